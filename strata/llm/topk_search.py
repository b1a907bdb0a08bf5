"""Exact top-k inner-product search: tiled matrix products with tree merging.

Query vectors are packed into blocks of bounded size; a pass broadcasts a bounded number of them and stores what
it finds. Every task walks its shard of the vectors in tiles; a tile is one matrix
product with the query block, from which the k best per query are selected and
merged into the task's running lists. The lists of the tasks are merged by a
tree of fixed fan-in, so no task ever sees the lists of all shards at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import batches, store

QUERY_BLOCK = 1024  # query vectors in a broadcast block
PASS_BLOCKS = 64  # blocks that one pass over the shards serves
TILE_ROWS = 4096
FAN_IN = 16
_EXACT = float(1 << 53)  # doubles hold every integer up to here
_LONG = (1 << 63) - 1

LISTS = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("node", T.LongType()),
                      T.StructField("query", T.BinaryType()), T.StructField("vec_id", T.BinaryType()),
                      T.StructField("score", T.BinaryType())])


def _matrix(column: pa.Array) -> tuple[np.ndarray, int]:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    n = len(column)
    return (flat.reshape(n, -1) if n else flat.reshape(0, 0)), n


def scores(queries: np.ndarray, tile: np.ndarray) -> np.ndarray:
    """Exact integer inner products of integer-valued double matrices.

    One floating-point product when no partial sum can leave the exact range of
    doubles, else integer arithmetic of any length, clamped to the long range.
    """
    if not queries.size or not tile.size:
        return np.zeros((len(queries), len(tile)), np.int64)
    if np.abs(queries).max() * np.abs(tile).max() * queries.shape[1] < _EXACT:
        return (queries @ tile.T).astype(np.int64)
    whole = lambda m: np.vectorize(int, otypes=[object])(m)
    exact = whole(queries) @ whole(tile).T
    return np.clip(exact, -_LONG - 1, _LONG).astype(np.int64)


def best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best entries of each query: higher score first, then smaller vec_id."""
    order = np.lexsort((vec, np.negative(np.maximum(score, -_LONG)), query))
    query, vec, score = query[order], vec[order], score[order]
    first = np.flatnonzero(np.diff(query, prepend=query[0] - 1)) if len(query) else np.zeros(0, np.int64)
    place = np.arange(len(query)) - np.repeat(first, np.diff(first, append=len(query)))
    keep = place < k
    return query[keep], vec[keep], score[keep]


def tile_best(q_rows: np.ndarray, q: np.ndarray, rows: np.ndarray, vec: np.ndarray, tile: np.ndarray,
              k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per-query selection of one tile; a query's own row takes no part."""
    order = np.argsort(vec, kind="stable")
    rows, vec, tile = rows[order], vec[order], tile[order]
    s = scores(q, tile)
    own_q, own_c = np.nonzero(q_rows[:, None] == rows[None, :])
    valid = np.ones(s.shape, bool)
    valid[own_q, own_c] = False
    out_q, out_c = [], []
    m = s.shape[1]
    for i in range(len(q)):
        c = np.flatnonzero(valid[i])
        x = s[i, c]
        if len(c) > k:
            edge = np.partition(x, len(c) - k)[len(c) - k]
            above = np.flatnonzero(x > edge)
            # vec is ascending, so the first ties have the smallest ids
            ties = np.flatnonzero(x == edge)[:k - len(above)]
            c = c[np.concatenate([above, ties])]
        out_q.append(np.full(len(c), i))
        out_c.append(c)
    if not out_q or not m:
        z = np.zeros(0, np.int64)
        return z, z, z
    qi, ci = np.concatenate(out_q), np.concatenate(out_c)
    return q_rows[qi], vec[ci], s[qi, ci]


def exact_top_k(vectors: DataFrame, k: int = 10, is_query: F.Column | None = None, id_col: str = "vec_id",
                vector_col: str = "embedding", scale: float = 1024.0, query_block: int = QUERY_BLOCK,
                tile_rows: int = TILE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for every query row.

    Components become floor(scale * x); the score is the exact integer inner
    product. Queries are the rows with ``is_query`` (default: id divisible by
    100); candidates are all rows but the query's own row. Ties go to the
    smaller id. Rows with a null id, a null or empty vector, or null or
    non-finite components take no part; only vectors of equal length are
    compared; repeated ids are rows of their own (their ranks share a
    query_id). An empty table gives an empty result. Scores beyond the long
    range are clamped to it.
    """
    if is_query is None:
        is_query = F.col("vec_id") % 100 == 0
    spark = vectors.sparkSession
    sc = spark.sparkContext
    v = vectors.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("v"))
    v = v.filter(F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    # Stored once with their row ids: queries, candidates and every pass read the same rows.
    v = store(v.withColumn("_query", F.coalesce(is_query, F.lit(False))), "search-vectors")
    queries = v.filter("_query")
    sizes = {r["n"]: r["rows"] for r in queries.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
             .orderBy("n").toLocalIterator()}
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def search(it: Iterator[pa.RecordBatch], served) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(LISTS)
        node, blocks = TaskContext.get().partitionId(), served.value
        z = np.zeros(0, np.int64)
        lists = dict.fromkeys(range(len(blocks)), (z, z, z))
        for batch in it:
            sizes = np.diff(batch.column("v").offsets.to_numpy())
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                m, n = _matrix(part.column("v"))
                m = np.floor(m * scale)
                rows, ids = part.column("_row").to_numpy(), part.column("vec_id").to_numpy()
                for b, (q_rows, q) in enumerate(blocks):
                    if q.shape[1] != size:
                        continue
                    for at in range(0, n, tile_rows):
                        cut = slice(at, at + tile_rows)
                        found = tile_best(q_rows, q, rows[cut], ids[cut], m[cut], k)
                        lists[b] = best(*(np.concatenate(x) for x in zip(lists[b], found, strict=True)), k)
        yield from batches(arrow, [(b, node, *(x.astype(np.int64).tobytes() for x in got))
                                   for b, got in lists.items() if len(got[0])])

    def merge(table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        whole = [np.concatenate([np.frombuffer(x, np.int64) for x in table.column(c).to_pylist()])
                 for c in ("query", "vec_id", "score")]
        got = best(*whole, k)
        return pa.table({"block": table.column("block").slice(0, 1), "node": table.column("node").slice(0, 1),
                         **{c: pa.array([x.astype(np.int64).tobytes()], pa.binary())
                            for c, x in zip(("query", "vec_id", "score"), got, strict=True)}},
                        schema=to_arrow_schema(LISTS))

    ranks = T.StructType([T.StructField("_row", T.LongType()), T.StructField("rank", T.IntegerType()),
                          T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())])

    def ranked(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for raw in zip(*(batch.column(c).to_pylist() for c in ("query", "vec_id", "score")), strict=True):
                q, vec, score = (np.frombuffer(x, np.int64) for x in raw)
                first = np.flatnonzero(np.diff(q, prepend=q[0] - 1))
                place = np.arange(len(q)) - np.repeat(first, np.diff(first, append=len(q))) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q), pa.array(place.astype(np.int32)), pa.array(vec), pa.array(score)], names=ranks.names)

    # A pass takes a hash part of the queries that fits a bounded broadcast; its result is stored and the
    # broadcast dropped, so neither the driver nor a worker holds more than one pass however many queries there are.
    found = []
    for size, rows in sizes.items():
        passes = -(-rows // (PASS_BLOCKS * query_block // 2))
        for number in range(passes):
            mine = queries.filter((F.size("v") == size) & (F.pmod(F.xxhash64("_row"), F.lit(passes)) == number))
            got = mine.select("_row", "v").toArrow()
            q_rows, matrix = got.column("_row").to_numpy(), _matrix(got.column("v").combine_chunks())[0]
            if not len(q_rows):
                continue
            matrix = np.floor(matrix * scale)
            served = sc.broadcast([(q_rows[x:x + query_block], matrix[x:x + query_block])
                                   for x in range(0, len(q_rows), query_block)])
            shards = max(v.rdd.getNumPartitions(), 1)
            lists = v.select("_row", "vec_id", "v").mapInArrow(lambda it, served=served: search(it, served), LISTS)
            while shards > 1:  # levels of the merge tree
                lists = lists.withColumn("node", F.floor(F.col("node") / FAN_IN)).groupBy("block", "node") \
                    .applyInArrow(merge, LISTS)
                shards = -(-shards // FAN_IN)
            found.append(store(lists.mapInArrow(ranked, ranks), "search-ranks"))
            served.destroy()
    every = reduce(DataFrame.unionByName, found)
    ids = queries.select("_row", F.col("vec_id").alias("query_id"))
    return every.join(ids, "_row").select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir):
    return exact_top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 10)


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, CAST(vec_id AS BIGINT) AS vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.r AS qr, q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.r <> c.r AND len(q.e) = len(c.e)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
