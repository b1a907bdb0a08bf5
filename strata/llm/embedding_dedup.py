"""Near-duplicate vectors by cross-polytope hashing with multiprobe buckets; every candidate pair is verified.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; its hash is the largest
coordinate and its sign. A table joins ``k`` such hashes. A vector has its home bucket in every table and
visits the buckets its next-best coordinates name, so two vectors meet when one visits the other's home. How many
tables and visits are needed is found by simulating pairs that lie exactly at the threshold.

Links are counted inside buckets by matrix products and never written out as pairs: a pair counts in the first
bucket where it meets, and a bucket gives each of its vectors a number of links and one tree edge. Equal vectors
are one class from the start. Buckets with very many vectors are cut into tiles.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import batches, by_key, discard, store
from strata.llm.components import connected_components

MISSED = 0.001        # share of pairs at the threshold that may meet nowhere
FULL = 1024           # vectors per bucket that the number of hashes aims at
TILE = 1 << 16        # vectors of a bucket that one task compares at once
CELLS = 1 << 20       # at most so many buckets are cut into tiles
STEP = 1024           # rows and columns of one matrix product
BEST = 4              # coordinates of a rotation that a visit may use
NO_ID = (1 << 63) - 1


# --- hashing --------------------------------------------------------------

def _hadamard(v: np.ndarray) -> np.ndarray:
    rows, size = v.shape
    half = 1
    while half < size:
        v = v.reshape(rows, -1, 2, half)
        v = np.stack([v[:, :, 0] + v[:, :, 1], v[:, :, 0] - v[:, :, 1]], 2).reshape(rows, size)
        half *= 2
    return v / math.sqrt(size)


@lru_cache(maxsize=256)
def _signs(size: int, number: int) -> np.ndarray:
    return np.random.default_rng([size, number]).choice(np.array([-1.0, 1.0]), (3, size))


def _best_coordinates(v: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the coordinates of the ``number``-th rotation that are largest in size: code (index and sign) and size."""
    for signs in _signs(v.shape[1], number):
        v = _hadamard(v * signs)
    order = np.argsort(-np.abs(v), axis=1, kind="stable")[:, :BEST]
    top = np.take_along_axis(v, order, 1)
    return order * 2 + (top < 0), np.abs(top)


@lru_cache(maxsize=64)
def _ways(hashes: int, best: int) -> list[tuple[int, ...]]:
    """Choices of a coordinate per hash, none far down in more than one of them; home first."""
    ways = [w for w in product(range(best), repeat=hashes) if math.prod(x + 1 for x in w) <= BEST]
    return sorted(ways, key=lambda w: (sum(w), w))


def _buckets(v: np.ndarray, table: int, hashes: int, visits: int) -> np.ndarray:
    """(rows, 1 + visits) bucket codes in one table: home, then the visits that give up least."""
    codes, sizes = zip(*(_best_coordinates(v, table * hashes + j) for j in range(hashes)), strict=True)
    ways = _ways(hashes, codes[0].shape[1])
    base = 2 * v.shape[1]
    code = np.stack([sum(codes[j][:, w[j]].astype(np.int64) * base ** j for j in range(hashes)) for w in ways], 1)
    loss = np.stack([sum((sizes[j][:, 0] - sizes[j][:, w[j]]) ** 2 for j in range(hashes)) for w in ways], 1)
    loss[:, 0] = -1.0
    order = np.argsort(loss, axis=1, kind="stable")[:, :1 + visits]
    return np.take_along_axis(code, order, 1)


def _meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of ``a`` and ``b`` (bucket codes) meet: one visits, or shares, the other's home."""
    return (a == b[:, :1]).any(1) | (b == a[:, :1]).any(1)


@lru_cache(maxsize=64)
def plan(size: int, hashes: int, threshold: float) -> tuple[int, int]:
    """(tables, visits) with the fewest rows that miss at most ``MISSED`` of the pairs at the threshold."""
    rng = np.random.default_rng(size)
    x = rng.normal(size=(1500, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-300)
    y = threshold * x + math.sqrt(1 - threshold ** 2) * z
    best = None
    for visits in (1, 2, 3):
        met = np.mean([_meet(_buckets(x, t, hashes, visits), _buckets(y, t, hashes, visits)) for t in range(3)])
        tables = max(1, math.ceil(math.log(MISSED) / math.log(max(1 - met, 1e-9))))
        if best is None or tables * (1 + visits) < best[0] * (1 + best[1]):
            best = (tables, visits)
    return best


def padded(size: int) -> int:
    return max(2, 1 << (size - 1).bit_length())


def unit(raw: list[bytes], dtype: str) -> np.ndarray:
    """Vectors of one length as rows of unit length (double)."""
    m = np.stack([np.frombuffer(x, dtype) for x in raw]).astype(np.float64)
    m /= np.abs(m).max(1, keepdims=True)
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def _widened(m: np.ndarray) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, padded(m.shape[1]) - m.shape[1])))


# --- classes of equal vectors ---------------------------------------------

def _vectors(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """(vec_id, key, vec): a digest of the vector (null for one that takes no part) and its bytes."""
    kind = df.schema[vec_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    dtype = "<f4" if single else "<f8"
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"),
                     F.col(vec_col).cast("array<float>" if single else "array<double>").alias("v"))
    schema = "vec_id long, key binary, vec binary"

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema([("vec_id", pa.int64()), ("key", pa.binary()), ("vec", pa.binary())])
        for batch in it:
            keys, raws = [], []
            for v in batch.column("v"):
                values = None if not v.is_valid or v.values.null_count else v.values.to_numpy() + 0.0
                fit = values is not None and len(values) and np.isfinite(values).all() and values.any()
                raw = values.astype(dtype).tobytes() if fit else None
                raws.append(raw)
                keys.append(None if raw is None else hashlib.sha256(raw).digest())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.binary()),
                                              pa.array(raws, pa.binary())], schema=arrow)

    return rows.mapInArrow(run, schema), dtype


# --- buckets and tiles ----------------------------------------------------

def _entries(classes: DataFrame, dtype: str, hashes: int, threshold: float, slim: bool) -> DataFrame:
    """A row per class and bucket: (size, bucket), and unless ``slim`` also (home, cid, least, n, vec)."""
    names = ["size", "bucket"] + ([] if slim else ["home", "cid", "least", "n", "vec"])
    kinds = {"size": pa.int32(), "bucket": pa.int64(), "home": pa.bool_(), "cid": pa.int64(), "least": pa.int64(),
             "n": pa.int64(), "vec": pa.binary()}
    arrow = pa.schema([(c, kinds[c]) for c in names])
    width = np.dtype(dtype).itemsize

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            raw = batch.column("vec").to_pylist()
            sizes = np.array([len(x) // width for x in raw])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                part = batch.take(pa.array(at))
                v = _widened(unit([raw[i] for i in at], dtype))
                tables, visits = plan(v.shape[1], hashes, threshold)
                for t in range(tables):
                    codes = _buckets(v, t, hashes, visits) * tables + t
                    for way in range(codes.shape[1]):
                        cols = [pa.array(np.full(len(at), size, np.int32)), pa.array(codes[:, way])]
                        if not slim:
                            cols += [pa.array(np.full(len(at), way == 0))]
                            cols += [part.column(c) for c in ("cid", "least", "n", "vec")]
                        yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    kind = {"size": "int", "bucket": "long", "home": "boolean", "cid": "long", "least": "long", "n": "long", "vec": "binary"}
    return classes.mapInArrow(run, ", ".join(f"{c} {kind[c]}" for c in names))


def _merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels of rows (the least row of their group) after links i-j."""
    while True:
        a, b = labels[i], labels[j]
        if (a == b).all():
            return labels
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further


def compare(v: np.ndarray, home: np.ndarray, n: np.ndarray, part: np.ndarray, bucket: int, hashes: int, threshold: float):
    """(links, labels) of the vectors of one bucket tile.

    ``part`` numbers the tile's one or two blocks of the bucket: with two, only pairs across them are compared
    (those inside a block have a tile of their own). A pair counts only in the first bucket where it meets, in
    the order of table, then code.
    """
    rows = len(v)
    wide = _widened(v)
    tables, visits = plan(wide.shape[1], hashes, threshold)
    table, code = bucket % tables, bucket // tables
    known: dict[int, dict[int, np.ndarray]] = {}
    links, labels = np.zeros(rows, np.int64), np.arange(rows)
    crossing = part.min() != part.max()
    order = np.argsort(part, kind="stable")
    blocks = [order[k:k + STEP] for k in range(0, rows, STEP)]

    def codes(block: int, t: int) -> np.ndarray:
        mine = known.setdefault(block, {})
        if t not in mine:
            mine[t] = _buckets(wide[blocks[block]], t, hashes, visits)
        return mine[t]

    for x, a in enumerate(blocks):
        for y in range(x, len(blocks)):
            b = blocks[y]
            if crossing and part[a[0]] == part[b[-1]]:
                continue
            near = v[a] @ v[b].T >= threshold
            near &= home[a][:, None] | home[b][None, :]
            if crossing:
                near &= part[a][:, None] != part[b][None, :]
            if x == y:
                near = np.triu(near, 1)
            i, j = np.nonzero(near)
            for t in range(table + 1):  # met before?
                if not len(i):
                    break
                p, q = codes(x, t)[i], codes(y, t)[j]
                if t < table:
                    earlier = _meet(p, q)
                else:
                    earlier = ((p == q[:, :1]).any(1) & (q[:, 0] < code)) | ((q == p[:, :1]).any(1) & (p[:, 0] < code))
                i, j = i[~earlier], j[~earlier]
            if len(i):
                i, j = a[i], b[j]
                links += np.bincount(i, n[j], rows).astype(np.int64) + np.bincount(j, n[i], rows).astype(np.int64)
                labels = _merge(labels, i, j)
        known.pop(x, None)
    return links, labels


def _links(tiles: DataFrame, dtype: str, hashes: int, threshold: float) -> DataFrame:
    """Per class and tile: its links there and one edge of the tile's trees, (least, cid) to (to_least, to_cid)."""
    out = "cid long, least long, links long, to_cid long, to_least long"
    names = ["size", "bucket", "tile", "part", "home", "cid", "least", "n", "vec"]

    def groups(it: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Sorted rows cut where (size, bucket, tile) changes; a group is at most ``TILE`` rows or so."""
        held: list[pa.RecordBatch] = []
        for batch in it:
            held.append(batch)
            if sum(map(len, held)) < TILE // 4:
                continue
            table = pa.Table.from_batches(held)
            edge = _edges(table)
            if len(edge):
                yield table.slice(0, edge[-1])
                held = table.slice(edge[-1]).combine_chunks().to_batches()
        if held:
            yield pa.Table.from_batches(held)

    def _edges(table: pa.Table) -> np.ndarray:
        change = np.zeros(max(len(table) - 1, 0), bool)
        for c in names[:3]:
            change |= np.diff(table.column(c).to_numpy()) != 0
        return np.flatnonzero(change) + 1

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema([(c, pa.int64()) for c in ("cid", "least", "links", "to_cid", "to_least")])
        for table in groups(it):
            ends = [*_edges(table).tolist(), len(table)]
            rows, start = [], 0
            for end in ends:
                if end - start > 1:
                    g = table.slice(start, end - start).combine_chunks()
                    cid, least = g.column("cid").to_numpy(), g.column("least").to_numpy()
                    links, labels = compare(unit(g.column("vec").to_pylist(), dtype), g.column("home").to_numpy(),
                                            g.column("n").to_numpy(), g.column("part").to_numpy(),
                                            g.column("bucket")[0].as_py(), hashes, threshold)
                    hit = np.flatnonzero(links)
                    to = labels[hit]
                    rows += zip(cid[hit].tolist(), least[hit].tolist(), links[hit].tolist(), cid[to].tolist(),
                                least[to].tolist(), strict=True)
                start = end
            yield from batches(arrow, rows)

    return tiles.select(*names).repartition("size", "bucket", "tile") \
        .sortWithinPartitions("size", "bucket", "tile", "part", "cid").mapInArrow(run, out)


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """One row per row of ``df``: id, n_links (other vectors with a cosine of ``threshold`` or more), component_id
    (the least id reachable by links, itself included) and kept (id = component_id).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of different
    lengths do not link. Equal vectors, repeated rows included, link with each other. Null ids count as vectors, but
    name a component only where no other id does. Vectors of any length are hashed whole. An empty table gives an
    empty result. Other columns are not read, so their names cannot clash.
    """
    vectors, dtype = _vectors(df, id_col, vec_col)
    # `vec` is the same for all rows of a key; a hot vector is reduced in every task before the shuffle.
    classes = vectors.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("vec").alias("vec"), F.coalesce(F.min("vec_id"), F.lit(NO_ID)).alias("least"), F.count(F.lit(1)).alias("n"))
    classes = store(classes.withColumn("cid", F.monotonically_increasing_id()), "vec-classes")
    facts = classes.agg(F.count(F.lit(1)), F.max(F.length("vec"))).first()
    if facts[0] == 0:
        return vectors.select(F.col("vec_id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                              F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    base = 2 * padded(facts[1] // np.dtype(dtype).itemsize)
    hashes = max(1, math.ceil(math.log(facts[0] / FULL) / math.log(base)))

    # Buckets over the size of a tile; their number is bounded by CELLS, hence the broadcast.
    cells = _entries(classes, dtype, hashes, threshold, slim=True).groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    cells = store(cells.filter(F.col("rows") > TILE // 2), "vec-cells")
    entries = cells.agg(F.sum("rows")).first()[0] or 0
    cut = max(TILE, entries // CELLS)
    large = cells.filter(F.col("rows") > cut).withColumn("blocks", F.ceil(F.col("rows") / (cut // 2)).cast("int")).drop("rows")
    rows = _entries(classes, dtype, hashes, threshold, slim=False).join(F.broadcast(large), ["size", "bucket"], "left")
    blocks = F.coalesce("blocks", F.lit(1))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("cid"), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    tiles = rows.withColumn("_other", other).withColumn(
        "tile", F.least("part", "_other").cast("long") * 1_000_000_000 + F.greatest("part", "_other"))
    found = store(_links(tiles, dtype, hashes, threshold), "vec-links")
    discard(cells)

    a, b = F.struct("least", "cid").alias("a"), F.struct(F.col("to_least").alias("least"), F.col("to_cid").alias("cid")).alias("b")
    comps = connected_components(found.filter("cid <> to_cid").select(a, b))
    comps = comps.select(F.col("class.cid").alias("cid"), F.col("component.least").alias("component_id"))
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    out = classes.select("key", "cid", "least", "n").join(counts, "cid", "left").join(comps, "cid", "left")
    out = store(out.select("key", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                           F.coalesce("component_id", "least").alias("component_id")), "vec-result")
    discard(classes, found)
    whole = by_key(vectors.select("vec_id", "key"), out, ["key"], "n")
    component = F.coalesce(F.nullif("component_id", F.lit(NO_ID)), "vec_id")
    return whole.select(F.col("vec_id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
  FROM embeddings
), fit AS (
  SELECT r, vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.r AS a, b.r AS b FROM fit a JOIN fit b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) / (a.norm * b.norm) >= 0.95
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (
  SELECT reach.a, min(v.vec_id) AS least FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a
)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.r) AS n_links,
       coalesce(least(l.least, v.vec_id), l.least, v.vec_id) AS component_id,
       v.vec_id IS NOT DISTINCT FROM coalesce(least(l.least, v.vec_id), l.least, v.vec_id) AS kept
FROM v LEFT JOIN least l ON l.a = v.r
"""
