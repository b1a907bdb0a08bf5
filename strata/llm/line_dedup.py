"""Line-run deduplication by a suffix array over line-id sequences.

Every text is a sequence of lines; equal lines share an id. Distributed prefix
doubling ranks the runs of 2**k lines that start at each position: the ranks of
a round are the global order of pairs of ranks of the round before. Positions
whose run occurs only once leave the rounds (their suffix is resolved), so the
rounds work on repeated lines alone.

A line is deleted when it lies in a run of lines of one text, of at least
``min_words`` words, that also starts at an earlier position of the corpus
(order: doc_id, input position, line number). So later copies of each maximal
repeated run go and the first copy of every line stays.

Two families of intervals are enough to find all such lines: for each line the
shortest qualifying run that starts there, and the shortest that ends there. A
run of L lines is named by two overlapping ranks of the largest power of two
within L; the suffixes that share a name form an interval of the suffix array
with a longest common prefix of at least L lines, and its first member is the
copy that stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import batches, discard, free_name, lean, n_partitions, store, text_bytes, words_of

MIN_WORDS = 50

LINES = T.StructType([
    T.StructField("_row", T.LongType()), T.StructField("line", T.IntegerType()),
    T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),  # the two halves of the line's hash
    T.StructField("fwd", T.IntegerType()), T.StructField("back", T.IntegerType())])


def run_lengths(n_words: list[int], min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line the lines of the shortest run with ``min_words`` words that starts (ends) there; 0: none."""
    n = len(n_words)
    total = np.concatenate([[0], np.cumsum(n_words)]).astype(np.int64)
    at = np.arange(n)
    end = np.searchsorted(total, total[:-1] + min_words, side="left")
    fwd = np.where(end <= n, end - at, 0)
    start = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    back = np.where(total[1:] >= min_words, at - start + 1, 0)
    return fwd, back


def _split(rows: DataFrame, min_words: int) -> DataFrame:
    """One row per line of every text that has a qualifying run."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(LINES)
        for batch in it:
            out: list[list] = [[] for _ in range(6)]
            for row, text in zip(batch.column("_row").to_pylist(), text_bytes(batch), strict=True):
                lines = text.split(b"\n")
                fwd, back = run_lengths([len(words_of(x)) for x in lines], min_words)
                if not fwd.any():
                    continue
                halves = np.frombuffer(b"".join(blake2b(x, digest_size=16).digest() for x in lines), np.int64)
                for col, x in zip(out, (np.full(len(lines), row), np.arange(len(lines)), halves[::2], halves[1::2],
                                        fwd, back), strict=True):
                    col.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c), type=f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)

    return rows.mapInArrow(run, LINES)


def _ranked(pairs: DataFrame, label: str) -> DataFrame:
    """Global ranks 0, 1, ... of the distinct rows (a, b): range partitions, local numbers, prefix sums."""
    spark = pairs.sparkSession
    order = ["a", "b"]
    parts = store(pairs.repartitionByRange(n_partitions(spark), *order)
                  .withColumn("_part", F.spark_partition_id()), label)
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: bounded by the number of partitions.
    base = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_part").orderBy(*order)
    return parts.join(F.broadcast(base), "_part").select(
        "a", "b", (F.col("_base") + F.row_number().over(inside) - 1).alias("rank"))


def later_copies(rows: DataFrame, min_words: int) -> DataFrame:
    """Lines to delete, from (_row, doc_id, text): one row per text, (_row, spans) with [start, end) line spans."""
    lines = store(_split(rows, min_words), "lines")
    done = [lines]
    longest = lines.agg(F.max(F.greatest("fwd", "back"))).first()[0] or 0

    def ranks(pairs: DataFrame, k: int) -> DataFrame:
        """(_row, line, rank) of the positions whose pair occurs at least twice."""
        repeated = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("a", "b")
        names = store(_ranked(repeated, f"line-order-{k}"), f"line-names-{k}")
        level = store(pairs.join(names, ["a", "b"]).select("_row", "line", "rank"), f"line-ranks-{k}")
        done.append(level)
        discard(names)
        return level

    order = rows.select("_row", "doc_id")
    wanted = lines.select("_row", "line", F.col("fwd").alias("n")).unionByName(
        lines.select("_row", (F.col("line") - F.col("back") + 1).alias("line"), F.col("back").alias("n"))) \
        .filter("n > 0").distinct()
    wanted = store(wanted, "line-runs")

    found = None
    k, level = 0, ranks(lines.select("_row", "line", "a", "b"), 0)
    while (1 << k) <= longest:
        size = 1 << k
        runs = wanted.filter((F.col("n") >= size) & (F.col("n") < 2 * size))
        second = level.select("_row", F.col("line").alias("_at"), F.col("rank").alias("_rank2"))
        named = runs.join(level, ["_row", "line"]).withColumn("_at", F.col("line") + F.col("n") - size) \
            .join(second, ["_row", "_at"]).select("_row", "line", "n", F.col("rank").alias("a"),
                                                  F.col("_rank2").alias("b"))
        found = named if found is None else found.unionByName(named)
        if 2 * size > longest:
            break
        shifted = level.select("_row", (F.col("line") - size).alias("line"), F.col("rank").alias("b"))
        k, level = k + 1, ranks(level.withColumnRenamed("rank", "a").join(shifted, ["_row", "line"]), k + 1)
    if found is None:
        found = wanted.filter("false").select("_row", "line", "n", F.lit(0).cast("long").alias("a"),
                                              F.lit(0).cast("long").alias("b"))
    # The interval of a name: all runs of n lines with these ranks; its first member stays.
    found = store(found.join(order, "_row").select(
        "n", "a", "b", F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "_row", "line").alias("at")),
        "line-intervals")
    first = store(found.groupBy("n", "a", "b").agg(F.min("at").alias("_first"), F.count(F.lit(1)).alias("_copies"))
                  .filter("_copies > 1").drop("_copies"), "line-firsts")
    later = store(found.join(first, ["n", "a", "b"]).filter(F.col("at") > F.col("_first")).select(
        F.col("at._row").alias("_row"), F.col("at.line").alias("start"),
        (F.col("at.line") + F.col("n")).alias("end")), "line-later")
    discard(*done, wanted, found, first)
    return later.groupBy("_row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _deleted(n: int, spans: list[dict]) -> np.ndarray:
    mark = np.zeros(n + 1, np.int64)
    for s in spans:
        mark[s["start"]] += 1
        mark[s["end"]] -= 1
    return np.cumsum(mark[:-1]) > 0


def _identified(docs: DataFrame, row: str) -> DataFrame:
    """The rows stored once with an id of their own in ``row``: everything that follows reads these, so the ids do not
    depend on how or how often the input is scanned."""
    return store(docs.withColumn(row, F.monotonically_increasing_id()), "line-rows")


def _texts(kept: DataFrame, row: str, id_col: str, text_col: str) -> DataFrame:
    return kept.select(F.col(row).alias("_row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
                chars_col: str | None = "n_chars", keep_emptied: bool = True) -> DataFrame:
    """The same rows and columns with later copies of repeated line runs deleted from the text.

    ``chars_col``, where the table has it, is set to the new length of changed
    texts. A null text stays null and takes no part; an empty text has one empty
    line. A text whose words all go becomes a text without words; its row stays,
    or goes with ``keep_emptied=False`` (it was a copy as a whole). Rows with
    equal ids are ordered by input position; null ids come first; very long texts are
    compared whole; names of other columns cannot clash; an empty table gives an empty result.
    """
    columns = docs.columns
    row, found = free_name(docs, "_row"), free_name(docs, "_spans")
    kept = _identified(docs, row)
    spans = later_copies(_texts(kept, row, id_col, text_col).filter(F.col("text").isNotNull()), min_words)
    marked = kept.join(
        spans.select(F.col("_row").alias(row), F.col("spans").alias(found)), row, "left")
    if chars_col not in columns:
        chars_col = None
    schema = docs.schema

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            spans = batch.column(len(columns)).to_pylist()
            batch = batch.select(list(range(len(columns))))
            changed = [k for k, s in enumerate(spans) if s]
            if changed:
                at = columns.index(text_col)
                texts = batch.column(at).to_pylist()
                chars = batch.column(columns.index(chars_col)).to_pylist() if chars_col else None
                keep = [True] * len(texts)
                for k in changed:
                    lines = texts[k].split("\n")
                    gone = _deleted(len(lines), spans[k])
                    texts[k] = "\n".join(x for x, d in zip(lines, gone, strict=True) if not d)
                    keep[k] = keep_emptied or bool(words_of(texts[k].encode()))
                    if chars is not None:
                        chars[k] = len(texts[k])
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.column(at).type))
                if chars is not None:
                    c = columns.index(chars_col)
                    batch = batch.set_column(c, batch.schema.field(c), pa.array(chars, batch.column(c).type))
                batch = batch.filter(pa.array(keep, pa.bool_()))
            yield batch

    return marked.select(*columns, found).mapInArrow(lean(run), schema)


def line_report(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per row: (doc_id, n_lines, n_removed, n_runs, kept_sha256) with the rules of ``dedup_lines``.

    ``n_runs`` counts maximal deleted runs; the digest is of the remaining
    UTF-8 text. A null text has no lines and the digest of the empty text; very long texts
    are hashed whole.
    """
    rows = _texts(_identified(docs.select(id_col, text_col), "_row"), "_row", id_col, text_col)
    spans = later_copies(rows.filter(F.col("text").isNotNull()), min_words)
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_lines", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("n_runs", T.LongType()),
        T.StructField("kept_sha256", T.StringType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in it:
            out = []
            nulls = batch.column("text").is_null().to_pylist()
            for doc_id, text, null, found in zip(batch.column("doc_id").to_pylist(), text_bytes(batch), nulls,
                                                 batch.column("spans").to_pylist(), strict=True):
                lines = [] if null else text.split(b"\n")
                gone = _deleted(len(lines), found or [])
                kept = text if not found else b"\n".join(x for x, d in zip(lines, gone, strict=True) if not d)
                out.append((doc_id, len(lines), int(gone.sum()),
                            int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()), sha256(kept).hexdigest()))
            yield from batches(arrow, out)

    return rows.join(spans, "_row", "left").select("doc_id", "text", "spans").mapInArrow(lean(run), schema)


def query(spark, sf_dir):
    return line_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
