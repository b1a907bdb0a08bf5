"""Conflict-constrained best-fit packing of documents into bins of fixed size.

A bin takes at most one document of a source and at most one of a duplicate
cluster. Documents are dealt into blocks of bounded size by a hash; a block is
packed by best fit decreasing: open bins are kept ordered by residual, each
carries a bitmap of its sources and one of its clusters, and the search starts
at the smallest residual that fits and goes on to its successors until the
bitmaps show a compatible bin, which is then the tightest one. Only sizes and
keys are shuffled, never texts.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import lower_ascii

CAPACITY = 2048  # words of a bin, document ends included
BLOCK_ROWS = 4096  # documents packed together
BIN_BITS = 24  # bins of a block


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of every item; items come in the order in which they are placed.

    ``sources`` and ``clusters`` are small numbers, -1 for none (no conflict).
    """
    open_bins: list[tuple[int, int]] = []  # (residual, bin), ascending
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    bins, offsets = [], []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s = 1 << source if source >= 0 else 0
        c = 1 << cluster if cluster >= 0 else 0
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins):
            b = open_bins[at][1]
            if not (source_bits[b] & s or cluster_bits[b] & c):
                break
            at += 1
        if at < len(open_bins):
            residual, b = open_bins.pop(at)
        else:
            residual, b = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        bins.append(b)
        offsets.append(capacity - residual)
        source_bits[b] |= s
        cluster_bits[b] |= c
        if residual > size:
            insort(open_bins, (residual - size, b))
    return bins, offsets


def _numbers(column: pa.ChunkedArray) -> list[int]:
    """Small numbers for the distinct values of a column, -1 for null."""
    codes = column.combine_chunks().dictionary_encode().indices
    return codes.fill_null(-1).to_pylist()


def pack(docs: DataFrame, size: F.Column, cluster: F.Column, capacity: int = CAPACITY, id_col: str = "doc_id",
         source_col: str = "source", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pack every row: (doc_id, piece, piece_start, piece_size, bin_id, bin_offset).

    ``size`` is at least 1 for each row (smaller or null sizes count as 1). A
    row larger than ``capacity`` is cut into full pieces, each a bin of its own,
    and a rest that is packed like a document. Null sources and clusters never
    conflict. Equal rows are separate documents; ties are placed by id, then
    input position. Bin ids are unique, not gapless. Other columns are ignored;
    an empty table gives an empty result.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"),
        F.greatest(F.coalesce(size, F.lit(1)), F.lit(1)).cast("long").alias("_size"),
        F.col(source_col).cast("string").alias("_source"), cluster.alias("_cluster"))
    total = rows.count()
    blocks = max(1, -(-total // block_rows))
    rest = F.when(F.col("_size") % capacity == 0, F.least(F.col("_size"), F.lit(capacity))) \
        .otherwise(F.col("_size") % capacity)
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_row", F.lit("block")), F.lit(blocks))) \
        .withColumn("_rest", rest)

    out = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("_size", T.LongType()),
        T.StructField("_rest", T.LongType()), T.StructField("_first_bin", T.LongType()),
        T.StructField("_bin", T.LongType()), T.StructField("bin_offset", T.LongType())])

    def pack_block(table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        table = table.sort_by([("_rest", "descending"), ("doc_id", "ascending"), ("_row", "ascending")])
        n = len(table)
        sizes = table.column("_rest").to_pylist()
        bins, offsets = best_fit(sizes, _numbers(table.column("_source")), _numbers(table.column("_cluster")), capacity)
        base = table.column("_block")[0].as_py() << BIN_BITS if n else 0
        # Full pieces of long rows get the bins after those of the block's packing.
        full = (np.array(table.column("_size").to_pylist(), np.int64) - np.array(sizes, np.int64)) // capacity
        first = max(bins, default=-1) + 1 + np.cumsum(full) - full
        return pa.table({
            "doc_id": table.column("doc_id"), "_size": table.column("_size"), "_rest": table.column("_rest"),
            "_first_bin": pa.array(first + base, pa.int64()), "_bin": pa.array(np.array(bins, np.int64) + base),
            "bin_offset": pa.array(offsets, pa.int64())}, schema=to_arrow_schema(out))

    packed = rows.groupBy("_block").applyInArrow(pack_block, out)
    pieces = ((F.col("_size") - F.col("_rest")) / capacity).cast("int")  # exact: a multiple of the capacity
    piece = F.explode(F.sequence(F.lit(0), pieces)).alias("piece")
    last = F.col("piece") == pieces
    return packed.select("*", piece).select(
        "doc_id", "piece", (F.col("piece").cast("long") * capacity).alias("piece_start"),
        F.when(last, F.col("_rest")).otherwise(F.lit(capacity)).cast("long").alias("piece_size"),
        F.when(last, F.col("_bin")).otherwise(F.col("_first_bin") + F.col("piece")).cast("long").alias("bin_id"),
        F.when(last, F.col("bin_offset")).otherwise(F.lit(0)).cast("long").alias("bin_offset"))


def word_size(text_col: str = "text") -> F.Column:
    """Words of a text plus one for its end; 1 for a null text."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)) + 1


def text_cluster(text_col: str = "text") -> F.Column:
    """Duplicate cluster: texts equal up to the case of A-Z and runs of white space; null for no text."""
    same = F.trim(F.regexp_replace(lower_ascii(F.col(text_col)), "[\\x20\\x09-\\x0D]+", " "))
    return F.when(F.col(text_col).isNotNull(), F.xxhash64(same))


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, word_size(), text_cluster())
