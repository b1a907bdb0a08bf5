"""Contiguous shards of near-equal byte size from per-partition prefix sums.

Rows are put in one global order (doc_id, then checksum, size and input
position as tie-breaks) by a range shuffle of narrow rows; texts never move.
Each range partition contributes one total, the totals are prefix-summed (one
row per partition), a running sum inside the partition adds the rest, and the
result is cut at equal multiples of ``total / shards``. DataFrame operations
only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import n_partitions, store

ROW_BYTES = 8  # fixed cost of a row beside its text


def shard_by_bytes(docs: DataFrame, shards: int = 24, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Assign every row to a shard: (doc_id, size, text_crc32, shard, slot).

    * ``size``: UTF-8 bytes of the text plus 8; a null text has no bytes and
      the checksum of the empty text.
    * A row belongs to the shard in which its first byte falls, so shards are
      contiguous in the global order and differ from ``total / shards`` by less
      than one row.
    * ``slot``: gapless position within the shard, from 0.

    Null ids come first; rows equal in id, size and checksum are
    interchangeable; an empty table gives an empty result; a shard may be
    empty when there are fewer rows than shards; other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.monotonically_increasing_id().alias("_pos"))
    order = [F.col("doc_id").asc_nulls_first(), "text_crc32", "size", "_pos"]
    # An explicit partition count is never coalesced, so the stored partition
    # number is a fixed property of each row from here on.
    ranged = store(rows.repartitionByRange(max(n_partitions(spark), shards), *order)
                   .withColumn("_part", F.spark_partition_id()), "shard-rows")

    totals = ranged.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row per partition: the single-task window and the broadcast are
    # bounded by the number of partitions.
    prefix = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_byte_base"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row_base"),
        F.sum("_bytes").over(everything).alias("_total"))

    inside = Window.partitionBy("_part").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first_byte = F.col("_byte_base") + F.sum("size").over(running) - F.col("size")
    placed = ranged.join(F.broadcast(prefix), "_part").select(
        "doc_id", "size", "text_crc32",
        F.floor(first_byte.cast("decimal(20,0)") * F.lit(shards) / F.col("_total")).cast("int").alias("shard"),
        (F.col("_row_base") + F.row_number().over(inside) - 1).alias("_rank"))
    first = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_rank") - F.col("_first")).alias("slot"))


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard_by_bytes(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


SQL = """
WITH crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab
), hexed AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                        lambda x: CAST('0x' || x AS BIGINT)) AS bytes
  FROM documents
), rows_ AS (
  SELECT doc_id, CAST(len(bytes) + 8 AS BIGINT) AS size,
         CAST(xor(4294967295, list_reduce(list_concat([4294967295], bytes),
              lambda a, b: xor(a >> 8, tab[xor(a & 255, b) + 1]))) AS BIGINT) AS text_crc32
  FROM hexed, crc_table
), summed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS first_byte,
         sum(size) OVER () AS total,
         row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) AS rn
  FROM rows_
), cut AS (
  SELECT *, CAST((first_byte * 24) // total AS INTEGER) AS shard FROM summed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       CAST(rn - min(rn) OVER (PARTITION BY shard) AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM cut
"""
