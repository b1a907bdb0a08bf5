"""A key with a large share of all rows is spread over tasks by the skew-safe operators."""

from pyspark.sql import functions as F

from strata.operators.movement import movement
from tests.conftest import rows


def _max_task_share(df) -> float:
    # sum(prev) keeps the window in the plan (an unused window would be pruned)
    per_task = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"),
                                                                 F.sum("prev").alias("m")).collect()
    total = sum(r["n"] for r in per_task)
    return max(r["n"] for r in per_task) / total


def test_hot_coin_lag_is_split_and_exact(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        n = 30000
        df = spark.range(n).select(
            F.when(F.col("id") % 5 < 2, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 997).cast("string")))
            .alias("s"),
            F.col("id").alias("b"), (F.col("id") % 13).cast("double").alias("p"))
        plain = movement(df, key="s", order="b", value="p", previous="prev")
        chunked = movement(df, key="s", order="b", value="p", previous="prev", chunk_width=500)
        # the hot coin holds 40 % of the rows: one task with the plain window
        assert _max_task_share(plain) >= 0.4
        assert _max_task_share(chunked) < 0.3
        assert rows(chunked, "s", "b", "prev") == rows(plain, "s", "b", "prev")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
