"""A stored tree of counts over value ranges, from which dense ranks are read after small changes.

Values with a fixed number of fraction digits become whole numbers; a level groups 1,024 neighbours of the level
below. Every node knows the distinct values under it. A change of some values moves the nodes on their paths only;
the dense rank of a value is one more than the distinct values in the greater siblings on its path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.sources.files import drop_stored, stored
from strata.streaming.versions import Keyed

STEP = 10     # bits of a level
LEVELS = 4    # a top node spans 2**30 neighbouring values


class RankTree:
    def __init__(self, spark: SparkSession, path: str, digits: int, buckets: int = 64):
        self.spark, self.digits = spark, digits
        # Siblings share a bucket, so a path reads few buckets.
        self.levels = [Keyed(spark, f"{path}/level={k}", F.shiftright("node", STEP), buckets) for k in range(LEVELS)]

    def whole(self, value: str | Column) -> Column:
        c = F.col(value) if isinstance(value, str) else value
        return F.round(c.cast("decimal(38,12)") * F.lit(10 ** self.digits), 0).cast("long")

    def update(self, changes: DataFrame, mb: int) -> None:
        """``changes``: (value, n) - rows gained or lost per value; null values are not ranked here."""
        delta = stored(changes.filter("value IS NOT NULL").groupBy(self.whole("value").alias("node"))
                       .agg(F.sum("n").alias("n")).filter("n <> 0"), "rank-delta")
        values = self.levels[0]
        buckets = values.touched(delta)
        if not buckets:
            return
        old = values.read(mb - 1, buckets)
        both = delta if old is None else old.unionByName(delta)
        # Values without rows stay with 0: a bucket is written whole.
        values.write(both.groupBy("node").agg(F.sum("n").cast("long").alias("n")), mb)
        was = delta.withColumn("was", F.lit(0).cast("long")) if old is None else \
            delta.join(old.select("node", F.col("n").alias("was")), "node", "left")
        was = was.withColumn("was", F.coalesce("was", F.lit(0).cast("long")))
        # Distinct values that came or went; they move the counts above them.
        moved = (F.col("was") + F.col("n") > 0).cast("long") - (F.col("was") > 0).cast("long")
        up = stored(was.select("node", moved.alias("n")).filter("n <> 0"), "rank-moved")
        above = [up.groupBy(F.shiftright("node", STEP * k).alias("node")).agg(F.sum("n").cast("long").alias("n"))
                 .filter("n <> 0") for k in range(1, LEVELS)]
        for level, change in zip(self.levels[1:], above, strict=True):
            buckets = level.touched(change)
            if not buckets:
                break
            old = level.read(mb - 1, buckets)
            both = change if old is None else old.unionByName(change)
            level.write(both.groupBy("node").agg(F.sum("n").cast("long").alias("n")), mb)
        for table in (delta, up):
            drop_stored(table)

    def _above(self, k: int, upto: int) -> DataFrame | None:
        """Per node of a level the distinct values in greater siblings (of all greater nodes at the top)."""
        nodes = self.levels[k].read(upto)
        if nodes is None:
            return None
        nodes = nodes.filter("n > 0")
        count = F.lit(1) if k == 0 else F.col("n")
        parents = [F.shiftright("node", STEP)] if k < LEVELS - 1 else []
        greater = Window.partitionBy(*parents).orderBy(F.col("node").desc()).rowsBetween(Window.unboundedPreceding, -1)
        return nodes.select("node", F.coalesce(F.sum(count).over(greater), F.lit(0)).alias("above"))

    def dense_rank_desc(self, df: DataFrame, value: str, out: str, upto: int) -> DataFrame:
        """Add the dense rank of ``value``, largest first, nulls last; every value must be in the tree."""
        ranked, rank = df.withColumn("_node", self.whole(value)), F.lit(1)
        top = self.levels[-1].read(upto)
        if top is None:  # nothing but nulls
            return df.withColumn(out, F.lit(1).cast("long"))
        for k in range(LEVELS):
            above = self._above(k, upto).select(F.col("node").alias(f"_at{k}"), F.col("above").alias(f"_above{k}"))
            ranked = ranked.join(above, F.shiftright("_node", STEP * k) == F.col(f"_at{k}"), "left")
            rank = rank + F.col(f"_above{k}")
        all_values = F.coalesce(top.agg(F.sum("n")).scalar(), F.lit(0))
        ranked = ranked.withColumn(out, F.when(F.col("_node").isNull(), all_values + 1).otherwise(rank).cast("long"))
        return ranked.select(*df.columns, out)

    def tidy(self, mb: int) -> None:
        for level in self.levels:
            level.tidy(mb)
