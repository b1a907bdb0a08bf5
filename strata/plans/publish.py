"""End-to-end runs: raw -> clean -> quality gate -> publish serving tables.

Every frame is computed once: it is staged (written to a new version folder); its rules are
counted while it is written, with no scan of their own, and what follows reads it back. Only when
everything is staged and checked do the names change, each by one catalog
call. A failure before that leaves all tables as they were. Clean tables are
partitioned by day, and the newest batch or period is found from the partition
values first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.quality import Watch, not_lost, not_null
from strata.plans import carbon as cb
from strata.plans import markets as mk
from strata.plans import readmissions as rd
from strata.sources import sinks


class _Run:
    """Staged frames of one publishing run."""

    def __init__(self, spark: SparkSession, root: str, prefix: str):
        self.spark, self.root, self.prefix = spark, f"{root}/tables", prefix
        self.staged: dict[str, tuple[str, tuple]] = {}

    def stage(self, df: DataFrame, name: str, partition_by=None, hide=(), watch: Watch | None = None) -> DataFrame:
        df = df if watch is None else watch.on(df)
        location = sinks.stage(df, f"{self.prefix}_{name}", self.root, "parquet", partition_by)
        self.staged[name] = (location, tuple(hide))
        return self.spark.read.parquet(location)

    def publish(self, names) -> dict:
        for name, (location, hide) in self.staged.items():
            sinks.point(self.spark, f"{self.prefix}_{name}", location, "parquet", hide)
        return {name: self.staged[name][0] for name in names}


def publish_carbon(spark: SparkSession, intensity_raw: DataFrame, generation_raw: DataFrame, root: str,
                   prefix: str = "energy", dedupe_polls: bool = True, wrap_midnight: bool = False) -> dict:
    """Stage, check (a period that does not parse fails), model once, then publish the four marts."""
    run = _Run(spark, root, prefix)
    stg_i = cb.stg_carbon_intensity(intensity_raw)
    stg_g = cb.stg_generation_mix(generation_raw)
    if dedupe_polls:
        stg_i = cb.dedupe_polls(stg_i, ["region_id", "period_from"])
        stg_g = cb.dedupe_polls(stg_g, ["region_id", "fuel_type", "period_from"])
    periods = (not_null("period_from"), not_null("period_to"))
    watch_i, watch_g = Watch((*cb.INTENSITY_RULES, *periods)), Watch((*cb.GENERATION_RULES, *periods))
    stg_i = run.stage(stg_i, "stg_carbon_intensity", watch=watch_i)
    stg_g = run.stage(stg_g, "stg_generation_mix", watch=watch_g)
    watch_i.gate()
    watch_g.gate()
    features = cb.int_time_features(cb.int_regional_metrics(stg_i, stg_g), wrap_midnight=wrap_midnight)
    f = run.stage(features.withColumn("period_day", F.to_date("period_from")), "int_time_features",
                  partition_by="period_day", hide=("period_day",))
    out = {
        "mart_carbon_intensity": cb.mart_carbon_intensity(f),
        "mart_generation_mix": cb.mart_generation_mix(f, partition="period_day"),
        "mart_peak_analysis": cb.mart_peak_analysis(f),
        "mart_regional_comparison": cb.mart_regional_comparison(f),
    }
    for name, df in out.items():
        run.stage(df, name)
    return run.publish(out)


def publish_markets(spark: SparkSession, bronze: DataFrame, root: str, prefix: str = "crypto",
                    chunk_width: int | None = None, batch_seconds: bool = True) -> dict:
    """Clean series, checked (a time that does not parse fails), then the three serving tables.

    The clean series is partitioned by the day of its batch (batch ids are
    unix seconds when ``batch_seconds``, else days themselves), not by batch: polls
    every half hour would otherwise make tens of thousands of tiny partitions.
    """
    run = _Run(spark, root, prefix)
    silver = mk.silver_prices(bronze.withColumn("_text", F.col("last_updated")), chunk_width=chunk_width)
    day = F.to_date(F.timestamp_seconds("_batch_id")) if batch_seconds else F.col("_batch_id")
    watch = Watch([not_null("symbol"), not_null("_batch_id"), not_null("current_price"), not_lost("_lost")])
    s = run.stage(
        silver.withColumns({"_lost": F.col("_text").isNotNull() & F.col("last_updated").isNull(), "batch_day": day})
        .drop("_text"), "prices_clean", partition_by="batch_day", hide=("batch_day", "_lost"), watch=watch)
    watch.gate()
    latest = run.stage(mk.gold_latest_prices(s, partition="batch_day"), "latest_prices")
    run.stage(mk.gold_price_summary(s), "price_movement_summary")
    run.stage(mk.gold_market_dominance(latest), "market_dominance")
    return run.publish(("latest_prices", "price_movement_summary", "market_dominance"))


def publish_readmissions(spark: SparkSession, bronze: DataFrame, root: str, order_by,
                         prefix: str = "healthcare", allow_losses: bool = False) -> dict:
    """Clean rows, checked (flagged + unflagged = all, natural key present, no
    number or date lost unless ``allow_losses``), then the three summaries."""
    run = _Run(spark, root, prefix)
    rules = [not_null("facility_id"), not_null("measure_name"), not_null("is_suppressed")]
    watch = Watch(rules if allow_losses else [*rules, not_lost("_lost")], flag="is_suppressed")
    s = run.stage(rd.silver_hrrp(bronze, order_by=order_by, lost="_lost"), "cms_hrrp_clean", hide=("_lost",), watch=watch)
    watch.gate()
    out = {
        "hospital_readmission_summary": rd.gold_hospital_summary(s),
        "state_readmission_summary": rd.gold_state_summary(s),
        "condition_readmission_summary": rd.gold_condition_summary(s),
    }
    for name, df in out.items():
        run.stage(df, name)
    return run.publish(out)
