"""Regional carbon intensity: raw polls -> staged views -> metrics -> marts.

Raw input is two flat tables from one nested document per poll: intensity
(one row per region and half hour) and generation mix (one row per region,
fuel and half hour). Staging renames, parses periods and labels regions and
fuels; the intermediate model pivots fuels into columns and joins them to the
intensity rows; the marts filter granular regions and summarise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.classify import (
    GRANULAR_REGION_RANGE, day_type, fuel_category, region_label, region_type, time_period,
)
from strata.functions.numeric import exact_avg, round_half_up
from strata.functions.parse import parse_period
from strata.operators.aggregate import conditional_sum_pivot, most_common
from strata.operators.latest import latest_batch
from strata.operators.quality import Rule, accepted_values, not_null
from strata.operators.rank import global_ranks
from strata.sources.files import stored

# Output columns of the pivot, in published order, as
# (column, compared column, compared value).
PIVOT_SPEC = (
    ("renewable_pct", "fuel_category", "renewable"),
    ("low_carbon_pct", "fuel_category", "low_carbon"),
    ("fossil_pct", "fuel_category", "fossil"),
    ("imports_pct", "fuel_category", "imports"),
    ("wind_pct", "fuel_type", "wind"),
    ("solar_pct", "fuel_type", "solar"),
    ("nuclear_pct", "fuel_type", "nuclear"),
    ("gas_pct", "fuel_type", "gas"),
    ("coal_pct", "fuel_type", "coal"),
)
# Accepted labels of the staged tables.
INTENSITY_LABELS = ("very low", "low", "moderate", "high", "very high")
REGION_TYPES = ("granular", "aggregate")
FUELS = ("wind", "solar", "hydro", "nuclear", "biomass", "gas", "coal", "imports", "other")
FUEL_CATEGORY_LABELS = ("renewable", "low_carbon", "fossil", "imports", "other")

INTENSITY_RULES = (
    not_null("region_id"),
    not_null("carbon_intensity_gco2_kwh"),
    not_null("intensity_category"),
    accepted_values("intensity_category", INTENSITY_LABELS),
    accepted_values("region_type", REGION_TYPES),
)
GENERATION_RULES = (
    not_null("region_id"),
    not_null("fuel_type"),
    accepted_values("fuel_type", FUELS),
    not_null("generation_pct"),
    accepted_values("fuel_category", FUEL_CATEGORY_LABELS),
)

# Columns of the published serving tables.
CARBON_MART_COLUMNS = [
    "region_id", "region_name", "region_label", "carbon_intensity_gco2_kwh", "intensity_category",
    "clean_energy_pct", "renewable_pct", "low_carbon_pct", "fossil_pct", "imports_pct", "wind_pct",
    "solar_pct", "nuclear_pct", "gas_pct", "coal_pct", "period_from", "period_to", "hour_of_day",
    "day_of_week", "day_type", "time_period", "month_of_year", "_ingested_at",
]
GENERATION_MART_COLUMNS = [
    "region_id", "region_name", "region_label", "wind_pct", "solar_pct", "nuclear_pct", "gas_pct",
    "coal_pct", "renewable_pct", "low_carbon_pct", "fossil_pct", "imports_pct", "clean_energy_pct",
    "carbon_intensity_gco2_kwh", "intensity_category", "period_from",
]
METRIC_COLUMNS = [name for name, _, _ in PIVOT_SPEC]


def granular_only(df: DataFrame, granular=GRANULAR_REGION_RANGE) -> DataFrame:
    """Granular regions, written on ``region_id`` so that the predicate can
    reach a Parquet scan of the raw table (a CASE label cannot)."""
    lo, hi = granular
    return df.filter(F.col("region_id").between(lo, hi))


def stg_carbon_intensity(raw: DataFrame) -> DataFrame:
    return raw.select(
        "region_id",
        F.col("short_name").alias("region_name"),
        "dno_region",
        F.col("intensity_forecast").alias("carbon_intensity_gco2_kwh"),
        F.col("intensity_index").alias("intensity_category"),
        parse_period("period_from").alias("period_from"),
        parse_period("period_to").alias("period_to"),
        region_type("region_id").alias("region_type"),
        region_label("region_id", "short_name").alias("region_label"),
        "batch_id",
        "_ingested_at",
    )


def stg_generation_mix(raw: DataFrame) -> DataFrame:
    return raw.select(
        "region_id",
        F.col("short_name").alias("region_name"),
        "fuel_type",
        F.col("percentage").alias("generation_pct"),
        fuel_category("fuel_type").alias("fuel_category"),
        parse_period("period_from").alias("period_from"),
        parse_period("period_to").alias("period_to"),
        "batch_id",
        "_ingested_at",
    )


def dedupe_polls(df: DataFrame, keys, order: str = "batch_id", keep: str = "first") -> DataFrame:
    """One row per key when the same period was polled more than once: the
    first poll (smallest ``order``, a missing one last) by default, or the
    latest (a missing one first). Polls of equal order are told apart by all
    other columns, so the survivor does not depend on the partitioning."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c != order]
    first = F.col(order).isNull() if keep == "first" else F.col(order).isNotNull()
    row = F.struct(first.alias("_known"), F.col(order), *rest)
    pick = F.min if keep == "first" else F.max
    return df.groupBy(*keys).agg(pick(row).alias("_r")).select(
        *[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def pivot_generation(gen: DataFrame, spec=PIVOT_SPEC) -> DataFrame:
    """Fuel rows to fixed percentage columns per region and period (one pass)."""
    return conditional_sum_pivot(
        gen, ["region_id", "period_from"],
        [(name, F.col(col) == F.lit(value), "generation_pct") for name, col, value in spec])


def int_regional_metrics(intensity: DataFrame, generation: DataFrame, spec=PIVOT_SPEC) -> DataFrame:
    """Intensity rows left-joined to the pivoted mix; clean energy = renewable
    + low carbon (null when the period has no mix)."""
    pivoted = pivot_generation(generation, spec)
    i = intensity.alias("i")
    g = pivoted.alias("g")
    joined = i.join(g, ["region_id", "period_from"], "left")
    names = [name for name, _, _ in spec]
    return joined.select(
        "region_id", "region_name", "region_type", "region_label", "carbon_intensity_gco2_kwh",
        "intensity_category", "period_from", "period_to", *names,
        round_half_up(F.col("renewable_pct") + F.col("low_carbon_pct"), 2).alias("clean_energy_pct"),
        "_ingested_at",
    )


def int_time_features(metrics: DataFrame, wrap_midnight: bool = False) -> DataFrame:
    p = F.col("period_from")
    return metrics.withColumns({
        "hour_of_day": F.hour(p),
        "day_of_week": F.dayofweek(p),
        "day_of_month": F.dayofmonth(p),
        "month_of_year": F.month(p),
    }).withColumns({
        "time_period": time_period("hour_of_day", wrap_midnight=wrap_midnight),
        "day_type": day_type("day_of_week"),
    })


def mart_carbon_intensity(features: DataFrame) -> DataFrame:
    """Granular regions, full series, 23 columns."""
    return granular_only(features).select(*CARBON_MART_COLUMNS)


def mart_generation_mix(features: DataFrame, partition: str | None = None) -> DataFrame:
    """Granular regions in the newest period (scalar-subquery filter)."""
    return latest_batch(granular_only(features), "period_from", partition).select(*GENERATION_MART_COLUMNS)


def mart_peak_analysis(features: DataFrame) -> DataFrame:
    return granular_only(features).groupBy("region_name", "region_label", "time_period", "day_type").agg(
        round_half_up(exact_avg("carbon_intensity_gco2_kwh"), 2).alias("avg_intensity"),
        round_half_up(exact_avg("renewable_pct"), 2).alias("avg_renewable_pct"),
        round_half_up(exact_avg("fossil_pct"), 2).alias("avg_fossil_pct"),
        F.count(F.lit(1)).alias("observations"),
    )


def regional_summary(features: DataFrame) -> DataFrame:
    def avg2(c):
        return round_half_up(exact_avg(c), 2)
    return granular_only(features).groupBy("region_id", "region_name", "region_label").agg(
        avg2("carbon_intensity_gco2_kwh").alias("avg_intensity"),
        round_half_up(F.min("carbon_intensity_gco2_kwh"), 2).alias("min_intensity"),
        round_half_up(F.max("carbon_intensity_gco2_kwh"), 2).alias("max_intensity"),
        avg2("clean_energy_pct").alias("avg_clean_energy_pct"),
        avg2("renewable_pct").alias("avg_renewable_pct"),
        avg2("wind_pct").alias("avg_wind_pct"),
        avg2("solar_pct").alias("avg_solar_pct"),
        avg2("nuclear_pct").alias("avg_nuclear_pct"),
        avg2("gas_pct").alias("avg_gas_pct"),
        F.countDistinct("period_from").alias("data_points"),
        most_common("intensity_category").alias("most_common_category"),
    )


def mart_regional_comparison(features: DataFrame) -> DataFrame:
    """Per granular region: 11 aggregates, cleanest (ascending) and dirtiest
    (descending) rank."""
    return rank_both_ways(regional_summary(features))


def rank_both_ways(summary: DataFrame, value: str = "avg_intensity") -> DataFrame:
    """Rank ascending and descending in one pass; the published ranks are ints. The summary is stored first."""
    s = global_ranks(stored(summary, "regional-summary"), value,
                     {"cleanest_rank": (True, False), "dirtiest_rank": (False, False)})
    return s.withColumns({c: F.col(c).cast("int") for c in ("cleanest_rank", "dirtiest_rank")})


def quality_rules() -> dict[str, tuple[Rule, ...]]:
    return {"stg_carbon_intensity": INTENSITY_RULES, "stg_generation_mix": GENERATION_RULES}
