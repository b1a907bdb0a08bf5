"""Hospital readmissions: raw file rows -> clean typed rows -> summaries.

Clean table grain: one row per facility and measure (natural key). The serving
tables summarise the reportable (not suppressed) rows per hospital, per state
and per condition, with a dense rank by average excess readmission ratio.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.classify import any_of, penalty_flag, risk_tier
from strata.functions.numeric import exact_avg, round_half_up
from strata.functions.parse import parse_mixed_date
from strata.operators.clean import (
    SUPPRESSED_VALUES, cast_columns, dedupe_natural_key, flag_suppressed, null_sentinels,
    rename_columns, snake_case_names, trim_columns, upper_trim_columns,
)
from strata.operators.rank import dense_rank_desc
from strata.sources.files import stored
from strata.sources.sinks import stamp_processed

# Header of the published file, in file order.
RAW_HEADER = [
    "Facility Name", "Facility ID", "State", "Measure Name", "Number of Discharges", "Footnote",
    "Excess Readmission Ratio", "Predicted Readmission Rate", "Expected Readmission Rate",
    "Number of Readmissions", "Start Date", "End Date",
]
# Columns whose sentinels mark a row as suppressed, and all columns cleaned of sentinels.
SUPPRESSION_CHECKED = ["number_of_discharges", "excess_readmission_ratio", "number_of_readmissions"]
SENTINEL_COLUMNS = ["number_of_discharges", "excess_readmission_ratio", "predicted_readmission_rate",
                    "expected_readmission_rate", "number_of_readmissions"]
NUMERIC_TYPES = {
    "number_of_discharges": "int",
    "excess_readmission_ratio": "double",
    "predicted_readmission_rate": "double",
    "expected_readmission_rate": "double",
    "number_of_readmissions": "int",
}
NATURAL_KEY = ["facility_id", "measure_name"]
# Patterns of well-formed numeric text, used to profile unexpected values.
NUMERIC_PATTERNS = {"number_of_discharges": "^[0-9]+$", "excess_readmission_ratio": "^[0-9.]+$"}


def bronze_hrrp(raw: DataFrame, source_file=None, source_year: int | None = None) -> DataFrame:
    """Raw rows with snake_case names and ingest metadata."""
    df = rename_columns(raw, snake_case_names(raw.columns))
    df = stamp_processed(df, "_ingested_at")
    extra = {}
    if source_file is not None:
        extra["_source_file"] = source_file if isinstance(source_file, F.Column) else F.lit(source_file)
    if source_year is not None:
        extra["_source_year"] = F.lit(source_year)
    return df.withColumns(extra) if extra else df


def silver_hrrp(bronze: DataFrame, order_by, sentinels=SUPPRESSED_VALUES,
                checked=SUPPRESSION_CHECKED, cleaned=SENTINEL_COLUMNS, types=None,
                dedupe: bool = True, lost: str | None = None) -> DataFrame:
    """Flag suppression, null the sentinels, cast, parse dates, tidy text,
    keep one row per facility and measure (the first in ``order_by``). ``lost``
    names a boolean column to add: a number or date of the row was lost."""
    df = flag_suppressed(bronze, checked, sentinels)
    df = null_sentinels(df, cleaned, sentinels)
    if lost is not None:
        gone = [F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in (types or NUMERIC_TYPES).items()]
        gone += [F.col(c).isNotNull() & parse_mixed_date(c, dtype=df.schema[c].dataType).isNull()
                 for c in ("start_date", "end_date")]
        df = df.withColumn(lost, any_of(gone))
    df = cast_columns(df, types or NUMERIC_TYPES)
    df = df.withColumns({c: parse_mixed_date(c, dtype=df.schema[c].dataType)
                         for c in ("start_date", "end_date")})
    df = trim_columns(df, ["facility_name", "measure_name"])
    df = upper_trim_columns(df, ["state"])
    if dedupe:
        df = dedupe_natural_key(df, NATURAL_KEY, order_by)
    df = stamp_processed(df, "_silver_processed_at")
    return df.withColumn("_silver_version", F.lit(1))


def reportable(silver: DataFrame) -> DataFrame:
    return silver.filter(~F.col("is_suppressed"))


def _avg(c: str, digits: int):
    return round_half_up(exact_avg(c), digits)


def _published_rank(g: DataFrame, value: str, out: str) -> DataFrame:
    """Dense rank, largest first; the published ranks are ints. The summary is stored, then ranked."""
    return dense_rank_desc(stored(g, "readmission-summary"), value, out).withColumn(out, F.col(out).cast("int"))


def gold_hospital_summary(silver: DataFrame, by_id: bool = False) -> DataFrame:
    """One row per hospital (id, name, state): conditions reported, five
    averages, national dense rank by average excess ratio, penalty flag, tier.
    With ``by_id`` hospitals are grouped by id alone, as names differ between
    files; the greatest name and state stand for them."""
    keys = ["facility_id"] if by_id else ["facility_id", "facility_name", "state"]
    names = [F.max(c).alias(c) for c in ("facility_name", "state")] if by_id else []
    g = reportable(silver).groupBy(*keys).agg(
        *names,
        F.count("measure_name").alias("conditions_reported"),
        _avg("excess_readmission_ratio", 4).alias("avg_excess_ratio"),
        _avg("predicted_readmission_rate", 4).alias("avg_predicted_rate"),
        _avg("expected_readmission_rate", 4).alias("avg_expected_rate"),
        _avg("number_of_readmissions", 0).alias("avg_readmissions"),
        _avg("number_of_discharges", 0).alias("avg_discharges"),
    )
    g = _published_rank(g, "avg_excess_ratio", "national_rank")
    g = g.withColumns({"penalty_flag": penalty_flag("avg_excess_ratio"),
                       "risk_tier": risk_tier("avg_excess_ratio")})
    return stamp_processed(g, "_gold_processed_at")


def gold_state_summary(silver: DataFrame) -> DataFrame:
    """One row per state."""
    g = reportable(silver).groupBy("state").agg(
        F.count("facility_id").alias("total_records"),
        _avg("excess_readmission_ratio", 4).alias("state_avg_excess_ratio"),
        _avg("predicted_readmission_rate", 4).alias("state_avg_predicted_rate"),
        _avg("number_of_readmissions", 0).alias("state_avg_readmissions"),
    )
    g = _published_rank(g, "state_avg_excess_ratio", "state_rank")
    g = g.withColumn("state_penalty_flag", penalty_flag("state_avg_excess_ratio"))
    return stamp_processed(g, "_gold_processed_at")


def gold_condition_summary(silver: DataFrame) -> DataFrame:
    """One row per condition."""
    g = reportable(silver).groupBy("measure_name").agg(
        F.count("facility_id").alias("hospitals_reporting"),
        _avg("excess_readmission_ratio", 4).alias("condition_avg_excess_ratio"),
        _avg("predicted_readmission_rate", 4).alias("condition_avg_predicted_rate"),
        _avg("number_of_readmissions", 0).alias("condition_avg_readmissions"),
        _avg("number_of_discharges", 0).alias("condition_avg_discharges"),
    )
    g = _published_rank(g, "condition_avg_excess_ratio", "condition_rank")
    return stamp_processed(g, "_gold_processed_at")


def suppression_summary(silver: DataFrame, digits: int = 6) -> DataFrame:
    """Rows and average excess ratio by suppression flag."""
    return silver.groupBy("is_suppressed").agg(
        F.count(F.lit(1)).alias("row_count"),
        round_half_up(exact_avg("excess_readmission_ratio"), digits).alias("avg_excess_ratio"),
    )


def top_penalised(hospitals: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` worst penalised hospitals (a top-k report; ties broken by id)."""
    return (hospitals.filter(F.col("penalty_flag"))
            .orderBy(F.col("national_rank"), F.col("facility_id"))
            .limit(k)
            .select("facility_name", "state", "avg_excess_ratio", "risk_tier", "national_rank"))
