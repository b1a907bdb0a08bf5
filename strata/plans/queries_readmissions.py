"""Registered readmission queries (raw rows from ``lineitem`` and its dimensions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.aggregate import value_frequency
from strata.operators.clean import (
    SUPPRESSED_VALUES, cast_losses, duplicate_count, flag_suppressed, null_sentinels, rename_columns,
    snake_case_names,
)
from strata.operators.quality import profile_non_numeric, reconcile_flag
from strata.plans import readmissions as rd
from strata.plans.registry import register
from strata.plans.sqltext import mean, rnd, with_ctes
from strata.sources.testdata import hrrp_raw

ORDER = ["k1", "k2", "k3"]


def _bronze(spark, sf_dir):
    return rd.bronze_hrrp(hrrp_raw(spark, sf_dir), source_file="hrrp_raw", source_year=2024)


def _silver(spark, sf_dir):
    return rd.silver_hrrp(_bronze(spark, sf_dir), order_by=ORDER)


# ---- SQL twins --------------------------------------------------------------
S = ", ".join("'" + v.replace("'", "''") + "'" for v in SUPPRESSED_VALUES)


def _nulled(c: str) -> str:
    return f"case when {c} not in ({S}) then {c} end as {c}"


SILVER_CTES = (
    ("raw", "hrrp_raw"),
    ("f", f"""
select *, coalesce(number_of_discharges in ({S}) or excess_readmission_ratio in ({S})
                   or number_of_readmissions in ({S}), false) as is_suppressed
from raw"""),
    ("n", f"""
select facility_id, facility_name, state, measure_name, {_nulled('number_of_discharges')},
       {_nulled('excess_readmission_ratio')}, {_nulled('predicted_readmission_rate')},
       {_nulled('expected_readmission_rate')}, {_nulled('number_of_readmissions')},
       start_date, end_date, footnote, k1, k2, k3, is_suppressed
from f"""),
    ("t", """
select facility_id, trim(facility_name) as facility_name, trim(upper(state)) as state,
       trim(measure_name) as measure_name,
       try_cast(number_of_discharges as integer) as number_of_discharges,
       try_cast(excess_readmission_ratio as double) as excess_readmission_ratio,
       try_cast(predicted_readmission_rate as double) as predicted_readmission_rate,
       try_cast(expected_readmission_rate as double) as expected_readmission_rate,
       try_cast(number_of_readmissions as integer) as number_of_readmissions,
       cast(coalesce(try_strptime(cast(start_date as varchar), '%m/%d/%Y'),
                     try_strptime(cast(start_date as varchar), '%Y-%m-%d')) as date) as start_date,
       cast(coalesce(try_strptime(cast(end_date as varchar), '%m/%d/%Y'),
                     try_strptime(cast(end_date as varchar), '%Y-%m-%d')) as date) as end_date,
       footnote, k1, k2, k3, is_suppressed
from n"""),
    ("silver", """
select * exclude (rn), 1 as _silver_version from (
  select *, row_number() over (partition by facility_id, measure_name order by k1, k2, k3) as rn from t) x
where rn = 1"""),
)

HOSPITAL_CTE = ("h", f"""
select facility_id, facility_name, state, count(measure_name) as conditions_reported,
       {rnd(mean('excess_readmission_ratio'), 4)} as avg_excess_ratio,
       {rnd(mean('predicted_readmission_rate'), 4)} as avg_predicted_rate,
       {rnd(mean('expected_readmission_rate'), 4)} as avg_expected_rate,
       {rnd(mean('number_of_readmissions'), 0)} as avg_readmissions,
       {rnd(mean('number_of_discharges'), 0)} as avg_discharges
from silver where not is_suppressed group by facility_id, facility_name, state""")

HOSPITAL_SQL = """
select *, cast(dense_rank() over (order by avg_excess_ratio desc nulls last) as integer) as national_rank,
       coalesce(avg_excess_ratio > 1.0, false) as penalty_flag,
       case when avg_excess_ratio >= 1.2 then 'High' when avg_excess_ratio >= 1.0 then 'Medium'
            else 'Low' end as risk_tier
from h"""


@register("bronze_hrrp", with_ctes(("raw", "hrrp_raw"), select="""
select *, 'hrrp_raw' as _source_file, 2024 as _source_year from raw"""))
def q_bronze_hrrp(spark, sf_dir):
    """Raw rows, snake_case names, ingest metadata."""
    return _bronze(spark, sf_dir)


@register("rename_columns", with_ctes(("raw", "hrrp_raw"), select="""
select facility_name, facility_id, state, measure_name, number_of_discharges, footnote,
       excess_readmission_ratio, predicted_readmission_rate, expected_readmission_rate,
       number_of_readmissions, start_date, end_date from raw"""))
def q_rename_columns(spark, sf_dir):
    """Published header names (with spaces) renamed to snake_case in one projection."""
    raw = hrrp_raw(spark, sf_dir)
    to_header = {snake_case_names([h])[h]: h for h in rd.RAW_HEADER}
    published = raw.select(*[F.col(c).alias(h) for c, h in to_header.items()])
    return rename_columns(published, snake_case_names(published.columns))


@register("suppression_flag", with_ctes(*SILVER_CTES[:2], select="""
select k1, k2, k3, is_suppressed from f"""))
def q_suppression_flag(spark, sf_dir):
    df = flag_suppressed(hrrp_raw(spark, sf_dir), rd.SUPPRESSION_CHECKED)
    return df.select("k1", "k2", "k3", "is_suppressed")


@register("null_sentinels", with_ctes(*SILVER_CTES[:3], select="""
select k1, k2, k3, number_of_discharges, excess_readmission_ratio, predicted_readmission_rate,
       expected_readmission_rate, number_of_readmissions from n"""))
def q_null_sentinels(spark, sf_dir):
    df = null_sentinels(hrrp_raw(spark, sf_dir), rd.SENTINEL_COLUMNS)
    return df.select("k1", "k2", "k3", *rd.SENTINEL_COLUMNS)


@register("cast_after_null", with_ctes(*SILVER_CTES[:3], select="""
select count(*) filter (where number_of_discharges is not null
                        and try_cast(number_of_discharges as integer) is null) as number_of_discharges_lost,
       count(*) filter (where excess_readmission_ratio is not null
                        and try_cast(excess_readmission_ratio as double) is null) as excess_readmission_ratio_lost,
       count(*) filter (where predicted_readmission_rate is not null
                        and try_cast(predicted_readmission_rate as double) is null) as predicted_readmission_rate_lost,
       count(*) filter (where expected_readmission_rate is not null
                        and try_cast(expected_readmission_rate as double) is null) as expected_readmission_rate_lost,
       count(*) filter (where number_of_readmissions is not null
                        and try_cast(number_of_readmissions as integer) is null) as number_of_readmissions_lost
from n"""))
def q_cast_after_null(spark, sf_dir):
    """Values a cast would lose once sentinels are nulled (all zero when clean)."""
    df = null_sentinels(hrrp_raw(spark, sf_dir), rd.SENTINEL_COLUMNS)
    return cast_losses(df, rd.NUMERIC_TYPES)


@register("parse_mixed_date", with_ctes(*SILVER_CTES[:4], select="select k1, k2, k3, start_date, end_date from t"))
def q_parse_mixed_date(spark, sf_dir):
    return _silver_nodedupe(spark, sf_dir).select("k1", "k2", "k3", "start_date", "end_date")


@register("clean_strings", with_ctes(*SILVER_CTES[:4], select="""
select k1, k2, k3, facility_name, state, measure_name from t"""))
def q_clean_strings(spark, sf_dir):
    return _silver_nodedupe(spark, sf_dir).select("k1", "k2", "k3", "facility_name", "state", "measure_name")


def _silver_nodedupe(spark, sf_dir):
    return rd.silver_hrrp(_bronze(spark, sf_dir), order_by=ORDER, dedupe=False)


@register("silver_hrrp", with_ctes(*SILVER_CTES, select="select * from silver"))
def q_silver_hrrp(spark, sf_dir):
    """Clean rows: flag, nulls, types, dates, text, one row per facility and measure."""
    return _silver(spark, sf_dir).drop("_source_file", "_source_year")


@register("dedupe_natural_key", with_ctes(*SILVER_CTES, select="""
select facility_id, measure_name, k1, k2, k3 from silver"""))
def q_dedupe_natural_key(spark, sf_dir):
    return _silver(spark, sf_dir).select("facility_id", "measure_name", "k1", "k2", "k3")


@register("duplicate_count", with_ctes(*SILVER_CTES[:4], select="""
select count(*) - (select count(*) from (select distinct facility_id, measure_name from t) d)
       as duplicates_removed from t"""))
def q_duplicate_count(spark, sf_dir):
    return duplicate_count(_silver_nodedupe(spark, sf_dir), rd.NATURAL_KEY)


@register("reportable_hrrp", with_ctes(*SILVER_CTES, select="""
select facility_id, measure_name, excess_readmission_ratio from silver where not is_suppressed"""))
def q_reportable_hrrp(spark, sf_dir):
    return rd.reportable(_silver(spark, sf_dir)).select("facility_id", "measure_name", "excess_readmission_ratio")


@register("reconcile_suppressed", with_ctes(*SILVER_CTES[:2], select="""
select count(*) filter (where is_suppressed) as flagged, count(*) filter (where not is_suppressed) as unflagged,
       count(*) as total,
       count(*) filter (where is_suppressed) + count(*) filter (where not is_suppressed) = count(*) as balanced
from f"""))
def q_reconcile_suppressed(spark, sf_dir):
    return reconcile_flag(flag_suppressed(hrrp_raw(spark, sf_dir), rd.SUPPRESSION_CHECKED), "is_suppressed")


@register("suppression_summary", with_ctes(*SILVER_CTES, select=f"""
select is_suppressed, count(*) as row_count, {rnd(mean('excess_readmission_ratio'), 6)} as avg_excess_ratio
from silver group by is_suppressed"""))
def q_suppression_summary(spark, sf_dir):
    return rd.suppression_summary(_silver(spark, sf_dir))


@register("profile_non_numeric", with_ctes(("raw", "hrrp_raw"), select="""
select column_name, value, count(*) as count from (
  select 'number_of_discharges' as column_name, number_of_discharges as value from raw
  where not regexp_matches(number_of_discharges, '^[0-9]+$')
  union all
  select 'excess_readmission_ratio', excess_readmission_ratio from raw
  where not regexp_matches(excess_readmission_ratio, '^[0-9.]+$')) x
group by column_name, value"""))
def q_profile_non_numeric(spark, sf_dir):
    """Unexpected text in numeric columns, with counts (all columns in one pass)."""
    return profile_non_numeric(hrrp_raw(spark, sf_dir), rd.NUMERIC_PATTERNS)


@register("value_frequency", with_ctes(("raw", "hrrp_raw"), select="""
select number_of_discharges, count(*) as count from raw group by number_of_discharges"""))
def q_value_frequency(spark, sf_dir):
    return value_frequency(hrrp_raw(spark, sf_dir), "number_of_discharges")


@register("gold_hospital_summary", with_ctes(*SILVER_CTES, HOSPITAL_CTE, select=HOSPITAL_SQL))
def q_gold_hospital_summary(spark, sf_dir):
    """Per hospital: averages, range-split national dense rank, penalty flag, risk tier."""
    return rd.gold_hospital_summary(_silver(spark, sf_dir))


@register("dense_rank_desc", with_ctes(*SILVER_CTES, HOSPITAL_CTE, select="""
select facility_id, facility_name, state, avg_excess_ratio,
       cast(dense_rank() over (order by avg_excess_ratio desc nulls last) as integer) as national_rank
from h"""))
def q_dense_rank_desc(spark, sf_dir):
    """The plain single-partition dense rank on the same input (for comparison)."""
    g = rd.gold_hospital_summary(_silver(spark, sf_dir))
    return g.select("facility_id", "facility_name", "state", "avg_excess_ratio", "national_rank")


@register("risk_tier", with_ctes(*SILVER_CTES, HOSPITAL_CTE, select="""
select facility_id, facility_name, state, avg_excess_ratio,
       case when avg_excess_ratio >= 1.2 then 'High' when avg_excess_ratio >= 1.0 then 'Medium'
            else 'Low' end as risk_tier from h"""))
def q_risk_tier(spark, sf_dir):
    g = rd.gold_hospital_summary(_silver(spark, sf_dir))
    return g.select("facility_id", "facility_name", "state", "avg_excess_ratio", "risk_tier")


@register("penalty_flag", with_ctes(*SILVER_CTES, HOSPITAL_CTE, select="""
select facility_id, facility_name, state, avg_excess_ratio,
       coalesce(avg_excess_ratio > 1.0, false) as penalty_flag from h"""))
def q_penalty_flag(spark, sf_dir):
    g = rd.gold_hospital_summary(_silver(spark, sf_dir))
    return g.select("facility_id", "facility_name", "state", "avg_excess_ratio", "penalty_flag")


@register("gold_state_summary", with_ctes(*SILVER_CTES, select=f"""
select *, cast(dense_rank() over (order by state_avg_excess_ratio desc nulls last) as integer) as state_rank,
       coalesce(state_avg_excess_ratio > 1.0, false) as state_penalty_flag
from (select state, count(facility_id) as total_records,
             {rnd(mean('excess_readmission_ratio'), 4)} as state_avg_excess_ratio,
             {rnd(mean('predicted_readmission_rate'), 4)} as state_avg_predicted_rate,
             {rnd(mean('number_of_readmissions'), 0)} as state_avg_readmissions
      from silver where not is_suppressed group by state) s"""))
def q_gold_state_summary(spark, sf_dir):
    return rd.gold_state_summary(_silver(spark, sf_dir))


@register("gold_condition_summary", with_ctes(*SILVER_CTES, select=f"""
select *, cast(dense_rank() over (order by condition_avg_excess_ratio desc nulls last) as integer)
          as condition_rank
from (select measure_name, count(facility_id) as hospitals_reporting,
             {rnd(mean('excess_readmission_ratio'), 4)} as condition_avg_excess_ratio,
             {rnd(mean('predicted_readmission_rate'), 4)} as condition_avg_predicted_rate,
             {rnd(mean('number_of_readmissions'), 0)} as condition_avg_readmissions,
             {rnd(mean('number_of_discharges'), 0)} as condition_avg_discharges
      from silver where not is_suppressed group by measure_name) s"""))
def q_gold_condition_summary(spark, sf_dir):
    return rd.gold_condition_summary(_silver(spark, sf_dir))


@register("top3_penalised", with_ctes(*SILVER_CTES, HOSPITAL_CTE, ("g", HOSPITAL_SQL), select="""
select facility_name, state, avg_excess_ratio, risk_tier, national_rank from g
where penalty_flag order by national_rank, facility_id limit 3"""))
def q_top3_penalised(spark, sf_dir):
    """Top-k report: the three worst penalised hospitals (ties broken by id)."""
    return rd.top_penalised(rd.gold_hospital_summary(_silver(spark, sf_dir)), 3)
