"""Registered carbon-intensity queries (raw polls from ``events``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import classify as cl
from strata.operators.quality import Watch, dq_counts, dq_report
from strata.plans import carbon as cb
from strata.plans.registry import ORACLE_SQL, register
from strata.plans.sqltext import exact_sum, mean, rnd, with_ctes
from strata.sources.documents import (
    carbon_documents_from_rows, flatten_generation_mix, flatten_regional_intensity,
)
from strata.sources.files import scratch_path
from strata.sources.testdata import generation_raw, intensity_raw


def _stg_i(spark, sf_dir):
    return cb.stg_carbon_intensity(intensity_raw(spark, sf_dir))


def _stg_g(spark, sf_dir):
    return cb.stg_generation_mix(generation_raw(spark, sf_dir))


def _metrics(spark, sf_dir):
    return cb.int_regional_metrics(_stg_i(spark, sf_dir), _stg_g(spark, sf_dir))


def _features(spark, sf_dir, wrap_midnight=False):
    return cb.int_time_features(_metrics(spark, sf_dir), wrap_midnight=wrap_midnight)


# ---- SQL twins --------------------------------------------------------------
# A derivation of its own: the rules become small value tables (from the marked
# constants of functions.classify) that are joined, shares are grouped into long
# rows and then spread, averages come from sums and counts, the most common
# label from ranked counts.
def _values(name: str, columns: str, rows) -> str:
    listed = ", ".join("(" + ", ".join("null" if v is None else repr(v) for v in r) + ")" for r in rows)
    return f"(values {listed}) {name}({columns})"


def _period(c: str) -> str:
    return f"try_cast(concat(replace(rtrim({c}, 'Z'), 'T', ' '), ':00') as timestamp) as {c}"


def _hour_rows(wrap: bool) -> list[tuple[int, str]]:
    """Every hour of the day with its label, counted out from the bounds."""
    rows = []
    for hour in range(24):
        found = cl.TIME_PERIOD_DEFAULT
        for label, lo, hi in reversed(cl.TIME_PERIODS):
            hours = [*range(lo, hi + 1)] if lo <= hi else [*range(lo, 24), *range(hi + 1)] if wrap else []
            found = label if hour in hours else found
        rows.append((hour, found))
    return rows


REGION_ROWS = [(i, "granular", None) for i in range(cl.GRANULAR_REGION_RANGE[0], cl.GRANULAR_REGION_RANGE[1] + 1)] + [
    (i, "aggregate", label) for i, label in cl.REGION_LABELS.items()]
FUEL_ROWS = [(fuel, label) for label, fuels in cl.FUEL_CATEGORIES for fuel in fuels]
DAY_ROWS = [(d, "weekend" if d in cl.WEEKEND_DAYS else "weekday") for d in range(1, 8)]

STG_I = ("stg_i", f"""
select raw.region_id, raw.short_name as region_name, raw.dno_region, {_period('period_from')}, {_period('period_to')},
       raw.intensity_forecast as carbon_intensity_gco2_kwh, raw.intensity_index as intensity_category,
       coalesce(rule.kind, 'aggregate') as region_type, coalesce(rule.own_label, raw.short_name) as region_label, batch_id
from intensity_raw raw left join {_values('rule', 'id, kind, own_label', REGION_ROWS)} on rule.id = raw.region_id""")
STG_G = ("stg_g", f"""
select raw.region_id, raw.short_name as region_name, raw.fuel_type, raw.percentage as generation_pct, batch_id,
       coalesce(rule.category, '{cl.FUEL_CATEGORY_DEFAULT}') as fuel_category,
       {_period('period_from')}, {_period('period_to')}
from generation_raw raw left join {_values('rule', 'fuel, category', FUEL_ROWS)} on rule.fuel = raw.fuel_type""")
PIV = ("piv", f"""
select region_id, period_from, {", ".join(
    f"coalesce(max(total) filter (where measure = '{n}'), 0) as {n}" for n in cb.METRIC_COLUMNS)}
from (
  select g.region_id, g.period_from, m.measure, {exact_sum('g.generation_pct')} as total
  from stg_g g left join {_values('m', 'measure, kind, value', cb.PIVOT_SPEC)}
       on m.value = case m.kind when 'fuel_type' then g.fuel_type else g.fuel_category end
  group by 1, 2, 3) long
group by region_id, period_from""")
METRICS = ("metrics", f"""
select i.* exclude (dno_region, batch_id), piv.* exclude (region_id, period_from),
       {rnd('piv.renewable_pct + piv.low_carbon_pct', 2)} as clean_energy_pct
from stg_i i left join piv using (region_id, period_from)""")


def _features_cte(wrap: bool = False):
    return ("features", f"""
select m.*, h.hour as hour_of_day, d.day as day_of_week, cast(date_part('day', period_from) as integer) as day_of_month,
       cast(date_part('month', period_from) as integer) as month_of_year, h.label as time_period, d.label as day_type
from metrics m
     left join {_values('h', 'hour, label', _hour_rows(wrap))} on h.hour = date_part('hour', period_from)
     left join {_values('d', 'day, label', DAY_ROWS)} on d.day = date_part('isodow', period_from) % 7 + 1""")


BASE = (("intensity_raw", "intensity_raw"), ("generation_raw", "generation_raw"), STG_I, STG_G, PIV, METRICS)
FEATURES = BASE + (_features_cte(False),)
GRANULAR = ("granular", "select * from features where region_type = 'granular'")
AVERAGED = {"avg_intensity": "carbon_intensity_gco2_kwh", **{f"avg_{c}": c for c in (
    "clean_energy_pct", "renewable_pct", "wind_pct", "solar_pct", "nuclear_pct", "gas_pct")}}
SUMMARY = ("summary", f"""
with label_counts as (
  select region_id, intensity_category, row_number() over (
           partition by region_id order by count(*) desc, intensity_category) as place
  from granular where intensity_category is not null group by region_id, intensity_category
), grouped as (
  select region_id, region_name, region_label, count(distinct period_from) as data_points,
         {rnd('min(carbon_intensity_gco2_kwh)', 2)} as min_intensity,
         {rnd('max(carbon_intensity_gco2_kwh)', 2)} as max_intensity,
         {", ".join(f"{rnd(mean(c), 2)} as {n}" for n, c in AVERAGED.items())}
  from granular group by all
)
select grouped.*, label_counts.intensity_category as most_common_category
from grouped left join label_counts on label_counts.region_id = grouped.region_id and place = 1""")


@register("stg_carbon_intensity", with_ctes(("intensity_raw", "intensity_raw"), STG_I, select="select * from stg_i"))
def q_stg_carbon_intensity(spark, sf_dir):
    return _stg_i(spark, sf_dir)


@register("stg_generation_mix", with_ctes(("generation_raw", "generation_raw"), STG_G, select="select * from stg_g"))
def q_stg_generation_mix(spark, sf_dir):
    return _stg_g(spark, sf_dir)


@register("parse_period", with_ctes(("intensity_raw", "intensity_raw"), select=f"""
select region_id, period_from as period_from_text, {_period('period_from')}, {_period('period_to')}
from intensity_raw"""))
def q_parse_period(spark, sf_dir):
    from strata.functions.parse import parse_period
    raw = intensity_raw(spark, sf_dir)
    return raw.select("region_id", F.col("period_from").alias("period_from_text"),
                      parse_period("period_from").alias("period_from"), parse_period("period_to").alias("period_to"))


@register("region_type", with_ctes(("intensity_raw", "intensity_raw"), STG_I, select="""
select region_type, count(*) as count from stg_i group by region_type"""))
def q_region_type(spark, sf_dir):
    return _stg_i(spark, sf_dir).groupBy("region_type").agg(F.count(F.lit(1)).alias("count"))


@register("region_label", with_ctes(("intensity_raw", "intensity_raw"), STG_I, select="""
select distinct region_id, region_name, region_label from stg_i"""))
def q_region_label(spark, sf_dir):
    return _stg_i(spark, sf_dir).select("region_id", "region_name", "region_label").distinct()


@register("fuel_category", with_ctes(("generation_raw", "generation_raw"), STG_G, select="""
select fuel_type, fuel_category, count(*) as count from stg_g group by fuel_type, fuel_category"""))
def q_fuel_category(spark, sf_dir):
    return _stg_g(spark, sf_dir).groupBy("fuel_type", "fuel_category").agg(F.count(F.lit(1)).alias("count"))


@register("pivot_generation", with_ctes(("generation_raw", "generation_raw"), STG_G, PIV, select="select * from piv"))
def q_pivot_generation(spark, sf_dir):
    """Nine fixed fuel columns per region and period in one aggregate pass."""
    return cb.pivot_generation(_stg_g(spark, sf_dir))


@register("int_regional_metrics", with_ctes(*BASE, select="select * from metrics"))
def q_int_regional_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


@register("int_time_features", with_ctes(*FEATURES, select="select * from features"))
def q_int_time_features(spark, sf_dir):
    return _features(spark, sf_dir)


@register("calendar_parts", with_ctes(*FEATURES, select="""
select region_id, period_from, hour_of_day, day_of_week, day_of_month, month_of_year from features"""))
def q_calendar_parts(spark, sf_dir):
    return _features(spark, sf_dir).select("region_id", "period_from", "hour_of_day", "day_of_week",
                                           "day_of_month", "month_of_year")


@register("time_period", with_ctes(*FEATURES, select="""
select hour_of_day, time_period, count(*) as count from features group by hour_of_day, time_period"""))
def q_time_period(spark, sf_dir):
    """As published: the 23..6 range is empty, so 'overnight' never appears."""
    return (_features(spark, sf_dir).groupBy("hour_of_day", "time_period")
            .agg(F.count(F.lit(1)).alias("count")))


@register("time_period_wrapped", with_ctes(*(BASE + (_features_cte(True),)), select="""
select hour_of_day, time_period, count(*) as count from features group by hour_of_day, time_period"""))
def q_time_period_wrapped(spark, sf_dir):
    """The documented intent: 23..6 wraps midnight."""
    return (_features(spark, sf_dir, wrap_midnight=True).groupBy("hour_of_day", "time_period")
            .agg(F.count(F.lit(1)).alias("count")))


@register("day_type", with_ctes(*FEATURES, select="""
select day_of_week, day_type, count(*) as count from features group by day_of_week, day_type"""))
def q_day_type(spark, sf_dir):
    return _features(spark, sf_dir).groupBy("day_of_week", "day_type").agg(F.count(F.lit(1)).alias("count"))


@register("filter_eq", with_ctes(*FEATURES, select="""
select region_id, period_from, carbon_intensity_gco2_kwh from features where region_type = 'granular'"""))
def q_filter_eq(spark, sf_dir):
    f = _features(spark, sf_dir)
    return f.filter(F.col("region_type") == "granular").select("region_id", "period_from",
                                                               "carbon_intensity_gco2_kwh")


@register("mart_carbon_intensity", with_ctes(*FEATURES, GRANULAR, select="""
select region_id, region_name, region_label, carbon_intensity_gco2_kwh, intensity_category, clean_energy_pct,
       renewable_pct, low_carbon_pct, fossil_pct, imports_pct, wind_pct, solar_pct, nuclear_pct, gas_pct,
       coal_pct, period_from, period_to, hour_of_day, day_of_week, day_type, time_period, month_of_year
from granular"""))
def q_mart_carbon_intensity(spark, sf_dir):
    return cb.mart_carbon_intensity(_features(spark, sf_dir))


@register("mart_generation_mix", with_ctes(*FEATURES, GRANULAR, select="""
select region_id, region_name, region_label, wind_pct, solar_pct, nuclear_pct, gas_pct, coal_pct,
       renewable_pct, low_carbon_pct, fossil_pct, imports_pct, clean_energy_pct, carbon_intensity_gco2_kwh,
       intensity_category, period_from
from granular where period_from = (select max(period_from) from granular)"""))
def q_mart_generation_mix(spark, sf_dir):
    return cb.mart_generation_mix(_features(spark, sf_dir))


@register("latest_period", with_ctes(("generation_raw", "generation_raw"), STG_G, select="""
select region_id, fuel_type, generation_pct, period_from from stg_g
where period_from = (select max(period_from) from stg_g)"""))
def q_latest_period(spark, sf_dir):
    """Rows of the newest period (max as a scalar subquery, no collect)."""
    from strata.operators.latest import latest_batch
    g = _stg_g(spark, sf_dir).select("region_id", "fuel_type", "generation_pct", "period_from")
    return latest_batch(g, "period_from")


@register("mart_peak_analysis", with_ctes(*FEATURES, GRANULAR, select=f"""
select region_name, region_label, time_period, day_type,
       {rnd(mean('carbon_intensity_gco2_kwh'), 2)} as avg_intensity,
       {rnd(mean('renewable_pct'), 2)} as avg_renewable_pct,
       {rnd(mean('fossil_pct'), 2)} as avg_fossil_pct,
       count(*) as observations
from granular group by region_name, region_label, time_period, day_type"""))
def q_mart_peak_analysis(spark, sf_dir):
    return cb.mart_peak_analysis(_features(spark, sf_dir))


@register("mart_regional_comparison", with_ctes(*FEATURES, GRANULAR, SUMMARY, select="""
select *, cast(rank() over (order by avg_intensity asc nulls first) as integer) as cleanest_rank,
       cast(rank() over (order by avg_intensity desc nulls last) as integer) as dirtiest_rank
from summary"""))
def q_mart_regional_comparison(spark, sf_dir):
    return cb.mart_regional_comparison(_features(spark, sf_dir))


@register("rank_both_ways", with_ctes(*FEATURES, GRANULAR, SUMMARY, select="""
select region_id, avg_intensity,
       cast(rank() over (order by avg_intensity asc nulls first) as integer) as cleanest_rank,
       cast(rank() over (order by avg_intensity desc nulls last) as integer) as dirtiest_rank
from summary"""))
def q_rank_both_ways(spark, sf_dir):
    """Rank ascending and descending."""
    return cb.rank_both_ways(cb.regional_summary(_features(spark, sf_dir)).select("region_id", "avg_intensity"))


@register("distinct_periods", with_ctes(*FEATURES, GRANULAR, select="""
select region_id, count(distinct period_from) as data_points from granular group by region_id"""))
def q_distinct_periods(spark, sf_dir):
    f = cb.granular_only(_features(spark, sf_dir))
    return f.groupBy("region_id").agg(F.countDistinct("period_from").alias("data_points"))


@register("most_common_category", with_ctes(*FEATURES, GRANULAR, select="""
select region_id, mode() within group (order by intensity_category) as most_common_category
from granular group by region_id"""))
def q_most_common_category(spark, sf_dir):
    from strata.operators.aggregate import most_common
    f = cb.granular_only(_features(spark, sf_dir))
    return f.groupBy("region_id").agg(most_common("intensity_category").alias("most_common_category"))


_DQ_I = f"""
select count(*) filter (where region_id is null) as not_null_region_id,
       count(*) filter (where carbon_intensity_gco2_kwh is null) as not_null_carbon_intensity_gco2_kwh,
       count(*) filter (where intensity_category is null) as not_null_intensity_category,
       count(*) filter (where intensity_category is not null and intensity_category not in
                        ({", ".join(repr(v) for v in cb.INTENSITY_LABELS)})) as accepted_values_intensity_category,
       count(*) filter (where region_type is not null and region_type not in
                        ({", ".join(repr(v) for v in cb.REGION_TYPES)})) as accepted_values_region_type
from stg_i"""
_DQ_G = f"""
select count(*) filter (where region_id is null) as not_null_region_id,
       count(*) filter (where fuel_type is null) as not_null_fuel_type,
       count(*) filter (where fuel_type is not null and fuel_type not in
                        ({", ".join(repr(v) for v in cb.FUELS)})) as accepted_values_fuel_type,
       count(*) filter (where generation_pct is null) as not_null_generation_pct,
       count(*) filter (where fuel_category is not null and fuel_category not in
                        ({", ".join(repr(v) for v in cb.FUEL_CATEGORY_LABELS)})) as accepted_values_fuel_category
from stg_g"""


@register("dq_not_null", with_ctes(("intensity_raw", "intensity_raw"), STG_I, select=f"""
select not_null_region_id, not_null_carbon_intensity_gco2_kwh, not_null_intensity_category from ({_DQ_I}) x"""))
def q_dq_not_null(spark, sf_dir):
    rules = [r for r in cb.INTENSITY_RULES if r.kind == "not_null"]
    return dq_counts(_stg_i(spark, sf_dir), rules)


@register("dq_accepted_values", with_ctes(("generation_raw", "generation_raw"), STG_G, select=f"""
select accepted_values_fuel_type, accepted_values_fuel_category from ({_DQ_G}) x"""))
def q_dq_accepted_values(spark, sf_dir):
    rules = [r for r in cb.GENERATION_RULES if r.kind == "accepted_values"]
    return dq_counts(_stg_g(spark, sf_dir), rules)


@register("dq_report", with_ctes(("intensity_raw", "intensity_raw"), ("generation_raw", "generation_raw"),
                                 STG_I, STG_G, ("di", _DQ_I), ("dg", _DQ_G), select="""
select 'stg_carbon_intensity' as "table", rule, failures from (unpivot di on columns(*) into name rule value failures)
union all
select 'stg_generation_mix' as "table", rule, failures from (unpivot dg on columns(*) into name rule value failures)"""))
def q_dq_report(spark, sf_dir):
    """All ten staging rules, one aggregate pass per table, as (table, rule, failures)."""
    a = dq_report(_stg_i(spark, sf_dir), cb.INTENSITY_RULES, table="stg_carbon_intensity")
    b = dq_report(_stg_g(spark, sf_dir), cb.GENERATION_RULES, table="stg_generation_mix")
    return a.unionByName(b)


@register("dq_observed", ORACLE_SQL["dq_report"])
def q_dq_observed(spark, sf_dir):
    """The ten staging rules, counted while the two tables are written (no scan of their own)."""
    reports = []
    for name, df, rules in (("stg_carbon_intensity", _stg_i(spark, sf_dir), cb.INTENSITY_RULES),
                            ("stg_generation_mix", _stg_g(spark, sf_dir), cb.GENERATION_RULES)):
        watch = Watch(rules)
        watch.on(df).write.parquet(scratch_path(spark, name))
        reports.append(watch.report(spark, name))
    return reports[0].unionByName(reports[1])


@register("dedupe_polls", with_ctes(("generation_raw", "generation_raw"), STG_G, select="""
select * exclude (rn) from (
  select *, row_number() over (partition by region_id, fuel_type, period_from order by batch_id) as rn
  from stg_g) x where rn = 1"""))
def q_dedupe_polls(spark, sf_dir):
    """Keep the first poll of each region, fuel and period."""
    return cb.dedupe_polls(_stg_g(spark, sf_dir), ["region_id", "fuel_type", "period_from"])


@register("flatten_regional_intensity", with_ctes(("intensity_raw", "intensity_raw"), select="""
select region_id, short_name, dno_region, intensity_forecast, intensity_index, period_from, period_to, batch_id
from intensity_raw"""))
def q_flatten_regional_intensity(spark, sf_dir):
    """Nested documents (built and serialised to JSON text by Spark) parsed and
    flattened back to one row per region and period."""
    docs = carbon_documents_from_rows(intensity_raw(spark, sf_dir), generation=None)
    return flatten_regional_intensity(docs).drop("_ingested_at")


@register("flatten_generation_mix", with_ctes(("generation_raw", "generation_raw"), select="""
select region_id, short_name, fuel_type, percentage, period_from, period_to, batch_id from generation_raw"""))
def q_flatten_generation_mix(spark, sf_dir):
    """Nested documents parsed and flattened to one row per region, fuel and period."""
    docs = carbon_documents_from_rows(None, generation=generation_raw(spark, sf_dir))
    return flatten_generation_mix(docs).drop("_ingested_at")
