"""Physical-plan properties that matter at scale."""

from strata.plans.registry import QUERIES, load_all
from tests.conftest import SF_SMALL

load_all()


def executed(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_batch_queries_run_no_python(spark):
    for name in ["silver_prices", "gold_hospital_summary", "int_time_features", "mart_regional_comparison",
                 "dq_report", "dedupe_natural_key"]:
        plan = executed(spark, name)
        assert "Python" not in plan and "ArrowEval" not in plan, name


def test_latest_batch_is_a_scalar_subquery_not_a_collect(spark):
    plan = executed(spark, "gold_latest_prices")
    assert "Subquery" in plan


def test_scan_reads_only_needed_columns(spark):
    df = QUERIES["mart_peak_analysis"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan          # the events scan prunes the unused JSON column


def test_hospital_rank_is_range_split(spark):
    plan = executed(spark, "gold_hospital_summary")
    assert "hashpartitioning(_range" in plan
    assert "lineitem" not in plan            # the summary was stored before it is ranked


def test_row_count_reads_no_columns_it_does_not_need(spark):
    df = QUERIES["row_count"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "value" not in plan
    assert "Scan ExistingRDD" not in plan


def test_latest_filter_is_on_a_parquet_scan(spark):
    plan = executed(spark, "gold_latest_prices")
    assert "Scan parquet" in plan and "Scan ExistingRDD" not in plan


def test_newest_period_filter_reaches_both_inputs_before_pivot(spark):
    df = QUERIES["mart_generation_mix"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # one pushed-down runtime filter per input scan, below the pivot aggregate and the join
    assert plan.count("Subquery subquery") >= 2
    pivot = plan.index("partial_sum(CASE WHEN (fuel_category")
    assert "Subquery" in plan[pivot:]


def test_nation_is_the_only_forced_broadcast(spark):
    from strata.sources.testdata import hrrp_raw
    logical = hrrp_raw(spark, SF_SMALL)._jdf.queryExecution().analyzed().toString()
    assert logical.count("broadcast") <= 1


def test_price_lag_is_split_by_chunk(spark):
    import re
    plan = executed(spark, "lag_price")
    # the lag window is partitioned by (symbol, chunk), so one coin is many tasks
    assert re.search(r"hashpartitioning\(symbol#\d+L?, _chunk#\d+L?", plan)
