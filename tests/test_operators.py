"""Operators on hand-made edge rows, and the range-split rank against the plain window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators.aggregate import conditional_sum_pivot, share_of_total, value_frequency
from strata.operators.clean import (
    cast_columns, cast_losses, dedupe_natural_key, duplicate_count, flag_suppressed, null_sentinels,
    snake_case_names,
)
from strata.operators.latest import latest_batch, latest_per_key
from strata.operators.movement import movement
from strata.operators.quality import (
    QualityGateError, accepted_values, dq_report, gate, not_null, profile_non_numeric, reconcile_flag,
)
from strata.operators.rank import global_rank, global_ranks, value_ranks
from tests.conftest import rows


# ---- rank --------------------------------------------------------------------
@pytest.mark.parametrize("ascending", [False, True])
@pytest.mark.parametrize("dense", [True, False])
def test_range_rank_equals_window_rank(spark, ascending, dense):
    rnd = random.Random(7)
    vals = [round(rnd.uniform(-50, 50), 1) for _ in range(400)]
    vals += [None] * 5 + [0.0] * 7 + [1e-300, -1e-300, 1e300, 3.0, 3.0, 3.0, 2.0 ** 10, 2.0 ** 10 - 1e-9]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    fn = F.dense_rank() if dense else F.rank()
    order = F.col("v").asc() if ascending else F.col("v").desc()
    want = rows(df.withColumn("r", fn.over(Window.orderBy(order))), "id", "r")
    got = rows(global_rank(df, "v", "r", ascending=ascending, dense=dense), "id", "r")
    assert got == want


@pytest.mark.parametrize("kind", ["bigint", "date", "decimal(12,3)"])
def test_range_rank_of_other_types(spark, kind):
    base = spark.range(500).select("id", (F.col("id") * 37 % 101).alias("x"))
    value = {"bigint": F.col("x") * 10 ** 15, "date": F.date_add(F.lit("2024-01-01"), F.col("x").cast("int")),
             "decimal(12,3)": (F.col("x") / 7).cast("decimal(12,3)")}[kind]
    df = base.select("id", F.when(F.col("id") % 50 != 0, value).alias("v"))
    want = rows(df.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("v").desc()))), "id", "r")
    assert rows(global_rank(df, "v", "r"), "id", "r") == want


def test_infinities_and_nan_rank_as_in_spark(spark):
    vals = [1.0, float("inf"), float("-inf"), float("nan"), None, -0.0, 0.0, 5.0] * 2
    df = spark.createDataFrame(list(enumerate(vals)), "id long, v double")
    for asc in (False, True):
        order = F.col("v").asc() if asc else F.col("v").desc()
        want = rows(df.withColumn("r", F.rank().over(Window.orderBy(order))), "id", "r")
        assert rows(global_rank(df, "v", "r", ascending=asc, dense=False), "id", "r") == want


def test_rank_of_over_a_million_groups(spark):
    n = 1_100_000
    df = spark.range(n).select(F.col("id").alias("v"))
    got = global_rank(df, "v", "r").agg(F.count_if(F.col("r") == n - F.col("v")).alias("right"), F.count("*").alias("n"))
    assert tuple(got.first()) == (n, n)


def test_ranks_in_both_directions_come_from_one_pass(spark):
    vals = [float(i * i % 97) for i in range(300)] + [None] * 4 + [5.0] * 30
    df = spark.createDataFrame(list(enumerate(vals)), "id long, v double")
    forms = {"a": (True, False), "b": (False, False), "c": (True, True), "d": (False, True)}
    want = df
    for out, (asc, dense) in forms.items():
        fn = F.dense_rank() if dense else F.rank()
        want = want.withColumn(out, fn.over(Window.orderBy(F.col("v").asc() if asc else F.col("v").desc())))
    got = global_ranks(df, "v", forms)
    assert rows(got, "id", *forms) == rows(want, "id", *forms)


def test_values_are_split_into_even_ranges_and_ranked_there(spark, tmp_path):
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for value in (F.lit(1_700_000_000) + F.col("id") * 157, F.exp(F.col("id") / 20_000)):
            df = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(value).alias("v"))
            df.write.mode("overwrite").parquet(f"{tmp_path}/v")
            out = global_rank(spark.read.parquet(f"{tmp_path}/v"), "v", "r")
            ranked = value_ranks(spark.read.parquet(f"{tmp_path}/v"), "v", {"r": (False, True)})
            ranges = ranked.groupBy((F.col("r") / 40_000).cast("int")).count()
            assert ranges.agg(F.max("count")).first()[0] <= 40_000
            out.write.format("noop").mode("overwrite").save()
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(_range" in plan       # numbered inside ranges
            assert "lambda" not in plan                    # nothing is compared with cut points, row by row
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


# ---- cleaning ------------------------------------------------------------------
SENT = ["Too Few to Report", "N/A", "Not Available", " N/A"]


def test_flag_and_null_sentinels(spark):
    data = [("1", "Too Few to Report", "0.9", "5"), ("2", " N/A", "N/A", "Not Available"),
            ("3", None, None, None), ("4", "10", "1.05", "3"), ("5", "7", "1.1", "x")]
    df = spark.createDataFrame(data, "id string, d string, r string, n string")
    flagged = flag_suppressed(df, ["d", "r", "n"], SENT)
    assert rows(flagged, "id", "is_suppressed") == [("1", True), ("2", True), ("3", False), ("4", False),
                                                     ("5", False)]
    nulled = null_sentinels(flagged, ["d", "r", "n"], SENT)
    assert rows(nulled.filter("id in ('1','2')"), "id", "d", "r", "n") == [
        ("1", None, "0.9", "5"), ("2", None, None, None)]
    typed = cast_columns(nulled, {"d": "int", "r": "double", "n": "int"})
    assert rows(typed.filter("id = '5'"), "d", "r", "n") == [(7, 1.1, None)]
    losses = cast_losses(nulled, {"d": "int", "r": "double", "n": "int"}).first()
    assert (losses.d_lost, losses.r_lost, losses.n_lost) == (0, 0, 1)


def test_snake_case_names():
    assert snake_case_names(["Number of Discharges", "Facility ID", "_source_file"]) == {
        "Number of Discharges": "number_of_discharges", "Facility ID": "facility_id",
        "_source_file": "_source_file"}


def test_dedupe_keeps_first_in_total_order_and_counts(spark):
    data = [("007", "AMI", 3, "c"), ("007", "AMI", 1, "a"), ("007", "HF", 2, "b"), (None, "HF", 5, "x"),
            (None, "HF", 4, "y")]
    df = spark.createDataFrame(data, "fid string, m string, k int, v string")
    out = dedupe_natural_key(df, ["fid", "m"], ["k"])
    assert rows(out, "v") == [("a",), ("b",), ("y",)]  # ("y", k=4) is first for the null key
    assert rows(out.filter(F.col("fid").isNotNull()), "fid", "m", "k") == [("007", "AMI", 1), ("007", "HF", 2)]
    assert duplicate_count(df, ["fid", "m"]).first()[0] == 2


# ---- movement -------------------------------------------------------------------
def test_movement_edges(spark):
    data = [("a", 1, 10.0), ("a", 2, 10.0), ("a", 3, 10.05), ("a", 5, 10.1),  # equal, +0.5 %, gap
            ("b", 1, 0.0), ("b", 2, 1.0),                                    # previous 0
            ("c", 1, 100.0), ("c", 2, 100.51)]                               # just over 0.5 %
    df = spark.createDataFrame(data, "s string, b long, p double")
    out = movement(df, key="s", order="b", value="p", previous="prev", change="chg", pct="pct")
    got = {(r.s, r.b): (r.prev, r.chg, r.pct) for r in out.collect()}
    assert got[("a", 1)] == (None, None, None)
    assert got[("a", 2)] == (10.0, 0.0, 0.0)
    assert got[("a", 3)] == (10.0, 0.05, 0.5)
    assert got[("a", 5)] == (10.05, 0.05, 0.4975)
    assert got[("b", 2)] == (0.0, 1.0, None)
    assert got[("c", 2)] == (100.0, 0.51, 0.51)


# ---- latest ----------------------------------------------------------------------
def test_latest_batch_and_per_key(spark):
    data = [("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 5.0), ("c", 2, 7.0)]   # b missing in batch 2
    df = spark.createDataFrame(data, "s string, b long, p double")
    assert rows(latest_batch(df, "b"), "s") == [("a",), ("c",)]
    assert rows(latest_per_key(df, "s", "b"), "s", "b", "p") == [("a", 2, 2.0), ("b", 1, 5.0), ("c", 2, 7.0)]


def test_latest_batch_uses_no_collect_and_prunes(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("b"), F.col("id"))
    plan = latest_batch(df, "b")._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan or "subquery" in plan


# ---- aggregates ---------------------------------------------------------------------
def test_conditional_pivot_fixed_columns_and_zero_default(spark):
    data = [(1, "wind", 10.0), (1, "wind", 5.0), (1, "gas", 20.0), (2, "solar", 1.5)]
    df = spark.createDataFrame(data, "r long, f string, p double")
    spec = [("wind_pct", F.col("f") == "wind", "p"), ("gas_pct", F.col("f") == "gas", "p"),
            ("coal_pct", F.col("f") == "coal", "p")]
    out = conditional_sum_pivot(df, ["r"], spec)
    assert out.columns == ["r", "wind_pct", "gas_pct", "coal_pct"]
    assert rows(out) == [(1, 15.0, 20.0, 0.0), (2, 0.0, 0.0, 0.0)]


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("c", 0)], "s string, m long")
    assert rows(share_of_total(df, "m", "pct"), "s", "pct") == [("a", 75.0), ("b", 25.0), ("c", 0.0)]
    zero = spark.createDataFrame([("a", 0)], "s string, m long")
    assert rows(share_of_total(zero, "m", "pct"), "pct") == [(None,)]


def test_value_frequency(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,)], "v string")
    assert rows(value_frequency(df, "v"), "v", "count") == [(None, 1), ("x", 2)]


# ---- quality ---------------------------------------------------------------------------
def test_quality_rules_nulls_and_gate(spark):
    df = spark.createDataFrame([(1, "low"), (None, "low"), (3, None), (4, "purple")], "id long, cat string")
    rules = [not_null("id"), accepted_values("cat", ["low", "high"])]
    rep = {r.rule: r.failures for r in dq_report(df, rules).collect()}
    assert rep == {"not_null_id": 1, "accepted_values_cat": 1}   # null passes accepted_values
    with pytest.raises(QualityGateError):
        gate(dq_report(df, rules))
    clean = df.filter("id is not null and cat = 'low'")
    assert gate(dq_report(clean, rules)) == []


def test_reconcile_and_profile(spark):
    df = spark.createDataFrame([("1", "0.9", True), ("Too Few to Report", "N/A", False), (None, "1.2", False)],
                               "d string, r string, f boolean")
    rec = reconcile_flag(df, "f").first()
    assert (rec.flagged, rec.unflagged, rec.total, rec.balanced) == (1, 2, 3, True)
    prof = rows(profile_non_numeric(df, {"d": "^[0-9]+$", "r": "^[0-9.]+$"}))
    assert prof == [("d", "Too Few to Report", 1), ("r", "N/A", 1)]


@pytest.mark.parametrize("width", [1, 3, 50])
def test_chunked_lag_equals_window_lag(spark, width):
    rnd = random.Random(3)
    data = [("hot", b, float(rnd.randint(1, 9))) for b in range(0, 120, 1) if rnd.random() < 0.8]
    data += [("cold", b, float(b)) for b in (5, 17, 18, 90)]
    df = spark.createDataFrame(data, "s string, b long, p double")
    plain = movement(df, key="s", order="b", value="p", previous="prev")
    chunked = movement(df, key="s", order="b", value="p", previous="prev", chunk_width=width)
    assert rows(chunked, "s", "b", "prev", "batch_price_change") == rows(plain, "s", "b", "prev",
                                                                         "batch_price_change")


@pytest.mark.parametrize("width", [None, 2])
def test_movement_same_batch_twice_uses_tiebreak(spark, width):
    # two snapshots of one coin in batch 2: the tiebreak (ingest order) decides, on every run
    data = [("a", 1, 0, 10.0), ("a", 2, 2, 12.0), ("a", 2, 1, 11.0), ("a", 3, 0, 13.0)]
    df = spark.createDataFrame(data, "s string, b long, t long, p double")
    out = movement(df, key="s", order="b", value="p", previous="prev", tiebreak="t", chunk_width=width)
    assert rows(out, "b", "t", "prev") == [(1, 0, None), (2, 1, 10.0), (2, 2, 11.0), (3, 0, 12.0)]


def test_chunked_lag_of_a_null_key(spark):
    data = [(None, b, float(b)) for b in range(10)] + [("a", 3, 1.0), ("a", 8, 2.0)]
    df = spark.createDataFrame(data, "s string, b long, p double")
    plain = movement(df, key="s", order="b", value="p", previous="prev")
    chunked = movement(df, key="s", order="b", value="p", previous="prev", chunk_width=3)
    assert rows(chunked, "s", "b", "prev") == rows(plain, "s", "b", "prev")


def test_unrounded_movement_keeps_the_value(spark):
    df = spark.createDataFrame([("a", 1, 1.25), ("a", 2, 1.3751)], "s string, b long, p double")
    out = movement(df, key="s", order="b", value="p", previous="prev", change_digits=None, pct_digits=None)
    got = rows(out, "batch_price_change", "batch_price_change_pct")[-1]
    assert got == (1.3751 - 1.25, (1.3751 - 1.25) / 1.25 * 100)


def test_first_nulls_are_counted_per_key(spark):
    from strata.operators.quality import expected_first_nulls
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0)], "k string, v double")
    assert tuple(expected_first_nulls(df, "k", "v").first()) == (2, 2, False)
    good = spark.createDataFrame([("a", None), ("a", 2.0), ("b", None)], "k string, v double")
    assert tuple(expected_first_nulls(good, "k", "v").first()) == (2, 2, True)


def test_survivors_do_not_depend_on_the_partitioning(spark):
    from strata.plans.carbon import dedupe_polls
    data = [("a", "x", 1, i * 7 % 11) for i in range(11)] + [("b", "y", None, 3), ("b", "y", 2, 9), ("c", "z", None, 4)]
    df = spark.createDataFrame(data, "k string, m string, o long, v long")
    natural, polls = set(), set()
    for n in (1, 2, 5, 11):
        part = df.repartition(n)
        natural.add(tuple(rows(dedupe_natural_key(part, ["k", "m"], ["k", "m"]))))
        polls.add(tuple(rows(dedupe_polls(part, ["k"], "o"))))
    assert natural == {(("a", "x", 1, 0), ("b", "y", None, 3), ("c", "z", None, 4))}
    assert polls == {(("a", "x", 1, 0), ("b", "y", 2, 9), ("c", "z", None, 4))}
    assert rows(dedupe_polls(df, ["k"], "o", keep="latest")) == [("a", "x", 1, 10), ("b", "y", 2, 9), ("c", "z", None, 4)]


def test_totals_beyond_bigint(spark):
    from strata.operators.aggregate import whole_total
    df = spark.createDataFrame([(1, 5 * 10 ** 18), (2, 5 * 10 ** 18)], "id long, cap long")
    assert int(df.agg(whole_total("cap")).first()[0]) == 10 ** 19
    assert rows(share_of_total(df, "cap", "share"), "id", "share") == [(1, 50.0), (2, 50.0)]


@pytest.mark.parametrize("partition", [None, "day"])
def test_latest_batch_by_partition(spark, partition):
    df = spark.createDataFrame([(1, 10, "a"), (1, 11, "b"), (2, 20, "c"), (2, 25, "d"), (2, 25, "e")], "day int, b int, v string")
    from strata.operators.latest import latest_batch
    assert rows(latest_batch(df, "b", partition), "v") == [("d",), ("e",)]
