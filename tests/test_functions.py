"""Column expressions on hand-made edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions import classify as C
from strata.functions.numeric import change_pct, round_half_up, safe_divide
from strata.functions.parse import parse_mixed_date, parse_period, parse_snapshot_time


def one(spark, expr, value, ddl):
    df = spark.createDataFrame([(value,)], ddl)
    return df.select(expr.alias("r")).first()["r"]


def test_round_half_up_is_exact_on_halves(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-42.57345,), (0.000250,), (None,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert got[:2] == [1.01, 2.68]
    assert [r[0] for r in df.select(round_half_up("x", 4)).collect()][2:] == [-42.5735, 0.0003, None]


def test_round_once_large_values_and_nan(spark):
    import math
    df = spark.createDataFrame([(1.0049999996,), (1e13 + 0.125,), (1e300,), (float("nan"),), (float("inf"),)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert got[:3] == [1.0, 1e13 + 0.13, 1e300] and math.isnan(got[3]) and got[4] == float("inf")
    same = [r[0] for r in df.select(round_half_up("x", None)).collect()]
    assert same[:3] == [1.0049999996, 1e13 + 0.125, 1e300]


def test_exact_averages(spark):
    import math

    from strata.functions.numeric import exact_avg, exact_sum
    df = spark.createDataFrame([("a", 0.1)] * 10 + [("b", 1e30), ("b", 1.0), ("c", float("nan")), ("c", 1.0), ("d", None)],
                               "k string, x double")
    got = {r.k: (r.s, r.a) for r in df.groupBy("k").agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).collect()}
    assert got["a"] == (1.0, 0.1) and got["b"] == (1e30, 5e29) and got["d"] == (None, None)
    assert math.isnan(got["c"][0]) and math.isnan(got["c"][1])


def test_safe_divide_zero_and_negative_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_divide("a", "b")).collect()] == [None, None, None, 1.5]
    got = [r[0] for r in df.select(change_pct("a", "b")).collect()]
    assert got == [None, None, None, 50.0]


def test_parse_snapshot_time_and_malformed(spark):
    ts = one(spark, parse_snapshot_time("s"), "2024-01-02T03:04:05.678Z", "s string")
    assert ts == dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    assert one(spark, parse_snapshot_time("s"), "2024-01-02T03:04:05Z", "s string") is None
    assert one(spark, parse_snapshot_time("s"), "garbage", "s string") is None


def test_parse_period_strips_z(spark):
    assert one(spark, parse_period("s"), "2024-05-01T23:30Z", "s string") == dt.datetime(2024, 5, 1, 23, 30)
    assert one(spark, parse_period("s"), "2024-05-01T23:30", "s string") == dt.datetime(2024, 5, 1, 23, 30)


def test_parse_mixed_date(spark):
    assert one(spark, parse_mixed_date("s"), "03/13/1996", "s string") == dt.date(1996, 3, 13)
    assert one(spark, parse_mixed_date("s"), "1996-03-13", "s string") == dt.date(1996, 3, 13)
    assert one(spark, parse_mixed_date("d"), dt.date(2020, 1, 2), "d date") == dt.date(2020, 1, 2)
    assert one(spark, parse_mixed_date("s"), "N/A", "s string") is None


def test_direction_and_volatility_null_paths(spark):
    df = spark.createDataFrame([(1.0, 0.5), (-0.01, 0.51), (0.0, -0.6), (None, None)], "c double, p double")
    out = df.select(C.price_direction("c").alias("d"), C.is_volatile("p").alias("v")).collect()
    assert [(r.d, r.v) for r in out] == [("UP", False), ("DOWN", True), ("FLAT", True), ("FLAT", False)]


def test_overall_direction(spark):
    df = spark.createDataFrame([(3, 1), (1, 3), (2, 2)], "u long, d long")
    assert [r[0] for r in df.select(C.overall_direction("u", "d")).collect()] == ["BULLISH", "BEARISH", "NEUTRAL"]


def test_risk_tier_and_penalty_edges(spark):
    df = spark.createDataFrame([(0.99995,), (1.0,), (1.2,), (1.19999,), (None,)], "r double")
    out = df.select(C.risk_tier("r").alias("t"), C.penalty_flag("r").alias("p")).collect()
    assert [(x.t, x.p) for x in out] == [("Low", False), ("Medium", False), ("High", True),
                                         ("Medium", True), ("Low", False)]


def test_region_type_and_label(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (14, "c"), (15, "d"), (18, "e"), (19, "f")],
                               "id long, name string")
    out = df.select(C.region_type("id").alias("t"), C.region_label("id", "name").alias("l")).collect()
    assert [(r.t, r.l) for r in out] == [
        ("aggregate", "a"), ("granular", "b"), ("granular", "c"), ("aggregate", "England"),
        ("aggregate", "GB"), ("aggregate", "f")]


def test_fuel_category(spark):
    fuels = ["wind", "solar", "hydro", "nuclear", "biomass", "gas", "coal", "imports", "other", "peat", None]
    df = spark.createDataFrame([(f,) for f in fuels], "f string")
    got = [r[0] for r in df.select(C.fuel_category("f")).collect()]
    assert got == ["renewable"] * 3 + ["low_carbon"] * 2 + ["fossil"] * 2 + ["imports"] + ["other"] * 3


def test_time_period_published_and_wrapped(spark):
    hours = [0, 6, 7, 9, 10, 16, 17, 20, 21, 22, 23]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    published = [r[0] for r in df.select(C.time_period("h")).collect()]
    assert "overnight" not in published
    assert published == ["daytime", "daytime", "morning_peak", "morning_peak", "daytime", "daytime",
                         "evening_peak", "evening_peak", "daytime", "daytime", "daytime"]
    wrapped = [r[0] for r in df.select(C.time_period("h", wrap_midnight=True)).collect()]
    assert wrapped == ["overnight", "overnight", "morning_peak", "morning_peak", "daytime", "daytime",
                       "evening_peak", "evening_peak", "daytime", "daytime", "overnight"]


def test_day_type_saturday_sunday_monday(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 6),), (dt.datetime(2024, 1, 7),), (dt.datetime(2024, 1, 8),)],
                               "t timestamp")
    got = [r[0] for r in df.select(C.day_type(F.dayofweek("t"))).collect()]
    assert got == ["weekend", "weekend", "weekday"]
