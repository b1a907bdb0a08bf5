"""Composite tables on hand-made edge rows (carbon polls, readmissions, prices)."""

import datetime as dt

from pyspark.sql import functions as F

from strata.plans import carbon as cb
from strata.plans import markets as mk
from strata.plans import readmissions as rd
from tests.conftest import rows

I_COLS = ("region_id long, short_name string, dno_region string, intensity_forecast double, "
          "intensity_index string, period_from string, period_to string, batch_id long, _ingested_at timestamp")
G_COLS = ("region_id long, short_name string, fuel_type string, percentage double, period_from string, "
          "period_to string, batch_id long, _ingested_at timestamp")
NOW = dt.datetime(2024, 1, 1)


def test_carbon_chain_edges(spark):
    # Saturday 2024-01-06 07:00, Sunday 23:00, Monday 10:00; regions 1, 14, 15, 18, 19, 0
    i = [(1, "North", "D1", 50.0, "moderate", "2024-01-06T07:00Z", "2024-01-06T07:30Z", 1, NOW),
         (14, "South", "D14", 10.0, "very low", "2024-01-07T23:00Z", "2024-01-07T23:30Z", 1, NOW),
         (15, "Eng", "D15", 100.0, "high", "2024-01-08T10:00Z", "2024-01-08T10:30Z", 1, NOW),
         (18, "All", "D18", 90.0, "high", "2024-01-08T10:00Z", "2024-01-08T10:30Z", 1, NOW),
         (19, "Odd", "D19", 5.0, "very low", "2024-01-08T10:00Z", "2024-01-08T10:30Z", 1, NOW),
         (0, "Zero", "D0", 5.0, "very low", "2024-01-08T10:00Z", "2024-01-08T10:30Z", 1, NOW)]
    g = [(1, "North", "wind", 30.0, "2024-01-06T07:00Z", "2024-01-06T07:30Z", 1, NOW),
         (1, "North", "nuclear", 20.0, "2024-01-06T07:00Z", "2024-01-06T07:30Z", 1, NOW),
         (1, "North", "gas", 40.0, "2024-01-06T07:00Z", "2024-01-06T07:30Z", 1, NOW),
         (1, "North", "peat", 10.0, "2024-01-06T07:00Z", "2024-01-06T07:30Z", 1, NOW),   # unknown fuel
         (1, "North", "wind", 30.0, "2024-01-06T07:00Z", "2024-01-06T07:30Z", 2, NOW)]   # polled twice
    si = cb.stg_carbon_intensity(spark.createDataFrame(i, I_COLS))
    sg = cb.stg_generation_mix(spark.createDataFrame(g, G_COLS))
    labels = {r.region_id: (r.region_type, r.region_label) for r in si.collect()}
    assert labels[1] == ("granular", "North") and labels[14] == ("granular", "South")
    assert labels[15] == ("aggregate", "England") and labels[18] == ("aggregate", "GB")
    assert labels[19] == ("aggregate", "Odd") and labels[0] == ("aggregate", "Zero")

    # As published, the second poll doubles wind; dedupe_polls in front restores it.
    m = cb.int_regional_metrics(si, sg)
    r1 = m.filter("region_id = 1").first()
    assert (r1.wind_pct, r1.renewable_pct, r1.low_carbon_pct, r1.fossil_pct, r1.clean_energy_pct) == \
        (60.0, 60.0, 20.0, 40.0, 80.0)
    deduped = cb.dedupe_polls(sg, ["region_id", "fuel_type", "period_from"])
    r1 = cb.int_regional_metrics(si, deduped).filter("region_id = 1").first()
    assert (r1.wind_pct, r1.clean_energy_pct) == (30.0, 50.0)
    # a region without generation rows keeps its intensity row, with null metrics
    r14 = m.filter("region_id = 14").first()
    assert r14.renewable_pct is None and r14.clean_energy_pct is None
    assert m.count() == si.count()

    f = cb.int_time_features(m)
    tf = {r.region_id: (r.hour_of_day, r.day_of_week, r.time_period, r.day_type) for r in f.collect()}
    assert tf[1] == (7, 7, "morning_peak", "weekend")
    assert tf[14] == (23, 1, "daytime", "weekend")       # 23h is not 'overnight' as published
    assert tf[15] == (10, 2, "daytime", "weekday")
    fw = {r.region_id: r.time_period for r in cb.int_time_features(m, wrap_midnight=True).collect()}
    assert fw[14] == "overnight"

    assert {r.region_id for r in cb.mart_carbon_intensity(f).collect()} == {1, 14}
    latest = cb.mart_generation_mix(f).collect()   # newest granular period: Sunday 23:00
    assert [r.region_id for r in latest] == [14]
    comp = {r.region_id: (r.cleanest_rank, r.dirtiest_rank) for r in cb.mart_regional_comparison(f).collect()}
    assert comp == {14: (1, 2), 1: (2, 1)}


def test_mode_tie_goes_to_smallest(spark):
    i = [(1, "N", "D", 10.0, "low", "2024-01-01T00:00Z", "x", 1, NOW),
         (1, "N", "D", 10.0, "high", "2024-01-01T01:00Z", "x", 1, NOW)]
    f = cb.int_time_features(cb.int_regional_metrics(
        cb.stg_carbon_intensity(spark.createDataFrame(i, I_COLS)),
        cb.stg_generation_mix(spark.createDataFrame([], G_COLS))))
    assert cb.regional_summary(f).first().most_common_category == "high"


H_COLS = ("facility_id string, facility_name string, state string, measure_name string, "
          "number_of_discharges string, footnote string, excess_readmission_ratio string, "
          "predicted_readmission_rate string, expected_readmission_rate string, number_of_readmissions string, "
          "start_date string, end_date string, k long")


def _h(fid, measure, ratio, disch="100", readm="10", pred="15.0", exp="14.0", k=0, name=" Gen ", state=" ny"):
    return (fid, name, state, measure, disch, None, ratio, pred, exp, readm, "07/01/2019", "2022-06-30", k)


def test_readmissions_chain_edges(spark):
    data = [_h("010001", "AMI", "1.2"), _h("010001", "HF", "1.2"),               # avg 1.2 -> High
            _h("010002", "AMI", "0.99995"),                                     # Low, no penalty
            _h("010003", "AMI", "1.0"),                                         # Medium, no penalty
            _h("010004", "AMI", "Too Few to Report", disch="Too Few to Report"),  # suppressed
            _h("010005", "AMI", "N/A", disch=" N/A", readm="Not Available"),
            _h("010006", "AMI", "1.1", pred="N/A"),                             # sentinel outside the flag
            _h("010003", "AMI", "1.5", k=9),                                    # duplicate key, later in order
            _h("010007", "AMI", None, disch=None, readm=None)]                  # null cells: not suppressed
    raw = spark.createDataFrame(data, H_COLS)
    silver = rd.silver_hrrp(rd.bronze_hrrp(raw), order_by=["k"])
    assert silver.count() == 8
    s = {r.facility_id: r for r in silver.collect()}
    assert s["010001"].state == "NY" and s["010001"].facility_name == "Gen"    # leading zeros kept
    assert s["010004"].is_suppressed and s["010005"].is_suppressed
    assert not s["010006"].is_suppressed and s["010006"].predicted_readmission_rate is None
    assert not s["010007"].is_suppressed
    assert s["010003"].excess_readmission_ratio == 1.0                          # first in order kept
    assert s["010001"].start_date == dt.date(2019, 7, 1) and s["010001"].end_date == dt.date(2022, 6, 30)

    h = {r.facility_id: r for r in rd.gold_hospital_summary(silver).collect()}
    assert "010004" not in h
    assert (h["010001"].risk_tier, h["010001"].penalty_flag, h["010001"].national_rank) == ("High", True, 1)
    assert (h["010002"].avg_excess_ratio, h["010002"].risk_tier, h["010002"].penalty_flag) == (1.0, "Medium",
                                                                                                False)
    assert (h["010003"].risk_tier, h["010003"].penalty_flag) == ("Medium", False)
    assert h["010007"].avg_excess_ratio is None and h["010007"].risk_tier == "Low"
    assert h["010007"].national_rank == max(r.national_rank for r in h.values())  # null ranks last
    assert rd.gold_state_summary(silver).count() == 1
    assert rd.gold_condition_summary(silver).count() == 2
    top = rd.top_penalised(rd.gold_hospital_summary(silver), 3).collect()
    assert [r.national_rank for r in top] == sorted(r.national_rank for r in top)


P_COLS = ("id string, symbol string, name string, current_price double, market_cap long, market_cap_rank int, "
          "total_volume long, high_24h double, low_24h double, price_change_24h double, "
          "price_change_percentage_24h double, circulating_supply double, total_supply double, "
          "max_supply double, last_updated string, _ingested_at timestamp, _batch_id long")


def _p(sym, batch, price, cap):
    return (sym, sym, sym.upper(), price, cap, 1, 1, price, price, 0.0, 0.0, 1.0, 1.0, None,
            "2024-01-01T00:00:00.000Z", NOW, batch)


def test_market_tables(spark):
    data = [_p("btc", 1, 100.0, 300), _p("btc", 2, 101.0, 300), _p("eth", 1, 10.0, 100),
            _p("eth", 2, 9.0, 100), _p("doge", 1, 0.1, 5)]   # doge missing from the newest batch
    silver = mk.silver_prices(spark.createDataFrame(data, P_COLS))
    assert silver.filter(F.col("previous_price").isNull()).count() == 3
    latest = mk.gold_latest_prices(silver)
    assert rows(latest, "symbol") == [("btc",), ("eth",)]
    dom = {r.symbol: r.market_cap_share_pct for r in mk.gold_market_dominance(latest).collect()}
    assert dom == {"btc": 75.0, "eth": 25.0}
    summ = {r.symbol: r for r in mk.gold_price_summary(silver).collect()}
    assert summ["btc"].overall_direction == "BULLISH" and summ["eth"].overall_direction == "BEARISH"
    assert summ["doge"].flat_count == 1 and summ["doge"].overall_direction == "NEUTRAL"
    assert summ["btc"].volatile_batches == 1 and summ["eth"].volatile_batches == 1
    assert (summ["btc"].volatility_rank, summ["eth"].volatility_rank, summ["doge"].volatility_rank) == (1, 1, 2)
    excl = {r.symbol: r.flat_count for r in mk.gold_price_summary(silver, exclude_first=True).collect()}
    assert excl == {"btc": 0, "eth": 0}
