"""End-to-end publishing: gate before publish, tables replaced by swap."""

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import QualityGateError, Watch, accepted_values, dq_report, not_null
from strata.plans import publish
from strata.sources.files import scratch_path
from strata.sources.testdata import generation_raw, hrrp_raw, intensity_raw, prices_raw
from tests.conftest import SF_SMALL


def test_publish_carbon_and_gate(spark):
    root = scratch_path(spark, "t-publish")
    paths = publish.publish_carbon(spark, intensity_raw(spark, SF_SMALL), generation_raw(spark, SF_SMALL), root,
                                   prefix="t_energy")
    assert set(paths) == {"mart_carbon_intensity", "mart_generation_mix", "mart_peak_analysis",
                          "mart_regional_comparison"}
    n = spark.table("t_energy_mart_regional_comparison").count()
    assert 0 < n <= 14
    before = spark.table("t_energy_mart_carbon_intensity").count()
    bad = generation_raw(spark, SF_SMALL).withColumn("fuel_type", F.lit("peat"))   # not an accepted fuel
    with pytest.raises(QualityGateError):
        publish.publish_carbon(spark, intensity_raw(spark, SF_SMALL), bad, root, prefix="t_energy")
    assert spark.table("t_energy_mart_carbon_intensity").count() == before          # nothing replaced


def test_publish_markets_and_readmissions(spark):
    root = scratch_path(spark, "t-publish2")
    publish.publish_markets(spark, prices_raw(spark, SF_SMALL), root, prefix="t_crypto", chunk_width=7,
                            batch_seconds=False)
    assert spark.table("t_crypto_price_movement_summary").count() == \
        spark.table("t_crypto_prices_clean").select("symbol").distinct().count()
    publish.publish_readmissions(spark, hrrp_raw(spark, SF_SMALL), root, ["k1", "k2", "k3"], prefix="t_hc")
    assert spark.table("t_hc_condition_readmission_summary").count() > 0


def test_the_gate_scans_nothing_again(spark, monkeypatch):
    """Counts come from the write itself; between staging and publishing no job reads the staged rows for the rules."""
    rules = [not_null("symbol"), accepted_values("symbol", ["a", "b"])]
    df = spark.createDataFrame([("a", True), ("b", False), (None, True), ("z", None)], "symbol string, flag boolean")
    watch = Watch(rules, flag="flag")
    path = scratch_path(spark, "t-watch")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("t-watch", "")
    watch.on(df).write.parquet(path)
    jobs = len(tracker.getJobIdsForGroup("t-watch"))
    assert watch.failures() == {"not_null_symbol": 1, "accepted_values_symbol": 1, "balanced_flag": 1} and watch.rows == 4
    with pytest.raises(QualityGateError, match="not_null_symbol=1"):
        watch.gate()
    assert len(tracker.getJobIdsForGroup("t-watch")) == jobs
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    want = sorted(map(tuple, dq_report(spark.read.parquet(path), rules, "t").collect()))
    assert [r for r in sorted(map(tuple, watch.report(spark, "t").collect())) if "balanced" not in r[1]] == want
    import inspect
    assert "dq_report" not in inspect.getsource(publish)


def test_newest_day_prunes_partitions(spark):
    root = scratch_path(spark, "t-prune")
    publish.publish_markets(spark, prices_raw(spark, SF_SMALL), root, prefix="t_prune", batch_seconds=False)
    from strata.plans import markets as mk
    run = [p for p in spark.table("t_prune_prices_clean").inputFiles()][0].split("/batch_day")[0]
    latest = mk.gold_latest_prices(spark.read.parquet(run), partition="batch_day")
    latest.write.format("noop").mode("overwrite").save()
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_day" in plan
    want = mk.gold_latest_prices(spark.table("t_prune_prices_clean")).drop("_gold_processed_at")
    assert sorted(map(tuple, latest.drop("_gold_processed_at").collect())) == sorted(map(tuple, want.collect()))


def test_lost_values_fail_the_gate(spark):
    root = scratch_path(spark, "t-losses")
    bad = prices_raw(spark, SF_SMALL).withColumn("last_updated", F.lit("yesterday"))
    with pytest.raises(QualityGateError, match="not_lost"):
        publish.publish_markets(spark, bad, root, prefix="t_lost", batch_seconds=False)
    assert not spark.catalog.tableExists("t_lost_prices_clean")
    odd = hrrp_raw(spark, SF_SMALL).withColumn("number_of_discharges", F.lit("many"))
    with pytest.raises(QualityGateError, match="not_lost"):
        publish.publish_readmissions(spark, odd, root, ["k1"], prefix="t_lost_hc")
    publish.publish_readmissions(spark, odd, root, ["k1"], prefix="t_lost_hc", allow_losses=True)
    assert "_lost" not in spark.table("t_lost_hc_cms_hrrp_clean").columns


def test_command_line_readmissions_and_carbon(spark, capsys):
    import json

    from strata.__main__ import main
    from strata.plans import readmissions as rd
    from strata.operators.clean import snake_case_names
    from strata.sources.files import write_csv

    raw = hrrp_raw(spark, SF_SMALL)
    to_header = {snake_case_names([h])[h]: h for h in rd.RAW_HEADER}
    csv = scratch_path(spark, "t-cli-csv")
    write_csv(raw.select(*[F.col(c).cast("string").alias(h) for c, h in to_header.items()]), csv)
    out = scratch_path(spark, "t-cli-out")
    main(["readmissions", "--csv", csv, "--out", out, "--prefix", "t_cli_hc"])
    paths = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(paths) == {"hospital_readmission_summary", "state_readmission_summary",
                          "condition_readmission_summary"}
    assert spark.table("t_cli_hc_cms_hrrp_clean").filter(F.col("_source_file").isNull()).count() == 0

    i, g = scratch_path(spark, "t-cli-i"), scratch_path(spark, "t-cli-g")
    intensity_raw(spark, SF_SMALL).write.parquet(i)
    generation_raw(spark, SF_SMALL).write.parquet(g)
    main(["carbon", "--intensity", i, "--generation", g, "--out", out, "--prefix", "t_cli_en"])
    assert spark.table("t_cli_en_mart_peak_analysis").count() > 0


def test_command_line_starts_from_json(spark):
    from strata.__main__ import main
    from strata.sources.documents import SNAPSHOT_SCHEMA
    out, prices, docs = scratch_path(spark, "t-cli-json"), scratch_path(spark, "t-cli-p"), scratch_path(spark, "t-cli-d")
    b = prices_raw(spark, SF_SMALL).filter("_batch_id <= 2").select(
        *[f.name for f in SNAPSHOT_SCHEMA.fields], (F.col("_batch_id") * 86400).alias("_batch_id"))
    b.coalesce(1).write.partitionBy("_batch_id").option("ignoreNullFields", "false").json(prices)
    main(["markets", "--prices-json", prices, "--out", out, "--prefix", "t_json"])
    assert spark.table("t_json_prices_clean").count() > 0
    text = """{"batch_id": 1, "data": [{"from": "2024-01-01T00:00Z", "to": "2024-01-01T00:30Z", "regions": [
      {"regionid": 3, "dnoregion": "d", "shortname": "r", "intensity": {"forecast": 90.0, "index": "low"},
       "generationmix": [{"fuel": "wind", "perc": 60.0}, {"fuel": "gas", "perc": 40.0}]}]}]}"""
    spark.createDataFrame([(text.replace("\n", " "),)], "value string").write.text(docs)
    main(["carbon", "--documents", docs, "--out", out, "--prefix", "t_json_en"])
    assert spark.table("t_json_en_mart_carbon_intensity").first()["renewable_pct"] == 60.0
