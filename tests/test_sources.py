"""Sources and sinks: CSV with quoted line breaks, landing checks, swap refresh, comments."""

import json
import os

import pytest
from pyspark.sql import functions as F

from strata.sources import sinks
from strata.sources.documents import (
    LandingError, check_landing, flatten_generation_mix, flatten_regional_intensity, read_carbon_documents,
    read_price_snapshots,
)
from strata.sources.files import read_csv_strings, scratch_path
from tests.conftest import rows


def _local(path):
    return path.removeprefix("file:")


def test_csv_multiline_quoted_cell_and_sentinels(spark):
    path = scratch_path(spark, "t-csv")
    os.makedirs(_local(path))
    with open(os.path.join(_local(path), "a.csv"), "w") as f:
        f.write('Facility ID,Facility Name,Number of Discharges\n'
                '010001,"General\nHospital", N/A\n'
                '010002,Other,Too Few to Report\n')
    df = read_csv_strings(spark, path, ["Facility ID", "Facility Name", "Number of Discharges"], multi_line=True)
    assert rows(df) == [("010001", "General\nHospital", " N/A"), ("010002", "Other", "Too Few to Report")]


def test_csv_columns_are_taken_by_name(spark):
    path = scratch_path(spark, "t-csv-names")
    os.makedirs(_local(path))
    with open(os.path.join(_local(path), "a.csv"), "w") as f:
        f.write("State,Extra,Facility Name\nTX,1,General\n")
    assert rows(read_csv_strings(spark, path, ["Facility Name", "State"])) == [("General", "TX")]
    with pytest.raises(ValueError, match="lacks"):
        read_csv_strings(spark, path, ["Facility Name", "County"])
    with open(os.path.join(_local(path), "b.csv"), "w") as f:
        f.write("Facility Name,Extra,State\nOther,2,NY\n")
    with pytest.raises(Exception):  # noqa: B017  a file with another header does not load into the wrong columns
        read_csv_strings(spark, path, ["Facility Name", "State"]).collect()


def test_price_snapshot_missing_field_and_corrupt_record(spark):
    path = scratch_path(spark, "t-json")
    os.makedirs(_local(path))
    with open(os.path.join(_local(path), "a.json"), "w") as f:
        f.write(json.dumps({"id": "bitcoin", "symbol": "btc", "current_price": 42000}) + "\n")
        f.write("{not json\n")
    df = read_price_snapshots(spark, path, multi_line=False)
    got = df.filter("symbol = 'btc'").first()
    assert got.current_price == 42000.0 and got.max_supply is None
    with pytest.raises(LandingError):
        check_landing(df)
    with pytest.raises(LandingError):
        check_landing(df.limit(0))
    assert rows(check_landing(df.filter("_corrupt_record is null")), "symbol") == [("btc",)]


def test_nested_document_all_periods_and_regions(spark):
    path = scratch_path(spark, "t-doc")
    os.makedirs(_local(path))
    doc = {"batch_id": 7, "data": [
        {"from": "2024-01-01T00:00Z", "to": "2024-01-01T00:30Z", "regions": [
            {"regionid": 1, "dnoregion": "D1", "shortname": "North",
             "intensity": {"forecast": 50, "index": "moderate"},
             "generationmix": [{"fuel": "wind", "perc": 40.5}, {"fuel": "gas", "perc": 59.5}]},
            {"regionid": 2, "dnoregion": "D2", "shortname": "South",
             "intensity": {"forecast": 10, "index": "very low"}, "generationmix": []}]},
        {"from": "2024-01-01T00:30Z", "to": "2024-01-01T01:00Z", "regions": [
            {"regionid": 1, "dnoregion": "D1", "shortname": "North",
             "intensity": {"forecast": 55, "index": "moderate"},
             "generationmix": [{"fuel": "wind", "perc": 100}]}]}]}
    with open(os.path.join(_local(path), "poll.json"), "w") as f:
        json.dump(doc, f, indent=2)
    docs = check_landing(read_carbon_documents(spark, path))
    i = flatten_regional_intensity(docs)
    assert rows(i, "region_id", "period_from", "intensity_forecast") == [
        (1, "2024-01-01T00:00Z", 50.0), (1, "2024-01-01T00:30Z", 55.0), (2, "2024-01-01T00:00Z", 10.0)]
    g = flatten_generation_mix(docs)
    assert rows(g, "region_id", "fuel_type", "percentage", "batch_id") == [
        (1, "gas", 59.5, 7), (1, "wind", 40.5, 7), (1, "wind", 100.0, 7)]


def test_overwrite_swaps_schema_and_rows(spark):
    root = scratch_path(spark, "t-swap")
    name = "t_swap_table"
    first = spark.createDataFrame([(1, "a")], "id int, v string")
    loc1 = sinks.overwrite(first, name, root, fmt="parquet")
    second = spark.createDataFrame([(2, 2.5, "x"), (3, 3.5, "y")], "id int, w double, v string")
    loc2 = sinks.overwrite(second, name, root, fmt="parquet")
    assert loc1 != loc2
    assert spark.table(name).columns == ["id", "w", "v"] and spark.table(name).count() == 2
    assert spark.read.parquet(loc1).count() == 1      # the old version is left intact for its readers


def test_comments_stored_with_table(spark):
    root = scratch_path(spark, "t-comment")
    sinks.overwrite(spark.createDataFrame([(1,)], "region_id int"), "t_comment_table", root, fmt="parquet")
    sinks.set_comments(spark, "t_comment_table", "Carbon intensity per region",
                       {"region_id": "Unique region identifier"})
    desc = {r.col_name: r.comment for r in spark.sql("DESCRIBE TABLE t_comment_table").collect()}
    assert desc["region_id"] == "Unique region identifier"
    ext = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED t_comment_table").collect()}
    assert ext.get("Comment") == "Carbon intensity per region"


def test_append_twice_reads_back_both(spark):
    path = scratch_path(spark, "t-append")
    a = spark.createDataFrame([(1,)], "b long")
    sinks.append(a, path=path, fmt="parquet")
    sinks.append(a.selectExpr("b + 1 as b"), path=path, fmt="parquet")
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]


def test_price_snapshot_file_is_a_json_array(spark):
    path = scratch_path(spark, "t-json-array")
    os.makedirs(_local(path))
    poll = [{"id": "bitcoin", "symbol": "btc", "name": "Bitcoin", "current_price": 42000.5, "market_cap": 800,
             "market_cap_rank": 1, "last_updated": "2024-01-01T00:00:00.000Z"},
            {"id": "ethereum", "symbol": "eth", "name": "Ethereum", "current_price": 2200, "market_cap": 270,
             "market_cap_rank": 2, "max_supply": None, "unexpected_field": "ignored"}]
    with open(os.path.join(_local(path), "poll-1.json"), "w") as f:
        json.dump(poll, f, indent=2)
    df = check_landing(read_price_snapshots(spark, path, multi_line=True))
    assert rows(df, "symbol", "current_price", "market_cap_rank", "last_updated") == [
        ("btc", 42000.5, 1, "2024-01-01T00:00:00.000Z"), ("eth", 2200.0, 2, None)]


def test_refresh_keeps_descriptions_and_retires_versions(spark):
    root, name = scratch_path(spark, "t-swap-same"), "t_swap_same"
    first = spark.createDataFrame([(1, "it's a")], "id int, v string")
    sinks.overwrite(first, name, root, fmt="parquet")
    sinks.set_comments(spark, name, "What it's for", {"v": "the value's text"})
    for k in range(3):
        sinks.overwrite(first.withColumn("more", F.lit(k)), name, root, fmt="parquet", partition_by="more")
    assert rows(spark.table(name)) == [(1, "it's a", 2)]
    assert spark.catalog.getTable(name).description == "What it's for"
    assert {c.name: c.description for c in spark.catalog.listColumns(name)}["v"] == "the value's text"
    assert len([d for d in os.listdir(os.path.join(_local(root), name)) if d.startswith("v")]) == 2


def test_a_failure_between_the_steps_leaves_the_old_table(spark, monkeypatch):
    root, name = scratch_path(spark, "t-broken"), "t_broken"
    df = spark.createDataFrame([(1,)], "id int")
    sinks.overwrite(df, name, root, fmt="parquet")

    def fail(*args, **kwargs):
        raise RuntimeError("stop")

    monkeypatch.setattr(sinks, "point", fail)
    with pytest.raises(RuntimeError):
        sinks.overwrite(df.selectExpr("id + 1 as id"), name, root, fmt="parquet")
    assert rows(spark.table(name)) == [(1,)]


def test_table_audit(spark):
    root = scratch_path(spark, "t-audit")
    sinks.overwrite(spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string"), "t_audit_a", root, fmt="parquet")
    sinks.set_comments(spark, "t_audit_a", "two rows")
    got = rows(sinks.table_audit(spark, ["t_audit_a"]))
    assert got == [("t_audit_a", 2, 2, "struct<id:int,v:string>", "two rows")]
    assert "t_audit_a" in [r[0] for r in rows(sinks.table_audit(spark).select("table_name"))]


def test_checkpoint_folder_must_be_set_on_a_cluster():
    from strata.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
