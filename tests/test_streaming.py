"""Stream equals batch, also across restarts, late rows and repeated polls."""

import json
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans import markets as mk
from strata.plans.queries_stream import PRICE_LANDING_SCHEMA, land_in_order
from strata.sources.documents import DOCUMENT_SCHEMA, LandingError
from strata.sources.files import scratch_path
from strata.sources.testdata import prices_raw
from strata.streaming import jobs, versions
from strata.streaming.market import Market, Movement, run_market_refresh
from strata.streaming.rank_tree import RankTree
from tests.conftest import SF_SMALL, rows

COLS = ("symbol", "_batch_id", "current_price", "previous_price", "batch_price_change",
        "batch_price_change_pct", "price_direction", "is_volatile")
FIELDS = [f.name for f in PRICE_LANDING_SCHEMA.fields]


def poll(symbol, batch, price, updated="2024-01-01T00:00:00.000Z"):
    base = dict.fromkeys(FIELDS)
    base.update(id=symbol, symbol=symbol, name=symbol, current_price=price, _batch_id=batch, last_updated=updated,
                market_cap=100 + (batch or 0))
    return tuple(base[f] for f in FIELDS)


def land(spark, landing, polls):
    spark.createDataFrame(polls, PRICE_LANDING_SCHEMA).coalesce(1).write.mode("append").json(landing)


def batch_series(bronze):
    sound = bronze.filter("symbol IS NOT NULL AND _batch_id IS NOT NULL")
    return mk.silver_prices(sound.withColumn("_text", F.col("last_updated")), tiebreak=["_text", "current_price"])


def refresh(spark, landing, root, lateness=3600, files=None, **more):
    stream = jobs.read_landing_json(spark, landing, PRICE_LANDING_SCHEMA, files)
    return run_market_refresh(spark, stream, root, lateness=lateness, buckets=4, **more)


def check_against_batch(spark, root, seen):
    """Series, summary with ranks and newest batch equal the batch job over all polls seen."""
    market = Market(spark, root, buckets=4)
    bronze = spark.createDataFrame(seen, PRICE_LANDING_SCHEMA).withColumn("_ingested_at", F.current_timestamp())
    want = batch_series(bronze)
    assert rows(market.clean_series(), *COLS) == rows(want, *COLS)
    summary = mk.gold_price_summary(want).drop("_gold_processed_at")
    assert rows(market.price_summary().select(*summary.columns)) == rows(summary)
    newest = [c for c in mk.LATEST_COLUMNS if c != "_ingested_at"]
    assert rows(market.latest_prices(), *newest) == rows(mk.gold_latest_prices(want), *newest)


def test_market_refresh_restart_equals_batch(spark):
    bronze = prices_raw(spark, SF_SMALL)
    landing, root = scratch_path(spark, "t-landing"), scratch_path(spark, "t-stream")
    land_in_order(bronze.filter("_batch_id < 4").select(*FIELDS), "_batch_id", "symbol", landing, chunks=2)
    read = refresh(spark, landing, root, lateness=1, files=8)
    n_first = Market(spark, root, 4).clean_series().count()
    land_in_order(bronze.filter("_batch_id >= 4").select(*FIELDS), "_batch_id", "symbol", landing, chunks=2)
    # A new query on the same checkpoint: resumes with the stored state.
    read += refresh(spark, landing, root, lateness=1, files=8)
    out = Market(spark, root, 4).clean_series()
    assert 0 < n_first < out.count()
    assert sum(r["rows"] for r in read) == bronze.count()  # every landed row was read once
    assert rows(out, *COLS) == rows(mk.silver_prices(bronze), *COLS)


@pytest.mark.parametrize("lateness", [3600, 1])
def test_late_and_repeated_polls_equal_the_batch_result(spark, lateness):
    """Within the horizon the state corrects the series; beyond it the coins' buckets are read. Same result."""
    landing, root = scratch_path(spark, "t-late"), scratch_path(spark, "t-late-out")
    steps = [
        [poll("a", 1, 10.0), poll("a", 3, 12.0), poll("b", 1, 5.0)],
        [poll("a", 2, 11.0), poll("b", 2, 6.0), poll("d", 9, None)],                  # a is late
        [poll("b", 2, 6.5, "2024-01-01T00:00:01.000Z"), poll("a", 4, 13.0)],          # b is polled again
        [poll("c", 15, 1.0), poll("c", 15, 2.0), poll("a", 15, 9.0), poll("b", 14, 7.0)],  # c twice at once
        [poll("a", 0, 1.5), poll("a", 3, 12.0), poll("b", 3, 8.0), poll("b", 3, 8.0)],   # far back, and a poll repeated as it was
        [poll("a", 16, 9.0), poll("b", 16, 1.0), poll("c", 16, 4.0)],
    ]
    seen = []
    for step in steps:
        land(spark, landing, step)
        seen += step
        refresh(spark, landing, root, lateness)
        check_against_batch(spark, root, seen)
    late = rows(Market(spark, root, 4).apart("late"), "symbol", "_batch_id", "current_price") if lateness == 1 else None
    if lateness == 1:
        assert ("a", 0, 1.5) in late
    else:
        assert not Market(spark, root, 4).series.has("late", 99)


def test_odd_values_pass_the_state_unchanged(spark):
    """Polls are texts within the state: quotes, line feeds, NaN, infinities, zeros with a sign and nulls come back."""
    landing, root = scratch_path(spark, "t-odd"), scratch_path(spark, "t-odd-out")
    odd = ['a"b', "a\nb", "a\\b", "\u00e9\U0001f600", " ", "", "\u0001c"]
    first = [poll(s, b, x) for s in odd for b, x in ((1, 1e-300), (2, float("nan")), (4, None), (5, float("inf")))]
    then = [poll(s, b, x) for s in odd for b, x in ((3, -0.0), (2, float("-inf")), (6, 0.1 + 0.2), (4, float("nan")))]
    for step in (first, then):
        land(spark, landing, step)
        refresh(spark, landing, root, serving=False)
    columns = ["symbol", "name", "_batch_id", "market_cap", "max_supply", "current_price", "previous_price"]
    shown = [F.col(c).cast("string") if c.endswith("_price") else F.col(c) for c in columns]
    want = batch_series(spark.createDataFrame(first + then, PRICE_LANDING_SCHEMA).withColumn("_ingested_at", F.current_timestamp()))
    got = Market(spark, root, 4).clean_series()
    assert rows(got.select(*shown)) == rows(want.select(*shown))
    assert got.filter("_ingested_at IS NULL").count() == 0


def test_state_calls_do_not_grow_with_the_coins():
    """A cell's state is read and written once a micro-batch, however many coins and polls arrive, and once by a timer."""
    calls = []

    class Stub:  # handle, state and clock
        held, now = None, 0

        def getValueState(self, name, schema):
            return self

        def registerTimer(self, at):
            calls.append("timer")

        def getCurrentWatermarkInMs(self):
            return self.now

        def get(self):
            calls.append("get")
            return self.held

        def update(self, value):
            calls.append("update")
            self.held = value

    def arrived(*batches):
        return [(json.dumps({"symbol": f"s{k}", "batch": b, "price": float(k + b)}) + f"\n{k}-{b}",) for k in range(500) for b in batches]

    stub, cell = Stub(), Movement()
    cell.init(stub)
    out = [r.asDict() for r in cell.handleInputRows(("c1",), iter(arrived(1, 3)), stub)]
    assert len(out) == 1 and calls == ["get", "timer", "update"]
    stub.now, calls[:] = 2000, []
    out = [r.asDict() for r in cell.handleInputRows(("c1",), iter(arrived(2)), stub)]  # between the two: the later is corrected
    assert [len(r["polls"]) for r in out] == [1000, 500] and calls == ["get", "update"]
    assert [k for r in out for k in r["kinds"]] == ["new", "undo", "fix"] * 500
    stub.now, calls[:] = 4000, []
    assert not list(cell.handleExpiredTimer(("c1",), stub, None)) and calls == ["get", "update"]
    timer, coins = stub.held
    assert timer is None and all(floor[0] == 3 and not recent for floor, recent in json.loads(coins).values())
    out = [r.asDict() for r in cell.handleInputRows(("c1",), iter(arrived(2)), stub)]
    assert {k for r in out for k in r["kinds"]} == {"late"}


def test_malformed_polls_are_kept_and_counted(spark):
    landing, root = scratch_path(spark, "t-bad"), scratch_path(spark, "t-bad-out")
    good = [poll("a", 1, 10.0), poll("b", 1, 5.0), poll("a", 2, 11.0)]
    land(spark, landing, [*good, poll(None, 1, 1.0), poll("a", None, 3.0)])
    spark.createDataFrame([('{"symbol": "a", "_batch_id": 3, ',)], "value string").coalesce(1).write.mode("append").text(landing)
    counts = refresh(spark, landing, root)
    assert sum(c["rows"] for c in counts) == 6 and sum(c["malformed"] for c in counts) == 3
    check_against_batch(spark, root, good)
    bad = Market(spark, root, 4).apart("bad")
    assert bad.count() == 3 and bad.filter("_corrupt_record LIKE '%symbol%'").count() == 1
    # Stopping instead: nothing is committed, and the micro-batch runs again once it may be kept.
    root = scratch_path(spark, "t-bad-stop")
    with pytest.raises(Exception, match="malformed"):
        refresh(spark, landing, root, on_malformed="raise")
    assert Market(spark, root, 4).upto() == -1
    refresh(spark, landing, root)
    check_against_batch(spark, root, good)


def signed(spark, *polls):
    """Polls as the processor would give them for a coin's first rows."""
    frame = spark.createDataFrame([(*p, None, "new") for p in polls],
                                  T.StructType([*PRICE_LANDING_SCHEMA.fields, T.StructField("previous_price", T.DoubleType()),
                                                T.StructField("kind", T.StringType())]))
    return frame.withColumns({"_ingested_at": F.current_timestamp(), "_corrupt_record": F.lit(None).cast("string")})


def test_a_retried_micro_batch_gives_the_same_tables(spark):
    root = scratch_path(spark, "t-retry")
    market = Market(spark, root, 4)
    market.refresh(signed(spark, poll("a", 1, 1.0), poll("b", 1, 2.0)), 0)
    second = signed(spark, poll("a", 2, 3.0), poll("c", 2, 2.5))
    market.refresh(second, 1)
    once = rows(market.clean_series(), *COLS), rows(market.price_summary()), rows(market.latest_prices(), "symbol")
    market.refresh(second, 1)
    assert (rows(market.clean_series(), *COLS), rows(market.price_summary()), rows(market.latest_prices(), "symbol")) == once


def test_uncommitted_micro_batches_are_not_read(spark):
    root = scratch_path(spark, "t-partial")
    market = Market(spark, root, 4)
    market.refresh(signed(spark, poll("a", 1, 1.0)), 0)
    market.series.write(signed(spark, poll("a", 2, 5.0)), 1)   # began, and did not finish
    market.parts.write(market.parts.read(0).withColumn("max_price", F.lit(9.0)), 1)
    assert market.upto() == 0 and market.clean_series().count() == 1
    assert market.price_summary().first().max_price == 1.0


def test_versions_are_merged_and_old_ones_go(spark, monkeypatch):
    monkeypatch.setattr(versions, "FAN_IN", 2)
    monkeypatch.setattr(versions, "KEEP_SECONDS", -60)
    root = scratch_path(spark, "t-compact")
    market = Market(spark, root, 4)
    for i in range(8):
        market.refresh(signed(spark, poll("a", i, float(i)), *([poll("b", i, 1.0)] if i == 0 else [])), i)
    assert len(market.series.versions(7)) == 1                       # one folder over eight micro-batches
    assert len(versions.listed(spark, f"{root}/series/v=*")) == 1
    assert len(versions.listed(spark, f"{root}/parts/bucket=*/v=*")) <= 4
    assert rows(market.parts.read(7), "symbol", "n") == [("a", 8), ("b", 1)]
    assert market.clean_series().count() == 9


def test_a_micro_batch_reads_only_the_buckets_it_touches(spark):
    """Input rows of the repair and of the merge do not grow with coins in other buckets or with the history."""
    root = scratch_path(spark, "t-prune")
    market = Market(spark, root, 64)
    market.refresh(signed(spark, *[poll(f"c{k}", b, float(k + b)) for k in range(200) for b in (1, 2, 3)]), 0)
    late = signed(spark, poll("c7", 0, 4.0)).withColumn("kind", F.lit("late"))
    market.refresh(late, 1)
    bucket = spark.range(1).select(versions.bucket_of(F.lit("c7"), 64)).first()[0]
    assert market.series.touched(1) == [bucket]
    read = market.series.read(1, ("new", "fix", "undo"), [bucket])
    files = [r[0] for r in read.select("_metadata.file_path").distinct().collect()]
    assert files and all(f"bucket={bucket}/" in f for f in files)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert set(market.parts.newest(1).values()) == {0, 1} and [b for b, v in market.parts.newest(1).items() if v == 1] == [bucket]
    seen = [poll(f"c{k}", b, float(k + b)) for k in range(200) for b in (1, 2, 3)] + [poll("c7", 0, 4.0)]
    want = batch_series(spark.createDataFrame(seen, PRICE_LANDING_SCHEMA).withColumn("_ingested_at", F.current_timestamp()))
    got = market.clean_series().filter("symbol = 'c7'")
    assert rows(got, "_batch_id", "current_price").__len__() == 4
    first = [r for r in rows(want, *COLS) if r[0] == "c7"]
    assert [r[3] for r in rows(got, *COLS)][:1] == [r[3] for r in first][:1]


def test_rank_tree_equals_dense_rank_after_every_change(spark):
    rnd = random.Random(11)
    tree = RankTree(spark, scratch_path(spark, "t-tree"), 2, buckets=8)
    held = {}
    for mb in range(4):
        changes = []
        for k in range(60):
            key = rnd.randrange(80)
            value = rnd.choice([None, round(rnd.uniform(0, 50), 2), float(rnd.randrange(20)), 9e6 + rnd.randrange(5)])
            if key in held:
                changes.append((held[key], -1))
            held[key] = value
            changes.append((value, 1))
        tree.update(spark.createDataFrame(changes, "value double, n int"), mb)
        df = spark.createDataFrame(list(held.items()), "id int, v double")
        want = rows(df.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("v").desc()))), "id", "r")
        assert rows(tree.dense_rank_desc(df, "v", "r", mb), "id", "r") == want
    # One value moves: one leaf bucket, and the nodes above it, have a new version.
    before = [level.newest(3) for level in tree.levels]
    tree.update(spark.createDataFrame([(123.45, 1)], "value double, n int"), 4)
    assert all(sum(v == 4 for v in level.newest(4).values()) == 1 for level in tree.levels) and before


REGION = lambda i: {"regionid": i, "dnoregion": f"d{i}", "shortname": f"r{i}",
                    "intensity": {"forecast": 10.0 * i, "index": "low"},
                    "generationmix": [{"fuel": "wind", "perc": 40.0}, {"fuel": "gas", "perc": 60.0}]}


def document(batch, hours=3):
    return {"batch_id": batch, "data": [{"from": f"2024-01-01T0{h}:00Z", "to": f"2024-01-01T0{h}:30Z", "regions": [REGION(1), REGION(2)]}
                                        for h in range(hours)]}


def put(spark, folder, name, text):
    path, fs = versions.hadoop(spark, f"{folder}/{name}")
    out = fs.create(path)
    out.write(bytearray(text.encode()))
    out.close()


def test_documents_of_any_layout_reach_both_tables(spark):
    """One document over many lines, several on one line each, broken and empty files: nothing is lost silently."""
    landing, root = scratch_path(spark, "t-docs"), scratch_path(spark, "t-docs-out")
    put(spark, landing, "pretty.json", json.dumps(document(1), indent=2))
    put(spark, landing, "lines.json", "\n".join(json.dumps(document(k)) for k in (2, 3)) + "\n{\"batch_id\": 4, \n")
    put(spark, landing, "broken.json", json.dumps(document(5), indent=2)[:-40])
    put(spark, landing, "empty.json", " \n")
    counts = jobs.ingest_documents(spark, landing, root)
    intensity, mix = jobs.document_tables(spark, root)
    assert (intensity.count(), mix.count()) == (18, 36)
    assert rows(intensity.select("batch_id").distinct()) == [(1,), (2,), (3,)]
    assert sum(c["malformed"] for c in counts) == 3
    bad = [r[0] for r in jobs.Documents(spark, root).read("bad").collect()]
    assert {x.strip()[:14] for x in bad} == {"", '{"batch_id": 4', '{\n  "batch_id"'}
    with pytest.raises(LandingError, match="3 malformed"):
        jobs.ingest_documents(spark, landing, scratch_path(spark, "t-docs-raise"), on_malformed="raise")


def test_a_retried_document_batch_replaces_both_tables(spark):
    landing, root = scratch_path(spark, "t-docs"), scratch_path(spark, "t-docs-out")
    put(spark, landing, "one.json", json.dumps(document(9)))
    jobs.ingest_documents(spark, landing, root)
    docs = spark.read.schema(DOCUMENT_SCHEMA).json(landing).withColumn("_corrupt_record", F.lit(None).cast("string"))
    jobs.Documents(spark, root).write(docs, 0)  # the micro-batch again
    assert tuple(t.count() for t in jobs.document_tables(spark, root)) == (6, 12)


def test_bronze_keeps_malformed_lines_apart(spark):
    landing, root = scratch_path(spark, "t-bronze"), scratch_path(spark, "t-bronze-out")
    land(spark, landing, [poll("a", 1, 1.0), poll("b", 1, 2.0)])
    put(spark, landing, "broken.json", '{"symbol": "a"\n')
    counts = jobs.bronze_append(spark, landing, PRICE_LANDING_SCHEMA, f"{root}/t", f"{root}/c")
    assert [(c["rows"], c["malformed"]) for c in counts] == [(3, 1)]
    assert jobs.bronze_rows(spark, f"{root}/t").count() == 2
    assert [r[0] for r in jobs.bronze_rows(spark, f"{root}/t", malformed=True).collect()] == ['{"symbol": "a"']
