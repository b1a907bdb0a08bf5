"""Market prices as a stream: the clean series chained by keyed state, serving tables kept up to date from signed rows.

T2. One processor per cell of coins (RocksDB state): per coin the last price before the horizon, and the rows within
it. A poll that arrives late, or repeats a batch id, is put in its place and the row after it is corrected. The output is a
log of signed rows - ``new`` and ``fix`` add one, ``undo`` takes one away - so nothing is rewritten and
the cost of a micro-batch does not depend on the history. Event-time timers let rows leave the state once
the watermark has passed them.

T3. The per-coin summary, the newest batch and the rank by price range follow from the signed rows of a
micro-batch: only buckets with changed coins are read and written. Only polls older than the horizon need
the history: the buckets of their coins are read, and the differences are signed rows again.

Rows without a symbol, without a batch id or without valid JSON are kept apart (``bad``).
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from strata.functions.classify import is_volatile, overall_direction, price_direction
from strata.functions.numeric import EXACT_TYPE, change_pct, round_half_up
from strata.operators.movement import previous_value
from strata.plans import markets
from strata.session import ROCKSDB
from strata.sources.documents import CORRUPT, LandingError
from strata.streaming.rank_tree import RankTree
from strata.streaming.versions import Keyed, Log, commit, committed

TIEBREAK = ("last_updated", "current_price")  # polls of one coin and batch id
BUCKETS = 16
ADDS, TAKES = ("new", "fix"), ("undo",)
MILLIS = 1000
HEAD = ("batch", "updated", "price")  # a poll's batch id and TIEBREAK in its head
CELLS = 4096     # groups of coins with a state
ROWS_OUT = 1000  # rows of a cell in one row of arrays


# ---- T2: the processor ---------------------------------------------------------
class Movement(StatefulProcessor):
    """Previous price per coin; see the module's text.

    Calls and values that cross to Python cost more than what is done with them. So a group of the state is a cell of
    coins, its state is one text, a poll is one text (``head`` in JSON, a line feed, the whole row in JSON), and the
    rows of a cell leave as arrays.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.shape = Row("polls", "previous", "kinds")
        # coins: symbol -> (order fields of the last poll before the horizon, [(poll, previous price)] within it)
        self.state = handle.getValueState("cell", "timer bigint, coins string")

    @staticmethod
    def _read(poll: str) -> tuple:
        """(batch id, last_updated, price, row, symbol) of a poll."""
        head, row = poll.split("\n", 1)
        d = json.loads(head)
        price = d.get("price")  # NaN and the infinities are texts
        return d["batch"], d.get("updated"), None if price is None else float(price), row, d["symbol"]

    @staticmethod
    def _order(row) -> tuple:
        """Order of the series, as SQL sorts it: nulls first, NaN last."""
        batch, updated, price = row[:3]
        nan = price is not None and math.isnan(price)
        return batch, updated is not None, updated or "", price is not None, nan, price if price is not None and not nan else 0.0

    def _out(self, rows: list[tuple]) -> Iterator[Row]:
        """(row, previous price, kind) as few rows of arrays of bounded length."""
        for i in range(0, len(rows), ROWS_OUT):
            yield self.shape(*map(list, zip(*rows[i:i + ROWS_OUT], strict=True)))

    @staticmethod
    def _split(floor, rows: list, horizon: int) -> tuple:
        """A coin's state: the rows within the horizon; the last row before it becomes the floor."""
        kept = [r for r in rows if r[0][0] >= horizon]
        if len(kept) < len(rows):
            floor = rows[len(rows) - len(kept) - 1][0][:3]
        return floor, kept

    def _stored(self) -> tuple[int | None, dict]:
        stored = self.state.get()
        return (stored[0], json.loads(stored[1])) if stored is not None else (None, {})

    def _store(self, timer: int | None, coins: dict) -> None:
        """One timer is outstanding while rows are held: for when all of them are behind the watermark."""
        if timer is None:
            newest = max((rows[-1][0][0] for _, rows in coins.values() if rows), default=None)
            if newest is not None:
                timer = (newest + 1) * MILLIS
                self.handle.registerTimer(timer)
        self.state.update((timer, json.dumps(coins)))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if key[0][0] == "\0":  # not a coin: kept apart
            bad = (r[0].split("\n", 1)[1] for r in rows)
            while some := [(row, None, "bad") for row in islice(bad, ROWS_OUT)]:
                yield from self._out(some)
            return
        horizon = timerValues.getCurrentWatermarkInMs() // MILLIS
        timer, coins = self._stored()
        arrived: dict[str, list] = {}
        for r in rows:
            row = self._read(r[0])
            arrived.setdefault(row[4], []).append(row[:4])
        out = []
        for symbol, polls in arrived.items():
            floor, held = coins.get(symbol, (None, []))
            edge = self._order(floor) if floor is not None else None
            series = [(r, p, False) for r, p in held]
            for r in polls:
                if edge is not None and self._order(r) < edge:
                    out.append((r[3], None, "late"))
                else:
                    series.append((r, None, True))
            series.sort(key=lambda x: self._order(x[0]))
            previous, kept = (floor[2] if floor is not None else None), []
            for r, was, fresh in series:
                if fresh:
                    out.append((r[3], previous, "new"))
                elif was != previous:
                    out += [(r[3], was, "undo"), (r[3], previous, "fix")]
                kept.append((r, previous))
                previous = r[2]
            coins[symbol] = self._split(floor, kept, horizon)
        self._store(timer, coins)
        yield from self._out(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        horizon = timerValues.getCurrentWatermarkInMs() // MILLIS
        _, coins = self._stored()
        self._store(None, {s: self._split(floor, rows, horizon) for s, (floor, rows) in coins.items()})
        yield from ()


def signed_series(stream: DataFrame, lateness: int, cells: int = CELLS) -> DataFrame:
    """The stream of polls as signed rows with ``previous_price`` and ``kind``.

    ``lateness`` (in units of the batch id, unix seconds) is how far a poll may lag behind the newest one and
    still be placed from the state. ``cells`` groups of coins share their state's reads and writes; a checkpoint keeps
    the number it began with.
    """
    times = [f.name for f in stream.schema if isinstance(f.dataType, T.TimestampType)]
    rows = stream.withColumns({c: F.unix_micros(c) for c in times})  # the text holds plain numbers
    columns = rows.columns
    # The event time serves timers only; as a column of the input it would make Spark drop late polls unseen.
    rows = rows.withColumn("_event", F.timestamp_seconds(F.coalesce("_batch_id", F.lit(0)))) \
        .withWatermark("_event", f"{lateness} seconds").drop("_event")
    sound = F.col("symbol").isNotNull() & F.col("_batch_id").isNotNull()
    if CORRUPT in columns:
        sound = sound & F.col(CORRUPT).isNull()
    apart = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*columns), F.lit(64)).cast("string"))
    cell = F.concat(F.lit("c"), F.pmod(F.xxhash64("symbol"), F.lit(cells)).cast("string"))
    # Plain names: a field named as the corrupt record would be read as one.
    at = {c: f"c{i}" for i, c in enumerate(columns)}
    text = T.StructType([T.StructField(at[f.name], f.dataType) for f in rows.schema])
    head = F.to_json(F.struct("symbol", *[F.col(c).alias(to) for c, to in zip(("_batch_id", *TIEBREAK), HEAD, strict=True)]))
    row = F.to_json(F.struct(*[F.col(c).alias(at[c]) for c in columns]))
    keyed = rows.select(F.concat(head, F.lit("\n"), row).alias("_poll"), F.when(sound, cell).otherwise(apart).alias("_key"))
    out = "polls array<string>, previous array<double>, kinds array<string>"
    moved = keyed.groupBy("_key").transformWithState(Movement(), out, "Update", "EventTime")
    moved = moved.select(F.explode(F.arrays_zip("polls", "previous", "kinds")).alias("r")).select(
        F.from_json("r.polls", text, {"mode": "FAILFAST"}).alias("p"), F.col("r.previous").alias("previous_price"),
        F.col("r.kinds").alias("kind"))
    moved = moved.select(*[F.col(f"p.{at[c]}").alias(c) for c in columns], "previous_price", "kind")
    return moved.withColumns({c: F.timestamp_micros(c) for c in times})


def with_movement(rows: DataFrame) -> DataFrame:
    """Change, percentage and labels from price and previous price."""
    cur, prev = F.col("current_price"), F.col("previous_price")
    return rows.withColumns({
        "batch_price_change": round_half_up(cur - prev, 2),
        "batch_price_change_pct": round_half_up(change_pct(cur, prev), 4),
    }).withColumns({
        "price_direction": price_direction("batch_price_change"),
        "is_volatile": is_volatile("batch_price_change_pct"),
    })


def net(signed: DataFrame, corrected: bool) -> DataFrame:
    """Rows that are not taken back. Only batches with a correction are compared; ``corrected`` False skips that."""
    adds = signed.filter(F.col("kind").isin(list(ADDS)))
    columns = [c for c in signed.columns if c not in ("kind", "bucket")]
    if not corrected:
        return adds.select(*columns)
    takes = signed.filter(F.col("kind").isin(list(TAKES)))
    touched = takes.select("symbol", "_batch_id").distinct()
    rest = adds.join(touched, ["symbol", "_batch_id"], "left_semi").select(*columns, F.lit(1).alias("_op")) \
        .unionByName(takes.select(*columns, F.lit(-1).alias("_op")))
    rest = rest.groupBy(*columns).agg(F.sum("_op").alias("_n")).filter("_n > 0")
    rest = rest.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).select(*columns)
    return adds.join(touched, ["symbol", "_batch_id"], "left_anti").select(*columns).unionByName(rest)


# ---- T3: serving tables from signed rows ---------------------------------------
def _sign() -> Column:
    return F.when(F.col("kind").isin(list(TAKES)), -1).otherwise(1)


def summary_parts(signed: DataFrame) -> DataFrame:
    """Per-coin parts that merge associatively (exact decimal sums). A correction keeps the price, so the extremes only grow."""
    p, d, s = F.col("current_price"), F.col("price_direction"), _sign()

    def signed_count(condition: Column) -> Column:
        return F.sum(F.when(condition, s).otherwise(0))

    def signed_sum(c: str) -> Column:
        return F.sum(F.col(c).cast(EXACT_TYPE) * s).cast(EXACT_TYPE)

    zero = F.lit(0).cast(EXACT_TYPE)
    return with_movement(signed).groupBy("symbol", "name").agg(
        F.sum(s).alias("n"),
        signed_count(p.isNotNull()).alias("n_price"),
        F.min(p).alias("min_price"),
        F.max(p).alias("max_price"),
        F.coalesce(signed_sum("current_price"), zero).alias("sum_price"),
        signed_count(F.col("batch_price_change_pct").isNotNull()).alias("n_pct"),
        F.coalesce(signed_sum("batch_price_change_pct"), zero).alias("sum_pct"),
        signed_count(d == "UP").alias("up_count"),
        signed_count(d == "DOWN").alias("down_count"),
        signed_count(d == "FLAT").alias("flat_count"),
        signed_count(F.col("is_volatile")).alias("volatile_batches"),
    )


def merge_parts(old: DataFrame | None, new: DataFrame) -> DataFrame:
    if old is None:
        return new
    low, high = F.min("min_price").alias("min_price"), F.max("max_price").alias("max_price")
    exact = [F.sum(c).cast(EXACT_TYPE).alias(c) for c in ("sum_price", "sum_pct")]
    counts = [F.sum(c).cast("long").alias(c) for c in new.columns
              if c not in ("symbol", "name", "min_price", "max_price", "sum_price", "sum_pct")]
    return old.unionByName(new).groupBy("symbol", "name").agg(low, high, *exact, *counts).select(*new.columns)


def price_range() -> Column:
    return round_half_up(F.col("max_price") - F.col("min_price"), 2)


class Market:
    """The tables under ``root``: ``series`` (log of signed rows), ``parts``, ``latest`` and the rank tree."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, serving: bool = True):
        self.spark, self.root, self.serving = spark, root, serving
        self.series = Log(spark, f"{root}/series", "symbol", buckets)
        self.parts = Keyed(spark, f"{root}/parts", "symbol", buckets)
        self.newest = Keyed(spark, f"{root}/latest", F.lit(0), 1)  # one bucket: replaced as a whole
        self.ranks = RankTree(spark, f"{root}/ranks", 2, buckets)

    # -- readers: committed micro-batches only
    def upto(self) -> int:
        return committed(self.spark, self.root)

    def clean_series(self, upto: int | None = None, buckets=None) -> DataFrame:
        """The clean series, with movements."""
        upto = self.upto() if upto is None else upto
        signed = self.series.read(upto, (*ADDS, *TAKES), buckets)
        return with_movement(net(signed, self.series.has("undo", upto))).drop(CORRUPT)

    def apart(self, kind: str) -> DataFrame:
        """Rows kept apart: ``late`` (older than the horizon; they are in the series too) or ``bad``."""
        return self.series.read(self.upto(), (kind,)).drop("kind", "bucket", "previous_price")

    def latest_prices(self) -> DataFrame:
        """The newest batch over all coins (12 columns)."""
        return self.newest.read(self.upto()).select(*markets.LATEST_COLUMNS)

    def price_summary(self) -> DataFrame:
        """Serving summary (same columns as the batch summary); the rank is read from the tree."""
        def avg_of(s, n, digits):
            return round_half_up(F.col(s).cast("double") / F.nullif(F.col(n), F.lit(0).cast("long")), digits)

        upto = self.upto()
        g = self.parts.read(upto).select(
            "symbol", "name",
            round_half_up("min_price", 2).alias("min_price"),
            round_half_up("max_price", 2).alias("max_price"),
            avg_of("sum_price", "n_price", 2).alias("avg_price"),
            price_range().alias("price_range"),
            avg_of("sum_pct", "n_pct", 4).alias("avg_batch_change_pct"),
            "up_count", "down_count", "flat_count", "volatile_batches",
        )
        g = self.ranks.dense_rank_desc(g, "price_range", "volatility_rank", upto)
        return g.withColumns({"volatility_rank": F.col("volatility_rank").cast("int"),
                              "overall_direction": overall_direction("up_count", "down_count")})

    # -- the writer
    def refresh(self, batch: DataFrame, mb: int, on_malformed: str = "keep", chunk_width: int | None = None) -> None:
        """Write one micro-batch of signed rows and everything that follows from it, then commit.

        The batch is evaluated once. ``on_malformed`` "raise" stops the stream at a micro-batch with bad rows: it is
        not committed, and is run again when the stream restarts.
        """
        self.series.write(batch, mb)
        buckets = self.series.touched(mb)
        if not buckets:  # a micro-batch for timers only
            self.series.forget(mb)
            commit(self.spark, self.root, mb)
            return
        if on_malformed == "raise" and self.series.has("bad", mb, mb):
            bad = self.series.read(mb, ("bad",), mb=mb).count()
            raise LandingError(f"micro-batch {mb} has {bad} malformed record(s)")
        if self.series.has("late", mb, mb):
            self._place_late(mb, chunk_width)
        if self.serving and any(self.series.has(kind, mb, mb) for kind in (*ADDS, *TAKES)):
            signed = self.series.read(mb, (*ADDS, *TAKES), mb=mb)
            before = self.parts.read(mb - 1, buckets)
            self.parts.write(merge_parts(before, summary_parts(signed)), mb)
            self._rerank(before, self.parts.read(mb, buckets), mb)
            fresh = signed.filter("kind = 'new'").select("_batch_id", *[c for c in markets.LATEST_COLUMNS])
            old = self.newest.read(mb - 1)
            both = fresh if old is None else fresh.unionByName(old)
            self.newest.write(both.filter(F.col("_batch_id") == both.agg(F.max("_batch_id")).scalar()), mb)
        commit(self.spark, self.root, mb)
        for table in (self.series, self.parts, self.newest, self.ranks):
            table.tidy(mb)

    def _place_late(self, mb: int, chunk_width: int | None) -> None:
        """Put polls older than the horizon into their coins' series, read from the buckets of those coins."""
        late = self.series.read(mb, ("late",), mb=mb)
        buckets = [r[0] for r in late.select("bucket").distinct().collect()]
        signed = self.series.read(mb, (*ADDS, *TAKES), buckets)
        columns = [c for c in late.columns if c not in ("kind", "bucket", "previous_price")]
        coins = late.select("symbol").distinct()
        old = net(signed, self.series.has("undo", mb)).join(coins, "symbol", "left_semi")
        both = old.select(*columns, F.col("previous_price").alias("_was"), F.lit(False).alias("_late")).unionByName(
            late.select(*columns, F.lit(None).cast("double").alias("_was"), F.lit(True).alias("_late")))
        moved = previous_value(both, "symbol", "_batch_id", "current_price", "previous_price", list(TIEBREAK), chunk_width)
        changed = moved.filter(F.col("_late") | ~F.col("previous_price").eqNullSafe(F.col("_was")))
        # A corrected row is taken back as it was and added as it is.
        kinds = F.when(F.col("_late"), F.array(F.lit("fix"))).otherwise(F.array(F.lit("undo"), F.lit("fix")))
        rows = changed.withColumn("kind", F.explode(kinds))
        previous = F.when(F.col("kind") == "undo", F.col("_was")).otherwise(F.col("previous_price"))
        self.series.add(rows.withColumn("previous_price", previous).drop("_was", "_late"), mb)

    def _rerank(self, before: DataFrame | None, after: DataFrame, mb: int) -> None:
        changes = after.select(price_range().alias("value"), F.lit(1).alias("n"))
        if before is not None:
            changes = changes.unionByName(before.select(price_range().alias("value"), F.lit(-1).alias("n")))
        self.ranks.update(changes, mb)


def run_market_refresh(spark: SparkSession, stream: DataFrame, root: str, lateness: int = 3600, buckets: int = BUCKETS,
                       on_malformed: str = "keep", chunk_width: int | None = None, serving: bool = True) -> list[dict]:
    """Process what the stream holds into the tables under ``root``; (rows, malformed) of each micro-batch.

    Without ``serving`` only the clean series is kept (T2). The counts are observed while the micro-batch is read, not by a scan of their own.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if "_ingested_at" not in stream.columns:
        stream = stream.withColumn("_ingested_at", F.current_timestamp())
    bad = F.col("symbol").isNull() | F.col("_batch_id").isNull()
    if CORRUPT in stream.columns:
        bad = bad | F.col(CORRUPT).isNotNull()
    rounded = {c: round_half_up(c, d) for c, d in markets.PRICE_ROUNDING.items()}
    watched = stream.observe("landing", F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("malformed"))
    market = Market(spark, root, buckets, serving)
    # Timers fire with the next polls; a micro-batch without rows would only move them out of the state earlier.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        q = (signed_series(watched.withColumns(rounded), lateness).writeStream.outputMode("update")
             .foreachBatch(lambda b, i: market.refresh(b, i, on_malformed, chunk_width))
             .option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start())
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    seen = [p["observedMetrics"].get("landing") for p in q.recentProgress if p["numInputRows"]]
    return [{"rows": m["rows"], "malformed": m["malformed"]} for m in seen if m is not None]
