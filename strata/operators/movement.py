"""Movement between consecutive snapshots of a series (previous value, change)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.numeric import change_pct, round_half_up


def _as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def previous_value(df: DataFrame, key, order, value: str, out: str = "previous_value",
                   tiebreak=None, chunk_width: int | None = None) -> DataFrame:
    """``lag(value, 1)`` per key in ``order``; null for the first snapshot.

    Without ``chunk_width`` this is one window: a shuffle by key and a sort
    within each key, so one key holding a third of all rows is one task.

    With ``chunk_width`` (in units of the first order column) the series is
    cut into chunks ``floor(order / chunk_width)`` and the work is split:

    1. ``lag`` inside each (key, chunk) - the hot key is spread over its chunks;
    2. the last value of every (key, chunk): an aggregate with map-side combine;
    3. ``lag`` over that small table per key gives, for each chunk, the last
       value of the nearest earlier non-empty chunk;
    4. the first row of each chunk takes that value (join on key and chunk,
       co-partitioned with step 1; null-safe, as a null key is a key).

    The result is identical to the plain window: the chunk is a monotone
    function of the order, so rows of earlier chunks are exactly the earlier rows.
    """
    keys = _as_list(key)
    order_cols = _as_list(order) + _as_list(tiebreak)
    if chunk_width is None:
        w = Window.partitionBy(*keys).orderBy(*order_cols)
        return df.withColumn(out, F.lag(value, 1).over(w))

    first_order = order_cols[0]
    chunk = F.floor(F.col(first_order) / F.lit(chunk_width)).cast("long")
    data = df.withColumn("_chunk", chunk)
    in_chunk = Window.partitionBy(*keys, "_chunk").orderBy(*order_cols)
    data = data.withColumns({
        out: F.lag(value, 1).over(in_chunk),
        "_first": F.row_number().over(in_chunk) == 1,
    })
    last = (df.withColumn("_chunk", chunk).groupBy(*keys, "_chunk")
            .agg(F.max_by(F.col(value), F.struct(*order_cols)).alias("_last")))
    per_key = Window.partitionBy(*keys).orderBy("_chunk")
    carried = last.select(*keys, "_chunk", F.lag("_last", 1).over(per_key).alias("_carried"))
    d, c = data.alias("d"), carried.alias("c")
    joined = d.join(c, [F.col(f"d.{k}").eqNullSafe(F.col(f"c.{k}")) for k in (*keys, "_chunk")], "left")
    previous = F.when(F.col("d._first"), F.col("c._carried")).otherwise(F.col(f"d.{out}"))
    return joined.select(*[F.col(f"d.{x}").alias(x) for x in df.columns], previous.alias(out))


def movement(df: DataFrame, key="symbol", order="_batch_id", value: str = "current_price",
             change_digits: int = 2, pct_digits: int = 4, tiebreak=None,
             previous: str = "previous_price", change: str = "batch_price_change",
             pct: str = "batch_price_change_pct", chunk_width: int | None = None) -> DataFrame:
    """Previous value, absolute change and change in percent per key.

    The lag sees ``value`` as it is in ``df``; round it first if the published
    series is rounded. A zero previous value gives a null percentage.
    """
    out = previous_value(df, key, order, value, previous, tiebreak, chunk_width)
    cur, prev = F.col(value), F.col(previous)
    return out.withColumns({
        change: round_half_up(cur - prev, change_digits),
        pct: round_half_up(change_pct(cur, prev), pct_digits),
    })
