"""Latest-state selection: newest batch of a table, newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_batch(df: DataFrame, order: str = "_batch_id", partition: str | None = None) -> DataFrame:
    """Rows of the newest batch (``order == max(order)``).

    ``partition`` names a partition column of the table that never decreases
    with ``order`` (a day): the newest partition is found from the partition
    values first, so the files of all others are pruned.

    The maximum is a scalar subquery: computed once by the engine, never
    collected to the driver, and pushed into the Parquet scan as a runtime
    filter, so row groups of older batches are skipped. A key missing from
    the newest batch is absent here; see ``latest_per_key``.
    """
    if partition is not None:
        df = df.filter(F.col(partition) == df.agg(F.max(partition)).scalar())
    newest = df.agg(F.max(order)).scalar()
    return df.filter(F.col(order) == newest)


def latest_per_key(df: DataFrame, keys, order) -> DataFrame:
    """Newest row of every key (``max_by(row, order)``), also for keys that
    stopped appearing. An aggregate with map-side combine (partial
    aggregation), so a hot key is reduced to one row per task before the
    shuffle; Spark runs it sort-based when the row holds strings."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_cols = [order] if isinstance(order, str) else list(order)
    row = F.struct(*[F.col(c) for c in df.columns])
    return (df.groupBy(*keys).agg(F.max_by(row, F.struct(*order_cols)).alias("_r"))
            .select(*[F.col(f"_r.{c}").alias(c) for c in df.columns]))
