"""Global ranks (``rank`` / ``dense_rank`` over the whole table) without a single-task window.

A window with ``orderBy`` and no ``partitionBy`` moves every row to one task.
Here the distinct values are ranked, range by range:

1. collapse the input to its distinct values with their row counts (an
   aggregate with map-side combine, so a value held by a third of all rows is a
   single row from here on);
2. shuffle them by range and store them once with the number of their
   partition: ranges follow the values' own distribution, and their number follows
   the data (``spark.sql.shuffle.partitions``, coalesced by AQE to the advisory size);
3. number them inside each range with one window;
4. add the values and rows of all lower ranges, from a table of one row
   per range;
5. join the rank back on the value (null-safe; AQE broadcasts it when small and
   splits skewed partitions when not).

One form serves all sizes. Both directions, dense or not, come from the same pass: the
descending rank is the ascending one counted from the total. The input is read
twice, the distinct values are computed once; a caller with a costly input stores it first
(``sources.files.stored``), as the serving tables do. Nulls are one extra value: first for
ascending and last for descending order, as Spark orders them by default; NaN is above
every number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.sources.files import stored


def value_ranks(df: DataFrame, value: str, ranks: dict[str, tuple[bool, bool]]) -> DataFrame:
    """Distinct values of ``value`` (including null) with global ranks (bigint): column -> (ascending, dense).

    Runs one job, which stores the distinct values with their ranges.
    """
    counted = df.groupBy(value).agg(F.count(F.lit(1)).alias("_rows"))
    values = stored(counted.repartitionByRange(value).withColumn("_range", F.spark_partition_id()), "rank-values")

    lower = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    whole = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sizes = values.groupBy("_range").agg(F.count(F.lit(1)).alias("_n_values"), F.sum("_rows").alias("_n_rows"))
    offsets = sizes.select(
        "_range",
        F.coalesce(F.sum("_n_values").over(lower), F.lit(0)).alias("_values_below"),
        F.coalesce(F.sum("_n_rows").over(lower), F.lit(0)).alias("_rows_below"),
        F.sum("_n_values").over(whole).alias("_all_values"), F.sum("_n_rows").over(whole).alias("_all_rows"))

    inside = Window.partitionBy("_range").orderBy(F.col(value).asc())
    placed = values.withColumns({
        "_at": F.row_number().over(inside),
        "_upto": F.sum("_rows").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    }).join(F.broadcast(offsets), "_range")
    nth, upto = F.col("_values_below") + F.col("_at"), F.col("_rows_below") + F.col("_upto")
    forms = {(True, True): nth, (False, True): F.col("_all_values") - nth + 1,
             (True, False): upto - F.col("_rows") + 1, (False, False): F.col("_all_rows") - upto + 1}
    return placed.select(value, *[forms[form].cast("long").alias(out) for out, form in ranks.items()])


def global_ranks(df: DataFrame, value: str, ranks: dict[str, tuple[bool, bool]]) -> DataFrame:
    """Add several ranks of one column over the whole DataFrame: column -> (ascending, dense)."""
    found = value_ranks(df, value, ranks)
    return (df.alias("l")
            .join(found.alias("r"), F.col(f"l.{value}").eqNullSafe(F.col(f"r.{value}")), "left")
            .select(*[F.col(f"l.{c}") for c in df.columns], *[F.col(f"r.{c}") for c in ranks]))


def global_rank(df: DataFrame, value: str, out: str, ascending: bool = False, dense: bool = True) -> DataFrame:
    """Add ``out`` (bigint) = (dense_)rank of ``value`` over the whole DataFrame."""
    return global_ranks(df, value, {out: (ascending, dense)})


def dense_rank_desc(df: DataFrame, value: str, out: str) -> DataFrame:
    """Dense rank, largest value first, nulls last."""
    return global_rank(df, value, out, ascending=False, dense=True)
