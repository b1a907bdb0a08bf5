"""Aggregation operators: conditional pivots, shares, frequencies, modes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.numeric import exact_sum, round_half_up, share_pct

WHOLE_TYPE = "decimal(38,0)"


def conditional_sum_pivot(df: DataFrame, keys, spec) -> DataFrame:
    """Rows to fixed columns in one aggregate pass.

    ``spec`` is a list of ``(out_name, condition Column, value column)``; each
    output is ``sum(case when condition then value else 0 end)``. Unlike
    ``.pivot()`` the output schema is fixed and needs no distinct-values job.
    """
    aggs = []
    for name, cond, value in spec:
        v = F.col(value) if isinstance(value, str) else value
        aggs.append(exact_sum(F.when(cond, v).otherwise(F.lit(0))).alias(name))
    return df.groupBy(*keys).agg(*aggs)


def whole_total(c) -> Column:
    """Sum of whole numbers without the range of bigint."""
    return F.sum((F.col(c) if isinstance(c, str) else c).cast(WHOLE_TYPE))


def total_of(df: DataFrame, value: str) -> Column:
    whole = isinstance(df.schema[value].dataType, T.IntegralType)
    return whole_total(value).cast("double") if whole else exact_sum(value)


def share_of_total(df: DataFrame, value: str, out: str, digits: int = 4) -> DataFrame:
    """``value / sum(value) * 100`` rounded; the total is a scalar subquery
    (computed once, no driver round trip). Whole numbers are summed as wide
    decimals, so no history is too long for the total."""
    total = df.agg(total_of(df, value)).scalar()
    return df.withColumn(out, round_half_up(share_pct(F.col(value), total), digits))


def value_frequency(df: DataFrame, column: str, out: str = "count") -> DataFrame:
    """Distinct values of a column with their row counts (partial + final aggregate)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(out))


def most_common(column: str) -> Column:
    """Most frequent non-null value; a tie goes to the smallest value.

    Spark's ``mode`` keeps a count per distinct value in the aggregation
    buffer, so use it on categorical columns (a handful of labels).
    """
    return F.mode(F.col(column), deterministic=True)


def count_when(cond: Column) -> Column:
    """Number of rows where ``cond`` is true (null counts as false)."""
    return F.count(F.when(cond, F.lit(1)))
