"""Cleaning operators: renaming, sentinel handling, typed casts, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.classify import any_of

# The text a publisher writes instead of a number it suppresses.
SUPPRESSED_VALUES = ["Too Few to Report", "N/A", "Not Available", " N/A"]


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename several columns in one projection; unknown names are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def snake_case_names(names) -> dict[str, str]:
    """``"Number of Discharges"`` -> ``"number_of_discharges"`` for each name;
    a name that is already snake_case (metadata such as ``_source_file``)
    is kept as it is."""
    out = {}
    for name in names:
        if name and all(ch.islower() or ch.isdigit() or ch == "_" for ch in name):
            out[name] = name
            continue
        words = "".join(ch if ch.isalnum() else " " for ch in name).split()
        out[name] = "_".join(w.lower() for w in words)
    return out


def flag_suppressed(df: DataFrame, columns, sentinels=SUPPRESSED_VALUES,
                    out: str = "is_suppressed") -> DataFrame:
    """Add a boolean: true when any of ``columns`` holds a sentinel.

    A null cell is not a sentinel, so a row whose checked cells are all null is
    not suppressed (``coalesce(..., false)``).
    """
    cond = any_of([F.col(c).isin(list(sentinels)) for c in columns])
    return df.withColumn(out, F.coalesce(cond, F.lit(False)))


def null_sentinels(df: DataFrame, columns, sentinels=SUPPRESSED_VALUES) -> DataFrame:
    """Replace sentinel text by null in ``columns`` (one projection)."""
    return df.withColumns({c: F.when(~F.col(c).isin(list(sentinels)), F.col(c)) for c in columns})


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns with ``try_cast``: a value that does not parse becomes null
    instead of failing the job under ANSI mode."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def cast_losses(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """One row: for each column, how many non-null values a cast would turn into null."""
    return df.agg(*[
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"{c}_lost")
        for c, t in types.items()
    ])


def trim_columns(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.trim(F.col(c)) for c in columns})


def upper_trim_columns(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: F.trim(F.upper(F.col(c))) for c in columns})


def dedupe_natural_key(df: DataFrame, keys, order_by) -> DataFrame:
    """Keep one row per natural key: the first in ``order_by`` (ascending).

    All other columns are the last tie-break, so the survivor is the same on
    every run and every partitioning, unlike ``dropDuplicates``. One ``min`` of
    the row as an ordered struct - an aggregate with map-side combine, so a key
    with a third of all rows is reduced to one row per task before the shuffle.
    Null keys form their own group, like ``dropDuplicates``.
    """
    keys = list(keys)
    order_by = [c for c in ([order_by] if isinstance(order_by, str) else order_by) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    row = F.struct(*order_by, *rest)
    return df.groupBy(*keys).agg(F.min(row).alias("_r")).select(
        *[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def duplicate_count(df: DataFrame, keys, out: str = "duplicates_removed") -> DataFrame:
    """One row: rows minus distinct keys (null keys count as one group)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg((F.sum("_n") - F.count(F.lit(1))).alias(out))
