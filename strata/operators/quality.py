"""Data-quality checks. Every check of a table runs in one aggregate pass.

A rule is ``Rule(name, column, kind, values)`` with ``kind`` in
``not_null`` (a null fails) and ``accepted_values`` (a non-null value outside
``values`` fails; null passes). ``dq_report`` returns one row per rule with
its number of failing rows; ``gate`` raises before anything is published. ``Watch`` gathers the same
counts while a table is written, so that a gate needs no scan of its own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class QualityGateError(RuntimeError):
    pass


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    kind: str
    values: tuple = field(default_factory=tuple)

    def failing(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "accepted_values":
            return c.isNotNull() & ~c.isin(list(self.values))
        if self.kind == "not_lost":
            return F.coalesce(c, F.lit(False))
        raise ValueError(f"unknown rule kind {self.kind!r}")


def not_null(column: str) -> Rule:
    return Rule(f"not_null_{column}", column, "not_null")


def not_lost(column: str) -> Rule:
    """A boolean column that marks rows whose value was lost in parsing or casting."""
    return Rule(f"not_lost_{column.strip('_')}", column, "not_lost")


def accepted_values(column: str, values) -> Rule:
    return Rule(f"accepted_values_{column}", column, "accepted_values", tuple(values))


def dq_counts(df: DataFrame, rules) -> DataFrame:
    """One row, one column of failure counts per rule (a single scan)."""
    return df.agg(*[F.count_if(r.failing()).cast("long").alias(r.name) for r in rules])


def dq_report(df: DataFrame, rules, table: str | None = None) -> DataFrame:
    """Rows ``(rule, failures)`` (plus ``table`` when given)."""
    rules = list(rules)
    wide = dq_counts(df, rules)
    long = wide.unpivot([], [r.name for r in rules], "rule", "failures")
    if table is not None:
        long = long.select(F.lit(table).alias("table"), "rule", "failures")
    return long


def gate(report: DataFrame) -> list:
    """Raise ``QualityGateError`` when any rule failed. The report has one row
    per rule, so collecting it is bounded by the number of rules."""
    failed = [r for r in report.filter(F.col("failures") > 0).collect()]
    if failed:
        detail = ", ".join(f"{r['rule']}={r['failures']}" for r in failed)
        raise QualityGateError(f"data-quality rules failed: {detail}")
    return failed


class Watch:
    """Failure counts of rules, row count and flag counts of a table, observed while it is written.

    ``on(df)`` goes into the plan that is written; after the write ``failures``, ``rows`` and ``gate`` are
    there without another scan. ``flag`` names a boolean column whose two sides must add up to all rows.
    """

    def __init__(self, rules=(), flag: str | None = None, columns: dict[str, Column] | None = None):
        self.rules, self.flag, self.columns = list(rules), flag, columns or {}
        self.seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        counts = [F.count_if(r.failing()).cast("long").alias(r.name) for r in self.rules]
        if self.flag is not None:
            counts += [F.count_if(F.col(self.flag)).alias("_flagged"), F.count_if(~F.col(self.flag)).alias("_unflagged")]
        return df.observe(self.seen, F.count(F.lit(1)).alias("_rows"), *counts, *[c.alias(n) for n, c in self.columns.items()])

    @property
    def rows(self) -> int:
        return self.seen.get["_rows"]

    def failures(self) -> dict[str, int]:
        """Rule -> failing rows; the flag's imbalance is one more rule."""
        seen = self.seen.get
        out = {r.name: seen[r.name] for r in self.rules}
        if self.flag is not None:
            out[f"balanced_{self.flag}"] = seen["_rows"] - seen["_flagged"] - seen["_unflagged"]
        return out

    def report(self, spark, table: str | None = None) -> DataFrame:
        """The rows of ``dq_report``, from the observed counts."""
        rows = [(table, name, n) for name, n in self.failures().items()]
        out = spark.createDataFrame(rows, "table string, rule string, failures long")
        return out if table is not None else out.drop("table")

    def gate(self) -> None:
        """Raise ``QualityGateError`` when any rule failed."""
        failed = {name: n for name, n in self.failures().items() if n}
        if failed:
            raise QualityGateError("data-quality rules failed: " + ", ".join(f"{k}={n}" for k, n in failed.items()))


def reconcile_flag(df: DataFrame, flag: str) -> DataFrame:
    """One row: rows flagged, not flagged, total, and whether they add up."""
    out = df.agg(
        F.count_if(F.col(flag)).cast("long").alias("flagged"),
        F.count_if(~F.col(flag)).cast("long").alias("unflagged"),
        F.count(F.lit(1)).alias("total"),
    )
    return out.withColumn("balanced", (F.col("flagged") + F.col("unflagged")) == F.col("total"))


def gate_reconciled(df: DataFrame, flag: str) -> None:
    """Raise when flagged and unflagged rows do not add up to all rows (one row is collected)."""
    r = reconcile_flag(df, flag).first()
    if not r["balanced"]:
        raise QualityGateError(f"{flag}: {r['flagged']} + {r['unflagged']} of {r['total']} rows")


def expected_first_nulls(df: DataFrame, key: str, column: str) -> DataFrame:
    """One row: nulls in ``column``, the number of keys, and whether every key has
    exactly one null (only its first snapshot lacks a previous value)."""
    per_key = df.groupBy(key).agg(F.count_if(F.col(column).isNull()).alias("_nulls"))
    return per_key.agg(
        F.coalesce(F.sum("_nulls"), F.lit(0)).cast("long").alias("null_count"),
        F.count(F.lit(1)).alias("key_count"),
        F.coalesce(F.bool_and(F.col("_nulls") == 1), F.lit(True)).alias("as_expected"))


def profile_non_numeric(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Text values that do not match each column's numeric pattern, with counts.

    Each cell is kept only when it does not match its column's pattern; the
    columns are then unpivoted into ``(column_name, value)`` and profiled by one
    aggregate. A null cell is never reported (``rlike`` of null is null).
    """
    cols = list(patterns)
    bad = df.select(*[
        F.when(~F.col(c).cast("string").rlike(p), F.col(c).cast("string")).alias(c)
        for c, p in patterns.items()
    ])
    long = bad.unpivot([], cols, "column_name", "value").filter(F.col("value").isNotNull())
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
