"""Numeric column helpers: half-up rounding, exact sums and averages, guarded division, changes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums and averages of measured values are taken in exact decimal arithmetic, so
# that they do not depend on the order in which partitions are combined.
EXACT_TYPE = "decimal(38,12)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, digits: int | None) -> Column:
    """Round once to ``digits`` fraction digits, half away from zero, as a double.

    Spark rounds the shortest decimal text of the double, so 1.005 gives 1.01
    and 1.0049999996 gives 1.0. NaN and infinities stay; ``None`` leaves the
    value alone.
    """
    x = _col(c).cast("double")
    return x if digits is None else F.round(x, digits)


def exact_sum(c) -> Column:
    """Sum as a double, independent of the order of rows.

    Values that the exact type cannot hold (NaN, infinities, 1e26 and beyond)
    and sums that leave it are summed as doubles.
    """
    c = _col(c)
    exact = c.try_cast(EXACT_TYPE)
    return F.when(F.count(exact) == F.count(c), F.coalesce(F.try_sum(exact).cast("double"), F.sum(c.cast("double")))) \
        .otherwise(F.sum(c.cast("double")))


def exact_avg(c) -> Column:
    """Average from the exact sum and the count; null without values."""
    c = _col(c)
    return exact_sum(c) / F.nullif(F.count(c), F.lit(0))


def safe_divide(numerator, denominator) -> Column:
    """``numerator / denominator``, null when the divisor is 0 or null.

    Under ANSI mode a plain division by zero raises; ``-0.0`` counts as zero.
    """
    return _col(numerator) / F.nullif(_col(denominator), F.lit(0))


def change(current, previous) -> Column:
    return _col(current) - _col(previous)


def change_pct(current, previous) -> Column:
    """Relative change in percent: ``(current - previous) / previous * 100``."""
    return safe_divide(_col(current) - _col(previous), previous) * F.lit(100)


def share_pct(part, total) -> Column:
    """``part / total * 100``, null for a zero total."""
    return safe_divide(part, total) * F.lit(100)
