"""String parsing into timestamps and dates.

All parsers are the ``try_`` forms: under ANSI mode a malformed string would
otherwise fail the whole job, and a null is what the published tables expect.
Timestamps are produced as ``timestamp_ntz`` (wall-clock UTC) so that a value
read from ``...Z`` text does not shift with the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the sources.
SNAPSHOT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
PERIOD_FORMAT = "yyyy-MM-dd'T'HH:mm"
US_DATE_FORMAT = "MM/dd/yyyy"
ISO_DATE_FORMAT = "yyyy-MM-dd"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def parse_snapshot_time(c, fmt: str = SNAPSHOT_TIME_FORMAT) -> Column:
    """``2024-01-01T10:00:00.000Z`` -> timestamp; malformed -> null."""
    return to_ntz(F.try_to_timestamp(_col(c), F.lit(fmt)))


def parse_period(c, fmt: str = PERIOD_FORMAT) -> Column:
    """Strip a trailing ``Z``, then parse at minute precision."""
    return to_ntz(F.try_to_timestamp(F.regexp_replace(_col(c), "Z$", ""), F.lit(fmt)))


# Shape of the text each date format accepts; the parser is only called on a
# matching string, because a failed ``try_to_date`` costs a caught exception.
DATE_SHAPES = {
    US_DATE_FORMAT: r"^\d{1,2}/\d{1,2}/\d{4}$",
    ISO_DATE_FORMAT: r"^\d{4}-\d{1,2}-\d{1,2}$",
}


def parse_mixed_date(c, formats=(US_DATE_FORMAT, ISO_DATE_FORMAT), dtype=None) -> Column:
    """A date column that may already be a date, or text in one of ``formats``.

    Pass ``dtype`` (the column's Spark type) to let a real ``date`` column
    through untouched."""
    from pyspark.sql import types as T
    if isinstance(dtype, T.DateType):
        return _col(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return _col(c).cast("date")
    text = _col(c).cast("string")
    expr = None
    for fmt in formats:
        shape = DATE_SHAPES.get(fmt)
        parsed = F.try_to_date(text, fmt)
        cond = text.rlike(shape) if shape else F.lit(True)
        expr = F.when(cond, parsed) if expr is None else expr.when(cond, parsed)
    return expr
