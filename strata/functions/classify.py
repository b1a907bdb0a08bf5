"""Rule-based labels as column expressions (first matching rule wins).

Each function returns a ``Column``; the rules are plain ``CASE WHEN`` chains so
they stay inside whole-stage code generation. Nulls fall to the ``otherwise``
branch, exactly like a SQL ``CASE`` without a matching ``WHEN``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. These must equal the published rules for equal results.
# ---------------------------------------------------------------------------
# Price direction labels and the volatility threshold (percent, strict >).
UP, DOWN, FLAT = "UP", "DOWN", "FLAT"
VOLATILITY_THRESHOLD_PCT = 0.5
# Overall direction of a coin from its counts of up and down moves.
BULLISH, BEARISH, NEUTRAL = "BULLISH", "BEARISH", "NEUTRAL"
# Readmission risk tiers on the rounded average excess ratio (>=), and the
# penalty threshold (strict >).
RISK_TIERS = (("High", 1.2), ("Medium", 1.0))
RISK_TIER_DEFAULT = "Low"
PENALTY_THRESHOLD = 1.0
# Region ids: 1 to 14 are granular regions; 15 to 18 are aggregates with fixed labels.
GRANULAR_REGION_RANGE = (1, 14)
REGION_LABELS = {15: "England", 16: "Scotland", 17: "Wales", 18: "GB"}
# Fuel categories, first match wins; anything else is "other".
FUEL_CATEGORIES = (
    ("renewable", ("wind", "solar", "hydro")),
    ("low_carbon", ("nuclear", "biomass")),
    ("fossil", ("gas", "coal")),
    ("imports", ("imports",)),
)
FUEL_CATEGORY_DEFAULT = "other"
# Time-of-day periods by hour, bounds included, first match wins.
TIME_PERIODS = (
    ("morning_peak", 7, 9),
    ("evening_peak", 17, 20),
    ("overnight", 23, 6),
)
TIME_PERIOD_DEFAULT = "daytime"
# Weekend days in Spark numbering (1 = Sunday, 7 = Saturday).
WEEKEND_DAYS = (1, 7)
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_direction(change) -> Column:
    """UP for a positive change, DOWN for a negative one, else FLAT (also for null)."""
    c = _col(change)
    return F.when(c > 0, F.lit(UP)).when(c < 0, F.lit(DOWN)).otherwise(F.lit(FLAT))


def is_volatile(change_pct, threshold: float = VOLATILITY_THRESHOLD_PCT) -> Column:
    """True when ``|change_pct| > threshold``; false for null."""
    return F.coalesce(F.abs(_col(change_pct)) > F.lit(threshold), F.lit(False))


def overall_direction(up_count, down_count) -> Column:
    up, down = _col(up_count), _col(down_count)
    return (F.when(up > down, F.lit(BULLISH))
            .when(down > up, F.lit(BEARISH))
            .otherwise(F.lit(NEUTRAL)))


def risk_tier(ratio, tiers=RISK_TIERS, default: str = RISK_TIER_DEFAULT) -> Column:
    """Highest tier whose lower bound (>=) the ratio reaches; null gives the default."""
    r = _col(ratio)
    expr = None
    for label, bound in tiers:
        expr = (F.when(r >= F.lit(bound), F.lit(label)) if expr is None
                else expr.when(r >= F.lit(bound), F.lit(label)))
    return expr.otherwise(F.lit(default))


def penalty_flag(ratio, threshold: float = PENALTY_THRESHOLD) -> Column:
    """True when the ratio is strictly above the threshold; null gives false."""
    return F.coalesce(_col(ratio) > F.lit(threshold), F.lit(False))


def region_type(region_id, granular=GRANULAR_REGION_RANGE) -> Column:
    lo, hi = granular
    return F.when(_col(region_id).between(lo, hi), F.lit("granular")).otherwise(F.lit("aggregate"))


def region_label(region_id, short_name, labels=REGION_LABELS) -> Column:
    rid = _col(region_id)
    expr = None
    for key, label in labels.items():
        expr = (F.when(rid == F.lit(key), F.lit(label)) if expr is None
                else expr.when(rid == F.lit(key), F.lit(label)))
    return expr.otherwise(_col(short_name))


def fuel_category(fuel, categories=FUEL_CATEGORIES, default: str = FUEL_CATEGORY_DEFAULT) -> Column:
    f = _col(fuel)
    expr = None
    for label, fuels in categories:
        cond = f.isin(list(fuels))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def _hour_in(hour: Column, lo: int, hi: int, wrap_midnight: bool) -> Column:
    if lo <= hi:
        return hour.between(lo, hi)
    if wrap_midnight:
        # The documented intent of a range such as 23..6: it crosses midnight.
        return (hour >= lo) | (hour <= hi)
    # As published: BETWEEN with lo > hi never matches.
    return hour.between(lo, hi)


def time_period(hour, periods=TIME_PERIODS, default: str = TIME_PERIOD_DEFAULT,
                wrap_midnight: bool = False) -> Column:
    """Label an hour of day. ``wrap_midnight=False`` keeps the published rule,
    under which the ``23..6`` range is empty and 'overnight' never appears."""
    h = _col(hour)
    expr = None
    for label, lo, hi in periods:
        cond = _hour_in(h, lo, hi, wrap_midnight)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def day_type(day_of_week, weekend=WEEKEND_DAYS) -> Column:
    return F.when(_col(day_of_week).isin(list(weekend)), F.lit("weekend")).otherwise(F.lit("weekday"))


def any_of(conditions) -> Column:
    """Disjunction of several boolean columns."""
    return reduce(lambda a, b: a | b, conditions)
