"""Helpers for writing the portable SQL twins of the queries."""

from __future__ import annotations

from strata.sources.testdata import ADAPTER_SQL


def rnd(expr: str, digits: int) -> str:
    """Half-up rounding of the decimal text of a double, back to double."""
    return f"cast(round(cast(cast({expr} as varchar) as decimal(38,20)), {digits}) as double)"


def exact_sum(expr: str) -> str:
    """Sum in decimal(38,12), back to double."""
    return f"cast(sum(cast({expr} as decimal(38,12))) as double)"


def mean(expr: str) -> str:
    """Average from the exact sum and the count."""
    return f"{exact_sum(expr)} / nullif(count({expr}), 0)"


def with_ctes(*ctes: tuple[str, str], select: str) -> str:
    """``with a as (...), b as (...) select ...``; adapter names resolve to their SQL."""
    parts = []
    for name, body in ctes:
        body = ADAPTER_SQL.get(body, body)
        parts.append(f"{name} as ({body.strip()})")
    return "with " + ",\n".join(parts) + "\n" + select.strip()
