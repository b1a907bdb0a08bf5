"""Named queries over the test tables, each with an independent SQL twin.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame built by the package's
operators from the Parquet tables in ``sf_dir``. ``ORACLE_SQL[name]`` is the
same result written as portable SQL against views named after those tables.
Processing-time columns (``_..._at``) are dropped from every result because
they differ between runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.sources.sinks import drop_processing_times

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a query (and its SQL twin, when it has one)."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return drop_processing_times(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from strata.plans import (  # noqa: F401
        queries_carbon, queries_markets, queries_misc, queries_readmissions, queries_stream,
    )
