"""Market prices: raw snapshots -> clean series with movements -> serving tables.

Grain of the clean table: one row per coin and batch (all history). The
serving tables are the newest snapshot, a movement summary per coin and the
market-cap share of each coin in the newest batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.classify import is_volatile, overall_direction, price_direction
from strata.functions.numeric import exact_avg, round_half_up
from strata.functions.parse import parse_snapshot_time
from strata.operators.aggregate import count_when, share_of_total
from strata.operators.latest import latest_batch
from strata.operators.movement import movement
from strata.operators.rank import dense_rank_desc
from strata.sources.files import stored
from strata.sources.sinks import stamp_processed

# Rounding of the published clean table (column -> fraction digits).
PRICE_ROUNDING = {
    "current_price": 2,
    "price_change_24h": 4,
    "price_change_percentage_24h": 4,
    "high_24h": 2,
    "low_24h": 2,
}

# Columns of the published serving tables.
LATEST_COLUMNS = [
    "symbol", "name", "current_price", "market_cap", "market_cap_rank", "total_volume",
    "high_24h", "low_24h", "price_change_24h", "price_change_percentage_24h",
    "circulating_supply", "_ingested_at",
]

DOMINANCE_COLUMNS = [
    "symbol", "name", "market_cap", "market_cap_share_pct", "market_cap_rank",
    "current_price", "total_volume",
]


def silver_prices(bronze: DataFrame, key: str = "symbol", order: str = "_batch_id",
                  volatility_threshold: float = 0.5, rounding: dict | None = PRICE_ROUNDING,
                  tiebreak=None, chunk_width: int | None = None) -> DataFrame:
    """Parse times, round prices, then add the movement against the previous
    batch of the same coin. The lag sees the rounded price (as published).

    ``chunk_width`` (in batch-id units, e.g. 86400 for unix-second batch ids
    and daily chunks) splits each coin's series so that a coin with a large
    share of all rows is spread over many tasks; the result is unchanged."""
    rounding = rounding or {}
    df = bronze.withColumns({
        "last_updated": parse_snapshot_time("last_updated"),
        **{c: round_half_up(c, d) for c, d in rounding.items()},
    })
    df = movement(df, key=key, order=order, value="current_price", change_digits=2, pct_digits=4,
                  tiebreak=tiebreak, chunk_width=chunk_width)
    df = df.withColumns({
        "price_direction": price_direction("batch_price_change"),
        "is_volatile": is_volatile("batch_price_change_pct", volatility_threshold),
    })
    return stamp_processed(df, "_silver_processed_at")


def gold_latest_prices(silver: DataFrame, order: str = "_batch_id", partition: str | None = None) -> DataFrame:
    """Newest batch only, 12 columns."""
    latest = latest_batch(silver, order, partition).select(*LATEST_COLUMNS)
    return stamp_processed(latest, "_gold_processed_at")


def gold_price_summary(silver: DataFrame, exclude_first: bool = False) -> DataFrame:
    """Per coin: price range and average, average move, direction counts,
    a dense rank by range (largest first) and an overall direction.

    All history counts, so each coin's first batch is a FLAT move; with
    ``exclude_first=True`` rows without a previous price are left out.
    """
    df = silver.filter(F.col("previous_price").isNotNull()) if exclude_first else silver
    price, direction = F.col("current_price"), F.col("price_direction")
    summary = df.groupBy("symbol", "name").agg(
        round_half_up(F.min(price), 2).alias("min_price"),
        round_half_up(F.max(price), 2).alias("max_price"),
        round_half_up(exact_avg(price), 2).alias("avg_price"),
        round_half_up(F.max(price) - F.min(price), 2).alias("price_range"),
        round_half_up(exact_avg("batch_price_change_pct"), 4).alias("avg_batch_change_pct"),
        count_when(direction == "UP").alias("up_count"),
        count_when(direction == "DOWN").alias("down_count"),
        count_when(direction == "FLAT").alias("flat_count"),
        count_when(F.col("is_volatile")).alias("volatile_batches"),
    )
    ranked = dense_rank_desc(stored(summary, "price-summary"), "price_range", "volatility_rank")
    ranked = ranked.withColumns({"volatility_rank": F.col("volatility_rank").cast("int"),
                                 "overall_direction": overall_direction("up_count", "down_count")})
    return stamp_processed(ranked, "_gold_processed_at")


def gold_market_dominance(latest: DataFrame) -> DataFrame:
    """Share of each coin in the total market cap of the newest batch."""
    shared = share_of_total(latest, "market_cap", "market_cap_share_pct", digits=4)
    return stamp_processed(shared.select(*DOMINANCE_COLUMNS), "_gold_processed_at")


def price_range_by_symbol(silver: DataFrame) -> DataFrame:
    """Batches, lowest, highest price and range per coin (clean-table audit)."""
    p = F.col("current_price")
    return silver.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("batches"),
        F.min(p).alias("min_price"),
        F.max(p).alias("max_price"),
        round_half_up(F.max(p) - F.min(p), 2).alias("price_range"),
    )


def batch_audit(bronze: DataFrame, newest: int = 5) -> DataFrame:
    """Rows and first ingest time of the newest batches (a top-k report)."""
    return (bronze.groupBy("_batch_id")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("_ingested_at").alias("ingested_at"))
            .orderBy(F.col("ingested_at").desc(), F.col("_batch_id").desc())
            .limit(newest))
