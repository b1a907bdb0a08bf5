"""Registered market-price queries (raw snapshots from ``events``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.numeric import round_half_up
from strata.operators.aggregate import share_of_total, value_frequency, whole_total
from strata.operators.latest import latest_batch, latest_per_key
from strata.operators.quality import expected_first_nulls
from strata.operators.rank import dense_rank_desc
from strata.plans import markets
from strata.plans.registry import register
from strata.plans.sqltext import mean, rnd, with_ctes
from strata.sources.testdata import prices_raw, table


# Batch ids of the test series count each coin's polls: split the series into
# chunks of so many polls, so that no coin is a single task.
CHUNK_WIDTH = 8


def _silver(spark, sf_dir):
    return markets.silver_prices(prices_raw(spark, sf_dir), chunk_width=CHUNK_WIDTH)


# ---- SQL twins --------------------------------------------------------------
SILVER_CTES = (
    ("bronze", "prices_raw"),
    ("r", f"""
select id, symbol, name, {rnd('current_price', 2)} as current_price, market_cap, market_cap_rank,
       total_volume, {rnd('high_24h', 2)} as high_24h, {rnd('low_24h', 2)} as low_24h,
       {rnd('price_change_24h', 4)} as price_change_24h,
       {rnd('price_change_percentage_24h', 4)} as price_change_percentage_24h,
       circulating_supply, total_supply, max_supply,
       try_strptime(last_updated, '%Y-%m-%dT%H:%M:%S.%gZ') as last_updated, _batch_id
from bronze"""),
    ("m", "select *, lag(current_price) over (partition by symbol order by _batch_id) as previous_price from r"),
    ("c", f"""
select *, {rnd('current_price - previous_price', 2)} as batch_price_change,
       {rnd('(current_price - previous_price) / nullif(previous_price, 0) * 100', 4)} as batch_price_change_pct
from m"""),
    ("silver", """
select *, case when batch_price_change > 0 then 'UP' when batch_price_change < 0 then 'DOWN' else 'FLAT' end
          as price_direction,
       coalesce(abs(batch_price_change_pct) > 0.5, false) as is_volatile
from c"""),
)

LATEST_SQL = """
select symbol, name, current_price, market_cap, market_cap_rank, total_volume, high_24h, low_24h,
       price_change_24h, price_change_percentage_24h, circulating_supply
from silver where _batch_id = (select max(_batch_id) from silver)"""

SUMMARY_CTE = ("s", f"""
select symbol, name, {rnd('min(current_price)', 2)} as min_price, {rnd('max(current_price)', 2)} as max_price,
       {rnd(mean('current_price'), 2)} as avg_price,
       {rnd('max(current_price) - min(current_price)', 2)} as price_range,
       {rnd(mean('batch_price_change_pct'), 4)} as avg_batch_change_pct,
       count(case when price_direction = 'UP' then 1 end) as up_count,
       count(case when price_direction = 'DOWN' then 1 end) as down_count,
       count(case when price_direction = 'FLAT' then 1 end) as flat_count,
       count(case when is_volatile then 1 end) as volatile_batches
from silver group by symbol, name""")


@register("silver_prices", with_ctes(*SILVER_CTES, select="select * from silver"))
def q_silver_prices(spark, sf_dir):
    """Clean price series: parsed time, rounded prices, movement, direction, volatility."""
    return _silver(spark, sf_dir)


@register("parse_last_updated", with_ctes(*SILVER_CTES[:2], select="select symbol, _batch_id, last_updated from r"))
def q_parse_last_updated(spark, sf_dir):
    return _silver(spark, sf_dir).select("symbol", "_batch_id", "last_updated")


@register("lag_price", with_ctes(*SILVER_CTES[:3], select="select symbol, _batch_id, current_price, previous_price from m"))
def q_lag_price(spark, sf_dir):
    return _silver(spark, sf_dir).select("symbol", "_batch_id", "current_price", "previous_price")


@register("price_movement", with_ctes(*SILVER_CTES[:4], select="""
select symbol, _batch_id, current_price, previous_price, batch_price_change, batch_price_change_pct from c"""))
def q_price_movement(spark, sf_dir):
    return _silver(spark, sf_dir).select("symbol", "_batch_id", "current_price", "previous_price",
                                         "batch_price_change", "batch_price_change_pct")


@register("price_direction", with_ctes(*SILVER_CTES, select="""
select symbol, _batch_id, batch_price_change, price_direction from silver"""))
def q_price_direction(spark, sf_dir):
    return _silver(spark, sf_dir).select("symbol", "_batch_id", "batch_price_change", "price_direction")


@register("volatility_flag", with_ctes(*SILVER_CTES, select="""
select symbol, _batch_id, batch_price_change_pct, is_volatile from silver"""))
def q_volatility_flag(spark, sf_dir):
    return _silver(spark, sf_dir).select("symbol", "_batch_id", "batch_price_change_pct", "is_volatile")


@register("reportable_prices", with_ctes(*SILVER_CTES, select="""
select symbol, _batch_id, current_price, previous_price from silver where previous_price is not null"""))
def q_reportable_prices(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return s.filter(F.col("previous_price").isNotNull()).select("symbol", "_batch_id", "current_price",
                                                               "previous_price")


@register("gold_latest_prices", with_ctes(*SILVER_CTES, select=LATEST_SQL))
def q_gold_latest_prices(spark, sf_dir):
    """Newest batch, 12 columns (J3 + P3)."""
    return markets.gold_latest_prices(_silver(spark, sf_dir))


@register("gold_price_summary", with_ctes(*SILVER_CTES, SUMMARY_CTE, select="""
select *, cast(dense_rank() over (order by price_range desc nulls last) as integer) as volatility_rank,
       case when up_count > down_count then 'BULLISH' when down_count > up_count then 'BEARISH'
            else 'NEUTRAL' end as overall_direction
from s"""))
def q_gold_price_summary(spark, sf_dir):
    """Per-coin movement summary with a range-split dense rank."""
    return markets.gold_price_summary(_silver(spark, sf_dir))


DOMINANCE_SQL = f"""
select symbol, name, market_cap,
       {rnd('market_cap / nullif((select sum(market_cap) from latest), 0) * 100', 4)} as market_cap_share_pct,
       market_cap_rank, current_price, total_volume
from latest"""


@register("gold_market_dominance", with_ctes(*SILVER_CTES, ("latest", LATEST_SQL), select=DOMINANCE_SQL))
def q_gold_market_dominance(spark, sf_dir):
    """Share of the newest batch's total market cap (scalar subquery, no collect)."""
    return markets.gold_market_dominance(markets.gold_latest_prices(_silver(spark, sf_dir)))


@register("market_share", with_ctes(("bronze", "prices_raw"), select=f"""
select symbol, _batch_id, market_cap,
       {rnd('market_cap / nullif((select sum(market_cap) from bronze), 0) * 100', 4)} as share_pct
from bronze"""))
def q_market_share(spark, sf_dir):
    """Share of total over the whole raw table (J4 / D16 on all rows)."""
    b = prices_raw(spark, sf_dir).select("symbol", "_batch_id", "market_cap")
    return share_of_total(b, "market_cap", "share_pct", digits=4)


@register("price_range_by_symbol", with_ctes(*SILVER_CTES, select=f"""
select symbol, count(*) as batches, min(current_price) as min_price, max(current_price) as max_price,
       {rnd('max(current_price) - min(current_price)', 2)} as price_range
from silver group by symbol"""))
def q_price_range_by_symbol(spark, sf_dir):
    return markets.price_range_by_symbol(_silver(spark, sf_dir))


@register("direction_counts", with_ctes(*SILVER_CTES, select="""
select price_direction, count(*) as count from silver group by price_direction"""))
def q_direction_counts(spark, sf_dir):
    """Value frequency of the direction label (A12)."""
    return value_frequency(_silver(spark, sf_dir), "price_direction")


@register("batch_audit", with_ctes(("bronze", "prices_raw"), select="""
select _batch_id, count(*) as rows, min(_ingested_at) as ingested_at from bronze
group by _batch_id order by ingested_at desc, _batch_id desc limit 5"""))
def q_batch_audit(spark, sf_dir):
    """Newest five batches with their row counts (a top-k report)."""
    return markets.batch_audit(prices_raw(spark, sf_dir))


@register("global_max_batch", with_ctes(("bronze", "prices_raw"), select="""
select max(_batch_id) as max_batch_id, cast(sum(cast(market_cap as decimal(38,0))) as double) as total_market_cap
from bronze"""))
def q_global_max_batch(spark, sf_dir):
    b = prices_raw(spark, sf_dir)
    return b.agg(F.max("_batch_id").alias("max_batch_id"),
                 whole_total("market_cap").cast("double").alias("total_market_cap"))


@register("row_count", with_ctes(("bronze", "prices_raw"), select="select count(*) as row_count from bronze"))
def q_row_count(spark, sf_dir):
    return prices_raw(spark, sf_dir).agg(F.count(F.lit(1)).alias("row_count"))


@register("latest_per_key", with_ctes(*SILVER_CTES, select="""
select symbol, _batch_id, current_price, previous_price from (
  select *, row_number() over (partition by symbol order by _batch_id desc) as rn from silver) x
where rn = 1"""))
def q_latest_per_key(spark, sf_dir):
    """Newest row of every coin, also for coins absent from the newest batch."""
    s = _silver(spark, sf_dir).select("symbol", "_batch_id", "current_price", "previous_price")
    return latest_per_key(s, "symbol", "_batch_id")


@register("latest_batch_rows", with_ctes(("bronze", "prices_raw"), select="""
select symbol, _batch_id, current_price from bronze where _batch_id = (select max(_batch_id) from bronze)"""))
def q_latest_batch_rows(spark, sf_dir):
    return latest_batch(prices_raw(spark, sf_dir).select("symbol", "_batch_id", "current_price"))


@register("first_batch_nulls", with_ctes(*SILVER_CTES, select="""
select cast(count(*) filter (where previous_price is null) as bigint) as null_count,
       count(distinct symbol) as key_count,
       (select bool_and(n = 1) from (
          select symbol, count(*) filter (where previous_price is null) as n from silver group by symbol) k) as as_expected
from silver"""))
def q_first_batch_nulls(spark, sf_dir):
    """Expected-null check: exactly one missing previous price per coin."""
    return expected_first_nulls(_silver(spark, sf_dir), "symbol", "previous_price")


@register("dense_rank_scaled", f"""
select l_orderkey, l_linenumber, l_extendedprice,
       dense_rank() over (order by {rnd('l_extendedprice', 0)} desc nulls last) as price_rank
from lineitem""")
def q_dense_rank_scaled(spark, sf_dir):
    """Range-split dense rank over every lineitem row (no single-partition window)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    li = li.withColumn("_v", round_half_up("l_extendedprice", 0))
    return dense_rank_desc(li, "_v", "price_rank").drop("_v")


@register("volatile_batches", with_ctes(*SILVER_CTES, select="""
select name, symbol, _batch_id, current_price, batch_price_change_pct from silver where is_volatile"""))
def q_volatile_batches(spark, sf_dir):
    """Batches whose move exceeds the volatility threshold (boolean filter, P8)."""
    s = _silver(spark, sf_dir)
    return s.filter(F.col("is_volatile")).select("name", "symbol", "_batch_id", "current_price",
                                                 "batch_price_change_pct")
