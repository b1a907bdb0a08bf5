"""Reference-shaped raw tables derived from the driver's test tables.

The benchmark tables (``events``, ``lineitem`` ...) are not market snapshots,
carbon documents or readmission files. Each function below turns them into a
raw table of the shape our operators expect; the same derivation exists as
portable SQL (``ADAPTER_SQL``) so that an independent engine can build the
identical input. Everything stays lazy and distributed; column selection and
filters reach the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _iso_minute(ts) -> F.Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm"), F.lit("Z"))


def prices_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market snapshots: every event is a poll of one coin (its user); the batch
    id counts the polls of the coin. Lazy: a query reads only the columns it uses."""
    polls = Window.partitionBy("user_id").orderBy("event_id")
    snap = table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("symbol"), "ts", "value",
        (F.col("event_id") % 250 + 1).cast("int").alias("market_cap_rank"),
        F.row_number().over(polls).cast("bigint").alias("batch_id"))
    v = F.col("value")
    return snap.select(
        F.col("symbol").alias("id"),
        "symbol",
        F.concat(F.lit("Coin "), F.col("symbol")).alias("name"),
        v.alias("current_price"),
        F.floor(v * 1000).cast("bigint").alias("market_cap"),
        "market_cap_rank",
        F.floor(v * 10).cast("bigint").alias("total_volume"),
        (v + F.lit(1.2345)).alias("high_24h"),
        (v * F.lit(0.9)).alias("low_24h"),
        (v - F.lit(49.12345)).alias("price_change_24h"),
        (v / F.lit(7)).alias("price_change_percentage_24h"),
        (v * F.lit(1000000)).alias("circulating_supply"),
        (v * F.lit(2000000)).alias("total_supply"),
        F.lit(None).cast("double").alias("max_supply"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z")).alias("last_updated"),
        F.col("ts").alias("_ingested_at"),
        F.col("batch_id").alias("_batch_id"),
    )


def _region_id() -> F.Column:
    return (F.col("user_id") % 18 + 1)


def generation_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation mix rows (region x fuel x hour); repeated polls are kept."""
    e = table(spark, sf_dir, "events")
    hour = F.date_trunc("hour", "ts")
    rid = _region_id()
    fuel = (F.when(F.col("event_type") == "view", "wind")
            .when(F.col("event_type") == "click", "solar")
            .when(F.col("event_type") == "purchase", "gas")
            .when(F.col("event_type") == "signup", "nuclear")
            .otherwise("imports"))
    return e.select(
        rid.alias("region_id"),
        F.concat(F.lit("Region "), rid.cast("string")).alias("short_name"),
        fuel.alias("fuel_type"),
        F.col("value").alias("percentage"),
        _iso_minute(hour).alias("period_from"),
        _iso_minute(hour + F.expr("INTERVAL 1 HOUR")).alias("period_to"),
        F.col("event_id").alias("batch_id"),
        F.col("ts").alias("_ingested_at"),
    )


def intensity_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carbon intensity rows (region x period). Clicks make periods of their own, half
    an hour earlier, which have no generation mix."""
    e = table(spark, sf_dir, "events")
    hour = F.date_trunc("hour", "ts")
    period = F.when(F.col("event_type") == "click", hour - F.expr("INTERVAL 30 MINUTES")).otherwise(hour)
    agg = (e.groupBy(_region_id().alias("region_id"), period.alias("p"))
           .agg(F.max("value").alias("v"), F.max("event_id").alias("batch_id"),
                F.max("ts").alias("ingested")))
    v = F.col("v")
    index = (F.when(v < 20, "very low").when(v < 40, "low").when(v < 80, "moderate")
             .when(v < 160, "high").otherwise("very high"))
    return agg.select(
        "region_id",
        F.concat(F.lit("Region "), F.col("region_id").cast("string")).alias("short_name"),
        F.concat(F.lit("DNO "), F.col("region_id").cast("string")).alias("dno_region"),
        v.alias("intensity_forecast"),
        index.alias("intensity_index"),
        _iso_minute(F.col("p")).alias("period_from"),
        _iso_minute(F.col("p") + F.expr("INTERVAL 1 HOUR")).alias("period_to"),
        "batch_id",
        F.col("ingested").alias("_ingested_at"),
    )


def hrrp_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readmission rows with sentinels, padded names and duplicate natural keys.

    Joins: ``nation`` has 25 rows at every scale factor (broadcast); the
    ``part`` and ``supplier`` joins are left to the planner (AQE broadcasts
    them at runtime when they are small, sort-merge otherwise).
    """
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (li.join(part, li.l_partkey == part.p_partkey)
         .join(sup, li.l_suppkey == sup.s_suppkey)
         .join(F.broadcast(nat), sup.s_nationkey == nat.n_nationkey))
    q, flag, status = F.col("l_quantity"), F.col("l_returnflag"), F.col("l_linestatus")
    disc = F.round(F.col("l_discount") * 100).cast("int").cast("string")
    qty = q.cast("int").cast("string")
    rate = lambda base: F.when(q < 6, "N/A").otherwise(
        F.concat((F.lit(base) + F.col("l_linenumber")).cast("string"), F.lit("."), F.lpad(qty, 2, "0")))
    return j.select(
        F.col("l_suppkey").alias("facility_id"),
        F.concat(F.lit(" "), F.col("s_name"), F.lit(" ")).alias("facility_name"),
        F.concat(F.lower("n_name"), F.lit(" ")).alias("state"),
        F.col("p_type").alias("measure_name"),
        F.when(q < 6, "Too Few to Report").when((flag == "N") & (q < 20), " N/A").otherwise(qty)
        .alias("number_of_discharges"),
        F.when((flag == "R") & (q < 10), "N/A")
        .when(status == "F", F.concat(F.lit("0."), (F.lit(80) + F.round(F.col("l_discount") * 100).cast("int"))
                                      .cast("string")))
        .otherwise(F.concat(F.lit("1."), F.lpad(disc, 2, "0")))
        .alias("excess_readmission_ratio"),
        F.when(q < 6, "Not Available").otherwise(F.round(F.col("l_tax") * 100).cast("int").cast("string"))
        .alias("number_of_readmissions"),
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("start_date"),
        F.col("l_shipdate").cast("date").alias("end_date"),
        F.lit(None).cast("string").alias("footnote"),
        rate(10).alias("predicted_readmission_rate"),
        rate(11).alias("expected_readmission_rate"),
        F.col("l_orderkey").alias("k1"),
        F.col("l_linenumber").alias("k2"),
        F.col("l_extendedprice").alias("k3"),
    )


# The same four inputs as portable SQL (runs unchanged on Spark and DuckDB over
# views named after the test tables). Used by the oracle side of the checks.
ADAPTER_SQL = {
    "prices_raw": """
select symbol as id, symbol, concat('Coin ', symbol) as name, value as current_price,
       cast(floor(value * 1000) as bigint) as market_cap,
       cast(event_id % 250 + 1 as int) as market_cap_rank,
       cast(floor(value * 10) as bigint) as total_volume, value + 1.2345 as high_24h, value * 0.9 as low_24h,
       value - 49.12345 as price_change_24h, value / 7 as price_change_percentage_24h,
       value * 1000000 as circulating_supply, value * 2000000 as total_supply, cast(null as double) as max_supply,
       concat(replace(substr(cast(ts as varchar(40)), 1, 19), ' ', 'T'), '.000Z') as last_updated,
       ts as _ingested_at, batch_id as _batch_id
from (select concat('u', cast(user_id as varchar(10))) as symbol, ts, value, event_id,
             cast(row_number() over (partition by user_id order by event_id) as bigint) as batch_id
      from events) e""",
    "generation_raw": """
select user_id % 18 + 1 as region_id,
       concat('Region ', cast(user_id % 18 + 1 as varchar(10))) as short_name,
       case event_type when 'view' then 'wind' when 'click' then 'solar' when 'purchase' then 'gas'
                       when 'signup' then 'nuclear' else 'imports' end as fuel_type,
       value as percentage,
       concat(replace(substr(cast(date_trunc('hour', ts) as varchar(40)), 1, 16), ' ', 'T'), 'Z') as period_from,
       concat(replace(substr(cast(date_trunc('hour', ts) + interval '1' hour as varchar(40)), 1, 16), ' ', 'T'), 'Z') as period_to,
       event_id as batch_id, ts as _ingested_at
from events""",
    "intensity_raw": """
select region_id, concat('Region ', cast(region_id as varchar(10))) as short_name,
       concat('DNO ', cast(region_id as varchar(10))) as dno_region, v as intensity_forecast,
       case when v < 20 then 'very low' when v < 40 then 'low' when v < 80 then 'moderate'
            when v < 160 then 'high' else 'very high' end as intensity_index,
       concat(replace(substr(cast(p as varchar(40)), 1, 16), ' ', 'T'), 'Z') as period_from,
       concat(replace(substr(cast(p + interval '1' hour as varchar(40)), 1, 16), ' ', 'T'), 'Z') as period_to,
       batch_id, ingested as _ingested_at
from (select user_id % 18 + 1 as region_id,
             case when event_type = 'click' then date_trunc('hour', ts) - interval '30' minute
                  else date_trunc('hour', ts) end as p,
             max(value) as v, max(event_id) as batch_id, max(ts) as ingested
      from events group by 1, 2) x""",
    "hrrp_raw": """
select l.l_suppkey as facility_id, concat(' ', s.s_name, ' ') as facility_name,
       concat(lower(n.n_name), ' ') as state, p.p_type as measure_name,
       case when l.l_quantity < 6 then 'Too Few to Report'
            when l.l_returnflag = 'N' and l.l_quantity < 20 then ' N/A'
            else cast(cast(l.l_quantity as int) as varchar(10)) end as number_of_discharges,
       case when l.l_returnflag = 'R' and l.l_quantity < 10 then 'N/A'
            when l.l_linestatus = 'F' then concat('0.', cast(80 + cast(round(l.l_discount * 100) as int) as varchar(10)))
            else concat('1.', lpad(cast(cast(round(l.l_discount * 100) as int) as varchar(10)), 2, '0'))
       end as excess_readmission_ratio,
       case when l.l_quantity < 6 then 'Not Available'
            else cast(cast(round(l.l_tax * 100) as int) as varchar(10)) end as number_of_readmissions,
       concat(substr(cast(l.l_shipdate as varchar(40)), 6, 2), '/', substr(cast(l.l_shipdate as varchar(40)), 9, 2),
              '/', substr(cast(l.l_shipdate as varchar(40)), 1, 4)) as start_date,
       cast(l.l_shipdate as date) as end_date, cast(null as varchar(10)) as footnote,
       case when l.l_quantity < 6 then 'N/A' else concat(cast(10 + l.l_linenumber as varchar(10)), '.',
            lpad(cast(cast(l.l_quantity as int) as varchar(10)), 2, '0')) end as predicted_readmission_rate,
       case when l.l_quantity < 6 then 'N/A' else concat(cast(11 + l.l_linenumber as varchar(10)), '.',
            lpad(cast(cast(l.l_quantity as int) as varchar(10)), 2, '0')) end as expected_readmission_rate,
       l.l_orderkey as k1, l.l_linenumber as k2, l.l_extendedprice as k3
from lineitem l join part p on l.l_partkey = p.p_partkey
     join supplier s on l.l_suppkey = s.s_suppkey join nation n on s.s_nationkey = n.n_nationkey""",
}
