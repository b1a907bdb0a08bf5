"""Registered source and sink round trips.

Each query derives its input from the test tables with Spark, writes it
through the source or sink under test into a fresh folder below the session's
checkpoint location, and returns what reads back - so the SQL twin is simply
the input itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strata.operators.clean import rename_columns, snake_case_names
from strata.plans import carbon as cb
from strata.plans import readmissions as rd
from strata.plans.registry import register
from strata.plans.sqltext import with_ctes
from strata.sources import sinks
from strata.sources.documents import SNAPSHOT_SCHEMA, read_price_snapshots
from strata.sources.files import read_csv_strings, scratch_path, write_csv
from strata.sources.testdata import generation_raw, hrrp_raw, intensity_raw, prices_raw

SNAPSHOT_FIELDS = [f.name for f in SNAPSHOT_SCHEMA.fields]


def _midpoint(df, column: str):
    """Middle of the column's range as a scalar subquery (splits a table in two)."""
    return df.agg((F.min(column) + F.max(column)) / 2).scalar()


@register("src_csv_hrrp", with_ctes(("raw", "hrrp_raw"), select="""
select facility_name, cast(facility_id as varchar) as facility_id, state, measure_name, number_of_discharges,
       footnote, excess_readmission_ratio, predicted_readmission_rate, expected_readmission_rate,
       number_of_readmissions, start_date, cast(end_date as varchar) as end_date
from raw"""))
def q_src_csv_hrrp(spark, sf_dir):
    """Published-header CSV written by Spark, read back as text and renamed."""
    raw = hrrp_raw(spark, sf_dir)
    to_header = {snake_case_names([h])[h]: h for h in rd.RAW_HEADER}
    # the file has its columns in another order than the reader asks for
    published = raw.select(*[F.col(c).cast("string").alias(h) for c, h in sorted(to_header.items())])
    path = scratch_path(spark, "hrrp-csv")
    write_csv(published, path)
    back = read_csv_strings(spark, path, rd.RAW_HEADER)
    return rename_columns(back, snake_case_names(back.columns))


@register("src_json_prices", with_ctes(("bronze", "prices_raw"), select="""
select id, symbol, name, current_price, market_cap, market_cap_rank, total_volume, high_24h, low_24h,
       price_change_24h, price_change_percentage_24h, circulating_supply, total_supply, max_supply,
       last_updated, _batch_id
from bronze"""))
def q_src_json_prices(spark, sf_dir):
    """Snapshots as JSON lines (one folder per batch id), read with the fixed schema."""
    b = prices_raw(spark, sf_dir)
    path = scratch_path(spark, "prices-json")
    b.select(*SNAPSHOT_FIELDS, "_batch_id").write.partitionBy("_batch_id").json(path)
    back = read_price_snapshots(spark, path, multi_line=False)
    return back.drop("_corrupt_record")


@register("sink_append", with_ctes(("bronze", "prices_raw"), select="""
select symbol, _batch_id, current_price, market_cap from bronze"""))
def q_sink_append(spark, sf_dir):
    """Two appends (older, then newer batches) to one folder; all rows read back."""
    b = prices_raw(spark, sf_dir).select("symbol", "_batch_id", "current_price", "market_cap")
    path = scratch_path(spark, "append")
    mid = _midpoint(b, "_batch_id")
    sinks.append(b.filter(F.col("_batch_id") <= mid), path=path, fmt="parquet")
    sinks.append(b.filter(F.col("_batch_id") > mid), path=path, fmt="parquet")
    return spark.read.parquet(path)


@register("sink_overwrite", with_ctes(("bronze", "prices_raw"), select="""
select symbol, _batch_id, current_price from bronze"""))
def q_sink_overwrite(spark, sf_dir):
    """Full refresh by swap: a first version, then the full table replaces it."""
    b = prices_raw(spark, sf_dir).select("symbol", "_batch_id", "current_price")
    name = f"strata_overwrite_{uuid.uuid4().hex[:12]}"
    root = scratch_path(spark, "overwrite")
    sinks.overwrite(b.filter(F.col("_batch_id") <= _midpoint(b, "_batch_id")).withColumn("extra", F.lit(1)),
                    name, root, fmt="parquet")
    sinks.overwrite(b, name, root, fmt="parquet")
    return spark.table(name)


@register("stamp_batch", with_ctes(("bronze", "prices_raw"), select="""
select symbol, current_price, cast(42 as bigint) as _batch_id, 'events' as _source from bronze"""))
def q_stamp_batch(spark, sf_dir):
    """Ingest metadata: batch id passed in (reruns write the same rows)."""
    b = prices_raw(spark, sf_dir).select("symbol", "current_price")
    return sinks.stamp_batch(b, 42, extra={"_source": "events"})


@register("model_view_chain", with_ctes(("intensity_raw", "intensity_raw"), select="""
select region_id, count(*) as row_count from intensity_raw where region_id between 1 and 14
group by region_id"""))
def q_model_view_chain(spark, sf_dir):
    """Staging and mart as a chain of views (inlined by the analyzer)."""
    suffix = uuid.uuid4().hex[:8]
    stg = sinks.materialise(cb.stg_carbon_intensity(intensity_raw(spark, sf_dir)), f"stg_ci_{suffix}")
    mart = cb.granular_only(stg).groupBy("region_id").agg(F.count(F.lit(1)).alias("row_count"))
    return sinks.materialise(mart, f"mart_ci_{suffix}")


@register("table_row_counts", with_ctes(("intensity_raw", "intensity_raw"), ("generation_raw", "generation_raw"),
                                        select="""
select 'intensity' as table_name, count(*) as row_count from intensity_raw
union all select 'generation', count(*) from generation_raw"""))
def q_table_row_counts(spark, sf_dir):
    """Row count of several catalog tables as one query."""
    suffix = uuid.uuid4().hex[:8]
    intensity_raw(spark, sf_dir).createOrReplaceTempView(f"intensity_{suffix}")
    generation_raw(spark, sf_dir).createOrReplaceTempView(f"generation_{suffix}")
    counts = sinks.table_row_counts(spark, [f"intensity_{suffix}", f"generation_{suffix}"])
    return counts.withColumn("table_name", F.regexp_replace("table_name", f"_{suffix}$", ""))
