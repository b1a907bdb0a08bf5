"""Semi-structured sources: market snapshots (JSON) and carbon documents (nested JSON).

Files land in a folder (one poll per file); Spark parses them on the
executors with an explicit schema - nothing is walked on the driver. Every
region of every period of every document is read (not only the first period).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Fields of a market snapshot, in published order.
SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("current_price", T.DoubleType()),
    T.StructField("market_cap", T.LongType()),
    T.StructField("market_cap_rank", T.IntegerType()),
    T.StructField("total_volume", T.LongType()),
    T.StructField("high_24h", T.DoubleType()),
    T.StructField("low_24h", T.DoubleType()),
    T.StructField("price_change_24h", T.DoubleType()),
    T.StructField("price_change_percentage_24h", T.DoubleType()),
    T.StructField("circulating_supply", T.DoubleType()),
    T.StructField("total_supply", T.DoubleType()),
    T.StructField("max_supply", T.DoubleType()),
    T.StructField("last_updated", T.StringType()),
])

# Shape of a regional carbon document.
FUEL_SHARE = T.StructType([T.StructField("fuel", T.StringType()), T.StructField("perc", T.DoubleType())])
REGION = T.StructType([
    T.StructField("regionid", T.LongType()),
    T.StructField("dnoregion", T.StringType()),
    T.StructField("shortname", T.StringType()),
    T.StructField("intensity", T.StructType([
        T.StructField("forecast", T.DoubleType()),
        T.StructField("index", T.StringType()),
    ])),
    T.StructField("generationmix", T.ArrayType(FUEL_SHARE)),
])
PERIOD = T.StructType([
    T.StructField("from", T.StringType()),
    T.StructField("to", T.StringType()),
    T.StructField("regions", T.ArrayType(REGION)),
])
DOCUMENT_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("data", T.ArrayType(PERIOD)),
])


class LandingError(RuntimeError):
    pass


def read_price_snapshots(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Snapshot files (a JSON array of coins per file, or JSON lines). A field
    missing in the file is null; a malformed record keeps its text in
    ``_corrupt_record``."""
    schema = T.StructType(SNAPSHOT_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(schema).option("multiLine", multi_line)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path))


def parse_price_snapshots(text: DataFrame, column: str = "value") -> DataFrame:
    """JSON text per row (e.g. from a message queue) to snapshot columns."""
    return text.select(F.from_json(F.col(column), SNAPSHOT_SCHEMA).alias("s")).select("s.*")


def read_carbon_documents(spark: SparkSession, path: str) -> DataFrame:
    """One nested document per file (pretty-printed JSON)."""
    schema = T.StructType(DOCUMENT_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(schema).option("multiLine", True)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path))


def parse_carbon_documents(text: DataFrame, column: str = "value") -> DataFrame:
    return text.select(F.from_json(F.col(column), DOCUMENT_SCHEMA).alias("d")).select("d.*")


def check_landing(df: DataFrame) -> DataFrame:
    """Raise when a landing batch is empty or holds a malformed record; return
    the rows otherwise. One aggregate job over the batch."""
    has_corrupt = CORRUPT in df.columns
    data_cols = [c for c in df.columns if c != CORRUPT]
    # Spark refuses a raw-file query that reads only the corrupt-record column,
    # so one data column is aggregated along with it.
    counts = df.agg(F.count(F.lit(1)).alias("n"),
                    (F.count_if(F.col(CORRUPT).isNotNull()) if has_corrupt else F.lit(0)).alias("bad"),
                    *([F.count(F.col(data_cols[0])).alias("_seen")] if data_cols else [])).first()
    if counts["n"] == 0:
        raise LandingError("landing batch is empty")
    if counts["bad"]:
        raise LandingError(f"landing batch has {counts['bad']} malformed record(s)")
    return df.drop(CORRUPT) if has_corrupt else df


def _regions(docs: DataFrame) -> DataFrame:
    periods = docs.select("batch_id", F.explode("data").alias("p"))
    return periods.select("batch_id", F.col("p.from").alias("period_from"), F.col("p.to").alias("period_to"),
                          F.explode("p.regions").alias("r"))


def flatten_regional_intensity(docs: DataFrame) -> DataFrame:
    """One row per region and period (every period of the document)."""
    return _regions(docs).select(
        F.col("r.regionid").alias("region_id"),
        F.col("r.shortname").alias("short_name"),
        F.col("r.dnoregion").alias("dno_region"),
        F.col("r.intensity.forecast").cast("double").alias("intensity_forecast"),
        F.col("r.intensity.index").alias("intensity_index"),
        "period_from", "period_to", "batch_id",
        F.current_timestamp().alias("_ingested_at"),
    )


def flatten_generation_mix(docs: DataFrame) -> DataFrame:
    """One row per region, fuel and period."""
    regions = _regions(docs)
    fuels = regions.select("batch_id", "period_from", "period_to", "r.regionid", "r.shortname",
                           F.explode("r.generationmix").alias("g"))
    return fuels.select(
        F.col("regionid").alias("region_id"),
        F.col("shortname").alias("short_name"),
        F.col("g.fuel").alias("fuel_type"),
        F.col("g.perc").cast("double").alias("percentage"),
        "period_from", "period_to", "batch_id",
        F.current_timestamp().alias("_ingested_at"),
    )


def carbon_documents_from_rows(intensity: DataFrame | None, generation: DataFrame | None) -> DataFrame:
    """Serialise flat rows into documents (one small document per row, so no
    group is gathered into one record) and parse them back from JSON text -
    the same parser path a landing folder takes."""
    parts = []
    if intensity is not None:
        region = F.struct(
            F.col("region_id").alias("regionid"), F.col("dno_region").alias("dnoregion"),
            F.col("short_name").alias("shortname"),
            F.struct(F.col("intensity_forecast").alias("forecast"), F.col("intensity_index").alias("index"))
            .alias("intensity"),
            F.array().cast(T.ArrayType(FUEL_SHARE)).alias("generationmix"))
        parts.append(intensity.select(F.col("batch_id").cast("long").alias("batch_id"),
                                      F.col("period_from"), F.col("period_to"), region.alias("region")))
    if generation is not None:
        region = F.struct(
            F.col("region_id").alias("regionid"), F.lit(None).cast("string").alias("dnoregion"),
            F.col("short_name").alias("shortname"),
            F.lit(None).cast(REGION["intensity"].dataType).alias("intensity"),
            F.array(F.struct(F.col("fuel_type").alias("fuel"), F.col("percentage").alias("perc")))
            .alias("generationmix"))
        parts.append(generation.select(F.col("batch_id").cast("long").alias("batch_id"),
                                       F.col("period_from"), F.col("period_to"), region.alias("region")))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    doc = F.struct(
        F.col("batch_id"),
        F.array(F.struct(F.col("period_from").alias("from"), F.col("period_to").alias("to"),
                         F.array(F.col("region")).alias("regions"))).alias("data"))
    text = rows.select(F.to_json(doc).alias("value"))
    return parse_carbon_documents(text)
