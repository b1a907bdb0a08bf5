"""Structured Streaming jobs: bronze ingest, document ingest, duplicate polls (market tables: ``market``).

All jobs read a landing folder with the file source and an explicit schema,
keep their progress in a checkpoint folder, and run with
``trigger(availableNow=True)``: each run processes what has landed since the
previous run and stops - the scheduled-append model, made incremental and
restartable. Records that are not valid JSON are kept in a table of their own with their text; how
many there were is observed while a micro-batch is read. Sinks are idempotent per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import ROCKSDB
from strata.sources.documents import (
    CORRUPT, DOCUMENT_SCHEMA, LandingError, flatten_generation_mix, flatten_regional_intensity,
)
from strata.streaming.versions import Log, commit, committed

MAX_BYTES = 8 << 30  # landed bytes of a micro-batch

WHITE = " \t\r\n"

BATCH_FIELD = T.StructField("_batch_id", T.LongType())


def _await(query, on_malformed: str = "keep") -> list[dict]:
    """Wait for the end; the observed (rows, malformed) of each micro-batch."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    seen = [p["observedMetrics"].get("landing") for p in query.recentProgress if p["numInputRows"]]
    counts = [{"rows": m["rows"], "malformed": m["malformed"]} for m in seen if m is not None]
    bad = sum(c["malformed"] for c in counts)
    if bad and on_malformed == "raise":
        raise LandingError(f"{bad} malformed record(s) landed; they are kept apart")
    return counts


def _limited(reader, max_files_per_trigger: int | None):
    """A micro-batch is bounded by bytes, or by files when asked for."""
    if max_files_per_trigger:
        return reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.option("maxBytesPerTrigger", str(MAX_BYTES))


def read_landing_json(spark: SparkSession, landing: str, schema: T.StructType,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream of JSON lines; a malformed line keeps its text in ``_corrupt_record``."""
    schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.readStream.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return _limited(reader, max_files_per_trigger).json(landing)


def read_landing_documents(spark: SparkSession, landing: str, schema: T.StructType,
                           max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream of JSON documents, one per file in any layout, or one per line.

    A file whose first line is a document of its own holds one document per line; any other file is one
    document over all its lines, as the published files are. A file is read as one text, so this is for polls;
    bulk loads go through ``read_landing_json``. A malformed document keeps its text in ``_corrupt_record``, and so
    does a file of white space (files of no bytes are skipped by Spark's reader).
    """
    files = _limited(spark.readStream, max_files_per_trigger).text(landing, wholetext=True)
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

    def parsed(text: Column) -> Column:
        return F.from_json(text, whole, options)

    lines = F.filter(F.split("value", r"\r?\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    by_line = (F.size(lines) > 0) & parsed(F.get(lines, F.lit(0)))[CORRUPT].isNull() & \
        F.btrim(F.get(lines, F.lit(0)), F.lit(WHITE)).endswith("}")
    texts = files.select(F.explode(F.when(by_line, lines).otherwise(F.array("value"))).alias("_text"))
    docs = texts.select("_text", parsed(F.col("_text")).alias("d")).select("_text", "d.*")
    broken = F.col(CORRUPT).isNotNull() | (F.btrim("_text", F.lit(WHITE)) == "")
    return docs.withColumn(CORRUPT, F.when(broken, F.col("_text"))).drop("_text")


def observed(stream: DataFrame) -> DataFrame:
    """Count rows and malformed records as they are read; the progress of the query carries the counts."""
    return stream.observe("landing", F.count(F.lit(1)).alias("rows"), F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed"))


# ---- T1: incremental bronze ingest ------------------------------------------
def bronze_append(spark: SparkSession, landing: str, schema: T.StructType, sink: str, checkpoint: str,
                  max_files_per_trigger: int | None = None, on_malformed: str = "keep") -> list[dict]:
    """Append every newly landed snapshot file to the bronze folder (Parquet); (rows, malformed) of each micro-batch.

    Malformed records go to the partition ``_malformed=true`` in the same transaction. With ``on_malformed``
    "raise" the run then fails (a failed fetch must not pass unseen), and what landed is stored all the same.
    """
    stream = observed(read_landing_json(spark, landing, schema, max_files_per_trigger)).withColumns(
        {"_ingested_at": F.current_timestamp(), "_malformed": F.col(CORRUPT).isNotNull()})
    return _await(stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).partitionBy("_malformed")
                  .outputMode("append").trigger(availableNow=True).start(sink), on_malformed)


def bronze_rows(spark: SparkSession, sink: str, malformed: bool = False) -> DataFrame:
    """The sound rows of the bronze folder, or the malformed records (``_corrupt_record``, ``_ingested_at``)."""
    rows = spark.read.parquet(sink).filter(F.col("_malformed") == malformed).drop("_malformed")
    return rows.select(CORRUPT, "_ingested_at") if malformed else rows.drop(CORRUPT)


# ---- S3 as a stream: nested documents to two tables ---------------------------
class Documents:
    """``carbon_intensity`` and ``generation_mix`` under ``root``, written in one step per micro-batch, and malformed texts."""

    KINDS = ("intensity", "mix", "bad")

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.logs = {kind: Log(spark, f"{root}/{kind}", key, 1)
                     for kind, key in zip(self.KINDS, ("region_id", "region_id", CORRUPT), strict=True)}

    def write(self, batch: DataFrame, mb: int) -> None:
        arrived = Log(self.spark, f"{self.root}/arrived", CORRUPT, 1)
        arrived.write(batch.withColumn("kind", F.lit("document")), mb, 8)  # the files are read once
        if arrived.touched(mb):
            docs = arrived.read(mb, mb=mb).drop("kind", "bucket")
            parts = {"intensity": flatten_regional_intensity(docs.filter(F.col(CORRUPT).isNull())),
                     "mix": flatten_generation_mix(docs.filter(F.col(CORRUPT).isNull())),
                     "bad": docs.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)}
            for kind, rows in parts.items():
                self.logs[kind].write(rows.withColumn("kind", F.lit(kind)), mb)
        arrived.forget(mb)
        commit(self.spark, self.root, mb)
        for log in self.logs.values():
            log.tidy(mb)

    def read(self, kind: str) -> DataFrame | None:
        """Rows of all committed micro-batches; None when there are none of the kind."""
        upto = committed(self.spark, self.root)
        log = self.logs[kind]
        return log.read(upto, (kind,)).drop("kind", "bucket") if log.has(kind, upto) else None


def ingest_documents(spark: SparkSession, landing: str, root: str, max_files_per_trigger: int | None = None,
                     on_malformed: str = "keep") -> list[dict]:
    """Landed documents to both tables; (documents, malformed) of each micro-batch. Both tables are written
    before the micro-batch is committed, so a retry replaces both."""
    stream = observed(read_landing_documents(spark, landing, DOCUMENT_SCHEMA, max_files_per_trigger))
    tables = Documents(spark, root)
    return _await(stream.writeStream.foreachBatch(tables.write).option("checkpointLocation", f"{root}/_checkpoint")
                  .trigger(availableNow=True).start(), on_malformed)


def document_tables(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(carbon_intensity, generation_mix) of all committed micro-batches."""
    tables = Documents(spark, root)
    return tables.read("intensity"), tables.read("mix")


# ---- T4: duplicate polls ----------------------------------------------------
def dedupe_polls_stream(stream: DataFrame, keys, event_time: str, delay: str = "2 hours") -> DataFrame:
    """Drop repeated polls of the same key that arrive within the watermark
    delay; the first arrival is kept. ``timestamp_ntz`` cannot carry a
    watermark, so the event time is cast to ``timestamp`` (session zone UTC)."""
    s = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return s.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def run_dedupe_polls(spark: SparkSession, landing: str, schema: T.StructType, keys, event_time: str,
                     sink: str, checkpoint: str, delay: str = "2 hours",
                     max_files_per_trigger: int | None = None) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)  # state beyond memory
    stream = read_landing_json(spark, landing, schema, max_files_per_trigger)
    stream = stream.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    out = dedupe_polls_stream(stream, keys, event_time, delay)
    q = (out.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(sink))
    _await(q)
