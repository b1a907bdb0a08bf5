"""Sinks and table metadata: append, full refresh, model materialisation, audit.

Tables live in the session catalog (``layer_table`` names) or at a path. The
storage format is a parameter: Delta when its package is on the class path,
otherwise Parquet. A full refresh never overwrites the files a query is
reading: it writes a new version folder and lets the name, a view, show it.
"""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROCESSING_TIME_SUFFIX = "_at"


def stamp_processed(df: DataFrame, column: str) -> DataFrame:
    """Add a processing-time column (``current_timestamp()``, one value per query)."""
    return df.withColumn(column, F.current_timestamp())


def stamp_batch(df: DataFrame, batch_id: int, ingested_col: str = "_ingested_at",
                batch_col: str = "_batch_id", extra: dict | None = None) -> DataFrame:
    """Add ingest metadata. The batch id is a parameter (not the wall clock) so
    that a rerun of the same batch writes the same rows."""
    cols = {ingested_col: F.current_timestamp(), batch_col: F.lit(batch_id).cast("bigint")}
    for name, value in (extra or {}).items():
        cols[name] = value if isinstance(value, F.Column) else F.lit(value)
    return df.withColumns(cols)


def stamp_source_file(df: DataFrame, column: str = "_source_file") -> DataFrame:
    """File name of each row from the scan's hidden ``_metadata`` column."""
    return df.withColumn(column, F.col("_metadata.file_name"))


def drop_processing_times(df: DataFrame) -> DataFrame:
    """Drop ``_..._at`` columns (they differ between any two runs)."""
    return df.drop(*[c for c in df.columns if c.startswith("_") and c.endswith(PROCESSING_TIME_SUFFIX)])


def table_format(spark: SparkSession) -> str:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("io.delta.sql.DeltaSparkSessionExtension")
        return "delta"
    except Exception:
        return "parquet"


def append(df: DataFrame, name: str | None = None, path: str | None = None,
           fmt: str | None = None, partition_by=None) -> None:
    """Append rows to a table (by name) or a folder (by path)."""
    fmt = fmt or table_format(df.sparkSession)
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if name:
        w.saveAsTable(name)
    else:
        w.save(path)


def stage(df: DataFrame, name: str, location_root: str, fmt: str | None = None, partition_by=None) -> str:
    """Write a new version of a table to a folder of its own; returns the folder. Readers see nothing yet."""
    fmt = fmt or table_format(df.sparkSession)
    location = f"{location_root.rstrip('/')}/{name.replace('.', '_')}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    w = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(location)
    return location


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _comments(spark: SparkSession, name: str) -> tuple[str | None, dict]:
    if not spark.catalog.tableExists(name):
        return None, {}
    return spark.catalog.getTable(name).description, {
        c.name: c.description for c in spark.catalog.listColumns(name) if c.description}


def _define(spark: SparkSession, name: str, select: str, comment: str | None, columns: dict) -> None:
    listed = ", ".join(f"`{c}`" + (f" COMMENT {_quoted(columns[c])}" if c in columns else "")
                       for c in spark.sql(select).columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} ({listed})"
              + (f" COMMENT {_quoted(comment)}" if comment else "") + f" AS {select}")


def point(spark: SparkSession, name: str, location: str, fmt: str | None = None, drop=(), keep: int = 2) -> None:
    """Let ``name`` show the staged version at ``location``, by one catalog call.

    The name is a view over the folder, whether the schema or the partitioning
    changed or not: readers get the old or the new version, never none, and
    descriptions stay. ``drop`` columns are left out of the view. Of the older
    versions the newest ``keep - 1`` stay for readers that resolved them; the
    others go.
    """
    fmt = fmt or table_format(spark)
    comment, columns = _comments(spark, name)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType not in ("VIEW", "TEMPORARY"):
        spark.sql(f"DROP TABLE {name}")  # a plain table of this name cannot become a view in place
    shown = [c for c in spark.read.format(fmt).load(location).columns if c not in drop]
    _define(spark, name, f"SELECT {', '.join(f'`{c}`' for c in shown)} FROM {fmt}.`{location}`", comment, columns)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(location).getParent()
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    older = sorted((st.getPath().getName(), st.getPath()) for st in fs.listStatus(folder)
                   if st.getPath().getName() < location.rsplit("/", 1)[-1])
    for _, path in older[:max(len(older) - (keep - 1), 0)]:
        fs.delete(path, True)


def overwrite(df: DataFrame, name: str, location_root: str, fmt: str | None = None,
              partition_by=None) -> str:
    """Full refresh with schema replacement: ``stage``, then ``point``.

    A failed write or a failure between the two leaves the table as it was.
    Returns the new location.
    """
    fmt = fmt or table_format(df.sparkSession)
    location = stage(df, name, location_root, fmt, partition_by)
    point(df.sparkSession, name, location, fmt)
    return location


def materialise(df: DataFrame, name: str, kind: str = "view", location_root: str | None = None) -> DataFrame:
    """A model as a view (lazy, inlined by the analyzer) or a table (stored once,
    read back by every consumer instead of recomputing the chain)."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind == "table":
        if location_root is None:
            raise ValueError("a table needs a location_root")
        overwrite(df, name, location_root)
        return spark.table(name)
    raise ValueError(f"unknown materialisation {kind!r}")


def table_row_counts(spark: SparkSession, names) -> DataFrame:
    """``(table_name, row_count)`` for several tables, as one query."""
    return reduce(DataFrame.unionByName, [
        spark.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n in names])


def table_audit(spark: SparkSession, names=None) -> DataFrame:
    """``(table_name, row_count, n_columns, schema, description)`` of the named tables, or of all in the catalog."""
    names = [t.name for t in spark.catalog.listTables()] if names is None else list(names)
    if not names:
        return spark.createDataFrame([], "table_name string, row_count long, n_columns int, schema string, description string")
    facts = [(n, len(spark.table(n).columns), spark.table(n).schema.simpleString(),
              spark.catalog.getTable(n).description) for n in names]
    listed = spark.createDataFrame(facts, "table_name string, n_columns int, schema string, description string")
    return table_row_counts(spark, names).join(listed, "table_name").select(
        "table_name", "row_count", "n_columns", "schema", "description")


def set_comments(spark: SparkSession, name: str, table_comment: str | None = None,
                 column_comments: dict | None = None) -> None:
    """Store descriptions with a published name (kept by later refreshes)."""
    if spark.catalog.getTable(name).tableType == "VIEW":
        comment, columns = _comments(spark, name)
        text = next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
                    if r["col_name"] == "View Text")
        _define(spark, name, text, table_comment or comment, {**columns, **(column_comments or {})})
        return
    if table_comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(table_comment)}")
    for col, text in (column_comments or {}).items():
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{col}` COMMENT {_quoted(text)}")
