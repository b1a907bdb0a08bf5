"""Delimited-file sources and scratch locations."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the session's checkpoint location (a shared file
    system on a cluster; never a machine-local temporary folder)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/strata-scratch/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and return the stored table, whatever reads it how often."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def drop_stored(df: DataFrame) -> None:
    """Delete a table of ``stored`` that nothing still to run reads."""
    path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_csv_strings(spark: SparkSession, path: str, columns, multi_line: bool = False) -> DataFrame:
    """CSV with a header row, every column read as text so that sentinels such
    as ``Too Few to Report`` or a leading-zero id survive; types come later.

    Columns are taken by the names of the header (read when the frame is built),
    in whatever order the file has them; a missing name raises. Files whose
    header differs from the first one fail when they are read. ``multi_line`` is
    for quoted cells with line breaks; it makes a file unsplittable.
    """
    reader = (spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    header = reader.option("inferSchema", False).csv(path).schema
    missing = [c for c in columns if c not in header.names]
    if missing:
        raise ValueError(f"the header of {path} lacks {missing}")
    return reader.schema(header).option("enforceSchema", False).csv(path).select(*[f"`{c}`" for c in columns])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; surrounding spaces kept (the writer trims by default)."""
    (df.write.mode("errorifexists")
     .option("header", True)
     .option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .csv(path))
