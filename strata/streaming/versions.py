"""Tables that micro-batches write: an append log and a table of one row per key, both by hash bucket.

Every micro-batch writes folders of its own, so a retry replaces what its first attempt left, and ends with
``commit``: readers look at committed micro-batches only, over all tables of a root at once. Buckets are partition
folders, so a reader that needs some keys reads their buckets' files and no others. Old folders go by age.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FAN_IN = 20            # log versions that are merged into one of the next level
KEEP_SECONDS = 6 * 3600  # what a slow reader may still look at


def hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def listed(spark: SparkSession, pattern: str) -> list:
    """(path, modification time in seconds) of what matches, by one call."""
    path, fs = hadoop(spark, pattern)
    return [(s.getPath().toString(), s.getModificationTime() / 1000) for s in fs.globStatus(path) or []]


def commit(spark: SparkSession, root: str, mb: int) -> None:
    """Show everything written for micro-batch ``mb``; earlier marks that nobody needs go."""
    path, fs = hadoop(spark, f"{root}/_commits/{mb:012d}")
    fs.create(path, True).close()
    for mark, _ in listed(spark, f"{root}/_commits/*"):
        if int(mark.rsplit("/", 1)[-1]) < mb - 1:
            old, _ = hadoop(spark, mark)
            fs.delete(old, False)


def committed(spark: SparkSession, root: str) -> int:
    """The newest committed micro-batch, -1 without any."""
    return max((int(mark.rsplit("/", 1)[-1]) for mark, _ in listed(spark, f"{root}/_commits/*")), default=-1)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class Log:
    """Rows of a ``kind``, appended: ``v=<first>-<last>/kind=<kind>/bucket=<b>``.

    After every ``FAN_IN`` micro-batches their versions are merged into one, those after ``FAN_IN`` merges
    again, and so on: few folders, and each row is rewritten a logarithm of times.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets

    def _version(self, first: int, last: int) -> str:
        return f"{self.path}/v={first:012d}-{last:012d}"

    def versions(self, upto: int) -> list[str]:
        """Folders that cover the micro-batches up to ``upto`` once each, merged ones first."""
        found = []
        for mark, _ in listed(self.spark, f"{self.path}/v=*/_SUCCESS"):
            first, last = map(int, mark.rsplit("/", 2)[-2][2:].split("-"))
            if last <= upto:
                found.append((first, -last))
        out, at = [], -1
        for first, last in sorted(found):
            if first > at:
                out.append(self._version(first, -last))
                at = -last
        return out

    def write(self, df: DataFrame, mb: int, spread: int = 4) -> None:
        """The rows of a micro-batch (with their ``kind``); ``spread`` files a bucket, so that a hot key is not one task."""
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(spread))
        (df.withColumn("bucket", bucket_of(self.key, self.buckets)).withColumn("_salt", salt)
         .repartition("bucket", "_salt").drop("_salt")
         .write.mode("overwrite").partitionBy("kind", "bucket").parquet(self._version(mb, mb)))

    def add(self, df: DataFrame, mb: int) -> None:
        """More kinds of rows for a micro-batch that ``write`` has begun."""
        (df.withColumn("bucket", bucket_of(self.key, self.buckets))
         .write.mode("append").partitionBy("kind", "bucket").parquet(self._version(mb, mb)))

    def forget(self, mb: int) -> None:
        """Remove the version of a micro-batch that had no rows."""
        path, fs = hadoop(self.spark, self._version(mb, mb))
        fs.delete(path, True)

    def has(self, kind: str, upto: int, mb: int | None = None) -> bool:
        """Whether there are rows of a kind (in one micro-batch): looks at folder names only."""
        folders = [self._version(mb, mb)] if mb is not None else self.versions(upto)
        return any(listed(self.spark, f"{v}/kind={kind}") for v in folders)

    def touched(self, mb: int) -> list[int]:
        """Buckets that a micro-batch wrote to."""
        found = listed(self.spark, f"{self._version(mb, mb)}/kind=*/bucket=*")
        return sorted({int(p.rsplit("=", 1)[-1]) for p, _ in found})

    def read(self, upto: int, kinds=None, buckets=None, mb: int | None = None) -> DataFrame | None:
        """Rows with their ``kind`` and ``bucket``; ``kinds`` and ``buckets`` prune folders. None without versions."""
        folders = [self._version(mb, mb)] if mb is not None else self.versions(upto)
        if not folders:
            return None
        df = self.spark.read.option("basePath", self.path).parquet(*folders).drop("v")
        df = df.filter(F.col("kind").isin(list(kinds))) if kinds is not None else df
        return df.filter(F.col("bucket").isin(list(buckets))) if buckets is not None else df

    def tidy(self, mb: int) -> None:
        """Merge full runs that end with the committed micro-batch ``mb``; drop merged versions of some age."""
        span = FAN_IN
        while (mb + 1) % span == 0:
            first = mb + 1 - span
            parts = [v for v in self.versions(mb) if int(v.rsplit("=", 1)[-1].split("-")[0]) >= first]
            if len(parts) > 1:
                (self.spark.read.option("basePath", self.path).parquet(*parts).drop("v").repartition("kind", "bucket")
                 .write.mode("overwrite").partitionBy("kind", "bucket").parquet(self._version(first, mb)))
            span *= FAN_IN
        shown, now = set(self.versions(mb)), time.time()
        for mark, written in listed(self.spark, f"{self.path}/v=*/_SUCCESS"):
            folder = f"{self.path}/{mark.rsplit('/', 2)[-2]}"
            last = int(folder.rsplit("-", 1)[-1])
            if folder not in shown and last <= mb and now - written > KEEP_SECONDS:
                path, fs = hadoop(self.spark, folder)
                fs.delete(path, True)


class Keyed:
    """A table that is merged by key: ``bucket=<b>/v=<micro-batch>`` holds the whole bucket as of that micro-batch.

    Only buckets with changed keys are read and written (dynamic partition overwrite).
    """

    def __init__(self, spark: SparkSession, path: str, key: str | Column, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.bucket = bucket_of(key, buckets) if isinstance(key, str) else F.pmod(key, F.lit(buckets)).cast("int")

    def newest(self, upto: int) -> dict[int, int]:
        """Bucket -> its newest version; at most two numbers a bucket are listed on the driver, plus aging ones."""
        out: dict[int, int] = {}
        for path, _ in listed(self.spark, f"{self.path}/bucket=*/v=*"):
            bucket, v = (int(x.split("=")[1]) for x in path.rsplit("/", 2)[-2:])
            if v <= upto and v > out.get(bucket, -1):
                out[bucket] = v
        return out

    def read(self, upto: int, buckets=None) -> DataFrame | None:
        wanted = None if buckets is None else set(buckets)
        paths = [f"{self.path}/bucket={b}/v={v}" for b, v in self.newest(upto).items() if wanted is None or b in wanted]
        if not paths:
            return None
        return self.spark.read.option("basePath", self.path).parquet(*paths).drop("v", "bucket")

    def touched(self, df: DataFrame) -> list[int]:
        """Buckets of the keys of ``df`` (at most ``buckets`` numbers are collected)."""
        return [r[0] for r in df.select(self.bucket).distinct().collect()]

    def write(self, df: DataFrame, mb: int) -> None:
        """New versions of the buckets in ``df``, which must hold those buckets whole."""
        (df.withColumns({"bucket": self.bucket, "v": F.lit(mb).cast("long")}).repartition("bucket")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket", "v").parquet(self.path))

    def tidy(self, mb: int) -> None:
        shown, now = self.newest(mb), time.time()
        for path, written in listed(self.spark, f"{self.path}/bucket=*/v=*"):
            bucket, v = (int(x.split("=")[1]) for x in path.rsplit("/", 2)[-2:])
            if v < shown.get(bucket, -1) and now - written > KEEP_SECONDS:
                old, fs = hadoop(self.spark, path)
                fs.delete(old, True)
