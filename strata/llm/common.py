"""Helpers shared by the training-data operators.

Numpy and Arrow run only inside tasks; Spark partitions and shuffles the work.
Intermediate tables go to the shared folder of ``spark.checkpoint.dir`` so that
lineage is cut and a lost executor costs no recomputation of earlier steps.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.files import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and return the stored table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``store`` that nothing still to run reads."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes with A-Z lower-cased.

    ``bytes.split`` without arguments splits at exactly these six bytes.
    """
    return text.translate(LOWER).split()


def lower_ascii(col: str | F.Column) -> F.Column:
    """Lower-case A-Z only (not other letters)."""
    return F.translate(col, UPPER, UPPER.lower())


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def by_key(rows: DataFrame, table: DataFrame, key: list[str], weight: str, share: int = 4096) -> DataFrame:
    """Left join of ``rows`` with a table of one row per key, null-safe, without a hot key in one task.

    Keys that hold more than one part in ``share`` of all ``weight`` (rows per key) are fewer than ``share``:
    they are broadcast, and their rows are salted in the shuffled join with the rest. The table is read
    three times, so it should be a stored one.
    """
    cols = [c for c in table.columns if c not in key]
    total = table.agg(F.sum(weight)).scalar()
    heavy = table.withColumn("_total", total).filter(F.col(weight) * share > F.col("_total"))
    light = table.withColumn("_total", total).filter(F.col(weight) * share <= F.col("_total"))

    def named(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{prefix}k_{c}") for c in key], *[F.col(c).alias(f"{prefix}v_{c}") for c in cols])

    def same(prefix: str) -> Column:
        on = [F.col(c).eqNullSafe(F.col(f"{prefix}k_{c}")) for c in key]
        return reduce(Column.__and__, on)

    first = rows.join(F.broadcast(named(heavy, "_h")), same("_h"), "left")
    salt = F.when(F.col(f"_hv_{weight}").isNotNull(), 1 + F.monotonically_increasing_id()).otherwise(0)
    light = named(light, "_l").withColumn("_l_salt", F.lit(0).cast("long"))
    both = first.withColumn("_salt", salt).join(light, same("_l") & (F.col("_salt") == F.col("_l_salt")), "left")
    return both.select(*rows.columns, *[F.coalesce(f"_hv_{c}", f"_lv_{c}").alias(c) for c in cols])


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The column as UTF-8 byte strings; null becomes empty."""
    kind = pa.large_binary() if pa.types.is_large_string(batch.column(name).type) else pa.binary()
    return [x or b"" for x in batch.column(name).cast(kind).to_pylist()]


def batches(schema: pa.Schema, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """One Arrow batch from row tuples (nothing when there are none)."""
    if rows:
        cols = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def release() -> None:
    """Give a worker's free memory back to the system: Python workers are reused, and sit beside a growing JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A ``mapInArrow`` function that ends with ``release``."""
    def wrapped(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(it)
        release()

    return wrapped


# --- compact arrays -------------------------------------------------------

def pack(a: np.ndarray, level: int = 1) -> bytes:
    """zstd over the byte planes of an array (planes of small numbers shrink well)."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
    return zstandard.ZstdCompressor(level=level).compress(planes)


def unpack(b: bytes, dtype) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(b, max_output_size=0) if b else b""
    item = np.dtype(dtype).itemsize
    if not raw:
        return np.zeros(0, dtype)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(item, -1).T).reshape(-1).view(dtype)


def pack_sorted(a: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit keys as gaps."""
    a = a.astype(np.uint64, copy=False)
    return pack(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b, np.uint64), dtype=np.uint64)


def pack_text(b: bytes, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(b)


def unpack_text(b: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(b)


# --- 64-bit hashes of substrings and words --------------------------------

_P = 0x9E3779B97F4A7C15
_CACHE: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, at least n+1 of each."""
    if len(_CACHE.get("pow", ())) < n + 1:
        size = max(n + 1, 1 << 20)
        for name, base in (("pow", _P), ("inv", pow(_P, -1, 1 << 64))):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _CACHE[name] = np.cumprod(x)
    return _CACHE["pow"], _CACHE["inv"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every bit of ``h``."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class SubstringHash:
    """Hash of any substring of a byte buffer in constant time.

    A polynomial modulo 2**64 over prefix sums, shifted to position 0 by the
    inverse power and passed through ``mix``.
    """

    def __init__(self, buf: np.ndarray):
        self.pow, self.inv = _powers(len(buf) + 1)
        self.sums = np.empty(len(buf) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum((buf.astype(np.uint64) + np.uint64(0x1F3)) * self.pow[:len(buf)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.inv[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


LONG_WORD = 64


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of words. Beyond ``LONG_WORD`` bytes a polynomial modulo 2**64 has known collisions (strings of the
    Thue-Morse kind), so these words are hashed by blake2b."""
    if not len(start):
        return np.zeros(0, np.uint64)
    out, raw = SubstringHash(buf).of(start, end), buf.tobytes()
    for k in np.flatnonzero(end - start > LONG_WORD).tolist():
        out[k] = int.from_bytes(blake2b(raw[start[k]:end[k]], digest_size=8).digest(), "little")
    return out


def word_spans(buf: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words in a buffer of documents joined by separators.

    ``is_word`` is a 256-entry table. No word crosses documents, as the caller
    joins them by a separator byte.
    """
    inside = is_word[buf]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
