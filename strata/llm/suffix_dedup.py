"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A byte goes when it lies in a string of ``length`` bytes that also starts
somewhere else in the corpus. So suffixes are compared to a depth of ``length``
bytes only. The steps, after the blockwise construction of suffix arrays:

1. Cover samples. Positions of a text that fall on a difference cover modulo
   ``PERIOD`` are ranked by their next ``length - PERIOD + 1`` bytes. Any two
   positions reach cover positions together after the same number of steps,
   fewer than PERIOD; so two equal strings of ``length`` bytes hold a pair of
   equal samples, and a suffix none of whose first PERIOD positions is a tied
   sample is resolved as unique.
2. Suffix buckets. Only the other suffixes are dealt into buckets, by the
   leading bits of the order key of their first ``length`` bytes, and a task
   sorts one bucket at a time. Suffixes that tie to the full depth are the
   repeated strings.
3. The bytes under tied suffixes are removed.

Order keys and sample ranks are 64-bit hashes, a total order in which ties mean
equal strings (two distinct strings share a key with a chance of 2**-64, and
matter only where a cover sample ties as well). Texts are put in an order in
which similar ones are neighbours (by the least hash of their short
substrings; a range shuffle, so that one large group of copies spans many
partitions) and packed into blocks once. Only sorted keys of a block travel to
the buckets, as gaps, and one bit for each key travels back. A key that a block
holds many times is sent once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import (
    SubstringHash,
    batches,
    n_partitions,
    pack,
    pack_sorted,
    pack_text,
    store,
    text_bytes,
    unpack,
    unpack_sorted,
    unpack_text,
)

LENGTH = 200
PERIOD = 73
# The powers of two modulo 73, a planar difference set: every non-zero residue
# is the difference of exactly one pair.
COVER = tuple(sorted(pow(2, k, PERIOD) for k in range(9)))
NEAR_BYTES = 32  # substrings that the order of texts is taken from
BLOCK_BYTES = 1 << 20  # text of a block, about (one longer text is a block of its own)
SLICE = 1 << 20  # positions hashed at once

_IN_COVER = np.isin(np.arange(PERIOD), COVER)

ASKED = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("bucket", T.IntegerType()),
    T.StructField("keys", T.BinaryType()), T.StructField("many", T.BinaryType()), T.StructField("texts", T.BinaryType())])
REPLY = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("step", T.IntegerType()),
    T.StructField("bucket", T.IntegerType()), T.StructField("tied", T.BinaryType()), T.StructField("texts", T.BinaryType())])


class Block:
    """The texts of a block: one buffer, starts and lengths."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.buf = np.frombuffer(b"".join(texts), np.uint8)
        digest = [int.from_bytes(blake2b(t, digest_size=8).digest(), "little") for t in texts]
        self.text_keys = np.array(digest, np.uint64)
        # Equal texts of a block: the first one stands for all.
        _, first, back, n = np.unique(self.text_keys, return_index=True, return_inverse=True, return_counts=True)
        self.is_first = np.zeros(len(texts), bool)
        self.is_first[first] = True
        self.copies = n[back] if len(texts) else n

    def _positions(self, keep: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the buffer positions a..b-1 in kept texts: position, place in the text, bytes left."""
        lo = np.searchsorted(self.starts + self.sizes, a, side="right")
        hi = np.searchsorted(self.starts, b, side="left")
        of = np.repeat(np.arange(lo, hi), np.minimum(self.starts[lo:hi] + self.sizes[lo:hi], b)
                       - np.maximum(self.starts[lo:hi], a))
        at = np.arange(a, a + len(of))
        ok = keep[of]
        at, of = at[ok], of[ok]
        place = at - self.starts[of]
        return at, place, self.sizes[of] - place

    def _hash(self, at: np.ndarray, length: int, a: int, b: int) -> np.ndarray:
        h = SubstringHash(self.buf[a:b + length])
        return h.of(at - a, at - a + length)

    def samples(self, keep: np.ndarray, length: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and ranks of the cover samples of kept texts."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
        width = length - PERIOD + 1
        for a in range(0, len(self.buf), SLICE):
            b = min(a + SLICE, len(self.buf))
            at, place, left = self._positions(keep, a, b)
            at = at[_IN_COVER[place % PERIOD] & (left >= width)]
            out.append((at, self._hash(at, width, a, b) >> np.uint64(64 - bits)))
        return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])

    def suffixes(self, keep: np.ndarray, length: int, tied: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and order keys of the suffixes that the tied samples at ``tied`` leave unresolved."""
        before = np.zeros(len(self.buf) + PERIOD + 1, np.int32)
        before[tied + 1] = 1
        before = np.cumsum(before, dtype=np.int32)  # tied samples before a position
        out = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
        for a in range(0, len(self.buf), SLICE):
            b = min(a + SLICE, len(self.buf))
            at, _, left = self._positions(keep, a, b)
            at = at[left >= length]
            at = at[before[at + PERIOD] > before[at]]
            out.append((at, self._hash(at, length, a, b)))
        return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def _ask(block: int, keys: np.ndarray, texts: np.ndarray | None, bits: int, buckets: int) -> list[tuple]:
    """Rows that send the distinct keys of a block to their buckets."""
    distinct, n = np.unique(keys, return_counts=True)
    # A bucket is a range of the key space, so each gets a run of the sorted keys.
    width = -(-(1 << bits) // buckets)
    edges = [min(k * width, 1 << bits) for k in range(1, buckets)]
    cut = [0, *np.searchsorted(distinct, np.array(edges, np.uint64)).tolist(), len(distinct)]
    text_keys = np.unique(texts) if texts is not None else np.zeros(0, np.uint64)
    text_cut = [0, *np.searchsorted(text_keys, np.array([((1 << 64) * k) // buckets for k in range(1, buckets)],
                                                        np.uint64)).tolist(), len(text_keys)]
    return [(block, k, pack_sorted(distinct[cut[k]:cut[k + 1]]), np.packbits(n[cut[k]:cut[k + 1]] > 1).tobytes(),
             pack(text_keys[text_cut[k]:text_cut[k + 1]]))
            for k in range(buckets) if cut[k] < cut[k + 1] or text_cut[k] < text_cut[k + 1]]


def _bits(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def sort_bucket(table: pa.Table, step: int) -> pa.Table:
    """Sort the keys of one bucket; tell each block which of its keys tie, and which whole texts do.

    For texts: 0 no tie, 1 the copy that stands for all, 2 another copy.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    blocks = np.array(table.column("block").to_pylist(), np.int64)
    order = np.argsort(blocks)
    pick = lambda c: [table.column(c)[int(i)].as_py() for i in order]
    blocks = blocks[order]
    lists = [unpack_sorted(x) for x in pick("keys")]
    sizes = [len(x) for x in lists]
    keys = np.concatenate(lists)
    by = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[by][1:] == keys[by][:-1]
    tied = np.empty(len(keys), bool)
    tied[by] = same[1:] | same[:-1]
    texts = [unpack(x, np.uint64) for x in pick("texts")]
    text_sizes = [len(x) for x in texts]
    text_keys = np.concatenate(texts)
    _, first, back, n = np.unique(text_keys, return_index=True, return_inverse=True, return_counts=True)
    state = np.where(n[back] > 1, 2, 0).astype(np.uint8)
    state[first[n > 1]] = 1
    rows, at, text_at = [], 0, 0
    for block, m, k, many in zip(blocks.tolist(), sizes, text_sizes, pick("many"), strict=True):
        rows.append((block, step, table.column("bucket")[0].as_py(),
                     np.packbits(tied[at:at + m] | _bits(many, m)).tobytes(), state[text_at:text_at + k].tobytes()))
        at, text_at = at + m, text_at + k
    return pa.Table.from_batches(batches(to_arrow_schema(REPLY), rows), schema=to_arrow_schema(REPLY))


class _Solver:
    """What a block does with its replies."""

    def __init__(self, texts: list[bytes], replies: list[dict], length: int, bits: int, buckets: int):
        self.block, self.length, self.bits, self.buckets, self.replies = Block(texts), length, bits, buckets, replies
        b = self.block
        at, ranks = b.samples(b.is_first, length, bits)
        whole = b.text_keys[b.is_first & (b.sizes >= length)]
        distinct, back = np.unique(ranks, return_inverse=True)
        tied = self._tied(0, distinct, bits)[back] if len(ranks) else np.zeros(0, bool)
        keys = np.unique(whole)
        state = np.concatenate([np.frombuffer(r["texts"], np.uint8) for r in self._of(0)] or [np.zeros(0, np.uint8)])
        status = np.zeros(len(texts), np.uint8)
        if len(keys):
            long = b.sizes >= length
            status[long] = state[np.searchsorted(keys, b.text_keys[long])]
        # Whole texts that occur elsewhere lose every byte; one copy stands for them in the buckets.
        self.gone = (status > 0) | ((b.copies > 1) & (b.sizes >= length))
        self.stands = b.is_first & (status < 2)
        self.at, self.keys = b.suffixes(self.stands, length, at[tied])

    def _of(self, step: int) -> list[dict]:
        return sorted((r for r in self.replies if r["step"] == step), key=lambda r: r["bucket"])

    def _tied(self, step: int, distinct: np.ndarray, bits: int) -> np.ndarray:
        width = -(-(1 << bits) // self.buckets)
        out = np.zeros(len(distinct), bool)
        for r in self._of(step):
            k = r["bucket"]
            a = np.searchsorted(distinct, np.uint64(k * width))
            b = len(distinct) if (k + 1) * width >= 1 << bits else np.searchsorted(distinct, np.uint64((k + 1) * width))
            out[a:b] = _bits(r["tied"], b - a)
        return out

    def covered(self) -> np.ndarray:
        """Bytes of the buffer under tied suffixes (texts that are gone as a whole are not marked)."""
        distinct, back = np.unique(self.keys, return_inverse=True)
        start = self.at[self._tied(1, distinct, 64)[back]] if len(back) else self.at
        mark = np.zeros(len(self.block.buf) + 1, np.int32)
        mark[start] += 1
        mark[start + self.length] -= 1
        return np.cumsum(mark[:-1]) > 0


def nearness(text: bytes) -> int:
    """The least hash of the substrings of NEAR_BYTES bytes (of the whole text when shorter)."""
    least, n = 1 << 64, len(text)
    for a in range(0, max(n - NEAR_BYTES + 1, 1), SLICE):
        part = np.frombuffer(text[a:a + SLICE + NEAR_BYTES - 1], np.uint8)
        at = np.arange(max(len(part) - NEAR_BYTES + 1, 1))
        least = min(least, int(SubstringHash(part).of(at, np.minimum(at + NEAR_BYTES, len(part))).min()))
    return (least >> 1)


def _blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """Stored blocks of neighbouring texts: (block, doc_ids, sizes, text)."""
    spark = docs.sparkSession
    one = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("near", T.LongType()),
        T.StructField("pos", T.LongType()), T.StructField("text", T.BinaryType())])
    schema = T.StructType([
        T.StructField("doc_ids", T.ArrayType(docs.schema[id_col].dataType)), T.StructField("sizes", T.BinaryType()),
        T.StructField("text", T.BinaryType())])

    def keyed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(one)
        for batch in it:
            yield from batches(arrow, [(i, nearness(t), p, pack_text(t)) for i, p, t in zip(
                batch.column("doc_id").to_pylist(), batch.column("pos").to_pylist(), text_bytes(batch), strict=True)])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)

        def row(ids: list, texts: list[bytes]) -> tuple:
            return (ids, pack(np.array([len(t) for t in texts], np.uint64)), pack_text(b"".join(texts)))

        ids, texts, size = [], [], 0
        for batch in it:
            for doc_id, packed in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(),
                                      strict=True):
                text = unpack_text(packed)
                if ids and size + len(text) > block_bytes:
                    yield from batches(arrow, [row(ids, texts)])
                    ids, texts, size = [], [], 0
                ids.append(doc_id)
                texts.append(text)
                size += len(text) + 16
        if ids:
            yield from batches(arrow, [row(ids, texts)])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("pos"),
                       F.col(text_col).alias("text")).mapInArrow(keyed, one)
    near = rows.repartitionByRange(n_partitions(spark), "near", "pos").sortWithinPartitions("near", "pos")
    return store(near.select("doc_id", "text").mapInArrow(run, schema)
                 .withColumn("block", F.monotonically_increasing_id()), "suffix-blocks")


def _texts(table: pa.Table | pa.RecordBatch) -> list[bytes]:
    sizes = unpack(table.column("sizes")[0].as_py(), np.uint64).astype(np.int64)
    raw, end = unpack_text(table.column("text")[0].as_py()), np.cumsum(sizes)
    return [raw[e - n:e] for e, n in zip(end.tolist(), sizes.tolist(), strict=True)]


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   with_text: bool = False, block_bytes: int = BLOCK_BYTES, buckets: int | None = None) -> DataFrame:
    """Per row: (doc_id, n_bytes, n_removed, n_spans, kept_sha256), and ``kept`` when ``with_text``.

    Strings are judged on the input and never cross texts; strings of the same
    text count, overlapping ones too. ``kept`` is the remaining UTF-8 bytes
    (binary, as a cut may fall inside a character). A null text counts as
    empty; texts shorter than ``length`` lose nothing; repeated rows are texts
    of their own; other columns are ignored; an empty table gives an empty
    result. Texts of any length are treated whole. ``length`` must exceed the
    period of the difference cover.
    """
    if length <= PERIOD:
        raise ValueError(f"length must be over {PERIOD}")
    spark = docs.sparkSession
    buckets = buckets or max(64, n_partitions(spark))
    total = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    # A rank is shortened to what keeps chance ties of unique samples rare (one in 4096); they are
    # harmless, as they only leave a suffix for the buckets.
    bits = min(64, max(32, math.ceil(math.log2(total / PERIOD * len(COVER) + 1)) + 12))
    texts = _blocks(docs, id_col, text_col, block_bytes).select("block", "doc_ids", "sizes", "text")

    def samples(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(ASKED)
        for batch in it:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                b = Block(_texts(one))
                _, ranks = b.samples(b.is_first, length, bits)
                yield from batches(arrow, _ask(one.column("block")[0].as_py(), ranks, b.text_keys[
                    b.is_first & (b.sizes >= length)], bits, buckets))

    ranks = store(texts.mapInArrow(samples, ASKED).groupBy("bucket")
                  .applyInArrow(lambda t: sort_bucket(t, 0), REPLY), "suffix-ranks")

    def suffixes(block: pa.Table, replies: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        s = _Solver(_texts(block), replies.to_pylist(), length, bits, buckets)
        rows = _ask(block.column("block")[0].as_py(), s.keys, None, 64, buckets)
        return pa.Table.from_batches(batches(to_arrow_schema(ASKED), rows), schema=to_arrow_schema(ASKED))

    ties = texts.groupBy("block").cogroup(ranks.groupBy("block")).applyInArrow(suffixes, ASKED) \
        .groupBy("bucket").applyInArrow(lambda t: sort_bucket(t, 1), REPLY)
    out = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType())] + ([T.StructField("kept", T.BinaryType())] if with_text else []))

    def finish(block: pa.Table, replies: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        s = _Solver(_texts(block), replies.to_pylist(), length, bits, buckets)
        b, covered, rows = s.block, s.covered(), []
        # Copies within the block share the result of the first one unless they are gone as a whole.
        first = {int(k): i for i, k in zip(np.flatnonzero(b.is_first), b.text_keys[b.is_first], strict=True)}
        for i, doc_id in enumerate(block.column("doc_ids")[0].as_py()):
            j = first[int(b.text_keys[i])]
            n, a = int(b.sizes[i]), int(b.starts[j])
            gone = np.ones(n, bool) if s.gone[i] else covered[a:a + n]
            kept = b.buf[a:a + n][~gone].tobytes()
            spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
            rows.append((doc_id, n, int(gone.sum()), spans, sha256(kept).hexdigest(), *([kept] if with_text else [])))
        return pa.Table.from_batches(batches(to_arrow_schema(out), rows), schema=to_arrow_schema(out))

    return texts.groupBy("block").cogroup(ranks.unionByName(ties).groupBy("block")).applyInArrow(finish, out)


def query(spark, sf_dir):
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
