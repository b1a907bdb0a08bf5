"""Exact n-gram Jaccard join: size-banded tiles with bitmap signatures.

Every text is the set of hashes of its word shingles; texts with equal sets are
one class. Two sets of similarity t or more share at least ceil(t n) shingles of
each, and so one of the first n - ceil(t n) + 1 shingles of each (the prefix) in
any fixed order of all shingles. In the order used here, shingles of one class
alone come first; a class with a whole prefix of them links nothing.

1. Blocks of texts send their shingles (shortened hashes, as gaps) and classes to
   buckets and learn, one bit each, which shingles another class may hold, and
   which classes they stand for (the first block of a class does).
2. Classes with a shared shingle in their prefix are candidates: their sets are
   stored with a bitmap signature.
3. The candidates of a shingle are first compared with two of them (linear in the
   group, so a group of near copies is joined without its pairs); linked classes
   become components.
4. What is left are pairs of one shingle in different components. They are
   compared completely: the classes are cut into bands by size (a link spans at
   most neighbouring bands) and hashed tiles of bounded size; in a pair of
   tiles the bit counts of the signatures bound the overlap from above. The
   classes of pairs that the bound leaves get their sets and meet once more in
   the same tiles, where these pairs are intersected exactly and give links that
   join the tiles' components; no table has a row for each pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import (
    LOWER,
    batches,
    by_key,
    discard,
    free_name,
    lean,
    mix,
    n_partitions,
    pack,
    pack_sorted,
    pack_text,
    release,
    store,
    text_bytes,
    unpack,
    unpack_sorted,
    unpack_text,
    word_hashes,
)
from strata.llm.components import connected_components

WORDS = 5
PERCENT = 80
BLOCK_BYTES = 2 << 20
SIGNATURE = 1 << 14  # bits of the comparison in tiles, at most; below that a signature has two to four bits a shingle
TILE = 2048
PART_SHINGLES = 1_000_000  # shingles on either side of the exact comparison that one task holds (and one text more)
BUCKET_SHINGLES = 4_000_000  # shingles (of all blocks) that one task looks up at once

_IS_WORD = np.ones(256, bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False

ASKED = T.StructType([T.StructField("block", T.LongType()), T.StructField("bucket", T.IntegerType()),
                      T.StructField("keys", T.BinaryType()), T.StructField("many", T.BinaryType()),
                      T.StructField("classes", T.BinaryType())])
REPLY = T.StructType([T.StructField("block", T.LongType()), T.StructField("bucket", T.IntegerType()),
                      T.StructField("shared", T.BinaryType()), T.StructField("owned", T.BinaryType())])
CANDIDATES = T.StructType([
    T.StructField("class", T.LongType()), T.StructField("n", T.IntegerType()),
    T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("small", T.BinaryType()),
    T.StructField("signature", T.BinaryType()),
    T.StructField("shingles", T.BinaryType())])
PAIRS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
REQUESTS = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("cell_band", T.IntegerType()), T.StructField("up", T.IntegerType()),
    T.StructField("t", T.IntegerType()), T.StructField("u", T.IntegerType()), T.StructField("part", T.LongType()),
    T.StructField("other", T.LongType()), T.StructField("class", T.LongType()), T.StructField("component", T.LongType()),
    T.StructField("place", T.LongType()), T.StructField("partners", T.BinaryType())])


class Shingles:
    """The shingle sets of a list of texts: sorted distinct hashes, text by text."""

    def __init__(self, texts: list[bytes], words: int):
        buf = np.frombuffer(b" ".join(t.translate(LOWER) for t in texts) + b" ", np.uint8)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        inside = _IS_WORD[buf]
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        first = np.searchsorted(start, np.cumsum(sizes) - sizes)
        n_words = np.diff(np.append(first, len(start)))
        h = word_hashes(buf, start, end)
        # A shingle starts at each word that has enough followers in its text; a short text is one shingle.
        n_shingles = np.where(n_words >= words, n_words - words + 1, np.minimum(n_words, 1))
        of = np.repeat(np.arange(len(texts)), n_shingles)
        at = np.arange(len(of)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles) + first[of]
        length = np.minimum(n_words, words)[of]
        code = np.zeros(len(of), np.uint64)
        for k in range(words):
            more = k < length
            nxt = h[np.minimum(at + k, max(len(h) - 1, 0))] if len(h) else code
            code = np.where(more, mix(code * np.uint64(0x9E3779B97F4A7C15) + nxt + np.uint64(k + 1)), code)
        ends = np.cumsum(n_shingles)
        for a, b in zip((ends - n_shingles).tolist(), ends.tolist(), strict=True):
            code[a:b].sort()
        keep = np.ones(len(code), bool)
        keep[1:] = (code[1:] != code[:-1]) | (of[1:] != of[:-1])
        self.codes, self.of = code[keep], of[keep]
        self.sizes = np.bincount(self.of, minlength=len(texts))
        self.starts = np.cumsum(self.sizes) - self.sizes
        ids = [int.from_bytes(blake2b(self[i].tobytes(), digest_size=8).digest(), "little", signed=True)
               if self.sizes[i] else 0 for i in range(len(texts))]
        self.classes = np.array(ids, np.int64)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.codes[self.starts[i]:self.starts[i] + self.sizes[i]]

    def prefixes(self, shared: np.ndarray, percent: int, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, shingle) of the shared shingles in the prefixes of the kept texts."""
        use = keep[self.of]
        codes, of, shared = self.codes[use], self.of[use], shared[use]
        n = np.bincount(of, minlength=len(self.sizes))
        # The order puts a text's unshared shingles first, then the shared ones by their codes.
        unshared = np.bincount(of[~shared], minlength=len(n))
        upto = np.cumsum(shared)
        before = np.concatenate([[0], upto])[np.cumsum(n) - n]  # shared ones of the texts before
        place = unshared[of] + upto - 1 - before[of]
        # overlap of at least percent of the union needs ceil(percent n / 100) shingles of this set
        size = n - -(-percent * n // 100) + 1
        take = shared & (place < size[of])
        return of[take], codes[take]


def signature(codes: np.ndarray, bits: int) -> np.ndarray:
    """Bitmap of ``bits`` (a power of two, at least 64): a bit for each shingle hash."""
    out = np.zeros(bits, bool)
    out[(codes & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").view(np.uint64)


def signature_bits(n: int) -> int:
    return 1 << max(8, math.ceil(math.log2(2 * max(n, 1))))


def fold(sig: np.ndarray, bits: int) -> np.ndarray:
    """The signature of the same set with fewer bits."""
    while len(sig) * 64 > bits:
        half = len(sig) // 2
        sig = sig[:half] | sig[half:]
    return sig


def may_link(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int, percent: int) -> bool:
    """Whether the bit counts of two signatures leave an overlap large enough for a link."""
    bits = 64 * min(len(a), len(b))
    a, b = fold(a, bits), fold(b, bits)
    overlap = min(n_a - int(np.bitwise_count(a & ~b).sum()), n_b - int(np.bitwise_count(b & ~a).sum()))
    return 100 * overlap >= percent * (n_a + n_b - overlap)


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    overlap = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * overlap >= percent * (len(a) + len(b) - overlap)


def _blocks(docs: DataFrame, id_col: str, text_col: str, words: int, block_bytes: int, row_col: str | None) -> DataFrame:
    """Stored blocks of texts with their classes (and row ids, where the table has them)."""
    schema = T.StructType([
        T.StructField("rows", T.ArrayType(T.LongType())), T.StructField("doc_ids", T.ArrayType(docs.schema[id_col].dataType)),
        T.StructField("n", T.ArrayType(T.LongType())), T.StructField("classes", T.ArrayType(T.LongType())),
        T.StructField("sizes", T.BinaryType()), T.StructField("text", T.BinaryType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)

        def row(rows: list, ids: list, texts: list[bytes]) -> tuple:
            s = Shingles(texts, words)
            return (rows, ids, s.sizes.tolist(), s.classes.tolist(), pack(np.array([len(t) for t in texts], np.uint64)),
                    pack_text(b"".join(texts)))

        rows, ids, texts, size = [], [], [], 0
        for batch in it:
            for r, i, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(),
                                  text_bytes(batch), strict=True):
                if ids and size + len(text) > block_bytes:
                    yield from batches(arrow, [row(rows, ids, texts)])
                    rows, ids, texts, size = [], [], [], 0
                rows.append(r)
                ids.append(i)
                texts.append(text)
                size += len(text) + 16
        if ids:
            yield from batches(arrow, [row(rows, ids, texts)])

    rows = docs.select((F.col(row_col) if row_col else F.lit(0).cast("long")).alias("row"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"))
    return store(rows.mapInArrow(lean(run), schema).withColumn("block", F.monotonically_increasing_id()), "shingle-blocks")


def _block_texts(table: pa.Table | pa.RecordBatch) -> list[bytes]:
    sizes = unpack(table.column("sizes")[0].as_py(), np.uint64).astype(np.int64)
    raw, end = unpack_text(table.column("text")[0].as_py()), np.cumsum(sizes)
    return [raw[e - n:e] for e, n in zip(end.tolist(), sizes.tolist(), strict=True)]


def _firsts(s: Shingles) -> np.ndarray:
    """Texts with shingles that stand for their class within the block."""
    first = np.zeros(len(s.classes), bool)
    first[np.unique(s.classes, return_index=True)[1]] = True
    return first & (s.sizes > 0)


def _block_classes(s: Shingles) -> np.ndarray:
    """The distinct classes of a block's texts with shingles, as sorted unsigned numbers."""
    return np.unique(s.classes[s.sizes > 0].view(np.uint64))


def _cuts(keys: np.ndarray, bits: int, buckets: int) -> list[int]:
    """Where the buckets (equal ranges of the key space) begin in sorted keys."""
    width = -(-(1 << bits) // buckets)
    edges = np.array([min(k * width, (1 << bits) - 1) for k in range(1, buckets)], np.uint64)
    return [0, *np.searchsorted(keys, edges).tolist(), len(keys)]


def _candidates(blocks: DataFrame, words: int, percent: int, buckets: int, bits: int) -> DataFrame:
    """Stored classes with a shared shingle in the prefix: (class, n, keys, small, signature, shingles)."""
    texts = blocks.select("block", "sizes", "text")
    short = np.uint64(64 - bits)

    def ask(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(ASKED)
        for batch in it:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                s = Shingles(_block_texts(one), words)
                distinct, n = np.unique(s.codes[_firsts(s)[s.of]] >> short, return_counts=True)
                classes = _block_classes(s)
                cut, by = _cuts(distinct, bits, buckets), _cuts(classes, 64, buckets)
                block = one.column("block")[0].as_py()
                yield from batches(arrow, [
                    (block, k, pack_sorted(distinct[cut[k]:cut[k + 1]]), np.packbits(n[cut[k]:cut[k + 1]] > 1).tobytes(),
                     pack_sorted(classes[by[k]:by[k + 1]]))
                    for k in range(buckets) if cut[k] < cut[k + 1] or by[k] < by[k + 1]])

    def answer(table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        lists = [unpack_sorted(x) for x in table.column("keys").to_pylist()]
        keys = np.concatenate(lists)
        by = np.argsort(keys, kind="stable")
        same = np.zeros(len(keys) + 1, bool)
        same[1:-1] = keys[by][1:] == keys[by][:-1]
        shared = np.empty(len(keys), bool)
        shared[by] = same[1:] | same[:-1]
        blocks = table.column("block").to_pylist()
        held = [unpack_sorted(x) for x in table.column("classes").to_pylist()]
        classes, of = np.concatenate(held), np.repeat(np.array(blocks, np.int64), [len(x) for x in held])
        order = np.lexsort((of, classes))
        owned = np.zeros(len(classes), bool)
        owned[order[np.flatnonzero(np.diff(classes[order], prepend=~classes[order][:1]))]] = True
        rows, at, class_at = [], 0, 0
        for block, x, many, c in zip(blocks, lists, table.column("many").to_pylist(), held, strict=True):
            own = np.unpackbits(np.frombuffer(many, np.uint8), count=len(x)).astype(bool)
            rows.append((block, table.column("bucket")[0].as_py(), np.packbits(shared[at:at + len(x)] | own).tobytes(),
                         np.packbits(owned[class_at:class_at + len(c)]).tobytes()))
            at, class_at = at + len(x), class_at + len(c)
        del keys, by, lists, held, classes, order
        release()
        return pa.Table.from_batches(batches(to_arrow_schema(REPLY), rows), schema=to_arrow_schema(REPLY))

    replies = texts.mapInArrow(lean(ask), ASKED).groupBy("bucket").applyInArrow(answer, REPLY)

    def choose(block: pa.Table, replies: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        s = Shingles(_block_texts(block), words)
        first = _firsts(s)
        distinct, classes = np.unique(s.codes[first[s.of]] >> short), _block_classes(s)
        cut, by = _cuts(distinct, bits, buckets), _cuts(classes, 64, buckets)
        shared, owned = np.zeros(len(distinct), bool), np.zeros(len(classes), bool)
        for r in replies.to_pylist():
            a, b = cut[r["bucket"]], cut[r["bucket"] + 1]
            shared[a:b] = np.unpackbits(np.frombuffer(r["shared"], np.uint8), count=b - a).astype(bool)
            a, b = by[r["bucket"]], by[r["bucket"] + 1]
            owned[a:b] = np.unpackbits(np.frombuffer(r["owned"], np.uint8), count=b - a).astype(bool)
        stands = first.copy()
        stands[first] = owned[np.searchsorted(classes, s.classes[first].view(np.uint64))]
        at = np.searchsorted(distinct, s.codes >> short)
        hit = shared[np.minimum(at, max(len(distinct) - 1, 0))] if len(distinct) else np.zeros(len(s.codes), bool)
        of, codes = s.prefixes(hit, percent, stands)
        edge = np.flatnonzero(np.diff(of, prepend=-1, append=-1))
        rows = []
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            i = int(of[a])
            sig = signature(s[i], signature_bits(int(s.sizes[i])))
            rows.append((int(s.classes[i]), int(s.sizes[i]), codes[a:b].view(np.int64).tolist(),
                         fold(sig, SIGNATURE).tobytes(), sig.tobytes(), pack_sorted(s[i])))
        return pa.Table.from_batches(batches(to_arrow_schema(CANDIDATES), rows), schema=to_arrow_schema(CANDIDATES))

    return store(texts.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(choose, CANDIDATES),
                 "jaccard-candidates")


def _both(pairs: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with columns of both classes, as ``<column>_a`` and ``<column>_b``."""
    side = lambda x: sets.select(F.col("class").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in columns])
    return pairs.join(side("a"), "a").join(side("b"), "b")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link: by the bit counts of their signatures first, and
    what these leave by exact intersection of the sorted sets."""

    def bound(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            n_a, n_b = batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist()
            keep = [100 * min(x, y) >= percent * max(x, y) and may_link(
                np.frombuffer(s.as_py(), np.uint64), x, np.frombuffer(t.as_py(), np.uint64), y, percent)
                for x, y, s, t in zip(n_a, n_b, batch.column("signature_a"), batch.column("signature_b"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def exact(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            keep = [links(unpack_sorted(x.as_py()), unpack_sorted(y.as_py()), percent)
                    for x, y in zip(batch.column("shingles_a"), batch.column("shingles_b"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = store(_both(pairs, sets, ["n", "signature"]).select("a", "b", "n_a", "n_b", "signature_a", "signature_b")
                 .mapInArrow(lean(bound), PAIRS), "jaccard-bounded")
    return store(_both(left, sets, ["shingles"]).mapInArrow(lean(exact), PAIRS), "jaccard-links")


def _stars(entries: DataFrame, salt: int) -> DataFrame:
    """Pairs of each class of a shingle with one centre of the shingle: the least by a hash.

    Centres are found by an aggregate that reduces in every task; a shingle that very many classes hold is
    joined by broadcast.
    """
    rank = F.struct(F.xxhash64("class", F.lit(salt)).alias("h"), F.col("class").alias("c"))
    centres = store(entries.groupBy("key").agg(F.min(rank)["c"].alias("centre"), F.count(F.lit(1)).alias("held")),
                    "jaccard-centres")
    pairs = by_key(entries, centres, ["key"], "held").filter(F.col("class") != F.col("centre"))
    return pairs.select(F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b")).distinct()


def _open(entries: DataFrame, components: DataFrame) -> DataFrame:
    """Entries of the shingles whose classes are in more than one component, with the component."""
    labelled = entries.join(components, "class", "left").withColumn("component", F.coalesce("component", "class"))
    labelled = store(labelled, "jaccard-open")
    many = labelled.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"),
                                       F.count(F.lit(1)).alias("held")).filter("_lo < _hi").select("key", "held")
    return by_key(labelled, store(many, "jaccard-open-keys"), ["key"], "held").filter("held IS NOT NULL").drop("held")


CELL_KEY = ["key", "cell_band", "up", "t", "u"]
CELL = "array<struct<up:int,t:int,u:int,side:int,cell_band:int>>"


def _cells(entries: DataFrame, percent: int) -> DataFrame:
    """The entries of each shingle dealt to pairs of tiles: ``cell_band``, ``up``, ``t``, ``u`` and ``side``.

    A link spans sizes of ratio percent / 100 at most, so at most two neighbouring bands. A (shingle, band) has
    as many tiles as its size asks for; a class meets the tiles of its own band, each pair of tiles once, and those of
    the next band.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + 1e-9).cast("int")
    entries = entries.withColumn("band", band)
    width = entries.groupBy("key", "band").agg(F.count(F.lit(1)).alias("held")).withColumn(
        "tiles", F.ceil(F.col("held") / TILE).cast("int"))
    per_key = Window.partitionBy("key").orderBy("band").rangeBetween
    width = width.withColumns({"below": F.max("tiles").over(per_key(-1, -1)), "above": F.max("tiles").over(per_key(1, 1))})
    entries = by_key(entries, store(width, "jaccard-tiles"), ["key", "band"], "held").withColumn(
        "tile", F.pmod(F.xxhash64("class"), F.col("tiles")).cast("int"))
    numbers = lambda n: F.sequence(F.lit(0), n - 1)
    own = F.transform(numbers(F.col("tiles")), lambda t: F.struct(
        F.lit(0).alias("up"), F.least(t, F.col("tile")).alias("t"), F.greatest(t, F.col("tile")).alias("u"),
        (F.col("tile") > t).cast("int").alias("side"), F.col("band").alias("cell_band")))
    up = F.when(F.col("above").isNotNull(), F.transform(numbers(F.col("above")), lambda t: F.struct(
        F.lit(1).alias("up"), F.col("tile").alias("t"), t.alias("u"), F.lit(0).alias("side"),
        F.col("band").alias("cell_band"))))
    down = F.when(F.col("below").isNotNull(), F.transform(numbers(F.col("below")), lambda t: F.struct(
        F.lit(1).alias("up"), t.alias("t"), F.col("tile").alias("u"), F.lit(1).alias("side"),
        (F.col("band") - 1).alias("cell_band"))))
    empty = F.array().cast(CELL)
    return entries.withColumn("cell", F.explode(F.concat(own, F.coalesce(up, empty), F.coalesce(down, empty)))).select(
        "key", "cell.*", "class", "component", "n")


def _tile_requests(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stored classes of each cell with a pair of different components that sizes and signatures leave.

    A row is one class of one part of a cell, with its ``place`` there and the places of its ``partners``: as many
    rows as a cell has classes at most, however many pairs they form. Parts bound the shingles that meet in a task.
    A pair that shares several open shingles is taken up at the least of them only: an entry carries the lesser
    open shingles of its class's prefix, and two classes with one in common there were compared before.
    """
    entries = store(entries.select("key", "class", "n", "component"), "jaccard-open-entries")
    keys = entries.groupBy("class").agg(F.collect_list("key").alias("keys"))  # at most a prefix
    earlier = F.filter("keys", lambda k: k < F.col("key")).alias("earlier")
    sets = keys.join(sets.select("class", "small"), "class")
    # Cells are dealt as numbers; signatures and lesser shingles join last and are shuffled once.
    cells = _cells(entries, percent).join(sets, "class").select("*", earlier).drop("keys")

    def compare(table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        table = table.sort_by("class")  # places do not depend on the order of arrival
        cls, comp, n, side = (table.column(c).to_numpy() for c in ("class", "component", "n", "side"))
        sigs = [np.frombuffer(x, np.uint64) for x in table.column("small").to_pylist()]
        before = [frozenset(x) for x in table.column("earlier").to_pylist()]
        width = 64 * min(map(len, sigs))
        sig = np.stack([fold(x, width) for x in sigs])
        cell = [table.column(c)[0].as_py() for c in CELL_KEY]
        crossing = table.column("up")[0].as_py() or table.column("t")[0].as_py() != table.column("u")[0].as_py()
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if crossing else left
        part = (np.cumsum(n, dtype=np.int64) - n) // PART_SHINGLES
        found, met = {}, {}  # of each part: the partners by place, and every place of a pair
        for i in left.tolist():
            j = right if crossing else right[cls[right] > cls[i]]
            j = j[(comp[j] != comp[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))]
            if len(j):
                over = np.minimum(n[i] - np.bitwise_count(sig[i] & ~sig[j]).sum(1).astype(np.int64),
                                  n[j] - np.bitwise_count(sig[j] & ~sig[i]).sum(1).astype(np.int64))
                j = j[100 * over >= percent * (n[i] + n[j] - over)]
                j = np.array([k for k in j.tolist() if before[i].isdisjoint(before[k])], np.int64)
                for p in np.unique(part[j]).tolist():
                    at, these = (int(part[i]), p), j[part[j] == p]
                    found.setdefault(at, {})[i] = pack_sorted(these)
                    met.setdefault(at, np.zeros(len(cls), bool))[these] = True
                    met[at][i] = True
        rows = [(*cell, *at, int(cls[i]), int(comp[i]), i, found[at].get(i))
                for at, places in met.items() for i in np.flatnonzero(places).tolist()]
        return pa.Table.from_batches(batches(to_arrow_schema(REQUESTS), rows), schema=to_arrow_schema(REQUESTS))

    return store(cells.groupBy(*CELL_KEY).applyInArrow(compare, REQUESTS), "jaccard-requests")


def _partners(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Each class of a part of a cell that has partners, and these, as rows of the table."""
    places = table.column("place").to_numpy()
    row = np.zeros(int(places.max()) + 1, np.int64)
    row[places] = np.arange(len(places))
    for i, x in enumerate(table.column("partners").to_pylist()):
        if x is not None:
            yield i, row[unpack_sorted(x).astype(np.int64)]


def _tile_pairs(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of one shingle and different components that sizes and signatures leave, all of them."""

    def pairs(table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        cls = table.column("class").to_numpy()
        a, b = (np.concatenate(x) for x in zip(*((np.full(len(j), i), j) for i, j in _partners(table)), strict=True))
        return pa.table({"a": np.minimum(cls[a], cls[b]), "b": np.maximum(cls[a], cls[b])}, schema=to_arrow_schema(PAIRS))

    return _tile_requests(entries, sets, percent).groupBy(*CELL_KEY, "part", "other").applyInArrow(pairs, PAIRS)


def _tile_links(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join the same components as all links between classes of one open shingle.

    The pairs that sizes and signatures leave are intersected exactly in the task that holds their part of a cell.
    Of links between the same components (as joined there so far) one is returned, so a part
    gives fewer links than it has classes.
    """

    def exact(table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        table = table.sort_by("place")
        cls, group = table.column("class").to_numpy(), table.column("component").to_numpy().copy()
        lists = [unpack_sorted(x) for x in table.column("shingles").to_pylist()]
        n = np.array([len(x) for x in lists], np.int64)
        distinct, codes = np.unique(np.concatenate(lists), return_inverse=True)
        codes = np.split(codes.astype(np.int32), np.cumsum(n)[:-1])
        held = np.zeros(len(distinct), bool)
        del lists, distinct
        a, b = [], []
        for i, j in _partners(table):
            j = j[group[j] != group[i]]
            if len(j):
                held[codes[i]] = True
                over = np.array([np.count_nonzero(held[codes[k]]) for k in j.tolist()], np.int64)
                held[codes[i]] = False
                j = j[100 * over >= percent * (n[i] + n[j] - over)]
                joined, first = np.unique(group[j], return_index=True)
                a += [cls[i]] * len(first)
                b += cls[j[first]].tolist()
                group[np.isin(group, joined)] = group[i]
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        release()
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)}, schema=to_arrow_schema(PAIRS))

    parts = _tile_requests(entries, sets, percent).join(sets.select("class", "shingles"), "class")
    return parts.groupBy(*CELL_KEY, "part", "other").applyInArrow(exact, PAIRS)


def classes_and_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                           percent: int = PERCENT, block_bytes: int = BLOCK_BYTES,
                           buckets: int | None = None, row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows: _row, doc_id, n_shingles, class) and (components: class, component) of the linked classes."""
    blocks = _blocks(docs, id_col, text_col, words, block_bytes, row_col)
    rows = store(blocks.select(F.explode(F.arrays_zip("rows", "doc_ids", "n", "classes")).alias("r")).select(
        F.col("r.rows").alias("_row"), F.col("r.doc_ids").alias("doc_id"), F.col("r.n").alias("n_shingles"),
        F.col("r.classes").alias("class")), "jaccard-rows")
    # A shortened hash keeps chance meetings rare (one in 4096); they only make candidates.
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    bits = min(64, max(32, math.ceil(math.log2(total + 1)) + 12))
    buckets = buckets or max(64, n_partitions(docs.sparkSession), -(-total // BUCKET_SHINGLES))
    found = _candidates(blocks, words, percent, buckets, bits)
    discard(blocks)
    sets = found  # one row per class, as one block stands for it
    entries = found.select("class", "n", F.explode("keys").alias("key"))
    # A shingle of one class alone (its copies met) links nothing.
    several = entries.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("key")
    entries = store(entries.join(several, "key"), "jaccard-entries")
    linked = _verify(_stars(entries, 1).unionByName(_stars(entries, 2)).distinct(), sets, percent)
    components = connected_components(linked)
    rest = _tile_links(_open(entries, components), sets, percent)
    linked = store(linked.unionByName(rest), "jaccard-links")
    return rows, connected_components(linked)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: (doc_id, n_shingles, component_id).

    The set of a text is its distinct shingles of ``words`` words (white space of ASCII
    splits, A-Z lower-cased); a shorter text is one shingle of all its words; a
    null text or one without words has no shingles and is its own component.
    Two rows link when 100 * intersection >= percent * union of non-empty sets;
    ``component_id`` is the smallest id reachable by links (null ids are not
    counted; null when no row of the component has an id). Repeated rows link
    like other equal sets; very long texts are compared whole; other columns are ignored;
    an empty table gives an empty result. Sets are of 64-bit hashes of shingles (words beyond 64 bytes enter by
    blake2b), classes of 64-bit hashes of sets.
    """
    rows, components = classes_and_components(docs, id_col, text_col, **options)
    labelled = rows.join(components, "class", "left").withColumn(
        "_component", F.coalesce("component", "class")).select("doc_id", "n_shingles", "_component")
    full = labelled.filter("n_shingles > 0")
    least = full.groupBy("_component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("_n"))
    alone = labelled.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    whole = by_key(full, store(least, "jaccard-least"), ["_component"], "_n")
    return whole.select("doc_id", "n_shingles", "component_id").unionByName(alone)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without all but one document of each component.

    The row with the smallest (id, row) stays, null ids last; texts without shingles all stay. Very long texts
    are compared whole; names of other columns cannot clash. The rows are stored once with a row id of
    their own, which everything that follows reads, so it does not matter how often or how the input is scanned.
    """
    row = free_name(docs, "_row")
    kept = store(docs.withColumn(row, F.monotonically_increasing_id()), "jaccard-docs")
    rows, components = classes_and_components(kept, id_col, text_col, row_col=row, **options)
    full = rows.filter("n_shingles > 0").join(components, "class", "left").select(
        F.coalesce("component", "class").alias("_component"),
        F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row").alias("at"))
    full = store(full, "jaccard-members")
    least = full.groupBy("_component").agg(F.min("at").alias("_least"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    drop = store(by_key(full, store(least, "jaccard-least"), ["_component"], "_n").filter(F.col("at") > F.col("_least"))
                 .select(F.col("at._row").alias(row)), "jaccard-dropped")
    return kept.join(drop, row, "left_anti").select(*docs.columns)


def query(spark, sf_dir):
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sh AS (
  SELECT DISTINCT r, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
  FROM d, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS t(i) WHERE len(w) > 0
), n AS (
  SELECT r, count(*) AS n FROM sh GROUP BY r
), pairs AS (
  SELECT a.r AS x, b.r AS y, count(*) AS c FROM sh a JOIN sh b USING (s) WHERE a.r <> b.r GROUP BY a.r, b.r
), link AS (
  SELECT x, y FROM pairs JOIN n nx ON nx.r = x JOIN n ny ON ny.r = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)
), reach AS (
  SELECT r AS x, r AS y FROM d
  UNION
  SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM reach JOIN d ON d.r = reach.x JOIN d o ON o.r = reach.y LEFT JOIN n ON n.r = d.r
GROUP BY d.r, d.doc_id, n.n
"""
