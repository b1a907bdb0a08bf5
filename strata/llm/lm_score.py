"""Language-model scores by subword lattice likelihood.

The model is a unigram vocabulary over words: the pieces of a public subword
vocabulary (its scores give the starting weights, re-estimated by
forward-backward over all distinct training words) and, as one more arc over
the whole lattice of a word, every word seen in training. A word's probability
is the sum over all its segmentations by forward recursion in log space; a
document's is the product over its words and its end.

Counts come from all training documents. Documents are packed into blocks; a
block lists its distinct words by hash bucket; a bucket gathers the words of all
blocks, counts and scores each word once, and sends the answers back to the
blocks. So a frequent word is one entry per block, never one row per use, and
the vocabulary of the corpus is never held in one place.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import batches, n_partitions, pack, pack_text, store, text_bytes, unpack, unpack_text, words_of
from strata.llm.lattice import Lattice, vocabulary_pieces

BLOCK_BYTES = 8 << 20  # text of a block, about
ROUNDS = 2  # forward-backward passes over the distinct training words

WORDS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("words", T.BinaryType()),
                      T.StructField("counts", T.BinaryType()), T.StructField("n_known", T.LongType()),
                      T.StructField("n_once", T.LongType()), T.StructField("n_twice", T.LongType())])
ANSWERS = T.StructType([T.StructField("block", T.LongType()), T.StructField("bucket", T.IntegerType()),
                        T.StructField("counts", T.BinaryType()), T.StructField("log10_p", T.BinaryType())])


def _join(words: list[bytes]) -> bytes:
    return pack_text(b"\n".join(words), 1)


def _split(blob: bytes) -> list[bytes]:
    raw = unpack_text(blob)
    return raw.split(b"\n") if raw else []


def _schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("doc_ids", T.ArrayType(id_type)), T.StructField("held", T.ArrayType(T.BooleanType())),
        T.StructField("n_words", T.BinaryType()), T.StructField("distinct", T.BinaryType()),
        T.StructField("ids", T.BinaryType()), T.StructField("uses", T.BinaryType()),
        T.StructField("words", T.ArrayType(T.BinaryType())), T.StructField("counts", T.ArrayType(T.BinaryType())),
        T.StructField("train_words", T.LongType()), T.StructField("train_docs", T.LongType())])


class _Block:
    """Documents of a block as numbers of its distinct words."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.doc_ids, self.held, self.n_words, self.distinct, self.ids, self.uses = [], [], [], [], [], []
        self.size = 0

    def add(self, doc_id, held: bool, text: bytes) -> None:
        tokens = words_of(text)
        uses = Counter(tokens)
        number = self.number
        self.ids.append(np.fromiter((number.setdefault(w, len(number)) for w in uses), np.int64, len(uses)))
        self.uses.append(np.fromiter(uses.values(), np.int64, len(uses)))
        self.doc_ids.append(doc_id)
        self.held.append(held)
        self.n_words.append(len(tokens))
        self.distinct.append(len(uses))
        self.size += len(text) + 64

    def row(self, buckets: int) -> tuple:
        words = list(self.number)
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
        # Answers come back in this order: by bucket, then by word.
        order = sorted(range(len(words)), key=words.__getitem__)
        order = np.array(order, np.int64)[np.argsort(bucket[order], kind="stable")] if words else np.zeros(0, np.int64)
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        ids = np.concatenate(self.ids) if self.ids else np.zeros(0, np.int64)
        uses = np.concatenate(self.uses) if self.uses else ids
        train = ~np.array(self.held, bool)
        count = np.bincount(ids, uses * np.repeat(train, self.distinct), len(words)).astype(np.uint32)
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        ranges = [order[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return (self.doc_ids, self.held, pack(np.array(self.n_words, np.uint64)),
                pack(np.array(self.distinct, np.uint32)), pack(place[ids].astype(np.uint32)),
                pack(uses.astype(np.uint32)), [_join([words[i] for i in r]) for r in ranges],
                [pack(count[r]) for r in ranges], int((np.array(self.n_words) * train).sum()), int(train.sum()))


def _blocks(docs: DataFrame, id_col: str, text_col: str, buckets: int, block_bytes: int) -> DataFrame:
    schema = _schema(docs.schema[id_col].dataType)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held"),
                       F.col(text_col).alias("text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        block = _Block()
        for batch in it:
            for doc_id, held, text in zip(batch.column("doc_id").to_pylist(), batch.column("held").to_pylist(),
                                          text_bytes(batch), strict=True):
                block.add(doc_id, held, text)
                if block.size >= block_bytes:
                    yield from batches(arrow, [block.row(buckets)])
                    block = _Block()
        if block.doc_ids:
            yield from batches(arrow, [block.row(buckets)])

    return store(rows.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id()), "lm-blocks")


def held_out(doc_id: F.Column) -> F.Column:
    """One document in ten, by the checksum of its id as text (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _gather(table: pa.Table) -> pa.Table:
    """Distinct words of a bucket with their training counts over all blocks."""
    from pyspark.sql.pandas.types import to_arrow_schema
    total: dict[bytes, int] = {}
    get = total.get
    for words, counts in zip(table.column("words").to_pylist(), table.column("counts").to_pylist(), strict=True):
        for w, c in zip(_split(words), unpack(counts, np.uint32).tolist(), strict=True):
            total[w] = get(w, 0) + c
    words = sorted(total)
    counts = np.array([total[w] for w in words], np.uint64)
    return pa.table({"bucket": table.column("bucket").slice(0, 1), "words": pa.array([_join(words)], pa.binary()),
                     "counts": pa.array([pack(counts)], pa.binary()),
                     "n_known": pa.array([int((counts > 0).sum())], pa.int64()),
                     "n_once": pa.array([int((counts == 1).sum())], pa.int64()),
                     "n_twice": pa.array([int((counts == 2).sum())], pa.int64())}, schema=to_arrow_schema(WORDS))


def estimate(words: DataFrame, pieces: list[bytes], log_p: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Piece log probabilities after ``rounds`` of forward-backward over the distinct training words."""
    sc = words.sparkSession.sparkContext
    schema = T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("n", T.DoubleType())])

    def expected(it: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*model.value)
        counts = np.zeros(len(lattice.log_p))
        for batch in it:
            for blob, n in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                known = unpack(n, np.uint64) > 0
                lattice.score([w for w, k in zip(_split(blob), known.tolist(), strict=True) if k], counts)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])],
                                         names=["piece", "n"])

    for _ in range(rounds):
        model = sc.broadcast((pieces, log_p))  # as large as the vocabulary file
        parts = words.select("words", "counts").mapInArrow(lambda it, model=model: expected(it, model), schema)
        counts = np.full(len(pieces), 0.01)
        for r in parts.groupBy("piece").agg(F.sum("n").alias("n")).toLocalIterator():  # at most one row per piece
            counts[r["piece"]] += r["n"]
        log_p = np.log(counts / counts.sum())
        model.unpersist()
    return log_p


def score_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES, buckets: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Tokens are the words of the text (white space of ASCII splits, A-Z lower-cased) and one
    end. Documents that are held out do not count in any statistic. With c the
    training count of a token, N of all and V the number of distinct ones:

    * ``base_score``: sum of log10((c + 0.1) / (N + 0.1 (V + 1)));
    * ``score``: sum of log10 P, where P(end) = (c + 1) / (N + 2) and
      P(word) = (max(c - D, 0) + (D W + 1) Q(word)) / (N + 2), W the number of
      distinct training words, D a discount estimated from the words seen once
      and twice, and Q the lattice probability of
      the word's segmentations. These probabilities sum to one over all tokens.

    A null text counts as empty (its end only); rows with equal or null ids are
    rows of their own; other columns are ignored; an empty table gives an empty
    result; without training documents the counts are 0. Texts and words of
    any length are scored whole.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    buckets = buckets or max(64, n_partitions(spark))
    blocks = _blocks(docs, id_col, text_col, buckets, block_bytes)
    entries = blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("bucket", "_e")).select(
        "block", "bucket", "_e.words", "_e.counts")
    words = store(entries.groupBy("bucket").applyInArrow(_gather, WORDS), "lm-words")
    n_words, n_docs = blocks.agg(F.sum("train_words"), F.sum("train_docs")).first()
    total, ends = (n_words or 0) + (n_docs or 0), n_docs or 0
    known, once, twice = (x or 0 for x in words.agg(F.sum("n_known"), F.sum("n_once"), F.sum("n_twice")).first())
    # Taken from the count of each known word for the segmentations: the usual estimate
    # from the words seen once and twice.
    discount = min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.5
    pieces, log_p = vocabulary_pieces(vocabulary)
    if known:
        log_p = estimate(words, pieces, log_p)
    model = sc.broadcast((pieces, log_p))

    def answer(asked: pa.Table, known_words: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        lattice = Lattice(*model.value)
        listed = _split(known_words.column("words")[0].as_py())
        counts = unpack(known_words.column("counts")[0].as_py(), np.uint64).astype(np.float64)
        # In log space, as the segmentations of a long word can be too small for a double.
        with np.errstate(divide="ignore"):
            whole = np.log(np.maximum(counts - discount, 0))
        log10_p = (np.logaddexp(whole, np.log(discount * known + 1) + lattice.score(listed))
                   - np.log(total + 2)) / np.log(10)
        place = {w: k for k, w in enumerate(listed)}
        out = []
        for block, bucket, blob in zip(*(asked.column(c).to_pylist() for c in ("block", "bucket", "words")),
                                       strict=True):
            at = np.fromiter((place[w] for w in _split(blob)), np.int64)
            out.append((block, bucket, pack(counts[at].astype(np.uint64)), pack(log10_p[at])))
        return pa.Table.from_batches(batches(to_arrow_schema(ANSWERS), out), schema=to_arrow_schema(ANSWERS))

    answers = entries.select("block", "bucket", "words").groupBy("bucket").cogroup(
        words.select("bucket", "words", "counts").groupBy("bucket")).applyInArrow(answer, ANSWERS)

    out_schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType())])
    distinct = known + (1 if ends else 0)
    floor = total + 0.1 * (distinct + 1)
    end_base, end_score = np.log10((ends + 0.1) / floor), np.log10((ends + 1) / (total + 2))

    def finish(block: pa.Table, answers: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        row = {c: block.column(c)[0].as_py() for c in block.column_names}
        parts = sorted(answers.select(["bucket", "counts", "log10_p"]).to_pylist(), key=lambda r: r["bucket"])
        counts = np.concatenate([unpack(r["counts"], np.uint64) for r in parts]).astype(np.float64)
        log10_p = np.concatenate([unpack(r["log10_p"], np.float64) for r in parts])
        base = np.log10((counts + 0.1) / floor)
        ids, uses = unpack(row["ids"], np.uint32), unpack(row["uses"], np.uint32).astype(np.float64)
        sizes = unpack(row["distinct"], np.uint32).astype(np.int64)
        of = np.repeat(np.arange(len(sizes)), sizes)
        add = lambda x: np.bincount(of, x[ids] * uses, len(sizes))
        n = unpack(row["n_words"], np.uint64).astype(np.int64)
        return pa.table({
            "doc_id": row["doc_ids"], "held_out": row["held"], "n_tokens": n + 1,
            "n_known": add((counts > 0).astype(np.float64)).astype(np.int64) + (1 if ends else 0),
            "train_tokens": np.full(len(n), total), "base_score": add(base) + end_base,
            "score": add(log10_p) + end_score}, schema=to_arrow_schema(out_schema))

    return blocks.select("block", "doc_ids", "held", "n_words", "distinct", "ids", "uses").groupBy("block").cogroup(
        answers.groupBy("block")).applyInArrow(finish, out_schema)


def query(spark, sf_dir, vocabulary: str | None = None):
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary)
