"""Counterfactual-regularised toxicity classifier.

A sparse logistic model over word and word-prefix features, fitted on labelled
documents. Each labelled sentence that names an identity group is repeated
with the term swapped for another of its set; a penalty on the change of the
document's score keeps the group terms themselves, and words next to them, from
carrying the verdict. So neutral mentions of a group are not rejected.

Features are made and screened on the executors: documents and toxic documents are counted per feature, and only
the features that pass - a hundredth of all - come to the driver, as numbers. The fit runs on a
bounded sample of labelled documents (``max_train_docs``) of any length; scoring covers every document whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import LOWER, batches, discard, lean, store, text_bytes

MAX_TRAIN_DOCS = 8_000  # labelled documents the model is fitted on, at most
THRESHOLD = 0.7
MIN_DOCS = 3    # a feature of the model is in so many sampled documents
SCREEN = 4.5    # and its share of toxic ones is so many standard errors away from the sample's

# Sets of interchangeable identity terms.
IDENTITY_SETS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "transgender", "nonbinary"),
    ("gay", "straight", "lesbian", "bisexual", "queer", "heterosexual", "homosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"),
    ("black", "white", "asian", "latino", "hispanic", "african", "european", "arab"),
    ("immigrant", "native", "refugee", "foreigner", "migrant"),
    ("immigrants", "natives", "refugees", "foreigners", "migrants"),
    ("old", "young", "elderly", "teenage"),
    ("disabled", "blind", "deaf", "paralyzed"),
)
PREFIXES = (3, 4, 5, 6, 7)

_TERM = {t: s for s in IDENTITY_SETS for t in s}
# Letters, digits and non-ASCII bytes form words.
_WORDS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SENTENCE = re.compile(rb"(?<=[.!?\n])")


def words(text: bytes) -> list[bytes]:
    return text.translate(LOWER).translate(_WORDS).split()


def word_features(word: bytes) -> list[int]:
    """Hashes of the word itself and of its prefixes (in characters)."""
    out = [zlib.crc32(b"w" + word)]
    chars = word.decode("utf-8", "replace")
    out += [zlib.crc32(b"p" + chars[:n].encode("utf-8", "replace")) for n in PREFIXES if len(chars) > n]
    return out


def features(text: bytes) -> set[int]:
    found: set[int] = set()
    for w in set(words(text)):
        found.update(word_features(w))
    return found


def swapped(text: bytes) -> bytes | None:
    """The text with the identity terms of its sentences swapped; None if it has none.

    The substitute of a term is the next one of its set.
    """
    low = text.translate(LOWER)
    if not any(w.decode("utf-8", "replace") in _TERM for w in set(low.translate(_WORDS).split())):
        return None
    out = []
    for sentence in _SENTENCE.split(low):
        for w in set(sentence.translate(_WORDS).split()):
            s = _TERM.get(w.decode("utf-8", "replace"))
            if s:
                other = s[(s.index(w.decode()) + 1) % len(s)].encode()
                sentence = re.sub(rb"(?<![0-9a-z\x80-\xff])" + re.escape(w) + rb"(?![0-9a-z\x80-\xff])",
                                  b"\x00" + other, sentence)
        out.append(sentence.replace(b"\x00", b""))
    return b"".join(out)


def fit(samples: list[tuple[int, np.ndarray, np.ndarray | None]], names: np.ndarray, l1: float = 2e-4,
        counterfactual: float = 0.5, steps: int = 300) -> tuple[float, dict[int, float]]:
    """(bias, weights) from rows (label, places of its features in ``names``, those after the swap or None).

    Accelerated proximal gradient for mean log loss (classes weighted by the
    root of their inverse share) + l1 * |w| + counterfactual * mean squared
    change of the raw score under the swap.
    """
    y = np.array([s[0] for s in samples], np.float64)
    if not len(y) or y.min() == y.max() or not len(names):
        rate = float(y.mean()) if len(y) else 0.0
        return (np.log((rate + 1e-6) / (1 - rate + 1e-6)), {})

    def rows(k: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lists = [s[k] if s[k] is not None else np.zeros(0, np.int32) for s in samples]
        row = np.repeat(np.arange(len(samples)), [len(x) for x in lists])
        at = place[np.concatenate(lists)]
        return row[at >= 0], at[at >= 0]

    changed = np.array([s[2] is not None for s in samples])
    share = np.where(y == 1, y.mean(), 1 - y.mean())
    weight = share ** -0.5
    weight /= weight.sum()
    place = np.arange(len(names))
    bias, w = _solve(y, weight, changed, rows(1, place), rows(2, place), np.zeros(len(names)), l1, counterfactual, steps)
    # The penalty that chose the features also shrank them: fit the chosen ones again, nearly free.
    names, chosen = names[w != 0], np.flatnonzero(w)
    if len(names):
        place = np.full(len(place), -1)
        place[chosen] = np.arange(len(chosen))
        bias, w = _solve(y, weight, changed, rows(1, place), rows(2, place), w[chosen], l1 / 20, counterfactual, steps, bias)
    keep = np.flatnonzero(w)
    return bias, {int(names[k]): float(w[k]) for k in keep}


def _solve(y: np.ndarray, weight: np.ndarray, changed: np.ndarray, plain: tuple[np.ndarray, np.ndarray],
           swap: tuple[np.ndarray, np.ndarray], w: np.ndarray, l1: float, counterfactual: float, steps: int,
           b: float = 0.0) -> tuple[float, np.ndarray]:
    (r, c), (rs, cs), m, d = plain, swap, len(y), len(w)
    # A column's own curvature is its weighted document share / 4; steps follow its
    # root, with a common factor found by backtracking.
    curve = 0.25 * np.bincount(c, weight[r], d) + 1e-4
    scale = 1.0 / np.sqrt(curve / curve.max())
    lip, t, v, bv = 1.0, 1.0, w.copy(), b

    def loss_grad(w_: np.ndarray, b_: float) -> tuple[float, np.ndarray, float]:
        z = np.bincount(r, w_[c], m) + b_
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        loss = float(np.sum(weight * (np.logaddexp(0, z) - y * z)))
        g = weight * (p - y)
        grad = np.bincount(c, g[r], d)
        if changed.any():
            diff = np.where(changed, z - b_ - np.bincount(rs, w_[cs], m), 0.0)
            loss += counterfactual * float(np.sum(diff ** 2)) / m
            h = 2 * counterfactual * diff / m
            grad += np.bincount(c, h[r], d) - np.bincount(cs, h[rs], d)
        return loss, grad, float(g.sum())

    for _ in range(steps):
        loss, grad, gb = loss_grad(v, bv)
        while True:
            eta = scale / lip
            new = v - eta * grad
            new = np.sign(new) * np.maximum(np.abs(new) - eta * l1, 0)
            nb = bv - gb / lip
            dw, db = new - v, nb - bv
            bound = loss + float(grad @ dw) + gb * db + 0.5 * lip * (float(np.sum(dw ** 2 / scale)) + db ** 2)
            if loss_grad(new, nb)[0] <= bound + 1e-12:
                break
            lip *= 2
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if float(np.sum((v - new) * (new - w))) > 0:  # restart when momentum points uphill
            t, t2 = 1.0, 1.0
        v, bv = new + (t - 1) / t2 * (new - w), nb + (t - 1) / t2 * (nb - b)
        done = np.max(np.abs(new - w), initial=0) < 1e-5 and abs(nb - b) < 1e-5
        w, b, t = new, nb, t2
        lip *= 0.9
        if done:
            break
    return float(b), w


def _sampled(rows: DataFrame, total: int, bound: int, *key: str) -> DataFrame:
    """A hash sample by ``key`` of about ``bound`` rows at most; all rows when there are no more."""
    if total <= bound:
        return rows
    return rows.filter(F.pmod(F.xxhash64(*key, F.lit("fit")), F.lit(1 << 30)) < int((1 << 30) * 0.98 * bound / total))


def training_rows(docs: DataFrame, labels: DataFrame, max_train_docs: int = MAX_TRAIN_DOCS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """A bounded hash sample of labelled documents outside the held-out third: (doc_id, label, text).

    Several label rows of an id count as toxic when one of them is; null labels, null ids and null texts teach
    nothing. Texts of any length take part. Other columns are not read.
    """
    kept = (labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
            .groupBy(F.col(id_col).alias("doc_id")).agg(F.max("toxic").cast("int").alias("label")))
    kept = _sampled(kept, kept.count(), max_train_docs, "doc_id")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    return texts.join(kept, "doc_id").select("doc_id", "label", "text")


def held_out(doc_id: F.Column) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


TRAINING = "doc_id string, digest binary, label int, x binary, swap binary"


def train(docs: DataFrame, labels: DataFrame, max_train_docs: int = MAX_TRAIN_DOCS, id_col: str = "doc_id",
          text_col: str = "text", min_docs: int = MIN_DOCS, screen: float = SCREEN, **options) -> tuple[float, dict[int, float]]:
    """Fit on the labelled documents outside the held-out third (rules of ``training_rows``).

    A row repeated under its id counts once, so at most about ``max_train_docs`` rows are collected, each as the
    numbers of its screened features. Without labels, or with labels of one kind, the model is their rate alone;
    empty tables give a rate near zero.
    """
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema([("doc_id", pa.string()), ("digest", pa.binary()), ("label", pa.int32()), ("x", pa.binary()),
                           ("swap", pa.binary())])
        code = lambda s: np.fromiter(sorted(s), np.uint32, len(s)).tobytes()
        for batch in it:
            rows = []
            for i, label, text in zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(),
                                      text_bytes(batch), strict=True):
                other = swapped(text)
                rows.append((str(i), blake2b(text, digest_size=16).digest(), label, code(features(text)),
                             code(features(other)) if other is not None else None))
            yield from batches(arrow, rows)

    rows = training_rows(docs, labels, max_train_docs, id_col, text_col).mapInArrow(lean(run), TRAINING)
    rows = store(rows.groupBy("doc_id", "digest").agg(F.max("label").alias("label"), F.any_value("x").alias("x"),
                                                      F.any_value("swap").alias("swap")), "toxic-features")
    sample = _sampled(rows, rows.count(), max_train_docs, "doc_id", "digest")
    facts = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).first()
    names = np.zeros(0, np.uint32)
    if facts["n"] and 0 < facts["toxic"] < facts["n"]:
        names = _screened(sample, facts["n"], facts["toxic"] / facts["n"], min_docs, screen)
    shared = docs.sparkSession.sparkContext.broadcast(names)  # screened features of a bounded sample

    def number(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, known = pa.schema([("label", pa.int32()), ("x", pa.binary()), ("swap", pa.binary())]), shared.value

        def places(raw: bytes | None) -> bytes | None:
            if raw is None:
                return None
            found = np.frombuffer(raw, np.uint32)
            return np.searchsorted(known, found[np.isin(found, known)]).astype(np.int32).tobytes()

        for batch in it:
            yield from batches(arrow, [(label, places(x), places(swap)) for label, x, swap in zip(
                *(batch.column(c).to_pylist() for c in ("label", "x", "swap")), strict=True)])

    found = sample.select("label", "x", "swap").mapInArrow(lean(number), "label int, x binary, swap binary").toArrow()
    got = sorted(zip(*(found.column(c).to_pylist() for c in ("label", "x", "swap")), strict=True),
                 key=lambda r: (r[0], r[1], r[2] is not None, r[2] or b""))
    discard(rows)
    read = lambda b: None if b is None else np.frombuffer(b, np.int32)
    return fit([(a, read(x), read(s)) for a, x, s in got], names, **options)


def _screened(sample: DataFrame, n_docs: int, rate: float, min_docs: int, screen: float) -> np.ndarray:
    """The features whose share of toxic documents is not what chance gives, sorted. Tasks count their
    documents' features first, so a frequent feature is one row per task."""
    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema([("feature", pa.int64()), ("n", pa.int64()), ("hits", pa.int64())])
        for batch in it:
            lists = [np.frombuffer(x, np.uint32) for x in batch.column("x").to_pylist()]
            label = np.repeat(batch.column("label").to_numpy(), [len(x) for x in lists])
            names, at, n = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
            hits = np.bincount(at, label, len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64)), pa.array(n), pa.array(hits)], schema=arrow)

    counted = sample.select("label", "x").mapInArrow(lean(count), "feature long, n long, hits long") \
        .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    n = F.col("n")
    z = (F.col("hits") - n * rate) / F.sqrt(n * rate * (1 - rate))
    kept = counted.filter((n >= min_docs) & (F.abs(z) >= screen)).select("feature").toArrow()
    return np.sort(kept.column("feature").to_numpy()).astype(np.uint32)


class Scorer:
    """Scores texts; remembers which words carry weight."""

    def __init__(self, bias: float, weights: dict[int, float]):
        self.bias, self.weights = bias, weights
        self.seen: dict[bytes, tuple[int, ...]] = {}

    def __call__(self, text: bytes) -> float:
        seen, found = self.seen, set()
        for w in set(words(text)):
            got = seen.get(w)
            if got is None:
                got = tuple(f for f in word_features(w) if f in self.weights)
                if len(seen) > 100_000:
                    seen.clear()
                if len(w) <= 64:
                    seen[w] = got
            if got:
                found.update(got)
        z = self.bias + sum(self.weights[f] for f in sorted(found))
        return float(1 / (1 + np.exp(-min(max(z, -40.0), 40.0))))


def score(docs: DataFrame, model: tuple[float, dict[int, float]], id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    A null text scores as empty (the model's bias); rows are scored one by one,
    so repeated rows and null ids keep a row each; other columns are ignored; an
    empty table gives an empty result. Texts of any length are scored whole. Only the text enters the score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the non-zero weights of a bounded sample
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow, scorer = to_arrow_schema(schema), Scorer(*shared.value)
        for batch in it:
            yield from batches(arrow, list(zip(
                batch.column("doc_id").to_pylist(), map(scorer, text_bytes(batch)), strict=True)))

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(lean(run), schema).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: tuple[float, dict[int, float]], text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with all their columns, whatever their names.

    A null or empty text has the model's bias and stays unless that is toxic; repeated rows and null ids are rows of
    their own; texts of any length are scored whole; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in it:
            yield batch.filter(pa.array([scorer(t) < threshold for t in text_bytes(batch, text_col)], pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, train(docs, labels))
