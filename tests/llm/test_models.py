"""Learned parts: lattice probabilities and the toxicity classifier."""

import zlib

import itertools

import numpy as np
import pytest

from strata.llm import toxicity
from strata.llm.lattice import BATCH_LONGEST, MARK, Lattice, vocabulary_pieces


def brute(word, pieces, log_p):
    table = dict(zip(pieces, log_p, strict=True))
    text = MARK + word
    alpha = [0.0] + [0.0] * len(text)
    alpha[0] = 1.0
    for j in range(len(text)):
        for e in range(j + 1, len(text) + 1):
            if text[j:e] in table:
                alpha[e] += alpha[j] * np.exp(table[text[j:e]])
    return np.log(alpha[-1])


@pytest.fixture(scope="module")
def small():
    pieces = [MARK + b"a", MARK + b"b", MARK + b"ab", b"a", b"b", b"ab", b"ba"]
    p = np.array([3, 2, 4, 2, 3, 5, 1.0])
    return pieces, np.log(p / p.sum())


def test_lattice_sums_all_segmentations(small):
    words = [bytes(x) for n in range(1, 7) for x in itertools.product(b"ab", repeat=n)]
    got = Lattice(*small).score(words)
    assert np.allclose(got, [brute(w, *small) for w in words])


def test_word_probabilities_sum_to_one(small):
    lattice = Lattice(*small)
    total = sum(np.exp(lattice.score([bytes(x) for x in itertools.product(b"ab", repeat=n)])).sum()
                for n in range(1, 16))
    assert 0.95 < total <= 1.0 + 1e-9  # the rest is on longer words


def test_long_words_take_the_same_recursion(small):
    word = b"abba" * 20
    assert len(word) > BATCH_LONGEST
    counts, lattice = np.zeros(len(small[0])), Lattice(*small)
    assert np.isclose(lattice.score([word], counts)[0], brute(word, *small))
    chars = np.frombuffer(MARK + word, np.uint8).astype(np.uint64)[:, None].copy()
    same = np.zeros(len(small[0]))
    assert np.isclose(lattice._batch(chars, same)[0], brute(word, *small))
    assert np.allclose(counts, same)


def test_expected_counts_raise_the_likelihood(small):
    pieces, log_p = small
    words = [b"ab", b"abab", b"ba", b"abba"]
    before = Lattice(pieces, log_p).score(words).sum()
    counts = np.full(len(pieces), 1e-9)
    Lattice(pieces, log_p).score(words, counts)
    assert Lattice(pieces, np.log(counts / counts.sum())).score(words).sum() > before


def test_every_byte_string_has_a_segmentation():
    import public_tokenizers
    pieces, log_p = vocabulary_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    words = [bytes([b]) for b in range(256) if b not in (9, 10, 11, 12, 13, 32)] + ["日本語ü".encode(), b"\xff\xfe" * 40]
    assert np.isfinite(Lattice(pieces, log_p).score(words)).all()
    assert np.isclose(np.exp(log_p).sum(), 1)


def sample(n, seed, group_share):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        toxic = rng.random() < 0.3
        words = [f"w{x}" for x in rng.integers(0, 200, 30)]
        if toxic:
            words[3] = rng.choice(["idiotx", "scumx"])
        if rng.random() < (group_share if toxic else 0.05):
            words[5] = "muslim"
        rows.append((int(toxic), " ".join(words).encode()))
    return rows


def trained(spark, rows, repeat=1, **options):
    """A model from (label, text) rows, under ids outside the held-out third."""
    ids = [i for i in range(4 * len(rows)) if zlib.crc32(str(i).encode()) % 3 != 1][:len(rows)]
    docs = spark.createDataFrame([(i, t.decode(), "k") for i, (_, t) in zip(ids, rows, strict=True)] * repeat,
                                 "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, y, 1) for i, (y, _) in zip(ids, rows, strict=True)], "doc_id long, toxic int, x int")
    return toxicity.train(docs, labels, **options)


def test_held_out_accuracy(spark):
    scorer = toxicity.Scorer(*trained(spark, sample(1500, 1, 0.05)))
    test = sample(500, 2, 0.05)
    right = sum((scorer(t) >= toxicity.THRESHOLD) == bool(y) for y, t in test)
    assert right >= 485


def test_the_penalty_lowers_the_weight_of_group_terms(spark):
    rows = sample(1500, 3, 0.8)  # toxic documents often name the group
    off = {}
    for penalty in (0.0, 0.5, 20.0):  # none, the default, a strong one
        weights = trained(spark, rows, counterfactual=penalty)[1]
        off[penalty] = sum(weights.get(f, 0.0) for f in toxicity.word_features(b"muslim"))
    assert abs(off[20.0]) <= abs(off[0.5]) < abs(off[0.0]), off
    default = trained(spark, rows)
    assert default == trained(spark, rows, counterfactual=0.5)


def test_rows_repeated_under_an_id_teach_once_and_long_texts_teach(spark):
    rows = sample(400, 4, 0.05)
    assert trained(spark, rows, repeat=3) == trained(spark, rows)
    long = [(y, t + b" filler" * 20_000) for y, t in rows]
    scorer = toxicity.Scorer(*trained(spark, long))
    assert sum((scorer(t) >= toxicity.THRESHOLD) == bool(y) for y, t in sample(300, 5, 0.05)) >= 285


def test_swap_keeps_everything_else():
    assert toxicity.swapped(b"A Muslim man. No terms here.") == b"a christian woman. no terms here." .replace(b"woman", b"girl")
    assert toxicity.swapped(b"nothing to see") is None


def test_one_class_or_none_gives_a_constant(spark):
    bias, weights = trained(spark, [(0, b"a b"), (0, b"c")])
    assert not weights and 1 / (1 + np.exp(-bias)) < 0.01
    bias, weights = toxicity.fit([], np.zeros(0, np.uint32))
    assert not weights


def test_scores_of_awkward_documents(spark, awkward, empty):
    labels = spark.createDataFrame([(3, 1), (4, 0), (5, 0), (5, None), (None, 1), (6, 1), (6, 0)], "doc_id long, toxic int")
    model = toxicity.train(awkward, labels)
    got = toxicity.score(awkward, model)
    assert got.count() == awkward.count()
    assert got.filter("score is null or score < 0 or score > 1 or (predicted = 1) != (score >= 0.7)").count() == 0
    assert toxicity.score(empty, model).count() == 0
    kept = toxicity.keep_clean(awkward, model)
    assert kept.columns == awkward.columns
    assert kept.count() == got.filter("predicted = 0").count()
    none = toxicity.train(awkward, labels.filter("false"))
    assert toxicity.score(awkward, none).filter("predicted = 1").count() == 0
