"""Merkle manifest against a plain recursive tree."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import merkle
from strata.llm.common import lower_ascii


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def written(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(digests, paths):
    """The root of ``digests``; appends to ``paths[i]`` the runs above digest i as (before, after)."""
    at = list(range(len(digests)))
    while len(digests) > 1:
        for i, p in enumerate(at):
            run = digests[p // 16 * 16:p // 16 * 16 + 16]
            paths[i].append(("".join(run[:p % 16]), "".join(run[p % 16 + 1:])))
        digests = [h("".join(digests[k:k + 16])) for k in range(0, len(digests), 16)]
        at = [p // 16 for p in at]
    return digests[0]


def brute(rows):
    """rows: (key, group, fields, other fields or None)."""
    groups = defaultdict(list)
    for key, group, fields, other in rows:
        groups[group].append((key is not None, key or 0, h("".join(map(written, fields))), key,
                              None if other is None else h("".join(map(written, other)))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    low, subroots = [], []
    for g in names:
        groups[g].sort(key=lambda r: r[:3])
        paths = [[] for _ in groups[g]]
        subroots.append(climb([r[2] for r in groups[g]], paths))
        low.append(paths)
    high = [[] for _ in names]
    root = climb(subroots, high) if names else None
    out = Counter()
    for n, g in enumerate(names):
        for r, path in zip(groups[g], low[n], strict=True):
            d = r[4] or r[2]
            for a, b in path + high[n]:
                d = h(a + d + b)
            proof = h("".join(a + b for a, b in path + high[n]))
            out[(r[3], r[2], subroots[n], root, proof, d, d == root)] += 1
    return out


def got(df):
    return Counter(tuple(r) for r in df.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


FIELDS = ("doc_id", "source", "n_chars", "text")


def tampered_by_crc(df):
    return merkle.manifest(df, fields=FIELDS, tampered=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                           changed={"text": lower_ascii("text")})


def expected(df):
    rows = []
    for r in df.select(*FIELDS).collect():
        hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        low = r.text and "".join(c.lower() if c.isascii() else c for c in r.text)
        rows.append((r.doc_id, r.source, tuple(r), (r.doc_id, r.source, r.n_chars, low) if hit else None))
    return brute(rows)


def test_awkward_rows_match_a_plain_tree(awkward):
    awkward = awkward.withColumn("text", F.concat(F.lit("ÀB"), "text"))
    want = expected(awkward)
    assert got(tampered_by_crc(awkward)) == want
    assert {k[-1] for k in want} == {True, False}


def test_no_row_and_one_row(awkward, empty):
    assert tampered_by_crc(empty).count() == 0
    one = awkward.filter("doc_id = 5").limit(1)
    assert got(tampered_by_crc(one)) == expected(one)


@pytest.mark.parametrize("hot_distance", [8, 1])
def test_deep_trees_and_many_groups(spark, monkeypatch, hot_distance):
    """A group with most rows, lone leaves, three levels over the groups; salted jumps give the same."""
    monkeypatch.setattr(merkle, "HOT_DISTANCE", hot_distance)
    monkeypatch.setattr(merkle, "SALTS", 4)
    df = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("é"), (F.col("id") % 900).cast("string"))).alias("source"),
        F.lit(1).alias("n_chars"), F.concat(F.lit("Text "), F.col("id").cast("string")).alias("text"))
    df = df.unionByName(spark.createDataFrame([(7, None, 1, "A")], df.schema)).unionByName(df.filter("doc_id < 40"))
    assert got(tampered_by_crc(df)) == expected(df)


def test_same_result_with_other_partitions(spark, awkward):
    before = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
    want = got(tampered_by_crc(awkward))
    try:
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "1")
        df = tampered_by_crc(awkward)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "13")
        assert got(df) == want
    finally:
        if before is None:
            spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        else:
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", before)
