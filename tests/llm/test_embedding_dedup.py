"""Near-duplicate vectors against all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int, n int, key string"


def brute(rows, threshold=0.95, kind=np.float32):
    fit = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = [[] for _ in rows]
    for size in {len(rows[k][1]) for k in fit}:
        mine = [k for k in fit if len(rows[k][1]) == size]
        m = np.array([rows[k][1] for k in mine], kind).astype(float)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        for i, j in zip(*np.nonzero(m @ m.T >= threshold), strict=True):
            if i != j:
                links[mine[i]].append(mine[j])
    comp = [None] * len(rows)
    for k in range(len(rows)):
        if comp[k] is None:
            todo, group = [k], {k}
            while todo:
                for j in links[todo.pop()]:
                    if j not in group:
                        group.add(j)
                        todo.append(j)
            ids = [rows[j][0] for j in group if rows[j][0] is not None]
            for j in group:
                comp[j] = (min(ids) if ids else None,)
    return sorted(((i, len(links[k]), comp[k][0], i == comp[k][0]) for k, (i, _) in enumerate(rows)), key=str)


def found(spark, rows, schema=SCHEMA):
    frame = spark.createDataFrame([(i, v, 0, 0, "x") for i, v in rows], schema).repartition(4)
    return sorted((tuple(r) for r in ed.near_duplicates(frame).collect()), key=str)


def clusters(rng, size, groups, members, spread):
    rows = []
    for _ in range(groups):
        centre = rng.normal(size=size)
        centre /= np.linalg.norm(centre)
        for _ in range(members):
            v = centre + spread * rng.normal(size=size) / math.sqrt(size)
            rows.append([float(np.float32(x)) for x in v])
    return rows


def test_awkward_vectors(spark):
    rng = np.random.default_rng(4)
    vecs = clusters(rng, 24, 30, 6, 0.2) + clusters(rng, 7, 3, 3, 0.05)
    vecs += [None, [], [0.0] * 24, [1.0] * 23 + [None], [math.nan] * 24, [math.inf] * 24, [-0.0] * 23 + [1.0], [0.0] * 23 + [1.0],
             [0.0] * 23 + [-1.0], [1e30] * 24, [1e-30] * 24, [2.0], [3.0], [-1.0]]
    vecs += vecs[:5] + [vecs[0]] * 40 + [vecs[1]] * 9
    rows = [(i, v) for i, v in enumerate(vecs)] + [(0, vecs[0]), (3, vecs[40]), (None, vecs[0]), (None, [9.0] * 5)]
    random.Random(1).shuffle(rows)
    want = brute(rows)
    assert found(spark, rows) == want
    assert sum(r[1] > 0 for r in want) > 150 and any(r[1] == 0 for r in want)


def test_doubles_and_empty(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(clusters(rng, 16, 20, 4, 0.25))]
    schema = SCHEMA.replace("float", "double")
    assert found(spark, rows, schema) == brute(rows, kind=np.float64)
    empty = spark.createDataFrame([], SCHEMA)
    assert ed.near_duplicates(empty).collect() == []
    assert [tuple(r) for r in ed.near_duplicates(spark.createDataFrame([(1, None, 0, 0, "")], SCHEMA)).collect()] == [(1, 0, 1, True)]


@pytest.mark.parametrize(("full", "tile"), [(1024, 1 << 16), (8, 64)])
def test_large_groups_and_more_hashes(spark, monkeypatch, full, tile):
    """A dense group of hundreds, cut into tiles and hashed more finely, gives the same counts."""
    rng = np.random.default_rng(6)
    monkeypatch.setattr(ed, "FULL", full)
    monkeypatch.setattr(ed, "TILE", tile)
    monkeypatch.setattr(ed, "STEP", 50)
    vecs = clusters(rng, 32, 1, 400, 0.1) + clusters(rng, 32, 60, 5, 0.15) + [list(map(float, v)) for v in rng.normal(size=(500, 32))]
    rows = [(i * 3, v) for i, v in enumerate(vecs)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("hashes", [1, 2, 3])
def test_recall_at_the_threshold(hashes):
    """Pairs at a cosine of exactly 0.95 meet; fresh random vectors, not those of the simulation."""
    rng = np.random.default_rng(77)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.95 * x + math.sqrt(1 - 0.95 ** 2) * z
    tables, visits = ed.plan(64, hashes, 0.95)
    met = np.zeros(len(x), bool)
    for t in range(tables):
        met |= ed._meet(ed._buckets(x, t, hashes, visits), ed._buckets(y, t, hashes, visits))
    assert met.mean() > 0.995


def test_query_over_the_test_table_finds_every_link(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    shaken = frame.withColumn("embedding", F.transform("embedding", lambda x, i: x + F.sin(i * 7.0 + 1).cast("float") * 0.02)) \
        .withColumn("vec_id", F.col("vec_id") + 10_000).unionByName(frame)
    rows = [(r.vec_id, list(r.embedding)) for r in shaken.collect()]
    got = sorted((tuple(r) for r in ed.near_duplicates(shaken).collect()), key=str)
    assert got == brute(rows)
    assert sum(r[1] for r in got) >= 1000
