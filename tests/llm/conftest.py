import random

import pytest

SYLLABLES = "the er on an in ti ou ea sh wh nd of ar éa ü".split()


def text(rng, n):
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return "".join(w + (rng.choice([" ", " ", " ", ".\n", "  "])) for w in words)


@pytest.fixture(scope="session")
def awkward(spark, tmp_path_factory):
    """A stored table of awkward documents: nulls, empty and long texts, copies, clashing columns."""
    rng = random.Random(7)
    base = [text(rng, n) for n in (30, 60, 120, 300, 8, 3, 200)]
    long = text(rng, 6000)
    passage = text(rng, 90)
    texts = [None, "", " \n\t ", *base, *base[:3], base[3] + " extra tail words", base[6] + "x", long, passage,
             base[1] + "\n" + passage, passage + "\n" + base[4], "a " * 400, "z" * 5000, "Hello, World", "hello, world",
             "one\n" * 120]
    rows = [(i, t, f"s{i % 3}" if i % 4 else None, i, f"c{i}", i * 1.5, i) for i, t in enumerate(texts)]
    rows += [(3, texts[3], "s0", 1, "x", 0.0, 0), (3, texts[3], "s0", 1, "x", 0.0, 0), (None, base[2], None, 1, "x", 0.0, 0)]
    schema = ("doc_id long, text string, source string, _row long, block string, rank double, n_chars long")
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, schema).coalesce(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.filter("false")
