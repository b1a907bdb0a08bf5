"""Operators against brute force on awkward documents."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from strata.llm import (
    decontaminate,
    jaccard_join,
    line_dedup,
    lm_score,
    packing,
    sharding,
    suffix_dedup,
    token_counts,
    topk_search,
)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(str.maketrans(UPPER, UPPER.lower())))


def multiset(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def test_shards_match_a_running_sum(awkward, empty):
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, zlib.crc32((r.text or "").encode()),
                    len((r.text or "").encode()) + 8) for r in awkward.collect()))
    total = sum(r[3] for r in rows)
    want, at, slots = Counter(), 0, Counter()
    for has, i, crc, size in rows:
        shard = at * 5 // total
        want[(i if has else None, size, crc, shard, slots[shard])] += 1
        slots[shard] += 1
        at += size
    got = sharding.shard_by_bytes(awkward, 5)
    assert multiset(got, "doc_id", "size", "text_crc32", "shard", "slot") == want
    assert sharding.shard_by_bytes(empty, 5).count() == 0


def test_shard_sizes_are_near_equal(awkward):
    sizes = [r[0] for r in sharding.shard_by_bytes(awkward, 4).groupBy("shard").sum("size").select("sum(size)").collect()]
    biggest_row = max(len((r.text or "").encode()) + 8 for r in awkward.collect())
    assert max(sizes) - min(sizes) <= 2 * biggest_row


def brute_lines(rows, min_words):
    first, gone = {}, [set() for _ in rows]
    for k, (_, text) in enumerate(rows):
        lines = text.split("\n")
        n = [len(words(x)) for x in lines]
        for s in range(len(lines)):
            total = 0
            for e in range(s, len(lines)):
                total += n[e]
                if total >= min_words:
                    if first.setdefault(tuple(lines[s:e + 1]), (k, s)) != (k, s):
                        gone[k].update(range(s, e + 1))
    return gone


def test_line_runs_match_brute_force(awkward, empty):
    rows = sorted(((r.doc_id is not None, r.doc_id or 0), r.text) for r in awkward.collect() if r.text is not None)
    gone = brute_lines([(i, t) for i, t in rows], 20)
    want = Counter()
    for ((has, i), t), g in zip(rows, gone, strict=True):
        kept = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in g)
        want[(i if has else None, len(t.split("\n")), len(g), hashlib.sha256(kept.encode()).hexdigest())] += 1
    got = line_dedup.line_report(awkward, 20).filter("n_lines > 0")
    assert multiset(got, "doc_id", "n_lines", "n_removed", "kept_sha256") == want
    assert line_dedup.line_report(empty, 20).count() == 0
    assert sum(map(len, gone)) > 0


def test_line_dedup_keeps_columns_and_first_copies(awkward):
    got = line_dedup.dedup_lines(awkward, 20)
    assert got.columns == awkward.columns and got.count() == awkward.count()
    before, after = awkward.collect(), got.collect()
    assert Counter(r._row for r in before) == Counter(r._row for r in after)
    changed = [r for r in after if r.text is not None and r.doc_id is not None and r.text != next(
        b.text for b in before if b.doc_id == r.doc_id)]
    assert changed and all(r.n_chars == len(r.text) for r in changed)
    fewer = line_dedup.dedup_lines(awkward, 20, keep_emptied=False)
    assert fewer.count() < got.count()
    assert fewer.filter("text is null").count() == 1


def test_repeated_strings_match_brute_force(awkward, empty):
    length = 90
    texts = [(r.doc_id, (r.text or "").encode()) for r in awkward.collect()]
    seen = Counter(t[a:a + length] for _, t in texts for a in range(len(t) - length + 1))
    want = Counter()
    for i, t in texts:
        mark = np.zeros(len(t) + 1, int)
        for a in range(len(t) - length + 1):
            if seen[t[a:a + length]] > 1:
                mark[a] += 1
                mark[a + length] -= 1
        gone = np.cumsum(mark[:-1]) > 0
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want[(i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept)] += 1
    got = suffix_dedup.remove_repeats(awkward, length, with_text=True, block_bytes=4000, buckets=7)
    assert Counter((*r[:5], bytes(r.kept)) for r in got.collect()) == want
    assert suffix_dedup.remove_repeats(empty, length).count() == 0


def test_the_cover_meets_every_difference():
    p = suffix_dedup.PERIOD
    assert {(a - b) % p for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(p))


def test_positions_beyond_one_slice(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 50)
    t = bytes(range(97, 123)) * 20
    small = suffix_dedup.Block([t, b"", t[:150], t])
    at, keys = small.samples(np.ones(4, bool), 90, 64)
    monkeypatch.setattr(suffix_dedup, "SLICE", 1 << 20)
    at2, keys2 = suffix_dedup.Block([t, b"", t[:150], t]).samples(np.ones(4, bool), 90, 64)
    assert at.tolist() == at2.tolist() and keys.tolist() == keys2.tolist()


def test_jaccard_components_match_brute_force(awkward, empty):
    rows = [(r.doc_id, words(r.text)) for r in awkward.collect()]
    sets = [frozenset(tuple(w[i:i + min(5, len(w))]) for i in range(len(w) - min(5, len(w)) + 1)) if w else frozenset()
            for _, w in rows]
    part = list(range(len(rows)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                part[root(i)] = root(j)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)].append(i)
    want = Counter((i, len(s), min(least[root(k)]) if least[root(k)] else None)
                   for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True)))
    got = jaccard_join.jaccard_components(awkward, block_bytes=3000, buckets=5)
    assert multiset(got, "doc_id", "n_shingles", "component_id") == want
    assert jaccard_join.jaccard_components(empty).count() == 0
    kept = jaccard_join.keep_one(awkward)
    with_words = {root(k) for k, s in enumerate(sets) if s}
    assert kept.columns == awkward.columns
    assert kept.count() == len(with_words) + sum(not s for s in sets)


def test_tiles_find_links_between_components(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 60, 100).astype(np.uint64)
    rows, sets = [], {}
    for k in range(40):
        codes = base.copy()
        codes[:k // 2] = rng.integers(0, 1 << 60, k // 2)
        codes = np.unique(codes)
        sets[k] = codes
        rows.append((k, len(codes), [1], bytearray(jaccard_join.signature(codes, 256).tobytes())))
    found = spark.createDataFrame(rows, "class long, n int, keys array<long>, small binary")
    entries = found.selectExpr("explode(keys) as key", "class", "n", "class as component")
    got = {tuple(r) for r in jaccard_join._tile_pairs(entries, found, 80).collect()}
    want = {(a, b) for a in sets for b in sets if a < b and jaccard_join.links(sets[a], sets[b], 80)}
    assert want <= got and want


def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def variants(m, changed, seed, start=0):
    """``m`` texts of the same 104 words (100 shingles) with ``changed`` shingles of their own each."""
    rng = np.random.default_rng(seed)
    base = [f"w{x}" for x in rng.integers(0, 1 << 60, 104)]
    rows = []
    for k in range(m):
        w = list(base)
        at = int(rng.integers(10, 80))
        w[at], w[at + changed - 5] = f"own{seed}x{k}", f"more{seed}x{k}"
        rows.append((start + k, " ".join(w)))
    return rows


def linked_parts(sets):
    """The least id reachable by links of 80 percent, by brute force."""
    part = {i: i for i in sets}

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                x, y = sorted((root(i), root(j)))
                part[y] = x
    return {i: root(i) for i in sets}


def test_pairs_of_a_large_group_never_become_rows(spark, monkeypatch):
    """Near copies just below the threshold, which signatures cannot tell from links, and others that link."""
    rows = [*variants(150, 8, 5), *variants(40, 6, 6, 1000)]
    want = linked_parts({i: shingle_set(t) for i, t in rows})
    joined, both = [], jaccard_join._both

    def counted(pairs, sets, columns):
        joined.append(pairs.count())
        return both(pairs, sets, columns)

    monkeypatch.setattr(jaccard_join, "_both", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()} == want
    assert sum(joined) <= 10 * len(rows)


def test_parts_of_tiles_join_the_components_of_all_links(spark, monkeypatch):
    """Each class a component of its own: with small tiles and parts, few links join what all links join."""
    rng = np.random.default_rng(4)
    base, rows, sets = rng.integers(0, 1 << 60, 200).astype(np.uint64), [], {}
    for k in range(60):
        codes = base.copy()
        codes[:k // 2] = rng.integers(0, 1 << 60, k // 2)
        sets[k] = np.unique(codes)
        bits = bytearray(jaccard_join.signature(sets[k], 256).tobytes())
        rows.append((k, len(sets[k]), [1, 2], bits, bytearray(jaccard_join.pack_sorted(sets[k]))))
    found = spark.createDataFrame(rows, "class long, n int, keys array<long>, small binary, shingles binary")
    entries = found.selectExpr("explode(keys) as key", "class", "n", "class as component")
    for tile, shingles, most in ((2048, 1 << 20, 59), (16, 700, 59 * 60)):
        monkeypatch.setattr(jaccard_join, "TILE", tile)
        monkeypatch.setattr(jaccard_join, "PART_SHINGLES", shingles)
        links = [tuple(r) for r in jaccard_join._tile_links(entries, found, 80).collect()]
        assert len(links) <= most and all(jaccard_join.links(sets[a], sets[b], 80) for a, b in links)
        part = {k: k for k in sets}
        for _ in sets:
            for a, b in links:
                part[a] = part[b] = min(part[a], part[b])
        assert part == linked_parts({k: frozenset(x.tolist()) for k, x in sets.items()})


def test_signature_bound_never_loses_a_link():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 60, n).astype(np.uint64))
        b = a[rng.random(len(a)) < 0.9]
        b = np.unique(np.append(b, rng.integers(0, 1 << 60, int(rng.integers(0, 30))).astype(np.uint64)))
        sa, sb = (jaccard_join.signature(x, jaccard_join.signature_bits(len(x))) for x in (a, b))
        if len(b) and jaccard_join.links(a, b, 80):
            assert jaccard_join.may_link(sa, len(a), sb, len(b), 80)


def test_contamination_matches_brute_force(spark, awkward, empty):
    docs = awkward.collect()
    long = next(r.text for r in docs if r.text and len(r.text.split()) > 5000)
    items = [(1, " ".join(long.split()[50:80])), (2, "Hello, world!"), (3, ""), (4, None), (5, "z" * 5000),
             (6, docs[6].text), (6, docs[6].text), (None, "a a a a")]
    table = spark.createDataFrame(items, "item_id long, text string")
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    want = Counter()
    for r in docs:
        w, hit, found = words(r.text, pattern), set(), set()
        for i, t in items:
            v = words(t, pattern)
            m = min(13, len(v))
            for s in range(len(v) - m + 1 if v else 0):
                for a in range(len(w) - m + 1):
                    if w[a:a + m] == v[s:s + m]:
                        hit.update(range(a, a + m))
                        found.add("" if i is None else str(i))
        want[(r.doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())] += 1
    for block_words in (1, 10_000):  # one automaton per item, and one for all
        got = decontaminate.find_contamination(awkward, table, block_words=block_words)
        assert multiset(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256") == want
    assert decontaminate.find_contamination(empty, table).count() == 0
    assert decontaminate.find_contamination(awkward, table.filter("false")).filter("n_hit > 0").count() == 0


def test_decontaminate_drops_or_cuts(spark, awkward):
    items = spark.createDataFrame([(1, "hello world")], "item_id long, text string")
    kept = decontaminate.decontaminate(awkward, items)
    assert kept.count() == awkward.count() - 2 and kept.columns == awkward.columns
    cut = decontaminate.decontaminate(awkward, items, action="cut")
    assert cut.count() == awkward.count()
    assert cut.filter("lower(text) like '%hello%world%'").count() == 0


def test_token_counts_match_the_library(awkward, empty):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = Counter((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids))
                   for r in awkward.collect())
    for chunk in (17, 65_536):
        got = token_counts.count_tokens(awkward, path, chunk_chars=chunk)
        assert multiset(got, "doc_id", "n_bytes", "n_tokens") == want
    assert token_counts.count_tokens(empty, path).count() == 0


def test_transducer_on_odd_strings():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), token_counts.WordCounter(token_counts.read_spec(path))
    rng = random.Random(5)
    vocab = [v.replace("</w>", "") for v in sorted(library.get_vocab())]
    cases = ["", "<|endoftext|>x", "a<|startoftext|>'s 'LL", "ΑΣ ΣΑΣ", "é Å", "ab" * 300, "!" * 333, "İ ǅ ß"]
    cases += ["".join(rng.choice(vocab) for _ in range(rng.randint(1, 4))) for _ in range(1500)]
    cases += ["".join(chr(rng.choice([rng.randint(33, 126), rng.randint(160, 900), rng.randint(0x4e00, 0x4f00)]))
                      for _ in range(rng.randint(1, 20))) for _ in range(800)]
    for s in cases:
        want = len(library.encode(s, add_special_tokens=False).ids)
        assert own.close(own.state_map(s)) == want, s
        parts = [own.state_map(s[i:i + 3]) for i in range(0, len(s), 3)]
        assert own.close(token_counts.scan(own, parts)) == want, s


def test_top_k_matches_brute_force(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(230)]
    rows += [(k, rows[0][1]) for k in (300, 301, 302)] + [(200, rows[7][1])] * 2
    rows += [(400, None), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (402, [float("nan")] * 6), (None, rows[1][1]), (500, [1.0, 2.0]),
             (501, [3.0, 4.0]), (600, [float("inf")] * 6), (700, [])]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5).write.parquet(str(tmp_path / "v"))
    table = spark.read.parquet(str(tmp_path / "v"))
    good = [(i, np.floor(1024 * np.array(v)).astype(int)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = Counter()
    for a, (i, q) in enumerate(good):
        if i % 100 == 0:
            all_ = sorted((-int(q @ v), j) for b, (j, v) in enumerate(good) if b != a and len(v) == len(q))
            for rank, (s, j) in enumerate(all_[:10], 1):
                want[(i, rank, j, -s)] += 1
    got = topk_search.exact_top_k(table, 10, query_block=2, tile_rows=16)
    assert multiset(got, "query_id", "rank", "vec_id", "score") == want
    assert topk_search.exact_top_k(table.filter("false")).count() == 0


def test_scores_beyond_doubles_are_exact():
    q = np.array([[2.0 ** 30, 3.0]])
    t = np.array([[2.0 ** 30, 1.0], [2.0 ** 40, 2.0 ** 20]])
    assert topk_search.scores(q, t).tolist() == [[2 ** 60 + 3, min(2 ** 70 + 3 * 2 ** 20, 2 ** 63 - 1)]]


def test_packing_obeys_every_rule(awkward, empty):
    packed = packing.pack(awkward, packing.word_size(), packing.text_cluster(), capacity=100, block_rows=8)
    rows = packed.collect()
    size = Counter()
    for r in awkward.collect():
        size[r.doc_id] += len(words(r.text)) + 1
    got, bins = Counter(), defaultdict(list)
    for r in rows:
        got[r.doc_id] += r.piece_size
        bins[r.bin_id].append(r)
    assert got == size
    source = {r.doc_id: r.source for r in awkward.collect()}
    text = {r.doc_id: tuple(words(r.text)) if r.text is not None else None for r in awkward.collect()}
    for parts in bins.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.piece_size
        assert at <= 100
        if len(parts) > 1:
            for what in (source, text):
                known = [what[r.doc_id] for r in parts if what[r.doc_id] is not None and r.doc_id is not None]
                assert len(known) == len(set(known))
    assert packing.pack(empty, packing.word_size(), packing.text_cluster()).count() == 0


def test_best_fit_takes_the_tightest_compatible_bin():
    def brute(sizes, sources, clusters, capacity):
        bins, out = [], []
        for s, a, c in zip(sizes, sources, clusters, strict=True):
            fits = [(r, b) for b, (r, x, y) in enumerate(bins) if r >= s and (a < 0 or a not in x) and (c < 0 or c not in y)]
            if fits:
                b = min(fits)[1]
            else:
                bins.append((capacity, set(), set()))
                b = len(bins) - 1
            r, x, y = bins[b]
            bins[b] = (r - s, x | {a}, y | {c})
            out.append(b)
        return out

    rng = np.random.default_rng(4)
    for _ in range(30):
        n = 120
        sizes = sorted(rng.integers(1, 60, n).tolist(), reverse=True)
        sources = rng.choice([-1, 0, 0, 0, 1, 2, 3], n).tolist()
        clusters = rng.integers(-1, 40, n).tolist()
        assert packing.best_fit(sizes, sources, clusters, 100)[0] == brute(sizes, sources, clusters, 100)


def test_base_scores_match_brute_force(awkward, empty):
    import public_tokenizers
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = lm_score.score_documents(awkward, path, block_bytes=4000, buckets=3).collect()
    docs = [(r.doc_id, words(r.text) + [" end"]) for r in awkward.collect()]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c = Counter(w for i, t in docs if not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((i is not None, i or 0, held(i), len(t), sum(c[w] > 0 for w in t), n,
                   round(sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)) for i, t in docs)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                   round(r.base_score, 6)) for r in got) == want
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert lm_score.score_documents(empty, path).count() == 0


def test_held_out_words_do_not_change_the_model(spark, awkward, tmp_path):
    import public_tokenizers
    path = public_tokenizers.path("piece_bpe_32k.model")
    held = next(i for i in range(100, 300) if zlib.crc32(str(i).encode()) % 10 == 0)
    base = awkward.select("doc_id", "text")
    more = base.unionByName(spark.createDataFrame([(held, "secretword " * 50)], base.schema))
    more.write.parquet(str(tmp_path / "d"))
    a = {r.doc_id: (r.score, r.base_score) for r in lm_score.score_documents(base, path).collect()}
    b = {r.doc_id: (r.score, r.base_score) for r in lm_score.score_documents(spark.read.parquet(str(tmp_path / "d")), path).collect()}
    assert all(np.allclose(a[i], b[i], rtol=1e-9) for i in a)


def thue_morse(n):
    return "".join("b" if bin(k).count("1") % 2 else "a" for k in range(n))


def test_long_words_with_equal_polynomials_do_not_link(spark):
    """A Thue-Morse word and its complement collide under any polynomial modulo a power of two."""
    word = thue_morse(2048)
    other = word.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, word), (2, other), (3, word)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def with_parallelism(spark, n, run):
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 12 if n > 1 else 1 << 27))
    try:
        return run()
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def many_copies(spark, tmp_path):
    rng = __import__("random").Random(3)
    base = [" ".join(rng.choice("abcdefghij") * 3 for _ in range(60)) + "\n" + " ".join(rng.choice("klmnop") * 4 for _ in range(60))
            for _ in range(20)]
    rows = [(i, base[i % 20] if i % 3 else f"only {i} " + " ".join(f"w{i}x{k}" for k in range(30))) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(8).write.parquet(f"{tmp_path}/docs")
    return spark.read.parquet(f"{tmp_path}/docs")


def test_keep_one_does_not_depend_on_how_the_input_is_scanned(spark, tmp_path):
    docs = many_copies(spark, tmp_path)
    built = with_parallelism(spark, 1, lambda: jaccard_join.keep_one(docs))
    ids = with_parallelism(spark, 16, lambda: sorted(r.doc_id for r in built.collect()))
    assert len(ids) == len(set(ids)) == 100 + 20


def test_line_dedup_does_not_depend_on_how_the_input_is_scanned(spark, tmp_path):
    docs = many_copies(spark, tmp_path)
    want = sorted(tuple(r) for r in line_dedup.dedup_lines(docs, 20, keep_emptied=False).collect())
    built = with_parallelism(spark, 1, lambda: line_dedup.dedup_lines(docs, 20, keep_emptied=False))
    assert with_parallelism(spark, 16, lambda: sorted(tuple(r) for r in built.collect())) == want
    assert len(want) == 100 + 20


def test_search_does_not_depend_on_how_the_input_is_scanned_or_on_passes(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(900)] + [(200, [1.0] * 8), (None, [1.0] * 8)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8).write.parquet(f"{tmp_path}/v")
    table = spark.read.parquet(f"{tmp_path}/v")
    want = multiset(topk_search.exact_top_k(table, 5), "query_id", "rank", "vec_id", "score")
    built = with_parallelism(spark, 1, lambda: topk_search.exact_top_k(table, 5))
    assert with_parallelism(spark, 16, lambda: multiset(built, "query_id", "rank", "vec_id", "score")) == want
    monkeypatch.setattr(topk_search, "PASS_BLOCKS", 2)
    assert multiset(topk_search.exact_top_k(table, 5, query_block=2), "query_id", "rank", "vec_id", "score") == want
