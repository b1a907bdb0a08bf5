"""Conversation repair against exhaustive search and against a plain table of costs-to-go."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest

from strata.llm import convo_repair as cr

GOOD = re.compile(r"(s?(ua)+)?\Z")
ROLE = {"u": "user", "a": "assistant"}
INK = re.compile(r"[^\x20\x09-\x0D]")


def faults_of(rows):
    """rows: (role, text) in order; the first fault of each."""
    seen, out = set(), []
    for row in rows:
        ink = INK.findall(row[1])
        out.append("blank" if not ink else "duplicate" if row in seen else "truncated" if ink[-1] not in ".!?" else None)
        seen.add(row)
    return out


def exhaustive(rows):
    """(cost, audit, repaired) over all edits with at most two insertions in a gap."""
    faults, best = faults_of(rows), None
    gaps = ["", "u", "a", "ua", "au"]
    per_row = [["D"] if f in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for f in faults]
    for edits in product(*per_row):
        cost = sum({"D": 2, "K": 0}.get(e, 1) + 5 * (e != "D" and f == "truncated") for e, f in zip(edits, faults, strict=True))
        for ins in product(gaps, repeat=len(rows) + 1):
            n = sum(map(len, ins))
            if best is not None and cost + 5 * n > best[0]:
                continue
            out, audit = [], ""
            for k, gap in enumerate(ins):
                out += [(ROLE[g], "") for g in gap]
                audit += "I" * len(gap)
                if k < len(rows):
                    audit += edits[k][0]
                    if edits[k] != "D":
                        out.append((rows[k][0] if edits[k] == "K" else ROLE[edits[k][1]], rows[k][1]))
            if GOOD.match("".join(r[:1] for r, _ in out)):
                found = (cost + 5 * n, audit, "\n".join(f"{r}:{t}" for r, t in out))
                best = found if best is None else min(best, found)
    return best


def plain(rows):
    """The same by costs-to-go from the end, then the least letter that keeps the cost."""
    faults, n = faults_of(rows), len(rows)
    nxt = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    nxt |= {(s, ""): s for s in ("", "s", "u", "a")}

    def steps(i, state):
        if i < n:
            yield "D", 2, i + 1, state, None
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                if (state, rows[i][0][:1]) in nxt:
                    yield "K", more, i + 1, nxt[state, rows[i][0][:1]], rows[i]
                for x, role in ROLE.items():
                    if (state, x) in nxt:
                        yield "R", 1 + more, i + 1, nxt[state, x], (role, rows[i][1])
        for x, role in ROLE.items():
            if (state, x) in nxt:
                yield "I", 5, i, nxt[state, x], (role, "")

    togo = {(n, ""): 0, (n, "a"): 0, (n, "u"): 5, (n, "s"): 10}
    for i in range(n - 1, -1, -1):
        for s in ("", "s", "u", "a"):
            togo[i, s] = min(c + togo[j, t] for letter, c, j, t, _ in steps(i, s) if letter != "I")
        for _ in range(3):
            for s in ("", "s", "u", "a"):
                togo[i, s] = min([togo[i, s]] + [c + togo[j, t] for letter, c, j, t, _ in steps(i, s) if letter == "I"])
    i, s, audit, out = 0, "", "", []
    while (i, s) not in ((n, ""), (n, "a")):
        letter, _, i, s, row = min((x for x in steps(i, s) if x[1] + togo[x[2], x[3]] == togo[i, s]), key=lambda x: x[0])
        audit += letter
        if row:
            out.append(row)
    return togo[0, ""], audit, "\n".join(f"{r}:{t}" for r, t in out)


def repaired(rows):
    faults, way, edits, widest = faults_of(rows), cr.Repair(), [], 0
    for k, ((role, _), fault) in enumerate(zip(rows, faults, strict=True)):
        edits += way.add(k, role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        widest = max(widest, k + 1 - sum(e.letter != "I" for e in edits))
    cost, last = way.end(len(rows) - 1)
    edits += last
    out = [(e.role or rows[e.row][0], "" if e.letter == "I" else rows[e.row][1]) for e in edits if e.letter != "D"]
    return (cost, "".join(e.letter for e in edits), "\n".join(f"{r}:{t}" for r, t in out)), widest


ROLES = ["user", "assistant", "system", "tool", "", "sys", "ua"]
TEXTS = ["Yes.", "no", " \n", "", "Why? ", "end !\x0b", "a.b"]


def some_rows(rng, n):
    return [(rng.choice(ROLES[:rng.randint(2, 7)]), rng.choice(TEXTS) if rng.random() < .6 else f"t{rng.random()}.") for _ in range(n)]


@pytest.mark.parametrize("seed", range(60))
def test_small_conversations_match_exhaustive_search(seed):
    rows = some_rows(random.Random(seed), seed % 4)
    assert repaired(rows)[0] == exhaustive(rows) == plain(rows) if rows else plain(rows) == (0, "", "")


@pytest.mark.parametrize("seed", range(40))
def test_long_conversations_match_costs_to_go(seed):
    rows = some_rows(random.Random(seed), 30 + seed * 5)
    assert repaired(rows)[0] == plain(rows)


def test_memory_holds_unresolved_edits_only():
    good = [("system", "Go.")] + [(("user", "assistant")[k % 2], f"text {k}.") for k in range(5000)]
    (cost, audit, _), widest = repaired(good)
    assert (cost, audit) == (0, "K" * 5001) and widest < 20
    bad = some_rows(random.Random(5), 5000)
    found, widest = repaired(bad)
    assert found == plain(bad) and widest < 2000


def damaged(rows):
    """rows: (conv, turn, role, text), the contract's damage."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        spaced = [" " if x is None else x for x in (conv, turn, role, text)]
        kind = zlib.crc32(f"{spaced[0]}:{spaced[1]}".encode()) % 20
        role, text = spaced[2:]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [] if kind == 0 else [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for found in out.values():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return out


def expected(rows):
    want = set()
    for conv, found in damaged(rows).items():
        turns = {t for t, _, _ in found if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [(r, t) for _, r, t in found]
        faults = faults_of(pairs)
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        cost, audit, text = plain(pairs)
        want.add((conv, gaps, *(faults.count(f) for f in cr.FAULTS), illegal, cost, audit,
                  hashlib.sha256(text.encode()).hexdigest()))
    return want


def sample(rng):
    rows = []
    for conv in [None, *range(120)]:
        turn = rng.randint(-3, 3)
        for role, text in some_rows(rng, rng.randint(1, 12)):
            turn += rng.choice([0, 1, 1, 1, 1, 3])
            rows.append((conv, turn if rng.random() < .95 else None, role if rng.random() < .95 else None,
                         text if rng.random() < .95 else None))
    return rows + rows[:15] + [(500, 1, "user", "x" * 200_000 + ".")]


def test_query_matches_brute_force(spark, tmp_path):
    rows = sample(random.Random(3))
    path = f"{tmp_path}/conversations.parquet"
    frame = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, kind int, digest string")
    frame.repartition(5).write.parquet(path)
    got = {tuple(r) for r in cr.query(spark, str(tmp_path)).collect()}
    assert got == expected(rows)


def test_repaired_rows_are_the_texts_of_the_report(spark):
    rows = sample(random.Random(9))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    broken = cr.damage(frame)
    texts = defaultdict(list)
    for r in cr.repair(broken).orderBy("conv_id", "position").collect():
        assert r.position == len(texts[r.conv_id])
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    for r in cr.report(broken).collect():
        assert hashlib.sha256("\n".join(texts[r.conv_id]).encode()).hexdigest() == r.repaired_sha256


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.report(frame).count() == 0 and cr.repair(frame).count() == 0


def test_a_text_repeated_in_most_rows(spark):
    """A key above the broadcast share takes the broadcast way and gives the same rows."""
    rows = [(1, k, "user" if k % 3 else "assistant", "same." if k % 2 else f"t{k}.") for k in range(6000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    cost, audit, _ = plain([r[2:] for r in rows])
    found = cr.report(frame).first()
    assert (found.cost, found.audit) == (cost, audit)
