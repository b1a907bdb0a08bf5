"""Benchmark decontamination with a generalised suffix automaton over words.

The normalised benchmark items are compiled into one suffix automaton (states
are classes of word sequences with the same ends). Document words stream
through it; the automaton keeps the longest suffix of the words read so far
that occurs in any item. Every match of at least ``window`` words, or of a
whole shorter item, marks its words.

The automaton is broadcast, so its size is checked: items are cut into blocks
of at most ``BLOCK_WORDS`` words and the documents pass over one block after
the other in the same task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import batches, text_bytes

BLOCK_WORDS = 2_000_000  # words of one broadcast automaton

# Lower-cases A-Z and turns every ASCII byte that is no letter or digit into a
# space; bytes of non-ASCII characters are word bytes.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def item_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased."""
    return text.translate(_TABLE).split()


class ItemAutomaton:
    """Generalised suffix automaton of word sequences, with what each state reports.

    ``window_items[state]``: items holding the ``window``-word sequence that
    the state stands for when a match is cut to that length.
    ``short[state]``: (length, items) of the whole short items which end every
    match in this state.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        owners: list[set[str]] = [set()]
        self.shortest = window
        for name, words in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            if ids:
                self.shortest = min(self.shortest, len(ids))
            last = 0
            for c in ids:
                last = self._extend(last, c)
                while len(owners) < len(self.length):
                    owners.append(set())
                owners[last].add(name)
        # An item ends in a state and in every suffix of it: push owners up.
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True)
        cut: dict[int, set[str]] = {}
        # Only owners of states that a window can be cut to are pushed further.
        for s in order:
            p = self.link[s]
            if self.length[s] >= window and self.length[p] < window:
                cut[s] = owners[s]
            elif self.length[s] >= window:
                owners[p] |= owners[s]
        self.window_items = {s: tuple(sorted(o)) for s, o in cut.items()}
        self.short: dict[int, list[tuple[int, tuple[str, ...]]]] = {}
        whole: dict[tuple[int, int], set[str]] = {}
        for name, words in items:
            if 0 < len(words) < window:
                s = 0
                for w in words:
                    s = self.next[s][self.vocab[w]]
                whole.setdefault((s, len(words)), set()).add(name)
        for (s, n), names in whole.items():
            self.short.setdefault(s, []).append((n, tuple(sorted(names))))

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(length)
        length.append(length[last] + 1)
        nxt.append({})
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        copy = len(self.length)
        self.length.append(self.length[p] + 1)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.link[q] = copy
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def stream(self, words: list[bytes], hit: np.ndarray, found: set[str]) -> None:
        """Mark the matched words in ``hit`` and collect the matched items in ``found``."""
        if not self.vocab or len(words) < self.shortest:
            return
        get = self.vocab.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        # A match needs consecutive known words: only runs that can hold one are streamed.
        edge = np.diff((ids >= 0).astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        keep = ends - starts >= self.shortest
        nxt, link, length, window = self.next, self.link, self.length, self.window
        for a, b in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True):
            s = n = 0
            for i, c in enumerate(ids[a:b].tolist(), a):
                while s and c not in nxt[s]:
                    s = link[s]
                    n = length[s]
                if c in nxt[s]:
                    s = nxt[s][c]
                    n += 1
                if n >= window:
                    hit[i + 1 - n:i + 1] = True
                    while length[link[s]] >= window:
                        s = link[s]
                        n = length[s]
                    # now s is the class of the last `window` words
                    found.update(self.window_items[s])
                if self.short and n >= self.shortest:
                    t = s
                    while t > 0:
                        for m, names in self.short.get(t, ()):
                            if m <= n:
                                hit[i + 1 - m:i + 1] = True
                                found.update(names)
                        t = link[t]


def _blocks(items: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> list:
    """Broadcast automata of at most ``block_words`` words each (more only for one longer item)."""
    sc = items.sparkSession.sparkContext
    out, block, size = [], [], 0
    for r in items.select(F.col(id_col).cast("string"), F.col(text_col)).toLocalIterator():
        words = item_words((r[1] or "").encode())
        if block and size + len(words) > block_words:
            out.append(sc.broadcast(ItemAutomaton(block, window)))
            block, size = [], 0
        block.append((r[0] or "", words))
        size += len(words)
    if block:
        out.append(sc.broadcast(ItemAutomaton(block, window)))
    return out


def find_contamination(docs: DataFrame, items: DataFrame, window: int = 13, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                       block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: (doc_id, n_words, n_hit, n_items, items_sha256, spans).

    ``spans`` are [start, end) word positions of the maximal hit runs. A null
    or empty text has no words and no hits; an item without words matches
    nothing; a null item id counts as the empty id; equal ids count once.
    Repeated documents are judged row by row; other columns are ignored; empty
    tables give an empty result or no hits. Very long texts are streamed whole.
    """
    automata = _blocks(items, item_col, item_text_col, window, block_words)
    schema = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType())))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in it:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), text_bytes(batch), strict=True):
                words = item_words(text)
                hit, found = np.zeros(len(words), bool), set()
                for a in automata:
                    a.value.stream(words, hit, found)
                edge = np.diff(hit.astype(np.int8), prepend=0, append=0)
                spans = np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], 1).tolist()
                digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
                rows.append((doc_id, len(words), int(hit.sum()), len(found), digest, spans))
            yield from batches(arrow, rows)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 13, coverage_pct: int = 5,
                  action: str = "drop", text_col: str = "text", item_text_col: str = "text",
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """Remove contamination from documents; all other rows and columns stay as they are.

    A document is contaminated when its hit words are at least ``coverage_pct``
    percent of its words (and at least one). ``action="drop"`` removes such
    documents; ``"cut"`` keeps them and cuts the bytes of their hit spans, from
    the first to the last byte of each span. Texts without words are kept.
    """
    if action not in ("drop", "cut"):
        raise ValueError("action is 'drop' or 'cut'")
    automata = _blocks(items, items.columns[0], item_text_col, window, block_words)
    schema = docs.schema
    at = docs.columns.index(text_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts, keep = text_bytes(batch, text_col), []
            new = batch.column(at).to_pylist() if action == "cut" else None
            for k, text in enumerate(texts):
                words = item_words(text)
                hit, found = np.zeros(len(words), bool), set()
                for a in automata:
                    a.value.stream(words, hit, found)
                n = int(hit.sum())
                bad = n > 0 and 100 * n >= coverage_pct * len(words)
                keep.append(action == "cut" or not bad)
                if bad and action == "cut":
                    new[k] = _cut(text, hit).decode()
            if action == "cut":
                batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.column(at).type))
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)


def _cut(text: bytes, hit: np.ndarray) -> bytes:
    buf = np.frombuffer(text.translate(_TABLE), np.uint8)
    edge = np.diff((buf != 32).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    runs = np.diff(hit.astype(np.int8), prepend=0, append=0)
    drop = np.zeros(len(text) + 1, np.int64)
    np.add.at(drop, starts[np.flatnonzero(runs == 1)], 1)
    np.add.at(drop, ends[np.flatnonzero(runs == -1) - 1], -1)
    return np.frombuffer(text, np.uint8)[np.cumsum(drop[:-1]) == 0].tobytes()


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_contamination(docs, items, 13).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), b AS (
  SELECT item_id, {_WORDS} AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
         array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
  FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0
), sizes AS (
  SELECT DISTINCT n FROM win
), placed AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM d, sizes, unnest(range(1, greatest(len(w) - n + 2, 1))) AS t(i)
), found AS (
  SELECT r, i, placed.n, item_id FROM placed JOIN win USING (n, s)
), hits AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + n)) AS u(p) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS h
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""
