"""Token counts of a byte-pair vocabulary by a compiled deterministic transducer.

The merge list of a public tokenizer file is compiled into a transducer over
byte symbols (256 bytes, and 256 bytes that end a word). A state stands for
the encoding of what has been read of a word; a transition on a symbol gives
the next state and the change in the number of emitted tokens. States and
transitions are made when first needed and kept, so common words cost one step
per byte once and one table look-up afterwards.

Why a transducer can do this: in the encoding of a prefix, the last token is
the only vocabulary entry that ends the prefix and whose pair with the last
token before it is stable, that is, encodes to itself. So each step needs only
the last tokens at the last few positions, never the whole word.

A text is cut into chunks of bounded length at any place. A chunk is reduced
to a state map: the text before its first white space (it ends a word begun
earlier), the tokens of its complete words, and the text after its last white
space (a word that goes on). White space returns the transducer to its start
state, so these maps compose associatively; the maps of a text are combined by
a tree scan. Long texts are spread over tasks by chunk.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import batches

CHUNK_CHARS = 65_536

# Fixed values of the tokenizer format: the printable stand-ins of bytes.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _byte_of_char() -> dict[str, int]:
    rest = [b for b in range(256) if b not in set(_PLAIN)]
    return {chr(b): b for b in _PLAIN} | {chr(256 + k): b for k, b in enumerate(rest)}


class Transducer:
    """Deterministic transducer that counts the tokens of one word.

    A symbol is a character: the byte, or 256 + byte for the last byte of a
    word. Tokens are strings of symbols.
    """

    def __init__(self, merges: list[tuple[str, str]], end: str):
        code = _byte_of_char()

        def symbols(piece: str) -> str:
            last = piece.endswith(end)
            body = "".join(chr(code[c]) for c in (piece[:-len(end)] if last else piece))
            return body[:-1] + chr(ord(body[-1]) + 256) if last else body

        self.rank: dict[tuple[str, str], int] = {}
        self.parts: dict[str, tuple[str, str]] = {}  # a token and the pair it is merged from
        for k, (a, b) in enumerate(merges):
            left, right = symbols(a), symbols(b)
            if self.rank.setdefault((left, right), k) == k:
                self.parts.setdefault(left + right, (left, right))
        # Entries that encode to themselves, by last symbol: lengths that a last token can have.
        self.parts = {t: p for t, p in self.parts.items() if self._reachable(t, p)}
        self.sizes: dict[str, set[int]] = {}
        for t in self.parts:
            self.sizes.setdefault(t[-1], set()).add(len(t))
        self.longest = max(map(len, self.parts), default=1)
        self.stable: dict[tuple[str, str], bool] = {}
        self.forget()

    def _reachable(self, token: str, parts: tuple[str, str]) -> bool:
        return all(len(x) == 1 or x in self.parts for x in parts)

    def forget(self) -> None:
        """Back to the start state alone; what is compiled from the merge list stays."""
        self.text = [""]  # the recent symbols
        self.size = [0]  # length of the last token
        self.back = [0]  # the state one symbol before
        self.change = [0]  # tokens more than there
        self.delta: dict[int, int] = {}  # state * 256 + byte -> state
        self.merged: dict[tuple[str, tuple[int, ...]], int] = {}

    def _edge(self, token: str, side: int) -> list[tuple[int, str]]:
        """The pieces at one edge of a token while it is built: (rank of the merge that makes it, piece)."""
        out = []
        while len(token) > 1:
            pair = self.parts[token]
            out.append((self.rank[pair], token))
            token = pair[side]
        out.append((-1, token))
        return out[::-1]

    def stays(self, a: str, b: str) -> bool:
        """Whether two neighbouring tokens stay apart: no merge across the border ever comes first.

        Both tokens are rebuilt in merge order; between two steps the pieces at
        the border must not have a merge that is due before the next step.
        """
        got = self.stable.get((a, b))
        if got is None:
            left, right = self._edge(a, 1), self._edge(b, 0)
            i = j = 0
            never = 1 << 60
            got = True
            while True:
                next_left = left[i + 1][0] if i + 1 < len(left) else never
                next_right = right[j + 1][0] if j + 1 < len(right) else never
                due = self.rank.get((left[i][1], right[j][1]), never)
                # Of equal ranks the leftmost place is merged first.
                if due < next_left and due <= next_right and due != never:
                    got = False
                    break
                if next_left == next_right == never:
                    break
                if next_left <= next_right:
                    i += 1
                else:
                    j += 1
            if len(self.stable) > KEEP_WORDS:
                self.stable.clear()
            self.stable[a, b] = got
        return got

    def last_token(self, state: int, symbol: str) -> tuple[int, int]:
        """(length of the last token, change in the number of tokens) after one more symbol."""
        sizes = self.sizes.get(symbol, ())
        text = self.text[state] + symbol
        n, a, gone, m = len(text), state, 0, 1
        while True:
            # `a` is the state before the last m symbols, `gone` the tokens since then.
            if m == 1 or m in sizes:
                token = text[n - m:]
                if m == 1 or token in self.parts:
                    if m == n or not self.size[a]:
                        return m, 1 - gone
                    if self.stays(self.text[a][-self.size[a]:], token):
                        return m, 1 - gone
            gone += self.change[a]
            a = self.back[a]
            m += 1

    def step(self, state: int, byte: int) -> int:
        key = state * 256 + byte
        got = self.delta.get(key)
        if got is None:
            symbol = chr(byte)
            size, change = self.last_token(state, symbol)
            text = self.text[state] + symbol
            # Two tokens back is all that a later step can look at: longer pasts are the same state.
            same = None
            if len(text) > 2 * self.longest:
                text, past, a = text[-2 * self.longest:], [size, change], state
                for _ in range(2 * self.longest - 1):
                    past += [self.size[a], self.change[a]]
                    a = self.back[a]
                same = (text, tuple(past))
            got = self.merged.get(same) if same else None
            if got is None:
                got = len(self.text)
                self.text.append(text)
                self.size.append(size)
                self.back.append(state)
                self.change.append(change)
                if same:
                    self.merged[same] = got
            self.delta[key] = got
        return got

    def count(self, word: bytes) -> int:
        """Tokens of one word (at least one byte)."""
        state = total = 0
        for b in word[:-1]:
            state = self.step(state, b)
            total += self.change[state]
        return total + self.last_token(state, chr(256 + word[-1]))[1]


_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"  # fixed value of the vocabulary file's word pattern
_PATTERN = regex.compile(_CONTRACTIONS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_SPACE = regex.compile(r"\s")
_LAST_SPACE = regex.compile(r"(?r)\s")
KEEP_WORDS = 300_000  # remembered words of a task; forgotten all at once beyond
KEEP_STATES = 250_000


class _Words(dict):
    """Token counts of words, made by the transducer when first asked for."""

    def __init__(self, machine: Transducer):
        super().__init__()
        self.machine = machine

    def __missing__(self, word: str) -> int:
        machine = self.machine
        if len(machine.text) > KEEP_STATES:
            machine.forget()
        got = machine.count(word.encode("utf-8", "surrogatepass"))
        if len(self) > KEEP_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = got
        return got


class WordCounter:
    """Counts tokens of pieces of text: special strings, normal form, word pattern, transducer."""

    def __init__(self, spec: dict):
        model = spec["model"]
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.words = _Words(Transducer(merges, model["end_of_word_suffix"]))

    def piece(self, raw: str) -> int:
        """Tokens of text that no word crosses the ends of."""
        if self.special is not None and "<" in raw:
            found = self.special.findall(raw)
            if found:
                return len(found) + sum(self._plain(x) for x in self.special.split(raw) if x)
        return self._plain(raw)

    def _plain(self, raw: str) -> int:
        if not raw.isascii() and not unicodedata.is_normalized("NFC", raw):
            raw = unicodedata.normalize("NFC", raw)
        # Letter by letter where a final sigma would be treated by its place in the word.
        text = "".join(map(str.lower, raw)) if "\u03a3" in raw else raw.lower()
        return sum(map(self.words.__getitem__, _PATTERN.findall(text)))

    def state_map(self, chunk: str) -> tuple[str, int | None, str]:
        """(open head, tokens of complete words, open tail); None: no white space in the chunk."""
        first = _SPACE.search(chunk)
        if first is None:
            return chunk, None, ""
        last = _LAST_SPACE.search(chunk)
        return chunk[:first.start()], self.piece(chunk[first.end():last.start()]) if last.start() > first.start() else 0, chunk[last.end():]

    def join(self, a: tuple, b: tuple) -> tuple:
        """Composition of the state maps of two neighbouring chunks."""
        if a[1] is None and b[1] is None:
            return a[0] + b[0], None, ""
        if a[1] is None:
            return a[0] + b[0], b[1], b[2]
        if b[1] is None:
            return a[0], a[1], a[2] + b[0]
        middle = a[2] + b[0]
        return a[0], a[1] + b[1] + (self.piece(middle) if middle else 0), b[2]

    def close(self, m: tuple) -> int:
        return sum(self.piece(x) for x in (m[0], m[2]) if x) + (m[1] or 0)


def scan(counter: WordCounter, maps: list[tuple]) -> tuple:
    """Combine the maps of a text pairwise, level by level."""
    maps = maps or [("", None, "")]
    while len(maps) > 1:
        maps = [counter.join(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    return maps[0]


_OPEN: dict[str, WordCounter] = {}


def _counter(path: str, spec: dict) -> WordCounter:
    """The task's counter; a Python worker keeps it from task to task."""
    if path not in _OPEN:
        _OPEN[path] = WordCounter(spec)
    return _OPEN[path]


def read_spec(path: str) -> dict:
    """The parts of a byte-pair vocabulary file that the transducer is compiled from."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["model"]["type"] != "BPE" or not spec["model"].get("end_of_word_suffix"):
        raise ValueError("a byte-pair vocabulary with word ends is needed")
    return {"added_tokens": spec["added_tokens"], "model": {
        "merges": spec["model"]["merges"], "end_of_word_suffix": spec["model"]["end_of_word_suffix"]}}


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Per row: (doc_id, n_bytes, n_tokens) under the vocabulary file at ``vocabulary``.

    The file is read on the driver and broadcast (a vocabulary of fixed size).
    A null text counts as empty (0 tokens); rows are counted one by one, so
    repeated rows and null ids each give their own result row; other columns
    are ignored; an empty table gives an empty result. Texts longer than
    ``chunk_chars`` are spread over tasks by chunk and their state maps
    combined; no text is cut short.
    """
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(read_spec(vocabulary))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("_row"))
    id_field = T.StructField("doc_id", docs.schema[id_col].dataType)
    done = T.StructType([id_field, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def whole(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(done)
        counter = _counter(vocabulary, shared.value)
        for batch in it:
            out = [(i, n, counter.close(counter.state_map(t))) for i, n, t in zip(
                batch.column("doc_id").to_pylist(), batch.column("n_bytes").to_pylist(),
                batch.column("text").to_pylist(), strict=True)]
            yield from batches(arrow, out)

    maps = T.StructType([
        T.StructField("_row", T.LongType()), id_field, T.StructField("n_bytes", T.LongType()),
        T.StructField("chunk", T.IntegerType()), T.StructField("head", T.StringType()),
        T.StructField("inner", T.LongType()), T.StructField("tail", T.StringType())])

    def to_maps(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(maps)
        counter = _counter(vocabulary, shared.value)
        for batch in it:
            out = [(r, i, n, k, *counter.state_map(t)) for r, i, n, k, t in zip(
                *(batch.column(c).to_pylist() for c in ("_row", "doc_id", "n_bytes", "chunk", "text")), strict=True)]
            yield from batches(arrow, out)

    def combine(table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema
        counter = _counter(vocabulary, shared.value)
        parts = sorted(table.select(["chunk", "head", "inner", "tail"]).to_pylist(), key=lambda r: r["chunk"])
        m = scan(counter, [(r["head"], r["inner"], r["tail"]) for r in parts])
        first = table.slice(0, 1)
        return pa.table({"doc_id": first.column("doc_id"), "n_bytes": first.column("n_bytes"),
                         "n_tokens": pa.array([counter.close(m)], pa.int64())}, schema=to_arrow_schema(done))

    sized = rows.withColumn("n_bytes", F.octet_length("text").cast("long")).withColumn("_chars", F.length("text"))
    short = sized.filter(F.col("_chars") <= chunk_chars).select("doc_id", "n_bytes", "text").mapInArrow(whole, done)
    chunks = (sized.filter(F.col("_chars") > chunk_chars)
              .withColumn("chunk", F.explode(F.sequence(
                  F.lit(0), F.floor((F.col("_chars") - 1) / chunk_chars).cast("int"))))
              .select("_row", "doc_id", "n_bytes", "chunk", F.substring(
                  F.col("text"), F.col("chunk") * chunk_chars + 1, F.lit(chunk_chars)).alias("text")))
    # The whole text is cut before the exchange, so a very long text is dealt out chunk by chunk.
    long = chunks.repartition(F.col("_row"), F.col("chunk")).mapInArrow(to_maps, maps).groupBy("_row") \
        .applyInArrow(combine, done)
    return short.unionByName(long)


def query(spark, sf_dir, vocabulary: str | None = None):
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, vocabulary).withColumn("over_limit", F.col("n_tokens") > 2048)

