"""Structure repair of conversations: the cheapest edits that make the roles alternate, by Viterbi.

A conversation's rows, in turn order, are kept, given another role or deleted, and rows are inserted, so that
the role initials read ``(s?(ua)+)?``. States are what that grammar expects next. For each state the
cheapest way to it survives, as a leaf of a tree of backpointers. Nodes count their references: a
survivor that dies releases its nodes, and as soon as all survivors share an ancestor the edits up to it are final
and leave the tree. So memory holds only the edits in which survivors differ. Survivors of equal cost are
compared by their whole unresolved suffixes.

Two passes stream over rows sorted by conversation. The first sees faults and role initials only and writes
edits as they become final; the second merges edits with the texts. Neither holds a
conversation, whatever its length.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import batches, by_key, store

# Roles of the grammar, costs of the edits, characters that end a sentence, white space.
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
SENTENCE_END = ".!?"
SPACE = " \t\n\x0b\x0c\r"
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
FAULTS = ("blank", "duplicate", "truncated")

# States: nothing yet, after s, after u, after a. What each initial leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT |= {(state, ""): state for state in range(4)}  # an empty role has no initial
FINAL = (START, ASSISTANT)
# Cost of doing from state y whatever state x can still do (in edits of its own): beyond it, x cannot win.
# From ASSISTANT a kept s has to be deleted; to USER one inserts u; to ASSISTANT one inserts u and a, or a.
STAND_IN = {START: {SYSTEM: 0, USER: INSERT, ASSISTANT: 0},
            SYSTEM: {START: 2 * INSERT + DELETE, USER: INSERT, ASSISTANT: 2 * INSERT},
            USER: {START: INSERT + DELETE, SYSTEM: INSERT, ASSISTANT: INSERT},
            ASSISTANT: {START: DELETE, SYSTEM: 0, USER: INSERT}}


class Node:
    """An edit: its letter, the row it belongs to (for an insertion the row before which it stands), the role it gives.

    ``refs`` counts its children, and one more while it is a survivor.
    """

    __slots__ = ("parent", "refs", "letter", "row", "role", "depth")

    def __init__(self, parent: Node | None, letter: str, row, role: str | None):
        self.parent, self.letter, self.row, self.role = parent, letter, row, role
        self.refs, self.depth = 1, 0 if parent is None else parent.depth + 1
        if parent is not None:
            parent.refs += 1


def _drop(node: Node) -> None:
    """One reference less; what nothing refers to any more leaves the tree, from the leaf upwards."""
    node.refs -= 1
    while node.refs == 0 and node.parent is not None:
        node.parent, node = None, node.parent
        node.refs -= 1


def _less(a: Node, b: Node) -> bool:
    """Whether the edits of ``a`` come before those of ``b``: their letters from the common ancestor on, ASCII order."""
    left, right = [], []
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.letter)
            a = a.parent
        else:
            right.append(b.letter)
            b = b.parent
    return left[::-1] < right[::-1]


def _offer(into: dict, state: int, cost: int, node: Node) -> None:
    """Let ``node`` survive in ``state`` when it is cheaper, or as cheap and first in order."""
    now = into.get(state)
    if now is not None and (cost > now[0] or (cost == now[0] and not _less(node, now[1]))):
        _drop(node)
        return
    into[state] = (cost, node)
    if now is not None:
        _drop(now[1])


class Repair:
    """Viterbi over the rows of one conversation: ``add`` them in order, then ``end``; both give the edits that became final."""

    def __init__(self):
        self.root = Node(None, "", None, None)
        self.best: dict[int, tuple[int, Node]] = {START: (0, self.root)}

    def _insert(self, row) -> None:
        """Ways to a state by inserting rows before ``row``; more than u and a lead back to where they began."""
        for state, initial in ((START, "u"), (SYSTEM, "u"), (ASSISTANT, "u"), (USER, "a")):
            if state in self.best:
                cost, node = self.best[state]
                _offer(self.best, NEXT[state, initial], cost + INSERT, Node(node, "I", row, ROLES[initial]))

    def add(self, row, initial: str, must_go: bool, cut_off: bool) -> list[Node]:
        self._insert(row)
        old, new = self.best, {}
        for state, (cost, node) in old.items():
            _offer(new, state, cost + DELETE, Node(node, "D", row, None))
            if must_go:
                continue
            cost += CUT_OFF * cut_off
            if (state, initial) in NEXT:
                _offer(new, NEXT[state, initial], cost, Node(node, "K", row, None))
            for other, role in ROLES.items():
                if (state, other) in NEXT:
                    _offer(new, NEXT[state, other], cost + REROLE, Node(node, "R", row, role))
        for state in list(new):  # a survivor cannot win once another can do all that it can, at less cost
            if any(new[state][0] > new[y][0] + STAND_IN[y][state] for y in new if y != state):
                _drop(new.pop(state)[1])
        self.best = new
        for _, node in old.values():
            _drop(node)
        return self._settled()

    def _settled(self) -> list[Node]:
        """Edits that all survivors share; they leave the tree."""
        if self.root.refs != 1:
            return []
        leaves = [node for _, node in self.best.values()]
        shared = leaves[0]
        for other in leaves[1:]:
            while shared is not other:
                if shared.depth >= other.depth:
                    shared = shared.parent
                else:
                    other = other.parent
        out = self._path(shared)
        shared.parent, self.root = None, shared
        return out

    def _path(self, node: Node) -> list[Node]:
        out = []
        while node is not self.root:
            out.append(node)
            node = node.parent
        return out[::-1]

    def end(self, row) -> tuple[int, list[Node]]:
        """(cost, last edits) once all rows are there; rows inserted at the end stand behind ``row``."""
        self._insert(row)
        last: dict[int, tuple[int, Node]] = {}
        for state in FINAL:
            if state in self.best:
                cost, node = self.best[state]
                node.refs += 1
                _offer(last, ASSISTANT, cost, node)
        cost, node = last[ASSISTANT]
        return cost, self._path(node)


# --- rows and faults ------------------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """The damage of the contract: by crc32(`conv_id:turn`) % 20 a row is dropped, emptied, stripped of its
    sentence ends, repeated or given to the user. Nulls in text and role, and in the hashed key, are one space."""
    def spaced(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(spaced("text"), SENTENCE_END, "")).otherwise(spaced("text"))
    out = rows.select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(spaced("role")).alias("role"),
                      text.alias("text"), kind.alias("_kind")).filter("_kind <> 0")
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.withColumn("_copy", F.explode(copies)).drop("_copy", "_kind")


ROW = ["conv", "turn", "role", "digest"]


def _rows(conversations: DataFrame, conv: str, turn: str) -> DataFrame:
    """(conv, turn, role, digest of the text, text); nulls in role and text are one space."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return conversations.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), role.alias("role"),
                                F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))


def _sorted(df: DataFrame, *more: str) -> DataFrame:
    return df.repartition("conv").sortWithinPartitions("conv", *more)


EDIT_FIELDS = [
    T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("digest", T.BinaryType()),
    T.StructField("kind", T.IntegerType()),     # 0 report of the conversation, 1 edit
    T.StructField("seq", T.LongType()), T.StructField("letter", T.StringType()), T.StructField("new_role", T.StringType()),
]
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _edit_schema(conv_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("conv", conv_type), *EDIT_FIELDS,
                         T.StructField("counts", T.ArrayType(T.LongType()))])


def _find_edits(it: Iterator[pa.RecordBatch], schema: pa.Schema, size: int = 8192) -> Iterator[pa.RecordBatch]:
    """First pass: sorted slim rows in, edits and one report per conversation out."""
    out, now = [], None

    def give(nodes: list[Node]) -> None:
        for x in nodes:
            now["seq"] += 1
            out.append((now["conv"], *x.row, 1, now["seq"], x.letter, x.role, None))

    def close() -> None:
        cost, last = now["way"].end(now["row"])
        give(last)
        span = 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["turns"]
        counts = [span, *(now[f] for f in FAULTS), now["illegal"], cost]
        out.append((now["conv"], None, None, None, 0, 0, None, None, counts))

    for batch in it:
        columns = (batch.column(c).to_pylist() for c in (*ROW, "blank", "cut_off", "repeat"))
        for conv, turn, role, digest, blank, cut_off, repeated in zip(*columns, strict=True):
            if now is None or conv != now["conv"]:
                if now is not None:
                    close()
                now = {"conv": conv, "way": Repair(), "seq": 0, "row": None, "low": None, "high": None, "turns": 0,
                       "initial": None, "illegal": 0, "blank": 0, "duplicate": 0, "truncated": 0}
            row = (turn, role, digest)
            again = repeated or row == now["row"]
            if turn is not None and turn != now["high"]:
                now["turns"] += 1
                now["low"], now["high"] = turn if now["low"] is None else now["low"], turn
            initial = role[:1]
            now["illegal"] += now["row"] is not None and (now["initial"], initial) not in LEGAL
            fault = "blank" if blank else "duplicate" if again else "truncated" if cut_off else None
            if fault:
                now[fault] += 1
            now["row"], now["initial"] = row, initial
            give(now["way"].add(row, initial, fault in ("blank", "duplicate"), fault == "truncated"))
            if len(out) >= size:
                yield from batches(schema, out)
                out.clear()
    if now is not None:
        close()
    yield from batches(schema, out)


def find_edits(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Edits (kind 1: row key, seq, letter, new_role) and one report (kind 0: counts) per conversation.

    A row repeats an earlier one when its (conversation, role, text) has an earlier turn; these first turns are
    reduced before they are shuffled, and keys with very many rows are joined by broadcast (``by_key``).
    """
    rows = _rows(conversations, conv, turn)
    seen = F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]"))
    ended = F.regexp_like("text", F.lit(r"[.!?][\x20\x09-\x0D]*\z"))
    slim = rows.select(*ROW, (~seen).alias("blank"), (~ended).alias("cut_off"))
    key = ["conv", "role", "digest"]
    first = slim.groupBy(*key).agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n")) \
        .filter("n > 1")
    slim = by_key(slim, store(first, "convo-repeats"), key, "n")
    later = F.struct("turn") != F.col("first")
    slim = slim.select(*ROW, "blank", "cut_off", F.coalesce(later, F.lit(False)).alias("repeat"))
    schema = _edit_schema(rows.schema["conv"].dataType)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        return _find_edits(it, to_arrow_schema(schema))

    return _sorted(slim, "turn", "role", "digest").mapInArrow(run, schema)


def _apply(it: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Second pass: reports, edits and texts in, events (conv, counts) and (conv, letter, role, text) out, in order."""
    edits, key = deque(), None
    for batch in it:
        columns = (batch.column(c).to_pylist() for c in (*ROW, "kind", "letter", "new_role", "counts", "text"))
        for conv, turn, role, digest, kind, letter, new_role, counts, text in zip(*columns, strict=True):
            if kind == 0 or key != (conv, turn, role, digest):
                while edits:  # rows inserted behind the last row
                    yield (key[0], *edits.popleft(), "")
                key = (conv, turn, role, digest)
            if kind == 0:
                yield conv, counts
            elif kind == 1:
                edits.append((letter, new_role))
            else:
                while edits[0][0] == "I":
                    yield (conv, *edits.popleft(), "")
                letter, new_role = edits.popleft()
                yield conv, letter, new_role or role, text
    while edits:
        yield (key[0], *edits.popleft(), "")


def _merged(conversations: DataFrame, conv: str, turn: str) -> DataFrame:
    edits = find_edits(conversations, conv, turn)
    rows = _rows(conversations, conv, turn).withColumn("kind", F.lit(2))
    merged = edits.withColumn("text", F.lit(None).cast("string")).unionByName(rows, allowMissingColumns=True)
    # A report first, then each row's edits before the row.
    merged = merged.withColumn("behind", F.col("kind") > 0)
    return _sorted(merged, "behind", "turn", "role", "digest", "kind", "seq").drop("behind")


def _stream(conversations: DataFrame, conv: str, turn: str, name: str, fields: list[T.StructField],
            fold: Callable[[Iterator[tuple]], Iterator[tuple]], size: int = 1024) -> DataFrame:
    schema = T.StructType([T.StructField(name, conversations.schema[conv].dataType), *fields])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow, out, held = to_arrow_schema(schema), [], 0
        for row in fold(_apply(it)):
            out.append(row)
            held += sum(len(x) for x in row if isinstance(x, str))
            if len(out) >= size or held > 1 << 24:
                yield from batches(arrow, out)
                out, held = [], 0
        yield from batches(arrow, out)

    return _merged(conversations, conv, turn).mapInArrow(run, schema)


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The repaired rows: (conv, position from 0, edit K, R or I, role, text).

    Rows of a conversation go by turn, null first; rows of the same turn by role, then by the SHA-256 of their text. A null
    conversation id is a conversation of its own. Nulls in role and text count as one space (so a null text is
    blank); an empty role has no initial, so the grammar does not see it. A repeated row is a duplicate. A
    conversation of only faulty rows, and an empty table, give no rows. Texts of any length are passed on whole. Other
    columns are not read, so their names cannot clash. The longest conversation is one task's stream, as its rows
    depend on each other, but no task holds one.
    """
    def fold(events: Iterator[tuple]) -> Iterator[tuple]:
        at, position = None, 0
        for event in events:
            if len(event) == 2:
                at, position = event[0], 0
            elif event[1] != "D":
                yield at, position, *event[1:]
                position += 1

    return _stream(conversations, conv, turn, conv, [
        T.StructField("position", T.LongType()), T.StructField("edit", T.StringType()),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType())], fold)


def report(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit (the edits' initials)
    and repaired_sha256 (of the repaired `role:text`, newline-joined). Rules as for ``repair``. The text is
    hashed as it streams by; the audit, one letter per edit, is the only thing that grows with a conversation."""
    def fold(events: Iterator[tuple]) -> Iterator[tuple]:
        state = None
        for event in chain(events, [None]):
            if event is None or len(event) == 2:
                if state is not None:
                    conv_id, counts, audit, digest, _ = state
                    yield conv_id, *counts, audit.decode(), digest.hexdigest()
                state = event and [*event, bytearray(), hashlib.sha256(), b""]
                continue
            _, letter, role, text = event
            state[2] += letter.encode()
            if letter != "D":
                state[3].update(state[4] + role.encode() + b":")
                state[3].update(text.encode())
                state[4] = b"\n"

    return _stream(conversations, conv, turn, conv, [
        *[T.StructField(c, T.LongType()) for c in COUNTS],
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())], fold)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    done = report(damage(rows)).withColumnRenamed("conv_id", "_conv")
    ids = rows.select("conv_id").distinct()
    out = ids.join(done, ids["conv_id"].eqNullSafe(done["_conv"]), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
