"""Merkle manifest of a dataset: a hash tree over all rows and a proof for every row, by pointer jumping.

Every row is a leaf (a digest of its fields). The leaves of a group, in key order,
form a tree of fan-out 16; the roots of the groups, in group order, form another on
top. Inner nodes are one fifteenth of the leaves. Each holds a pointer to an ancestor
and the *segment* of sibling runs between; a self-join on the pointer appends
the ancestor's own segment and doubles the distance, so a tree of depth d is done
after log2(d) joins. The leaves come last: their parents' segments then reach the root.

Digests travel as 32 bytes, and a run (the digests of the children of one node) is kept
once for all its children. All work is DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import discard, lower_ascii, n_partitions, store

FAN_OUT = 16
SHIFT = 4            # log2 of the fan-out
TOP = -1             # number of the tree over the groups' roots
HOT_DISTANCE = 8     # from this distance on, an ancestor may be shared by more than 65,536 nodes
SALTS = 256

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = ["tree", "level", "idx"]


def field_bytes(c: str | Column) -> Column:
    """`-` for null, else the UTF-8 byte count, `:` and the value (numbers as decimal text)."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*fields: str | Column) -> Column:
    """Digest (32 bytes) of the fields of a row."""
    return F.unhex(F.sha2(F.concat(*[field_bytes(c) for c in fields]), 256))


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _digest_of(digests: Column) -> Column:
    """Digest of concatenated digests, each taken as hex text."""
    return F.unhex(F.sha2(_hex(digests), 256))


def _pos(idx: str | Column) -> Column:
    return F.pmod(F.col(idx) if isinstance(idx, str) else idx, F.lit(FAN_OUT)).cast("int")


def _left(step: Column) -> Column:
    return F.substring(step["run"], F.lit(1), step["pos"] * 32)


def _right(step: Column) -> Column:
    return F.substring(step["run"], step["pos"] * 32 + 33, F.length(step["run"]))


def siblings(path: Column) -> Column:
    """The siblings of a path concatenated, level by level and left to right."""
    return F.aggregate(path, F.lit(b""), lambda acc, s: F.concat(acc, _left(s), _right(s)))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path of (pos, run) steps give; the run's own digest at ``pos`` is not read."""
    return F.aggregate(path, leaf, lambda d, s: _digest_of(F.concat(_left(s), d, _right(s))))


@dataclass
class Tree:
    """``leaves``: (key, tree, idx, height, leaf and extra columns), stored. ``nodes``: the inner nodes
    (tree, level, idx, height, digest, run), stored. ``root``: digest as hex text, None for an empty table."""

    leaves: DataFrame
    nodes: DataFrame | None
    root: str | None
    depth: int        # steps from the lowest leaf to the root
    top_height: int


def _height(rows: Column) -> Column:
    """Levels above the leaves of a tree of fan-out 16 (0 for a lone leaf)."""
    return sum((F.when(rows > F.lit(FAN_OUT ** k), 1).otherwise(0) for k in range(15)), F.lit(0)).cast("int")


def _placed(leaves: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Number groups (``tree``) and their leaves (``idx``) in order, without a window over a whole group.

    Leaves are range-partitioned by (group, order, salt) and stored with their partition, so a
    large group is many partitions and repeated rows are spread too. Rows are numbered inside
    (group, partition); offsets come from a table of one row per (group, partition).
    """
    parts = n_partitions(leaves.sparkSession)
    ranged = store(leaves.withColumn("_salt", F.monotonically_increasing_id())
                   .repartitionByRange(parts, group, *order, "_salt").withColumn("_part", F.spark_partition_id()),
                   "merkle-ranged")
    cells = ranged.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    spans = cells.groupBy(group).agg(F.min("_part").alias("_first"), F.sum("_n").alias("_total"))
    # Groups are numbered by their first partition, then in order inside it.
    starts = spans.groupBy("_first").agg(F.count(F.lit(1)).alias("_groups"))
    earlier = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = starts.select("_first", F.coalesce(F.sum("_groups").over(earlier), F.lit(0)).alias("_base"))
    spans = spans.join(F.broadcast(starts), "_first").withColumn(
        "tree", F.col("_base") + F.row_number().over(Window.partitionBy("_first").orderBy(group)) - 1)
    c, s = cells.alias("c"), spans.alias("s")
    places = c.join(s, F.col(f"c.{group}").eqNullSafe(F.col(f"s.{group}"))).select(
        F.col(f"c.{group}").alias("_group"), F.col("c._part").alias("_cell"), "_offset", "tree",
        _height(F.col("_total")).alias("height"))
    inside = Window.partitionBy("_part", group).orderBy(*order, "_salt")
    numbered = ranged.withColumn("_in", F.row_number().over(inside) - 1)
    same = (numbered["_part"] == places["_cell"]) & numbered[group].eqNullSafe(places["_group"])
    out = store(numbered.join(places, same).withColumn("idx", F.col("_in") + F.col("_offset"))
                .drop("_in", "_offset", "_group", "_cell", "_part", "_salt"), "merkle-leaves")
    discard(ranged)
    return out


def _levels(level0: DataFrame, top: int) -> list[DataFrame]:
    """Inner nodes level by level, each stored: a run of 16 consecutive nodes becomes their digest."""
    levels, below = [], level0
    for level in range(1, top + 1):
        runs = below.filter(F.col("height") >= level).groupBy(
            "tree", F.shiftright("idx", SHIFT).alias("idx"), "height").agg(
            F.array_sort(F.collect_list(F.struct(_pos("idx").alias("pos"), "digest"))).alias("_run"))
        run = F.aggregate("_run", F.lit(b""), lambda acc, x: F.concat(acc, x["digest"]))
        below = store(runs.select("tree", F.lit(level).alias("level"), "idx", "height", run.alias("run"))
                      .withColumn("digest", _digest_of(F.col("run"))), "merkle-level")
        levels.append(below)
    return levels


def build(leaves: DataFrame, group: str, order: list[str]) -> Tree:
    """The tree over ``leaves`` (with the column ``leaf``, 32 bytes): one tree per group, one over their roots.

    Groups go null first, then by value; leaves of a group by ``order`` (nulls first), equal ones in any order
    that leaves the digests the same when ``leaf`` is in ``order``. An empty table has no root.
    """
    placed = _placed(leaves, group, order)
    sizes = placed.agg(F.max("height"), F.max("tree")).first()
    if sizes[0] is None:
        return Tree(placed, None, None, 0, 0)
    level0 = placed.select("tree", "idx", "height", F.col("leaf").alias("digest"))
    levels = _levels(level0, sizes[0])
    tops = [level0.filter("height = 0")] + [x.filter(F.col("height") == F.col("level")) for x in levels]
    top_height = 0
    while FAN_OUT ** top_height < sizes[1] + 1:
        top_height += 1
    roots = tops[0].select("tree", "digest")
    for x in tops[1:]:
        roots = roots.unionByName(x.select("tree", "digest"))
    above = _levels(roots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"),
                                 F.lit(top_height).alias("height"), "digest"), top_height)
    root = (above[-1] if above else roots).select(_hex(F.col("digest"))).first()[0]
    nodes = None
    for x in levels + above:
        nodes = x if nodes is None else nodes.unionByName(x)
    if nodes is not None:
        nodes = store(nodes, "merkle-nodes")
        discard(*levels, *above)
    return Tree(placed, nodes, root, sizes[0] + top_height, top_height)


def _pointer(tree: Tree) -> list[Column]:
    """(a_tree, a_level, a_idx, pos) of the parent; nulls at the root. A group's root stands in the top tree."""
    inner = F.col("level") < F.col("height")
    hung = ~inner & (F.col("tree") != TOP) & F.lit(tree.top_height > 0)
    return [F.when(inner, F.col("tree")).when(hung, F.lit(TOP).cast("long")).alias("a_tree"),
            F.when(inner, F.col("level") + 1).when(hung, F.lit(1)).alias("a_level"),
            F.when(inner, F.shiftright("idx", SHIFT)).when(hung, F.shiftright("tree", SHIFT)).alias("a_idx"),
            F.when(inner, _pos("idx")).when(hung, _pos("tree")).alias("pos")]


def _jump(paths: DataFrame, distance: int) -> DataFrame:
    """One self-join: every node takes over its ancestor's segment and pointer.

    Up to distance 4 an ancestor serves 65,536 nodes at most. Beyond, the ancestors pointed at - fewer than
    one in 16**8 - are repeated under ``SALTS`` salts, so that the nodes below the root are many tasks.
    """
    salts = SALTS if distance >= HOT_DISTANCE else 1
    x, y = paths.withColumn("_salt", F.pmod(F.hash(*NODE), F.lit(salts))), paths
    if salts > 1:
        aims = paths.filter("a_tree IS NOT NULL").select(*[F.col(f"a_{c}").alias(c) for c in NODE]).distinct()
        y = y.join(aims, NODE, "left_semi")
    y = y.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    x, y = x.alias("x"), y.alias("y")
    on = [F.col(f"x.a_{c}") == F.col(f"y.{c}") for c in NODE] + [F.col("x._salt") == F.col("y._salt")]
    none = F.array().cast(paths.schema["path"].dataType)
    return x.join(y, on, "left").select(
        *[F.col(f"x.{c}").alias(c) for c in NODE],
        F.coalesce(F.col("x.subroot"), F.col("y.subroot")).alias("subroot"),
        F.concat(F.col("x.path"), F.coalesce(F.col("y.path"), none)).alias("path"),
        *[F.col(f"y.a_{c}").alias(f"a_{c}") for c in NODE])


def proofs(tree: Tree) -> DataFrame:
    """The leaves of ``tree`` with ``path``, their steps (pos, run) up to the root, and ``subroot``, the root of their group."""
    leaves, nodes = tree.leaves, tree.nodes
    steps = "array<struct<pos:int,run:binary>>"
    if nodes is None:  # no row or one row: the leaf is the root
        return leaves.withColumns({"path": F.array().cast(steps), "subroot": F.col("leaf")})
    # First self-join: the run between a node and its parent.
    below = nodes.select(*NODE, "height", "digest", *_pointer(tree)).alias("x")
    above = nodes.select(*NODE, "run").alias("y")
    on = [F.col(f"x.a_{c}") == F.col(f"y.{c}") for c in NODE]
    own = (F.col("x.level") == F.col("x.height")) & (F.col("x.tree") != TOP)
    step = F.array(F.struct(F.col("x.pos").alias("pos"), F.col("y.run").alias("run")))
    paths = store(below.join(above, on, "left").select(
        *[F.col(f"x.{c}").alias(c) for c in NODE],
        F.when(own, F.col("x.digest")).alias("subroot"),
        F.when(F.col("y.run").isNull(), F.array().cast(steps)).otherwise(step).alias("path"),
        *[F.col(f"x.a_{c}").alias(f"a_{c}") for c in NODE]), "merkle-paths")
    distance = 1
    while distance < tree.depth - 1:
        before, paths = paths, store(_jump(paths, distance), "merkle-paths")
        discard(before)
        distance *= 2
    # Last self-join: leaves, sixteen to a parent.
    x = leaves.withColumn("level", F.lit(0))
    x = x.select(*leaves.columns, *_pointer(tree)).alias("x")
    y = paths.join(nodes.select(*NODE, "run"), NODE).alias("y")
    first = F.array(F.struct(F.col("x.pos").alias("pos"), F.col("y.run").alias("run")))
    return x.join(y, [F.col(f"x.a_{c}") == F.col(f"y.{c}") for c in NODE], "left").select(
        *[F.col(f"x.{c}").alias(c) for c in leaves.columns],
        F.when(F.col("y.run").isNull(), F.array().cast(steps)).otherwise(F.concat(first, F.col("y.path"))).alias("path"),
        F.when(F.col("x.height") == 0, F.col("x.leaf")).otherwise(F.col("y.subroot")).alias("subroot"))


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", fields=FIELDS,
             tampered: Column | None = None, changed: dict | None = None) -> DataFrame:
    """One row per row of ``docs``: key, leaf, subroot, root, proof_sha256, folded_root, verified (digests as hex text).

    Where ``tampered`` holds, ``changed`` (field -> new value) replaces fields before the leaf is folded again;
    ``verified`` says whether the folded root is still the root. Null fields are written as ``-`` and a null group is
    a group of its own, before all others; a null key comes first in its group. Empty and very long texts
    are hashed whole. Repeated rows are leaves of their own; rows of one key go by their digest. An empty table gives
    an empty result. Other columns of ``docs`` are not read, so their names cannot clash.
    """
    key_col, group_col = F.col(key).alias("key"), F.col(group).alias("group")
    other = F.lit(None).cast("binary")
    if tampered is not None:
        other = F.when(tampered, leaf_digest(*[(changed or {}).get(c, c) for c in fields]))
    rows = store(docs.select(key_col, group_col, leaf_digest(*fields).alias("leaf"), other.alias("other")), "merkle-rows")
    tree = build(rows, "group", ["key", "leaf"])
    discard(rows)
    root = F.lit(tree.root).cast("string")
    folded = _hex(fold(F.coalesce("other", "leaf"), F.col("path")))
    return proofs(tree).select(
        F.col("key").alias(key), _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
        root.alias("root"), F.sha2(_hex(siblings(F.col("path"))), 256).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == root).alias("verified"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    every_fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(docs, tampered=every_fifth, changed={"text": lower_ascii("text")})


SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab
), fields AS (
  SELECT doc_id, source, text,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') ||
         coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') ||
         coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
         xor(4294967295, list_reduce(list_concat([4294967295], list_transform(
             regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'), lambda x: CAST('0x' || x AS BIGINT))),
             lambda a, b: xor(a >> 8, tab[xor(a & 255, b) + 1]))) AS crc
  FROM documents, crc_table
), hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(text) || ':' ||
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS other
  FROM fields
), leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n
  FROM hashed
), nodes(tree, level, idx, digest, n) AS (
  SELECT tree, 0, idx, leaf, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (n + 15) // 16
  FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 16, n
), tops(level, idx, digest, n) AS (
  SELECT 0, tree, digest, (SELECT count(DISTINCT tree) FROM leaves) FROM nodes WHERE n = 1
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), (n + 15) // 16
  FROM tops WHERE n > 1 GROUP BY level, idx // 16, n
), subroots AS (
  SELECT tree, level, digest FROM nodes WHERE n = 1
), steps AS (
  SELECT l.tree AS tree, l.idx AS idx, n.level AS step, n.idx // 16 AS run,
         n.idx < (l.idx // CAST(16 ** n.level AS BIGINT)) AS is_left, n.idx AS spot, n.digest
  FROM leaves l JOIN nodes n ON n.tree = l.tree AND n.n > 1
   AND n.idx // 16 = l.idx // CAST(16 ** (n.level + 1) AS BIGINT) AND n.idx <> l.idx // CAST(16 ** n.level AS BIGINT)
  UNION ALL
  SELECT l.tree, l.idx, s.level + t.level, t.idx // 16, t.idx < (l.tree // CAST(16 ** t.level AS BIGINT)), t.idx, t.digest
  FROM leaves l JOIN subroots s ON s.tree = l.tree JOIN tops t ON t.n > 1
   AND t.idx // 16 = l.tree // CAST(16 ** (t.level + 1) AS BIGINT) AND t.idx <> l.tree // CAST(16 ** t.level AS BIGINT)
), sides AS (
  SELECT tree, idx, step, coalesce(string_agg(digest, '' ORDER BY spot) FILTER (WHERE is_left), '') AS left_part,
         coalesce(string_agg(digest, '' ORDER BY spot) FILTER (WHERE NOT is_left), '') AS right_part
  FROM steps GROUP BY tree, idx, step
), depth AS (
  SELECT s.tree, s.level + (SELECT max(level) FROM tops) AS depth FROM subroots s
), folded(tree, idx, step, digest) AS (
  SELECT tree, idx, 0, coalesce(other, leaf) FROM leaves
  UNION ALL
  SELECT f.tree, f.idx, f.step + 1, sha256(coalesce(s.left_part, '') || f.digest || coalesce(s.right_part, ''))
  FROM folded f JOIN depth d ON d.tree = f.tree AND f.step < d.depth
  LEFT JOIN sides s ON s.tree = f.tree AND s.idx = f.idx AND s.step = f.step
), proof AS (
  SELECT tree, idx, string_agg(left_part || right_part, '' ORDER BY step) AS path FROM sides GROUP BY tree, idx
), root AS (
  SELECT digest AS root FROM tops WHERE n = 1
)
SELECT l.doc_id, l.leaf, s.digest AS subroot, root, sha256(coalesce(p.path, '')) AS proof_sha256,
       f.digest AS folded_root, f.digest = root AS verified
FROM leaves l JOIN subroots s ON s.tree = l.tree CROSS JOIN root
JOIN depth d ON d.tree = l.tree
JOIN folded f ON f.tree = l.tree AND f.idx = l.idx AND f.step = d.depth
LEFT JOIN proof p ON p.tree = l.tree AND p.idx = l.idx
"""
