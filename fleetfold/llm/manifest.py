"""Merkle manifest of a dataset, stored every few levels and recomputed in between.

H is the lowercase hex sha256 of its inputs' concatenation. A row's leaf is H of its fields, each ``-`` if null, else
UTF-8 byte count, ``:`` and value. Per language, leaves ascend by id; while several nodes remain, every ``ARITY``
consecutive ones become their H (a last run of fewer, even of one, too). What remains is the language's subroot; the
subroots, ordered by language with null first, are leaves of one more such tree, whose last node is the root.

Stored are the leaves and then every ``STRIDE``-th level, each as one row per aligned subtree: its ``ARITY ** STRIDE``
stored descendants in order. A row is all that a task needs to recompute the nodes in between, so building hands on one
node per row, and extraction of proofs goes down from the root: it joins each subtree with the path of its top, makes
the missing interior nodes anew, emits every child's siblings level by level together with the path above, and lets the
interior nodes go. Nodes in between are written nowhere.

A proof is the list of a leaf's siblings from its own run up to the root. Folding a leaf with its proof gives the root if
neither was changed.

Positions come from one cut into even ranges of (language, id, leaf), whatever share of rows a language has. The number of
stored levels grows as log_512 of the rows; each is one grouping of rows of bounded size.

Defined cases: null language is a language of its own, first in order; null ids come first in their language and are
never tampered with by the query; null or empty text and other fields count as the leaf rule says; very long texts are
hashed whole; rows with equal ids are ordered by their leaf, and exact repeats, whose leaves are equal, keep one leaf and
one proof each; a language with one row has its leaf as subroot, and a table with one language has its subroot as root;
without any sibling the proof is empty. An empty table has no root and gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfold.llm.common import lower_ascii, table
from fleetfold.plans.ordered import Ordered
from fleetfold.session import pin

ARITY = 8
STRIDE = 3  # levels from one stored level to the next
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def leaf(fields: list[Column]) -> Column:
    """H of the fields' values, each with its length."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _digest(text: str) -> bytes:
    return hashlib.sha256(text.encode()).digest()


def next_level(nodes: list[str]) -> list[str]:
    """H of every run of ``ARITY`` nodes."""
    return [hashlib.sha256("".join(nodes[k : k + ARITY]).encode()).hexdigest() for k in range(0, len(nodes), ARITY)]


def interior(nodes: list[str], whole: bool, stride: int = STRIDE) -> list[list[str]]:
    """All levels of one subtree from its stored descendants up to its top.

    A subtree that is its tree's only one ends where one node remains, the others after ``stride`` levels.
    """
    levels = [nodes]
    while len(levels[-1]) > 1 if whole else len(levels) <= stride:
        levels.append(next_level(levels[-1]))
    return levels


def siblings(levels: list[list[str]], at: int) -> list[tuple[int, str]]:
    """For each level below the top: the place in its run of the node above ``at``, and the run's others, joined."""
    out = []
    for nodes in levels[:-1]:
        first = at - at % ARITY
        out.append((at - first, "".join(nodes[first:at] + nodes[at + 1 : first + ARITY])))
        at //= ARITY
    return out


def fold(node: str, path: list[tuple[int, str]]) -> str:
    """The root that a leaf and its proof lead to."""
    for place, others in path:
        cut = 64 * place
        node = hashlib.sha256((others[:cut] + node + others[cut:]).encode()).hexdigest()
    return node


def _pack(path: list[tuple[int, str]]) -> bytes:
    return b"".join(bytes((place, len(others) // 64)) + bytes.fromhex(others) for place, others in path)


def _unpack(packed: bytes) -> list[tuple[int, str]]:
    out, at = [], 0
    while at < len(packed):
        place, count = packed[at], packed[at + 1]
        out.append((place, packed[at + 2 : at + 2 + 32 * count].hex()))
        at += 2 + 32 * count
    return out


@dataclass
class Tree:
    """Trees of one kind, one per key: their stored levels from the leaves up, and the top node of each key.

    A level has ``key``, ``part`` (number of the aligned subtree), ``parts`` (of its key on this level), ``nodes`` and, on
    the lowest, ``tags``: what its leaves carry along.
    """

    levels: list[DataFrame]
    tops: DataFrame


def _subtrees(nodes: DataFrame, extra: list[str], stride: int) -> DataFrame:
    """Rows ``key``, ``pos``, ``node`` gathered per aligned subtree."""
    size = ARITY**stride
    grouped = nodes.groupBy("key", F.floor(F.col("pos") / size).alias("part")).agg(F.sort_array(F.collect_list(F.struct("pos", "node", *extra))).alias("own"))
    parts = grouped.groupBy("key").agg(F.count(F.lit(1)).alias("parts"))
    grouped = grouped.join(parts, "key")
    tags = [F.transform("own", lambda o: F.struct(*[o[c].alias(c) for c in extra])).alias("tags")] if extra else []
    return grouped.select("key", "part", "parts", F.transform("own", lambda o: o["node"]).alias("nodes"), *tags)


def _tops(stride: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, nodes = batch.column("parts").to_pylist(), batch.column("nodes").to_pylist()
            top = [bytes.fromhex(interior([n.hex() for n in own], p == 1, stride)[-1][0]) for p, own in zip(parts, nodes)]
            arrays = [batch.column("key"), batch.column("part"), batch.column("parts"), pa.array(top, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "pos", "parts", "node"])

    return work


def build(nodes: DataFrame, extra: list[str] | None = None, stride: int = STRIDE) -> Tree:
    """Trees over ``key``, ``pos`` (from 0 within the key) and ``node``; ``extra`` columns stay with the leaves."""
    levels, done = [], []
    extra = extra or []
    while True:
        level = pin(_subtrees(nodes, extra, stride), f"level-{len(levels)}")
        levels.append(level)
        tops = pin(level.select("key", "part", "parts", "nodes").mapInArrow(_tops(stride), "key string, pos long, parts long, node binary"), "tops")
        done.append(tops.where("parts = 1").select("key", "node"))
        nodes, extra = tops.where("parts > 1").select("key", "pos", "node"), []
        if nodes.isEmpty():
            return Tree(levels, pin(reduce(DataFrame.unionByName, done), "tree-tops"))


def _paths(stride: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "part", "parts", "nodes", "above")]
            for key, part, parts, nodes, above in zip(*columns):
                levels = interior([n.hex() for n in nodes], parts == 1, stride)
                first = part * ARITY**stride
                own = [_pack(siblings(levels, k)) + above for k in range(len(nodes))]
                arrays = [pa.array([key] * len(own), pa.string()), pa.array(range(first, first + len(own)), pa.int64()), pa.array(own, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "part", "above"])

    return work


def _downwards(tree: Tree, tops: DataFrame, stride: int) -> DataFrame:
    """The lowest level's subtrees with ``above``, the path from their tops to the root; ``tops`` has each key's own path."""
    above = None
    for number in reversed(range(len(tree.levels))):
        level = tree.levels[number]
        # The top subtree of a key has the key's path, the others that of the node that they have become.
        ends = level.where("parts = 1").select("key", "part").join(tops, "key")
        paths = ends if above is None else ends.unionByName(above)
        joined = level.join(paths, ["key", "part"])
        if number == 0:
            return joined
        slim = joined.select("key", "part", "parts", "nodes", "above")
        above = slim.mapInArrow(_paths(stride), "key string, part long, above binary")
    raise ValueError("a tree has at least one level")


class Manifest:
    """The stored levels of a dataset's tree of trees, and its root."""

    def __init__(self, docs: DataFrame, fields: list[str] | None = None, key: str = "lang", order: str = "doc_id", changed: Column | None = None, stride: int = STRIDE):
        """``changed`` is a second leaf to be folded with the proof of the first, or null where there is none."""
        self.stride = stride
        name = F.coalesce(F.concat(F.lit("="), F.col(key)), F.lit(""))  # null sorts first and stays apart from empty
        own = leaf([F.col(c) for c in fields or FIELDS])
        changed = F.lit(None).cast("string") if changed is None else changed
        rows = docs.select(name.alias("key"), F.col(order).cast("long").alias("id"), F.unhex(own).alias("node"), F.unhex(changed).alias("changed"))
        rows = pin(rows.withColumn("one", F.lit(1).cast("long")), "leaves")
        placed = Ordered(rows, ["key"], ["id", "node"], max_group_rows=0).running({"place": ("sum", "one")}).result()
        self.tree = build(placed.withColumn("pos", F.col("place") - 1).drop("place", "one"), ["id", "changed"], stride)
        # Few as languages are, their order is a dense position over the whole small table.
        subroots = self.tree.tops.select(F.lit("").alias("key"), F.col("key").alias("lang"), "node", F.lit(1).cast("long").alias("one"))
        ranked = Ordered(subroots, ["key"], ["lang"]).running({"place": ("sum", "one")}).result()
        self.langs = build(ranked.withColumn("pos", F.col("place") - 1).drop("place", "one"), ["lang"], stride)

    def root(self) -> str | None:
        """The whole dataset's digest; one row."""
        row = self.langs.tops.first()
        return bytes(row.node).hex() if row else None

    def proofs(self) -> DataFrame:
        """Per row: id, leaf, subroot, root, proof (packed siblings) and folded_root; every row's proof, regenerated."""
        none = F.lit(b"").alias("above")
        whole = _downwards(self.langs, self.langs.tops.select("key", none), self.stride)
        root = self.langs.tops.select("key", F.col("node").alias("root"))
        lang_paths = whole.join(root, "key").mapInArrow(_lang_paths(self.stride), "key string, root binary, above binary")
        lang_paths = pin(lang_paths, "language-paths")
        subtrees = _downwards(self.tree, lang_paths.select("key", "above"), self.stride)
        ends = lang_paths.select("key", "root").join(self.tree.tops.select("key", F.col("node").alias("subroot")), "key")
        slim = subtrees.join(ends, "key").select("parts", "nodes", "tags", "above", "subroot", "root")
        return slim.mapInArrow(_leaf_proofs(self.stride), "id long, leaf string, subroot string, root string, proof binary, proof_sha256 string, folded_root string")


def _lang_paths(stride: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("parts", "nodes", "tags", "above", "root")]
            for parts, nodes, tags, above, root in zip(*columns):
                levels = interior([n.hex() for n in nodes], parts == 1, stride)
                own = [_pack(siblings(levels, k)) + above for k in range(len(nodes))]
                arrays = [pa.array([t["lang"] for t in tags], pa.string()), pa.array([root] * len(own), pa.binary()), pa.array(own, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "root", "above"])

    return work


def _leaf_proofs(stride: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("parts", "nodes", "tags", "above", "subroot", "root")]
            for parts, nodes, tags, above, subroot, root in zip(*columns):
                leaves = [n.hex() for n in nodes]
                levels, upper = interior(leaves, parts == 1, stride), _unpack(above)
                rest = "".join(others for _, others in upper)
                proofs, digests, folded = [], [], []
                for k, (own, tag) in enumerate(zip(leaves, tags)):
                    path = siblings(levels, k)
                    proofs.append(_pack(path) + above)
                    digests.append(_digest("".join([others for _, others in path]) + rest).hex())
                    folded.append(fold(own if tag["changed"] is None else tag["changed"].hex(), path + upper))
                count = len(leaves)
                arrays = [pa.array([t["id"] for t in tags], pa.int64()), pa.array(leaves), pa.array([subroot.hex()] * count), pa.array([root.hex()] * count)]
                arrays += [pa.array(proofs, pa.binary()), pa.array(digests), pa.array(folded)]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "leaf", "subroot", "root", "proof", "proof_sha256", "folded_root"])

    return work


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof; where 3 divides the id's checksum the text is tampered with before folding."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    hit = (F.crc32(F.col("doc_id").cast("string")) % 3 == 0) & F.col("text").isNotNull()
    tampered = F.when(hit, leaf([lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in FIELDS]))
    proofs = Manifest(docs, changed=tampered).proofs()
    return proofs.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def _tree_sql(name: str, leaves: str, key: str, order: str, depth: int) -> str:
    """Levels of a forest as ``{name}0`` .. ``{name}{depth}`` (key, pos, h) and its tops as ``{name}_top``; finished trees stay as they are."""
    out = [f"{name}0 AS (SELECT {key} AS key, row_number() OVER (PARTITION BY {key} ORDER BY {order}) - 1 AS pos, h FROM {leaves})"]
    for k in range(depth):
        out.append(
            f"{name}{k + 1} AS (SELECT key, pos // {ARITY} AS pos, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h "
            f"FROM (SELECT *, count(*) OVER (PARTITION BY key) AS n FROM {name}{k}) GROUP BY key, pos // {ARITY})"
        )
    return ",\n".join(out)


def _path_sql(name: str, depth: int) -> str:
    """Siblings of every node of ``{name}0``: per level the place and the joined others, null where the tree had ended."""
    out = []
    for k in range(depth):
        out.append(
            f"{name}_s{k} AS (SELECT a.key, a.pos, a.pos % {ARITY} AS place, coalesce(string_agg(b.h, '' ORDER BY b.pos), '') AS others "
            f"FROM (SELECT *, count(*) OVER (PARTITION BY key) AS n FROM {name}{k}) AS a LEFT JOIN {name}{k} AS b "
            f"ON a.key = b.key AND a.pos // {ARITY} = b.pos // {ARITY} AND a.pos <> b.pos WHERE a.n > 1 GROUP BY ALL)"
        )
    return ",\n".join(out)


def _sql(depth: int = 8, lang_depth: int = 3) -> str:
    """DuckDB SQL with the trees written out to fixed depths: 8 ** depth rows of a language, 8 ** lang_depth languages."""

    def field(c: str, value: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR END"

    own = " || ".join(field(c, c) for c in FIELDS)
    low = " || ".join(field(c, "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')" if c == "text" else c) for c in FIELDS)
    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = f"list_reduce(list_concat([xor(c, b)], range(8)), lambda c, i: {bit})"
    crc = f"xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), lambda c, b: {byte}), 4294967295)"
    at = lambda name, k: f"(d.pos // {ARITY**k})" if name == "t" else f"(r.pos // {ARITY**k})"
    steps = [("t", k) for k in range(depth)] + [("g", k) for k in range(lang_depth)]
    joins, parts, node = [], [], "d.start"
    for name, k in steps:
        alias = f"{name}s{k}"
        key = "d.key" if name == "t" else "r.key"
        joins.append(f"LEFT JOIN {name}_s{k} AS {alias} ON {alias}.key = {key} AND {alias}.pos = {at(name, k)}")
        parts.append(f"coalesce({alias}.others, '')")
    folds, previous = [], "f_start"
    folds.append(f"f_start AS (SELECT d.*, r.pos AS lang_pos, {' || '.join(parts)} AS proof, {', '.join(f'{n}s{k}.place AS {n}p{k}, {n}s{k}.others AS {n}o{k}' for n, k in steps)}, d.start AS node FROM docs AS d JOIN g_leaves AS l ON l.lang = d.key JOIN g0n AS r ON r.lang = d.key {' '.join(joins)})")
    for name, k in steps:
        current = f"f_{name}{k}"
        place, others = f"{name}p{k}", f"{name}o{k}"
        folded = f"sha256({others}[:64 * {place}] || node || {others}[64 * {place} + 1:])"
        folds.append(f"{current} AS (SELECT * EXCLUDE (node), CASE WHEN {others} IS NULL THEN node ELSE {folded} END AS node FROM {previous})")
        previous = current
    return f"""
WITH raw AS (
  SELECT doc_id, coalesce('=' || lang, '') AS lang, sha256({own}) AS h,
         CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN sha256({low}) ELSE sha256({own}) END AS start
  FROM documents
), {_tree_sql("t", "raw", "lang", "doc_id NULLS FIRST, h", depth)},
docs AS (SELECT doc_id, lang AS key, h, start, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM raw),
g_leaves AS (SELECT key AS lang, h FROM t{depth}),
g_rows AS (SELECT '' AS one, lang, h FROM g_leaves),
{_tree_sql("g", "g_rows", "one", "lang", lang_depth)},
g0n AS (SELECT '' AS key, lang, row_number() OVER (ORDER BY lang) - 1 AS pos FROM g_leaves),
{_path_sql("t", depth)},
{_path_sql("g", lang_depth)},
{", ".join(folds)}
SELECT f.doc_id, f.h AS leaf, l.h AS subroot, g.h AS root, sha256(f.proof) AS proof_sha256, f.node AS folded_root, f.node = g.h AS verified
FROM {previous} AS f JOIN g_leaves AS l ON l.lang = f.key CROSS JOIN g{lang_depth} AS g
"""


OP12_SQL = _sql()
