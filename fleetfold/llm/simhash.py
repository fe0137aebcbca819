"""SimHash near copies by a self-join of a binary trie.

A document's fingerprint has 64 bits: bit i is set if it is set in over half the XXH64 values (seed 42) of
its word shingles. Distinct fingerprints form a binary trie. The self-join goes through pairs of nodes of
equal depth, adds up the bits in which their paths differ and leaves a pair as soon as there are more than
allowed. The upper levels are walked as a table of existing nodes, until the fullest node is small enough
for a task; a pair of such nodes that is still alive carries its fingerprints to one task, which goes on
bit by bit over the sorted values. Exact copies share a fingerprint and enter the join once.

Defined cases: null, empty and blank texts have no words and fingerprint zero, and link like any other.
Fewer words than a shingle give one shingle of all words. Ties (a bit set in exactly half) leave the bit
zero. Repeated rows share a component, named by the least id. A null id never names a component unless
all its members are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfold.llm.common import table
from fleetfold.llm.components import components
from fleetfold.session import pin

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
NODE_ROWS = 1 << 14  # fingerprints below one trie node that a task may hold
LEAST_DEPTH, MOST_DEPTH = 6, 32
_SMALL = 16  # pairs of leaves below which a node pair is compared leaf by leaf


def fingerprint_of(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one text as a signed 64-bit integer."""
    return _fingerprints([text], words)[0].item()


def _fingerprints(texts: list, words: int):
    """Signed fingerprints of a batch of texts."""
    import numpy as np
    import xxhash

    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), dtype=np.uint64)
    for k, text in enumerate(texts):
        # bytes.lower and bytes.split know A-Z and the six ASCII blanks only.
        parts = text.encode().lower().split() if text else []
        if not parts:
            continue
        if len(parts) <= words:
            out[k] = digest(b" ".join(parts), SEED)
            continue
        shingles = zip(*(parts[i:] for i in range(words)))
        hashes = np.array([digest(b" ".join(s), SEED) for s in shingles], dtype=np.uint64)
        total = np.zeros(64, dtype=np.int64)
        for start in range(0, len(hashes), 65_536):
            bits = np.unpackbits(hashes[start : start + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += bits.sum(axis=0, dtype=np.int64)
        out[k] = np.packbits(total * 2 > len(hashes), bitorder="little").view(np.uint64)[0]
    return out.view(np.int64)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``fp`` (signed 64 bits) of every row."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            values = pa.array(_fingerprints(batch.column(1).to_pylist(), words))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), values], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _pairs_below(a, b, start: int, diff: int, most: int, same: bool):
    """Pairs (i, j) of sorted unsigned values below two trie nodes of depth ``start`` that differ in ``diff``
    bits so far, with at most ``most`` differing bits in all."""
    import numpy as np

    found = []
    front = np.array([[0, len(a), 0, len(b), diff]], dtype=np.int64)
    for depth in range(start, 65):
        if not len(front):
            break
        spans = (front[:, 1] - front[:, 0]) * (front[:, 3] - front[:, 2])
        ready = (spans <= _SMALL) | (depth == 64)
        if ready.any():
            done = front[ready]
            wide = done[:, 3] - done[:, 2]
            size = spans[ready]
            row = np.repeat(np.arange(len(done)), size)
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            i, j = done[row, 0] + at // wide[row], done[row, 2] + at % wide[row]
            near = np.bitwise_count(a[i] ^ b[j]) <= most
            if same:
                near &= i < j
            found.append((i[near], j[near]))
            front = front[~ready]
            if not len(front):
                break
        # Split every node at the next bit: values are sorted, so its 1-branch begins at prefix | bit.
        bit = np.uint64(1) << np.uint64(63 - depth)
        keep = ~np.uint64((1 << (64 - depth)) - 1)
        mid_a = np.searchsorted(a, (a[front[:, 0]] & keep) | bit)
        mid_b = np.searchsorted(b, (b[front[:, 2]] & keep) | bit)
        lo_a, hi_a, lo_b, hi_b, so_far = front.T
        children = [
            np.stack([lo_a, mid_a, lo_b, mid_b, so_far], 1),
            np.stack([mid_a, hi_a, mid_b, hi_b, so_far], 1),
            np.stack([lo_a, mid_a, mid_b, hi_b, so_far + 1], 1),
            np.stack([mid_a, hi_a, lo_b, mid_b, so_far + 1], 1),
        ]
        front = np.concatenate(children)
        alive = (front[:, 1] > front[:, 0]) & (front[:, 3] > front[:, 2]) & (front[:, 4] <= most)
        if same:  # below one node each pair of children is met once
            alive &= front[:, 0] <= front[:, 2]
        front = front[alive]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _prefix(depth: int):
    """The first ``depth`` bits of a fingerprint."""
    return F.shiftrightunsigned(F.col("fp"), 64 - depth)


def _node_depth(distinct: DataFrame, node_rows: int) -> int:
    """The least even depth at which no node holds more than ``node_rows`` fingerprints."""
    depth = LEAST_DEPTH
    while depth < MOST_DEPTH:
        fullest = distinct.groupBy(_prefix(depth).alias("node")).count().agg(F.max("count")).first()[0] or 0
        if fullest <= node_rows:
            break
        depth += max(2, (fullest // node_rows).bit_length() // 2 * 2)
    return min(depth, MOST_DEPTH)


def node_pairs(distinct: DataFrame, depth: int, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``u <= v`` of existing trie nodes of one depth whose paths differ in ``diff <= max_bits`` bits.

    Walked from the root two levels at a time, over tables of existing nodes only.
    """
    pairs = distinct.sparkSession.createDataFrame([(0, 0, 0)], "u long, v long, diff int")
    for level in range(2, depth + 1, 2):
        nodes = distinct.select(_prefix(level).alias("node")).distinct()
        nodes = nodes.select("node", F.shiftright("node", 2).alias("parent"))
        if level >= 8:
            pairs, nodes = pin(pairs, "node-pairs"), pin(nodes, "nodes")
        left = nodes.select(F.col("parent").alias("u"), F.col("node").alias("x"))
        right = nodes.select(F.col("parent").alias("v"), F.col("node").alias("y"))
        pairs = pairs.join(left, "u").join(right, "v").where("x <= y")
        differing = F.bit_count(F.col("x").bitwiseXOR(F.col("y")).bitwiseAND(F.lit(3)))
        pairs = pairs.select(F.col("x").alias("u"), F.col("y").alias("v"), (F.col("diff") + differing).cast("int").alias("diff"))
        pairs = pairs.where(F.col("diff") <= max_bits)
    return pairs


def near_pairs(distinct: DataFrame, max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints (column ``fp``, no repeats) that differ in at most ``max_bits`` bits."""
    depth = _node_depth(distinct, node_rows)
    pairs = pin(node_pairs(distinct, depth, max_bits).withColumn("pair", F.xxhash64("u", "v")), "trie-front")
    placed = distinct.select(_prefix(depth).alias("node"), "fp")
    ends = pairs.select("u", "v", "diff", "pair", F.explode(F.array_distinct(F.array("u", "v"))).alias("node"))
    members = ends.join(placed, "node").select("u", "v", "diff", (F.col("node") == F.col("v")).alias("second"), "fp")

    def join(key, batch):
        import numpy as np
        import pyarrow as pa

        u, v, diff = (k.as_py() for k in key)
        second = np.asarray(batch.column("second").to_pylist(), dtype=bool)
        values = batch.column("fp").to_numpy().view(np.uint64)
        same = u == v
        a = np.sort(values if same else values[~second])
        b = a if same else np.sort(values[second])
        i, j = _pairs_below(a, b, depth, diff, max_bits, same)
        return pa.table({"a": a[i].view(np.int64), "b": b[j].view(np.int64)})

    return members.groupBy("u", "v", "diff").applyInArrow(join, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    node_rows: int = NODE_ROWS,
) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id`` (least id reachable over links), ``n_near`` (other fingerprints linked)
    and ``group`` (names the component by a fingerprint)."""
    prints = pin(fingerprints(docs, id_column, text, words), "fingerprints")
    # One row per fingerprint: copies are joined once, and only classes are linked.
    classes = pin(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_docs")), "classes")
    links = pin(near_pairs(classes.select("fp"), max_bits, node_rows), "links")
    roots = components(links).withColumnRenamed("node", "fp")
    both = links.select(F.col("a").alias("fp")).unionAll(links.select(F.col("b").alias("fp")))
    degree = both.groupBy("fp").agg(F.count(F.lit(1)).alias("n_near"))
    member = classes.join(roots, "fp").select("fp", "root", "first_id")
    named = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = member.join(named, "root").join(degree, "fp").select("fp", "component_id", "n_near", "root")
    side = classes.join(linked, "fp", "left").select(
        "fp",
        F.coalesce("component_id", "first_id").alias("component_id"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.coalesce("root", "fp").alias("group"),
    )
    return prints.join(pin(side, "class-components"), "fp").select("doc_id", "fp", "component_id", "n_near", "group")


def keep_one_of_each(docs: DataFrame, text: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of near copies: one with the group's least id; all columns stay as they are.

    Of repeated rows with that id one stays. Rows without an id go if another member of the group has one.
    """
    groups = pin(near_duplicates(docs, "doc_id", text, words, max_bits), "groups")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    repeated = pin(groups.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("__id")), "repeated-ids")
    later = groups.where(~first).select(F.col("doc_id").alias("__id"))
    out = pin(later.unionByName(repeated).distinct(), "leaving-ids")
    same_id = F.col("doc_id").eqNullSafe(F.col("__id"))
    kept = docs.join(out, same_id, "left_anti")
    if repeated.isEmpty():
        return kept
    # Rows that share an id (or have none) are told apart by their fingerprint, which costs a second pass over them.
    unclear = docs.join(repeated, same_id, "left_semi").withColumn("__fp", _fingerprint_column(F.col(text), words))
    stay = groups.where(first).select(F.col("doc_id").alias("__id"), F.col("fp").alias("__of"), F.col("group").alias("__group")).distinct()
    unclear = unclear.join(stay, same_id & (F.col("__fp") == F.col("__of"))).dropDuplicates(["__group"])
    return kept.unionByName(unclear.select(*docs.columns))


def _fingerprint_column(text, words: int):
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(_fingerprints([t if isinstance(t, str) else None for t in texts], words))

    return run(text)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_near")
