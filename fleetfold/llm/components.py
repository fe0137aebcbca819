"""Connected components of links between keys, by alternating large and small stars.

Every round is a pair of grouped minima and joins; nothing is gathered in one task or on the driver. The
result of each round is a table in the shared folder, so a lost executor costs at most one round.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetfold.session import pin


def _spanning(batches: Iterator) -> Iterator:
    """Links of one partition reduced to stars with the same components, a few million links at a time."""
    import pyarrow as pa

    held: list = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= 2_000_000:
            yield _stars(pa.Table.from_batches(held))
            held, size = [], 0
    if held:
        yield _stars(pa.Table.from_batches(held))


def _stars(links):
    import pyarrow as pa

    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x] = top
            x = up
        return top

    for a, b in zip(links.column(0).to_pylist(), links.column(1).to_pylist()):
        x, y = root(a), root(b)
        parent.setdefault(x, x)
        parent.setdefault(y, y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    pairs = [(x, root(x)) for x in parent]
    pairs = [(x, r) for x, r in pairs if x != r]
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"]
    )


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (least node of its component) for every node of ``links`` (two long columns ``a``, ``b``).

    Large star: hang the larger neighbours of a node on its least neighbour. Small star: hang the smaller
    ones, and the node, on the least. When a round changes nothing every component is a star.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    edges = pin(links.mapInArrow(_spanning, "a long, b long").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = pin(large.where("a <> b").distinct(), "large-star")
        small_least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        hung = large.join(small_least, F.col("a") == F.col("n"))
        small = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(hung.select("a", F.col("m").alias("b")))
        edges = pin(small.where("a <> b").distinct(), "small-star")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
