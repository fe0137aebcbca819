"""Ordered scans: the cut path must give what a window gives, whatever the keys."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetfold.plans import joins, ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, some under none, the rest under many."""
    rng = random.Random(5)
    rows = []
    for i in range(6000):
        kind = rng.random()
        key = "hot" if kind < 0.34 else None if kind < 0.4 else f"k{rng.randrange(700)}"
        rows.append((key, rng.randrange(50), i, rng.choice([None, rng.randrange(100)])))
    return spark.createDataFrame(rows, "k string, t int, id int, v int").repartition(7).cache()


def as_set(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_previous_row_over_the_cuts(skewed):
    fast = ordered.with_previous(skewed, ["k"], ["t", "id"], ["v", "id"])
    cut = ordered.with_previous(skewed, ["k"], ["t", "id"], ["v", "id"], max_group_rows=0)
    assert ordered.group_sizes(skewed, ["k"])[0] > 1800
    assert cut.columns == fast.columns == ["k", "t", "id", "v", "prev_v", "prev_id"]
    assert as_set(cut) == as_set(fast)


def test_previous_row_without_keys(skewed):
    cut = ordered.with_previous(skewed, [], ["id"], ["id"], max_group_rows=0)
    rows = {r.id: r.prev_id for r in cut.collect()}
    assert rows[0] is None and all(rows[i] == i - 1 for i in range(1, 6000))


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_totals_over_the_cuts(skewed, keys):
    measures = {"s": ("sum", "v"), "m": ("max", "v")}
    order = ["t", "id"]
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.select("*", F.sum("v").over(window).alias("s"), F.max("v").over(window).alias("m"))
    cut = ordered.with_running(skewed, keys, order, measures, max_group_rows=0)
    assert as_set(cut) == as_set(plain)
    assert as_set(ordered.with_running(skewed, keys, order, measures)) == as_set(plain)


def test_positions_are_dense(skewed):
    got = ordered.with_position(skewed.select("id"), ["id"], max_group_rows=0)
    assert sorted(map(tuple, got.collect())) == [(i, i + 1) for i in range(6000)]


def test_the_cut_is_even_though_one_key_is_hot(skewed):
    cut = ordered.Ordered(skewed, ["k"], ["t", "id"], 0).df
    sizes = [r["count"] for r in cut.groupBy(ordered.RANGE).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 6000 / 3


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, skewed, how):
    side = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 700, 2)], "k string, w int")
    hot = {r.k for r in joins.hot_keys(skewed, "k").collect()}
    assert hot == {"hot"}
    plain = skewed.join(side, "k", how).select("k", "t", "id", "v", "w")
    salted = joins.salted(skewed, side, "k", ["id"], how, salts=5).select("k", "t", "id", "v", "w")
    assert as_set(salted) == as_set(plain)


def test_lookup_spreads_hot_keys_itself_without_adaptive_splitting(spark, skewed):
    side = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(700)], "k string, w int")
    plain = joins.lookup(skewed, side, "k", spread_by=["id"])
    assert "_salt" not in plain._jdf.queryExecution().toString()
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        spread = joins.lookup(skewed, side, "k", spread_by=["id"])
        assert "_salt" in spread._jdf.queryExecution().toString()
        assert as_set(spread.select(*plain.columns)) == as_set(plain)
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
