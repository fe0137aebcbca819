"""Block matrix join: bounds that lose nothing, and the result against brute force."""

import math

import numpy as np
import pytest
from fleetfold.llm import neighbours
from fleetfold.llm.neighbours import Codes, code_products, inner_products, nearest, survivors

SCHEMA = "vec_id long, embedding array<double>, query_id string, rank string, ids string"


def plain(rows, k):
    """(query, rank, id, score), queries being the ids that 5 divides."""
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for query, q in usable:
        if query % 5:
            continue
        scored = []
        for i, v in usable:
            if i != query and len(v) == len(q):
                total = 0.0
                for a, b in zip(q, v):
                    total += a * b
                scored.append((-total, i))
        out += [(query, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def found(spark, rows, k=4, **settings):
    df = spark.createDataFrame([(i, v, "own", "own", "own") for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in nearest(df.where("vec_id % 5 = 0"), df, k, **settings).collect())


def test_products_of_codes_are_exact():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-127, 128, (5, 2500), dtype=np.int8), rng.integers(-127, 128, (7, 2500), dtype=np.int8)
    assert (code_products(a, b) == a.astype(np.int64) @ b.astype(np.int64).T).all()


@pytest.mark.parametrize("scale", [1e-30, 1e-3, 1.0, 1e9, 1e40])
def test_no_pair_above_the_floor_is_dropped(scale):
    rng = np.random.default_rng(2)
    q, x = rng.normal(size=(40, 24)) * scale, rng.normal(size=(300, 24)) * rng.choice([1e-4, 1, 50], (300, 1))
    scores = np.stack([inner_products(np.repeat(one[None], len(x), 0), x) for one in q])
    least = np.sort(scores, axis=1)[:, -10]
    kept = set(zip(*(a.tolist() for a in survivors(Codes(q), Codes(x), least))))
    needed = set(zip(*(a.tolist() for a in np.nonzero(scores >= least[:, None]))))
    assert needed <= kept
    assert scale > 1e10 or scale < 1e-10 or len(kept) < 0.5 * scores.size  # plain vectors are sieved


@pytest.mark.parametrize("settings", [{}, {"query_bytes": 100, "strip_rows": 7}])
def test_neighbours_equal_brute_force(spark, settings):
    rng = np.random.default_rng(3)
    rows = [(k, rng.integers(-3, 4, 6).astype(float).tolist()) for k in range(120)]  # many ties and equal vectors
    rows += [(200 + k, [1.0, 2.0, 3.0, 0.0, 0.0, -1.0]) for k in range(40)]  # a group of copies, queries among them
    assert found(spark, rows, **settings) == plain(rows, 4)


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(5, None), (10, []), (15, [0.0, -0.0]), (20, [nan, 1.0]), (25, [inf, 1.0]), (30, [None, 1.0]), (None, [9.0, 9.0])]
    some = [(35, [1.0, 2.0]), (35, [1.0, 2.0]), (35, [2.0, 1.0]), (41, [1e200, 1.0]), (42, [1e-200, 0.0]), (43, [-0.0, 1.0]), (44, [0.0, 1.0]), (45, [5.0, 1.0, 1.0])]
    got = found(spark, odd + some)
    assert got == plain(odd + some, 4)
    assert {g[0] for g in got} == {35}  # 45 has no candidate of its length
    assert found(spark, [(5, [1.0]), (6, [2.0])]) == [(5, 1, 6, 2.0)]
    assert found(spark, []) == []


def test_float_vectors_count_in_double_precision(spark):
    df = spark.createDataFrame([(0, [0.1, 0.7]), (1, [0.3, 0.9])], "vec_id long, embedding array<float>")
    a, b = [np.array(v, np.float32).astype(float) for v in ([0.1, 0.7], [0.3, 0.9])]
    assert nearest(df.where("vec_id = 0"), df, 2).first().score == a[0] * b[0] + a[1] * b[1]


def test_a_tile_takes_any_order_of_pieces():
    rng = np.random.default_rng(4)
    q, x = rng.normal(size=(30, 8)), rng.normal(size=(900, 8))
    tile = neighbours.Tile([(k, k) for k in range(30)], q, 5)
    for at in range(0, 900, 70):
        tile.feed(x[at : at + 70], [[k] for k in range(at, min(at + 70, 900))])
    exact = q @ x.T
    for (k, _), ids, scores in tile.results():
        assert ids == np.argsort(-exact[k])[:5].tolist() and scores == sorted(scores, reverse=True)
