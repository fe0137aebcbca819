"""Merges: rules, ties, replays, and independence from how the input is split."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from fleetfold.operators import merge
from fleetfold.session import pin

DIM = "id string, name string, rate decimal(10,4), valid_from timestamp, valid_to timestamp, is_current boolean, key long"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def staged(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, rate double")


def load(spark, target, rows, day):
    return merge.scd2_merge(target, staged(spark, rows), "id", ["name", "rate"], day, "key")


def history(df):
    return sorted(
        ((r.id, r.name, None if r.rate is None else float(r.rate), str(r.valid_from)[:10], str(r.valid_to)[:10], r.is_current, r.key)
        for r in df.collect()), key=repr
    )


def test_scd2_life_of_a_member(spark):
    empty = spark.createDataFrame([], DIM)
    first = load(spark, empty, [("a", "x", 0.02), ("b", "y", None), (None, "z", 1.0)], "2026-01-01")
    assert history(first) == [
        ("a", "x", 0.02, "2026-01-01", "None", True, 1),
        ("b", "y", None, "2026-01-01", "None", True, 2),
    ]
    # The same again: nothing changes, although 0.02 arrives as a double.
    assert history(load(spark, first, [("a", "x", 0.02), ("b", "y", None)], "2026-01-02")) == history(first)
    # Null to value, a change, a new member.
    second = load(spark, first, [("a", "x2", 0.02), ("b", "y", 0.5), ("c", "n", 0.1)], "2026-01-03")
    assert history(second) == [
        ("a", "x", 0.02, "2026-01-01", "2026-01-03", False, 1),
        ("a", "x2", 0.02, "2026-01-03", "None", True, 3),
        ("b", "y", 0.5, "2026-01-03", "None", True, 4),
        ("b", "y", None, "2026-01-01", "2026-01-03", False, 2),
        ("c", "n", 0.1, "2026-01-03", "None", True, 5),
    ]
    # Changed back, and an absent member that stays open.
    third = load(spark, second, [("a", "x", 0.02)], "2026-01-04")
    opened = [r for r in third.collect() if r.is_current]
    assert sorted((r.id, r.name, r.key) for r in opened) == [("a", "x", 6), ("b", "y", 4), ("c", "n", 5)]
    assert third.count() == 6


def test_scd2_counts_a_key_staged_twice_once(spark):
    empty = spark.createDataFrame([], DIM)
    merged = load(spark, empty, [("a", "x", 1.0)] * 5 + [("a", "y", 1.0)], "2026-01-01")
    assert history(merged) == [("a", "y", 1.0, "2026-01-01", "None", True, 1)]


SEEN = "seen_at array<timestamp>"


def spans(df):
    """Versions without their numbers."""
    return sorted(((r.id, r.name, None if r.rate is None else float(r.rate), str(r.valid_from)[:10], str(r.valid_to)[:10], r.is_current) for r in df.collect()), key=repr)


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_scd2_loads_in_any_order_give_one_history(spark, order):
    loads = [
        ("2026-01-01", [("a", "x", 1.0), ("b", "y", None), ("c", "n", 1.0), ("e", "1", 1.0)]),
        ("2026-02-01", [("a", "x2", 1.0), ("b", "y", None), ("d", "q", 2.0), ("e", "2", 1.0)]),
        ("2026-03-01", [("a", "x", 1.0), ("b", "y", 0.5), ("c", "n", 1.0), ("d", "q", 2.0), ("e", "2", 1.0)]),
    ]
    target = spark.createDataFrame([], f"{DIM}, {SEEN}")
    for k in order:
        target = load(spark, target, loads[k][1], loads[k][0])
    assert spans(target) == [
        ("a", "x", 1.0, "2026-01-01", "2026-02-01", False),
        ("a", "x", 1.0, "2026-03-01", "None", True),
        ("a", "x2", 1.0, "2026-02-01", "2026-03-01", False),
        ("b", "y", 0.5, "2026-03-01", "None", True),
        ("b", "y", None, "2026-01-01", "2026-03-01", False),
        ("c", "n", 1.0, "2026-01-01", "None", True),
        ("d", "q", 2.0, "2026-02-01", "None", True),
        ("e", "1", 1.0, "2026-01-01", "2026-02-01", False),
        ("e", "2", 1.0, "2026-02-01", "None", True),
    ]
    keys = [r.key for r in target.collect()]
    assert None not in keys and len(set(keys)) == len(keys)


def test_scd2_random_loads_equal_a_plain_history(spark):
    rng = random.Random(8)
    loads = [(f"2026-01-{d:02d}", [(k, rng.choice("xy"), 1.0) for k in "abcdefgh" if rng.random() < 0.7]) for d in range(1, 9)]
    expected = []
    for k in "abcdefgh":
        seen = [(day, value) for day, rows in loads for key, value, _ in rows if key == k]
        runs = [list(g) for _, g in itertools.groupby(seen, lambda s: s[1])]
        for run, after in zip(runs, [*runs[1:], None]):
            expected.append((k, run[0][1], 1.0, run[0][0], after[0][0] if after else "None", after is None))
    rng.shuffle(loads)
    target = spark.createDataFrame([], f"{DIM}, {SEEN}")
    for day, rows in loads:
        target = pin(load(spark, target, rows, day), "history")
    assert spans(target) == sorted(expected, key=repr)


def test_scd2_late_load_without_seen_times_keeps_spans_sound(spark):
    """Seen on the table of a user: closing the open version before it began."""
    first = load(spark, spark.createDataFrame([], DIM), [("a", "x", 1.0)], "2026-02-01")
    late = load(spark, first, [("a", "w", 1.0), ("b", "y", 1.0)], "2026-01-01")
    assert spans(late) == [("a", "w", 1.0, "2026-01-01", "2026-02-01", False), ("a", "x", 1.0, "2026-02-01", "None", True), ("b", "y", 1.0, "2026-01-01", "None", True)]
    assert {r.key for r in late.where("name = 'x'").collect()} == {1}  # facts refer to it
    assert spans(load(spark, late, [("a", "w", 1.0)], "2026-01-01")) == spans(late)


def test_scd2_late_load_keeps_an_end_without_successor(spark):
    rows = [("a", "x", 1.0, "2026-01-01", "2026-03-01", False, 1)]
    closed = spark.createDataFrame(rows, "id string, name string, rate double, f string, t string, is_current boolean, key long")
    closed = closed.select("id", "name", F.col("rate").cast("decimal(10,4)").alias("rate"), F.col("f").cast("timestamp").alias("valid_from"), F.col("t").cast("timestamp").alias("valid_to"), "is_current", "key")
    assert spans(load(spark, closed, [("a", "w", 1.0)], "2025-12-01")) == [
        ("a", "w", 1.0, "2025-12-01", "2026-01-01", False), ("a", "x", 1.0, "2026-01-01", "2026-03-01", False)
    ]


def test_scd2_untracked_attributes_open_no_version(spark):
    empty = spark.createDataFrame([], DIM)
    first = load(spark, empty, [("a", "x", 1.0)], "2026-01-01")
    again = merge.scd2_merge(first, staged(spark, [("a", "other", 1.0)]), "id", ["rate"], "2026-01-02", "key")
    assert history(again) == history(first)


def test_scd1_overwrites_inserts_and_keeps_own_columns(spark):
    target = spark.createDataFrame([("a", 1, "keep", 10), ("b", 2, "keep", 11)], "id string, v int, own string, key long")
    new = spark.createDataFrame([("b", None), ("c", 3), ("c", 3), (None, 9)], "id string, v int")
    merged = merge.scd1_merge(target, new, "id", "key")
    assert rows_of(merged) == sorted([("a", 1, "keep", 10), ("b", None, "keep", 11), ("c", 3, None, 12)], key=repr)
    assert rows_of(merge.scd1_merge(merged, new, "id", "key")) == rows_of(merged)


def test_insert_absent_survives_null_keys(spark):
    target = spark.createDataFrame([("a",), (None,)], "id string")
    new = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "id string, v int")
    assert rows_of(merge.insert_absent(target, new, "id")) == [("b", 2)]


def test_changed_rows_treat_null_as_a_value(spark):
    old = spark.createDataFrame([("a", None), ("b", 1), ("c", None), ("d", 4)], "id string, v int")
    new = spark.createDataFrame([("a", 1), ("b", None), ("c", None), ("d", 4)], "id string, v int")
    assert {r.id for r in merge.changed_rows(old, new, "id", ["v"]).collect()} == {"a", "b"}


def test_latest_and_first_per_key_with_ties(spark):
    rows = [("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 2, None), ("b", None, 1, "z")]
    df = spark.createDataFrame(rows, "k string, t int, id int, v string")
    assert rows_of(merge.latest_per_key(df, ["k"], ["t", "id"])) == [("a", 2, 2, None), ("b", None, 1, "z")]
    assert rows_of(merge.latest_per_key(df, ["k"], ["t", "id"], first=True)) == [("a", 1, 1, "x"), ("b", None, 1, "z")]


def test_surrogate_keys_follow_the_natural_order(spark):
    df = spark.createDataFrame([(f"n{i:03d}",) for i in random.Random(1).sample(range(500), 500)], "id string").repartition(6)
    for limit in (0, 10_000):
        got = merge.surrogate_keys(df, "id", "key", after=40, max_group_rows=limit)
        assert sorted(map(tuple, got.collect())) == [(f"n{i:03d}", 41 + i) for i in range(500)]


POLICY = merge.Policies(
    key="k", order=("t", "id"), latest=("s",), last_known=("p",), first=("c",), greatest=("d",), sticky_true=("done",)
)


def random_events(n, seed):
    rng = random.Random(seed)
    return [
        (
            rng.choice(["hot", "hot", "hot", *"abcdef", None]),
            rng.choice([None, *range(8)]) if rng.random() < 0.05 else rng.randrange(8),
            i,
            rng.choice([None, "s1", "s2"]),
            rng.choice([None, None, 5, 6]),
            rng.choice(["c1", "c2", None]),
            rng.choice([None, 0.5, 1.5, 2.5]),
            rng.random() < 0.2,
        )
        for i in range(n)
    ]


def expected_fold(rows):
    out = {}
    keyed = sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: (r[1], r[2]))
    for key, group in itertools.groupby(sorted(keyed, key=lambda r: r[0]), key=lambda r: r[0]):
        group = list(group)
        known = [r[4] for r in group if r[4] is not None]
        far = [r[6] for r in group if r[6] is not None]
        out[key] = (
            group[0][5], group[-1][3], known[-1] if known else None, max(far) if far else None,
            any(r[7] for r in group), group[-1][1],
        )
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_order_and_replay_folds_to_the_closed_form(spark, seed):
    rows = random_events(300, seed)
    schema = "k string, t int, id int, s string, p int, c string, d double, done boolean"
    rng = random.Random(seed)
    batches = [rows[i::5] for i in range(5)]
    rng.shuffle(batches)
    state = None
    for batch in [*batches, batches[0], batches[3]]:
        state = merge.merge_with_policy(state, spark.createDataFrame(batch, schema), POLICY)
    got = {r.k: (r.c, r.s, r.p, r.d, r.done, r.last_event_at) for r in merge.read_state(state, POLICY).collect()}
    assert got == expected_fold(rows)


def test_reference_batching_uses_the_newest_row_of_a_batch_only(spark):
    schema = "k string, t int, id int, s string, p int, c string, d double, done boolean"
    batch = spark.createDataFrame([("a", 1, 1, "x", 7, "c", 9.0, True), ("a", 2, 2, "y", None, "c", 1.0, False)], schema)
    whole = merge.read_state(merge.merge_with_policy(None, batch, POLICY), POLICY).first()
    newest = merge.read_state(merge.merge_with_policy(None, batch, POLICY, reference_batching=True), POLICY).first()
    assert (whole.p, whole.d, whole.done) == (7, 9.0, True)
    assert (newest.p, newest.d, newest.done) == (None, 1.0, False)


def test_late_event_does_not_replace_newer_state(spark):
    schema = "courier string, t int, id int, status string"
    now = spark.createDataFrame([("a", 5, 1, "new")], schema)
    late = spark.createDataFrame([("a", 3, 2, "old"), ("b", 1, 3, "first"), (None, 9, 4, "lost")], schema)
    state = merge.upsert_latest(now, late, "courier", ["t", "id"])
    assert rows_of(state) == [("a", 5, 1, "new"), ("b", 1, 3, "first")]


def test_differs_on_no_columns_is_false(spark):
    df = spark.range(1).select(F.struct(F.lit(1).alias("a")).alias("l"), F.struct(F.lit(2).alias("a")).alias("r"))
    assert df.where(merge.differs("l", "r", [])).count() == 0


def test_versions_meet_exactly_with_the_default_clock(spark):
    def load(target, rows):
        return merge.scd2_merge(target, staged(spark, rows), "id", ["name", "rate"], None, "key")

    empty = staged(spark, []).withColumns(
        {"valid_from": F.lit(None).cast("timestamp"), "valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True), "key": F.lit(None).cast("long")}
    )
    from fleetfold.session import pin

    first = pin(load(empty, [(k, "x", 1.0) for k in "abcdef"]), "first")
    second = pin(load(first, [(k, "y", 1.0) for k in "abcdef"]), "second")
    for key in "abcdef":
        old, new = sorted(second.where(F.col("id") == key).collect(), key=lambda r: r.valid_from)
        assert old.valid_to == new.valid_from and not old.is_current and new.is_current and new.valid_to is None
