"""FM-indexes against plain counting, and collocations against a plain version."""

import re
from collections import Counter

import cases
import numpy as np
import pytest
from fleetfold.llm import phrases
from fleetfold.llm.phrases import Index, collocations, counted_phrases


def pieces(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def plain_counts(rows):
    counts = Counter()
    for text, lang in rows:
        for words in pieces(text):
            for size in range(1, 5):
                counts.update(("und" if lang is None else lang, tuple(words[k : k + size])) for k in range(len(words) - size + 1))
    return counts


def plain(rows, least, top):
    counts = plain_counts(rows)
    out = {}
    candidates = {g: a for g, a in counts.items() if len(g[1]) > 1 and a >= least}
    for (lang, words), a in candidates.items():
        inside = lambda longer: any(longer[k : k + len(words)] == words for k in range(len(longer) - len(words) + 1))
        if any(o == lang and len(w) > len(words) and 100 * f >= 80 * a and inside(w) for (o, w), f in candidates.items()):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        n = sum(f for (o, w), f in counts.items() if o == lang and len(w) == 1)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right, n))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n, -s) for lang, own in out.items() for rank, (s, a, p, left, right, n) in enumerate(sorted(own)[:top], 1)
    )


def invented(n, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        words = [f"w{x}" for x in rng.zipf(1.5, rng.integers(0, 60)) if x < 40]
        rows.append((" ".join(words) + rng.choice([". The Big red dog, ran", "! the big red cat\tsat;", " the big\nred dog"]), ["en", None, "fr"][k % 3]))
    return rows


def test_intervals_equal_plain_counts():
    rng = np.random.default_rng(6)
    text = np.append(rng.integers(0, 6, 3000), 0).astype(np.int32)
    index = Index.of(text, 6)
    plain_of = lambda size: Counter(g for k in range(len(text) - size + 1) if 0 not in (g := tuple(text[k : k + size].tolist())))
    left = right = both = index.words()
    for size in range(2, phrases.DEPTH + 1):
        left, right, both = index.extended(left, False), index.extended(right, True), index.extended(both, size % 2 == 0)
        for got in (left, right, both):
            assert dict(zip(map(tuple, got.words.tolist()), got.counts.tolist())) == plain_of(size)


@pytest.mark.parametrize("shard_words", [50, 700, phrases.SHARD_WORDS])
def test_counts_sum_up_over_shards(spark, shard_words):
    rows = invented(200)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    counts, totals = counted_phrases(docs, 5, shard_words=shard_words)
    got = {(r.lang, tuple(r.phrase.split(" "))): r.f for r in counts.collect()}
    assert got == {g: f for g, f in plain_counts(rows).items() if f >= 5}
    words = Counter()
    for (lang, gram), f in plain_counts(rows).items():
        words[lang] += f * (len(gram) == 1)
    assert {r.lang: r.n for r in totals.collect()} == words


@pytest.mark.parametrize("top", [7, 2000])
def test_collocations_equal_a_plain_version(spark, top):
    rows = invented(300)
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = sorted(tuple(r) for r in collocations(docs, 5, top, shard_words=400).collect())
    assert got == plain(rows, 5, top) and any(len(g[2].split()) == 4 for g in got)


def test_edge_rows(spark):
    rows = [(r[1], r[2]) for r in cases.EDGE_ROWS]
    docs = cases.edge_docs(spark)
    got = sorted(tuple(r) for r in collocations(docs, 2, 50, shard_words=1000).collect())
    assert got == plain(rows, 2, 50) and got
    assert collocations(cases.empty_docs(spark)).count() == 0
    stops = spark.createDataFrame([(" .,\t;", "en"), (None, None)], "text string, lang string")
    assert collocations(stops, 1).count() == 0


def test_a_long_text_is_cut_at_piece_ends():
    text = np.array([3, 3, 0, 2, 2, 2, 2, 0, 1, 0], np.int32)
    assert [p.tolist() for p in phrases._cut(text, 3)] == [[3, 3, 0], [2, 2, 2, 2, 0], [1, 0]]


def test_scores_are_exact_beyond_64_bits(spark):
    from unittest import mock

    big = 2**62 // 3
    counts = spark.createDataFrame(
        [("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 1)], "lang string, size int, phrase string, f long"
    )
    totals = spark.createDataFrame([("en", 2 * big + 1)], "lang string, n long")
    with mock.patch.object(phrases, "counted_phrases", return_value=(counts, totals)):
        (row,) = collocations(counts).collect()
    assert row.score == 2000000 * (big - 1) // (2 * big + 1) and (row.l, row.r) == (big, big + 1)
