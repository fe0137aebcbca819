"""The registered queries: against SQL where there is SQL, else against plain versions on the smallest tables."""

import hashlib
import zlib

import __spark_entry__ as driver
import cases
import compare
import numpy as np
import public_tokenizers
import pytest
from fleetfold.llm.queries import ORACLES, QUERIES

# Plain versions are in this module, ``test_pii`` and ``test_pipeline``; toxicity has held-out accuracy alone.
WITHOUT_SQL = {"op2_bpe", "op3_fingerprints", "op4_simhash", "op5_token_files", "op6_pii", "op7_substring_dedup", "op8_language_id", "op9_toxicity"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())


def result(spark, sf_dir, name, *columns):
    return {r[0]: tuple(r[1:]) for r in QUERIES[name](spark, sf_dir).select("doc_id", *columns).collect()}


def test_each_operator_is_registered_once_and_checked():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert "pipeline" in driver.queries() and set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert compare.differences(spark, duck, QUERIES[name], ORACLES[name], sf_dir) == []


def test_bpe_equals_the_library(spark, sf_dir, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = result(spark, sf_dir, "op2_bpe", "n_tokens", "ids_sha256", "decoded_sha256")
    for doc_id, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert got[doc_id] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_fingerprints_equal_a_plain_comparison(spark, sf_dir, texts):
    from fleetfold.llm.fingerprints import digests, edited, fingerprints_of

    got = result(spark, sf_dir, "op3_fingerprints", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    order = sorted(texts, reverse=True)
    assert len(got) == len(order)
    for k, doc_id in enumerate(order):
        text, following = texts[doc_id] or "", texts[order[(k + 1) % len(order)]] or ""
        changed = edited(text, following)
        prints = fingerprints_of([text, changed])
        near = cases.likeness(digests(text), digests(changed)), cases.likeness(digests(text), digests(following))
        assert got[doc_id] == (len(text), hashlib.sha256(changed.encode()).hexdigest(), *prints, *near)


def test_simhash_equals_all_pairs(spark, sf_dir, texts):
    prints = {doc_id: cases.simhash(text) for doc_id, text in texts.items()}
    expected = cases.classes(prints)
    got = result(spark, sf_dir, "op4_simhash", "fingerprint", "component_id")
    assert got == {doc_id: (f"{prints[doc_id]:016x}", expected[doc_id]) for doc_id in texts}


def test_token_files_hold_the_ids_in_order(spark, sf_dir, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = result(spark, sf_dir, "op5_token_files", "start", "n_tokens", "ids_crc32")
    start = 0
    for doc_id in sorted(texts):
        ids = [*library.encode(texts[doc_id] or "", add_special_tokens=False).ids, 1]
        assert got[doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_personal_data_equals_plain_patterns(spark, sf_dir, texts):
    got = result(spark, sf_dir, "op6_pii", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    for doc_id, text in texts.items():
        spans = cases.personal(text or "")
        joined = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)
        counts = tuple(sum(s[1] == k for s in spans) for k in range(4))
        assert got[doc_id][:5] == (*counts, hashlib.sha256(joined.encode()).hexdigest())
        assert {s for s in joined.split(",") if s} <= set(got[doc_id][5].split(","))


def test_repeated_spans_equal_one_pass_in_order(spark, sf_dir, texts):
    from fleetfold.llm.spans import merged, runs_of

    first, later = {}, {}
    for doc_id in sorted(texts):
        for run, start, end in runs_of(texts[doc_id] or ""):
            if first.setdefault(run, (doc_id, start)) != (doc_id, start):
                later.setdefault(doc_id, set()).add((start, end))
    got = result(spark, sf_dir, "op7_substring_dedup", "removed_spans", "text")
    assert any(later.values())
    for doc_id, text in texts.items():
        spans = merged(sorted(later.get(doc_id, ())))
        kept = text
        for start, end in reversed(spans):
            kept = kept[:start] + kept[end:]
        assert got[doc_id] == (",".join(f"{a}:{b}" for a, b in spans), kept)


def test_language_of_the_held_out_fold(spark, duck, sf_dir):
    langs = dict(duck.sql("SELECT doc_id, lang FROM documents").fetchall())
    got = result(spark, sf_dir, "op8_language_id", "held_out", "lang_pred", "score")
    assert all(held == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= score <= 1 for d, (held, _, score) in got.items())
    held_out = [lang == langs[d] for d, (held, lang, _) in got.items() if held and langs[d]]
    assert sum(held_out) >= 0.97 * len(held_out)


def test_toxicity_of_the_held_out_fold(spark, duck):
    sf_dir = "/root/testdata/sf0.01"
    labels = dict(compare.connect(sf_dir).sql("SELECT doc_id, toxic FROM labels").fetchall())
    got = result(spark, sf_dir, "op9_toxicity", "held_out", "score", "predicted")
    assert all(held == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= s <= 1 and p == (s >= 0.5) for d, (held, s, p) in got.items())
    pairs = [(labels[d], p) for d, (held, _, p) in got.items() if held and d in labels]
    assert sum(a == b for a, b in pairs) >= 0.95 * len(pairs)
