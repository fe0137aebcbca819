"""The whole pipeline, and language identification, row by row against plain versions on the smallest tables."""

import hashlib
import re
import zlib
from collections import Counter

import cases
import compare
import corpus_pipeline
import public_tokenizers
import pytest
from fleetfold.llm.queries import QUERIES


@pytest.fixture(scope="module")
def tables(sf_dir):
    duck = compare.connect(sf_dir)
    return duck.sql("SELECT doc_id, text, lang, source FROM documents").fetchall(), dict(duck.sql("SELECT item_id, text FROM benchmark").fetchall())


def spaced(text):
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    return f"_{'_'.join(words)}_" if words else ""


def grams(framed):
    """N-grams in order: single letters first, then pairs, then triples."""
    return [g for n in (1, 2, 3) for k in range(len(framed) - n + 1) if (g := framed[k : k + n]) != "_"]


def profiles(rows):
    counts = {}
    for doc_id, text, lang, _ in rows:
        if lang is not None and zlib.crc32(str(doc_id).encode()) % 3 != 1:
            counts.setdefault(lang, Counter()).update(grams(spaced(text)))
    return {lang: {g: k for k, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:400])} for lang, c in counts.items()}


def identify(text, known):
    """Language, score and similarity by out-of-place distance."""
    own = [g for g, _ in Counter(grams(spaced(text))).most_common(400)]
    if not own:
        return "und", 0.0, 0.0
    worst = max(map(len, known.values()))
    far = {lang: sum(min(abs(p[g] - k), worst) if g in p else worst for k, g in enumerate(own)) for lang, p in known.items()}
    (first, best), (second, _) = sorted((d, lang) for lang, d in far.items())[:2]
    return best, 0.5 + 0.5 * (second - first) / second if second else 0.5, 1 - first / (worst * len(own))


def test_language_id_equals_a_plain_version(spark, sf_dir, tables):
    known = profiles(tables[0])
    got = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op8_language_id"](spark, sf_dir).collect()}
    for doc_id, text, *_ in tables[0]:
        lang, score, _ = identify(text, known)
        assert got[doc_id][0] == lang and got[doc_id][1] == pytest.approx(score)


def without_boilerplate(rows):
    key = lambda line: line.strip(" \t\r")
    pages, totals = Counter(), Counter(source for *_, source in rows)
    for _, text, _, source in rows:
        pages.update((source, line) for line in {key(x) for x in text.split("\n")} - {""})
    bad = {(s, line) for (s, line), n in pages.items() if n >= 2 and n > 0.1 * totals[s]}
    return [(d, "\n".join(x for x in t.split("\n") if (s, key(x)) not in bad), lang, s) for d, t, lang, s in rows]


def test_pipeline_equals_a_plain_version(spark, sf_dir, tables):
    from tokenizers import Tokenizer

    rows, items = tables
    known = profiles(rows)
    found = {r[0]: identify(r[1], known) for r in rows}
    rows = [r for r in rows if found[r[0]][0] != "und" and found[r[0]][2] >= 0.02]
    rows = without_boilerplate(rows)
    groups = cases.classes({r[0]: cases.simhash(r[1]) for r in rows})
    rows = [r for r in rows if groups[r[0]] == r[0]]
    rows = [r for r in rows if not cases.decontaminate(r[1], items)[3]]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {}
    for doc_id, text, *_ in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        expected[doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == expected and 0 < len(got) < len(tables[0])


def test_words_in_the_plain_versions():
    assert re.sub("_", "", spaced("a½b, Ⅷ c")) == "abc"
