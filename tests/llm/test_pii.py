"""Disclosing terms and sanitised texts against plain versions."""

import hashlib
import math
import random
import re
from collections import defaultdict

import cases
import pytest
from fleetfold.llm import pii
from fleetfold.llm.queries import QUERIES

BY = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}


def words_outside(text, spans):
    for m in re.finditer(r"[^\W_]+", text):
        if not any(a < m.end() and m.start() < b for a, _, b, _ in spans):
            yield m


def plain_terms(texts):
    """Disclosure per term by definition, over the distinct texts."""
    distinct = sorted(set(texts))
    spans = {t: cases.personal(t) for t in distinct}
    seen = defaultdict(lambda: defaultdict(set))  # entity -> text -> what stands around
    for t in distinct:
        by_kind = defaultdict(list)
        for a, _, b, kind in spans[t]:
            by_kind[kind].append((a, b))
        for kind, own in by_kind.items():
            pattern = pii.PATTERNS[kind].replace("(?:(?<![A-Za-z0-9._%+-])|\\G)", "").replace("(?<![0-9])", "")
            found = [(m.start(), m.end()) for m in re.finditer(pattern, t)]
            for a, b in own:
                at = found.index((a, b))
                before = t[found[at - 1][1] if at else 0 : a][-pii.WINDOW :]
                behind = t[b : found[at + 1][0] if at + 1 < len(found) else len(t)][: pii.WINDOW]
                value = t[a:b].lower() if kind == "email" else t[a:b] if kind == "ip" else re.sub("[^0-9]", "", t[a:b])
                seen[f"{kind}:{value}"][t].add((before, behind))
    terms_of = {t: {m.group().lower() for m in words_outside(t, spans[t])} for t in distinct}
    whole = {t: set(re.findall(r"[^\W_]+", t.lower())) for t in distinct}
    out = {}
    for own in seen.values():
        information = math.log(len(distinct) / len(own))
        for term in set().union(*(terms_of[t] for t in own)):
            both = [t for t in own if term in terms_of[t]]
            evidence = min(len(set().union(*(own[t] for t in both))), len(both))
            n_term = sum(term in w for w in whole.values())
            mutual = math.log(len(distinct) * min(len(both), n_term) / (len(own) * n_term))
            disclosure = mutual / information * evidence**3 / (evidence**3 + pii.PRIOR) if information > 0 else 0.0
            if disclosure >= pii.GENERALISE:
                out[term] = max(out.get(term, 0), disclosure)
    return out


def plain_sanitised(text, terms):
    spans = cases.personal(text)
    marks = [(a, b, BY[kind]) for a, _, b, kind in spans]
    marks += [(m.start(), m.end(), "" if terms[m.group().lower()] >= pii.REMOVE else "[WORD]") for m in words_outside(text, spans) if m.group().lower() in terms]
    out, at = [], 0
    for a, b, by in sorted(marks):
        out += [text[at:a], by] if a >= at else []
        at = max(at, b)
    return "".join(out) + text[at:]


def corpus(seed):
    """Persons with words of their own near them, some of which others use too; mentions in two to twelve texts, and copies."""
    rng = random.Random(seed)
    common = [f"w{k}" for k in range(60)]
    texts = []
    for person in range(12):
        own, shared = f"Nickname{person}", f"Trade{person % 5}"
        address = rng.choice([f"p{person}@mail.example.org", f"10.0.{person}.7", f"+49 30 55{person:02d} 7{person:02d}1"])
        for _ in range(person + 1):
            body = rng.choices(common, k=rng.randrange(5, 40))
            for word in (own, shared, address) if rng.random() < 0.9 else (address,):
                body.insert(rng.randrange(len(body)), word)
            texts += [" ".join(body)] * rng.choice([1, 1, 3])
    texts += [" ".join([*rng.choices(common, k=20), f"Nickname{k % 12}" if k % 9 == 0 else "Trade3"]) for k in range(150)]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_terms_equal_a_plain_version(spark, seed):
    texts = corpus(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    terms = plain_terms(texts)
    assert terms and any(v >= pii.REMOVE for v in terms.values()) and any(v < pii.REMOVE for v in terms.values())
    found = pii.find(docs)
    for r in found.collect():
        text = texts[r.doc_id]
        expected = [(m.start(), m.end(), terms[m.group().lower()]) for m in words_outside(text, cases.personal(text)) if m.group().lower() in terms]
        assert [(t.start, t.end) for t in r.terms or []] == [e[:2] for e in expected]
        assert [t.disclosure for t in r.terms or []] == pytest.approx([e[2] for e in expected])
    for r in pii.sanitise(docs, found).collect():
        assert r.text == plain_sanitised(texts[r.doc_id], terms)


def test_one_text_never_discloses_and_two_may(spark):
    fill = [f"nothing of note in text {k} here" for k in range(40)]
    once = ["Quux met a@b.example yesterday"]
    twice = ["Zorro met c@d.example yesterday", "some day Zorro wrote that c@d.example is down"]
    docs = spark.createDataFrame(list(enumerate(fill + once * 5 + twice)), "doc_id long, text string")
    got = {t[0] for r in pii.find(docs).collect() for t in [((fill + once * 5 + twice)[r.doc_id][t.start : t.end],) for t in r.terms or []]}
    assert got == {"Zorro"}


def test_query_equals_plain_versions(spark, sf_dir):
    import compare

    texts = {d: t or "" for d, t in compare.connect(sf_dir).sql("SELECT doc_id, text FROM documents").fetchall()}
    terms = plain_terms(list(texts.values()))
    for r in QUERIES["op6_pii"](spark, sf_dir).collect():
        text = texts[r.doc_id]
        spans = cases.personal(text)
        spans += [(m.start(), 4, m.end(), "term") for m in words_outside(text, spans) if m.group().lower() in terms]
        assert r.spans == ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))
        assert r.sanitised_sha256 == hashlib.sha256(plain_sanitised(text, terms).encode()).hexdigest()
