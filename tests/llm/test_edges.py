"""Nulls, empty and very long texts, ties, repeated rows, empty tables, and extra columns with clashing names."""

import random
import time

import cases
import corpus_pipeline
import public_tokenizers
import pytest
from fleetfold.llm import bpe, decontam, fingerprints, langid, linededup, pii, simhash, spans, tokenfiles, toxicity
from fleetfold.session import scratch
from pyspark.sql import functions as F

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return cases.edge_docs(spark)


@pytest.fixture(scope="module")
def empty(spark):
    return cases.empty_docs(spark)


def own_columns_kept(df):
    assert all(r[0] == f"own {name}" for name in cases.CLASHING for r in df.select(name).distinct().collect())


def test_line_dedup(spark, docs, empty):
    out = linededup.drop_boilerplate(docs)
    assert out.columns[: len(docs.columns)] == docs.columns
    own_columns_kept(out)
    # On site a one line stands on two of six pages; the pages that have it lose all they have. No other site repeats a line.
    expected = [(i, "" if s == "a" and t and t.startswith("Same text") else t) for i, t, _, s, _ in cases.EDGE_ROWS]
    assert cases.rows(out, "doc_id", "text") == sorted(expected, key=repr)
    assert linededup.drop_boilerplate(empty).count() == 0


def test_line_dedup_counts_pages_not_lines(spark):
    pages = [(k, None if k < 6 else "s", "menu\n menu\t\n\nbody %d" % k) for k in range(12)]
    pages += [(20, "t", "menu\nmenu\nmenu")]  # on all pages, but there is one
    pages += [(30 + k, "u", f"menu\nbody {k}") for k in range(2)]  # on both pages
    docs = spark.createDataFrame(pages, "doc_id long, source string, text string")
    out = {r.doc_id: r for r in linededup.drop_boilerplate(docs).collect()}
    assert out[0].text == "\nbody 0" and out[0]["__n_dropped"] == 2 and out[11].text == "\nbody 11"
    assert out[20].text == "menu\nmenu\nmenu"
    assert [out[30 + k].text for k in range(2)] == ["body 0", "body 1"]


def test_line_dedup_ratio_is_exceeded_not_met(spark):
    docs = spark.createDataFrame([(k, "s", "x" if k < 5 else f"line {k}") for k in range(10)], "doc_id long, source string, text string")
    dropped = lambda ratio: linededup.drop_boilerplate(docs, ratio=ratio).agg(F.sum("__n_dropped")).first()[0]
    assert dropped(0.5) == 0 and dropped(0.49) == 5


@pytest.mark.parametrize("leaf_chars", [64, 4_000, bpe.LEAF_CHARS])
def test_bpe(spark, docs, empty, leaf_chars):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTE_BPE)
    expected = []
    for doc_id, text, *_ in cases.EDGE_ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, ids, library.decode(ids, skip_special_tokens=False)))
    got = [tuple(r) for r in bpe.encode(docs, BYTE_BPE, leaf_chars=leaf_chars).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert bpe.encode(empty, BYTE_BPE).count() == 0


def test_fingerprints(spark, docs, empty):
    out = fingerprints.with_next(docs, fingerprints._compare, fingerprints._SCHEMA)
    got = cases.rows(out, "doc_id", "n_chars", "edited_sha256", "fingerprint", "near_edited", "near_next")
    order = [(d, t or "") for d, t, *_ in cases.EDGE_ROWS]
    hashes = {t: r.h for t in {t for _, t in order} for r in [spark.sql("SELECT xxhash64(:t) AS h", args={"t": t}).first()]}
    order.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]], r[1]), reverse=True)
    expected = []
    for k, (doc_id, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        changed = fingerprints.edited(text, following)
        a, b, c = (fingerprints.digests(t) for t in (text, changed, following))
        digest = fingerprints.hashlib.sha256(changed.encode()).hexdigest()
        expected.append((doc_id, len(text), digest, fingerprints.fingerprints_of([text])[0], cases.likeness(a, b), cases.likeness(a, c)))
    assert got == sorted(expected, key=repr)
    one = spark.createDataFrame([(1, "Alone. Here.")], "doc_id long, text string")
    assert fingerprints.with_next(one, fingerprints._compare, fingerprints._SCHEMA).first().near_next == 1.0
    assert fingerprints.with_next(empty, fingerprints._compare, fingerprints._SCHEMA).count() == 0


def test_simhash(spark, docs, empty):
    prints = {k: cases.simhash(row[1]) for k, row in enumerate(cases.EDGE_ROWS)}
    groups = cases.classes(prints)
    least = {}
    for k, row in enumerate(cases.EDGE_ROWS):
        if row[0] is not None:
            least[groups[k]] = min(row[0], least.get(groups[k], row[0]))
    expected = [(row[0], prints[k], least.get(groups[k])) for k, row in enumerate(cases.EDGE_ROWS)]
    got = [(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_keeps_one_of_each_group(spark, docs, empty):
    out = simhash.keep_one_of_each(docs)
    assert out.columns == docs.columns
    own_columns_kept(out)
    kept = sorted((r.doc_id, r.text or "") for r in out.select("doc_id", "text").collect() if r.doc_id is not None)
    groups = cases.classes({k: cases.simhash(row[1]) for k, row in enumerate(cases.EDGE_ROWS)})
    assert len(kept) + out.where("doc_id IS NULL").count() == len(set(groups.values()))
    assert [d for d, _ in kept] == [1, 4, 4, 5, 6, 7, 8]  # 2 and 3 are wordless as 1 is, 9 copies 4
    assert simhash.keep_one_of_each(empty).count() == 0


def test_token_files(spark, docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    out = scratch(spark, "files")
    tokenfiles.write_tokens(docs, WORD_BPE, out, block_ids=100)
    got = sorted(((r.start, r.doc_id, r.ids) for r in tokenfiles.read_tokens(spark, out).collect()))
    ids = [(d, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for d, t, *_ in cases.EDGE_ROWS]
    coded = [(d, b"".join(i.to_bytes(4, "little") for i in own)) for d, own in ids]
    assert sorted((d, b) for _, d, b in got if d is not None) == sorted(c for c in coded if c[0] is not None)
    assert [d for _, d, _ in got] == sorted([d for d, _ in ids], key=lambda d: (d is not None, d or 0))
    at = 0
    for start, _, own in got:
        assert start == at
        at += len(own) // 4
    out = scratch(spark, "files")
    tokenfiles.write_tokens(empty, WORD_BPE, out)
    assert tokenfiles.read_tokens(spark, out).count() == 0


def test_personal_data(spark, docs, empty):
    found = pii.find(docs)
    assert found.count() == len(cases.EDGE_ROWS)
    assert found.agg(F.sum(F.size("spans"))).first()[0] == sum(len(cases.personal(r[1] or "")) for r in cases.EDGE_ROWS)
    own_columns_kept(pii.sanitise(docs, found))
    assert cases.rows(pii.sanitise(docs, found), "doc_id", "text") == cases.rows(docs, "doc_id", "text")
    assert pii.find(empty).count() == 0


def test_repeated_spans(spark, docs, empty):
    out = spans.drop_repeated(docs)
    assert out.columns == [*docs.columns, "__removed"]
    own_columns_kept(out)
    texts = {(r.doc_id, r.text) for r in out.collect() if r.doc_id not in (5, 6)}
    same = cases.EDGE_ROWS[5][1]
    assert (4, same) in texts and (9, "") in texts and (None, None) in texts and (2, "") in texts
    assert out.where("doc_id = 4").count() == 3
    assert spans.drop_repeated(empty).count() == 0


def test_language(spark, docs, empty):
    got = langid.identify(docs, docs).select("doc_id", "__language.*").collect()
    by_text = {(r.doc_id, t): r for r, (_, t, *_) in zip(got, cases.EDGE_ROWS)}
    assert len(got) == len(cases.EDGE_ROWS)
    for (doc_id, text), row in by_text.items():
        wordless = not any(c.isalpha() for c in text or "")
        assert (row.lang_pred == "und") == wordless, doc_id
        assert 0 <= row.score <= 1
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    own_columns_kept(kept)
    assert langid.keep_identified(empty).count() == 0
    unlabelled = langid.identify(docs, docs.where("false")).select("__language.*").distinct().collect()
    assert [tuple(r) for r in unlabelled] == [("und", 0.0, 0.0)]


def test_number_signs_are_no_letters(spark, docs):
    odd = spark.createDataFrame([(1, "½ ② ① Ⅷ 12"), (2, "a½b")], "doc_id long, text string")
    got = {r.doc_id: r.lang for r in langid.identify(odd, docs).select("doc_id", "__language.lang_pred").toDF("doc_id", "lang").collect()}
    assert got[1] == "und" and langid._spaced("a½b Ⅷc") == "_a_b_c_"


def test_grams_are_ranked_by_one_sort_as_by_plain_counting(monkeypatch):
    pool = random.Random(3)
    signs = [chr(c) for c in range(1, 0x3000)] + list("_½Ⅷİß\n\0") + list("abé ") * 3000
    texts = [None, "", "_", "a", "__a__", "\0a\0", *["".join(pool.choices(signs, k=k)) for k in (1, 2, 5, 50, 3000) * 40]]
    wide = "a".join(chr(c) for c in range(0x4E00, 0x9FFF)) * 10  # too many letters, too long for one integer
    model = langid.RankOrder({"x": ["a", "_a", "_a_"], "y": ["é", "b", "ab"]})
    for text in [*texts, wide]:
        plain = [langid._packed(g) for g in langid.ranked_grams(text, model.grams)]
        assert list(model._ranked(text)) == plain, text
        codes, _ = langid._Spaced()(text)
        assert "".join(map(chr, codes)) == langid._spaced(text), text
    assert langid._ranked_codes(*model.spaced(wide), model.spaced.letters, model.grams) is None
    monkeypatch.setattr(langid, "ranked_grams", None)  # the usual text does without
    assert model.predict("a b a")[0] == "x"


def test_a_language_costs_less_than_counting_the_grams_one_by_one():
    words = random.Random(4)
    text = " ".join("".join(words.choices("abcdefghijklmnopqrstuvwxyzäöü", k=6)) for _ in range(2000))
    model = langid.RankOrder({"x": langid.ranked_grams(text, 400), "y": list("abc")})

    def least(call):
        times = []
        for _ in range(7):
            start = time.process_time()
            call()
            times.append(time.process_time() - start)
        return min(times)

    assert least(lambda: model.predict(text)) < 0.8 * least(lambda: langid.ranked_grams(text, model.grams))


def test_toxicity(spark, docs, empty):
    labels = spark.createDataFrame([(4, 1), (4, None), (5, 0), (99, 1), (None, 1)], "doc_id long, toxic int")
    got = docs.withColumn("own_score", toxicity.toxicity(docs, labels, F.col("text"))).select("doc_id", "own_score").collect()
    assert len(got) == len(cases.EDGE_ROWS) and all(0 < r.own_score < 1 for r in got)
    assert empty.withColumn("s", toxicity.toxicity(empty, labels, F.col("text"))).count() == 0
    none = docs.select(toxicity.toxicity(docs, labels.where("false"), F.col("text")).alias("s")).distinct().collect()
    assert len(none) == 1 and none[0].s < 0.5


def test_decontamination(spark, docs, empty):
    items = {
        1: "Same text, twice over, in two rows that repeat each other word by word and id by id, to the end of it.",
        2: "taken",
        3: "漢字",
        4: None,
        5: "?!",
        6: "word7 runs on word8 runs on word9 runs on word10 runs on word11 runs on word12",
        None: "without an",
    }
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string").withColumn("words", F.lit("clash"))
    bench = bench.unionAll(bench)
    out = decontam.contamination(docs, bench)
    own_columns_kept(out)
    got = [(r.doc_id, r.text, *r["__found"]) for r in out.select("doc_id", "text", "__found").collect()]
    for doc_id, text, n_words, n_hit, _, ids, n_items, contaminated in got:
        words, hit, found, bad = cases.decontaminate(text, items)
        assert (n_words, n_hit, ids, n_items, contaminated) == (words, hit, [f for f in found if f != "None"], len(found), bad), doc_id
    assert decontam.contamination(docs, bench.where("false")).where("__found.contaminated").count() == 0
    assert decontam.contamination(empty, bench).count() == 0
    clean = decontam.keep_clean(docs, bench)
    assert clean.columns == docs.columns and clean.where("doc_id = 9").count() == 0


def test_every_stage_with_edge_rows_and_without_rows(spark, docs, empty, sf_dir):
    for start in (docs, empty.withColumns({n: F.lit(f"own {n}") for n in cases.CLASHING})):
        rows = start
        for name, stage in corpus_pipeline.STAGES:
            path = scratch(spark, name)
            alone = stage(spark, start, sf_dir)  # on the raw rows, nulls and all
            assert alone.count() <= start.count()
            stage(spark, rows, sf_dir).write.parquet(path)
            rows = spark.read.parquet(path)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert rows.columns == start.columns
                own_columns_kept(rows)
