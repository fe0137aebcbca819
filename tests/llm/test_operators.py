"""The operators' own parts on small rows, against plain Python."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from fleetfold.llm import bpe, components, fingerprints, pii, simhash, spans, tokenfiles, toxicity
from hypothesis import given, settings
from hypothesis import strategies as st

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(alphabet="abcdeing ", min_size=1, max_size=300), st.text(alphabet="漢字éü0123!?-", min_size=1, max_size=200)), st.integers(0, 300))
def test_joined_halves_are_the_whole(text, cut):
    vocab = bpe.vocabulary(BYTE_BPE)
    whole = text.replace(" ", "").encode()
    left, right = whole[: cut % (len(whole) + 1)], whole[cut % (len(whole) + 1) :]
    assert vocab.join(vocab.encode_run(left), vocab.encode_run(right)) == vocab.encode_run(whole)


@pytest.mark.parametrize("leaf, half", [(8, 2), (50, 7), (1000, 100)])
def test_leaves_join_to_the_whole_text(leaf, half):
    from tokenizers import Tokenizer

    library, vocab, rng = Tokenizer.from_file(BYTE_BPE), bpe.vocabulary(BYTE_BPE), random.Random(leaf)
    pieces = ["the ", "internationalisation", "   ", "\n\n", "漢字", "1234567890", "!!??", "don't", "<|endoftext|>", "é", "\t", "'s", " "]
    for _ in range(200):
        text = "".join(rng.choice(pieces) * rng.choice([1, 1, 2, 30]) for _ in range(rng.randrange(12)))
        parts = [(vocab.encode_run(p.encode()) if kind else vocab.encode(p), kind) for p, kind in vocab.leaves(text, leaf, half)]
        assert "".join(p for p, _ in vocab.leaves(text, leaf, half)) == text
        assert vocab.join_tree(parts) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=400))
def test_packed_values_come_back(values):
    control, data = tokenfiles.pack(np.array(values, dtype=np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert len(data) == sum(max(1, (v.bit_length() + 7) // 8) for v in values)
    assert tokenfiles.unpack(control, data, len(values)).tolist() == values


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=300), st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=300), st.integers(0, 200))
def test_subtracted_sketches_give_the_differences(a, b, shared):
    common = [k * 7919 + 1 for k in range(shared)]
    left, right = list({*a, *common}), list({*b, *common})
    ((only_left, only_right),) = fingerprints.differences([left], [right])
    assert set(only_left.tolist()) == set(left) - set(right) and set(only_right.tolist()) == set(right) - set(left)


def test_trie_join_equals_all_pairs(spark):
    rng = random.Random(4)
    seeds = [rng.getrandbits(64) for _ in range(150)]
    values = {0, 2**64 - 1, 1, 3, *seeds}
    for s in seeds:
        for _ in range(4):
            v = s
            for _ in range(rng.randrange(1, 4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    ordered = sorted(values)
    expected = {(a, b) for i, a in enumerate(ordered) for b in ordered[i + 1 :] if (a ^ b).bit_count() <= 2}
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in ordered]
    for node_rows in (4, 1 << 14):  # many small trie nodes, and few
        pairs = simhash.near_pairs(spark.createDataFrame(signed, "fp long"), 2, node_rows).collect()
        got = [tuple(sorted((r.a % 2**64, r.b % 2**64))) for r in pairs]
        assert len(got) == len(set(got)) and set(got) == expected


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5000, 5001), (5001, 5000), (7, 7)]
    random.Random(1).shuffle(links)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long").repartition(8)).collect()}
    assert got == {**{k: 0 for k in range(201)}, **{1000 + k: 1000 for k in range(300)}, 5000: 5000, 5001: 5000}


def test_terms_that_give_an_entity_away(spark):
    names = ["quick", "brown", "lazy", "old", "young", "bright"]
    rows = [(k, f"Every {n} day number{k} please write to Zebulon at zeb.q@mail.example.org or ask the {n} desk again") for k, n in enumerate(names)]
    rows += [(100 + k, f"Every {n} thing is said to be old at the desk or so they ask again and write day after day please") for k, n in enumerate(names)]
    copy = "Copies of one text name Arabella beside 203.0.113.9 and nothing else"
    rows += [(200 + k, copy) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find(docs)
    by_id = {r.doc_id: r for r in found.collect()}
    text = rows[0][1]
    assert [text[t.start : t.end] for t in by_id[0].terms] == ["Zebulon"]
    assert [s.kind for s in by_id[0].spans] == ["email"]
    assert not by_id[100].terms and not by_id[200].terms  # one context only, however many copies
    clean = {r.doc_id: r.text for r in pii.sanitise(docs, found).collect()}
    assert clean[0] == text.replace("Zebulon", "").replace("zeb.q@mail.example.org", "[EMAIL]")
    assert clean[100] == rows[6][1] and clean[203] == copy.replace("203.0.113.9", "[IP]")


def test_personal_data_in_hard_places(spark):
    import cases

    texts = [
        "a@b.c%d@e.f a@b a@b.c.d-e.f+g@h.ii", "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 00000255.0.0.01", "4111 1111-1111 1111 4111111111111112 5",
        "+1 (23) 456-7890- +12 +1((((((( +49.30.1234567x", "é+1 234 567 8901 😀 a@b.cd", "x" * 20_000 + "@y.zz " + "9" * 20_000 + " " + "1.2.3.4 " * 3_000,
        "a@b" + ".c" * 8_000,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.detect(docs).collect():
        assert [(s.start, s.kind_no, s.end, s.kind) for s in row.spans] == cases.personal(texts[row.doc_id])


def test_restored_words():
    counts: dict = {}
    for word, n in {"idiot": 50, "worthless": 50, "stupid": 40, "the": 500, "and": 400, "thing": 90, "an": 200, "is": 200, "are": 100}.items():
        for gram in toxicity.sequences(word):
            counts[gram] = counts.get(gram, 0) + n
    words = toxicity.Restorer(counts)
    for hidden, plain in {"1d10t": "idiot", "i d i o t": "idiot", "i.d-i_o*t": "idiot", "w0rthl3ss!!": "worthless", "stuuupid": "stupid", "ST*PID": "stpid"}.items():
        assert plain in words.all_words(hidden) or hidden == "ST*PID", hidden
    assert words.all_words("the thing, and 42 an") == ["the", "thing", "and", "an"]
    assert words.all_words("") == words.all_words(None) == words.all_words("!!! 123") == []


def test_a_passage_pasted_into_a_sentence_is_found():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8)))
    sentence = lambda: " ".join(word() for _ in range(rng.randrange(5, 15))) + ". "
    found = 0
    for _ in range(100):
        passage = ("".join(sentence() for _ in range(6)))[:400]
        first, second = ("".join(sentence() for _ in range(10)) + word() + " " + passage + " " + "".join(sentence() for _ in range(5)) for _ in range(2))
        known = {run for run, _, _ in spans.runs_of(first)}
        cover = spans.merged([(a, b) for run, a, b in spans.runs_of(second) if run in known])
        found += sum(b - a for a, b in cover) > 0.6 * len(passage)
    assert found >= 97
    assert "".join(spans.parts_of("a, b. c!? d\n\n e; f")) == "a, b. c!? d\n\n e; f"


def test_letter_sequences_are_counted_without_a_limit(spark):
    rng = random.Random(5)
    often = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)) for _ in range(45_000))
    docs = spark.createDataFrame([(often,), (often,), ("þiþlþ þ1þ1þ þ.1.þ.1.þ",), (None,), ("",)], "text string")
    counts: dict = {}
    for word in [*often.split() * 2, "þiþlþ"]:
        for gram in toxicity.sequences(word):
            counts[gram] = counts.get(gram, 0) + 1
    assert len(counts) > 400_000
    got = {r.part: tuple(r.words) for r in toxicity.restored(docs).collect()}
    assert got["þ1þ1þ"] == got["þ.1.þ.1.þ"] == ("þiþlþ",)
    table = {r.gram: r.n for r in toxicity.letter_counts(toxicity.corpus_words(docs)).collect()}
    assert table == counts


def test_group_counts_decode_like_all_counts(spark):
    texts = ["the idiot said that it is worthless", "1d10t i d i o t 1.d-1_o*t w0rthl3ss!! stuuupid sai1 th3|it a+b-c|d", "wor-th-less id1ot5, t h a t i s"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = {r.gram: r.n for r in toxicity.letter_counts(toxicity.corpus_words(docs)).collect()}
    whole = toxicity.Restorer(counts)
    got = {r.part: tuple(r.words) for r in toxicity.restored(docs).collect()}
    assert got == {part: whole.decode(part) for t in texts for part in whole.disguised(t)} and len(got) > 8


def test_terms_are_taken_out_wherever_they_stand(spark):
    names = ["quick", "brown", "lazy", "old", "young", "bright"]
    far = " and so on it goes without an end" * 5
    rows = [(k, f"Every {n} day number{k} write to zeb.q@mail.example.org or ask{far} Zebulon at the desk") for k, n in enumerate(names)]
    rows += [(10, "Only Zebulon is named here, and Zebulon again")]
    rows += [(100 + k, f"Every {n} thing {k} write to or ask at the desk{far} day number") for k, n in enumerate(names * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    found = pii.find(docs)
    got = {r.doc_id: [texts[r.doc_id][t.start : t.end] for t in r.terms or []] for r in found.collect()}
    assert got == {k: ["Zebulon"] if k < 10 else ["Zebulon"] * 2 if k == 10 else [] for k in texts}
    assert {r.doc_id: r.text for r in pii.sanitise(docs, found).collect()}[10] == "Only  is named here, and  again"


def test_repeats_in_text_without_ascii_stops_or_spaces():
    rng = random.Random(6)
    han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))
    thai = lambda n: "".join(chr(rng.randrange(0x0E01, 0x0E2F)) for _ in range(n))
    tabbed = lambda n: "\t".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)) + "\t"
    stops = lambda n: "".join(han(15) + "。" for _ in range(n // 15))
    for make, size in ((han, 400), (thai, 400), (stops, 400), (tabbed, 150)):
        passage = make(size)
        first, second = make(200) + passage + make(200), make(200) + passage + make(200)
        assert "".join(spans.parts_of(first)) == first
        known = {run for run, _, _ in spans.runs_of(first)}
        cover = spans.merged([(a, b) for run, a, b in spans.runs_of(second) if run in known])
        begin = second.index(passage)
        assert 0.6 * len(passage) < sum(b - a for a, b in cover) <= len(passage)
        assert all(begin <= a and b <= begin + len(passage) for a, b in cover)


def test_long_runs_of_single_letters_are_decoded_whole():
    counts: dict = {}
    for word, n in {"you": 50, "stupid": 40, "worthless": 40, "idiot": 30}.items():
        for gram in toxicity.sequences(word):
            counts[gram] = counts.get(gram, 0) + n
    meant = ["you", "stupid", "worthless", "idiot"] * 50
    run = " ".join("".join(meant))
    assert toxicity.Reader().disguised(run) == [run]
    assert toxicity.Restorer(counts).decode(run) == tuple(meant)


def letter_table(words):
    counts: dict = {}
    for word, n in words.items():
        for gram in toxicity.sequences(word):
            counts[gram] = counts.get(gram, 0) + n
    return counts


def cheapest(model, text):
    """Least cost over all paths of a string, and the words of the paths that have it; every path is built as a whole."""
    alpha = any(c.isalpha() for c in text)
    solid = [k for k, c in enumerate(text) if c.isalnum()]
    inner = (solid[0], solid[-1]) if alpha else (0, len(text))
    paths = {("", 0.0)}
    for k, sign in enumerate(text):
        if sign.isalpha():
            moves = [(sign, 0.0)] + ([("", toxicity.COST_REPEAT)] if k and text[k - 1] == sign else [])
        else:
            moves = [(c, toxicity.COST_LEET) for c in toxicity.LEET.get(sign, "")]
            if sign in toxicity.SEPARATORS:
                moves += [("", toxicity.COST_DROP / (2 if sign == " " else 1)), (" ", 0.0)]
            elif moves and not inner[0] <= k <= inner[1]:
                moves.append((" ", toxicity.COST_DROP))
            elif sign in "!|+(":
                moves.append((" ", toxicity.COST_LEET))
        paths = {(made + out, cost + more) for made, cost in paths for out, more in moves or [(" ", 0.0)]}
    costs: dict = {}
    for made, cost in paths:
        words = tuple(made.split())
        for word in words:
            framed = "^" + word + "$"
            cost += sum(model.cost(framed[max(0, k - model.order + 1) : k], framed[k]) for k in range(1, len(framed)))
        costs[words] = min(cost, costs.get(words, cost))
    least = min(costs.values())
    stands = not alpha and least >= toxicity.COST_STANDS * sum(c in toxicity.LEET for c in text)
    return [()] if stands else [w for w, c in costs.items() if c < least + 1e-9]


DISGUISED = {
    "a$$": "ass", "|oser": "loser", "(lown": "clown", "455": "ass", "@$$": "ass", "4$$": "ass", "1d10t.@u": "idiot", "sstuupid": "stupid", "iddiot": "idiot",
    "1d10t": "idiot", "(lown!!": "clown", "id|ot,": "idiot", "$tup!d$": "stupid", "l0$er": "loser", "s t u p i d": "stupid", "s  t\tu\np i d": "stupid",
}


def test_disguises_reach_the_lattice_and_its_best_path_is_found():
    often = {"ass": 400, "loser": 300, "clown": 200, "idiot": 300, "stupid": 300, "the": 900, "au": 30, "is": 500, "said": 100, "and": 500}
    words = toxicity.Restorer(letter_table(often))
    for hidden, plain in DISGUISED.items():
        parts = words.in_doubt(hidden)
        assert any(plain in words.decode(part) for part in parts), (hidden, parts)
    rng = random.Random(8)
    strings = [part for hidden in DISGUISED for part in words.in_doubt(hidden)]
    strings += ["".join(rng.choice("1dio0t5a$@!|.(-s") for _ in range(rng.randrange(3, 9))) for _ in range(300)]
    strings += ["1999", "$100", "2000", "!!!", "the!!", "the$$$", "(said)", "555-1234", "|".join("aid"), "i1" * 5, "saaaiiidd"]
    for text in strings:
        assert words.decode(text) in cheapest(words.model, text), text
    assert words.all_words("the! (said) is$ 1999 $100") == ["the", "said", "is"]
    long = "i-d-1-0-t-" * 40  # beyond any limit on the length of a word
    assert "".join(words.decode(long)).count("idiot") == 40


def test_doubled_letters_are_restored_if_another_word_is_more_frequent(spark):
    often = ["the idiot said that he is stupid and a clown"] * 30 + ["letter", "an iddiot", "sstuupid"] + ["coffee cofee"] * 3
    docs = spark.createDataFrame([(t,) for t in often], "text string")
    got = {r.part: tuple(r.words) for r in toxicity.restored(docs).collect()}
    assert got == {"iddiot": ("idiot",), "sstuupid": ("stupid",)}
    assert toxicity.Reader().words_with("an iddiot letter", {"iddiot": ["idiot"]}) == ["an", "iddiot", "idiot", "letter"]


def test_long_words_are_counted_by_the_letter_model(spark):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefghij") for _ in range(5_000))
    docs = spark.createDataFrame([(long + " short",)], "text string")
    got = {r.gram: r.n for r in toxicity.letter_counts(toxicity.corpus_words(docs)).collect()}
    assert got == letter_table({long: 1, "short": 1})


def test_digests_that_stand_twice_on_one_side_are_compared_as_they_are():
    pairs = [([5, 5, 7], [7, 9]), ([3, 3], []), ([1, 2], [2, 1]), (list(range(1, 400)), list(range(200, 700))), ([4, 4, 4, 8], [4, 6, 6])]
    found = fingerprints.differences([a for a, _ in pairs], [b for _, b in pairs])
    for (a, b), (only_a, only_b) in zip(pairs, found):
        left, right = Counter(a), Counter(b)
        assert sorted(map(int, only_a)) == sorted((left - right).elements())
        assert sorted(map(int, only_b)) == sorted((right - left).elements())
