"""Toxicity behind disguised spelling: noisy-channel restoring, then scoring of the restored words.

Restoring: a word in leetspeak, of signs alone, with stretched letters or with signs between its letters or at its
ends, and a run of single letters, become a lattice: each sign may stand for the letters it resembles, a repeated
letter may be one letter, a separator or a sign at an end may be nothing or a word's end. A character language model
and the costs of these channels pick the best path by Viterbi search; its states are the last letters, of which a
place has few, and all of them are kept. A plain word with a doubled letter becomes a lattice too if another word of
the corpus differs from it in doubled letters only and is ``RARER`` times as frequent; it is read both as it stands and
as restored. Other plain words have one path, themselves.

The language model counts letter sequences of all words of the corpus: the tokens are counted by a shuffle and
told apart once each, the sequences are counted by another, and all of them stay in a pinned table. Each distinct
disguised string is decoded once: the strings are dealt into groups, the sequences that a group's lattices can
form are joined with that table, and the group is decoded with these counts, which gives the same as all counts
would. The restored strings are joined back to the texts that have them.

Scoring: features are restored words and their beginnings. Features whose share of
toxic texts is beyond chance get a log-odds weight, unless they always follow the same few words, as the
words of a copied text do; a text's score is the logistic of the prior odds and the
weights of its different words. Weights are fitted on at most about ``MAX_LABELLED`` labelled rows.

Defined cases: null, empty and wordless texts score the prior alone; an empty table gives an empty result. Texts and
tokens of any length are read whole; counts of long ones are handed on in parts. Of paths of equal cost the one that
comes first in order of its text wins, so ties give the same words everywhere. Labels of unknown documents and null
labels train nothing; of several labels of a document the greatest holds. Without any label, or of one
kind only, every score is the smoothed prior. Repeated rows score alike. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfold.llm.common import pinned_small, remainder, table
from fleetfold.session import pin

ORDER = 5  # letters per sequence of the language model
GROUP_LETTERS = 20_000  # letters of disguised strings that are decoded together
MAX_LABELLED = 20_000
MIN_CONTEXTS = 4  # different words before a feature in toxic texts,
FREE_SHARE, FREE_CONTEXTS = 0.4, 100  # and at least this share of its uses, or this many
MIN_WEIGHT = 3.0
MIN_EVIDENCE = 16.0  # texts times divergence (in nats) of their toxic share from the prior share: chance is below 1e-6
MOST_SENT_LABELS = 1_000_000
STEMS = (4, 5, 6)  # lengths of the word beginnings that are features
RARER = 8  # a word with doubled letters this many times rarer than its like is taken for a disguise
CACHED_WORDS = 150_000
CACHED_DULL = 400_000  # words without weight that a worker remembers
HELD_COUNTS = 200_000  # distinct strings whose counts a worker holds before it hands them on

# Signs and the letters they are read as.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y",
}
SEPARATORS = " .-_*'~·,"
COST_LEET, COST_DROP, COST_REPEAT = 1.0, 0.7, 0.4
COST_STANDS = 3.3  # of each sign of a string without letters that is no word: one of ten digits, and not leetspeak

_EDGES_LEFT, _EDGES_RIGHT = "\"'*#([{<&%.,;:?-_~|", "\"'*#)]}>&%.,;:?!$-_~|"
# The same ends without signs that may stand for letters.
_PLAIN_LEFT, _PLAIN_RIGHT = ("".join(c for c in edges if c not in LEET) for edges in (_EDGES_LEFT, _EDGES_RIGHT))
_STRETCHED = re.compile(r"(.)\1\1")
_DOUBLED = re.compile(r"(.)\1")
_LETTERS = re.compile(r"[^\W\d_]+")
_FORGETS = 0.4  # factor for each letter of context that the model has to give up


class LetterModel:
    """Log-probability of a letter after others, from counts of sequences; shorter contexts where longer ones are unknown."""

    def __init__(self, counts: dict[str, int], order: int = ORDER, total: int | None = None):
        self.order = order
        self.counts = counts
        self.total = total or sum(n for g, n in counts.items() if len(g) == 1) or 1
        self.known: dict[tuple[str, str], float] = {}

    def cost(self, context: str, letter: str) -> float:
        found = self.known.get((context, letter))
        if found is None:
            found = self._cost(context, letter)
            if len(self.known) > 150_000:
                self.known.clear()
            self.known[context, letter] = found
        return found

    def _cost(self, context: str, letter: str) -> float:
        lost = 0.0
        while context:
            if (n := self.counts.get(context + letter)) and (m := self.counts.get(context)):
                return lost - math.log(min(1.0, n / m))
            lost -= math.log(_FORGETS)
            context = context[1:]
        return lost - math.log((self.counts.get(letter, 0) + 0.5) / (self.total + 1000))


def single_runs(tokens: list[str]) -> list[str]:
    """Runs of three or more tokens of one letter, joined by blanks."""
    lengths = list(map(len, tokens))
    if lengths.count(1) < 3:
        return []
    runs: list[list[str]] = []
    last = -2
    for k, length in enumerate(lengths):
        if length == 1:
            if k > last + 1:
                runs.append([])
            runs[-1].append(tokens[k])
            last = k
    return [" ".join(run) for run in runs if len(run) > 2]


def sequences(word: str, order: int = ORDER) -> Iterator[str]:
    """Letter sequences of a word between its start and end signs."""
    framed = "^" + word + "$"
    for n in range(1, order + 1):
        for k in range(len(framed) - n + 1):
            yield framed[k : k + n]


def _unlinked(made: tuple | None) -> str:
    out = []
    while made:
        made, piece = made
        out.append(piece)
    return "".join(reversed(out))


class Reader:
    """Parts of a text: words that are read as they stand, and disguised strings."""

    def __init__(self):
        self.read: dict[str, tuple[str, ...] | str] = {}

    def _reading(self, token: str) -> tuple[str, ...] | str:
        word = token.lstrip(_PLAIN_LEFT).rstrip(_PLAIN_RIGHT)
        if word.isalpha() and not _STRETCHED.search(word):
            return (word,)
        letters = sum(map(str.isalpha, word))
        signs = sum(c in LEET for c in word)
        if letters + signs < 3:
            return tuple(_LETTERS.findall(word))
        return word

    def reading(self, token: str) -> tuple[str, ...] | str:
        """Words of a token, or the string that has to be decoded."""
        found = self.read.get(token)
        if found is None:
            found = self._reading(token)
            if len(self.read) >= CACHED_WORDS:
                self.read.clear()
            self.read[token] = found
        return found

    def spaced(self, run: str) -> list[str]:
        """String to decode of a run of single letters, none if it repeats one letter."""
        return [] if run == run[:2] * (len(run) // 2) + run[0] else [run]

    def parts(self, text: str | None) -> list[tuple[str, ...] | str]:
        """Words or disguised string of each token in order; those of runs of single letters follow."""
        if not text:
            return []
        tokens = text.lower().split()
        out = [self.reading(token) for token in tokens]
        for run in single_runs(tokens):
            out += self.spaced(run)
        return out

    def disguised(self, text: str | None) -> list[str]:
        """Strings that have to be decoded."""
        return list(dict.fromkeys(p for p in self.parts(text) if isinstance(p, str)))

    def in_doubt(self, text: str | None) -> list[str]:
        """Strings that have to be decoded, and words with doubled letters, which may have to be."""
        parts = dict.fromkeys(p if isinstance(p, str) else p[0] if len(p) == 1 and _DOUBLED.search(p[0]) else None for p in self.parts(text))
        return [p for p in parts if p is not None]

    def words_with(self, text: str | None, meant: dict[str, list[str]]) -> list[str]:
        """Words in order, with what each disguised string stands for; a restored word with doubled letters follows itself."""
        out: list[str] = []
        for part in self.parts(text):
            if isinstance(part, str):
                out += meant.get(part, ())
            else:
                out += part
                if len(part) == 1 and part[0] in meant:
                    out += (w for w in meant[part[0]] if w != part[0])
        return out


class Restorer(Reader):
    """Words of a text as they were meant."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        super().__init__()
        self.model = LetterModel(counts, total=total)

    @staticmethod
    def _inner(text: str) -> tuple[int, int]:
        """Places of the first and last letter or digit: signs outside may be nothing. The whole string if it has no letter."""
        if not any(map(str.isalpha, text)):
            return 0, len(text)
        places = [k for k, c in enumerate(text) if c.isalnum()]
        return places[0], places[-1]

    def _moves(self, text: str, k: int, first: int, last: int) -> list[tuple[str, float]]:
        """What the sign at ``k`` may stand for: letters, nothing, or ``$`` for a word's end; with channel costs."""
        sign = text[k]
        if sign.isalpha():
            moves = [(sign, 0.0)]
            if k and text[k - 1] == sign:
                moves.append(("", COST_REPEAT))
            return moves
        moves = [(letter, COST_LEET) for letter in LEET.get(sign, "")]
        if sign in SEPARATORS:
            moves += [("", COST_DROP if sign != " " else COST_DROP / 2), ("$", 0.0)]
        elif moves and not first <= k <= last:
            moves.append(("$", COST_DROP))
        elif sign in "!|+(":
            moves.append(("$", COST_LEET))
        return moves or [("$", 0.0)]

    def decode(self, text: str) -> tuple[str, ...]:
        """Viterbi search through the lattice of a word or a run of letters; paths are kept as links to the step before.

        A string without letters is a number or the like, and no word, unless a path costs less than that.
        """
        keep = self.model.order - 1
        first, last = self._inner(text)
        paths: dict[str, tuple[float, tuple | None]] = {"^": (0.0, None)}
        for k in range(len(text)):
            after: dict[str, tuple[float, tuple | None]] = {}
            for context, (cost, made) in paths.items():
                for out, channel in self._moves(text, k, first, last):
                    if out == "":
                        state, total, text_so_far = context, cost + channel, made
                    elif out == "$":
                        if context == "^":
                            state, total, text_so_far = context, cost + channel, made
                        else:
                            state, total, text_so_far = "^", cost + channel + self.model.cost(context, "$"), (made, " ")
                    else:
                        total = cost + channel + self.model.cost(context, out)
                        state, text_so_far = (context + out)[-keep:], (made, out)
                    if state not in after or total < after[state][0]:
                        after[state] = (total, text_so_far)
            paths = after
        ends = [(cost + (0 if context == "^" else self.model.cost(context, "$")), made) for context, (cost, made) in paths.items()]
        least = min(cost for cost, _ in ends)
        if not any(map(str.isalpha, text)) and least >= COST_STANDS * sum(c in LEET for c in text):
            return ()
        return tuple(min(_unlinked(made) for cost, made in ends if cost == least).split())

    def sequences_of(self, text: str) -> set[str]:
        """Longest sequences that the lattice of a string can form: the model is asked for these and their ends only."""
        keep = self.model.order - 1
        first, last = self._inner(text)
        states, out = {"^"}, {"^"}
        for k in range(len(text)):
            moves = {out for out, _ in self._moves(text, k, first, last)}
            after = set()
            for context in states:
                for move in moves:
                    if move == "" or (move == "$" and context == "^"):
                        after.add(context)
                        continue
                    out.add(context + move)
                    after.add("^" if move == "$" else (context + move)[-keep:])
            states = after
        return out | {context + "$" for context in states if context != "^"}

    def all_words(self, text: str | None) -> list[str]:
        """Restored words in order; words hidden in runs of single letters follow."""
        return [w for part in self.parts(text) for w in (self.decode(part) if isinstance(part, str) else part)]


def _tallied(counts: Counter):
    import pyarrow as pa

    columns = [pa.array([t for t, _ in counts], pa.string()), pa.array([r for _, r in counts], pa.bool_()), pa.array(list(counts.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["token", "run", "n"])


def _count_tokens(batches: Iterator) -> Iterator:
    """Tokens and runs of single letters with their counts, summed over many texts."""
    reader = Reader()
    tokens: Counter = Counter()
    runs: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                split = text.lower().split()
                tokens.update(split)
                runs.update(part for run in single_runs(split) for part in reader.spaced(run))
                if len(tokens) + len(runs) >= HELD_COUNTS:
                    yield _tallied(Counter({**{(t, False): n for t, n in tokens.items()}, **{(r, True): n for r, n in runs.items()}}))
                    tokens.clear()
                    runs.clear()
    yield _tallied(Counter({**{(t, False): n for t, n in tokens.items()}, **{(r, True): n for r, n in runs.items()}}))


def _words_of_tokens(batches: Iterator) -> Iterator:
    """Words of plain letters and disguised strings of distinct tokens, with the tokens' counts."""
    import pyarrow as pa

    reader = Reader()
    for batch in batches:
        words: Counter = Counter()
        for token, run, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if run:
                words[token, False] += n
                continue
            word = token.strip(_EDGES_RIGHT)
            if word.isalpha():
                words[word, True] += n
                if word == token and not _STRETCHED.search(word):
                    continue
            part = reader._reading(token)
            if isinstance(part, str):
                words[part, False] += n
        columns = [pa.array([w for w, _ in words], pa.string()), pa.array([p for _, p in words], pa.bool_()), pa.array(list(words.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "plain", "n"])


def _count_sequences(batches: Iterator) -> Iterator:
    """Letter sequences with their counts: at each place the longest is counted, and its beginnings when counts are handed on."""
    import pyarrow as pa

    def handed_on():
        every: Counter = Counter()
        for longest, n in counts.items():
            for end in range(1, len(longest) + 1):
                every[longest[:end]] += n
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array(list(every), pa.string()), pa.array(list(every.values()), pa.int64())], names=["gram", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for word, n in zip(*(batch.column(k).to_pylist() for k in range(2))):
            framed = "^" + word + "$"
            for k in range(len(framed)):
                counts[framed[k : k + ORDER]] += n
                if len(counts) >= HELD_COUNTS:
                    yield handed_on()
    yield handed_on()


def corpus_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word``, ``plain`` (else a disguised string) and ``n`` over all texts."""
    tokens = docs.select(F.col(text).alias("text")).mapInArrow(_count_tokens, "token string, run boolean, n long")
    tokens = tokens.groupBy("token", "run").agg(F.sum("n").alias("n"))
    words = tokens.mapInArrow(_words_of_tokens, "word string, plain boolean, n long")
    return pin(words.groupBy("word", "plain").agg(F.sum("n").alias("n")), "words")


def doubled_words(words: DataFrame, rarer: int = RARER) -> DataFrame:
    """Plain words with a doubled letter whose like, doubled letters aside, is at least ``rarer`` times as frequent."""
    plain = words.where("plain").select("word", "n", F.regexp_replace("word", r"(.)\1+", "$1").alias("single"))
    likes = plain.groupBy("single").agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("words")).where("words > 1")
    doubled = plain.where(F.length("word") > F.length("single")).join(likes, "single")
    # Letters stretched threefold are disguised strings already.
    return doubled.where((F.col("n") * rarer <= F.col("most")) & ~F.col("word").rlike(r"(.)\1\1")).select("word")


def letter_counts(words: DataFrame) -> DataFrame:
    """``gram`` and ``n``: counts of all letter sequences over plain words."""
    grams = words.where("plain").select("word", "n").mapInArrow(_count_sequences, "gram string, n long")
    return pin(grams.groupBy("gram").agg(F.sum("n").alias("n")), "letter-counts")


def _wanted_sequences(batches: Iterator) -> Iterator:
    """Group and sequence, distinct per batch, for disguised strings."""
    import pyarrow as pa

    restorer = Restorer({})
    for batch in batches:
        longest: dict[int, set[str]] = {}
        for part, group in zip(*(batch.column(k).to_pylist() for k in range(2))):
            longest.setdefault(group, set()).update(restorer.sequences_of(part))
        for group, some in longest.items():
            ends = list({one[k:] for one in some for k in range(len(one))})
            columns = [pa.array([group] * len(ends), pa.int64()), pa.array(ends, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["group", "gram"])


def _decoded(total: int):
    """Restored words of the disguised strings of a group."""

    def run(parts, counts):
        import pyarrow as pa

        restorer = Restorer(dict(zip(counts.column("gram").to_pylist(), counts.column("n").to_pylist())), total)
        names = parts.column("part").to_pylist()
        return pa.table({"part": pa.array(names, pa.string()), "words": pa.array([list(restorer.decode(p)) for p in names], pa.list_(pa.string()))})

    return run


def restored(docs: DataFrame, text: str = "text") -> DataFrame:
    """``part`` and ``words``: every disguised string of the texts, and the words that it stands for."""
    words = corpus_words(docs, text)
    grams = letter_counts(words)
    total = grams.where(F.length("gram") == 1).agg(F.sum("n")).first()[0] or 1
    parts = words.where(~F.col("plain")).select("word").unionByName(doubled_words(words)).select(F.col("word").alias("part"))
    parts = pin(parts, "parts")
    letters = parts.agg(F.sum(F.length("part"))).first()[0] or 0
    groups = -(-letters // GROUP_LETTERS) or 1
    parts = parts.withColumn("group", F.pmod(F.xxhash64("part"), F.lit(groups)))
    # Sorted by group within a task, so that a batch holds few groups and their common sequences meet.
    dealt = pin(parts.repartition("group").sortWithinPartitions("group"), "disguised")
    wanted = dealt.mapInArrow(_wanted_sequences, "group long, gram string").distinct()
    counts = wanted.join(grams, "gram").select("group", "gram", "n")
    both = dealt.groupBy("group").cogroup(counts.groupBy("group"))
    return pin(both.applyInArrow(_decoded(total), "part string, words array<string>"), "restored")


def _text_key(text: str) -> Column:
    return F.struct(F.xxhash64(text).alias("hash"), F.length(text).alias("length"))


def with_restored(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` (``text`` and others) with ``meant``: the disguised strings of each text and their words."""

    @F.pandas_udf("array<string>")
    def disguised(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader()
        for texts in parts:
            yield pd.Series([reader.in_doubt(t) for t in texts], dtype="object")

    keyed = rows.withColumn("key", _text_key("text"))
    held = keyed.select("key", F.explode(disguised("text")).alias("part")).distinct()
    meant = held.join(known, "part").groupBy("key").agg(F.collect_list(F.struct("part", "words")).alias("meant"))
    return pin(keyed.join(meant, "key", "left").select(*rows.columns, "meant"), "labelled-restored")


def labelled_texts(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """``text`` and ``toxic`` of about ``most`` labelled documents at most, drawn by a hash of the id."""
    known = labels.where(F.col("toxic").isNotNull()).groupBy(F.col("doc_id").alias("of")).agg(F.max("toxic").alias("toxic"))
    known, few = pinned_small(known, "labels", MOST_SENT_LABELS)
    total = known.count()
    if total > most:
        known = known.where(F.pmod(F.xxhash64("of"), F.lit(1 << 20)) < (most << 20) // total)
    rows = docs.join(F.broadcast(known) if few else known, F.col("doc_id") == F.col("of"))
    return pin(rows.select("text", "toxic").repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "labelled")


def features(word: str) -> list[str]:
    return [word, *(f"^{word[:n]}" for n in STEMS if len(word) > n)]


def _meant(pairs: list[dict] | None) -> dict[str, list[str]]:
    return {p["part"]: p["words"] for p in (() if pairs is None else pairs)}


def _feature_counts(batches: Iterator) -> Iterator:
    """Number of texts per feature and label, summed per batch."""
    import pyarrow as pa

    reader = Reader()
    for batch in batches:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic, meant in zip(*(batch.column(k).to_pylist() for k in range(3))):
            words = set(reader.words_with(text, _meant(meant)))
            seen[toxic > 0].update({f for w in words for f in features(w)})
        names = list({**seen[0], **seen[1]})
        columns = [pa.array(names, pa.string()), *(pa.array([s[n] for n in names], pa.int64()) for s in seen)]
        yield pa.RecordBatch.from_arrays(columns, names=["feature", "clean", "toxic"])


def _feature_contexts(wanted: set[str]):
    """Feature, preceding word and number of texts with both, for wanted features in toxic texts."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        reader = Reader()
        for batch in batches:
            pairs: Counter = Counter()
            for text, toxic, meant in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if toxic > 0:
                    words = reader.words_with(text, _meant(meant))
                    pairs.update({(f, b) for b, w in zip(["", *words], words) for f in features(w) if f in wanted})
            columns = list(zip(*pairs)) or [(), ()]
            columns = [*(pa.array(c, pa.string()) for c in columns), pa.array(list(pairs.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["feature", "before", "n"])

    return run


def fit(labelled: DataFrame) -> tuple[float, dict[str, float]]:
    """Prior log-odds and feature weights from ``text``, ``toxic`` and ``meant``."""
    totals = labelled.agg(
        F.count_if(F.col("toxic") > 0).alias("toxic"), F.count_if(F.col("toxic") <= 0).alias("clean")
    ).first()
    n_toxic, n_clean = totals.toxic, totals.clean
    prior = math.log((n_toxic + 0.5) / (n_clean + 0.5)) if n_toxic + n_clean else math.log(0.01)
    prior = max(-4.0, min(-0.5, prior))
    if not n_toxic or not n_clean:
        return prior, {}
    seen = labelled.mapInArrow(_feature_counts, "feature string, clean long, toxic long")
    seen = seen.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= MIN_CONTEXTS)
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    n, base = F.col("toxic") + F.col("clean"), n_toxic / (n_toxic + n_clean)
    share = F.col("toxic") / n
    rest = F.when(F.col("clean") > 0, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    evidence = n * (share * F.log(share / base) + rest)
    strong = seen.withColumn("weight", odds).where((F.col("weight") >= MIN_WEIGHT) & (evidence >= MIN_EVIDENCE))
    # Their number is bounded by the labelled rows: each takes several toxic texts.
    weights = {r.feature: r.weight for r in strong.collect()}
    # A word of a copied passage comes behind the same word again and again; a word in free use does not.
    pairs = labelled.mapInArrow(_feature_contexts(set(weights)), "feature string, before string, n long")
    pairs = pairs.groupBy("feature", "before").agg(F.sum("n").alias("n"))
    varied = pairs.groupBy("feature").agg(F.count(F.lit(1)).alias("contexts"), F.sum("n").alias("uses"))
    free = F.col("contexts") >= F.greatest(F.lit(MIN_CONTEXTS), F.least(F.col("uses") * FREE_SHARE, F.lit(FREE_CONTEXTS)))
    kept = {r.feature for r in varied.where(free).select("feature").collect()}
    weights = {f: w for f, w in weights.items() if f in kept}
    return _calibrated(labelled, prior, weights), weights


def _calibrated(labelled: DataFrame, prior: float, weights: dict[str, float]) -> float:
    """The prior moved to where the fewest labelled texts fall on the wrong side of one half.

    Sums of weights are counted in steps, so a bounded table reaches the driver.
    """
    step = 0.25

    @F.pandas_udf("double")
    def evidence(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        scorer = Scorer(weights)
        for texts, lists in parts:
            yield pd.Series([scorer.evidence(t, _meant(m)) for t, m in zip(texts, lists)], dtype="float64")

    bins = labelled.withColumn("bin", F.floor(evidence("text", "meant") / step))
    rows = bins.groupBy("bin").agg(F.count_if(F.col("toxic") > 0).alias("toxic"), F.count_if(F.col("toxic") <= 0).alias("clean")).collect()
    cuts = [k * step for k in range(2, int(8 / step))]
    wrong = {cut: sum(r.toxic if r.bin * step < cut else r.clean for r in rows) for cut in cuts}
    least = [cut for cut in cuts if wrong[cut] == min(wrong.values())]
    return -least[len(least) // 2]


class Scorer:
    def __init__(self, weights: dict[str, float]):
        self.reader = Reader()
        self.weights = weights
        self.starts = {f[1 : min(STEMS) + 1] for f in weights if f[0] == "^"}
        self.known: dict[str, tuple[tuple[tuple[str, float], ...], str | None]] = {}
        self.dull: set[str] = set()  # tokens without weight that hide nothing

    def word(self, word: str) -> tuple[tuple[str, float], ...]:
        """The heaviest feature of a word, if any."""
        if word not in self.weights and word[: min(STEMS)] not in self.starts:
            return ()
        best = max(((self.weights[f], f) for f in features(word) if f in self.weights), default=None)
        return ((best[1], best[0]),) if best else ()

    def _token(self, token: str) -> tuple[tuple[tuple[str, float], ...], str | None]:
        """Weighted features of a token, and the string that has to be looked up among the restored ones, if any."""
        if token.isalpha() and not _DOUBLED.search(token):
            return self.word(token), None
        part = self.reader._reading(token)
        if isinstance(part, str):
            return (), part
        hits = tuple(p for w in part for p in self.word(w))
        return hits, part[0] if len(part) == 1 and _DOUBLED.search(part[0]) else None

    def hits(self, text: str | None) -> tuple[dict[str, float], list[str]]:
        """Weighted features of the words that are read as they stand, and the strings that may be disguised."""
        hits: dict[str, float] = {}
        hidden: dict[str, None] = {}
        if text:
            tokens = text.lower().split()
            for token in set(tokens) - self.dull:
                found = self.known.get(token)
                if found is None:
                    found = self._token(token)
                    if found == ((), None):
                        if len(self.dull) >= CACHED_DULL:
                            self.dull.clear()
                        self.dull.add(token)
                        continue
                    if len(self.known) >= CACHED_WORDS:
                        self.known.clear()
                    self.known[token] = found
                weighted, part = found
                hits.update(weighted)
                if part is not None:
                    hidden[part] = None
            for run in single_runs(tokens):
                hidden.update(dict.fromkeys(self.reader.spaced(run)))
        return hits, list(hidden)

    def evidence(self, text: str | None, meant: dict[str, list[str]]) -> float:
        """Log-odds of a text, without the prior's."""
        hits, hidden = self.hits(text)
        for part in hidden:
            for word in meant.get(part, ()):
                hits.update(self.word(word))
        return sum(sorted(hits.values()))


_HITS = "array<struct<feature:string,weight:double>>"


def _hits_of(pairs) -> list[dict]:
    return [{"feature": f, "weight": w} for f, w in pairs]


def _telling(weights: dict[str, float]):
    """Disguised strings that have weighted words, with the features of these."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scorer = Scorer(weights)
        kind = pa.list_(pa.struct([("feature", pa.string()), ("weight", pa.float64())]))
        for batch in batches:
            rows = [(p, {f: n for w in words for f, n in scorer.word(w)}) for p, words in zip(*(batch.column(k).to_pylist() for k in range(2)))]
            rows = [(p, _hits_of(found.items())) for p, found in rows if found]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.string()), pa.array([h for _, h in rows], kind)], names=["part", "hits"])

    return run


def _trained(docs: DataFrame, labels: DataFrame) -> tuple[float, dict[str, float], DataFrame]:
    """Prior, weights, and the disguised strings with weighted words."""
    known = restored(docs)
    prior, weights = fit(with_restored(labelled_texts(docs, labels), known))
    return prior, weights, pin(known.mapInArrow(_telling(weights), f"part string, hits {_HITS}"), "telling")


def toxicity(docs: DataFrame, labels: DataFrame, text: Column) -> Column:
    """Score from 0 to 1 of a text column of ``docs``; the language model is learnt from ``docs``, weights from its labelled rows.

    All disguised strings with weighted words go along; for large tables see ``scored``, which joins them.
    """
    prior, weights, telling = _trained(docs, labels)
    meant = {r.part: [(h.feature, h.weight) for h in r.hits] for r in telling.collect()}

    @F.pandas_udf("double")
    def evidence(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(weights)
        for texts in parts:
            out = []
            for hits, hidden in map(scorer.hits, texts):
                for part in hidden:
                    hits.update(meant.get(part, ()))
                out.append(prior + sum(sorted(hits.values())))
            yield pd.Series(out, dtype="float64")

    return 1 / (1 + F.exp(-evidence(text)))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``score`` of every row; texts are read in place, only their disguised strings are joined."""
    prior, weights, telling = _trained(docs, labels)

    @F.pandas_udf(f"hits {_HITS}, hidden array<string>")
    def read(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(weights)
        for texts in parts:
            rows = [scorer.hits(t) for t in texts]
            yield pd.DataFrame({"hits": [_hits_of(h.items()) for h, _ in rows], "hidden": [h for _, h in rows]})

    rows = pin(docs.select("doc_id", _text_key("text").alias("key"), read("text").alias("read")).select("doc_id", "key", "read.*"), "read")
    hidden = rows.select("key", F.explode("hidden").alias("part")).join(telling, "part")
    more = hidden.select("key", F.explode("hits").alias("hit")).groupBy("key").agg(F.collect_set("hit").alias("more"))
    joined = rows.select("doc_id", "key", "hits").join(more, "key", "left")
    hits = F.array_distinct(F.concat("hits", F.coalesce("more", F.array().cast(_HITS))))
    evidence = F.aggregate(F.array_sort(F.transform(hits, lambda h: h["weight"])), F.lit(0.0), lambda a, w: a + w)
    return joined.select("doc_id", (1 / (1 + F.exp(-(F.lit(prior) + evidence)))).alias("score"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; one fold of five is held out of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    labels = labels.where(F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 5) != 0))
    held_out = remainder(F.col("doc_id"), 5) == 0
    return scored(docs, labels).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
