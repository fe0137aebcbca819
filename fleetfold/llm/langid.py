"""Language identification by rank order of character n-grams.

Each language has a profile: its most frequent n-grams of one to three characters, in order. A document is
compared by its own most frequent n-grams: each adds the number of places by which it is out of place in
the profile, or the whole profile length if it is not there. The language with the least sum wins, ties go
to the name that sorts first.

Defined cases: text that is null, empty or without a letter gives ``und`` and score 0; number signs such as fractions
are no letters. Very long texts are read whole. Rows without a language label train nothing. With no labelled text at
all everything is ``und``. Repeated rows count as often as they come; n-grams of equal count keep the order in which
they first appear. An empty table gives an empty result. Extra columns are neither read nor changed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetfold.llm.common import remainder, table

PROFILE_GRAMS = 400
DOCUMENT_GRAMS = 400
MAX_LANGUAGES = 1_000
UNDETERMINED = "und"
MIN_SIMILARITY = 0.02

_LETTERS = re.compile(r"[^\W\d_]+")  # letters, and signs that count as numbers


def _letters_of(word: str) -> list[str]:
    return "".join(c if c.isalpha() else " " for c in word).split()


def _spaced(text: str | None) -> str:
    """The letters of a text in lower case, each word between single underscores; empty without letters."""
    words = _LETTERS.findall(text.lower()) if text else []
    if not "".join(words).isalpha():
        words = [part for word in words for part in _letters_of(word)]
    return "_" + "_".join(words) + "_" if words else ""


def ranked_grams(text: str | None, most: int) -> list[str]:
    """The most frequent n-grams in falling order of count; ties in order of first appearance."""
    spaced = _spaced(text)
    if not spaced:
        return []
    pairs = list(map(add, spaced, spaced[1:]))
    counts = Counter(spaced)
    counts.update(pairs)
    counts.update(map(add, pairs, spaced[2:]))
    del counts["_"]
    return sorted(counts, key=counts.__getitem__, reverse=True)[:most]


class _Spaced:
    """``_spaced`` as arrays. Letters are numbered in the order in which they are first seen: 1 is the mark between words,
    0 whatever is no letter. The numbers are short, so that several fit one integer."""

    def __init__(self):
        import numpy as np

        self.numbers = np.full(0x110000, -1, dtype=np.int64)
        self.numbers[[0, ord("_")]] = 0, 1
        self.letters = 1

    def __call__(self, text: str | None):
        """Code points, and the numbers of the letters; both empty without letters."""
        import numpy as np

        # The sign in front and the one behind are no letters; of the signs behind a word one stays.
        codes = np.frombuffer(f"\0{text.lower() if text else ''}\0".encode("utf-32-le"), dtype="<u4").astype(np.int64)
        codes[codes == ord("_")] = 0
        numbers = self.numbers[codes]
        if numbers.min() < 0:
            for code in sorted(set(codes[numbers < 0].tolist())):
                if chr(code).isalpha():
                    self.letters += 1
                self.numbers[code] = self.letters if chr(code).isalpha() else 0
            numbers = self.numbers[codes]
        letter = numbers > 0
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] = letter.any()
        codes, letter = codes[keep], letter[keep]
        codes[~letter] = ord("_")
        return codes, self.numbers[codes]


def _packed(gram: str) -> int:
    """An n-gram of up to three characters as one integer."""
    return sum(ord(c) << 21 * (2 - i) for i, c in enumerate(gram))


def _ranked_codes(codes, numbers, letters: int, most: int):
    """What ``ranked_grams`` gives, as packed integers: each n-gram goes with its place through one sort.

    None where the integers are too short for that, with very many letters in a very long text.
    """
    import numpy as np

    length = len(codes)
    bits, place_bits = letters.bit_length(), length.bit_length()
    if 3 * bits + place_bits > 63 or 2 * place_bits + 2 > 63:
        return None
    place, mark = np.arange(length), 1 << 2 * bits
    packed = numbers << 2 * bits
    grams = [packed]
    for n in (1, 2):
        packed = packed[:-1] | (numbers[n:] << (2 - n) * bits)
        grams.append(packed)
    keys = np.concatenate([(g << place_bits) | place[: len(g)] for g in grams])
    keys.sort()
    grams = keys >> place_bits
    starts = np.concatenate([[0], np.flatnonzero(grams[1:] != grams[:-1]) + 1])
    counts = np.diff(starts, append=len(keys))
    grams, first = grams[starts], keys[starts] & ((1 << place_bits) - 1)
    size = 1 + ((grams & (mark - 1)) > 0) + ((grams & ((1 << bits) - 1)) > 0)
    order = ((length - counts) << place_bits + 2) | (size << place_bits) | first
    order = order[grams != mark]
    if len(order) > most:
        order.partition(most - 1)
        order = order[:most]
    order.sort()
    first, size = order & ((1 << place_bits) - 1), (order >> place_bits) & 3
    padded = np.concatenate([codes, [0, 0]])
    whole = (padded[first] << 42) | (padded[first + 1] << 21) | padded[first + 2]
    return (whole >> 21 * (3 - size)) << 21 * (3 - size)


def _count_grams(batches: Iterator) -> Iterator:
    """Counts of n-grams per language, summed per batch with sorted integer codes (21 bits a character)."""
    import numpy as np
    import pyarrow as pa

    spaced, end = _Spaced(), np.array([ord("\n")])
    for batch in batches:
        texts: dict[str, list] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes, _ = spaced(text)
            if len(codes):
                texts.setdefault(lang, []).extend((codes, end))
        for lang, parts in texts.items():
            codes = np.concatenate(parts)
            grams, counts = [], []
            packed = codes
            for n in (1, 2, 3):
                if n > 1:
                    packed = (packed[:-1] << 21) | codes[n - 1 :]
                unique, times = np.unique(packed, return_counts=True)
                for code, k in zip(unique.tolist(), times.tolist()):
                    gram = "".join(chr((code >> 21 * i) & 0x1FFFFF) for i in range(n - 1, -1, -1))
                    if "\n" not in gram and gram != "_":
                        grams.append(gram)
                        counts.append(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(counts, pa.int64())],
                names=["lang", "gram", "n"],
            )


def learn_profiles(docs: DataFrame, lang: str = "lang", text: str = "text", grams: int = PROFILE_GRAMS) -> dict[str, list[str]]:
    """Ranked n-grams per language over all given rows with a language.

    What reaches the driver is at most ``grams`` rows for each of at most ``MAX_LANGUAGES`` languages.
    """
    labelled = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = labelled.mapInArrow(_count_grams, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("place", place).where(F.col("place") <= grams)
    rows = best.select("lang", "place", "gram").limit(grams * MAX_LANGUAGES + 1).collect()
    profiles: dict[str, list[str]] = {}
    for row in sorted(rows):
        profiles.setdefault(row.lang, []).append(row.gram)
    if len(profiles) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; is {lang!r} a language column?")
    return profiles


class RankOrder:
    """Out-of-place distances of a text to every profile."""

    def __init__(self, profiles: dict[str, list[str]], grams: int = DOCUMENT_GRAMS):
        import numpy as np

        self.names = sorted(profiles)
        self.grams = grams
        self.worst = max((len(p) for p in profiles.values()), default=1)
        known = sorted({_packed(g) for p in profiles.values() for g in p})
        self.known = np.array([*known, 2**63 - 1], dtype=np.int64)  # an end that is no n-gram
        index = {g: i for i, g in enumerate(known)}
        # The last line of the table stands for n-grams that no profile has.
        self.places = np.full((len(known) + 1, len(self.names)), -1, dtype=np.int32)
        for k, name in enumerate(self.names):
            for place, gram in enumerate(profiles[name]):
                self.places[index[_packed(gram)], k] = place
        self.spaced = _Spaced()

    def _ranked(self, text: str | None):
        """The n-grams of a text in the order of ``ranked_grams``, packed."""
        import numpy as np

        codes, numbers = self.spaced(text)
        if not len(codes):
            return codes
        ranked = _ranked_codes(codes, numbers, self.spaced.letters, self.grams)
        return np.array([_packed(g) for g in ranked_grams(text, self.grams)], dtype=np.int64) if ranked is None else ranked

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language; confidence (lead over the second best); similarity to the winner. All scores from 0 to 1."""
        import numpy as np

        ranked = self._ranked(text)
        if not len(ranked) or not self.names:
            return UNDETERMINED, 0.0, 0.0
        at = np.searchsorted(self.known, ranked)
        at[self.known[at] != ranked] = -1
        places = self.places[at]
        out = np.abs(places - np.arange(len(ranked), dtype=np.int32)[:, None])
        distance = np.where(places < 0, self.worst, np.minimum(out, self.worst)).sum(axis=0)
        order = np.argsort(distance, kind="stable")
        similarity = 1 - float(distance[order[0]]) / (self.worst * len(ranked))
        if len(order) == 1:
            return self.names[order[0]], similarity, similarity
        first, second = float(distance[order[0]]), float(distance[order[1]])
        return self.names[order[0]], 0.5 + 0.5 * (second - first) / second if second else 0.5, similarity


def language(profiles: dict[str, list[str]], text: Column) -> Column:
    """Struct of ``lang_pred``, ``score`` and ``similarity`` for a text column."""

    @F.pandas_udf("lang_pred string, score double, similarity double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = RankOrder(profiles)
        for texts in parts:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score", "similarity"])

    return predict(text)


def identify(docs: DataFrame, train: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """All columns of ``docs`` and a struct ``__language`` (lang_pred, score, similarity) learnt from ``train``."""
    return docs.withColumn("__language", language(learn_profiles(train, lang, text), F.col(text)))


def keep_identified(docs: DataFrame, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """Drop documents without a language: no letter in the text, or hardly an n-gram in common with any profile.

    Profiles come from the labelled rows of ``docs`` itself. The label of a row is no input of its own decision.
    """
    found = identify(docs, _training_rows(docs))
    kept = (F.col("__language.lang_pred") != UNDETERMINED) & (F.col("__language.similarity") >= min_similarity)
    return found.where(kept).select(*docs.columns)


def _training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(remainder(F.col("doc_id"), 3) != 1)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; one fold of three is held out of the profiles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, _training_rows(docs))
    return found.select(
        "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "__language.lang_pred", "__language.score", "__language.similarity"
    )
