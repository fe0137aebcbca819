"""Repeated passages by runs of consecutive sentences.

A text is cut behind sentence ends, line ends and the stops within sentences, so that a passage pasted into the
middle of a sentence still shares its later parts. A long stretch without a stop is cut behind words picked by
their checksum, so equal stretches are cut alike wherever they begin; in scripts without blanks it is cut behind
characters, by the checksum of the last few, and ``UNSPACED`` characters count as a word. From each part on, the shortest run of at least
``MIN_PARTS`` consecutive parts with ``MIN_WORDS`` words is hashed (128 bits, without case and blanks). Runs
that occur more than once anywhere are joined with their places; the first place by id and position
stays, the parts that any other place covers go. Every stretch of parts with enough words is covered by such
runs, so a repeated passage goes whole, up to the parts it shares with its surroundings.

The runs are dealt by hash twice: narrow rows to count them, and once more to keep those that repeat.
The hash counts are combined before the shuffle, and the join is one that adaptive execution can split, so
a run that a third of all documents have is no bottleneck. Texts move only if many of them change.

Defined cases: null text stays null, empty text empty; a text may lose all its parts; rows with equal id and equal
text are one document, and all of them stay as the first of them does; ties of id go by text hash; null ids come first;
other columns are kept unread.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfold.llm.common import table
from fleetfold.session import pin

MIN_PARTS = 2
MIN_WORDS = 20
LONG_PART = 12  # words from which a part is cut further,
ONE_IN = 8  # behind one word in so many
UNSPACED = 2  # characters of a script without blanks that count as a word
GRAM = 3  # such characters whose checksum decides on a cut,
ONE_CHARACTER_IN = 16  # behind one in so many
# Cut behind stops and line ends, with the blanks that follow; the parts add up to the text.
_STOPS = ".!?;:,\n。｡！？；：，、､．…।॥؟؛،۔።፣።་།။၊។"
_PART = re.compile(rf"[^{_STOPS}]*[{_STOPS}][{_STOPS}\s]*|[^{_STOPS}]+")
_WORD = re.compile(r"\s*\S+\s*|\s+")
# Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han
_UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_RUN = "doc_id long, hash long, run binary, start int, end int"


def _size(words: list[str], unspaced: bool) -> int:
    """Number of words; those of scripts without blanks by their characters."""
    if not unspaced:
        return len(words)
    return sum(max(1, len(_UNSPACED.findall(w)) // UNSPACED) for w in words)


def _cuts(word: str) -> Iterator[int]:
    """Places to cut a stretch without blanks at."""
    for k in range(GRAM, len(word) + 1):
        gram = word[k - GRAM : k]
        if _UNSPACED.match(gram[-1]) and zlib.crc32(gram.lower().encode("utf-8", "surrogatepass")) % ONE_CHARACTER_IN == 0:
            yield k


def parts_of(text: str) -> list[str]:
    out = []
    unspaced = _UNSPACED.search(text) is not None
    for part in _PART.findall(text):
        if _size(part.split(), unspaced) < LONG_PART:
            out.append(part)
            continue
        begin = at = 0
        for word in _WORD.findall(part):
            if unspaced:
                for cut in _cuts(word):
                    out.append(part[begin : at + cut])
                    begin = at + cut
            at += len(word)
            if begin < at and zlib.crc32(word.strip().encode()) % ONE_IN == 0:
                out.append(part[begin:at])
                begin = at
        if begin < len(part):
            out.append(part[begin:])
    return out


def runs_of(text: str, min_parts: int = MIN_PARTS, min_words: int = MIN_WORDS) -> list[tuple[bytes, int, int]]:
    """Digest, first character and end of the shortest long-enough run from each part on."""
    import xxhash

    parts = parts_of(text)
    words = [p.lower().split() for p in parts]
    unspaced = _UNSPACED.search(text) is not None
    sizes = [_size(some, unspaced) for some in words]
    ends, at = [], 0
    for part in parts:
        at += len(part)
        ends.append(at)
    out = []
    stop, held = 0, 0  # parts before ``stop`` are in the run, with ``held`` words
    for k in range(len(parts)):
        while stop < len(parts) and (stop - k < min_parts or held < min_words):
            held += sizes[stop]
            stop += 1
        if stop - k < min_parts or held < min_words:
            break
        joined = " ".join([w for some in words[k:stop] for w in some])
        out.append((xxhash.xxh3_128_digest(joined), ends[k] - len(parts[k]), ends[stop - 1]))
        held -= sizes[k]
    return out


def _runs(min_parts: int, min_words: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32()]
        names = ["doc_id", "hash", "run", "start", "end"]
        for batch in batches:
            rows = batch.to_pylist()
            out = [(r["doc_id"], r["hash"], *one) for r in rows if r["text"] for one in runs_of(r["text"], min_parts, min_words)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 5, kinds)], names=names)

    return run


def repeated_spans(docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_parts: int = MIN_PARTS, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``hash`` (of the text) and ``spans`` (start, end in characters) of non-first repeated runs, per document that has any."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    runs = rows.mapInArrow(_runs(min_parts, min_words), _RUN)
    often = pin(runs.groupBy("run").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("run"), "repeated-runs")
    places = pin(runs.join(often, "run"), "run-places")
    place = F.struct("doc_id", "hash", "start")
    first = pin(places.groupBy("run").agg(F.min(place).alias("first")), "first-places")
    later = places.join(first, "run").where(~F.col("first").eqNullSafe(place))
    return later.groupBy("doc_id", "hash").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))


def drop_repeated(docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_parts: int = MIN_PARTS, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the covered parts of ``text``; ``__removed`` has the merged spans (null if none)."""
    spans = pin(repeated_spans(docs, id_column, text, min_parts, min_words), "spans")
    side = spans.withColumnsRenamed({"doc_id": "__id", "hash": "__hash", "spans": "__spans"})
    same = F.col(id_column).cast("long").eqNullSafe(F.col("__id")) & F.xxhash64(text).eqNullSafe(F.col("__hash"))
    joined = docs.join(side, same, "left")
    # Only texts that change go through Python.
    cut = _without(F.when(F.col("__spans").isNotNull(), F.col(text)), F.col("__spans"))
    changed = joined.withColumn("__cut", cut)
    kept = F.when(F.col("__spans").isNotNull(), F.col("__cut.kept")).otherwise(F.col(text))
    return changed.withColumn("__removed", F.col("__cut.removed")).withColumn(text, kept).select(*docs.columns, "__removed")


def merged(spans) -> list[tuple[int, int]]:
    """Union of spans that are sorted by start."""
    out: list[list[int]] = []
    for span in spans:
        start, end = (span["start"], span["end"]) if isinstance(span, dict) else span
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _without(text, spans):
    @F.pandas_udf("kept string, removed array<struct<start:int,end:int>>")
    def run(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        kept, removed = [], []
        for one, some in zip(texts, lists):
            if some is None:
                kept.append(None)
                removed.append(None)
                continue
            union = merged(some)
            parts, at = [], 0
            for start, end in union:
                parts.append(one[at:start])
                at = end
            kept.append("".join(parts) + one[at:])
            removed.append([{"start": a, "end": b} for a, b in union])
        return pd.DataFrame({"kept": kept, "removed": removed})

    return run(text, spans)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the repeated passages that others had first."""
    cleaned = drop_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.array_join(F.transform("__removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    chars = F.aggregate("__removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cleaned.select(
        "doc_id",
        F.coalesce(F.size("__removed").cast("long"), F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce(chars, F.lit(0).cast("long")).alias("removed_chars"),
        F.coalesce(spans, F.lit("")).alias("removed_spans"),
        "text",
    )
