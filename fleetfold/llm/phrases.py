"""Collocations by FM-indexes over word ids, one per shard, with counts summed across shards.

A shard is a run of documents with about ``SHARD_WORDS`` words. Its words become ids, piece ends become the id 0, and the
ids are indexed in both directions: the Burrows-Wheeler transform of the text and of the reversed text, over suffixes in
order of their first ``DEPTH`` words, which is all that phrases of that length need. A phrase is an interval in each; the
symbols before its interval in the one index are its left extensions, those in the other its right extensions, with their
counts, and each extension has its own pair of intervals.

Shards cannot tell by themselves what is frequent in the whole, so counting goes in two steps:

1. Every shard is indexed once and stored, and counts its words and pairs under hashes of ``HASH_BITS``. The sums over all
   shards are a sieve: a phrase that reaches ``least`` always passes, and few others do. Hashes travel sorted, as differences,
   in buckets of the hash range whose number follows the size of the texts, so a bucket fits a task. Each shard gets
   back which of its own passed; the frequent ones are never sent whole.
2. Every shard takes its index up again, extends frequent pairs to the right, then these to the left, as long as all
   pairs inside are in the sieve, and counts the phrases by name. Sums of these are exact.

The rest are joins over the frequent phrases alone: parts of every cut, extensions that hold nearly all occurrences, and
ranks. As a longer candidate around a phrase contains one with just one more word, at least as frequent, extensions
by one word to the left or right decide whether the phrase is dropped.

A frequent phrase is one row per shard in any shuffle. A shard's memory is bounded by its words; only a piece without any
stop inside that is longer than a shard makes a longer one.

Defined cases: null text is empty and has no words; null language counts as ``und``; documents with equal ids or texts all
count; a word may be any run without blanks, also in scripts without blanks; very long texts are cut into shards at piece
ends, which no phrase crosses; equal scores go by count, then by phrase in byte order. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetfold.llm.common import LOWER, UPPER, table
from fleetfold.session import pin

DEPTH = 4  # words of the longest phrase
LEAST = 30
TOP = 2000
COVERED = 80  # percent of a phrase's occurrences inside a longer one that make it redundant
SHARD_WORDS = 1_500_000  # below 2 ** (64 - HASH_BITS)
SHARDS_PER_TASK = 8
HASH_BITS = 40
BUCKET_BYTES = 8 << 20  # text for each bucket of the sieve
CHUNK = 1 << 16  # symbols of an index in one stored row
_ROWS = 1 << 16  # rows of an Arrow batch of counts
_PIECE = 1 << 18  # occurrences that are extended at once

_STOPS = b".,;:!?\n\x0b\x0c\r"  # fixed value: where pieces end
_PLAIN = bytes.maketrans(UPPER.encode() + _STOPS + b"\t", LOWER.encode() + b";" * len(_STOPS) + b" ")
_LANGS, _VOCABULARY, _FORWARD, _BACKWARD, _PASSED, _GRAM, _TOTAL = range(7)
_STORED = "shard long, kind int, part int, blob binary, n long"


def tokens(text: bytes) -> list[bytes]:
    """Words of a lower-cased text, and ``;`` for each end of a piece."""
    return text.translate(_PLAIN).replace(b";", b" ; ").split()


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks from 1."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    ordered[order] = np.cumsum(new)
    return ordered


def transform(text: np.ndarray) -> np.ndarray:
    """The symbol before each suffix, suffixes in order of their first ``DEPTH`` symbols. ``text`` ends with 0."""
    assert DEPTH == 4  # twice two symbols
    keys = text.astype(np.int64)
    keys *= int(text.max(initial=0)) + 1
    keys[:-1] += text[1:]
    pairs = _ranks(keys)
    np.multiply(pairs, len(text) + 2, out=keys)
    keys[:-2] += pairs[2:]
    del pairs
    order = np.argsort(keys)
    order -= 1
    return text[order]


class Side:
    """One direction of the index: counts of symbols within any interval of its transform."""

    def __init__(self, symbols: np.ndarray, width: int):
        self.symbols, self.width = symbols, width
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=width))])  # suffixes with a lesser first symbol
        self._places: np.ndarray | None = None

    def before(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the rows before ``row``."""
        size = len(self.symbols)
        if self._places is None:
            self._places = np.sort(self.symbols.astype(np.int64) * size + np.arange(size))
        return np.searchsorted(self._places, symbol * size + row) - self.first[symbol]


class Phrases:
    """Distinct phrases of one length: their words, and their intervals in both directions."""

    def __init__(self, words: np.ndarray, forward: np.ndarray, backward: np.ndarray, counts: np.ndarray):
        self.words, self.forward, self.backward, self.counts = words, forward, backward, counts

    def where(self, keep: np.ndarray | slice) -> Phrases:
        return Phrases(self.words[keep], self.forward[keep], self.backward[keep], self.counts[keep])

    def pieces(self, size: int = _PIECE) -> Iterator[Phrases]:
        """Consecutive phrases with about ``size`` occurrences together."""
        number = np.cumsum(self.counts) // size
        cuts = [0, *(np.nonzero(np.diff(number))[0] + 1).tolist(), len(number)]
        return (self.where(slice(a, b)) for a, b in zip(cuts, cuts[1:]))

    @staticmethod
    def joined(parts: list[Phrases]) -> Phrases:
        return Phrases(*[np.concatenate([getattr(p, name) for p in parts]) for name in ("words", "forward", "backward", "counts")])


class Index:
    """Both directions over one text of word ids, in which 0 ends a piece."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray, width: int):
        self.forward, self.backward, self.width = Side(forward, width), Side(backward, width), width

    @classmethod
    def of(cls, text: np.ndarray, width: int) -> Index:
        return cls(transform(text), transform(np.concatenate([text[-2::-1], text[-1:]])), width)

    def words(self) -> Phrases:
        symbols = np.arange(1, self.width)
        first, counts = self.forward.first[1:-1], np.diff(self.forward.first)[1:]
        return Phrases(symbols[:, None], first, first, counts).where(counts > 0)

    def extended(self, phrases: Phrases, right: bool, last: bool = False) -> Phrases:
        """All phrases with one word more on one side, with their counts and, unless they are the last, intervals."""
        side = self.backward if right else self.forward
        start, other = (phrases.backward, phrases.forward) if right else (phrases.forward, phrases.backward)
        sizes = phrases.counts
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        rows = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - sizes), sizes)
        keys, counts = np.unique(owner * self.width + side.symbols[rows], return_counts=True)
        owner, symbol = keys // self.width, keys % self.width
        # Inside the other direction's interval the extensions follow each other in order of the new word.
        inside = np.cumsum(counts) - counts - (ends - sizes)[owner]
        word = symbol > 0
        owner, symbol, counts, inside = owner[word], symbol[word], counts[word], inside[word]
        there = other[owner] + inside
        here = there if last else side.first[symbol] + side.before(symbol, start[owner])
        old, new = phrases.words[owner], symbol[:, None]
        if right:
            return Phrases(np.concatenate([old, new], axis=1), there, here, counts)
        return Phrases(np.concatenate([new, old], axis=1), here, there, counts)


def _hashed(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Sieve hashes of words or pairs."""
    full = hashes[words[:, 0]] if words.shape[1] == 1 else pair_hashes(hashes[words[:, 0]], hashes[words[:, 1]])
    return full >> np.uint64(64 - HASH_BITS)


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def pack_numbers(*columns: np.ndarray) -> bytes:
    """Numbers of equal count byte by byte, lowest bytes first, compressed: small ones take little."""
    return zstandard.compress(b"".join(_planes(c) for c in columns), 1)


def unpack_numbers(blob: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(p.T).view("<u8").ravel() for p in planes]


def pack_hashes(hashes: np.ndarray, *columns: np.ndarray) -> bytes:
    """Ascending hashes as differences, with columns beside them."""
    return pack_numbers(np.diff(hashes, prepend=np.uint64(0)), *columns)


def unpack_hashes(blob: bytes, columns: int = 1) -> list[np.ndarray]:
    first, *others = unpack_numbers(blob, columns)
    return [np.cumsum(first, dtype=np.uint64), *others]


def word_hashes(words: list[tuple[int, bytes]], langs: list[str]) -> np.ndarray:
    """One hash per word and language; the first place is for the end of a piece."""
    prefixes = [f"{lang}\t".encode() for lang in langs]
    return np.array([0, *[xxhash.xxh3_64_intdigest(prefixes[k] + word) for k, word in words]], np.uint64)


def pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    # Any odd multipliers and shifts that mix well do; the hashes only sieve.
    with np.errstate(over="ignore"):
        mixed = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def _batch(shard: int, kind: int, blobs: list[bytes], parts: list[int] | None = None, n: list[int] | None = None) -> pa.RecordBatch:
    size = len(blobs)
    arrays = [pa.array([shard] * size, pa.int64()), pa.array([kind] * size, pa.int32()), pa.array(parts or range(size), pa.int32())]
    arrays += [pa.array(blobs, pa.binary()), pa.array(n or [None] * size, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["shard", "kind", "part", "blob", "n"])


def _counted(index: Index, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and pairs of a shard, ascending, and their counts, which share 64 bits while they are sorted."""
    beside = np.uint64(64 - HASH_BITS)
    parts = []
    for piece in index.words().pieces():
        for some in (piece, index.extended(piece, right=True, last=True)):
            parts.append(_hashed(some.words, hashes) << beside | np.minimum(some.counts, (1 << int(beside)) - 1).astype(np.uint64))
    both = np.concatenate(parts)
    del parts
    both.sort()
    found = both >> beside
    starts = np.nonzero(np.concatenate([[True], found[1:] != found[:-1]]))[0]
    both &= np.uint64((1 << int(beside)) - 1)
    return found[starts], np.add.reduceat(both, starts)


def _summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts hashes, where each distinct one starts in it, and their sums."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    starts = np.nonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))[0]
    return order, starts, np.add.reduceat(counts[order], starts)


def _stored(shard: int, text: np.ndarray, words: list[tuple[int, bytes]], langs: list[str], buckets: int) -> Iterator[pa.RecordBatch]:
    """A shard's index, and its counts of words and pairs by hash, a row per bucket of hashes."""
    width = len(words) + 1
    index = Index.of(text, width)
    pack = zstandard.ZstdCompressor(level=1).compress
    yield _batch(shard, _LANGS, [json.dumps(langs).encode()])
    yield _batch(shard, _VOCABULARY, [pack(b"\t".join(b"%d %s" % one for one in words[k : k + CHUNK])) for k in range(0, len(words), CHUNK)])
    for kind, side in ((_FORWARD, index.forward), (_BACKWARD, index.backward)):
        yield _batch(shard, kind, [pack(side.symbols[k : k + CHUNK].tobytes()) for k in range(0, len(text), CHUNK)])
    found, counts = _counted(index, word_hashes(words, langs))
    bucket = (found >> np.uint64(HASH_BITS - buckets.bit_length() + 1)).astype(np.int64)
    cuts = [0, *(np.nonzero(np.diff(bucket))[0] + 1).tolist(), len(bucket)]
    for k in range(0, len(cuts) - 1, 100):
        ends = list(zip(cuts[k:], cuts[k + 1 : k + 101]))
        yield _batch(shard, _GRAM, [pack_hashes(found[a:b], counts[a:b]) for a, b in ends], [int(bucket[a]) for a, _ in ends])
    of_word = np.array([0, *[k for k, _ in words]])
    of_lang = np.bincount(of_word, weights=np.diff(index.forward.first) * (np.arange(width) > 0), minlength=len(langs))
    yield _batch(shard, _TOTAL, [lang.encode() for lang in langs], n=[int(x) for x in of_lang])


def _cut(text: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Stretches of about ``size`` symbols, cut at piece ends."""
    ends = np.nonzero(text == 0)[0] + 1
    at = 0
    while at < len(text):
        if len(text) - at <= 1.25 * size:
            stop = len(text)
        else:
            fitting = np.searchsorted(ends, at + size, side="right")
            stop = int(ends[fitting - 1]) if fitting and ends[fitting - 1] > at else int(ends[fitting])
        yield text[at:stop]
        at = stop


def _index_worker(shard_words: int, buckets: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)
        ids: dict[str, defaultdict] = {}
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            langs = list(ids)
            words: list[tuple[int, bytes]] = [(0, b"")] * sum(len(own) - 1 for own in ids.values())
            for k, own in enumerate(ids.values()):
                for word, number in own.items():
                    if number:
                        words[number - 1] = (k, word)
            whole = np.concatenate(held)
            ids.clear()
            held.clear()
            for text in _cut(whole, shard_words):
                own_words = words
                if len(text) < len(whole):
                    used, text = np.unique(text, return_inverse=True)
                    text, own_words = text.astype(np.int32), [words[k - 1] for k in used.tolist() if k]
                if own_words:
                    yield from _stored(next(numbers), text, own_words, langs, buckets)

        next_id = count(1)
        for batch in batches:
            texts: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():
                if lang not in ids:
                    ids[lang] = defaultdict(next_id.__next__, {b";": 0})
                found = tokens(b";".join(own))
                text = np.fromiter(map(ids[lang].__getitem__, found), np.int32, len(found))
                text = np.append(text, np.int32(0))
                held.append(text[np.concatenate([text[:1] > 0, (text[1:] > 0) | (text[:-1] > 0)])])
            if sum(map(len, held)) >= shard_words:
                yield from flush()
                next_id = count(1)
        yield from flush()

    return work


def _contained(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def frequent_phrases(index: Index, hashes: np.ndarray, passed: np.ndarray) -> Iterator[Phrases]:
    """Phrases of 1 to ``DEPTH`` words whose words and pairs are in the sieve, piece by piece."""
    width = index.width
    single = index.words()
    single = single.where(_contained(passed, _hashed(single.words, hashes)))
    yield single
    known = np.zeros(width, bool)
    known[single.words[:, 0]] = True

    def pair_passes(pairs: np.ndarray) -> np.ndarray:
        keep = known[pairs[:, 1]]
        keep[keep] = _contained(passed, _hashed(pairs[keep], hashes))
        return keep

    some = [index.extended(piece, right=True) for piece in single.pieces()]
    some = [longer.where(pair_passes(longer.words)) for longer in some]
    if not some:
        return
    pairs = Phrases.joined(some)
    yield pairs
    good = np.sort(pairs.words[:, 0] * width + pairs.words[:, 1])
    for longer in pairs.pieces():
        for size in range(3, DEPTH + 1):
            right = size % 2 == 1
            longer = index.extended(longer, right, last=size == DEPTH)
            a, b = (-2, -1) if right else (0, 1)
            longer = longer.where(_contained(good, longer.words[:, a] * width + longer.words[:, b]))
            yield longer


def _named(phrases: Phrases, words: pa.Array, langs: pa.Array) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(phrases.counts), _ROWS):
        part = phrases.words[at : at + _ROWS] - 1
        columns = [words.take(pa.array(part[:, k])) for k in range(part.shape[1])]
        name = columns[0] if len(columns) == 1 else pc.binary_join_element_wise(*columns, pa.scalar(" ", words.type))
        size = pa.array(np.full(len(part), part.shape[1], np.int32))
        arrays = [langs.take(pa.array(part[:, 0])), size, name, pa.array(phrases.counts[at : at + _ROWS].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(arrays, names=["lang", "size", "phrase", "n"])


def _count_worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Takes up each shard's index with the hashes that passed; counts its frequent phrases by name."""
    unpack = zstandard.ZstdDecompressor().decompress
    shard, blobs, passed = None, defaultdict(list), []

    def finish() -> Iterator[pa.RecordBatch]:
        if not passed or not blobs[_FORWARD]:
            return
        langs = json.loads(blobs[_LANGS][0])
        pairs = [one.split(b" ", 1) for blob in blobs[_VOCABULARY] for one in unpack(blob).split(b"\t")]
        words = [(int(k), word) for k, word in pairs]
        sides = [np.concatenate([np.frombuffer(unpack(b), np.int32) for b in blobs[kind]]) for kind in (_FORWARD, _BACKWARD)]
        index = Index(*sides, len(words) + 1)
        names = pa.array([w for _, w in words], pa.binary()).cast(pa.string())
        of_word = pa.array(langs, pa.string()).take(pa.array([k for k, _ in words], pa.int32()))
        sieve = np.sort(np.concatenate(passed))
        for phrases in frequent_phrases(index, word_hashes(words, langs), sieve):
            yield from _named(phrases, names, of_word)

    for batch in batches:
        marks = np.stack([np.asarray(batch.column("shard")), np.asarray(batch.column("kind"))], axis=1)
        cuts = [0, *(np.nonzero((marks[1:] != marks[:-1]).any(axis=1))[0] + 1).tolist(), len(marks)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            own, kind = int(marks[a, 0]), int(marks[a, 1])
            if own != shard:
                yield from finish()
                shard, passed = own, []
                blobs.clear()
            part = batch.slice(a, b - a)
            if kind == _PASSED:
                passed.extend(unpack_hashes(blob)[0] for blob in part.column("blob").to_pylist())
            else:
                blobs[kind] += part.column("blob").to_pylist()
    yield from finish()


def _sieve(least: int):
    """Sums a bucket's counts over all shards and gives each shard those of its hashes that reach ``least``."""

    def work(bucket: pa.Table) -> pa.Table:
        shards = bucket.column("shard").to_pylist()
        parts = [unpack_hashes(blob, 2) for blob in bucket.column("blob").to_pylist()]
        order, starts, sums = _summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        passes = np.empty(len(order), bool)
        passes[order] = np.repeat(sums >= least, np.diff(starts, append=len(order)))
        ends = np.cumsum([len(p[0]) for p in parts])
        own = [p[0][passes[e - len(p[0]) : e]] for p, e in zip(parts, ends)]
        kept = [(shard, pack_hashes(h)) for shard, h in zip(shards, own) if len(h)]
        number = bucket.column("part")[0].as_py()
        arrays = [pa.array([s for s, _ in kept], pa.int64()), pa.array([_PASSED] * len(kept), pa.int32()), pa.array([number] * len(kept), pa.int32())]
        return pa.Table.from_arrays([*arrays, pa.array([b for _, b in kept], pa.binary())], names=["shard", "kind", "part", "blob"])

    return work


def counted_phrases(
    docs: DataFrame, least: int = LEAST, lang: str = "lang", text: str = "text", shard_words: int = SHARD_WORDS
) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``size``, ``phrase``, ``f`` of all phrases of up to ``DEPTH`` words with f >= least; and ``lang``, ``n`` words in all."""
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = 1 << max(4, math.ceil(math.log2(max(1, size / BUCKET_BYTES))))
    stored = pin(texts.mapInArrow(_index_worker(shard_words, buckets), _STORED), "word-indexes")
    totals = stored.where(F.col("kind") == _TOTAL).groupBy(F.decode("blob", "UTF-8").alias("lang")).agg(F.sum("n").alias("n"))
    grams = stored.where(F.col("kind") == _GRAM).select("part", "shard", "blob")
    back = grams.groupBy("part").applyInArrow(_sieve(least), "shard long, kind int, part int, blob binary")
    index = stored.where(F.col("kind") <= _BACKWARD).select("shard", "kind", "part", "blob")
    # Several shards to a task, so that their counts are added up before they are shuffled.
    shards = stored.where(F.col("kind") == _LANGS).count()
    tasks = max(1, math.ceil(shards / SHARDS_PER_TASK), min(shards, docs.sparkSession.sparkContext.defaultParallelism))
    dealt = index.unionByName(back).repartition(tasks, "shard").sortWithinPartitions("shard", "kind", "part")
    named = dealt.mapInArrow(_count_worker, "lang string, size int, phrase string, n long")
    counts = named.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    return pin(counts, "phrase-counts"), totals


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, lang: str = "lang", text: str = "text", shard_words: int = SHARD_WORDS
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a (its count), l and r (of the parts at its weakest cut), n, score."""
    counts, totals = counted_phrases(docs, least, lang, text, shard_words)
    candidates = counts.where(F.col("size") >= 2).select("lang", "size", "phrase", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("words"))

    # Extensions by one word on either side that hold nearly all occurrences.
    ends = [F.slice("words", start, F.col("size") - 1) for start in (1, 2)]
    inner = candidates.where(F.col("size") >= 3).select("lang", "a", F.explode(F.array(*ends)).alias("part"))
    inner = inner.groupBy("lang", F.array_join("part", " ").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = candidates.join(inner, ["lang", "phrase"], "left")
    wide = "decimal(20,0)"
    kept = kept.where(F.col("longer").isNull() | (F.col("longer").cast(wide) * 100 < F.col("a").cast(wide) * covered)).drop("longer")

    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"p1": F.array_join(F.slice("words", 1, F.col("k")), " "), "p2": F.array_join(F.slice("words", F.col("k") + 1, F.col("size")), " ")})
    sides = [counts.select("lang", F.col("phrase").alias(p), F.col("f").alias(c)) for p, c in (("p1", "l"), ("p2", "r"))]
    cuts = reduce(lambda df, side: df.join(side[0], ["lang", side[1]]), zip(sides, ("p1", "p2")), cuts)
    # A quotient of decimals, exact beyond 64 bits; the result is at most half of the factor.
    score = F.expr(f"(CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS {wide})) DIV (CAST(l AS {wide}) + CAST(r AS {wide}))")
    weakest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("w"))
    scored = weakest.select("lang", "phrase", "a", "w.l", "w.r", "w.score")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = scored.withColumn("rank", place).where(F.col("rank") <= top).join(totals, "lang")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of two to four words of each language."""
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def _grams_sql(size: int) -> str:
    return (
        f"SELECT lang, {size} AS size, unnest(list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(w[i:i + {size - 1}], ' '))) AS phrase "
        f"FROM pieces WHERE len(w) >= {size}"
    )


OP13_SQL = f"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents
), cut AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts
), pieces AS (
  SELECT lang, list_filter(string_split(translate(piece, chr(9), ' '), ' '), lambda x: x <> '') AS w FROM cut
), counts AS (
  SELECT lang, size, phrase, count(*) AS f FROM ({" UNION ALL ".join(_grams_sql(k) for k in range(1, DEPTH + 1))}) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2 AND f >= {LEAST}
), kept AS (
  SELECT * FROM candidates AS c WHERE NOT EXISTS (
    SELECT 1 FROM candidates AS d WHERE d.lang = c.lang AND d.size > c.size AND 100 * d.f >= {COVERED} * c.f
      AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS p1, array_to_string(w[k + 1:], ' ') AS p2
  FROM (SELECT *, unnest(range(1, size)) AS k FROM kept)
), scored AS (
  SELECT c.*, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score
  FROM cuts AS c JOIN counts AS x ON x.lang = c.lang AND x.phrase = p1 JOIN counts AS y ON y.lang = c.lang AND y.phrase = p2
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM weakest AS s JOIN totals AS t ON t.lang = s.lang
QUALIFY row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) <= {TOP}
"""
