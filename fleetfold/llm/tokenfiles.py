"""Token ids in files: frequency ranks in a byte-aligned variable-length code.

Ids are replaced by their rank of frequency, so that common ids need one byte. Values are coded with one to
four data bytes each; their lengths stand apart in control bytes, two bits a value, four values to a byte
(the first in the lowest bits). Decoding looks up lengths per control byte in a table, sums them to
offsets, and reads all values with one strided gather.

Format: a folder with two Parquet tables that Spark writes, so they commit as a whole on any store.
``ranks`` holds the dictionary (``rank``, ``id``). ``blocks`` holds blocks of whole documents in ascending id order:
``shard`` (in order), ``first`` (ids of the shard before the block), ``doc_ids``, ``lengths``, ``n_ids``, ``control``, ``data``.

Defined cases: null text counts as empty and gives the end id alone; null ids come first; rows with equal
ids are ordered by their tokens, so repeated rows stand side by side; an empty table gives empty files; only the
id and text columns are read.
"""

from __future__ import annotations

import functools
import json
import sys
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfold.llm.common import pinned_small, table
from fleetfold.plans.ordered import with_running
from fleetfold.session import scratch

END_ID = 1
BLOCK_IDS = 1 << 16  # a block closes with the document that fills it
SHARD_IDS = 1 << 22  # ids that one writing task should get
MOST_SENT_ROWS = 1_000_000  # shards whose starts are sent to every task
CACHED_WORDS, CACHED_PIECES = 800_000, 400_000  # in each of two generations
# The normaliser and the split pattern that allow words to be encoded one by one.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_STOPS = (".", ",", ";", ":", "!", "?")
_BLOCK = "shard int, first long, doc_ids array<long>, lengths array<long>, n_ids long, control binary, data binary"


class _Bounded(dict):
    """A dict that computes what it lacks. When full it starts afresh, but takes over what is asked for again."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most, self.before = compute, most, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordEncoder:
    """Ids of a text by the tokenizers library, with the ids of each blank-separated word kept."""

    def __init__(self, path: str):
        import numpy as np
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.by_word = steps == _NORMALIZERS and pre[0].get("pattern", {}).get("Regex") == _SPLIT
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.signs = {s[0] for s in self.specials}  # a text without them has no special token
        self.by_word &= not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in spec["added_tokens"])
        top = max([self.tokenizer.get_vocab_size(), END_ID + 1, *(t["id"] + 1 for t in spec["added_tokens"])])
        self.dtype = np.dtype("<u2") if top <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.model = self.tokenizer.model
        self.pattern = regex.compile(_SPLIT)
        printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        rest = [b for b in range(256) if b not in set(printable)]
        self.letter = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.words = _Bounded(self._word, CACHED_WORDS)
        self.pieces = _Bounded(self._piece, CACHED_PIECES)

    def _bytes(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _piece(self, piece: str) -> bytes:
        named = piece if piece.isascii() else "".join(map(self.letter.__getitem__, piece.encode()))
        return self._bytes([t.id for t in self.model.tokenize(named)])

    def _whole(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        # Printable Latin-1 is lower-cased letter by letter and is its own normal form; the rest takes the long way.
        if (word.isascii() or max(word) < "Ā") and word.isprintable() and not any(s in word for s in self.signs):
            word = word.lower()
            if word.isalpha():
                return self.pieces[word]
            if word[-1:] in _STOPS and word[:-1].isalpha():
                return self.pieces[word[:-1]] + self.pieces[word[-1]]
            return b"".join(map(self.pieces.__getitem__, self.pattern.findall(word)))
        return self._whole(word)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian integers of ``dtype``."""
        if not text:
            return b""
        if not self.by_word:
            return self._whole(text)
        if not any(s in text for s in self.signs) and _is_latin(text):
            text = text.lower()  # fewer words to know
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


@functools.cache
def encoder(path: str) -> WordEncoder:
    """One per Python worker."""
    return WordEncoder(path)


def pack(values) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    import numpy as np

    values = np.ascontiguousarray(values, dtype="<u4")
    size = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    codes[: len(values)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) < size[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[used].tobytes()


@functools.cache
def _tables():
    """Lengths of the four values per control byte, and the mask per length."""
    import numpy as np

    lengths = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.int64)
    masks = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)
    return lengths, masks


def unpack(control: bytes, data: bytes, count: int):
    """The values that ``pack`` coded."""
    import numpy as np

    lengths, masks = _tables()
    size = lengths[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:count]
    offsets = np.cumsum(size) - size
    padded = np.frombuffer(data + b"\0\0\0\0", dtype=np.uint8)
    words = np.ndarray((len(padded) - 3,), dtype="<u4", buffer=padded, strides=(1,))
    return words[offsets] & masks[size]


def encode_ids(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """``doc_id``, ``n`` and ``ids`` (little-endian integers, two or four bytes by vocabulary) with the end id."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        model = encoder(path)
        end = np.array([end_id], dtype=model.dtype).tobytes()
        for batch in batches:
            coded = [model.encode(t) + end for t in batch.column(1).to_pylist()]
            counts = pa.array([len(c) // model.dtype.itemsize for c in coded], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts, pa.array(coded, pa.binary())], names=["doc_id", "n", "ids"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, ids binary")


def _count_ids(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    totals = np.zeros(0, dtype=np.int64)
    for batch in batches:
        joined = b"".join(batch.column("ids").to_pylist())
        width = len(joined) // max(1, sum(batch.column("n").to_pylist())) or 2
        seen = np.bincount(np.frombuffer(joined, dtype=f"<u{width}"))
        if len(seen) > len(totals):
            totals = np.pad(totals, (0, len(seen) - len(totals)))
        totals[: len(seen)] += seen
    ids = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), pa.array(totals[ids])], names=["id", "n"])


def _write_blocks(rank_of: bytes, block_ids: int):
    """Blocks of one sorted partition, closed as soon as they are full."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        rank = np.frombuffer(rank_of, dtype="<u4")
        shard = TaskContext.get().partitionId()
        held: list[tuple] = []
        size = first = 0

        def block():
            width = len(held[0][2]) // held[0][1]
            values = rank[np.frombuffer(b"".join(h[2] for h in held), dtype=f"<u{width}")]
            control, data = pack(values)
            row = [shard, first, [h[0] for h in held], [h[1] for h in held], size, control, data]
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary()]
            names = ["shard", "first", "doc_ids", "lengths", "n_ids", "control", "data"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            for doc_id, n, ids in zip(*(batch.column(k).to_pylist() for k in range(3))):
                held.append((doc_id, n, ids))
                size += n
                if size >= block_ids:
                    yield block()
                    first += size
                    held, size = [], 0
        if held:
            yield block()

    return run


def write_tokens(docs: DataFrame, tokenizer: str, out: str, id_column: str = "doc_id", text: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Encode the texts and write ``ranks`` and ``blocks`` below ``out``."""
    spark = docs.sparkSession
    staged = scratch(spark, "token-ids")
    encode_ids(docs, tokenizer, id_column, text).write.option("compression", "zstd").parquet(staged)
    coded = spark.read.parquet(staged)
    # At most one row per id of the vocabulary reaches the driver.
    counts = coded.select("n", "ids").mapInArrow(_count_ids, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ranked = [r.id for r in sorted(counts.collect(), key=lambda r: (-r.n, r.id))]
    total = coded.agg(F.sum("n")).first()[0] or 0
    spark.createDataFrame(list(enumerate(ranked)), "rank int, id int").coalesce(1).write.parquet(f"{out}/ranks")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_IDS))
    order = ["doc_id", "n", F.xxhash64("ids")]
    ordered = coded.repartitionByRange(parts, *order).sortWithinPartitions(*order, "ids")
    ordered.mapInArrow(_write_blocks(_inverse(ranked), block_ids), _BLOCK).write.parquet(f"{out}/blocks")


def _inverse(ranked: list[int]) -> bytes:
    """Rank of each id, as little-endian 32-bit integers."""
    import numpy as np

    rank = np.zeros(max(ranked, default=0) + 1, dtype="<u4")
    rank[np.array(ranked, dtype=np.int64)] = np.arange(len(ranked), dtype="<u4")
    return rank.tobytes()


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids before the document) and ``ids`` (little-endian unsigned 32-bit integers), from the files."""
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    ranks = spark.read.schema("rank int, id int").parquet(f"{path}/ranks").orderBy("rank").collect()  # the vocabulary at most
    table_of = b"".join(r.id.to_bytes(4, "little") for r in ranks)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = with_running(totals, [], ["shard"], {"so_far": ("sum", "n")}).select("shard", (F.col("so_far") - F.col("n")).alias("before"))
    before, few = pinned_small(before, "shard-starts", MOST_SENT_ROWS)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        id_of = np.frombuffer(table_of, dtype="<u4")
        for batch in batches:
            for row in batch.to_pylist():
                ids = id_of[unpack(row["control"], row["data"], row["n_ids"])].astype("<u4").tobytes()
                ends = np.cumsum(np.array(row["lengths"], dtype=np.int64))
                begins = ends - row["lengths"]
                parts = [ids[4 * b : 4 * e] for b, e in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(begins + row["before"] + row["first"], pa.int64()), pa.array(parts, pa.binary())],
                    names=["doc_id", "start", "ids"],
                )

    return blocks.join(F.broadcast(before) if few else before, "shard").mapInArrow(run, "doc_id long, start long, ids binary")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as token files and read back."""
    import public_tokenizers

    out = scratch(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), out)
    back = read_tokens(spark, out)
    return back.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
