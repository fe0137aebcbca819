"""Byte-level BPE by tree concatenation.

Text of ordinary length is encoded where it lies. Longer text is cut into leaves that go to different
tasks. A cut between two pre-tokens needs no care. A single pre-token that is longer than a leaf (digits,
punctuation, or a script without spaces) is halved wherever the halves fall; after encoding, neighbours
are joined pairwise, level by level: a window of tokens around the join is encoded anew and grows until
its first token is the one that the left side had there and its last token the one of the right side.
Then every two neighbouring tokens come from one correct encoding, and a BPE encoding is correct if all
its neighbouring pairs are, so the joined ids are those of the whole text.

Defined cases: null text counts as empty: no ids, empty text back. Special tokens written out in a text
become their ids, as in the tokenizers library. Rows that repeat (same id, same text) each keep their row.
Only the id and text columns are read.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfold.llm.common import row_key, table

# Fixed value: the published pre-token pattern of this family of vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF_CHARS = 16_384
HALF_CHARS = 2_048  # parts of a single long pre-token
_SCHEMA = "id long, ids array<int>, decoded string"


class ByteBpe:
    """A byte-level BPE vocabulary file with the pieces that the join needs."""

    def __init__(self, path: str):
        import regex
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"]:
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has special tokens that take in their surroundings")
        byte_of = _byte_alphabet()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in merges]
        if made != sorted(made):
            raise ValueError(f"ids of {path} are not in the order of its merges")
        self.special = special
        self.encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.pattern = regex.compile(PATTERN)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode(text, allowed_special="all")

    def encode_run(self, piece: bytes) -> list[int]:
        """Merge bytes that belong to one pre-token."""
        return self.encoding._encode_single_piece(piece) if piece else []

    def bytes_of(self, ids) -> bytes:
        return self.encoding.decode_bytes(ids)

    def decode(self, ids) -> str:
        return self.bytes_of(ids).decode("utf-8", errors="replace")

    def leaves(self, text: str, leaf_chars: int = LEAF_CHARS, half_chars: int = HALF_CHARS) -> Iterator[tuple[str, int]]:
        """Cut a text into (part, kind): kind 0 is whole pre-tokens, 1 the first part of a long one, 2 its later parts."""
        for section in self.split_special.split(text) if self.split_special else [text]:
            if section in self.special:
                yield section, 0
                continue
            begin = end = 0
            blanks: list[tuple[int, int]] = []  # pre-tokens of blanks right before ``end``
            for match in self.pattern.finditer(section):
                start, end = match.span()
                long = end - start > half_chars * 2
                # Cut before a blank that follows a non-blank: there any regex engine ends a pre-token.
                clear = section[start] in " \n" and start > 0 and not section[start - 1].isspace()
                if long or start - begin > leaf_chars and clear or start - begin > 4 * leaf_chars:
                    yield from _closed(section, begin, start, blanks)
                    begin, blanks = start, []
                if long:
                    for n, (a, b) in enumerate(_halves(start, end, half_chars)):
                        yield section[a:b], 2 if n else 1
                    begin = end
                elif match.group().isspace():
                    blanks.append((start, end))
                else:
                    blanks = []
            if end > begin:
                yield section[begin:end], 0

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of two neighbouring parts of one pre-token, from the ids of each."""
        if not left or not right:
            return left + right
        reach = 2
        while True:
            a, b = min(reach, len(left)), min(reach, len(right))
            window = self.encode_run(self.bytes_of(left[-a:] + right[:b]))
            left_agrees = a == len(left) or window[0] == left[-a]
            right_agrees = b == len(right) or window[-1] == right[b - 1]
            if left_agrees and right_agrees:
                return left[: len(left) - a] + window + right[b:]
            reach *= 2

    def join_tree(self, parts: list[tuple[list[int], int]]) -> list[int]:
        """Ids of a whole text from the ids and kinds of its leaves, in order."""
        out: list[int] = []
        k = 0
        while k < len(parts):
            end = k + 1
            while end < len(parts) and parts[end][1] == 2:
                end += 1
            level = [ids for ids, _ in parts[k:end]]  # one leaf, or all parts of one long pre-token
            while len(level) > 1:
                above = [self.join(level[i], level[i + 1]) for i in range(0, len(level) - 1, 2)]
                level = above + level[len(above) * 2 :]
            out += level[0]
            k = end
        return out


def _closed(section: str, begin: int, end: int, blanks: list[tuple[int, int]]) -> Iterator[tuple[str, int]]:
    """Whole pre-tokens up to a cut. Blanks at its end are parted by what follows them, so they are named one by one."""
    text_end = blanks[0][0] if blanks else end
    if text_end > begin:
        yield section[begin:text_end], 0
    for a, b in blanks:
        yield section[a:b], 1


def _halves(start: int, end: int, most: int) -> Iterator[tuple[int, int]]:
    if end - start <= most:
        yield start, end
        return
    middle = (start + end) // 2
    yield from _halves(start, middle, most)
    yield from _halves(middle, end, most)


def _byte_alphabet() -> dict[str, int]:
    """The published one-character names of the 256 bytes: printable ones name themselves, the rest follow from 256 up."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@functools.cache
def vocabulary(path: str) -> ByteBpe:
    """One vocabulary per Python worker."""
    return ByteBpe(path)


def _lists(pa, np, arrays: list):
    """An Arrow list column of integer arrays."""
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate([np.asarray(a, dtype=np.int32) for a in arrays]) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``id``, ``ids`` and ``decoded`` (the text that the ids stand for) of every row."""
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    long_text = F.length("text") > leaf_chars
    short = rows.where(~long_text).mapInArrow(_encode_short(path), _SCHEMA)
    leaves = rows.where(long_text).select("text", row_key(F.col("id"), F.col("text")).alias("key")).select("key.*", "text")
    leaves = leaves.mapInArrow(_cut(path, leaf_chars), "id long, hash long, length long, leaf int, kind int, part string")
    spread = leaves.repartition("id", "hash", "leaf")
    parts = spread.mapInArrow(_encode_leaves(path), "id long, hash long, length long, leaf int, kind int, ids array<int>")
    joined = parts.groupBy("id", "hash", "length").applyInArrow(_join_leaves(path), _SCHEMA)
    return short.unionByName(joined)


def _encode_short(path: str):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        vocab = vocabulary(path)
        for batch in batches:
            ids = [vocab.encode(t) for t in batch.column(1).to_pylist()]
            back = [vocab.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists(pa, np, ids), pa.array(back, pa.string())], names=["id", "ids", "decoded"]
            )

    return run


def _cut(path: str, leaf_chars: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        vocab = vocabulary(path)
        names = ["id", "hash", "length", "leaf", "kind", "part"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
        for batch in batches:
            for row in batch.to_pylist():
                out = [
                    (row["id"], row["hash"], row["length"], n, kind, part)
                    for n, (part, kind) in enumerate(vocab.leaves(row["text"], leaf_chars))
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return run


def _encode_leaves(path: str):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        vocab = vocabulary(path)
        for batch in batches:
            parts, kinds = batch.column("part").to_pylist(), batch.column("kind").to_pylist()
            ids = [vocab.encode_run(p.encode()) if kind else vocab.encode(p) for p, kind in zip(parts, kinds)]
            columns = [batch.column(n) for n in ("id", "hash", "length", "leaf", "kind")]
            names = ["id", "hash", "length", "leaf", "kind", "ids"]
            yield pa.RecordBatch.from_arrays([*columns, _lists(pa, np, ids)], names=names)

    return run


def _join_leaves(path: str):
    def run(group):
        import numpy as np
        import pyarrow as pa

        vocab = vocabulary(path)
        leaf = group.column("leaf").to_numpy()
        copies = int((leaf == 0).sum())  # rows with the same id and text come as copies of each leaf
        order = np.argsort(leaf, kind="stable")[::copies]
        kinds, lists = group.column("kind").to_numpy(), group.column("ids")
        ids = vocab.join_tree([(lists[int(k)].as_py(), int(kinds[k])) for k in order])
        key = group.column("id")[0].as_py()
        return pa.table(
            {
                "id": pa.array([key] * copies, pa.int64()),
                "ids": _lists(pa, np, [ids] * copies),
                "decoded": pa.array([vocab.decode(ids)] * copies, pa.string()),
            }
        )

    return run


def digests(encoded: DataFrame) -> DataFrame:
    """Count and digests of the ids and of the decoded text."""
    decimals = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimals.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the 50k byte-level vocabulary."""
    import public_tokenizers

    return digests(encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))
