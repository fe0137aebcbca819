"""Document fingerprints as invertible Bloom lookup tables of paragraph digests.

A text is cut into paragraphs: lines, and within a line the parts behind sentence ends; a long one is cut every
``PIECE`` characters, so that a change in its end leaves its beginning alike. Each paragraph has a 64-bit digest (its n-th repeat in the text has another one, so repeats count). A digest is added to one cell
in each of ``TABLES`` sub-tables; a cell holds a count, the XOR of its digests and the XOR of their
checksums. The fingerprint is the smallest such table, of fixed size, as text: equal texts have equal ones.

Two texts are compared by subtracting their tables cell by cell: what they share cancels out. Cells with
a single digest left give it away; taking it out of its other cells frees more (peeling). If that stalls,
both tables are made again with twice the cells, until all differing digests are recovered. Likeness is
the share of common digests among all digests of both texts.

Defined cases: null text counts as empty; two empty texts have likeness 1; blank lines are no paragraphs; ties
in order (equal ids) are resolved by a hash of the text; rows without an id stand behind all others;
a single row is its own neighbour; repeated rows are neighbours of each other; only id and text are read.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfold.llm.common import table
from fleetfold.session import pin

TABLES = 3
PIECE = 64  # characters of a paragraph that one digest covers at most
ROOMY = 8  # cells of a sub-table per digest beyond which a table that does not peel never will
CELLS = 8  # cells per sub-table of the fingerprint itself
LEAST_RANGES, MOST_RANGES = 1_024, 20_000  # ranges of ids that are worked on apart: four to a shuffle partition between these
_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def paragraphs(text: str) -> list[str]:
    for end in (". ", "! ", "? "):
        text = text.replace(end, end[0] + "\n")
    return [p[k : k + PIECE] for p in map(str.strip, text.split("\n")) for k in range(0, len(p), PIECE)]


def digests(text: str) -> list[int]:
    """One digest per paragraph; repeats differ from each other."""
    import xxhash

    seen: dict[str, int] = {}
    out = []
    for part in paragraphs(text):
        times = seen[part] = seen.get(part, -1) + 1
        out.append(xxhash.xxh64_intdigest(part, times))
    return out


def _mixed(keys, salt: int):
    """Mix 64-bit values; ``salt`` gives independent mixtures."""
    import numpy as np

    x = keys ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Tables:
    """One invertible Bloom table per owner, side by side in flat arrays of ``owners * TABLES * cells``."""

    def __init__(self, owners: int, cells: int, keys, owner):
        import numpy as np

        self.cells, self.owners = cells, owners
        size = owners * TABLES * cells
        self.count = np.zeros(size, dtype=np.int32)
        self.keys = np.zeros(size, dtype=np.uint64)
        self.checks = np.zeros(size, dtype=np.uint64)
        self._add(keys, owner, np.ones(len(keys), dtype=np.int32))

    def _places(self, keys, owner):
        """Cells of each key, one row per sub-table."""
        import numpy as np

        base = owner.astype(np.int64) * (TABLES * self.cells)
        mixed = [(_mixed(keys, k + 1) % np.uint64(self.cells)).astype(np.int64) for k in range(TABLES)]
        return np.stack([base + k * self.cells + m for k, m in enumerate(mixed)])

    def _add(self, keys, owner, sign):
        import numpy as np

        checks = _mixed(keys, TABLES + 1)
        for place in self._places(keys, owner):
            np.add.at(self.count, place, sign)
            np.bitwise_xor.at(self.keys, place, keys)
            np.bitwise_xor.at(self.checks, place, checks)

    def subtract(self, other: Tables) -> None:
        self.count -= other.count
        self.keys ^= other.keys
        self.checks ^= other.checks

    def peel(self):
        """Recovered (owner, digest, side) rows and, per owner, whether nothing is left in its cells.

        Side is 1 for digests that only the minuend has, -1 for the subtrahend's.
        """
        import numpy as np

        found = []
        width = TABLES * self.cells
        at = np.arange(len(self.count))
        while len(at):
            at = at[np.abs(self.count[at]) == 1]
            keys = self.keys[at]
            pure = self.checks[at] == _mixed(keys, TABLES + 1)
            at, keys = at[pure], keys[pure]
            if not len(at):
                break
            owner = at // width
            order = np.lexsort((keys, owner))
            at, keys, owner = at[order], keys[order], owner[order]
            first = np.ones(len(at), dtype=bool)
            first[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
            keys, owner, side = keys[first], owner[first], self.count[at[first]].copy()
            self._add(keys, owner, -side)
            found.append((owner, keys, side))
            at = np.unique(self._places(keys, owner))
        left = ((self.count != 0) | (self.keys != 0) | (self.checks != 0)).reshape(self.owners, width).any(axis=1)
        empty = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32)
        columns = [np.concatenate(c) for c in zip(*found)] if found else empty
        return *columns, ~left

    def text(self, owner: int) -> str:
        """The cells of one owner as text."""
        span = slice(owner * TABLES * self.cells, (owner + 1) * TABLES * self.cells)
        cells = self.count[span].astype("<i4").tobytes() + self.keys[span].astype("<u8").tobytes()
        return base64.b64encode(cells + self.checks[span].astype("<u4").tobytes()).decode()


def _flat(lists: list):
    """Concatenated digests, and the position of the list that each is from."""
    import numpy as np

    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    keys = np.concatenate([np.asarray(x, dtype=np.uint64) for x in lists]) if len(lists) else np.zeros(0, np.uint64)
    return keys, np.repeat(np.arange(len(lists)), sizes)


def differences(left: list, right: list, cells: int = CELLS) -> list[tuple[list[int], list[int]]]:
    """Per pair of digest lists the digests that only the left and only the right one has.

    All pairs are tried with small tables; those that do not peel out are tried again with twice the cells. A digest
    that one side has twice never peels out: tables that have far more cells than digests are given up, and the
    digests are compared as they are.
    """
    import numpy as np

    out: list = [None] * len(left)
    open_pairs = list(range(len(left)))
    while open_pairs:
        sides = [_flat([side[k] for k in open_pairs]) for side in (left, right)]
        minuend, subtrahend = (Tables(len(open_pairs), cells, *side) for side in sides)
        minuend.subtract(subtrahend)
        owner, keys, side, done = minuend.peel()
        order = np.argsort(owner, kind="stable")
        owner, keys, side = owner[order], keys[order], side[order]
        ends = np.searchsorted(owner, np.arange(len(open_pairs) + 1))
        for n, k in enumerate(open_pairs):
            if done[n]:
                span = slice(ends[n], ends[n + 1])
                out[k] = (keys[span][side[span] > 0], keys[span][side[span] < 0])
        open_pairs = [k for n, k in enumerate(open_pairs) if not done[n]]
        for k in open_pairs:
            if cells > ROOMY * (len(left[k]) + len(right[k])):
                a, b = (Counter(map(int, side[k])) for side in (left, right))
                out[k] = tuple(np.array(sorted((x - y).elements()), dtype=np.uint64) for x, y in ((a, b), (b, a)))
        open_pairs = [k for k in open_pairs if out[k] is None]
        cells *= 2
    return out


def likeness(left: list, right: list, cells: int = CELLS) -> list[float]:
    """Share of common digests among all of both, per pair of digest lists, from their recovered differences."""
    out = []
    for a, b, (only_a, only_b) in zip(left, right, differences(left, right, cells)):
        differing = len(only_a) + len(only_b)
        common = (len(a) + len(b) - differing) // 2
        out.append(common / (common + differing) if common + differing else 1.0)
    return out


def fingerprints_of(texts: list[str]) -> list[str]:
    keys, owner = _flat([digests(t) for t in texts])
    tables = Tables(len(texts), CELLS, keys, owner)
    return [tables.text(k) for k in range(len(texts))]


def _bucketed(docs: DataFrame, id_column: str, text: str, ranges: int | None) -> DataFrame:
    """Rows with the number of their id range; -1 without an id. Bounds are quantiles of the ids, one row on the driver."""
    if ranges is None:
        partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranges = min(max(LEAST_RANGES, 4 * partitions), MOST_RANGES)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    shares = [k / ranges for k in range(1, ranges)]
    bounds = rows.agg(F.percentile_approx("doc_id", shares, 20 * ranges)).first()[0] or []
    bounds = sorted(set(bounds))
    # Number of bounds at or below the id, looked up in two steps: among every ``wide``-th one, then between two of these.
    wide = max(1, math.isqrt(len(bounds)))
    coarse = F.lit(bounds[wide - 1 :: wide]).cast("array<bigint>")
    fine = F.lit(bounds).cast("array<bigint>")
    below = F.size(F.filter(coarse, lambda b: b <= F.col("doc_id"))) * wide
    bucket = below + F.size(F.filter(F.slice(fine, below + 1, wide), lambda b: b <= F.col("doc_id")))
    return rows.select(F.when(F.col("doc_id").isNull(), -1).otherwise(bucket).alias("bucket"), "doc_id", "text")


def _heads(rows: DataFrame) -> DataFrame:
    """The first row of each range in falling order, given to the range that comes before it in that order.

    One id per range is collected, and as many rows are copied.
    """
    firsts = {r.bucket: r.doc_id for r in rows.groupBy("bucket").agg(F.max("doc_id").alias("doc_id")).collect()}
    order = sorted(firsts, reverse=True)
    goes_to = [(b, firsts[b], order[k - 1]) for k, b in enumerate(order)]  # the first range's head follows the last range
    of = rows.sparkSession.createDataFrame(goes_to, "of int, head long, bucket int")
    same = (F.col("rows.bucket") == F.col("of")) & F.col("rows.doc_id").eqNullSafe(F.col("head"))
    tied = rows.alias("rows").join(F.broadcast(of).alias("of"), same)
    first = tied.select("of.bucket", "doc_id", "text", F.xxhash64("text").alias("h"))
    # Rows that tie for the head are few; the one with the greatest hash leads.
    best = first.groupBy("bucket").agg(F.max(F.struct("h", "text", "doc_id")).alias("best"))
    return best.select("bucket", F.lit(False).alias("own"), "best.doc_id", "best.text")


def with_next(docs: DataFrame, per_pairs, schema: str, id_column: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Apply ``per_pairs(rows, nexts)`` to texts and the texts that follow them in falling order of id.

    The rows are dealt once, by range of id; each range also gets the first row of the next, so no task sees
    more than its ranges and nothing is sorted as a whole.
    """
    rows = _bucketed(docs, id_column, text, ranges)
    heads = pin(_heads(rows), "range-heads")
    both = rows.select("bucket", F.lit(True).alias("own"), "doc_id", "text").unionByName(heads)
    dealt = both.repartition("bucket").sortWithinPartitions(
        "bucket", F.desc("own"), F.desc_nulls_last("doc_id"), F.desc(F.xxhash64("text")), F.desc("text")
    )

    def run(batches: Iterator) -> Iterator:
        last: list[dict] = []
        for batch in batches:
            held = last + batch.to_pylist()
            here = [k for k in range(len(held) - 1) if held[k]["own"]]
            if here:
                yield per_pairs([held[k] for k in here], [held[k + 1]["text"] for k in here])
            last = held[-1:]

    return dealt.mapInArrow(run, schema)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(rows: list[dict], nexts: list[str]):
    import pyarrow as pa

    texts = [r["text"] for r in rows]
    changed = [edited(t, n) for t, n in zip(texts, nexts)]
    own, new, following = ([digests(t) for t in group] for group in (texts, changed, nexts))
    prints = []
    for lists in (own, new):
        keys, owner = _flat(lists)
        tables = Tables(len(lists), CELLS, keys, owner)
        prints.append([tables.text(k) for k in range(len(lists))])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r["doc_id"] for r in rows], pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
            pa.array(prints[0]),
            pa.array(prints[1]),
            pa.array(likeness(own, new)),
            pa.array(likeness(own, following)),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return with_next(table(spark, sf_dir, "documents"), _compare, _SCHEMA)
