"""Nearest neighbours by a block matrix join: int8 product tiles, error bounds, float recomputation, heaps.

Queries are cut into blocks and candidates into strips; a tile is one block against one strip, and a task takes a
tile's queries into memory and then reads its candidates piece by piece. Inside, a vector x is written as

    x = step * code + rest,    code in -127..127,    step = greatest |component| / 127

so that the inner product of q and x lies within

    step_q * step_x * (code_q . code_x)  +-  (step_q * |code_q| * |rest_x| + |rest_q| * |x|)

The products of codes are made by a matrix product in float32 and are exact there: numpy has no fast int8 product, and
sums of int8 products stay below 2^24 for ``EXACT_DIM`` components, wider vectors are summed in slices. A pair whose
upper end does not reach the query's k-th best score so far is dropped, which loses nothing. The others are computed
anew from the original vectors in double precision, component by component in order, and go to the query's heap. The
heaps of the strips are merged per query. So the result is exact, not approximate.

Equal vectors are one candidate with its least k + 1 ids, and one query; a group of copies of any size costs one vector
in the tiles. The grid follows counts: query blocks of ``QUERY_BYTES``, strips of ``STRIP_ROWS``, at least as many tiles
as the cluster has use for. Candidates travel once per query block, queries once per strip.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, neither do rows
without an id. Vectors are compared with those of their own length only. Ties go to the smaller id. Exact repeats of a row
count once; an id with several vectors is a query with each of them, and a candidate with each, but never of itself. A
query whose candidates are fewer than k gets all of them, one without candidates gets no row. Vectors with components
beyond 1e+-12 skip the bounds and are always computed; a pair whose product
is not a number (infinities of both signs) is left out. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetfold.llm.common import table
from fleetfold.session import pin

K = 20
QUERY_BYTES = 32 << 20  # vectors of a query block in double precision
STRIP_ROWS = 1 << 20
TILES_PER_CORE = 2
BLOCK, QUERY_ROWS = 4096, 1024  # candidates and queries of one matrix product
PAIRS = 1 << 15  # pairs that are computed anew at once
EXACT_DIM = 1000
_PLAIN = (1e-12, 1e12)


def _usable(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``id``, ``vec`` and two hashes that name the vector; only rows that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    kept = df.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & finite & some)
    vec = F.transform(vector, lambda x: x + F.lit(0).cast("float"))  # minus zero equals zero
    kept = kept.select(F.col(id_column).cast("long").alias("id"), vec.alias("vec"))
    return kept.select("id", "vec", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"))


def _distinct(rows: DataFrame) -> DataFrame:
    return rows.groupBy("h1", "h2").agg(F.first("vec").alias("vec"))


def _least_ids(rows: DataFrame, most: int) -> DataFrame:
    """The least ids of each distinct vector. Only the ranked few of a group leave the tasks that read it."""
    once = rows.select("h1", "h2", "id").distinct()
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    few = once.withColumn("place", place).where(F.col("place") <= most)
    return few.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def nearest(
    queries: DataFrame, vectors: DataFrame, k: int = K, id_column: str = "vec_id", vector: str = "embedding",
    query_bytes: int = QUERY_BYTES, strip_rows: int = STRIP_ROWS,
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest inner product for each row of ``queries``.

    Returns query_id, rank (from 1), vec_id, score; a query is never its own neighbour.
    """
    spark = vectors.sparkSession
    asked = pin(_usable(queries, id_column, vector).select("id", "h1", "h2", "vec").distinct(), "queries")
    rows = _usable(vectors, id_column, vector)
    candidates = pin(_distinct(rows).join(_least_ids(rows, k + 1), ["h1", "h2"]), "candidates")  # equal vectors of one id are one row
    shapes = _distinct(asked)
    n_queries, width = shapes.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    n_candidates = candidates.count()
    # A query's own rows are taken out in the end: one, or as many as its id has vectors.
    own_rows = asked.groupBy("id").count().agg(F.max("count")).first()[0] or 0
    most = k + own_rows
    blocks = max(1, math.ceil(n_queries * (width or 1) * 8 / query_bytes))
    wanted = TILES_PER_CORE * spark.sparkContext.defaultParallelism
    strips = max(1, math.ceil(n_candidates / strip_rows), math.ceil(wanted / blocks))

    none = F.array().cast("array<long>")
    strip_of, block_of = F.pmod("h2", F.lit(strips)), F.pmod("h1", F.lit(blocks))
    left = shapes.select("h1", "h2", "vec", none.alias("ids"), F.lit(0).alias("kind"), _tiles(block_of, F.sequence(F.lit(0), F.lit(strips - 1)), strips, False))
    right = candidates.select("h1", "h2", "vec", "ids", F.lit(1).alias("kind"), _tiles(strip_of, F.sequence(F.lit(0), F.lit(blocks - 1)), strips, True))
    tiles = left.unionByName(right).withColumn("dim", F.size("vec"))
    dealt = tiles.repartitionById(blocks * strips, F.col("tile")).sortWithinPartitions("tile", "dim", "kind", "h1", "h2")
    found = pin(dealt.mapInArrow(_tile_worker(most), "h1 long, h2 long, ids array<long>, scores array<double>"), "tile-heaps")

    lists = found.groupBy("h1", "h2").agg(F.collect_list(F.struct("ids", "scores")).alias("lists"))
    merged = lists.mapInArrow(_merge_worker(most), "h1 long, h2 long, best array<struct<vec_id:long,score:double>>")
    own = asked.select(F.col("id").alias("query_id"), "h1", "h2").join(merged, ["h1", "h2"])
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    ranked = own.select("query_id", F.posexplode(others).alias("at", "one"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "one.vec_id", "one.score")


def _tiles(own: Column, others: Column, strips: int, is_strip: bool) -> Column:
    """The tiles that a row goes to: tile = block * strips + strip."""
    number = (lambda o: o * strips + own) if is_strip else (lambda o: own * strips + o)
    return F.explode(F.transform(others, lambda o: number(o).cast("int"))).alias("tile")


class Codes:
    """Vectors as int8 codes with what their error bounds need."""

    def __init__(self, x: np.ndarray):
        top = np.abs(x).max(axis=1)
        self.wild = ~((top >= _PLAIN[0]) & (top <= _PLAIN[1]))
        safe = np.where(self.wild[:, None], 1.0, x)
        self.step = np.where(self.wild, 1.0, top) / 127
        self.code = np.rint(safe / self.step[:, None]).astype(np.int8)
        wide = self.code.astype(np.float64)
        self.code_norm = np.sqrt((wide * wide).sum(axis=1))
        rest = safe - wide * self.step[:, None]
        # Norms are rounded up, so that the bounds hold for what is stored.
        self.rest_norm = np.sqrt((rest * rest).sum(axis=1)) * (1 + 1e-9)
        self.norm = np.sqrt((safe * safe).sum(axis=1)) * (1 + 1e-9)


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of int8 rows."""
    out = None
    for at in range(0, a.shape[1], EXACT_DIM):
        part = a[:, at : at + EXACT_DIM].astype(np.float32) @ b[:, at : at + EXACT_DIM].astype(np.float32).T
        out = part if out is None else out.astype(np.float64) + part
    return out


def survivors(q: Codes, x: Codes, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose inner product may reach ``least`` (per query), by the bounds."""
    products = code_products(q.code, x.code)
    # Divided by both steps, least <= upper end reads: product >= least/(step_q step_x) - |code_q| |rest_x|/step_x - |rest_q| |x|/(step_q step_x).
    floor = least / q.step
    # Slack for rounding in float32, of terms and of their sum.
    query_side = np.stack([floor - 1e-6 * np.abs(floor), -q.code_norm * (1 + 1e-6), -q.rest_norm / q.step * (1 + 1e-6)], axis=1)
    strip_side = np.stack([1 / x.step, x.rest_norm / x.step, x.norm / x.step])
    with np.errstate(all="ignore"):
        needed = query_side.astype(np.float32) @ strip_side.astype(np.float32)
    needed[:, x.wild] = -np.inf
    needed[q.wild | np.isneginf(least)] = -np.inf
    return np.nonzero(~(products < needed))  # what cannot be compared is computed


def inner_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed in order of the components."""
    with np.errstate(all="ignore"):
        return np.add.accumulate(q * x, axis=1)[:, -1]


class Tile:
    """A block of queries and their heaps, fed with candidates."""

    def __init__(self, keys: list[tuple[int, int]], vectors: np.ndarray, k: int):
        self.keys, self.vectors, self.k = keys, vectors, k
        self.parts = [(at, Codes(vectors[at : at + QUERY_ROWS])) for at in range(0, len(vectors), QUERY_ROWS)]
        self.heaps: list[list[tuple[float, int, list[int]]]] = [[] for _ in keys]  # worst first
        self.least = np.full(len(keys), -np.inf)
        self.seen = 0

    def feed(self, vectors: np.ndarray, ids: list[list[int]]) -> None:
        """Small pieces first, while there is no good score to reach yet, then ever larger ones."""
        at = 0
        while at < len(vectors):
            size = min(max(4 * self.k, self.seen), BLOCK)
            self._piece(vectors[at : at + size], ids[at : at + size])
            self.seen += size
            at += size

    def _piece(self, vectors: np.ndarray, ids: list[list[int]]) -> None:
        x = Codes(vectors)
        for first, q in self.parts:
            rows, columns = survivors(q, x, self.least[first : first + QUERY_ROWS])
            rows = rows + first
            for at in range(0, len(rows), PAIRS):
                r, c = rows[at : at + PAIRS], columns[at : at + PAIRS]
                scores = inner_products(self.vectors[r], vectors[c])
                keep = scores >= self.least[r]
                self._push(r[keep], c[keep], scores[keep], ids)

    def _push(self, rows: np.ndarray, columns: np.ndarray, scores: np.ndarray, ids: list[list[int]]) -> None:
        for row, column, score in zip(rows.tolist(), columns.tolist(), scores.tolist()):
            heap, one = self.heaps[row], (score, -ids[column][0], ids[column])
            if len(heap) < self.k:
                heapq.heappush(heap, one)
            elif one[:2] > heap[0][:2]:
                heapq.heapreplace(heap, one)
            if len(heap) == self.k:
                self.least[row] = heap[0][0]

    def results(self) -> Iterator[tuple[tuple[int, int], list[int], list[float]]]:
        """Per query its best ids and their scores, best first, ids of equal vectors written out."""
        for key, heap in zip(self.keys, self.heaps):
            flat = heapq.nsmallest(self.k, ((-score, one) for score, _, ids in heap for one in ids))
            if flat:
                yield key, [one for _, one in flat], [-score for score, _ in flat]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _tile_worker(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, tile, keys, held, ids = None, None, [], [], []

        def feed() -> None:
            if held and tile is not None:
                tile.feed(np.concatenate(held), list(ids))
            held.clear()
            ids.clear()

        def finish() -> Iterator[pa.RecordBatch]:
            feed()
            if tile is not None:
                out = list(tile.results())
                for at in range(0, len(out), 10_000):
                    part = out[at : at + 10_000]
                    h1, h2 = [p[0][0] for p in part], [p[0][1] for p in part]
                    arrays = [pa.array(h1, pa.int64()), pa.array(h2, pa.int64())]
                    arrays += [pa.array([p[1] for p in part], pa.list_(pa.int64())), pa.array([p[2] for p in part], pa.list_(pa.float64()))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["h1", "h2", "ids", "scores"])

        for batch in batches:
            marks = np.stack([np.asarray(batch.column(c)) for c in ("tile", "dim", "kind")], axis=1)
            cuts = [0, *(np.nonzero((marks[1:] != marks[:-1]).any(axis=1))[0] + 1).tolist(), len(marks)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                here, kind = tuple(marks[a, :2].tolist()), int(marks[a, 2])
                if here != place:
                    yield from finish()
                    place, tile, keys = here, None, []
                    held.clear()
                vectors = _matrix(part.column("vec"))
                if kind == 0:
                    keys += zip(part.column("h1").to_pylist(), part.column("h2").to_pylist())
                    held.append(vectors)
                    continue
                if tile is None and keys:
                    tile = Tile(keys, np.concatenate(held), k)
                    held.clear()
                if tile is not None:
                    held.append(vectors)
                    ids += part.column("ids").to_pylist()
                    if len(ids) >= BLOCK:
                        feed()
        yield from finish()

    return work


def _merge_worker(k: int):
    kind = pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for lists in batch.column("lists").to_pylist():
                sorted_ones = [[(-s, i) for i, s in zip(one["ids"], one["scores"])] for one in lists]
                best.append([{"vec_id": i, "score": -s} for s, i in islice(heapq.merge(*sorted_ones), k)])
            yield pa.RecordBatch.from_arrays([batch.column("h1"), batch.column("h2"), pa.array(best, kind)], names=["h1", "h2", "best"])

    return work


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all embeddings for every twentieth one."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors.where(F.col("vec_id") % 20 == 0), vectors)


OP11_SQL = f"""
WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM usable AS q JOIN usable AS c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= {K}
"""
