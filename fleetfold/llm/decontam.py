"""Benchmark decontamination as a prefix-filtered containment join.

An item is cut into windows of ``WINDOW`` consecutive words (an item with fewer words is one window), and a
window into word shingles. For full containment the filter prefix of a window is one shingle: its rarest in
the documents, since a text that holds the window holds that shingle too. So documents and windows meet on
rarest shingles only. A meeting gives the one place where the window would have to stand: it must begin
at or behind the first word (position) and end at or before the last (length). Places that pass are
verified word by word over the whole window.

All steps are DataFrame expressions. Places of benchmark shingles in documents are counted first (that is the
rarity), written to the shared folder, and reused for the join. The benchmark side is sent to every task
only if it is small, else the join is by shingle with adaptive skew splitting.

Defined cases: null or empty texts have no words, no hits and are not contaminated; items without words
match nothing; a null item id counts as one item and is left out of the list of ids; equal windows of
several items hit for all of them; repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfold.llm.common import lower_ascii, pinned_small, row_key, table
from fleetfold.session import pin

WINDOW = 13
SHINGLE = 3
MOST_SENT_ROWS = 1_000_000  # window shingles that are sent to every task
MOST_SENT_PLACES = 500_000  # candidate places (some 200 bytes each) that are sent to every task
# Fixed value: the contract's words, as the characters between them.
_BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words_of(text: Column) -> Column:
    """Words in order; an empty array for null or wordless text."""
    bare = F.regexp_replace(lower_ascii(text), _BETWEEN, " ")
    bare = F.trim(bare)
    return F.when(F.length(bare) > 0, F.split(bare, " ", -1)).otherwise(F.array().cast("array<string>"))


def _shingle_hashes(words: Column, size: int) -> Column:
    """Hash of the shingle at each position, for shingles of ``size`` words; meetings are verified by the words themselves."""
    at = F.sequence(F.lit(0), F.size(words) - size)
    one = F.transform(at, lambda i: F.xxhash64(F.lit(size), *[F.get(words, i + k) for k in range(size)]))
    return F.when(F.size(words) >= size, one).otherwise(F.array().cast("array<bigint>"))


def windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct windows: ``w`` (id), ``words``, and ``items`` (sorted ids as strings) that have them."""
    rows = items.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    cut = rows.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, window))).alias("words"))
    distinct = cut.groupBy("words").agg(F.collect_set("item").alias("items"), F.max(F.col("item").isNull()).alias("unnamed"))
    return distinct.withColumn("w", F.sha1(F.array_join("words", " ").cast("binary")))


def _window_shingles(cut: DataFrame) -> DataFrame:
    """``w``, ``offset``, ``h`` of each shingle of each window. A window shorter than a shingle is one shingle itself."""
    parts = [F.when(F.size("words") == n, _shingle_hashes(F.col("words"), n)) for n in range(1, SHINGLE)]
    hashes = F.coalesce(*parts, _shingle_hashes(F.col("words"), SHINGLE))
    return cut.select("w", F.posexplode(hashes).alias("offset", "h"))


def find_windows(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document key: the verified places of windows. Columns ``key``, ``hits`` (array of start, length and
    items, ``unnamed``), only for documents with candidates, and ``words`` counted for all: see ``contamination``."""
    cut = pin(windows(items, window=window), "windows")
    shingles, few = pinned_small(_window_shingles(cut), "window-shingles", MOST_SENT_ROWS)
    wanted = shingles.select("h").distinct()
    lengths = [r[0] for r in cut.select(F.least(F.size("words"), F.lit(SHINGLE))).distinct().collect()]  # at most three
    rows = docs.select(row_key(F.col(id_column), F.col(text)).alias("key"), words_of(F.col(text)).alias("words"))
    places = None
    for size in sorted(lengths):
        some = rows.select("key", F.posexplode(_shingle_hashes(F.col("words"), size)).alias("at", "h"))
        places = some if places is None else places.unionAll(some)
    if places is None:
        return None
    met = pin(places.join(F.broadcast(wanted) if few else wanted, "h").distinct(), "shingle-places")
    # The prefix of a window: its shingle with the fewest places in the documents. One that has none rules the window out.
    counts = met.groupBy("h").agg(F.count(F.lit(1)).alias("places"))
    ranked = shingles.join(counts, "h", "left")
    prefix = ranked.groupBy("w").agg(
        F.min(F.struct(F.coalesce("places", F.lit(0)).alias("places"), "offset", "h")).alias("rarest")
    )
    prefix = prefix.where("rarest.places > 0").select("w", "rarest.offset", "rarest.h").join(cut, "w")
    prefix = pin(prefix.select("h", "offset", "words", "items", "unnamed"), "prefixes")
    starts = met.join(F.broadcast(prefix) if few else prefix, "h").where("at >= offset")
    place = F.struct((F.col("at") - F.col("offset")).alias("start"), "words", "items", "unnamed")
    return starts.select("key", place.alias("place")).groupBy("key").agg(F.collect_list("place").alias("places"))


def contamination(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """All columns of ``docs`` and ``__found``: a struct of n_words, n_hit, hits (start, length), item ids and contaminated."""
    words = words_of(F.col(text))
    candidates = find_windows(docs, items, id_column, text, window)
    empty = "array<struct<start:int,words:array<string>,items:array<string>,unnamed:boolean>>"
    if candidates is None:
        joined = docs.withColumn("__places", F.lit(None).cast(empty))
    else:
        side = pin(candidates.withColumnsRenamed({"key": "__key", "places": "__places"}), "candidates")
        n_places = side.agg(F.sum(F.size("__places"))).first()[0] or 0
        side = F.broadcast(side) if n_places <= MOST_SENT_PLACES else side
        key = row_key(F.col(id_column), F.col(text))
        joined = docs.join(side, key.eqNullSafe(F.col("__key")), "left")
    joined = joined.withColumn("__words", words)
    length_bound = lambda p: p["start"] + F.size(p["words"]) <= F.size("__words")
    same = lambda p: F.slice("__words", p["start"] + 1, F.size(p["words"])) == p["words"]
    hits = F.filter(F.filter("__places", length_bound), same)
    hits = F.coalesce(hits, F.array().cast(empty))
    joined = joined.withColumn("__hits", hits)
    spans = F.array_distinct(F.transform("__hits", lambda p: F.struct(p["start"].alias("start"), F.size(p["words"]).alias("length"))))
    covered = F.array_distinct(F.flatten(F.transform("__spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))))
    ids = F.array_sort(F.array_distinct(F.flatten(F.transform("__hits", lambda p: p["items"]))))
    n_hit, n_words = F.size("__covered").cast("long"), F.size("__words").cast("long")
    joined = joined.withColumn("__spans", spans).withColumn("__covered", covered).withColumn("__ids", ids)
    unnamed = F.exists("__hits", lambda p: p["unnamed"]).cast("long")
    found = F.struct(
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.col("__spans").alias("hits"),
        F.col("__ids").alias("item_ids"),
        (F.size("__ids").cast("long") + unnamed).alias("n_items"),
        ((n_hit > 0) & (n_hit * 20 >= n_words)).alias("contaminated"),
    )
    return joined.select(*[F.col(c) for c in docs.columns], found.alias("__found"))


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Drop contaminated documents; the rest keeps all columns."""
    return contamination(docs, items).where(~F.col("__found.contaminated")).select(*docs.columns)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that benchmark windows cover."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    ids = F.array_join("__found.item_ids", ",")
    return found.select(
        "doc_id", "__found.n_words", "__found.n_hit", "__found.n_items",
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"), "__found.contaminated",
    )


_SQL_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP10_SQL = f"""
WITH item AS (
  SELECT item_id::VARCHAR AS item, {_SQL_WORDS} AS ws FROM benchmark WHERE text IS NOT NULL
), win AS (
  SELECT DISTINCT item, array_to_string(list_slice(ws, s, s + {WINDOW - 1}), ' ') AS win, least(len(ws), {WINDOW}) AS n
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - {WINDOW - 2}, 2))) AS s FROM item WHERE len(ws) > 0)
), doc AS (
  SELECT doc_id, coalesce({_SQL_WORDS}, []) AS ws FROM documents
), spots AS (
  SELECT doc_id, n, s, array_to_string(list_slice(ws, s, s + n - 1), ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM doc, (SELECT DISTINCT n FROM win))
), hits AS (
  SELECT doc_id, item, s, n FROM spots JOIN win USING (win, n)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
