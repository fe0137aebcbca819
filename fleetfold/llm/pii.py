"""Personal data by patterns, and terms that give it away by corpus statistics.

Patterns find e-mail addresses, IPv4 addresses, payment cards and phone numbers. Each distinct value is a
protected entity. All words of a document with the entity are candidates. Over the distinct texts of the corpus

    information(entity)       = log(documents / documents with the entity)
    disclosure(entity, term)  = pointwise mutual information / information(entity) * n^3 / (n^3 + PRIOR)

where the mutual information comes from the documents that have both, those that have the term, and those that
have the entity. The first factor is 1 for a term that only occurs with the entity: reading the
term is as good as reading the entity. The second shrinks it by the evidence n, the number of texts with both that
are told apart by what stands around the entity (``WINDOW`` characters on both sides). It grows with the cube: one
text alone, or copies of one passage, disclose nothing, two texts only what stands nowhere else. Terms at or above
``GENERALISE`` are spans of their own and are replaced by a class of words, at or above ``REMOVE`` they are taken out,
wherever they stand, also in documents without the entity.

As the first factor is at most 1, the second bounds the disclosure: entities, and pairs of entity and term, whose
bound is below ``GENERALISE`` are left out before anything is counted for them, which changes no result. Terms
are counted and scored first; places are looked up for those that disclose.

All steps are DataFrame expressions. Positions come from the pieces that a pattern cuts a text into, summed up
blockwise, so many matches in one long text stay cheap. Quantifiers are possessive and look back to the start
of a run, which changes no match but keeps long runs linear.

Defined cases: null text counts as empty and has no spans; very long texts are searched whole; a match that fails its test
is dropped without a second try; overlapping spans of different kinds are all reported, and replaced as one; repeated
rows get equal spans; equal scores are treated alike; a null id is kept; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfold.llm.common import table
from fleetfold.session import pin

WINDOW = 80
PRIOR = 1.9  # weight of what is not known against the cube of the evidence
GENERALISE, REMOVE = 0.8, 0.95
TERM = "term"
MOST_SENT_BYTES = 16 << 20  # of a table that is sent to every task
FIRST_PART = 16  # one of so many texts is counted first
_BLOCK = 64
_WORD = r"[\p{L}\p{N}]+"

# The kinds in their order and their patterns, in possessive form.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_SIGNS = {"email": "@", "ip": ".", "card": None, "phone": "+"}  # a text without the sign has no match
REPLACED_BY = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", TERM: "[WORD]"}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _indices(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), operator.add)


def _sums_before(numbers: Column) -> Column:
    """For each element the sum of those before it; sums of blocks are made first."""

    def with_blocks(a: Column, blocks: Column) -> Column:
        def before(i: Column) -> Column:
            block = F.floor(i / _BLOCK).cast("int")
            return _sum(F.slice(blocks, F.lit(1), block)) + _sum(F.slice(a, block * _BLOCK + 1, i % _BLOCK))

        return F.transform(_indices(F.size(a)), before)

    def whole(a: Column) -> Column:
        count = F.ceil(F.size(a) / _BLOCK).cast("int")
        blocks = F.transform(_indices(count), lambda b: _sum(F.slice(a, b * _BLOCK + 1, _BLOCK)))
        return _let(blocks, lambda s: with_blocks(a, s))

    return _let(numbers, whole)


def _cut(text: Column, pattern: str, build: Callable[[Column, Column, Column, Column], Column]) -> Column:
    """``build(match, start, piece before, piece behind)`` for each match of a pattern, as an array."""

    def whole(both: Column) -> Column:
        matches, pieces = both["m"], both["p"]
        steps = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: F.length(p) + F.length(m))

        def each(sums: Column) -> Column:
            def one(i: Column) -> Column:
                piece = F.get(pieces, i)
                return build(F.get(matches, i), F.get(sums, i) + F.length(piece), piece, F.get(pieces, i + 1))

            return F.transform(_indices(F.size(matches)), one)

        return _let(_sums_before(steps), each)

    return _let(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p")), whole)


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        small = lambda p: F.coalesce(F.regexp_replace(p, "^0+", "").try_cast("int"), F.lit(0)) <= 255
        short = lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3
        return F.forall(F.split(value, r"\."), lambda p: short(p) & small(p))
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _test(kind: str) -> Callable[[Column], Column]:
    return lambda s: _valid(kind, s["value"])


_SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string,value:string,before:string,behind:string>>"


def base_spans(text: Column) -> Column:
    """Spans of all kinds by start and kind: start, kind_no, end, kind, value, and the text around (``WINDOW`` characters)."""
    none = F.array().cast(_SPAN)
    kinds = []
    for number, kind in enumerate(KINDS):

        def build(match: Column, start: Column, before: Column, behind: Column, number=number, kind=kind) -> Column:
            return F.struct(
                start.alias("start"),
                F.lit(number).alias("kind_no"),
                (start + F.length(match)).alias("end"),
                F.lit(kind).alias("kind"),
                match.alias("value"),
                F.right(before, F.lit(WINDOW)).alias("before"),
                F.left(behind, F.lit(WINDOW)).alias("behind"),
            )

        found = F.filter(_cut(text, PATTERNS[kind], build), _test(kind))
        possible = text.contains(_SIGNS[kind]) if _SIGNS[kind] else text.rlike("[0-9]")
        kinds.append(F.when(possible, found).otherwise(none).cast(_SPAN))
    return F.coalesce(F.array_sort(F.concat(*kinds)), none)


def detect(docs: DataFrame, id_column: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """``doc_id``, ``hash`` (of the text, tells rows with equal ids apart) and ``spans`` of every row.

    With ``keep_text`` also ``text`` where there are spans, so that it need not be fetched again, and ``text_sha256``.
    """
    filled = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(filled).alias("hash"), base_spans(filled).alias("spans"), filled.alias("text"))
    if not keep_text:
        return found.drop("text")
    kept = F.when(F.size("spans") > 0, F.col("text"))
    return found.withColumns({"text_sha256": F.sha2("text", 256), "text": kept})


def _entities(found: DataFrame) -> DataFrame:
    """Distinct ``hash`` (of the text), ``entity`` and ``context`` (hash of the text around)."""
    span = found.where(F.size("spans") > 0).select("hash", F.explode("spans").alias("s"))
    digits = F.regexp_replace("s.value", "[^0-9]", "")
    value = F.when(F.col("s.kind") == "email", F.lower("s.value")).otherwise(F.when(F.col("s.kind") == "ip", F.col("s.value")).otherwise(digits))
    return span.select(
        "hash", F.concat("s.kind", F.lit(":"), value).alias("entity"), F.xxhash64("s.before", "s.behind").alias("context")
    ).distinct()


def _shrunk(n: Column | str) -> Column:
    """What evidence of n texts leaves of a disclosure."""
    n = F.col(n) if isinstance(n, str) else n
    return n * n * n / (n * n * n + F.lit(PRIOR))


def _evidence() -> Column:
    return F.least(F.count_distinct("context"), F.count_distinct("hash"))


def _words(text: str) -> Column:
    """All words with their places."""

    def build(match: Column, start: Column, before: Column, behind: Column) -> Column:
        return F.struct(F.lower(match).alias("term"), start.alias("start"), (start + F.length(match)).alias("end"))

    return _cut(F.col(text), _WORD, build)


def _outside(word: Column) -> Column:
    """The word is no part of a span; ``spans`` must be a stored column, or its patterns would run once per word."""
    return ~F.exists("spans", lambda s: (s["start"] < word["end"]) & (word["start"] < s["end"]))


def _sent(df: DataFrame, name: str, column: str) -> DataFrame:
    """A pinned one-column table, to be sent to every task while it is small in bytes, else joined by shuffle."""
    copy = pin(df, name)
    size = copy.agg(F.sum(F.octet_length(F.col(column).cast("string")) + 32)).first()[0] or 0
    return F.broadcast(copy) if size <= MOST_SENT_BYTES else copy


def _terms_of(texts: DataFrame) -> DataFrame:
    """``hash`` and each different word of every row, spans included."""
    return texts.select("hash", F.explode(F.array_distinct(F.split(F.lower(F.col("text")), r"[^\p{L}\p{N}]+"))).alias("term"))


def _slim(found: DataFrame) -> DataFrame:
    return found.select("hash", "text", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def disclosing_terms(texts: DataFrame, found: DataFrame, entities: DataFrame) -> DataFrame:
    """``term`` and its greatest ``disclosure`` of an entity, at or above ``GENERALISE``."""
    telling = entities.groupBy("entity").agg(_evidence().alias("n"), F.count_distinct("hash").alias("n_entity"))
    telling = pin(telling.where(_shrunk("n") >= GENERALISE).select("entity", "n_entity"), "telling-entities")
    none = telling.select(F.lit("").alias("term"), F.lit(0.0).alias("disclosure")).where(F.lit(False))
    if telling.isEmpty():
        return none
    kept = pin(entities.join(telling.select("entity"), "entity", "left_semi"), "entities")
    # Texts with entities have been kept with their spans.
    own = _slim(found.where("text IS NOT NULL")).join(kept.select("hash").distinct(), "hash", "left_semi").dropDuplicates(["hash"])
    outside = F.transform(F.filter(_words("text"), _outside), lambda w: w["term"])
    words = pin(own, "texts-with-entities").select("hash", F.explode(F.array_distinct(outside)).alias("term"))
    pairs = words.join(kept, "hash").groupBy("entity", "term").agg(_evidence().alias("n"), F.count_distinct("hash").alias("n_both"))
    pairs = pin(pairs.where(_shrunk("n") >= GENERALISE).join(telling, "entity"), "entity-terms")
    if pairs.isEmpty():
        return none
    total = F.lit(found.select("hash").distinct().count()).cast("double")
    information = F.log(total / F.col("n_entity"))

    def disclosure(n_term: Column) -> Column:
        mutual = F.log(total * F.least(F.col("n_both"), n_term) / (F.col("n_entity") * n_term))
        return F.when(information > 0, mutual / information * _shrunk("n")).otherwise(0.0)

    # Of texts that repeat each word has to be told apart by text; those of all others are added up where they are read.
    repeated = _sent(found.groupBy("hash").count().where("count > 1").select("hash"), "repeated", "hash")

    def counted(some: DataFrame, name: str) -> DataFrame:
        """In how many different texts each candidate stands."""
        terms = _sent(candidates.select("term").distinct(), name, "term")
        single, copies = some.join(repeated, "hash", "left_anti"), some.join(repeated, "hash", "left_semi")
        parts = [_terms_of(rows).join(terms, "term", "left_semi") for rows in (single, copies)]
        both = [rows.groupBy("term").agg(F.count(F.lit(1)).alias("n")) for rows in (parts[0], parts[1].distinct())]
        return both[0].unionByName(both[1]).groupBy("term").agg(F.sum("n").alias("n_term"))

    # A part of the texts bounds a term's count from below, and so its disclosure from above.
    candidates = pairs
    least = counted(texts.where(F.pmod("hash", F.lit(FIRST_PART)) == 0), "first-candidates")
    at_least = F.greatest(F.coalesce("n_term", F.lit(0)), "n_both")
    candidates = pin(pairs.join(least, "term", "left").where(disclosure(at_least) >= GENERALISE).drop("n_term"), "rare-candidates")
    scored = candidates.join(counted(texts, "candidates"), "term").withColumn("disclosure", disclosure(F.col("n_term")))
    return scored.where(F.col("disclosure") >= GENERALISE).groupBy("term").agg(F.max("disclosure").alias("disclosure"))


_TERMS = "array<struct<start:int,kind_no:int,end:int,kind:string,disclosure:double>>"


def find(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``hash``, ``spans`` (base), ``terms`` (start, kind_no, end, kind, disclosure) and ``sanitised_sha256`` of every row."""
    found = pin(detect(docs, id_column, text, keep_text=True), "spans")
    base = found.withColumns({"terms": F.lit(None).cast(_TERMS), "marks": F.when(F.size("spans") > 0, _marks())})
    clean = F.when(F.col("marks").isNull(), F.col("text_sha256")).otherwise(F.sha2(_replaced("text", "marks"), 256))
    columns = ["doc_id", "hash", "spans", "terms", "sanitised_sha256"]
    base = base.withColumn("sanitised_sha256", clean).select(*columns)
    filled = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.xxhash64(filled).alias("hash"), filled.alias("text"))
    giving = pin(disclosing_terms(texts, found, pin(_entities(found), "entity-contexts")), "disclosing-terms")
    if giving.isEmpty():
        return base
    # Which of them each text has, then their places; texts stay where they are read but for those to be marked.
    held = _terms_of(texts).join(_sent(giving, "giving", "term"), "term").distinct()
    held = _sent(held.groupBy("hash").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("own")), "texts-to-mark", "own")
    places = F.filter(_words("text"), lambda w: F.map_contains_key("own", w["term"]))

    def one(w: Column) -> Column:
        values = {"start": w["start"], "kind_no": F.lit(len(KINDS)), "end": w["end"], "kind": F.lit(TERM), "disclosure": F.try_element_at("own", w["term"])}
        return F.struct(*[v.alias(n) for n, v in values.items()])

    spans = F.transform(base_spans(F.col("text")), lambda s: F.struct(*[s[c].alias(c) for c in ("start", "end", "kind")]))
    some = pin(texts.join(held, "hash").select("hash", "text", spans.alias("spans"), F.transform(places, one).alias("places")), "places")
    some = some.withColumn("terms", F.filter("places", _outside).cast(_TERMS)).where(F.size("terms") > 0)
    some = some.withColumn("marks", _marks()).select("hash", "terms", F.sha2(_replaced("text", "marks"), 256).alias("sanitised_sha256"))
    # One set of terms for equal texts; the texts themselves go no further.
    more = pin(some, "terms").dropDuplicates(["hash"]).withColumnsRenamed({"terms": "_terms", "sanitised_sha256": "_clean"})
    marked = base.drop("terms").join(more, "hash", "left").withColumnRenamed("_terms", "terms")
    return marked.withColumn("sanitised_sha256", F.coalesce("_clean", "sanitised_sha256")).select(*columns)


def _marks() -> Column:
    """What to replace by what, in order, of ``spans`` and ``terms``."""
    return F.array_sort(
        F.concat(
            F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), _class_of(s["kind"]).alias("by"))),
            F.coalesce(
                F.transform(
                    "terms",
                    lambda t: F.struct(
                        t["start"].alias("start"), t["end"].alias("end"), F.when(t["disclosure"] >= REMOVE, "").otherwise(REPLACED_BY[TERM]).alias("by")
                    ),
                ),
                F.array().cast("array<struct<start:int,end:int,by:string>>"),
            ),
        )
    )


def _replaced(text: str, marks: str) -> Column:
    """A text with its marks replaced; a span that overlaps the last one joins it."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, m: Column) -> Column:
        between = F.col(text).substr(acc["at"] + 1, F.greatest(m["start"] - acc["at"], F.lit(0)))
        by = F.when(m["start"] >= acc["at"], m["by"]).otherwise("")
        return F.struct(F.greatest(acc["at"], m["end"]).alias("at"), F.concat(acc["parts"], F.array(between, by)).alias("parts"))

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["parts"], ""), F.col(text).substr(acc["at"] + 1, F.length(text)))

    return F.aggregate(marks, start, step, finish)


def sanitise(docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with spans replaced in ``text``: base kinds by their class, disclosing terms by a class or by nothing."""
    # Of repeated rows one set of spans is enough.
    side = found.where((F.size("spans") > 0) | (F.size("terms") > 0)).select("doc_id", "hash", _marks().alias("__marks"))
    side = side.withColumnsRenamed({"doc_id": "__id", "hash": "__hash"}).dropDuplicates(["__id", "__hash"])
    same = F.col(id_column).eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("__hash"))
    clean = F.when(F.col("__marks").isNull(), F.col(text)).otherwise(_replaced(text, "__marks"))
    return docs.join(side, same, "left").withColumn(text, clean).select(*docs.columns)


def _class_of(kind: Column) -> Column:
    return functools.reduce(lambda c, k: c.when(kind == k, REPLACED_BY[k]), KINDS[1:], F.when(kind == KINDS[0], REPLACED_BY[KINDS[0]]))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, the terms that disclose it, and the digest of the sanitised text."""
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    slim = lambda s: F.struct(s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["end"].alias("end"), s["kind"].alias("kind"))
    none = F.array().cast("array<struct<start:int,kind_no:int,end:int,kind:string>>")
    together = F.array_sort(F.concat(F.transform("spans", slim), F.coalesce(F.transform("terms", slim), none)))
    return found.select(
        "doc_id", *counts, F.sha2(_joined(F.col("spans")).cast("binary"), 256).alias("base_sha256"), _joined(together).alias("spans"), "sanitised_sha256"
    )
