"""Boilerplate lines by their share of a site's pages.

A line is boilerplate on a site if it stands on more than ``ratio`` of the site's pages, and on at least
``min_pages`` of them. Lines are compared without outer blanks; blank lines are never boilerplate and
always stay. A line that a page repeats counts once for that page, and all its copies go.

Defined cases: null text stays null with no lines; empty text stays empty; rows without a site form one
site; repeated rows count as pages of their own; a page may lose all its lines and then has empty text. A share that
equals the ratio does not exceed it. Very long texts are read whole; an empty table gives an empty result.
Extra columns are kept unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfold.llm.common import table
from fleetfold.session import pin

RATIO = 0.1
MIN_PAGES = 2  # a line on one page is no repeat
_BLANKS = " \t\r"


def _line_key(line: Column) -> Column:
    return F.unhex(F.md5(F.btrim(line, F.lit(_BLANKS)).cast("binary")))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(docs: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Per site the digests of its boilerplate lines: ``__site``, ``__boilerplate``.

    Pages are counted per (site, line) before the shuffle, so a hot site or line is one row per task. The
    list of a site is bounded by what its pages hold: each entry stands on a share ``ratio`` of them, so
    it is at most the mean page's number of lines divided by ``ratio``.
    """
    filled = F.filter(_lines(F.col(text)), lambda x: F.btrim(x, F.lit(_BLANKS)) != "")
    pages = docs.select(F.col(site).alias("__site"), F.array_distinct(F.transform(filled, _line_key)).alias("__keys"))
    totals = pages.groupBy("__site").agg(F.count(F.lit(1)).alias("__total"))
    seen = pages.select("__site", F.explode("__keys").alias("__key")).groupBy("__site", "__key").agg(F.count(F.lit(1)).alias("__pages"))
    sites = totals.select(F.col("__site").alias("__of"), "__total")
    sites = F.broadcast(sites) if _few(totals) else sites
    often = seen.where(F.col("__pages") >= min_pages).join(sites, F.col("__site").eqNullSafe(F.col("__of")))
    often = often.where(F.col("__pages") > F.col("__total") * ratio)
    return often.groupBy("__site").agg(F.sort_array(F.collect_set("__key")).alias("__boilerplate"))


def _few(totals: DataFrame, most: int = 100_000) -> bool:
    """Whether the sites can be sent to every task."""
    return totals.limit(most + 1).count() <= most


def drop_boilerplate(docs: DataFrame, site: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and ``__n_lines`` and ``__n_dropped``."""
    # Pinned, so that its true size decides between sending it to all tasks and a join by site, whose hot
    # sites adaptive execution splits.
    side = pin(boilerplate(docs, site, text, ratio, min_pages), "boilerplate")
    joined = docs.join(side, F.col(site).eqNullSafe(F.col("__site")), "left")
    lines = _lines(F.col(text))
    kept = F.filter(lines, lambda x: ~F.array_contains("__boilerplate", _line_key(x)))
    cleaned = joined.withColumn("__kept", F.when(F.col("__boilerplate").isNull(), lines).otherwise(kept))
    counted = cleaned.withColumns(
        {
            "__n_lines": F.coalesce(F.size(lines), F.lit(0)),
            "__n_dropped": F.coalesce(F.size(lines) - F.size("__kept"), F.lit(0)),
        }
    )
    counted = counted.withColumn(text, F.array_join("__kept", "\n"))
    return counted.select(*docs.columns, "__n_lines", "__n_dropped")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    cleaned = drop_boilerplate(docs)
    return cleaned.select(
        "doc_id", "source", F.col("__n_lines").cast("long").alias("n_lines"), F.col("__n_dropped").cast("long").alias("n_dropped"), "text"
    )


OP1_SQL = f"""
WITH lines AS (
  SELECT DISTINCT doc_id, source, trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13)) AS line FROM documents
), totals AS (
  SELECT source, count(*) AS total FROM documents GROUP BY source
), often AS (
  SELECT l.source, line, count(*) AS pages FROM lines AS l WHERE line <> '' GROUP BY l.source, line
), bad AS (
  SELECT o.source, list(line) AS bad FROM often AS o JOIN totals AS t ON o.source IS NOT DISTINCT FROM t.source
  WHERE pages >= {MIN_PAGES} AND pages > total * {RATIO}::DOUBLE GROUP BY o.source
), kept AS (
  SELECT doc_id, d.source, string_split(text, chr(10)) AS lines,
         list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(bad, []), trim(x, ' ' || chr(9) || chr(13)))) AS kept
  FROM documents AS d LEFT JOIN bad AS b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, source, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(lines) - len(kept), 0)::BIGINT AS n_dropped,
       array_to_string(kept, chr(10)) AS text
FROM kept
"""
