"""Joins of a large table to a lookup side.

Neither side is hinted: Catalyst broadcasts the lookup side only while its measured size stays
below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, where adaptive
execution splits partitions that a hot key has filled. In a session without that splitting hot
keys are spread by a salt instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.01  # fewer than 1 / HOT_SHARE keys can hold more than this share: a bounded table


def _splits_hot_partitions(df: DataFrame) -> bool:
    conf = df.sparkSession.conf
    names = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(conf.get(n, "true").lower() == "true" for n in names)


def lookup(facts: DataFrame, side: DataFrame, on, how: str = "left", spread_by: list[str] | None = None) -> DataFrame:
    """Equi-join to a side with at most one row per key. ``spread_by`` names columns of ``facts``
    that tell the rows of one key apart, should they have to be spread."""
    if spread_by and not _splits_hot_partitions(facts):
        return salted(facts, side, on, spread_by, how)
    return facts.join(side, on, how)


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold more than ``share`` of the rows, at most 1 / share of them."""
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).count()
    total = per_key.agg(F.sum("count")).first()[0] or 0
    return per_key.where(F.col("count") > F.lit(total * share)).select(key)


def salted(
    facts: DataFrame,
    side: DataFrame,
    key: str,
    spread_by: list[str],
    how: str = "left",
    salts: int = 32,
    share: float = HOT_SHARE,
) -> DataFrame:
    """Equi-join in which a hot key of ``facts`` meets one copy of its lookup row per salt.

    ``spread_by`` names columns that tell the rows of one key apart. Only hot keys are copied; rows
    without a key are spread too, as they match nothing.
    """
    hot = F.broadcast(hot_keys(facts, key, share).withColumn("_hot", F.lit(True)))
    salt: Column = F.when(F.col("_hot") | F.col(key).isNull(), F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")).otherwise(0)
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = facts.join(hot, key, "left").withColumn("_salt", salt).drop("_hot")
    right = side.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [key, "_salt"], how).drop("_salt")
