"""From raw documents to token digests, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All but the last
return the columns of documents. Between stages the rows are written as Parquet and read again, so a lost
executor never costs more than the stage that it was in.

Defined cases: an empty table passes through all stages. Null or empty text has no language and goes in the
first stage. A null id is kept. Extra columns are carried along to the last stage, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfold.llm.bpe import digests, encode
from fleetfold.llm.common import ready, table
from fleetfold.llm.decontam import keep_clean
from fleetfold.llm.langid import keep_identified
from fleetfold.llm.linededup import drop_boilerplate
from fleetfold.llm.simhash import keep_one_of_each
from fleetfold.session import pin


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no known language."""
    ready(spark)
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take boilerplate lines out of the texts; ``n_chars`` follows the text. Documents stay, even if emptied."""
    ready(spark)
    cleaned = drop_boilerplate(docs)
    counted = F.when(F.col("__n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", counted).select(*docs.columns)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each group of near copies."""
    ready(spark)
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold benchmark windows."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode what is left and decode it again: one row of digests per document."""
    ready(spark)
    return digests(encode(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash", simhash),
    ("decontamination", decontaminate),
    ("bpe", tokenize),
]

# Fingerprints by XXH64 and token ids are beyond SQL; tests/llm/test_pipeline.py compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = pin(docs, f"stage-{name}")
    return docs
