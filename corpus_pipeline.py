"""Five stages over documents: toxicity, exact and near duplicates, mixing, packing.

Each stage works on all rows that the one before it kept, is written as Parquet
and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from weftline.llm.common import materialize, read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose probability of any toxicity is under the bar stay; null and empty texts have the prior, and all stay where the labels tell nothing apart."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of the largest id stays, null texts being empty ones; with all columns, whatever their names."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that link, directly or by way of others, the row of the smallest id stays; rows without words, text or id stay all."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix takes them; the budget is of the words that are left."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece, with its token ids. Null text is the single end id; rows that repeat are packed each; an empty table gives no rows."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_join", drop_near_copies), ("mixing", mix_sources), ("packing", pack)]

#: A fitted model decides the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; an empty table gives an empty one."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
