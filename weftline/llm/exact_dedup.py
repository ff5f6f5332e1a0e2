"""Exact deduplication by a heavy-hitter split (operator 8, DataFrame functions only).

Every row gets the SHA-256 of its whole text. A Misra-Gries summary (`freqItems`
is Spark's mergeable form of it) names every digest that may hold more than
`support` of all rows, 1 / support names at most. Their exact counts and winners
are verified, and that table, whose size is bounded by 1 / support, is broadcast:
rows of a heavy digest that aren't its winner are decided where they are read and
never shuffled. All other digests use an ordinary shuffle whose counts are
combined before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm.common import HEAVY, materialize, read_table, whole_row

#: A digest with more than this share of all rows is heavy; at most 1 / SUPPORT digests can be.
SUPPORT = HEAVY


def digest_of(text: str = "text") -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def heavy_winners(digests: DataFrame, support: float = SUPPORT) -> DataFrame:
    """(digest, heavy_keep, heavy_size) of the verified heavy digests of (doc_id, digest): 1 / support rows at most."""
    # freqItems compares byte arrays by reference, so it counts a 64-bit hash of them; what else shares the hash is counted too.
    tagged = digests.withColumn("tag", F.xxhash64("digest"))
    named = tagged.stat.freqItems(["tag"], support).select(F.explode("tag_freqItems").alias("tag"))
    counted = tagged.join(F.broadcast(named), "tag").groupBy("digest")
    found = counted.agg(F.max("doc_id").alias("heavy_keep"), F.count(F.lit(1)).alias("heavy_size"))
    return materialize(found.where(F.col("heavy_size") > 1), "heavy")


def exact_groups(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty text. The largest doc_id of a group stays (null ids
    lose to any other; a group of null ids has keep_id null). Of rows that repeat
    both text and doc_id one is kept. An empty table gives an empty result; other
    columns of `docs` are not read.
    """
    digests = materialize(docs.select("doc_id", digest_of().alias("digest")), "digests")
    heavy = F.broadcast(heavy_winners(digests, support))
    marked = digests.join(heavy, "digest", "left")
    is_winner = F.col("doc_id").eqNullSafe(F.col("heavy_keep"))
    losers = marked.where(F.col("heavy_size").isNotNull() & ~is_winner)
    losers = losers.select("doc_id", "digest", F.col("heavy_keep").alias("keep_id"), F.col("heavy_size").alias("group_size"), F.lit(False).alias("kept"))
    # What is left: light rows, and of each heavy digest the rows of its winner alone.
    light = marked.where(F.col("heavy_size").isNull() | is_winner)
    rows = light.groupBy("digest", "doc_id", "heavy_size").agg(F.count(F.lit(1)).alias("copies"))
    groups = rows.groupBy(F.col("digest").alias("group_digest")).agg(
        F.max("doc_id").alias("keep_id"), F.coalesce(F.max("heavy_size"), F.sum("copies")).alias("group_size")
    )
    rows = rows.join(groups, F.col("digest") == F.col("group_digest"))
    rows = rows.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)
    rows = rows.select("doc_id", "digest", "keep_id", "group_size", kept.alias("kept"))
    out = rows.unionByName(losers)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The rows of `docs` that stay, with all their columns, whatever these are called.

    Null text counts as empty; ties, repeated rows and empty tables are as in `exact_groups`.
    Losers of heavy digests go where they are read; the rest meets once, by digest.
    """
    digests = materialize(docs.select("doc_id", digest_of().alias("digest")), "digests")
    heavy = F.broadcast(heavy_winners(digests, support))
    marked = docs.select(whole_row(docs), digest_of().alias("digest")).join(heavy, "digest", "left")
    first = marked.where(F.col("heavy_size").isNull() | F.col("row.doc_id").eqNullSafe(F.col("heavy_keep")))
    ranked = first.withColumn("nth", F.row_number().over(Window.partitionBy("digest").orderBy(F.col("row.doc_id").desc_nulls_last())))
    return ranked.where("nth = 1").select("row.*")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
