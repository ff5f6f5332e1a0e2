"""Mixing sources to target weights by hash-threshold histograms (operator 1, DataFrame functions only).

Weights share `share` times all words between the sources; no source gives more
than `cap` times its size. A source is taken whole `floor(target / size)` times,
and what then remains is met by a threshold on a hash of each document: nested
thresholds, so a larger budget takes a superset. The threshold comes from
histograms of words by source and hash bucket; only the bucket where the budget
runs out is looked at more finely. Nothing is sorted but the buckets of a source,
`1 << BITS` of them at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm.common import WORD, materialize, read_table, smallest_broadcast, whole_row

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, CAP = 1.5, 2.0
#: Bits of the hash that a histogram resolves, and levels: 60 bits in all.
BITS, LEVELS = 12, 5
#: Tables with a row per source are broadcast up to so many sources.
BROADCAST_SOURCES = 20_000


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def hash_of() -> Column:
    """60 bits of the MD5 of a row's id and text: the same in every run."""
    row = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\u001f"), F.coalesce(F.col("text"), F.lit("")))
    return F.conv(F.substring(F.md5(row.cast("binary")), 1, 15), 16, 10).cast("bigint")


def targets_of(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Add target to (source, source_size): weights by rank of the source in code point order, null last.

    A source gets min(cap * size, level * weight). The level that spends the
    budget is the largest over all k of (budget - caps of the k first) / (weights
    of the others), sources ordered by cap * size / weight. One row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int")))
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    filled = weighed.withColumn("full", cap * F.col("source_size"))
    left = share * F.sum("source_size").over(whole) - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    others = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = filled.withColumn("level", left / others).withColumn("level", F.max("level").over(whole))
    target = F.least("full", F.greatest(F.col("level"), F.lit(0.0)) * F.col("weight"))
    return level.select("source", "source_size", target.alias("target"))


def _plan(narrow: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """(s, source_size, target, base, limit) by source s: rows are taken `base` times, those with a hash below `limit` once more."""
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets_of(sizes, weights, share, cap)
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("base", base.cast("bigint"))
    plan = materialize(plan.withColumn("rest", F.col("target") - F.col("base") * F.col("source_size")), "targets")
    n_sources = plan.count()

    def boundary(rows: DataFrame, level: int, rest: DataFrame) -> DataFrame:
        """(source, prefix, rest): of the rows under each source's prefix, the bucket where `rest` runs out."""
        shift = 60 - BITS * (level + 1)
        bars = rows.withColumn("bucket", F.shiftright("h", shift)).groupBy("source", "bucket").agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        bars = bars.withColumn("below", upto - F.col("words"))
        small = smallest_broadcast(rest.select(F.col("source").alias("s"), "rest"), n_sources, BROADCAST_SOURCES)
        bars = bars.join(small, F.col("source").eqNullSafe(F.col("s")))
        crossed = (F.col("below") <= F.col("rest")) & (F.col("rest") < F.col("below") + F.col("words"))
        return bars.where(crossed).select("source", F.col("bucket").alias("prefix"), (F.col("rest") - F.col("below")).alias("rest"), F.col("words").alias("last"))

    rest, rows = plan.select("source", "rest"), narrow
    for level in range(LEVELS):
        found = materialize(boundary(rows, level, rest), f"bucket{level}")
        if level < LEVELS - 1:
            small = smallest_broadcast(found.select(F.col("source").alias("s"), "prefix"), n_sources, BROADCAST_SOURCES)
            inside = F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", 60 - BITS * (level + 1)) == F.col("prefix"))
            rows = rows.join(small, inside, "left_semi")
            if level == 0:
                rows = materialize(rows, "boundary")
        rest = found.select("source", "rest")
    # The last level has single hash values: take this one too if that is nearer.
    limit = F.when(2 * F.col("rest") > F.col("last"), F.col("prefix") + 1).otherwise(F.col("prefix"))
    plan = plan.join(found.select(F.col("source").alias("s"), limit.alias("limit")), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    return smallest_broadcast(plan.withColumnRenamed("source", "s"), n_sources, BROADCAST_SOURCES)


def _repeats() -> Column:
    """How often a row (size, h) with its source's plan is taken."""
    more = F.coalesce((F.col("h") < F.col("limit")).cast("bigint"), F.lit(0))
    return F.when(F.col("size") > 0, F.col("base") + more).otherwise(F.lit(0)).cast("bigint")


def _sized(docs: DataFrame) -> DataFrame:
    return materialize(docs.select("doc_id", "source", n_words().alias("size"), hash_of().alias("h")), "sized")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Per row of `docs`: doc_id, source, size, source_size, target, repeats, taken.

    Null text has size 0 and is taken for nothing; null is a source of its own.
    Rows with equal id and text share a hash and are taken together. Of the two
    ends of the hash value at which the budget runs out the nearer is chosen
    (the lower at a tie). An empty table, or one without words, takes nothing.
    Other columns are not read.
    """
    narrow = _sized(docs)
    plan = _plan(narrow, weights, share, cap)
    out = narrow.join(plan, F.col("source").eqNullSafe(F.col("s"))).withColumn("repeats", _repeats())
    return out.select("doc_id", "source", "h", "size", "source_size", "target", "repeats", (F.col("repeats") * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The rows of `docs` that the mix takes, each as often as it is taken, with the columns of `docs`, whatever these are called.

    Rows without words, null texts too, give no words either way; they are kept
    once. What decides is the row's own hash and its source's plan, so texts are
    decided where they are read.
    """
    plan = _plan(_sized(docs), weights, share, cap)
    rows = docs.select(whole_row(docs), n_words().alias("size"), hash_of().alias("h"))
    rows = rows.join(plan, F.col("row.source").eqNullSafe(F.col("s")))
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(_repeats()).cast("int")
    return rows.where(times > 0).select("row", F.explode(F.sequence(F.lit(1), times))).select("row.*")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "size", "source_size", "target", "repeats", "taken")


ORACLE = r"""
WITH rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(31) || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM rows GROUP BY source),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER b, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM sizes
  WINDOW b AS (ORDER BY 2.0::DOUBLE * source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, greatest((SELECT max(level) FROM levels), 0) * weight) AS target
  FROM levels),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS base FROM targets),
ranked AS (
  SELECT r.*, p.source_size, p.target, p.base, p.target - p.base * p.source_size AS rest,
         sum(size) OVER (PARTITION BY r.source ORDER BY h)::BIGINT AS upto,
         sum(size) OVER (PARTITION BY r.source, h)::BIGINT AS same
  FROM rows r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source),
final AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE base + CASE WHEN upto <= rest OR (upto - same <= rest AND 2 * (rest - (upto - same)) > same) THEN 1 ELSE 0 END END AS repeats
  FROM ranked)
SELECT doc_id, source, size, source_size, target, repeats::BIGINT AS repeats, (repeats * size)::BIGINT AS taken FROM final
"""
