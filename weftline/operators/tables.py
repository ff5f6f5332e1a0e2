"""Tables that are kept up to date and read by key or time (OP-15, 17, 29, 30, 36, 56..60).

A `BucketTable` lies in buckets of a key. A delta is merged with the buckets that
it touches, which are written anew, and one commit puts them in the place of the
old ones; readers see all of a delta or nothing, merge nothing, and read one
bucket for one key. What no commit names is removed, so the table takes the disk
of its live rows and of the buckets that the last delta replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftline.operators import serving as S
from weftline.operators.events import latest_version
from weftline.streaming.commits import Commits

HOUR = 3_600_000


class BucketTable:
    """`schema` names the columns, `key` those whose hash is the bucket; `merge` makes the new rows from old and new ones together."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: list[str], merge: Callable[[DataFrame], DataFrame], buckets: int = 64):
        self.spark, self.path, self.schema, self.key, self.merge, self.buckets = spark, path.rstrip("/"), schema, key, merge, buckets
        self.commits = Commits(spark, f"{self.path}/commits")

    def bucket(self, *values: Column | str) -> Column:
        return F.pmod(F.xxhash64(*(values or self.key)), F.lit(self.buckets)).cast("int")

    def apply(self, delta: DataFrame, number: int | None = None) -> list[int]:
        """Merge a delta in; returns the buckets that it touched. A number that was applied before changes nothing."""
        done, state = self.commits.last()
        number = (-1 if done is None else done) + 1 if number is None else number
        if done is not None and done >= number:
            return []
        held = {} if state is None else {int(b): run for b, run in state["buckets"].items()}
        names = [c.split()[0] for c in self.schema.split(", ")]
        delta = delta.select(*names).withColumn("bucket", self.bucket())
        touched = sorted(r.bucket for r in delta.select("bucket").distinct().collect())  # as many as there are buckets at most
        old = self._read(held, touched).withColumn("bucket", self.bucket())
        new = self.merge(delta.drop("bucket").unionByName(old.drop("bucket"))).withColumn("bucket", self.bucket())
        run = f"run={number}"
        new.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{run}")
        now = {str(b): r for b, r in (held | {b: run for b in touched}).items()}
        replaced = [f"{held[b]}/bucket={b}" for b in touched if b in held]
        self.commits.put(number, {"buckets": now, "dropped": replaced})
        for folder in [] if state is None else state["dropped"]:  # neither this commit nor the one before names it
            self.commits.remove(folder)
        return touched

    def _read(self, held: dict[int, str], buckets: list[int]) -> DataFrame:
        folders = [f"{self.path}/{held[b]}/bucket={b}" for b in buckets if b in held and self.commits.files.exists(self.commits.at.getParent().suffix(f"/{held[b]}/bucket={b}"))]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def read(self, *key_values: object) -> DataFrame:
        """All rows, or those of a key's values: then one bucket is read."""
        _, state = self.commits.last()
        held = {} if state is None else {int(b): run for b, run in state["buckets"].items()}
        if not key_values:
            return self._read(held, sorted(held))
        types = dict(c.split() for c in self.schema.split(", "))
        given = [F.lit(v).cast(types[k]) for k, v in zip(self.key, key_values)]
        own = self.spark.range(1).select(self.bucket(*given)).first()[0]
        found = self._read(held, [own])
        for k, v in zip(self.key, given):
            found = found.where(F.col(k) == v)
        return found

    def follow(self, stream: DataFrame, checkpoint: str, interval_ms: int | None = None) -> StreamingQuery:
        """OP-15: apply each batch of a stream of changes."""
        given = {"availableNow": True} if interval_ms is None else {"processingTime": f"{interval_ms} milliseconds"}
        return stream.writeStream.foreachBatch(lambda batch, number: self.apply(batch, number) and None).option("checkpointLocation", checkpoint).trigger(**given).start()


def observation_table(spark: SparkSession, path: str, buckets: int = 64) -> BucketTable:
    """OP-30: how often each product was seen in each category; a delta (product_id, category_id, observations) adds to it."""
    add = lambda rows: rows.groupBy("product_id", "category_id").agg(F.sum("observations").alias("observations"))
    return BucketTable(spark, path, "product_id long, category_id long, observations long", ["product_id"], add, buckets)


def dominant_of(table: BucketTable, touched: list[int] | None = None) -> DataFrame:
    """OP-36: the category of each product, of all or of the buckets that a delta touched."""
    _, state = table.commits.last()
    held = {int(b): run for b, run in (state or {"buckets": {}})["buckets"].items()}
    return S.dominant_category(table._read(held, sorted(held) if touched is None else touched))


def cart_table(spark: SparkSession, path: str, buckets: int = 64) -> BucketTable:
    """OP-15, 17, 58: the newest change of each user's items, by user; a change that comes again, or an older one, changes nothing."""
    newest = lambda rows: latest_version(rows, ["user_id", "item_id"], "change")
    return BucketTable(spark, path, "user_id long, item_id long, operation string, category_id long, added_at_ms long, last_updated_at_ms long, change long", ["user_id"], newest, buckets)


def feature_table(spark: SparkSession, path: str, buckets: int = 64) -> BucketTable:
    """OP-17, 59: the newest feature snapshot of each user."""
    newest = lambda rows: latest_version(rows, ["user_id"], "feature_version")
    return BucketTable(spark, path, "user_id long, feature_id string, event_count long, distinct_items long, feature_version long, expires_at_ms long", ["user_id"], newest, buckets)


def write_rollup(metrics: DataFrame, path: str) -> None:
    """OP-29: minute metrics by hour of their window; hours that are written again replace theirs."""
    rows = metrics.select("window_start_ms", "item_id", "pv_count", "cart_count", "buy_count").withColumn("hour", F.floor(F.col("window_start_ms") / HOUR))
    sums = rows.groupBy("hour", "window_start_ms", "item_id").agg(*[F.sum(c).alias(c) for c in ("pv_count", "cart_count", "buy_count")])
    sums.repartition("hour").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("hour").parquet(path)


def rollup_range(spark: SparkSession, path: str, as_of: int, minutes: int) -> DataFrame:
    """The rollup's minutes of [as_of - minutes, as_of); hours outside are pruned."""
    start = as_of - minutes * 60_000
    rows = spark.read.schema("window_start_ms long, item_id long, pv_count long, cart_count long, buy_count long, hour long").parquet(path)
    return rows.where(F.col("hour").between(start // HOUR, (as_of - 1) // HOUR) & (F.col("window_start_ms") >= start) & (F.col("window_start_ms") < as_of))


def trending_of_rollup(spark: SparkSession, path: str, catalog: DataFrame, as_of: int, minutes: int = 15, limit: int = 20) -> DataFrame:
    """OP-60 over the rollup."""
    return S.trending(rollup_range(spark, path, as_of, minutes).drop("hour"), catalog, as_of, minutes, limit)
