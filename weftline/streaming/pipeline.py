"""The streaming job: five sinks of one query, with one commit a batch (OP-7, 14, 27, 28, 40..50, 63).

All is done within each batch by ordinary DataFrame operations. Ids that have come
and versions of carts are those of the batches committed so far, joined to the rows.
The watermark of a shard is a prefix maximum by stretches of arrivals, so no task has
a shard's rows, and what goes from batch to batch is one time a shard. Windows stay
open as counts, in order of time, until the clock of the slowest shard has passed them.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import Executor, Future, ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftline.config import BEHAVIORS, RuntimeConfig
from weftline.functions.scalar import MINUTE, behavior_count, minute_start, sha_of, window_label
from weftline.operators import events as E
from weftline.operators import serving as S
from weftline.streaming.commits import Commits, read_sink
from weftline.streaming.state import EVENT, RETENTION_MS, STATE_CONF, marked

HOUR = 3_600_000
#: Batches whose open windows, ids and carts are kept apart; beyond that they become one table.
PARTS = 20
_COUNTS = ", ".join(f"{b}_count long" for b in BEHAVIORS)
_PART = f"window_start_ms long, item_id long, source_category_id long, user_id long, {_COUNTS}, replay_run_id string"

SINKS = {
    "raw": "event_id string, user_id long, item_id long, category_id long, behavior_type string, event_time_ms long, source_sequence long, replay_run_id string, record_version long",
    "metrics": f"window_start_ms long, item_id long, source_category_id long, {_COUNTS}, unique_users long, replay_run_id string, window_start string, record_version long",
    "features": f"window_start_ms long, user_id long, event_count long, {_COUNTS}, distinct_items long, window_start string, window_end string, feature_id string, feature_version long, record_version long",
    "quality": "quality_type string, event_id string, user_id long, item_id long, category_id long, behavior_type string, event_time_ms long, source_sequence long, replay_run_id string, reason_code string, quality_event_id string, reason_message string, observed_at_ms long, record_version long",
    "cart": "operation string, user_id long, item_id long, category_id long, added_at_ms long, last_updated_at_ms long, source_sequence long, change long",
}

#: What is remembered of a sink's rows, with the time of their batch.
HELD = {"raw": "event_id string, now long", "cart": "user_id long, item_id long, last_updated_at_ms long, source_sequence long, change long, now long"}
#: The order of rows with one id: the first is the same whenever a batch runs again.
ARRIVAL = ("arrival", "source_sequence", "replay_run_id", "event_time_ms", "user_id", "item_id", "category_id", "behavior_type")
#: What a batch keeps takes as many tasks as it needs, not one for each partition of a shuffle.
CACHE_CONF = ("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")


def event_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """OP-7's interface over a folder of Parquet files."""
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def nothing(spark: SparkSession, schema: str) -> DataFrame:
    """No rows; unlike a frame of a Python list, it starts no Python worker."""
    return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in schema.split(", "))])


def with_heartbeats(events: DataFrame) -> DataFrame:
    """A row a second that is no event, so that a shard is found idle though nothing comes."""
    spark = events.sparkSession
    beats = spark.readStream.format("rate").load().select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema], F.lit(True).alias("beat"))
    return events.withColumn("beat", F.lit(False)).unionByName(beats)


def classified(rows: DataFrame, tops: dict[str, int], closed: int | None, delay_ms: int, stretches: DataFrame | None = None) -> DataFrame:
    """OP-41 to 43: rows of a batch with ON_TIME or LATE for UNIQUE or VALID. A row is late at or behind the watermark of the rows before it in its
    shard, and at or behind the time up to which windows are closed, whatever its shard."""
    timed = E.with_running_top(rows, ["shard"], stretches)
    held = F.create_map(*[F.lit(x) for item in tops.items() for x in item])[F.col("shard")] if tops else F.lit(None)  # a shard each
    watermark = F.greatest(F.greatest("__top", held.cast("long")) - delay_ms, F.lit(closed).cast("long"))
    late = F.coalesce(F.col("event_time_ms") <= watermark, F.lit(False))
    return timed.withColumn("status", F.when(~F.col("status").isin("UNIQUE", "VALID"), F.col("status")).when(late, "LATE").otherwise("ON_TIME")).drop("__top")


def quality_rows(rows: DataFrame, at_ms: Column | None = None) -> DataFrame:
    """OP-40: a quality row for each invalid and each late row, with its time of observation."""
    rows = rows.where(F.col("status").isin("INVALID", "LATE")).withColumnRenamed("status", "quality_type")
    behind = F.col("quality_type") == "LATE"
    rows = rows.withColumn("reason_code", F.when(behind, E.LATE_REASON).otherwise(F.col("validation_reason"))).withColumn("reason_message", F.when(behind, E.LATE_MESSAGE).otherwise(E.INVALID_MESSAGE))
    rows = rows.withColumn("quality_event_id", sha_of("|", "quality_type", F.coalesce("event_id", F.lit("")), "replay_run_id", "source_sequence", "reason_code"))
    return E.observed(rows, at_ms)


def cart_changes(rows: DataFrame) -> DataFrame:
    """OP-15, 24, 35: an UPSERT or a DELETE for each row that changes a cart; `change` numbers the changes of a user and item, so one that is applied again can be told."""
    return rows.where("change > 0").select(*E.mutation_columns(), "source_sequence", "change")


def newer_carts(rows: DataFrame, held: DataFrame) -> DataFrame:
    """OP-35: the newest row of each cart, with the number of its change, where it is newer than the last held one."""
    last = E.latest_version(held, ["user_id", "item_id"], "change").select(F.col("user_id").alias("__user"), F.col("item_id").alias("__item"), F.struct("last_updated_at_ms", "source_sequence").alias("__version"), F.col("change").alias("__change"))
    rows = E.latest_cart(rows).join(last, F.col("user_id").eqNullSafe(F.col("__user")) & F.col("item_id").eqNullSafe(F.col("__item")), "left")
    newer = F.col("__change").isNull() | (F.struct(F.col("event_time_ms").alias("last_updated_at_ms"), "source_sequence") > F.col("__version"))
    return rows.where(newer).withColumn("change", F.coalesce("__change", F.lit(0)) + 1)


def open_counts(rows: DataFrame) -> DataFrame:
    """Counts of rows on time by window, item, category and user: what both kinds of windows are summed from."""
    rows = rows.where("status = 'ON_TIME'").withColumn("window_start_ms", minute_start()).withColumnRenamed("category_id", "source_category_id")
    return rows.groupBy("window_start_ms", "item_id", "source_category_id", "user_id").agg(*map(behavior_count, BEHAVIORS), F.min("replay_run_id").alias("replay_run_id"))


def metrics_of(counts: DataFrame) -> DataFrame:
    """OP-27, from `open_counts`."""
    sums = [F.sum(f"{b}_count").alias(f"{b}_count") for b in BEHAVIORS]
    out = counts.groupBy("window_start_ms", "item_id", "source_category_id").agg(*sums, F.countDistinct("user_id").alias("unique_users"), F.min("replay_run_id").alias("replay_run_id"))
    return out.withColumn("window_start", window_label(F.col("window_start_ms"))).withColumn("record_version", F.col("window_start_ms") + MINUTE)


def features_of(counts: DataFrame) -> DataFrame:
    """OP-28, from `open_counts`."""
    sums = [F.sum(f"{b}_count").alias(f"{b}_count") for b in BEHAVIORS]
    out = counts.groupBy("window_start_ms", "user_id").agg(F.sum(sum((F.col(f"{b}_count") for b in BEHAVIORS), F.lit(0))).alias("event_count"), *sums, F.countDistinct("item_id").alias("distinct_items"))
    out = out.withColumn("window_start", window_label(F.col("window_start_ms"))).withColumn("window_end", window_label(F.col("window_start_ms") + MINUTE))
    out = out.withColumn("feature_id", sha_of("|", F.lit("USER_FEATURES_1M"), "user_id", "window_start"))
    return out.withColumn("feature_version", F.col("window_start_ms") + MINUTE).withColumn("record_version", F.col("feature_version"))


def clock_of(tops: dict[str, int], seen: dict[str, int], shards: tuple[str, ...], started: int, now: int, delay_ms: int, idle_ms: int | None) -> int | None:
    """The time up to which windows are complete: the watermark of the slowest shard of those that are declared or have come.

    One from which nothing has come for `idle_ms` holds up nothing; one that hasn't come at all holds up
    everything until then. None where no shard says anything.
    """
    active = [s for s in {*shards, *tops} if idle_ms is None or now - seen.get(s, started) < idle_ms]
    return min(tops[s] for s in active) - delay_ms if active and all(s in tops for s in active) else None


class Job:
    """What is done with each batch of `marked` rows, or of `deduplicated` ones, whose ids and carts a state store has looked up. The state between
    batches is the last commit: `shards` (largest event time and last batch's time of each), `closed`, `parts`, the folders of counts whose windows
    are open, with their first and last hour, and `raw` and `cart`, the folders with ids and changes of carts that are remembered, with their last
    batch's time: those of the sinks themselves, and one into which those of many batches were put together."""

    def __init__(self, path: str, delay_ms: int = 5000, shards: tuple[str, ...] = (), idle_ms: int | None = None, at_ms: Column | None = None, after: Callable[[str], None] | None = None, retention_ms: int = RETENTION_MS):
        self.path, self.delay_ms, self.shards, self.idle_ms, self.at_ms, self.after, self.retention_ms = path, delay_ms, shards, idle_ms, at_ms, after, retention_ms

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        spark.conf.set(*CACHE_CONF)  # the query's own session
        commits = Commits(spark, f"{self.path}/commits")
        done, state = commits.last()
        if done is not None and done >= number:
            return  # ran before, to its commit
        state = {"started": None, "closed": None, "shards": {}, "parts": [], "dropped": [], "raw": [], "cart": []} | (state or {})
        keyed = "change" in batch.columns
        kept = batch.persist() if keyed else None
        stretches = E.stretch_tops(batch, ["shard"], F.max("now").alias("now")).persist()  # a row per stretch of arrivals
        try:
            news = stretches.groupBy("shard").agg(F.max("__most").alias("top"), F.max("now").alias("now")).collect()  # a row per shard
            now = max((r.now for r in news), default=state["started"] or 0)
            started = state["started"] if state["started"] is not None else now
            tops, seen = ({s: x[k] for s, x in state["shards"].items()} for k in (0, 1))
            held = {s: t for s, t in tops.items() if t is not None}
            for r in news:
                if r.shard is not None:
                    tops[r.shard], seen[r.shard] = max((t for t in (tops.get(r.shard), r.top) if t is not None), default=None), r.now
            clock = clock_of({s: t for s, t in tops.items() if t is not None}, seen, self.shards, started, now, self.delay_ms, self.idle_ms)
            closed = max((t for t in (clock, state["closed"]) if t is not None), default=None)
            rows, live, gone = classified(batch.where("status <> 'BEAT'"), held, state["closed"], self.delay_ms, stretches), {}, []
            changed, accepted, come = batch, rows.where("status IN ('ON_TIME', 'LATE')"), any(r.shard is not None for r in news)  # else there are heartbeats alone
            if not keyed:
                for sink in HELD:
                    live[sink] = [p for p in state[sink] if p[1] > now - self.retention_ms]
                    gone += [p[0] for p in state[sink] if p not in live[sink]]
                kept = accepted = self._unique(rows, live["raw"] if come else [], now).persist()
                changed = newer_carts(accepted, self._held(spark, "cart", live["cart"] if come else [], now))
                rows = accepted.unionByName(batch.where("status = 'INVALID'"))
            self._write(E.raw_projection(accepted), "raw", number)  # what is kept is there then, and the others read it at once
            with ThreadPoolExecutor() as pool:  # left when all have ended, so none writes on beside a batch that runs again
                others = [self._beside(pool, quality_rows(rows, self.at_ms), "quality", number), self._beside(pool, cart_changes(changed), "cart", number)]
                parts, dropped = self._windows(accepted, state, closed, number, pool)
                for other in others:
                    other.result()
            for sink in live:
                live[sink] += [[f"{sink}/batch={number}", now]] if come else []
                if len(live[sink]) > PARTS:
                    gone += [p[0] for p in live[sink]]
                    live[sink] = [self._merged(spark, sink, live[sink], now, number)]
            dropped += [folder for folder in gone if folder.startswith("held/")]  # sinks stay
            commits.put(number, {"started": started, "closed": closed, "shards": {s: [tops[s], seen[s]] for s in tops}, "parts": parts, "dropped": dropped, **live})
            for folder in state["dropped"]:  # neither this commit nor the one before names it
                commits.remove(folder)
        finally:
            stretches.unpersist()
            if kept is not None:
                kept.unpersist()

    def _held(self, spark: SparkSession, sink: str, parts: list, now: int) -> DataFrame:
        """What is remembered of a sink's rows."""
        found, names = nothing(spark, HELD[sink]), [c.split()[0] for c in HELD[sink].split(", ")]
        for folder, at in parts:
            merged = folder.startswith("held/")
            rows = spark.read.schema(HELD[sink] if merged else SINKS[sink]).parquet(f"{self.path}/{folder}")
            rows = rows.where(F.col("now") > now - self.retention_ms) if merged else rows.withColumn("now", F.lit(at).cast("long"))
            found = found.unionByName(rows.select(*names))
        return found

    def _unique(self, rows: DataFrame, parts: list, now: int) -> DataFrame:
        """OP-34, 46: the first of the valid rows with an id, by arrival, if its id isn't remembered."""
        first = E.keep_first(rows.where("status IN ('ON_TIME', 'LATE')"), *ARRIVAL)
        return first.join(self._held(rows.sparkSession, "raw", parts, now), "event_id", "left_anti").select(*rows.columns) if parts else first

    def _merged(self, spark: SparkSession, sink: str, parts: list, now: int, number: int) -> list:
        """One folder of what is remembered in many; of a cart the last change."""
        rows, folder = self._held(spark, sink, parts, now), f"held/{sink}-{number}"
        rows = E.latest_version(rows, ["user_id", "item_id"], "change") if sink == "cart" else rows
        rows.write.mode("overwrite").parquet(f"{self.path}/{folder}")
        return [folder, max(p[1] for p in parts)]

    def _write(self, rows: DataFrame, sink: str, number: int) -> None:
        rows.select(*[c.split()[0] for c in SINKS[sink].split(", ")]).write.mode("overwrite").parquet(f"{self.path}/{sink}/batch={number}")
        if self.after:
            self.after(sink)

    def _beside(self, pool: Executor, rows: DataFrame, sink: str, number: int) -> Future:
        """`_write` while others write."""
        return pool.submit(inheritable_thread_target(rows.sparkSession)(self._write), rows, sink, number)

    def _windows(self, rows: DataFrame, state: dict, closed: int | None, number: int, pool: Executor) -> tuple[list, list]:
        """Add the batch's counts to the open ones, write the windows that close, and return the folders that stay and those that go."""
        spark, parts, gone = rows.sparkSession, list(state["parts"]), []
        new = f"parts/run=batch-{number}"
        self._write_counts(open_counts(rows), new)
        ends = spark.read.schema(_PART).parquet(f"{self.path}/{new}").agg(F.min("window_start_ms"), F.max("window_start_ms")).first()
        if ends[0] is not None:
            parts.append([new, *(t // HOUR for t in ends)])
        before = state["closed"]
        if closed is not None and closed != before:
            due = self._counts(spark, parts, before, closed)
            features = self._beside(pool, features_of(due), "features", number)
            self._write(metrics_of(due), "metrics", number)
            features.result()
        if closed is not None:
            gone += [p for p in parts if (p[2] + 1) * HOUR <= closed]
        parts = [p for p in parts if p not in gone]
        if len(parts) > PARTS:
            merged = f"parts/run=merged-{number}"
            sums = self._counts(spark, parts, closed, None).groupBy("window_start_ms", "item_id", "source_category_id", "user_id").agg(*[F.sum(f"{b}_count").alias(f"{b}_count") for b in BEHAVIORS], F.min("replay_run_id").alias("replay_run_id"))
            self._write_counts(sums, merged)
            gone, parts = gone + parts, [[merged, min(p[1] for p in parts), max(p[2] for p in parts)]]
        return parts, [p[0] for p in gone]

    def _write_counts(self, counts: DataFrame, folder: str) -> None:
        """Files in order of time, so that readers skip what lies outside theirs; a folder for each hour would make as many files a task as a batch spans hours."""
        counts.sortWithinPartitions("window_start_ms").write.mode("overwrite").parquet(f"{self.path}/{folder}")

    def _counts(self, spark: SparkSession, parts: list, after: int | None, upto: int | None) -> DataFrame:
        """The counts of windows that end after `after` and not after `upto`; only the folders and stretches of files of that time are read."""
        first = -(1 << 62) if after is None else (after - MINUTE) // HOUR
        last = (1 << 62) if upto is None else upto // HOUR
        folders = [f"{self.path}/{p[0]}" for p in parts if p[1] <= last and p[2] >= first]
        if not folders:
            return nothing(spark, _PART)
        found, start = spark.read.schema(_PART).parquet(*folders), F.col("window_start_ms")
        found = found if after is None else found.where(start > after - MINUTE)
        return found if upto is None else found.where(start <= upto - MINUTE)


def start_job(rows: DataFrame, job: Job, checkpoint: str, interval_ms: int | None = None) -> StreamingQuery:
    """Start the query over `marked` or `deduplicated` rows: all that is there is worked off and the query ends; with an interval it goes on."""
    rows.sparkSession.conf.set(*STATE_CONF)
    given = {"availableNow": True} if interval_ms is None else {"processingTime": f"{interval_ms} milliseconds"}
    return rows.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint).outputMode("append").trigger(**given).start()


def run_job(spark: SparkSession, log: str, path: str, config: RuntimeConfig, shard: Column | None = None, files_per_trigger: int = 1000, after: Callable[[str], None] | None = None) -> StreamingQuery:
    """OP-47, 48, 63: the whole job over a log, by its settings, into the folders of `SINKS` under `path`.

    A bounded job ends when the log is worked off, and no shard is idle in it; else it
    looks for more every checkpoint interval. Started again, it goes on where it was.
    """
    events = event_stream(spark, log, files_per_trigger)
    events = events if config.bounded else with_heartbeats(events)
    job = Job(path, config.watermark_delay_ms, config.shards, None if config.bounded else config.idle_timeout_ms, after=after, retention_ms=config.dedup_retention_hours * HOUR)
    return start_job(marked(events, shard), job, f"{config.checkpoint_dir.rstrip('/')}/job", None if config.bounded else config.checkpoint_interval_ms)


def supervised(start: Callable[[], StreamingQuery], config: RuntimeConfig) -> int:
    """OP-47: run a job to its end, started again after a fixed delay when it fails, as often as `restart_attempts`; returns how often it was."""
    for attempt in range(config.restart_attempts + 1):
        try:
            start().awaitTermination()
            return attempt
        except StreamingQueryException:
            if attempt == config.restart_attempts:
                raise
            time.sleep(config.restart_delay_ms / 1000)
    raise AssertionError("unreachable")


def job_rows(spark: SparkSession, path: str, sink: str) -> DataFrame:
    """What a job's committed batches wrote to a sink."""
    return read_sink(spark, path, sink, SINKS[sink]).drop("batch")


def job_windows(spark: SparkSession, path: str, sink: str, flush: bool = False) -> DataFrame:
    """OP-44: metrics or features of the windows that have closed; of those still open too with `flush`, as they are now."""
    rows = job_rows(spark, path, sink)
    _, state = Commits(spark, f"{path}/commits").last()
    if not flush or state is None:
        return rows
    still = Job(path)._counts(spark, state["parts"], state["closed"], None)
    return rows.unionByName((metrics_of if sink == "metrics" else features_of)(still).select(*rows.columns))


def job_carts(spark: SparkSession, path: str, config: RuntimeConfig) -> DataFrame:
    """OP-18: the active carts by a job's change log and its settings; of an item the change with the highest number counts."""
    changes = job_rows(spark, path, "cart")
    last = E.latest_version(changes, ["user_id", "item_id"], "change")
    added = job_rows(spark, path, "raw").where("behavior_type = 'cart'").select("user_id", F.col("event_time_ms").alias("last_updated_at_ms"))
    return S.active_cart(last.drop("source_sequence", "change"), added, config.cart_ttl_seconds)


def job_features(spark: SparkSession, path: str, config: RuntimeConfig) -> DataFrame:
    """OP-19: the online features by a job's features and its settings."""
    return S.online_features(job_windows(spark, path, "features", config.flush_open_windows), ttl_seconds=config.feature_ttl_seconds)


def plan_of(df: DataFrame) -> str:
    """OP-50: the plan without running it; of a streaming frame, the plan of its logical form."""
    execution = df._jdf.queryExecution()
    return execution.logical().toString() if df.isStreaming else execution.explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def log_columns() -> list[str]:
    return [c.split()[0] for c in EVENT.split(", ")]
