"""Queries of the streaming job over the `events` table and their SQL (OP-7, 14, 15, 17, 41..49)."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.config import RuntimeConfig
from weftline.operators import events as E
from weftline.operators import tables as T
from weftline.plans.behavior import MUTATIONS, ORACLE, replayed
from weftline.plans.scratch import scratch
from weftline.streaming import pipeline as P
from weftline.streaming.commits import read_sink
from weftline.streaming.state import marked

#: What far shards are apart, and what late carts come behind, in ms and in arrivals.
APART, BEHIND = 360_000_000, 1_500_000_000
#: Files of a batch: a part is one batch, however many files it has, as the SQL numbers a cart's changes by part.
PART_FILES = (1 << 31) - 1
EVENT_COLUMNS = ("event_id", "user_id", "item_id", "category_id", "behavior_type", "event_time_ms", "source_sequence")


def shard() -> Column:
    return F.col("user_id") % 2


def log_of(rows: DataFrame, path: str) -> None:
    """All parts of a log, each in a folder, in one pass over the source."""
    rows.select("part", *P.log_columns()).write.partitionBy("part").parquet(path)


def arrive(spark: SparkSession, source: str, log: str) -> None:
    """Put the files of a part, if it has rows, into the log."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(log).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(log))
    for status in files.listStatus(path(source)) if files.exists(path(source)) else []:
        if not files.rename(status.getPath(), path(log, f"{path(source).getName()}-{status.getPath().getName()}")):
            raise RuntimeError(f"{status.getPath()} could not be put into the log")


def _two_runs(rows: DataFrame) -> DataFrame:
    return rows.withColumn("part", F.when(F.col("replay_run_id") == "a", 0).otherwise(1))


def _far_shards(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_time_ms", F.col("event_time_ms") + F.when(shard() == 1, APART).otherwise(0))


def _three_parts(rows: DataFrame) -> DataFrame:
    """Two far shards; the first run in two halves, then the second run with the first run's carts of some users, which are older than what came before."""
    rows = _far_shards(rows).withColumn("arrival", F.col("arrival") + F.when((F.col("behavior_type") == "cart") & (F.col("user_id") % 3 == 0), BEHIND).otherwise(0))
    half = F.broadcast(rows.agg(F.max("source_sequence").alias("last")))  # one row
    part = F.when(F.col("arrival") >= 1_000_000_000, 2).when(F.col("arrival") * 2 >= F.col("last"), 1).otherwise(0)
    return rows.join(half).withColumn("part", part)


def _shard_after_shard(rows: DataFrame) -> DataFrame:
    return _far_shards(rows.where("replay_run_id = 'a'")).withColumn("part", shard())


def _thirds(rows: DataFrame) -> DataFrame:
    rows = _far_shards(rows.where("replay_run_id = 'a'"))
    last = F.broadcast(rows.agg(F.max("arrival").alias("last")))  # one row
    return rows.join(last).withColumn("part", F.floor(F.col("arrival") * 3 / (F.col("last") + 1)))


#: How the log comes: the `part` of each row, and how many there are, with a restart between two parts; the shards that are declared, and whether rows are dealt to shards.
SETUPS: dict[str, tuple[Callable[[DataFrame], DataFrame], int, tuple[str, ...]]] = {
    "once": (lambda rows: rows.withColumn("part", F.lit(0)), 1, ()),
    "restarted": (_two_runs, 2, ()),
    "shards": (_three_parts, 3, ("0", "1")),
    "late_shard": (_shard_after_shard, 2, ("0", "1")),
    "idle_shard": (_thirds, 3, ("0", "1", "2")),
}


@lru_cache(maxsize=64)
def _done(spark: SparkSession, app: str, sf_dir: str, setup: str) -> str:
    """Where the job over a setup's log has written; a session runs it once."""
    root = scratch(spark, f"job-{setup}")
    dealt, parts, shards = SETUPS[setup]
    log_of(dealt(replayed(spark, sf_dir, spread=True)), f"{root}/parts")
    for k in range(parts):
        arrive(spark, f"{root}/parts/part={k}", f"{root}/log")
        # Time goes on by a minute a part, and a shard is idle after half of one.
        idle, now = (30_000, F.lit(60_000 * k)) if setup == "idle_shard" else (None, None)
        log = P.event_stream(spark, f"{root}/log", PART_FILES)
        rows = marked(log, shard() if shards else None, now=now)
        job = P.Job(f"{root}/out", shards=shards, idle_ms=idle, at_ms=F.col("event_time_ms") + 7)
        P.start_job(rows, job, f"{root}/checkpoint").awaitTermination()
    return f"{root}/out"


def sink(spark: SparkSession, sf_dir: str, setup: str, name: str) -> DataFrame:
    return P.job_rows(spark, _done(spark, spark.sparkContext.applicationId, sf_dir, setup), name)


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = sink(spark, sf_dir, "once", "quality").where("quality_type = 'LATE'").select("event_id", F.lit("LATE").alias("status"))
    return sink(spark, sf_dir, "once", "raw").join(late, "event_id", "left").select(*EVENT_COLUMNS, F.coalesce("status", F.lit("ON_TIME")).alias("status"))


def _carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest change of each cart entry."""
    return E.latest_version(sink(spark, sf_dir, "once", "cart"), ["user_id", "item_id"], "change")


def _latest_carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("operation") == "DELETE", "buy").otherwise("cart").alias("behavior_type")
    return _carts(spark, sf_dir).select("user_id", "item_id", "category_id", kind, F.col("last_updated_at_ms").alias("event_time_ms"), "source_sequence")


@lru_cache(maxsize=16)
def _carts_served(spark: SparkSession, app: str, sf_dir: str) -> T.BucketTable:
    """The job's cart changes, applied batch by batch to a table by user; the second batch comes twice."""
    changes = read_sink(spark, _done(spark, app, sf_dir, "shards"), "cart", P.SINKS["cart"])
    table = T.cart_table(spark, scratch(spark, "carts"))
    for number, batch in enumerate((0, 1, 1, 2)):
        table.apply(changes.where(F.col("batch") == batch), number)
    return table


def _one_cart(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _carts_served(spark, spark.sparkContext.applicationId, sf_dir)
    first = table.read().agg(F.min("user_id")).first()[0]
    return table.read(1 if first is None else first)


METRICS = "window_start_ms, item_id, source_category_id, pv_count, cart_count, fav_count, buy_count, unique_users, replay_run_id, record_version"
FEATURES = "window_start_ms, user_id, event_count, pv_count, cart_count, fav_count, buy_count, distinct_items, feature_id, feature_version"


def _columns(text: str) -> list[str | Column]:
    return text.split(", ")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "stream_user_features": lambda s, d: sink(s, d, "once", "features").select(*_columns(FEATURES)),
        "stream_quality": lambda s, d: sink(s, d, "once", "quality"),
        "stream_accepted": _accepted,
        "stream_item_metrics": lambda s, d: sink(s, d, "once", "metrics").select(*_columns(METRICS)),
        "stream_cart_latest": _latest_carts,
        "stream_cart_mutations": lambda s, d: _carts(s, d).drop("source_sequence", "change"),
        "stream_fan_out_raw": lambda s, d: sink(s, d, "once", "raw"),
        "stream_restarted_raw": lambda s, d: sink(s, d, "restarted", "raw"),
        "stream_sharded_metrics": lambda s, d: sink(s, d, "idle_shard", "metrics").select(*_columns(METRICS)),
        "stream_late_shard": lambda s, d: sink(s, d, "late_shard", "metrics").select(*_columns(METRICS)),
        "stream_idle_shard": lambda s, d: sink(s, d, "idle_shard", "features").select(*_columns(FEATURES)),
        "job_raw": lambda s, d: sink(s, d, "shards", "raw"),
        "job_metrics": lambda s, d: sink(s, d, "shards", "metrics").select(*_columns(METRICS)),
        "job_features": lambda s, d: sink(s, d, "shards", "features").select(*_columns(FEATURES)),
        "job_quality": lambda s, d: sink(s, d, "shards", "quality"),
        "job_cart": lambda s, d: sink(s, d, "shards", "cart"),
        "served_carts": lambda s, d: _carts_served(s, s.sparkContext.applicationId, d).read(),
        "served_cart_lookup": _one_cart,
    }


_CLOSED = "window_start_ms + 60000 <= (SELECT max(event_time_ms) - 5000 FROM ev)"


def _shards_sql(where: str, arrival: str) -> str:
    """Two far shards, each with its own watermark, and what follows from them, as `jrows`, `juniq`, `jmetrics` and `jfeatures`."""
    return f"""
, two AS (
  SELECT * EXCLUDE (event_time_ms, arrival), event_time_ms + CASE WHEN user_id % 2 = 1 THEN {APART} ELSE 0 END AS event_time_ms, {arrival} AS arrival FROM ev WHERE {where}),
jrows AS (
  SELECT *, CASE WHEN event_id IS NULL OR trim(event_id) = '' THEN 'INVALID_EVENT_ID' WHEN user_id <= 0 OR item_id <= 0 OR category_id <= 0 THEN 'INVALID_IDENTIFIER'
                 WHEN event_time_ms <= 0 THEN 'INVALID_EVENT_TIME' WHEN behavior_type NOT IN ('pv', 'cart', 'fav', 'buy') THEN 'INVALID_BEHAVIOR_TYPE' END AS validation_reason,
         max(event_time_ms) OVER (PARTITION BY user_id % 2 ORDER BY arrival, source_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 5000 AS watermark_ms,
         CASE WHEN arrival >= 1000000000 THEN 2 WHEN arrival * 2 >= (SELECT max(source_sequence) FROM ev) THEN 1 ELSE 0 END AS part
  FROM two),
juniq AS (
  SELECT *, coalesce(event_time_ms <= watermark_ms, false) AS is_late, event_time_ms - event_time_ms % 60000 AS window_start_ms FROM jrows WHERE validation_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arrival, source_sequence) = 1),
jclosed AS (SELECT * FROM juniq WHERE NOT is_late AND window_start_ms + 60000 <= (SELECT min(top) - 5000 FROM (SELECT max(event_time_ms) AS top FROM two GROUP BY user_id % 2))),
jmetrics AS (
  SELECT window_start_ms, item_id, category_id AS source_category_id, count(*) FILTER (behavior_type = 'pv') AS pv_count, count(*) FILTER (behavior_type = 'cart') AS cart_count,
         count(*) FILTER (behavior_type = 'fav') AS fav_count, count(*) FILTER (behavior_type = 'buy') AS buy_count, count(DISTINCT user_id) AS unique_users, min(replay_run_id) AS replay_run_id, window_start_ms + 60000 AS record_version
  FROM jclosed GROUP BY window_start_ms, item_id, category_id),
jfeatures AS (
  SELECT window_start_ms, user_id, count(*) AS event_count, count(*) FILTER (behavior_type = 'pv') AS pv_count, count(*) FILTER (behavior_type = 'cart') AS cart_count,
         count(*) FILTER (behavior_type = 'fav') AS fav_count, count(*) FILTER (behavior_type = 'buy') AS buy_count, count(DISTINCT item_id) AS distinct_items,
         sha256('USER_FEATURES_1M|' || user_id || '|' || strftime(make_timestamp(window_start_ms * 1000), '%Y-%m-%d %H:%M:%S.%g')) AS feature_id, window_start_ms + 60000 AS feature_version
  FROM jclosed GROUP BY window_start_ms, user_id)
"""


_JOB = _shards_sql("true", f"arrival + CASE WHEN behavior_type = 'cart' AND user_id % 3 = 0 THEN {BEHIND} ELSE 0 END")
_ONE_RUN = _shards_sql("replay_run_id = 'a'", "arrival")
_JOB_QUALITY = """
SELECT quality_type, event_id, user_id, item_id, category_id, behavior_type, event_time_ms, source_sequence, replay_run_id, reason_code,
       sha256(quality_type || '|' || coalesce(event_id, '') || '|' || replay_run_id || '|' || source_sequence || '|' || reason_code) AS quality_event_id, reason_message, event_time_ms + 7 AS observed_at_ms, event_time_ms + 7 AS record_version
FROM (
  SELECT 'INVALID' AS quality_type, * EXCLUDE (validation_reason), validation_reason AS reason_code, 'event failed the source-faithful semantic contract' AS reason_message FROM jrows WHERE validation_reason IS NOT NULL
  UNION ALL BY NAME
  SELECT 'LATE' AS quality_type, * EXCLUDE (validation_reason, is_late, window_start_ms), 'LATE_FOR_AGGREGATION' AS reason_code, 'event_time is at or behind the current watermark' AS reason_message FROM juniq WHERE is_late)
"""
_JOB_CART = """
, versions AS (SELECT *, event_time_ms::HUGEINT * 10000000000 + source_sequence AS version FROM juniq WHERE behavior_type IN ('cart', 'buy')),
newest AS (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY user_id, item_id, part ORDER BY version DESC) = 1),
changed AS (SELECT * FROM newest QUALIFY version > coalesce(max(version) OVER (PARTITION BY user_id, item_id ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1))
SELECT CASE behavior_type WHEN 'buy' THEN 'DELETE' ELSE 'UPSERT' END AS operation, user_id, item_id, category_id, CASE behavior_type WHEN 'buy' THEN 0 ELSE event_time_ms END AS added_at_ms, event_time_ms AS last_updated_at_ms,
       source_sequence, row_number() OVER (PARTITION BY user_id, item_id ORDER BY part) AS change
FROM changed
"""

_SERVED = (
    _JOB_CART.replace("FROM changed\n", "FROM changed)").replace("\nSELECT CASE behavior_type", ",\nnumbered AS (SELECT CASE behavior_type")
    + " SELECT user_id, item_id, operation, category_id, added_at_ms, last_updated_at_ms, change FROM numbered n WHERE change = (SELECT max(change) FROM numbered m WHERE m.user_id = n.user_id AND m.item_id = n.item_id)"
)


def oracle_sql() -> dict[str, str]:
    columns = ", ".join(EVENT_COLUMNS)
    selects = {
        "stream_user_features": f"SELECT {FEATURES} FROM features WHERE {_CLOSED}",
        "stream_quality": "SELECT * FROM quality",
        "stream_accepted": f"SELECT {columns}, CASE WHEN is_late THEN 'LATE' ELSE 'ON_TIME' END AS status FROM uniq",
        "stream_item_metrics": f"SELECT {METRICS} FROM metrics WHERE {_CLOSED}",
        "stream_cart_latest": "SELECT * FROM cart",
        "stream_cart_mutations": MUTATIONS,
        "stream_fan_out_raw": f"SELECT {columns}, replay_run_id, event_time_ms AS record_version FROM uniq",
        "stream_restarted_raw": f"SELECT {columns}, replay_run_id, event_time_ms AS record_version FROM uniq",
        "stream_sharded_metrics": f"{_ONE_RUN} SELECT * FROM jmetrics",
        "stream_late_shard": f"{_ONE_RUN} SELECT * FROM jmetrics",
        "stream_idle_shard": f"{_ONE_RUN} SELECT * FROM jfeatures",
        "job_raw": f"{_JOB} SELECT {columns}, replay_run_id, event_time_ms AS record_version FROM juniq",
        "job_metrics": f"{_JOB} SELECT * FROM jmetrics",
        "job_features": f"{_JOB} SELECT * FROM jfeatures",
        "job_quality": _JOB + _JOB_QUALITY,
        "job_cart": _JOB + _JOB_CART,
        "served_carts": f"{_JOB}{_SERVED}",
        "served_cart_lookup": f"{_JOB}{_SERVED} AND user_id = (SELECT min(user_id) FROM changed)",
    }
    return {name: ORACLE + sql for name, sql in selects.items()}
