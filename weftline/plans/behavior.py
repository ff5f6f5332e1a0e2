"""The behavior stream over the `events` table, in order of arrival, as two replays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.scalar import event_identity


def source_events(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    kind = F.col("event_type")
    behavior = F.when(kind == "view", "pv").when(kind == "click", "fav").when(kind == "purchase", "buy").when(kind == "signup", "cart").otherwise(kind)
    item = F.get_json_object("props", "$.k").cast("bigint")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return (events.repartition("event_id") if spread else events).select(
        F.col("user_id").cast("bigint").alias("user_id"), item.alias("item_id"), (F.pmod(item, F.lit(10)) + 1).cast("bigint").alias("category_id"), behavior.alias("behavior_type"),
        (F.unix_seconds(F.col("ts").cast("timestamp")) * 1000).alias("event_time_ms"), F.col("event_id").cast("bigint").alias("source_sequence"),
    )


def replayed(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Two replays, the second after the first; some rows arrive 40 places behind. With `spread` the source's rows are dealt to all tasks first, as one
    row group of a file is one task's, and so is all that is made of it."""
    runs = F.explode(F.array(F.struct(F.lit(0).cast("bigint").alias("o"), F.lit("a").alias("run")), F.struct(F.lit(1).cast("bigint").alias("o"), F.lit("b").alias("run"))))
    rows = source_events(spark, sf_dir, spread).withColumn("r", runs)
    behind = F.when(F.col("source_sequence") % 17 == 0, 40).otherwise(0)
    rows = rows.withColumn("arrival", F.col("r.o") * 1_000_000_000 + F.col("source_sequence") + behind).withColumn("replay_run_id", F.col("r.run")).drop("r")
    return rows.withColumn("event_id", event_identity())


ORACLE = r"""
WITH src AS (
  SELECT user_id::BIGINT AS user_id, json_extract_string(props, '$.k')::BIGINT AS item_id, json_extract_string(props, '$.k')::BIGINT % 10 + 1 AS category_id,
         CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'fav' WHEN 'purchase' THEN 'buy' WHEN 'signup' THEN 'cart' ELSE event_type END AS behavior_type,
         floor(epoch(ts))::BIGINT * 1000 AS event_time_ms, event_id::BIGINT AS source_sequence
  FROM events),
ev AS (
  SELECT src.*, run AS replay_run_id, o * 1000000000 + source_sequence + CASE WHEN source_sequence % 17 = 0 THEN 40 ELSE 0 END AS arrival,
         sha256(user_id || chr(31) || item_id || chr(31) || category_id || chr(31) || behavior_type || chr(31) || (event_time_ms // 1000) || chr(31) || source_sequence) AS event_id
  FROM src CROSS JOIN (VALUES (0, 'a'), (1, 'b')) AS r(o, run)),
cls AS (
  SELECT *, CASE WHEN event_id IS NULL OR trim(event_id) = '' THEN 'INVALID_EVENT_ID' WHEN user_id <= 0 OR item_id <= 0 OR category_id <= 0 THEN 'INVALID_IDENTIFIER'
                 WHEN event_time_ms <= 0 THEN 'INVALID_EVENT_TIME' WHEN behavior_type NOT IN ('pv', 'cart', 'fav', 'buy') THEN 'INVALID_BEHAVIOR_TYPE' END AS validation_reason,
         max(event_time_ms) OVER (ORDER BY arrival, source_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 5000 AS watermark_ms
  FROM ev),
uniq AS (
  SELECT *, coalesce(event_time_ms <= watermark_ms, false) AS is_late FROM cls WHERE validation_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arrival, source_sequence) = 1),
ontime AS (SELECT *, event_time_ms - event_time_ms % 60000 AS window_start_ms FROM uniq WHERE NOT is_late),
metrics AS (
  SELECT window_start_ms, item_id, category_id AS source_category_id, count(*) FILTER (behavior_type = 'pv') AS pv_count, count(*) FILTER (behavior_type = 'cart') AS cart_count,
         count(*) FILTER (behavior_type = 'fav') AS fav_count, count(*) FILTER (behavior_type = 'buy') AS buy_count, count(DISTINCT user_id) AS unique_users, min(replay_run_id) AS replay_run_id,
         strftime(make_timestamp(window_start_ms * 1000), '%Y-%m-%d %H:%M:%S.%g') AS window_start, window_start_ms + 60000 AS record_version
  FROM ontime GROUP BY ALL),
features AS (
  SELECT *, sha256('USER_FEATURES_1M|' || user_id || '|' || window_start) AS feature_id FROM (
  SELECT window_start_ms, user_id, count(*) AS event_count, count(*) FILTER (behavior_type = 'pv') AS pv_count, count(*) FILTER (behavior_type = 'cart') AS cart_count,
         count(*) FILTER (behavior_type = 'fav') AS fav_count, count(*) FILTER (behavior_type = 'buy') AS buy_count, count(DISTINCT item_id) AS distinct_items,
         strftime(make_timestamp(window_start_ms * 1000), '%Y-%m-%d %H:%M:%S.%g') AS window_start, strftime(make_timestamp((window_start_ms + 60000) * 1000), '%Y-%m-%d %H:%M:%S.%g') AS window_end,
         window_start_ms + 60000 AS feature_version, window_start_ms + 60000 AS record_version
  FROM ontime GROUP BY ALL)),
quality AS (
  SELECT *, event_time_ms + 7 AS observed_at_ms, event_time_ms + 7 AS record_version, sha256(quality_type || '|' || coalesce(event_id, '') || '|' || replay_run_id || '|' || source_sequence || '|' || reason_code) AS quality_event_id FROM (
  SELECT 'INVALID' AS quality_type, event_id, user_id, item_id, category_id, behavior_type, event_time_ms, source_sequence, replay_run_id, validation_reason AS reason_code, 'event failed the source-faithful semantic contract' AS reason_message FROM cls WHERE validation_reason IS NOT NULL
  UNION ALL
  SELECT 'LATE', event_id, user_id, item_id, category_id, behavior_type, event_time_ms, source_sequence, replay_run_id, 'LATE_FOR_AGGREGATION', 'event_time is at or behind the current watermark' FROM uniq WHERE is_late)),
cart AS (
  SELECT user_id, item_id, category_id, behavior_type, event_time_ms, source_sequence FROM uniq WHERE behavior_type IN ('cart', 'buy')
  QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY event_time_ms DESC, source_sequence DESC) = 1)
"""
MUTATIONS = "SELECT CASE behavior_type WHEN 'buy' THEN 'DELETE' ELSE 'UPSERT' END AS operation, user_id, item_id, category_id, CASE behavior_type WHEN 'buy' THEN 0 ELSE event_time_ms END AS added_at_ms, event_time_ms AS last_updated_at_ms FROM cart"
