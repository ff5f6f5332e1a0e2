"""Validation, deduplication, lateness, metrics, features, quality and accounting (OP-20..24, 27, 28, 32..35, 40..46)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.config import BEHAVIORS
from weftline.functions.scalar import MINUTE, behavior_count, minute_start, sha_of, window_label

#: Arrivals that share one running maximum; the maxima before them come from a table with a row per stretch.
STRETCH = 1 << 17

# The codes and messages of quality rows.
LATE_REASON = "LATE_FOR_AGGREGATION"
INVALID_MESSAGE = "event failed the source-faithful semantic contract"
LATE_MESSAGE = "event_time is at or behind the current watermark"


def validation_reason() -> Column:
    """OP-20: the first rule that is broken."""
    return (
        F.when(F.col("event_id").isNull() | (F.length(F.trim("event_id")) == 0), "INVALID_EVENT_ID")
        .when((F.col("user_id") <= 0) | (F.col("item_id") <= 0) | (F.col("category_id") <= 0), "INVALID_IDENTIFIER")
        .when(F.col("event_time_ms") <= 0, "INVALID_EVENT_TIME")
        .when(~F.col("behavior_type").isin(*BEHAVIORS), "INVALID_BEHAVIOR_TYPE")
    )


def classify(events: DataFrame) -> DataFrame:
    return events.withColumn("validation_reason", validation_reason())


def valid_events(events: DataFrame) -> DataFrame:
    """OP-21."""
    return classify(events).where("validation_reason IS NULL").drop("validation_reason")


def keep_first(events: DataFrame, *order: str) -> DataFrame:
    """OP-34, 46: the first observed row of each event_id; each task keeps its own first before rows are shuffled."""
    order = order or ("arrival", "source_sequence")
    rank = F.row_number().over(Window.partitionBy("event_id").orderBy(*order))
    return events.withColumn("__nth", rank).where("__nth = 1").drop("__nth")


def stretch_tops(events: DataFrame, by: list[str] | None = None, *more: Column) -> DataFrame:
    """__most, the largest event time of each stretch of arrivals and `by`, and what else is given; a row per stretch."""
    return events.groupBy(*(by or []), F.floor(F.col("arrival") / STRETCH).alias("__stretch")).agg(F.max("event_time_ms").alias("__most"), *more)


def with_running_top(events: DataFrame, by: list[str] | None = None, tops: DataFrame | None = None) -> DataFrame:
    """Add __top, the largest event time of all rows that arrived earlier, of the same `by` if given; null before any.

    A running maximum over the arrival order, done by stretches of arrivals: the
    maximum of each stretch, a prefix maximum over that small table, and a
    running maximum within a stretch. No task holds the whole order. Rows without
    arrival come first. `tops` are the `stretch_tops` of the rows where they are there already.
    """
    by = by or []
    rows = events.withColumn("__stretch", F.floor(F.col("arrival") / STRETCH))
    tops = stretch_tops(events, by) if tops is None else tops
    before = Window.partitionBy(*by).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(*[F.col(c).alias(f"__of_{c}") for c in by], F.col("__stretch").alias("__of"), F.max("__most").over(before).alias("__before"))
    same = F.col("__stretch").eqNullSafe(F.col("__of"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    inside = Window.partitionBy(*by, "__stretch").orderBy("arrival", "source_sequence").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(tops, same).withColumn("__top", F.greatest("__before", F.max("event_time_ms").over(inside)))
    return rows.drop("__stretch", "__of", "__before", *[f"__of_{c}" for c in by])


def with_watermark(events: DataFrame, delay_ms: int = 5000) -> DataFrame:
    """OP-41: watermark_ms from all rows that arrived earlier; null before any."""
    return with_running_top(events).withColumn("watermark_ms", F.col("__top") - delay_ms).drop("__top")


def accepted(events: DataFrame, delay_ms: int = 5000) -> DataFrame:
    """OP-21, 34, 41: unique valid rows with the watermark of the whole source, invalid rows included."""
    marked = classify(with_watermark(events, delay_ms)).where("validation_reason IS NULL").drop("validation_reason")
    return keep_first(marked)


def is_late() -> Column:
    return F.coalesce(F.col("event_time_ms") <= F.col("watermark_ms"), F.lit(False))


def on_time(unique: DataFrame) -> DataFrame:
    """OP-42."""
    return unique.where(~is_late())


def late(unique: DataFrame) -> DataFrame:
    """OP-43: at the watermark counts as late."""
    return unique.where(is_late())


def raw_projection(unique: DataFrame) -> DataFrame:
    """OP-23."""
    return unique.select("event_id", "user_id", "item_id", "category_id", "behavior_type", "event_time_ms", "source_sequence", "replay_run_id", F.col("event_time_ms").alias("record_version"))


def item_metrics(rows: DataFrame) -> DataFrame:
    """OP-27, 44: one-minute windows by item and category."""
    start = minute_start()
    return (
        rows.groupBy(start.alias("window_start_ms"), "item_id", F.col("category_id").alias("source_category_id"))
        .agg(*map(behavior_count, BEHAVIORS), F.countDistinct("user_id").alias("unique_users"), F.min("replay_run_id").alias("replay_run_id"))
        .withColumn("window_start", window_label(F.col("window_start_ms")))
        .withColumn("record_version", F.col("window_start_ms") + MINUTE)
    )


def user_features(rows: DataFrame) -> DataFrame:
    """OP-28: one-minute windows by user with a stable id."""
    out = rows.groupBy(minute_start().alias("window_start_ms"), "user_id").agg(F.count(F.lit(1)).alias("event_count"), *map(behavior_count, BEHAVIORS), F.countDistinct("item_id").alias("distinct_items"))
    out = out.withColumn("window_start", window_label(F.col("window_start_ms"))).withColumn("window_end", window_label(F.col("window_start_ms") + MINUTE))
    out = out.withColumn("feature_id", sha_of("|", F.lit("USER_FEATURES_1M"), "user_id", "window_start"))
    return out.withColumn("feature_version", F.col("window_start_ms") + MINUTE).withColumn("record_version", F.col("feature_version"))


def closed_windows(windows: DataFrame, events: DataFrame, delay_ms: int = 5000, flush: bool = False) -> DataFrame:
    """OP-44: windows whose end the final watermark has reached; all with `flush`."""
    if flush:
        return windows
    top = events.agg((F.max("event_time_ms") - delay_ms).alias("__watermark"))
    return windows.join(F.broadcast(top), F.col("window_start_ms") + MINUTE <= F.col("__watermark")).drop("__watermark")


def observed(rows: DataFrame, at_ms: Column | None = None) -> DataFrame:
    """Add observed_at_ms, the whole second of observation unless given, and it as record_version."""
    now = F.unix_timestamp() * 1000 if at_ms is None else at_ms
    return rows.withColumn("observed_at_ms", now.cast("bigint")).withColumn("record_version", F.col("observed_at_ms"))


def quality_events(events: DataFrame, unique: DataFrame, at_ms: Column | None = None) -> DataFrame:
    """OP-40: invalid rows of every run, and late rows, which are unique, with their time of observation."""
    columns = ["event_id", "user_id", "item_id", "category_id", "behavior_type", "event_time_ms", "source_sequence", "replay_run_id"]
    invalid = classify(events).where("validation_reason IS NOT NULL").select(F.lit("INVALID").alias("quality_type"), *columns, F.col("validation_reason").alias("reason_code"))
    behind = late(unique).select(F.lit("LATE").alias("quality_type"), *columns, F.lit(LATE_REASON).alias("reason_code"))
    both = invalid.unionByName(behind)
    message = F.when(F.col("quality_type") == "LATE", LATE_MESSAGE).otherwise(INVALID_MESSAGE)
    return both.withColumn("quality_event_id", sha_of("|", "quality_type", F.coalesce("event_id", F.lit("")), "replay_run_id", "source_sequence", "reason_code")).withColumn("reason_message", message).transform(observed, at_ms)


def quality_summary(quality: DataFrame) -> DataFrame:
    """OP-32."""
    return quality.groupBy("quality_type").agg(F.count(F.lit(1)).alias("events"))


def accounting(events: DataFrame, unique: DataFrame, source_rows: int | None = None, rejected: int = 0) -> DataFrame:
    """OP-33: one row; it fails where the numbers can't be."""
    seen = classify(events).agg(F.count(F.lit(1)).alias("decoded"), F.count_if(F.col("validation_reason").isNotNull()).alias("invalid"))
    kept = unique.agg(F.count(F.lit(1)).alias("accepted_unique"), F.count_if(is_late()).alias("late"))
    out = seen.crossJoin(kept)  # one row each
    source = F.col("decoded") + rejected if source_rows is None else F.lit(source_rows)
    out = out.select(source.cast("bigint").alias("source_rows"), "decoded", F.lit(rejected).cast("bigint").alias("producer_rejected"), "invalid", (F.col("decoded") - F.col("invalid")).alias("valid"), "accepted_unique", (F.col("decoded") - F.col("invalid") - F.col("accepted_unique")).alias("duplicate"), "late", (F.col("accepted_unique") - F.col("late")).alias("on_time"))
    checked = F.when((F.col("duplicate") < 0) | (F.col("on_time") < 0), F.raise_error(F.lit("accounting does not add up"))).otherwise(F.col("on_time"))
    return out.withColumn("on_time", checked.cast("bigint"))


def latest_cart(unique: DataFrame) -> DataFrame:
    """OP-22, 35: the last cart or buy of each user and item, late rows included; combined before the shuffle."""
    order = F.struct("event_time_ms", "source_sequence")
    rows = unique.where(F.col("behavior_type").isin("cart", "buy"))
    return rows.groupBy("user_id", "item_id").agg(F.max_by(F.struct("category_id", "behavior_type", "event_time_ms", "source_sequence"), order).alias("r")).select("user_id", "item_id", "r.*")


def mutation_columns() -> list[Column]:
    buys, at = F.col("behavior_type") == "buy", F.col("event_time_ms")
    added = F.when(buys, F.lit(0).cast("bigint")).otherwise(at).alias("added_at_ms")
    return [F.when(buys, "DELETE").otherwise("UPSERT").alias("operation"), F.col("user_id"), F.col("item_id"), F.col("category_id"), added, at.alias("last_updated_at_ms")]


def cart_mutations(latest: DataFrame) -> DataFrame:
    """OP-24."""
    return latest.select(*mutation_columns())


def latest_version(rows: DataFrame, keys: list[str], version: str, tie: str | None = None) -> DataFrame:
    """OP-17: the greatest version of each key, null least, the last ingested at a tie; one aggregate, combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    order = F.struct(F.col(version).isNotNull(), version, *[F.col(tie).isNotNull(), F.col(tie)] if tie else [])
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")
