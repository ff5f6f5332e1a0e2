"""Sources: ordered CSV rows, parsing, HTTP-style ingress, Kafka and CDC (OP-1..13, 51)."""

from __future__ import annotations

import csv
import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.config import BEHAVIORS
from weftline.functions.scalar import event_identity

CSV_COLUMNS = ("user_id", "item_id", "category_id", "behavior_type", "timestamp")
BLANKS = " \t\n\r\u000b\u000c"

# The columns of each kind of message.
MESSAGES = {
    "raw": "event_id string, user_id long, item_id long, category_id long, behavior_type string, event_time_ms long, source_sequence long, replay_run_id string, record_version long",
    "metrics": "window_start string, item_id long, source_category_id long, pv_count long, cart_count long, fav_count long, buy_count long, unique_users long, replay_run_id string, record_version long",
    "features": "feature_id string, window_start string, window_end string, user_id long, event_count long, pv_count long, cart_count long, fav_count long, buy_count long, distinct_items long, feature_version long, record_version long",
    "quality": "quality_event_id string, quality_type string, event_id string, user_id long, item_id long, category_id long, behavior_type string, event_time_ms long, replay_run_id string, source_sequence long, reason_code string, reason_message string, observed_at_ms long, record_version long",
    "catalog": "product_id long, category_id long, product_name string, price decimal(12,2), is_active boolean, updated_at string, catalog_version long",
}
INSTANTS = ("window_start", "window_end", "updated_at")


#: A line that ends within quotes: fields without a leading quote, or quoted ones and what follows, then one that stays open.
_OPEN = r'^(?:(?:[^",][^,]*+|"(?:[^"]|"")*+"(?:[^",][^,]*+)?)?,)*+"(?:[^"]|"")*+$'


def _header(line: Column) -> Column:
    """Whether a line is the canonical header, with or without quotes and blanks."""
    unquoted = lambda v: F.btrim(F.regexp_replace(v, '^"([^"]*)"', "$1"), F.lit(BLANKS))
    fields = F.transform(F.split(line, ","), unquoted)
    return F.coalesce((F.size(fields) == len(CSV_COLUMNS)) & (F.concat_ws(",", fields) == ",".join(CSV_COLUMNS)), F.lit(False))


def _state(constant: Column, flip: Column, order: Window, start: Column | None = None) -> Column:
    """The state before each row of a chain of functions of a truth value, which set it (`constant`), turn it over (`flip`) or leave it; `start` is the first row's."""
    flips = F.sum(flip.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = F.last(F.when(constant.isNotNull(), F.struct(constant.alias("v"), flips.alias("k"))), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    before = flips - flip.cast("int")
    odd = lambda n: n % 2 == 1
    begun = F.lit(False) if start is None else start
    return F.when(last.isNull(), begun != odd(before)).otherwise(last["v"] != odd(before - last["k"]))


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """(n, block, at, value, whole) of all lines in the order of paths and lines: n is the number of the record that a line is of, and `whole` says whether it is all of it.

    A line is a function of whether it begins within quotes to whether it ends there.
    Most lines leave that as it is; only in splits that have others are the lines put
    in order, and their functions composed by a prefix scan. A split as a whole is such a
    function too, so where records begin is known from one row per split.
    """
    where = F.col("_metadata")
    lines = spark.read.text(path).select("value", where["file_path"].alias("path"), where["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("at"))
    first = F.col("block") == 0
    lines = lines.withColumn("value", F.when(first & F.col("value").startswith("\ufeff"), F.substr("value", F.lit(2))).otherwise(F.col("value")))
    quoted = F.col("value").contains('"')
    lines = lines.withColumn("outside", quoted & F.col("value").rlike(_OPEN)).withColumn("inside", ~quoted | F.concat(F.lit('"'), "value").rlike(_OPEN))
    turns = F.col("outside") | ~F.col("inside")
    blocks = lines.groupBy("path", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"), F.count_if(turns).alias("turns"), F.min_by("value", "at").alias("head"))
    # Lines of splits in which quotes turn, with what they are if the split begins outside (0) or within (1) quotes.
    order = Window.partitionBy("path", "block").orderBy("at")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turning = lines.join(blocks.where("turns > 0").select("path", "block"), ["path", "block"])
    constant, flip = F.when(F.col("outside") == F.col("inside"), F.col("outside")), F.col("outside") & ~F.col("inside")
    turning = turning.withColumn("s0", _state(constant, flip, order)).withColumn("s1", _state(constant, flip, order, F.lit(True)))
    turning = turning.withColumns({f"{name}{k}": c for k in (0, 1) for name, c in (("c", F.count_if(~F.col(f"s{k}")).over(upto)), ("e", F.when(F.col(f"s{k}"), F.col("inside")).otherwise(F.col("outside"))))})
    ends = turning.groupBy("path", "block").agg(*[F.max(f"c{k}").alias(f"starts{k}") for k in (0, 1)], *[F.max_by(f"e{k}", "at").alias(f"end{k}") for k in (0, 1)])
    blocks = blocks.join(ends, ["path", "block"], "left").withColumn("starts0", F.coalesce("starts0", "n")).withColumn("starts1", F.coalesce("starts1", F.lit(0)))
    blocks = blocks.withColumn("end0", F.coalesce("end0", F.lit(False))).withColumn("end1", F.coalesce("end1", F.lit(True)))
    in_file = Window.partitionBy("path").orderBy("block")
    blocks = blocks.withColumn("begins", _state(F.when(F.col("end0") == F.col("end1"), F.col("end0")), F.col("end0") & ~F.col("end1"), in_file))
    starts = F.when(F.col("begins"), F.col("starts1")).otherwise(F.col("starts0"))
    every = Window.orderBy("path", "block")  # a row per split
    before = F.coalesce(F.sum(starts).over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    header = F.first(_header(F.col("head")) & ~F.col("end0")).over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    facts = blocks.select("path", "block", "first", "turns", "begins", (before - header.cast("int")).alias("before"))
    plain = lines.join(facts.where("turns = 0"), ["path", "block"])
    plain = plain.select(F.when(F.col("begins"), F.col("before") - 1).otherwise(F.col("at") - F.col("first") + F.col("before")).alias("n"), "path", "block", "at", "value", (~F.col("begins")).alias("whole"))
    turned = turning.join(facts.select("path", "block", "begins", "before"), ["path", "block"])
    chosen = lambda name: F.when(F.col("begins"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
    turned = turned.select((F.col("before") + chosen("c") - 1).alias("n"), "path", "block", "at", "value", (~chosen("s") & ~chosen("e")).alias("whole"))
    return plain.unionByName(turned).where("n >= 0")


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """OP-1: (source_sequence, raw_values) in the order of paths and lines; a canonical header is dropped in the scan's first row alone.

    Blank records keep their number. Files, compressed ones too, are read in splits as
    Hadoop makes them; records may span lines and splits. The line ends within a
    record come back as one newline character each. Lines without a quote are split
    here; only records with one go through Python's reader.
    """
    lines = csv_lines(spark, path)
    joined = F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"]))
    records = lines.where("whole").select("n", "value").unionByName(lines.where("NOT whole").groupBy("n").agg(joined.alias("value")))

    def split(batches):
        csv.field_size_limit(1 << 31)
        for batch in batches:
            values = [next(csv.reader(io.StringIO(v, newline="")), []) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.list_(pa.string()))], names=["source_sequence", "raw_values"])

    quoted = F.col("value").contains('"')
    numbered = records.select(F.col("n").cast("long").alias("source_sequence"), "value")
    simple = numbered.where(~quoted).select("source_sequence", F.when(F.col("value") == "", F.array().cast("array<string>")).otherwise(F.split("value", ",", -1)).alias("raw_values"))
    return simple.unionByName(numbered.where(quoted).mapInArrow(split, "source_sequence long, raw_values array<string>"))


def parse_rows(rows: DataFrame, run_id: str | Column) -> DataFrame:
    """OP-2: events and rejects in one frame; reason is null for an event. Ids and times of 0 or less pass on."""
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    value = lambda k: F.btrim(F.get("raw_values", F.lit(k)), F.lit(BLANKS))
    # Single underscores between digits count as nothing, as Python reads integers; digits are those of ASCII.
    number = lambda k: F.when(value(k).rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.replace(value(k), F.lit("_"), F.lit(""))).try_cast("bigint")
    seconds = number(4)
    out = rows.select(
        "source_sequence", "raw_values", run.alias("replay_run_id"), number(0).alias("user_id"), number(1).alias("item_id"), number(2).alias("category_id"),
        value(3).alias("behavior_type"), F.try_multiply(seconds, F.lit(1000).cast("bigint")).alias("event_time_ms"),
    )
    reason = (
        F.when(F.size("raw_values") != 5, "COLUMN_COUNT")
        .when(F.col("source_sequence") < 0, "SOURCE_SEQUENCE")
        .when(F.length(F.trim("replay_run_id")) == 0, "REPLAY_RUN_ID")
        .when(F.col("user_id").isNull() | F.col("item_id").isNull() | F.col("category_id").isNull() | F.col("event_time_ms").isNull(), "NOT_AN_INTEGER")
        .when(~F.col("behavior_type").isin(*BEHAVIORS), "BEHAVIOR_TYPE")
    )
    return out.withColumn("reason", reason).withColumn("event_id", F.when(F.col("reason").isNull(), event_identity()))


def read_events(spark: SparkSession, path: str, run_id: str) -> tuple[DataFrame, DataFrame]:
    """OP-4: (events, rejects), each bounded by Spark's partitions, never gathered."""
    return split_parsed(parse_rows(csv_rows(spark, path), run_id))


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    events = parsed.where("reason IS NULL").select("event_id", *CSV_COLUMNS[:4], "event_time_ms", "source_sequence", "replay_run_id")
    return events, parsed.where("reason IS NOT NULL").select("source_sequence", "raw_values", "reason")


def event_batches(parsed: DataFrame, batch_size: int = 1000) -> DataFrame:
    """OP-4, 5: a row per batch of source rows: how many there are, how many events, and the numbers of its rejects, in order."""
    rejects = F.array_sort(F.collect_list(F.when(F.col("reason").isNotNull(), F.col("source_sequence"))))
    return batch_numbers(parsed, batch_size).groupBy("batch").agg(F.count(F.lit(1)).alias("source_rows"), F.count_if(F.col("reason").isNull()).alias("events"), rejects.alias("rejects"))


def batch_numbers(rows: DataFrame, batch_size: int = 1000) -> DataFrame:
    """OP-4: the number of the batch that each source row comes in."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    return rows.withColumn("batch", F.floor(F.col("source_sequence") / batch_size).cast("bigint"))


def replay_stats(parsed: DataFrame, batch_size: int = 1000) -> DataFrame:
    """OP-5: one row of counts: source_rows, emitted_events, invalid_rows, batches."""
    n = F.count(F.lit(1))
    invalid = F.count_if(F.col("reason").isNotNull())
    return parsed.agg(n.alias("source_rows"), (n - invalid).alias("emitted_events"), invalid.alias("invalid_rows"), F.ceil(n / batch_size).cast("bigint").alias("batches"))


def validate_ingress(events: DataFrame) -> DataFrame:
    """OP-8: status 202 or 422 by row; identity is recomputed, behaviors and positive ids aren't looked at."""
    known = F.col("user_id").isNotNull() & F.col("item_id").isNotNull() & F.col("category_id").isNotNull() & F.col("behavior_type").isNotNull()
    fine = known & (F.col("event_time_ms") >= 0) & (F.pmod("event_time_ms", F.lit(1000)) == 0) & (F.col("source_sequence") >= 0) & (F.length(F.trim("replay_run_id")) > 0)
    status = F.when(F.coalesce(fine, F.lit(False)) & (F.col("event_id").isNull() | (F.col("event_id") == event_identity())), 202).otherwise(422)
    return events.withColumn("status", status)


def valid_catalog_keys(rows: DataFrame) -> DataFrame:
    """OP-51: parsed rows whose ids and time are positive."""
    return rows.where("reason IS NULL AND user_id > 0 AND item_id > 0 AND category_id > 0 AND event_time_ms > 0")


def kafka_events(spark: SparkSession, options: dict[str, str], topic: str, avro_schema: str, bounded: bool = False) -> DataFrame:
    """OP-7: Confluent-framed Avro; needs the Kafka and Avro packages of Spark on the class path."""
    from pyspark.sql.avro.functions import from_avro

    reader = spark.read if bounded else spark.readStream
    raw = reader.format("kafka").options(**options).option("subscribe", topic).option("startingOffsets", "earliest").load()
    return raw.select(from_avro(F.expr("substring(value, 6)"), avro_schema).alias("e")).select("e.*")


def kafka_rows(events: DataFrame) -> DataFrame:
    """OP-9: key and value of each event as the producer sends them, the value as JSON."""
    return events.select(F.col("user_id").cast("string").alias("key"), F.to_json(F.struct(*events.columns)).alias("value"))


def cdc_changes(log: DataFrame, schema: str) -> DataFrame:
    """OP-11: after-images of a JSON change log (op, value); decimals come as strings; tombstones are dropped."""
    return log.where("value IS NOT NULL").select("op", F.from_json("value", schema).alias("v")).select("op", "v.*")


def replay_schedule(events: DataFrame, speed: float) -> DataFrame:
    """OP-5: due_ms after the start for each event, 0 at speed 0."""
    if speed < 0:
        raise ValueError("speed must not be negative")
    first = F.broadcast(events.agg(F.min_by("event_time_ms", "source_sequence").alias("__start")))  # one row
    due = F.greatest(F.lit(0), F.col("event_time_ms") - F.col("__start")) / speed if speed else F.lit(0.0)
    return events.join(first).withColumn("due_ms", due.cast("double")).drop("__start")


def write_replay(parsed: DataFrame, source: str, output: str, rejects: str | None = None, force: bool = False, batch_size: int = 1000) -> DataFrame:
    """OP-6: events as JSON lines, and rejects to a folder of their own; returns the counts of `replay_stats`.

    Source, output and rejects must be three places; what is there already is an
    error without `force`, and is found before anything is written.
    """
    places = [p.rstrip("/") for p in (source, output, rejects) if p]
    if len(set(places)) < len(places):
        raise ValueError("source, output and rejects must differ")
    spark = parsed.sparkSession
    for place in places[1:]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(place)
        if not force and folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            raise FileExistsError(place)
    events, bad = split_parsed(parsed)
    if rejects:
        bad.write.json(rejects, mode="overwrite")
    events.write.json(output, mode="overwrite")
    return replay_stats(parsed, batch_size)


def utc_instant(text: Column) -> Column:
    """The time a label names, in UTC where it has no offset."""
    return F.when(text.rlike(r"(Z|[+-]\d\d:?\d\d)$"), text).otherwise(F.concat(text, F.lit("Z"))).try_cast("timestamp")


def typed_messages(messages: DataFrame, kind: str) -> DataFrame:
    """OP-16: JSON messages (value) of a kind as typed rows with ingested_at; quality rows keep their event time as a number."""
    rows = messages.select(F.from_json("value", MESSAGES[kind]).alias("m")).select("m.*")
    rows = rows.withColumns({c: utc_instant(F.col(c)) for c in INSTANTS if c in rows.columns})
    if kind == "raw":
        rows = rows.withColumn("event_time_ms", F.timestamp_millis("event_time_ms"))
    if kind == "quality":
        rows = rows.withColumn("observed_at_ms", F.timestamp_millis("observed_at_ms")).withColumnRenamed("observed_at_ms", "observed_at")
    return rows.withColumnRenamed("event_time_ms", "event_time").withColumn("ingested_at", F.current_timestamp())
