"""Carts, online features, catalog and trending products (OP-18, 19, 25, 26, 29..31, 36..38, 52..60, 65)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftline.functions.scalar import catalog_price
from weftline.operators.events import latest_version
from weftline.streaming.commits import Commits

# Fixed value: the manifest's name for the rule of `dominant_category`.
CATEGORY_POLICY = "most_frequent_then_lowest_category_id"
CATALOG_CONTENT = ("category_id", "product_name", "price", "is_active", "updated_at")


def cart_sessions(upserts: DataFrame, ttl_seconds: int) -> DataFrame:
    """(user_id, since_ms, expires_at_ms) of each user's last cart, from all UPSERTs (user_id, last_updated_at_ms).

    An UPSERT after the expiry of what was there starts a new cart. Only gaps of
    the TTL or more count, so times are combined by stretches of it before they
    are ordered: a user has one row per stretch, not one per UPSERT.
    """
    ttl = ttl_seconds * 1000
    at = F.col("last_updated_at_ms")
    spans = upserts.groupBy("user_id", F.floor(at / ttl).alias("stretch")).agg(F.min(at).alias("first"), F.max(at).alias("last"))
    before = F.lag("last").over(Window.partitionBy("user_id").orderBy("stretch"))
    starts = spans.withColumn("start", F.when(before.isNull() | (F.col("first") - before >= ttl), F.col("first")))
    return starts.groupBy("user_id").agg(F.max("start").alias("since_ms"), (F.max("last") + ttl).alias("expires_at_ms"))


def active_cart(mutations: DataFrame, upserts: DataFrame, ttl_seconds: int = 604_800, rebuilt: bool = False) -> DataFrame:
    """OP-18, 38: items in each user's cart, from the last mutation of each item.

    A user's last UPSERT sets the expiry of the whole cart, a DELETE doesn't;
    `upserts` (user_id, last_updated_at_ms) has all of them, those of items that
    are gone too. Items of a cart that had expired before are not in it, unless it
    is `rebuilt` from the compacted log: that is read at once, so no cart expires
    between two of its entries.
    """
    if ttl_seconds <= 0:
        raise ValueError("ttl_seconds must be positive")
    known = F.when(~F.col("operation").isin("UPSERT", "DELETE"), F.raise_error(F.lit("unknown cart operation"))).otherwise(F.col("operation"))
    rows = mutations.withColumn("operation", known).where("operation = 'UPSERT'")
    if rebuilt:
        live = rows.join(upserts.groupBy("user_id").agg((F.max("last_updated_at_ms") + ttl_seconds * 1000).alias("expires_at_ms")), "user_id")
    else:
        live = rows.join(cart_sessions(upserts, ttl_seconds), "user_id").where("last_updated_at_ms >= since_ms")
    value = F.concat_ws("|", "category_id", "added_at_ms", "last_updated_at_ms").alias("value")
    return live.select("user_id", "item_id", "category_id", "added_at_ms", "last_updated_at_ms", "expires_at_ms", value)


def feature_contract() -> Column:
    """OP-19: the first broken rule of a feature snapshot, or null; a missing value breaks the rule that reads it."""
    counts = ("pv_count", "cart_count", "fav_count", "buy_count")
    broken = lambda fine: ~F.coalesce(fine, F.lit(False))
    some = lambda x: F.coalesce(F.col(x) >= 0, F.lit(False))
    whole = some("event_count") & some("distinct_items")
    for c in counts:
        whole = whole & some(c)
    return (
        F.when(broken(F.col("user_id") > 0), "user_id")
        .when(broken(F.col("feature_version") > 0), "feature_version")
        .when(broken(F.length(F.trim("feature_id")) > 0), "feature_id")
        .when(~whole, "counts")
        .when(F.col("event_count") != sum((F.col(c) for c in counts), F.lit(0)), "event_count")
        .when(F.col("distinct_items") > F.col("event_count"), "distinct_items")
    )


def online_features(snapshots: DataFrame, current: DataFrame | None = None, ttl_seconds: int = 86_400) -> DataFrame:
    """OP-19: the newest snapshot of each user; one of the current version or an older changes nothing."""
    if ttl_seconds <= 0:
        raise ValueError("ttl_seconds must be positive")
    columns = ["user_id", "feature_id", "window_start", "window_end", "event_count", "pv_count", "cart_count", "fav_count", "buy_count", "distinct_items", "feature_version"]
    fine = snapshots.where(feature_contract().isNull()).select(*columns).withColumn("__held", F.lit(0))
    if current is not None:
        fine = fine.unionByName(current.select(*columns).withColumn("__held", F.lit(1)))
    newest = latest_version(fine, ["user_id"], "feature_version", "__held").drop("__held")
    return newest.withColumn("expires_at_ms", F.col("feature_version") + ttl_seconds * 1000)


def category_observations(rows: DataFrame) -> DataFrame:
    """OP-30."""
    return rows.groupBy(F.col("item_id").alias("product_id"), "category_id").agg(F.count(F.lit(1)).alias("observations"))


def dominant_category(observations: DataFrame) -> DataFrame:
    """OP-36: the most observed category, the smallest at a tie."""
    best = F.max_by("category_id", F.struct("observations", -F.col("category_id")))
    return observations.groupBy("product_id").agg(best.alias("category_id"))


def catalog_coverage(observations: DataFrame) -> DataFrame:
    """OP-31."""
    by_product = observations.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    return by_product.agg(F.count(F.lit(1)).alias("unique_products"), F.count_if(F.col("n") > 1).alias("conflicting_products"))


def generate_catalog(rows: DataFrame) -> DataFrame:
    """OP-52: one row per observed product."""
    products = dominant_category(category_observations(rows))
    return products.select("product_id", "category_id", F.concat(F.lit("Synthetic product "), F.col("product_id").cast("string")).alias("product_name"), catalog_price().alias("price"), F.lit(True).alias("is_active"), F.lit("2026-01-01T00:00:00Z").alias("updated_at"), F.lit(1).cast("bigint").alias("catalog_version"))


def catalog_manifest(parsed: DataFrame, valid: DataFrame) -> DataFrame:
    """OP-53: counts of a generation, one row."""
    rows = parsed.agg(F.count(F.lit(1)).alias("source_rows")).crossJoin(valid.agg(F.count(F.lit(1)).alias("valid_rows")))
    return rows.crossJoin(catalog_coverage(category_observations(valid))).withColumn("rejected_rows", F.col("source_rows") - F.col("valid_rows")).withColumn("category_resolution_policy", F.lit(CATEGORY_POLICY))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """OP-53: sha256 of each CSV file that a catalog was written to; a file is a range of product ids."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(catalog_folder(spark, path))
    return files.select("path", F.sha2("content", 256).alias("catalog_sha256"))


def canonical_snapshot(rows: DataFrame, kind: str) -> DataFrame:
    """OP-39: the order in which two snapshots are compared."""
    keys = {"raw": ["source_sequence"], "metrics": ["window_start", "item_id", "source_category_id"], "features": ["window_start", "user_id"], "quality": ["quality_event_id"], "catalog": ["product_id"]}
    return rows.orderBy(*keys[kind])


def write_catalog(catalog: DataFrame, path: str, expected: int) -> None:
    """OP-12: load into a folder of its own, in ranges of product ids, compare its count with the manifest's, and only then make it the catalog by one commit.

    Readers have the old catalog until then; the one before the old one is removed.
    """
    spark, folder = catalog.sparkSession, f"load={uuid.uuid4().hex}"
    commits = Commits(spark, f"{path.rstrip('/')}/commits")
    done, state = commits.last()
    catalog.orderBy("product_id").write.option("header", True).csv(f"{path}/{folder}")
    found = spark.read.schema(catalog.schema).option("header", True).csv(f"{path}/{folder}").count()
    if found != expected:
        commits.remove(folder)
        raise ValueError(f"{found} rows loaded, {expected} expected")
    commits.put(0 if done is None else done + 1, {"folder": folder, "old": state and state["folder"]})
    if state and state["old"]:
        commits.remove(state["old"])


def catalog_folder(spark: SparkSession, path: str) -> str:
    """Where the catalog lies that was loaded last."""
    _, state = Commits(spark, f"{path.rstrip('/')}/commits").last()
    if state is None:
        raise FileNotFoundError(path)
    return f"{path}/{state['folder']}"


def loaded_catalog(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(catalog_folder(spark, path))


def catalog_constraint() -> Column:
    """OP-54: the first broken rule, or null."""
    return (
        F.when(~F.coalesce((F.col("product_id") > 0) & (F.col("category_id") > 0), F.lit(False)), "identifier")
        .when(F.coalesce(F.length(F.trim("product_name")), F.lit(0)) == 0, "product_name")
        .when(~F.coalesce(F.col("price") >= 0, F.lit(False)), "price")
        .when(~F.coalesce(F.col("catalog_version") > 0, F.lit(False)), "catalog_version")
    )


def version_guard(changes: DataFrame) -> DataFrame:
    """OP-55, 56: a decision per change (op, change_sequence and the catalog's columns).

    A change is held against the last accepted state: the newest version so far.
    Accepted versions never fall, so that is the greatest version before it, with
    the content that first came with it.
    """
    before = Window.partitionBy("product_id").orderBy("change_sequence").rowsBetween(Window.unboundedPreceding, -1)
    content = F.struct(*CATALOG_CONTENT)
    rule = catalog_constraint()
    eligible = rule.isNull() & (F.col("op") != "d")
    # Of equal versions the first came in: order by version and then the earlier sequence.
    state = F.struct(F.col("catalog_version").alias("v"), (-F.col("change_sequence")).alias("s"), content.alias("c"))
    rows = changes.withColumn("__last", F.max_by(F.when(eligible, state), F.when(eligible, F.struct("catalog_version", -F.col("change_sequence")))).over(before))
    decision = (
        F.when(F.col("op") == "d", "REJECT_DELETE")
        .when(rule.isNotNull(), "REJECT_CONSTRAINT")
        .when(F.col("__last").isNull(), "ACCEPT")
        .when(F.col("catalog_version") < F.col("__last.v"), "REJECT_VERSION_DECREASE")
        .when((F.col("catalog_version") == F.col("__last.v")) & ~content.eqNullSafe(F.col("__last.c")), "REJECT_SAME_VERSION_CHANGED")
        .otherwise("ACCEPT")
    )
    return rows.withColumn("decision", decision).drop("__last")


def current_catalog(changes: DataFrame) -> DataFrame:
    """OP-57."""
    return latest_version(changes, ["product_id"], "catalog_version", "change_sequence")


def trending(metrics: DataFrame, catalog: DataFrame, as_of: int | DataFrame | None = None, minutes: int = 15, limit: int = 20) -> DataFrame:
    """OP-25, 26, 29, 37, 60: top products of [as_of - minutes, as_of) by the catalog as it is now.

    `as_of` is a time in ms, a table with one row (as_of_ms), or now.
    """
    if not 1 <= minutes <= 1440 or (isinstance(as_of, int) and as_of < 0):
        raise ValueError("minutes must be in 1..1440 and as_of not negative")
    start = F.col("window_start_ms")
    if isinstance(as_of, DataFrame):
        clock = F.broadcast(as_of.select("as_of_ms"))  # one row
        recent = metrics.join(clock, (start >= F.col("as_of_ms") - minutes * 60_000) & (start < F.col("as_of_ms")))
    else:
        end = F.unix_millis(F.current_timestamp()) if as_of is None else F.lit(as_of)
        recent = metrics.where((start >= end - minutes * 60_000) & (start < end))
    sums = recent.groupBy("item_id").agg(F.sum("pv_count").alias("views"), F.sum("cart_count").alias("carts"), F.sum("buy_count").alias("purchases"))
    active = catalog.where("is_active").select("product_id", "product_name", F.col("price").cast("double").alias("current_price"))
    # No hint: the optimizer broadcasts a side once its size is known.
    out = sums.join(active, F.col("item_id") == F.col("product_id"))
    out = out.select("product_id", "product_name", "current_price", "views", "carts", "purchases")
    return out.orderBy(F.desc("purchases"), F.desc("carts"), F.desc("views"), "product_id").limit(limit)


def user_cart(spark: SparkSession, cart: DataFrame, user_id: int, now_ms: int) -> DataFrame:
    """OP-58: a user's items by number, with the seconds left; where there is no cart, one row without an item and -2."""
    if user_id <= 0:
        raise ValueError("user_id must be positive")
    asked = spark.range(user_id, user_id + 1).select(F.col("id").alias("user_id"))
    rows = cart.where((F.col("user_id") == user_id) & (F.col("expires_at_ms") > now_ms))
    left = F.coalesce(F.floor((F.col("expires_at_ms") - now_ms) / 1000).cast("bigint"), F.lit(-2).cast("bigint"))
    found = asked.join(rows, "user_id", "left")
    return found.select("user_id", F.col("item_id").alias("product_id"), "category_id", F.col("added_at_ms").alias("added_at"), F.col("last_updated_at_ms").alias("last_updated_at"), left.alias("ttl_seconds")).orderBy("product_id")


def user_feature_lookup(spark: SparkSession, features: DataFrame, user_id: int, now_ms: int) -> DataFrame:
    """OP-59: always one row; available is false and ttl_seconds -2 where there is nothing."""
    if user_id <= 0:
        raise ValueError("user_id must be positive")
    asked = spark.range(user_id, user_id + 1).select(F.col("id").alias("user_id"))
    rows = features.where((F.col("user_id") == user_id) & (F.col("expires_at_ms") > now_ms))
    ttl = F.coalesce(F.floor((F.col("expires_at_ms") - now_ms) / 1000).cast("bigint"), F.lit(-2).cast("bigint"))
    return asked.join(rows, "user_id", "left").withColumn("available", F.col("feature_id").isNotNull()).withColumn("ttl_seconds", ttl)


def serving_key(kind: str, user_id: Column, prefix: str = "weft") -> Column:
    """OP-65: key columns of the two stores; the braces name the hash slot."""
    label = {"cart": "active_cart:{", "features": "features:user:{"}[kind]
    return F.when(user_id > 0, F.concat(F.lit(f"{prefix}:{label}"), user_id.cast("string"), F.lit("}")))
