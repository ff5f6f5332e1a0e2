"""Identity hashes, labels and rules as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE = 60_000


def sha_of(separator: str, *parts: Column | str) -> Column:
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.sha2(F.concat_ws(separator, *[c.cast("string") for c in columns]).cast("binary"), 256)


def event_identity() -> Column:
    """OP-3: whole-second time, source sequence, and no run id."""
    return sha_of("\u001f", "user_id", "item_id", "category_id", "behavior_type", F.floor(F.col("event_time_ms") / 1000).cast("bigint"), "source_sequence")


def minute_start(ms: str = "event_time_ms") -> Column:
    return (F.col(ms) - F.pmod(F.col(ms), F.lit(MINUTE))).cast("bigint")


def window_label(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss.SSS")


def behavior_count(kind: str, when: Column | None = None) -> Column:
    hit = F.col("behavior_type") == kind
    return F.count_if(hit if when is None else hit & when).alias(f"{kind}_count")


def catalog_price(product_id: str = "product_id") -> Column:
    """OP-52's price rule in decimals."""
    cents = F.pmod(F.col(product_id), F.lit(50_000)) + 100
    return (cents.cast("decimal(12,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(12,2)")
