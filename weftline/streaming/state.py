"""Keyed state of a stream: ids that have come, and the version of each cart (OP-34, 35, 45, 46).

The job finds both in its own committed batches (`pipeline.Job`); here they are held by a state store.

Python gets the keys of rows and what orders them; the row itself travels as a JSON
text that it doesn't look into. State is kept in RocksDB by buckets of ids and of
carts, so a call has many rows and no key has the whole stream.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weftline.operators import events as E

EVENT = "event_id string, user_id long, item_id long, category_id long, behavior_type string, event_time_ms long, source_sequence long, replay_run_id string, arrival long"
#: What the payload holds.
PAYLOAD = f"{EVENT}, validation_reason string, shard string"
#: A row of a stream before its watermark is known: status is INVALID, DUPLICATE, UNIQUE or, for a heartbeat, BEAT; change numbers the changes of a cart and is 0 where a row changes none.
DEDUPLICATED = f"{PAYLOAD}, status string, change long, now long"
#: Buckets of ids and of carts; a task holds the rows of one at a time, and they are at least as many as there are tasks to work on them.
BUCKETS = 1024
#: Bytes of a digest.
DIGEST = 32
RETENTION_MS = 168 * 3_600_000
STATE_CONF = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_LEAST = -(1 << 63)


class Remembering(StatefulProcessor):
    """What came, by the digest of its key; each entry has the time of the batch that last wrote it, and those older than the retention count as gone.

    A bucket's entries are one value of state, read and written once a batch: a call
    of the store for each key costs milliseconds, which is hours for millions of them.
    Times are those of the batches' starts, which a batch that runs again has again.
    They are compared when a key is looked for; old entries go when their bucket is
    next written.
    """

    #: Numbers of an entry, the time first.
    WIDTH = 1

    def __init__(self, retention_ms: int):
        self.retention_ms = retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entries = handle.getValueState("entries", "digests binary, numbers binary")

    def load(self) -> dict[bytes, tuple[int, ...]]:
        held = self.entries.get()
        if held is None:
            return {}
        digests, numbers = bytes(held[0]), np.frombuffer(bytes(held[1]), "<i8").reshape(-1, self.WIDTH)
        return {digests[k * DIGEST : (k + 1) * DIGEST]: tuple(x) for k, x in enumerate(numbers.tolist())}

    def found(self, entries: dict[bytes, tuple[int, ...]], key: bytes, now: int) -> tuple[int, ...] | None:
        entry = entries.get(key)
        return entry if entry is not None and entry[0] > now - self.retention_ms else None

    def save(self, entries: dict[bytes, tuple[int, ...]], now: int) -> None:
        live = {key: x for key, x in entries.items() if x[0] > now - self.retention_ms}
        self.entries.update((b"".join(live), np.array(list(live.values()), "<i8").tobytes()))

    def close(self) -> None:
        pass


class KeepFirst(Remembering):
    """Whether a row is the first with its id, by arrival and across batches."""

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        frame, entries, new = pd.concat(list(rows), ignore_index=True), self.load(), False
        status = np.where(frame.payload.isna(), "BEAT", "INVALID").astype(object)
        ids, valid, times = frame.id.tolist(), frame.valid.to_numpy(bool), frame.now.tolist()
        met = set()
        for k in np.lexsort((frame.nth, frame["at"])).tolist():
            if valid[k]:
                row_id, now = ids[k], times[k]
                if row_id in met or self.found(entries, row_id, now) is not None:
                    status[k] = "DUPLICATE"
                else:
                    status[k], entries[row_id], new = "UNIQUE", (now,), True
                met.add(row_id)
        if new:
            self.save(entries, max(times))
        yield pd.DataFrame({"payload": frame.payload, "status": status, "now": frame.now})


class CartVersions(Remembering):
    """The number of the change that a row makes to its cart; 0 for rows that aren't the newest of their batch or are no newer than what came before."""

    #: Time, event time and sequence of the newest row, changes so far.
    WIDTH = 4

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True)
        newest: dict[bytes, tuple[int, int, int]] = {}
        for k, (cart, ms, nth) in enumerate(zip(frame.cart, frame.ms.tolist(), frame.nth.tolist())):
            if cart and (cart not in newest or newest[cart][:2] <= (ms, nth)):
                newest[cart] = (ms, nth, k)
        change, times = np.zeros(len(frame), "int64"), frame.now.tolist()
        entries, new = self.load() if newest else {}, False
        for cart, (ms, nth, k) in newest.items():
            last = self.found(entries, cart, times[k])
            if last is None or last[1:3] < (ms, nth):
                change[k] = (last[3] if last else 0) + 1
                entries[cart], new = (times[k], ms, nth, int(change[k])), True
        if new:
            self.save(entries, max(times))
        yield pd.DataFrame({"payload": frame.payload, "status": frame.status, "now": frame.now, "change": change})


def _bucket(*parts: Column | str) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).alias("bucket")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def marked(events: DataFrame, shard: Column | None = None, now: Column | None = None) -> DataFrame:
    """Rows of a stream as `PAYLOAD`, with a status VALID, INVALID or BEAT, and the time of the batch. `shard` splits the order of arrival, such as
    the source partition does; `now` is the time of the batch unless given. Rows are heartbeats if `beat` says so; they have no shard."""
    beats = F.coalesce("beat", F.lit(False)) if "beat" in events.columns else F.lit(False)
    rows = E.classify(events).withColumn("shard", F.when(~beats, F.coalesce((F.lit(0) if shard is None else shard).cast("string"), F.lit(""))))
    rows = rows.withColumn("status", F.when(beats, "BEAT").when(F.col("validation_reason").isNotNull(), "INVALID").otherwise("VALID"))
    now = (F.unix_millis(F.current_timestamp()) if now is None else now).cast("long").alias("now")
    return rows.select(*[c.split()[0] for c in PAYLOAD.split(", ")], "status", now)


def deduplicated(events: DataFrame, shard: Column | None = None, retention_ms: int = RETENTION_MS, now: Column | None = None) -> DataFrame:
    """`marked` rows with their status, and the change that they make to a cart, by a state store; a job over `marked` rows finds both by itself."""
    rows = marked(events, shard, now)
    beats = F.col("status") == "BEAT"
    names = [c.split()[0] for c in PAYLOAD.split(", ")]
    order = [F.coalesce(c, F.lit(_LEAST)).alias(a) for c, a in (("arrival", "at"), ("source_sequence", "nth"))]
    keyed = rows.select(
        _bucket(F.coalesce("event_id", F.concat_ws("|", "replay_run_id", "source_sequence"))), _digest(F.coalesce("event_id", F.lit(""))).alias("id"), (F.col("status") == "VALID").alias("valid"), *order, "now",
        F.when(~beats, F.to_json(F.struct(*names))).alias("payload"),
    )
    first = keyed.groupBy("bucket").transformWithStateInPandas(KeepFirst(retention_ms), "payload string, status string, now long", "Append", "None")
    row = F.from_json("payload", PAYLOAD)
    of_cart = (F.col("status") == "UNIQUE") & row["behavior_type"].isin("cart", "buy")
    cart = F.when(of_cart, F.concat_ws("|", F.coalesce(row["user_id"].cast("string"), F.lit("")), F.coalesce(row["item_id"].cast("string"), F.lit(""))))
    # Rows of no cart are dealt by themselves, so they don't meet in one bucket.
    carts = first.select(_bucket(F.coalesce(cart, "payload")), F.coalesce(_digest(cart), F.lit(b"")).alias("cart"), F.coalesce(row["event_time_ms"], F.lit(_LEAST)).alias("ms"), F.coalesce(row["source_sequence"], F.lit(_LEAST)).alias("nth"), "payload", "status", "now")
    changed = carts.groupBy("bucket").transformWithStateInPandas(CartVersions(retention_ms), "payload string, status string, now long, change long", "Append", "None")
    return changed.select(F.from_json("payload", PAYLOAD).alias("r"), "status", "change", "now").select("r.*", "status", "change", "now")
