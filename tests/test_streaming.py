"""The job: golden rows, restarts, a batch that is killed between two sinks, shards that are late or idle, retention, open windows."""

import hashlib
import itertools
import os
import threading
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from weftline.config import RuntimeConfig
from weftline.operators import events as E
from weftline.plans import streams
from weftline.plans.behavior import replayed
from weftline.streaming import pipeline as P
from weftline.streaming.commits import Commits
from weftline.streaming.state import CartVersions, KeepFirst, deduplicated, marked

FAST = {"restart_delay_ms": 1}


def append(rows, path):
    rows.select(*P.log_columns()).coalesce(1).sortWithinPartitions("arrival").write.mode("append").parquet(str(path))


def found(spark, path, sink):
    return sorted(map(repr, P.job_rows(spark, str(path), sink).drop("observed_at_ms", "record_version").collect()))


@pytest.fixture(scope="module")
def twice(spark, golden, tmp_path_factory):
    """The golden rows in two batches with a restart between: (log, out, settings)."""
    root = tmp_path_factory.mktemp("job")
    config = RuntimeConfig(f"{root}/checkpoint", flush_open_windows=True)
    for rows in (golden.where("arrival < 6"), golden.where("arrival >= 6")):
        append(rows, root / "log")
        P.run_job(spark, f"{root}/log", f"{root}/out", config).awaitTermination()
    return root / "log", root / "out", config


def test_golden_rows_through_the_job(spark, golden, twice):
    _, out, config = twice
    raw = P.job_rows(spark, str(out), "raw")
    assert sorted(map(tuple, raw.collect())) == sorted(map(tuple, E.raw_projection(E.accepted(golden)).collect()))
    metrics = P.job_windows(spark, str(out), "metrics").collect()
    assert sorted((r.item_id, r.pv_count, r.cart_count, r.fav_count, r.buy_count, r.unique_users) for r in metrics) == [(100, 1, 1, 1, 1, 2), (101, 0, 2, 0, 0, 1), (102, 0, 1, 0, 1, 1)]
    assert {r.user_id: r.feature_id[:8] for r in P.job_windows(spark, str(out), "features").collect()} == {1: "38c38b84", 2: "97994506"}
    assert sorted(r.quality_event_id[:8] for r in P.job_rows(spark, str(out), "quality").collect()) == ["45261c00", "6d8fda92", "88e3f46d"]
    assert [(r.user_id, r.value) for r in P.job_carts(spark, str(out), config).collect()] == [(1, "11|1511658005000|1511658005000")]


def test_open_windows_are_read_with_flush(spark, golden, twice):
    _, out, config = twice
    unique = E.on_time(E.accepted(golden))
    for sink, whole in (("metrics", E.item_metrics(unique)), ("features", E.user_features(unique))):
        flushed = P.job_windows(spark, str(out), sink, flush=True)
        assert sorted(repr(tuple(r[c] for c in flushed.columns)) for r in whole.collect()) == sorted(map(repr, map(tuple, flushed.collect())))
    assert {r.user_id for r in P.job_features(spark, str(out), config).collect()} == {1, 2}


def test_a_batch_killed_between_two_sinks(spark, golden, twice, tmp_path):
    """Readers see nothing of it, and the run that goes on gives what an undisturbed one does."""
    log, out, _ = twice
    calls, seen = itertools.count(), []

    def after(sink):
        if sink == "quality" and next(calls) in (1, 2):  # once the second batch, and once that again
            seen.append(P.job_rows(spark, f"{tmp_path}/out", "raw").count())
            raise RuntimeError("killed")

    config = RuntimeConfig(f"{tmp_path}/checkpoint", **FAST)
    assert P.supervised(lambda: P.run_job(spark, str(log), f"{tmp_path}/out", config, files_per_trigger=1, after=after), config) == 2
    assert seen == [5, 5]
    for sink in P.SINKS:
        assert found(spark, tmp_path / "out", sink) == found(spark, out, sink), sink


def test_a_job_that_fails_too_often_is_given_up(spark, twice, tmp_path):
    def after(sink):
        raise RuntimeError("killed")

    config = RuntimeConfig(f"{tmp_path}/checkpoint", restart_attempts=1, **FAST)
    with pytest.raises(P.StreamingQueryException):
        P.supervised(lambda: P.run_job(spark, str(twice[0]), f"{tmp_path}/out", config, after=after), config)
    assert P.job_rows(spark, f"{tmp_path}/out", "raw").count() == 0


def test_a_batch_that_was_committed_changes_nothing(spark, twice):
    _, out, _ = twice
    before = {f for _, _, files in os.walk(out) for f in files}
    number, state = Commits(spark, f"{out}/commits").last()
    P.Job(str(out))(spark.createDataFrame([], "x int"), number)
    assert Commits(spark, f"{out}/commits").last() == (number, state) and {f for _, _, files in os.walk(out) for f in files} == before


def test_clock_of_shards():
    clock = lambda tops, seen, shards, now=100, idle=None: P.clock_of(tops, seen, shards, 0, now, 5, idle)
    assert clock({"a": 50, "b": 30}, {"a": 100, "b": 100}, ()) == 25
    assert clock({"a": 50}, {"a": 100}, ("a", "b")) is None
    assert clock({"a": 50}, {"a": 100}, ("a", "b"), idle=100) == 45
    assert clock({"a": 50}, {"a": 100}, ("a", "b"), now=99, idle=100) is None
    assert clock({"a": 50, "b": 30}, {"a": 100, "b": 10}, (), idle=50) == 45
    assert clock({"a": 50}, {"a": 10}, (), idle=50) is None


def events_of(spark, rows):
    """(id, shard as user, seconds, arrival) as valid events."""
    return spark.createDataFrame([(i, u, 1, 1, "pv", ms, n, "r", n) for i, u, ms, n in rows], P.EVENT)


def run(spark, root, rows, now=0, **job):
    append(rows, root / "log")
    stream = deduplicated(P.event_stream(spark, f"{root}/log"), F.col("user_id"), now=F.lit(now), retention_ms=job.pop("retention_ms", P.HOUR))
    P.start_job(stream, P.Job(f"{root}/out", **job), f"{root}/checkpoint").awaitTermination()


def test_a_shard_that_was_idle_loses_nothing(spark, tmp_path):
    """Shard 2 is silent while windows close without it; what it then brings is on time or late, and counted as such."""
    minute = 60_000
    options = {"shards": ("1", "2"), "idle_ms": 30_000}
    run(spark, tmp_path, events_of(spark, [("a", 1, minute, 1), ("b", 2, minute, 2)]), 0, **options)
    run(spark, tmp_path, events_of(spark, [("c", 1, 3 * minute + 5000, 3)]), minute, **options)
    assert [r.window_start_ms for r in P.job_windows(spark, f"{tmp_path}/out", "metrics").collect()] == [minute]
    run(spark, tmp_path, events_of(spark, [("d", 2, 2 * minute, 4), ("e", 2, 3 * minute, 5), ("f", 2, 3 * minute + 1, 6), ("g", 2, 9 * minute, 7), ("h", 1, 9 * minute, 8)]), 2 * minute, **options)
    assert [r.event_id for r in P.job_rows(spark, f"{tmp_path}/out", "quality").orderBy("source_sequence").collect()] == ["d", "e"]
    counted = P.job_windows(spark, f"{tmp_path}/out", "metrics", flush=True).groupBy().sum("pv_count").first()[0]
    assert counted == 6 and P.job_rows(spark, f"{tmp_path}/out", "raw").count() == 8


def test_ids_are_remembered_for_the_retention_of_processing_time(spark, tmp_path):
    """Event time doesn't matter: a replay from the start of a log that is longer than the retention is known, until that time has gone by."""
    day = 86_400_000
    for now, rows in [(0, [("x", 1, 400 * day, 1)]), (23, [("x", 1, 1, 2), ("y", 1, 1, 3)]), (24, [("x", 1, 1, 4), ("y", 1, 1, 5)]), (47, [("x", 1, 1, 6), ("y", 1, 1, 7)])]:
        run(spark, tmp_path, events_of(spark, rows), now, retention_ms=24)
    got = P.job_rows(spark, f"{tmp_path}/out", "raw").orderBy("source_sequence").collect()
    assert [(r.event_id, r.source_sequence) for r in got] == [("x", 1), ("y", 3), ("x", 4), ("y", 7)]


def test_counts_of_open_windows_are_merged_and_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "PARTS", 2)
    for k in range(5):
        run(spark, tmp_path, events_of(spark, [(f"a{k}", 1, 1_000 * k + 1, 10 * k), (f"b{k}", 1, 2_000 * k + 2, 10 * k + 1)]))
    _, state = Commits(spark, f"{tmp_path}/out/commits").last()
    assert len(state["parts"]) <= 2 and len(os.listdir(tmp_path / "out/parts")) <= 5 and len(Commits(spark, f"{tmp_path}/out/commits").numbers()) == 2
    run(spark, tmp_path, events_of(spark, [("z", 1, 3 * P.HOUR, 100)]))
    assert [(r.pv_count, r.unique_users) for r in P.job_windows(spark, f"{tmp_path}/out", "metrics").collect()] == [(10, 1)]
    _, state = Commits(spark, f"{tmp_path}/out/commits").last()
    assert [p[1] for p in state["parts"]] == [3]


def test_counts_of_many_hours_lie_in_few_files(spark, tmp_path):
    """A batch's open windows take a file a task at most, however many hours it spans."""
    run(spark, tmp_path, events_of(spark, [(f"h{k}", 1, (40 - k) * P.HOUR + 1, k) for k in range(40)]), shards=("1", "2"))
    _, state = Commits(spark, f"{tmp_path}/out/commits").last()
    files = [f for _, _, names in os.walk(tmp_path / "out/parts") for f in names if f.endswith(".parquet")]
    assert state["parts"] == [["parts/run=batch-0", 40, 40]] and len(files) <= 4
    run(spark, tmp_path, events_of(spark, [(f"i{k}", 1, (41 + k) * P.HOUR + 1, 100 + k) for k in range(40)] + [("z", 2, 99 * P.HOUR, 200)]), shards=("1", "2"))
    files = [f for _, _, names in os.walk(tmp_path / "out/parts") for f in names if f.endswith(".parquet")]
    assert len(files) <= 8
    assert sorted(r.window_start_ms // P.HOUR for r in P.job_windows(spark, f"{tmp_path}/out", "metrics").collect()) == list(range(40, 80))


class Held:
    """A value of state that counts its calls."""

    def __init__(self):
        self.value, self.calls = None, 0

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


def test_state_is_read_and_written_once_a_bucket():
    """A thousand ids and carts of a bucket take two calls of the store, and what they leave is found again until the retention is over."""
    day, held, handle = 24, Held(), type("Handle", (), {})
    handle.getValueState = lambda self, *_: held
    keys = [hashlib.sha256(str(k).encode()).digest() for k in range(1000)]
    ids = pd.DataFrame({"id": keys * 2, "valid": True, "at": range(2000), "nth": 0, "now": 0, "payload": "{}"})
    first = KeepFirst(day)
    first.init(handle())
    assert [list(f.status) for f in first.handleInputRows(None, iter([ids[:700], ids[700:]]), None)] == [["UNIQUE"] * 1000 + ["DUPLICATE"] * 1000] and held.calls == 2
    again = [set(f.status) for now in (day - 1, day) for f in first.handleInputRows(None, iter([ids[:1000].assign(now=now)]), None)]
    assert again == [{"DUPLICATE"}, {"UNIQUE"}] and held.calls == 5

    held.__init__()
    carts = pd.DataFrame({"cart": [*keys, b"", keys[0]], "ms": [*range(1000), 7, 5], "nth": 1, "now": 0, "payload": "{}", "status": "UNIQUE"})
    versions = CartVersions(day)
    versions.init(handle())
    assert [list(f.change) for f in versions.handleInputRows(None, iter([carts]), None)] == [[0, *[1] * 999, 0, 1]] and held.calls == 2
    newer = carts.assign(ms=carts.ms + (carts.index == 3), now=1)
    assert [{k: c for k, c in enumerate(f.change) if c} for f in versions.handleInputRows(None, iter([newer]), None)] == [{3: 2}]


def test_rows_with_nothing_in_them(spark, tmp_path):
    """Numbers beyond a double's come back whole, and nulls stay nulls."""
    rows = [(None,) * 9, ("i", 2**60 + 1, 2**60 + 3, 1, "cart", 2**50 + 1, None, None, None), ("j", None, 5, 1, "buy", 60_000, 1, "r", 1), (" ", 1, 1, 1, "pv", 1, 1, "r", 2)]
    append(spark.createDataFrame(rows, P.EVENT), tmp_path / "log")
    P.run_job(spark, f"{tmp_path}/log", f"{tmp_path}/out", RuntimeConfig(f"{tmp_path}/checkpoint")).awaitTermination()
    raw = {r.event_id: r for r in P.job_rows(spark, f"{tmp_path}/out", "raw").collect()}
    assert set(raw) == {"i", "j"} and (raw["i"].user_id, raw["i"].item_id, raw["i"].source_sequence, raw["j"].user_id) == (2**60 + 1, 2**60 + 3, None, None)
    assert P.job_rows(spark, f"{tmp_path}/out", "cart").count() == 2 and P.job_rows(spark, f"{tmp_path}/out", "quality").where("quality_type = 'INVALID'").count() == 2


def test_a_job_that_goes_on_finds_a_shard_idle_by_heartbeats(spark, tmp_path):
    config = RuntimeConfig(f"{tmp_path}/checkpoint", checkpoint_interval_ms=500, bounded=False, shards=("1", "2"), idle_timeout_ms=20_000)
    append(events_of(spark, [("a", 1, 60_000, 1), ("b", 1, 200_000, 2)]), tmp_path / "log")
    query = P.run_job(spark, f"{tmp_path}/log", f"{tmp_path}/out", config, F.col("user_id"))
    began = time.time()

    def wait(done):
        while not done():
            assert query.isActive and time.time() < began + 150, query.exception()
            time.sleep(0.5)

    try:
        wait(lambda: P.job_rows(spark, f"{tmp_path}/out", "raw").count() == 2 and time.time() > began + 12)
        append(events_of(spark, [("c", 1, 200_001, 3)]), tmp_path / "log")
        wait(lambda: P.job_rows(spark, f"{tmp_path}/out", "raw").count() == 3)
        # Nothing more comes: shard 2 is found idle while shard 1 isn't.
        wait(lambda: P.job_rows(spark, f"{tmp_path}/out", "metrics").count() == 1)
    finally:
        query.stop()


def test_plan_of_a_stream(spark, twice):
    assert "TransformWithState" in P.plan_of(deduplicated(P.event_stream(spark, str(twice[0]))))
    assert "Scan" in P.plan_of(P.job_rows(spark, str(twice[1]), "raw"))


def run_marked(spark, root, rows, now=0, **job):
    append(rows, root / "log")
    P.start_job(marked(P.event_stream(spark, f"{root}/log"), now=F.lit(now)), P.Job(f"{root}/out", **job), f"{root}/checkpoint").awaitTermination()


def test_a_batch_takes_as_many_tasks_as_it_needs(spark, tmp_path):
    """However many partitions a shuffle has, a small batch is written in few files and needs no state store."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        config = RuntimeConfig(f"{tmp_path}/checkpoint", flush_open_windows=True)
        append(spark.createDataFrame([(f"i{k}", k + 1, 1, 1, "cart", 60_000 + k, k, "r", k) for k in range(200)], P.EVENT), tmp_path / "log")
        P.run_job(spark, f"{tmp_path}/log", f"{tmp_path}/out", config).awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    files = {sink: sum(f.endswith(".parquet") for _, _, names in os.walk(tmp_path / "out" / sink) for f in names) for sink in ("raw", "cart", "parts")}
    assert max(files.values()) <= 8 and not os.listdir(tmp_path / "checkpoint/job").count("state"), files
    assert P.job_rows(spark, f"{tmp_path}/out", "raw").count() == P.job_rows(spark, f"{tmp_path}/out", "cart").count() == 200


def test_the_job_remembers_ids_and_carts_of_its_batches(spark, tmp_path, monkeypatch):
    """As long as the retention, by processing time, through merged folders too; nulls are a cart of their own; what has run out goes."""
    monkeypatch.setattr(P, "PARTS", 2)
    day, minute = 24, 60_000
    batches = [
        (0, [("x", 1, "cart", 9), ("a", None, "cart", 7), ("x", 1, "cart", 10)]), (22, [("x", 1, "buy", 20), ("y", 1, "cart", 8)]), (23, [("z", 1, "buy", 9), ("b", None, "buy", 8), ("y", 1, "cart", 30)]),
        (24, [("x", 1, "pv", 1), ("y", 1, "pv", 2), ("c", 1, "cart", 10)]), (47, [("y", 1, "pv", 3), ("z", 1, "pv", 4), ("d", 1, "cart", 1)]), (99, []), (99, [("e", 1, "pv", 5), ("f", 1, "cart", 2)]),
    ]
    n = itertools.count()
    for now, rows in batches:
        run_marked(spark, tmp_path, spark.createDataFrame([(i, u, 1, 1, kind, minute + ms, k, "r", k) for (i, u, kind, ms), k in zip(rows, n)], P.EVENT), now, retention_ms=day)
    raw = P.job_rows(spark, f"{tmp_path}/out", "raw").orderBy("source_sequence").collect()
    assert [(r.event_id, r.event_time_ms - minute) for r in raw] == [("x", 9), ("a", 7), ("y", 8), ("z", 9), ("b", 8), ("x", 1), ("c", 10), ("y", 3), ("z", 4), ("d", 1), ("e", 5), ("f", 2)]
    carts = P.job_rows(spark, f"{tmp_path}/out", "cart").orderBy("source_sequence").collect()
    assert [(r.user_id, r.operation, r.last_updated_at_ms - minute, r.change) for r in carts] == [(1, "UPSERT", 9, 1), (None, "UPSERT", 7, 1), (1, "DELETE", 9, 2), (None, "DELETE", 8, 2), (1, "UPSERT", 10, 3), (1, "UPSERT", 2, 1)]
    _, state = Commits(spark, f"{tmp_path}/out/commits").last()
    assert [p[1] for p in state["raw"]] == [p[1] for p in state["cart"]] == [99] and os.listdir(tmp_path / "out/held") == []


def test_sinks_of_a_batch_are_written_beside_each_other(spark, tmp_path):
    """Those that need nothing of one another: each waits here until the other is there too."""
    both = {sink: barrier for sinks in (("quality", "cart"), ("metrics", "features")) for barrier in [threading.Barrier(2, timeout=60)] for sink in sinks}
    rows = [("a", 1, "cart", 60_000), ("b", 1, "pv", 300_000), ("c", 1, "pv", 60_001)]
    run_marked(spark, tmp_path, spark.createDataFrame([(i, u, 1, 1, kind, ms, k, "r", k) for k, (i, u, kind, ms) in enumerate(rows)], P.EVENT), after=lambda sink: both[sink].wait() if sink in both else None)
    assert {sink: P.job_rows(spark, f"{tmp_path}/out", sink).count() for sink in P.SINKS} == {"raw": 3, "metrics": 1, "features": 1, "quality": 1, "cart": 1}


def test_parts_of_a_log_are_dealt_in_one_pass(spark, golden, tmp_path):
    """One read of the source makes all parts, which come to the log one by one; one without rows comes as nothing."""
    read = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda x: read.add(1) or x, "long").asNondeterministic()
    streams.log_of(golden.withColumn("arrival", counted("arrival")).withColumn("part", F.when(F.col("arrival") < 100, 0).otherwise(2)), f"{tmp_path}/parts")
    assert read.value == golden.count()
    come = []
    for k in range(3):
        streams.arrive(spark, f"{tmp_path}/parts/part={k}", f"{tmp_path}/log")
        come.append(spark.read.schema(P.EVENT).parquet(f"{tmp_path}/log").count())
    assert come == [12, 12, 24]
    assert sorted(map(repr, spark.read.schema(P.EVENT).parquet(f"{tmp_path}/log").collect())) == sorted(map(repr, golden.select(*P.log_columns()).collect()))


def test_source_of_one_row_group_is_dealt_to_all_tasks(spark, tmp_path):
    rows = replayed(spark, "/root/testdata/sf0.1", spread=True).withColumn("part", F.lit(0))
    streams.log_of(rows, str(tmp_path / "log"))
    assert len(list((tmp_path / "log").glob("part=0/*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "log")).count() == 200_000
