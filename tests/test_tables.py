"""Tables kept up to date, read by key or time, and the version guard over a stream."""

import os
import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import serving as S
from weftline.operators import tables as T
from weftline.streaming.commits import Commits
from weftline.streaming.guard import CHANGE, guarded_stream
from weftline.streaming.state import STATE_CONF


def files_of(path):
    return sorted(f"{d.removeprefix(str(path))}/{f}" for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def observed(spark, rows):
    return spark.createDataFrame(rows, "product_id long, category_id long, observations long")


def test_deltas_of_observations_equal_one_full_run(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(rnd.randrange(40), rnd.randrange(4), rnd.randint(1, 3)) for _ in range(400)]
    table = T.observation_table(spark, str(tmp_path), 8)
    for k in range(4):
        table.apply(observed(spark, rows[k::4]))
    whole = observed(spark, rows).groupBy("product_id", "category_id").agg(F.sum("observations").alias("observations"))
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, whole.collect()))
    assert sorted(map(tuple, T.dominant_of(table).collect())) == sorted(map(tuple, S.dominant_category(whole).collect()))
    # A delta of one product reads and writes its bucket alone.
    before = files_of(tmp_path)
    touched = table.apply(observed(spark, [(7, 9, 1000)]))
    assert len(touched) == 1 and {f.split("/")[2] for f in set(files_of(tmp_path)) - set(before)} == {f"bucket={touched[0]}"}
    assert (7, 9) in [tuple(r) for r in T.dominant_of(table, touched).collect()]
    assert all(f"bucket={touched[0]}/" in name for name in T.dominant_of(table, touched).inputFiles())


def test_a_delta_that_comes_again_changes_nothing(spark, tmp_path):
    table = T.observation_table(spark, str(tmp_path), 4)
    assert table.read().count() == 0 and table.read(1).count() == 0
    table.apply(observed(spark, [(1, 1, 5), (None, 2, 1)]), 0)
    assert table.apply(observed(spark, [(1, 1, 5)]), 0) == []
    table.apply(observed(spark, []), 1)
    assert sorted(map(repr, map(tuple, table.read().collect()))) == ["(1, 1, 5)", "(None, 2, 1)"]


def test_disk_stays_with_the_live_rows(spark, tmp_path):
    """Of each bucket there is what counts and what the last delta replaced, however many deltas came."""
    table = T.cart_table(spark, str(tmp_path), 2)
    for k in range(25):
        rows = [(u, k % 3, "UPSERT", 1, k, k, k) for u in range(6)]
        table.apply(spark.createDataFrame(rows, table.schema))
        assert len(files_of(tmp_path)) <= 4
    assert {tuple(r) for r in table.read(3).select("item_id", "change").collect()} == {(0, 24), (1, 22), (2, 23)}
    assert len(Commits(spark, f"{tmp_path}/commits").numbers()) == 2


def test_a_lookup_reads_one_bucket(spark, tmp_path):
    table = T.feature_table(spark, str(tmp_path), 16)
    table.apply(spark.createDataFrame([(u, f"f{u}", 1, 1, 5, 6) for u in range(200)] + [(3, "new", 2, 1, 9, 10), (4, "old", 2, 1, 4, 5)], table.schema))
    for user in (3, 4, 150):
        found = table.read(user)
        assert len({os.path.dirname(f) for f in found.inputFiles()}) == 1 and len(table.read().inputFiles()) >= 10
    assert [table.read(u).first().feature_id for u in (3, 4)] == ["new", "f4"]


def test_a_stream_of_changes_into_a_table(spark, tmp_path):
    spark.conf.set(*STATE_CONF)
    table = T.cart_table(spark, f"{tmp_path}/table", 4)
    for k in range(3):
        spark.createDataFrame([(1, k, "UPSERT", 1, k, k, 1), (2, 0, "DELETE" if k == 1 else "UPSERT", 1, k, k, 3 - k)], table.schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
        table.follow(spark.readStream.schema(table.schema).parquet(f"{tmp_path}/log"), f"{tmp_path}/checkpoint").awaitTermination()
    assert sorted((r.user_id, r.item_id, r.change) for r in table.read().collect()) == [(1, 0, 1), (1, 1, 1), (1, 2, 1), (2, 0, 3)]


def test_trending_reads_the_hours_of_its_time_alone(spark, tmp_path):
    hour = T.HOUR
    rows = [(h * hour + m * 60_000, 1 + m % 2, 5, 1, 1) for h in range(10) for m in (0, 30, 59)]
    metrics = spark.createDataFrame(rows, "window_start_ms long, item_id long, pv_count long, cart_count long, buy_count long")
    T.write_rollup(metrics, str(tmp_path))
    found = T.rollup_range(spark, str(tmp_path), 5 * hour + 60_000, 15)
    assert {r.window_start_ms for r in found.collect()} == {4 * hour + 59 * 60_000, 5 * hour}
    assert "PartitionFilters: [isnotnull(hour" in found._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")) and len({r[0] for r in found.select("hour").distinct().collect()}) == 2
    catalog = spark.createDataFrame([(1, "a", 1.0, True), (2, "b", 2.0, True)], "product_id long, product_name string, price double, is_active boolean")
    for as_of, minutes in ((5 * hour + 60_000, 15), (6 * hour, 61), (20 * hour, 5)):
        want = S.trending(metrics, catalog, as_of, minutes).collect()
        assert T.trending_of_rollup(spark, str(tmp_path), catalog, as_of, minutes).collect() == want
    # An hour that is written again replaces its own rows alone.
    T.write_rollup(metrics.where(f"window_start_ms >= {9 * hour}").limit(1), str(tmp_path))
    assert spark.read.parquet(str(tmp_path)).count() == len(rows) - 2


@pytest.mark.parametrize("batches", [1, 4])
def test_guard_of_a_stream_equals_the_guard_of_a_table(spark, tmp_path, batches):
    spark.conf.set(*STATE_CONF)
    rnd = random.Random(6)
    from decimal import Decimal

    rows = [(rnd.choice("uuuud"), n, rnd.choice((1, 2, 3, 3, None)), rnd.choice((1, 1, 2, 0)), rnd.choice(("a", "a", "b", " ")), rnd.choice((Decimal("1.00"), Decimal("1.00"), Decimal("2.50"), None)), rnd.choice((True, True, None)), "t", rnd.randint(0, 4)) for n in range(160)]
    step = len(rows) // batches
    for k in range(batches):
        spark.createDataFrame(rows[k * step : (k + 1) * step], CHANGE).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
        stream = guarded_stream(spark.readStream.schema(CHANGE).parquet(f"{tmp_path}/log"))
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(f"{CHANGE}, decision string").parquet(f"{tmp_path}/out")
    want = S.version_guard(spark.createDataFrame(rows, CHANGE)).select(*got.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert len({r.decision for r in got.collect()}) == 5
