"""The twelve-row fixture in two replays, parity with SQL, ingest and guards."""

import duckdb
import pytest
from pyspark.sql import functions as F

from weftline.config import RuntimeConfig, kafka_options
from weftline.functions.scalar import event_identity
from weftline.operators import events as E
from weftline.operators import serving as S
from weftline.plans import registry
from weftline.sources import ingest

SF = "/root/testdata/sf0.001"


def test_golden_accounting_and_identity(golden):
    unique = E.accepted(golden)
    assert E.accounting(golden, unique).first().asDict() == {"source_rows": 24, "decoded": 24, "producer_rejected": 0, "invalid": 2, "valid": 22, "accepted_unique": 11, "duplicate": 11, "late": 1, "on_time": 10}
    assert unique.where("source_sequence = 0").first().event_id == "e3232a8494b32c8e185c385c0216cdc23a6c283867bdb0c627505e46b7ab7a21"


def test_golden_metrics_features_quality_cart(golden):
    unique = E.accepted(golden)
    metrics = E.closed_windows(E.item_metrics(E.on_time(unique)), golden)
    assert sorted((r.item_id, r.pv_count, r.cart_count, r.fav_count, r.buy_count, r.unique_users) for r in metrics.collect()) == [(100, 1, 1, 1, 1, 2), (101, 0, 2, 0, 0, 1), (102, 0, 1, 0, 1, 1)]
    features = E.closed_windows(E.user_features(E.on_time(unique)), golden)
    assert {r.user_id: r.feature_id[:8] for r in features.collect()} == {1: "38c38b84", 2: "97994506"}
    assert sorted(r.quality_event_id[:8] for r in E.quality_events(golden, unique).collect()) == ["45261c00", "6d8fda92", "88e3f46d"]
    assert [(r.user_id, r.value) for r in S.active_cart(E.cart_mutations(E.latest_cart(unique)), unique.where("behavior_type = 'cart'").withColumnRenamed("event_time_ms", "last_updated_at_ms")).collect()] == [(1, "11|1511658005000|1511658005000")]


def test_watermark_by_stretches_equals_the_plain_window(spark, monkeypatch):
    from pyspark.sql import Window

    monkeypatch.setattr(E, "STRETCH", 7)
    rows = spark.range(100).select(F.col("id").alias("arrival"), F.col("id").alias("source_sequence"), (F.abs(F.hash("id")) % 1000).cast("long").alias("event_time_ms"))
    plain = F.max("event_time_ms").over(Window.orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)) - 5
    assert E.with_watermark(rows, 5).withColumn("plain", plain).where(~F.col("plain").eqNullSafe(F.col("watermark_ms"))).count() == 0


PARITY = """
item_metrics_1m user_features_1m quality_events active_cart active_cart_short_ttl catalog_version_guard trending ingest_parse csv_scan csv_quoted csv_event_batches replay_output
messages_raw messages_quality messages_catalog catalog_manifest catalog_loaded catalog_cdc latest_of_versions feature_contract user_cart_lookup user_feature_lookup replay_schedule
stream_accepted stream_user_features stream_item_metrics stream_quality stream_cart_latest job_raw job_metrics job_features job_quality job_cart stream_late_shard stream_idle_shard
served_carts served_cart_lookup catalog_observed stream_version_guard trending_of_rollup
""".split()


@pytest.mark.parametrize("name", PARITY)
def test_parity_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("events", "part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = registry.queries()[name](spark, SF)
    cursor = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r) for r in cursor.fetchall()))) == sorted(repr(tuple(r[c] for c in names)) for r in got.collect())


def test_user_cart_lookup_with_a_gap_beyond_the_ttl(spark, tmp_path):
    """The lookup has what the SQL has: items from before a gap too, as in a store that was rebuilt."""
    rows = [(1, 1, 7, "signup", '{"k": 5}'), (2, 12, 7, "signup", '{"k": 6}'), (3, 13, 7, "signup", '{"k": 8}'), (4, 14, 7, "purchase", '{"k": 8}')]
    days = spark.createDataFrame(rows, "event_id long, day int, user_id long, event_type string, props string")
    days.select("event_id", F.make_timestamp_ntz(F.lit(2024), F.lit(1), "day", F.lit(0), F.lit(0), F.lit(0)).alias("ts"), "user_id", "event_type", "props").write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    cursor = con.execute(registry.oracle_sql()["user_cart_lookup"])
    got = registry.queries()["user_cart_lookup"](spark, str(tmp_path))
    names = [d[0] for d in cursor.description]
    assert [r.product_id for r in got.collect()] == [5, 6]
    assert sorted(cursor.fetchall()) == sorted(tuple(r[c] for c in names) for r in got.collect())


def test_csv_scan_keeps_ordinals(spark, tmp_path):
    text = "﻿user_id,item_id,category_id,behavior_type,timestamp\n1,2,3,pv,4\n\nuser_id,item_id,category_id,behavior_type,timestamp\n\"1\n\",2,3,pv,4\n1,2,3,zz,4\n"
    (tmp_path / "a.csv").write_text(text, encoding="utf-8")
    rows = ingest.csv_rows(spark, str(tmp_path / "a.csv"))
    got = {r.source_sequence: (r.reason, r.user_id) for r in ingest.parse_rows(rows, "run").collect()}
    assert got == {0: (None, 1), 1: ("COLUMN_COUNT", None), 2: ("NOT_AN_INTEGER", None), 3: (None, 1), 4: ("BEHAVIOR_TYPE", 1)}


def test_settings():
    with pytest.raises(ValueError):
        RuntimeConfig("")
    with pytest.raises(ValueError):
        kafka_options("b:1", "SASL_SSL", "PLAIN", "u", "")
    assert kafka_options("b:1")["kafka.security.protocol"] == "PLAINTEXT"
    assert kafka_options("b:1", "SASL_SSL", "PLAIN", jaas="own")["kafka.sasl.jaas.config"] == "own"
    with pytest.raises(ValueError):
        kafka_options("b:1", jaas="own")


def test_feature_guard(spark):
    row = lambda v, n=1: (1, "f", "a", "b", n, n, 0, 0, 0, 1, v)
    schema = "user_id long, feature_id string, window_start string, window_end string, event_count long, pv_count long, cart_count long, fav_count long, buy_count long, distinct_items long, feature_version long"
    current = spark.createDataFrame([row(5, 7)], schema)
    got = S.online_features(spark.createDataFrame([row(5, 9), row(4, 8)], schema), current).first()
    assert (got.feature_version, got.event_count) == (5, 7)


def test_catalog_is_written_whole_with_a_digest(spark, tmp_path):
    path, rows = str(tmp_path / "c"), spark.createDataFrame([(2, 5), (1, 7), (1, 6), (1, 7)], "item_id long, category_id long")
    with pytest.raises(FileNotFoundError):
        S.catalog_folder(spark, path)
    catalog = S.generate_catalog(rows)
    for k in range(3):
        S.write_catalog(catalog.withColumn("catalog_version", F.lit(k).cast("long")), path, 2)
        digests = S.file_digests(spark, path).collect()
        assert digests and all(len(d.catalog_sha256) == 64 for d in digests)
        with pytest.raises(ValueError):
            S.write_catalog(catalog, path, 3)
        got = S.loaded_catalog(spark, path, catalog.schema).collect()
        assert sorted((r.product_id, r.catalog_version) for r in got) == [(1, k), (2, k)]
    assert len([p for p in (tmp_path / "c").iterdir() if p.name.startswith("load=")]) == 2


def test_lookups_without_anything(spark):
    features = S.online_features(spark.createDataFrame([(1, "f", "a", "b", 1, 1, 0, 0, 0, 1, 5)], "user_id long, feature_id string, window_start string, window_end string, event_count long, pv_count long, cart_count long, fav_count long, buy_count long, distinct_items long, feature_version long"))
    got = S.user_feature_lookup(spark, features, 9, 0).first()
    assert (got.available, got.ttl_seconds) == (False, -2)
    with pytest.raises(ValueError):
        S.user_feature_lookup(spark, features, 0, 0)


def test_csv_scan_numbers_files_in_path_order_and_splits_them(spark, tmp_path):
    for k in range(9):
        (tmp_path / f"part-{k}.csv").write_text(f"{k},2,3,pv,4\n" + (f"{k},x\n\n" if k % 2 else "") + ("user_id,item_id,category_id,behavior_type,timestamp\n" if k == 4 else ""))
    want = [(tuple(v.split(",")) if v else ()) for k in range(9) for v in (tmp_path / f"part-{k}.csv").read_text().splitlines()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 30)
    try:
        assert [tuple(r.raw_values) for r in ingest.csv_rows(spark, str(tmp_path)).orderBy("source_sequence").collect()] == want
        (tmp_path / "part-3.csv").write_text('a"b,"c,""d",3\n"open\nline",1\n')
        got = [tuple(r.raw_values) for r in ingest.csv_rows(spark, str(tmp_path)).orderBy("source_sequence").collect()]
        assert got[5:7] == [('a"b', 'c,"d', "3"), ("open\nline", "1")] and len(got) == len(ingest_lines(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def ingest_lines(folder):
    import csv

    return [row for path in sorted(folder.iterdir()) if path.suffix == ".csv" for row in csv.reader(path.open(newline=""))]


def test_lines_that_end_within_quotes(spark):
    import csv
    import itertools

    lines = ["".join(x) for n in range(7) for x in itertools.product('",a', repeat=n)]
    found = spark.createDataFrame([(x,) for x in lines], "v string").select("v", F.col("v").rlike(ingest._OPEN)).collect()
    for v, is_open in found:
        assert is_open == (len(list(csv.reader([v + "\n", "z\n"]))) == 1), v


def test_a_cart_that_expired_does_not_come_back(spark):
    hour = 3_600_000
    rows = [("UPSERT", 1, 10, 5, 0), ("UPSERT", 1, 11, 5, 3 * hour), ("DELETE", 1, 12, 5, 4 * hour), ("UPSERT", 2, 10, 5, 0), ("UPSERT", 2, 11, 5, hour - 1)]
    mutations = spark.createDataFrame([(*r, r[-1]) for r in rows], "operation string, user_id long, item_id long, category_id long, added_at_ms long, last_updated_at_ms long")
    got = {(r.user_id, r.item_id): r.expires_at_ms for r in S.active_cart(mutations, mutations.where("operation = 'UPSERT'"), 3600).collect()}
    assert got == {(1, 11): 4 * hour, (2, 10): 2 * hour - 1, (2, 11): 2 * hour - 1}


def test_missing_values_break_the_contract(spark):
    names = ["user_id", "feature_version", "feature_id", "event_count", "distinct_items", "pv_count", "cart_count", "fav_count", "buy_count"]
    fine = [1, 5, "f", 2, 1, 2, 0, 0, 0]
    rows = [fine] + [[None if k == n else v for k, v in enumerate(fine)] for n in range(9)]
    schema = ", ".join(f"{n} {'string' if n == 'feature_id' else 'long'}" for n in names)
    got = [r[0] for r in spark.createDataFrame([tuple(r) for r in rows], schema).select(S.feature_contract()).collect()]
    assert got == [None, "user_id", "feature_version", "feature_id"] + ["counts"] * 6


def test_rows_without_arrival_are_kept(spark):
    rows = spark.createDataFrame([(None, 1, 50_000), (3, 2, 10_000), (4, 3, 90_000)], "arrival long, source_sequence long, event_time_ms long")
    assert sorted((r.source_sequence, r.watermark_ms) for r in E.with_watermark(rows).collect()) == [(1, None), (2, 45_000), (3, 45_000)]


def test_replay_writes_events_and_rejects(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,2,3,pv,4\n1,2\n")
    source, out, bad = (str(tmp_path / x) for x in ("a.csv", "out", "bad"))
    parsed = ingest.parse_rows(ingest.csv_rows(spark, source), "run")
    assert ingest.write_replay(parsed, source, out, bad).first().asDict() == {"source_rows": 2, "emitted_events": 1, "invalid_rows": 1, "batches": 1}
    assert spark.read.json(bad).first().reason == "COLUMN_COUNT" and spark.read.json(out).count() == 1
    with pytest.raises(FileExistsError):
        ingest.write_replay(parsed, source, out, str(tmp_path / "new"))
    with pytest.raises(ValueError):
        ingest.write_replay(parsed, source, out, out, force=True)


@pytest.mark.parametrize("seed, compressed", [(1, False), (2, False), (3, True)])
def test_csv_records_over_lines_and_splits(spark, tmp_path, seed, compressed):
    """Random quotes and line ends, in splits of 40 bytes, against Python's reader over whole files."""
    import csv
    import gzip
    import io
    import random

    rnd, want = random.Random(seed), []
    for k in range(5):
        rows = [[rnd.choice(["1", "a b", 'say ""x""', "", "x\ny", "\n\n\n", 'q"q', ",", "é" * 9, '"']) for _ in range(rnd.randint(1, 4))] for _ in range(rnd.randint(0, 30))]
        out = io.StringIO()
        for row in rows:
            out.write(",".join(f'"{v.replace(chr(34), chr(34) * 2)}"' if rnd.random() < 0.2 or set(v) & set('\n,"') and not v.startswith("q") else v for v in row) + "\n" * rnd.choice((1, 1, 1, 2)))
        if k == 1:
            out = io.StringIO('"user_id", item_id,"category_id",behavior_type ,timestamp\n' + out.getvalue())
        text = ("\ufeff" if k % 2 else "") + out.getvalue()
        if compressed:
            (tmp_path / f"p{k}.csv.gz").write_bytes(gzip.compress(text.encode()))
        else:
            (tmp_path / f"p{k}.csv").write_text(text, encoding="utf-8", newline="")
        want += [tuple(r) for r in csv.reader(io.StringIO(text.removeprefix("\ufeff"), newline=""))]
    spark.conf.set("spark.sql.files.maxPartitionBytes", 40)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        got = ingest.csv_rows(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [tuple(r.raw_values) for r in sorted(got, key=lambda r: r.source_sequence)] == want
    assert sorted(r.source_sequence for r in got) == list(range(len(want)))


def test_integers_are_read_as_python_does(spark):
    given = ["1", "+1", "-1", " 7\t", "1_000", "1__0", "_1", "1_", "0x1", "1.0", "", " ", "5\x00", "\x1f5", "007", "9223372036854775807", "9223372036854775808", "1e3", "--1"]

    def plain(v):
        try:
            return int(v.strip(" \t\n\r\x0b\x0c"))
        except ValueError:
            return None

    rows = spark.createDataFrame([(k, [v, "1", "1", "pv", "1"]) for k, v in enumerate(given)], "source_sequence long, raw_values array<string>")
    got = [r.user_id for r in ingest.parse_rows(rows, "run").orderBy("source_sequence").collect()]
    want = [plain(v) for v in given]
    assert got == [None if v is not None and v >= 1 << 63 else v for v in want[:13]] + [None] + want[14:16] + [None] + want[17:]


def test_batches_of_events_and_rejects(spark):
    rows = spark.createDataFrame([(k, ["1", "2", "3", "pv" if k % 3 else "zz", "4"]) for k in range(7)], "source_sequence long, raw_values array<string>")
    got = ingest.event_batches(ingest.parse_rows(rows, "run"), 3).orderBy("batch").collect()
    assert [(r.batch, r.source_rows, r.events, list(r.rejects)) for r in got] == [(0, 3, 2, [0]), (1, 3, 2, [3]), (2, 1, 0, [6])]
    with pytest.raises(ValueError):
        ingest.event_batches(ingest.parse_rows(rows, "run"), 0)
