import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


# User, item, category, behavior, seconds after 1511658000.
FIXTURE = [(1, 100, 10, "cart", 0), (1, 100, 10, "pv", 1), (2, 100, 10, "fav", 2), (-1, 200, 20, "pv", 3), (1, 101, 11, "cart", 4), (1, 101, 11, "cart", 5), (2, 102, 12, "cart", 6), (2, 102, 12, "buy", 7), (1, 100, 10, "buy", 8), (1, 100, 10, "pv", 70), (2, 103, 13, "buy", 10), (2, 104, 14, "pv", 71)]


@pytest.fixture(scope="session")
def golden(spark):
    from weftline.functions.scalar import event_identity

    rows = [(u, i, c, b, (1511658000 + t) * 1000, k, f"golden-{run}", n * 100 + k) for n, run in enumerate("ab") for k, (u, i, c, b, t) in enumerate(FIXTURE)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, category_id long, behavior_type string, event_time_ms long, source_sequence long, replay_run_id string, arrival long")
    return df.withColumn("event_id", event_identity())
