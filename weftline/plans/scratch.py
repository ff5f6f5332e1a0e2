"""Folders for tables that queries write and read again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


@lru_cache(maxsize=1)
def _own_dir() -> str:
    found = tempfile.mkdtemp(prefix="weftline-")
    atexit.register(shutil.rmtree, found, True)
    return found


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder in spark.checkpoint.dir; in local mode one of our own where that is unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = _own_dir()
    return f"{shared.rstrip('/')}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
