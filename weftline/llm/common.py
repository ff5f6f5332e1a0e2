"""Session helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What counts as white space between words, and a word, in Java, RE2 and Python alike.
WORD = r"[^\x20\x09-\x0D]+"
#: A key with more than this share of all rows is heavy; at most 1 / HEAVY keys can be.
HEAVY = 0.001
#: Spark's setting that drops an action's shuffle files when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=1)
def _own_dir() -> str:
    """For one process: the driver is the only executor, and the folder goes with it."""
    found = tempfile.mkdtemp(prefix="weftline-")
    atexit.register(shutil.rmtree, found, True)
    return found


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = _own_dir()
    return f"{found.rstrip('/')}/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends there, and any executor can be lost.

    The shuffle files of the write go when it has ended, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete the folder that `materialize` wrote for `table`, once nothing will read it any more."""
    spark = table.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def join_to_classes(rows: DataFrame, classes: DataFrame, on: list[str], size: str, total: int) -> DataFrame:
    """`rows` with the columns of `classes`, which has one row for each value of `on` and in `size` how many rows have it.

    Values that more than HEAVY of all rows share, 1 / HEAVY at most, are broadcast, so
    no task gets all rows of one of them; the others meet in an ordinary shuffle.
    """
    bar = HEAVY * total
    heavy = F.broadcast(classes.where(F.col(size) > bar).withColumn("__heavy", F.lit(True)))
    marked = rows.join(heavy, on, "left")
    light = marked.where("__heavy IS NULL").select(*rows.columns).join(classes.where(F.col(size) <= bar), on)
    return marked.where("__heavy").drop("__heavy").unionByName(light)


def whole_row(docs: DataFrame) -> Column:
    """All columns of `docs` as one, `row`; "row.*" gives them back, whatever they are called."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def fresh(taken: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as set it apart from those taken."""
    lowered, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in lowered:
            name = f"_{name}"
        out.append(name)
    return out


def id_bucket(n: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def smallest_broadcast(df: DataFrame, rows: int, bound: int) -> DataFrame:
    """Mark `df` for broadcast only when its counted rows are within `bound`; otherwise Spark shuffles and splits skew."""
    return F.broadcast(df) if rows <= bound else df


def release() -> None:
    """Hand freed memory back: workers wait for their next task beside those at work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return outer
