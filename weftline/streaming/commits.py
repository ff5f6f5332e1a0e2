"""One commit for all that a batch writes (OP-47..49)."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Commits that are kept; what only older ones name may be removed.
KEPT = 2


class Commits:
    """Small files by batch number, in a folder that all can see; each says what there is once that batch is done.

    A commit comes into being by the renaming of a file, so a reader sees all of a batch's sinks or none of them. A
    batch that runs again writes the same folders again, or, if its commit is there, nothing.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        self.files = self.at.getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        if not self.files.exists(self.at):
            return []
        return sorted(int(s.getPath().getName()) for s in self.files.listStatus(self.at) if s.getPath().getName().isdigit())

    def _path(self, name: str) -> Any:
        return self.at.suffix(f"/{name}")

    def last(self) -> tuple[int, dict] | tuple[None, None]:
        """(number, what was put) of the newest commit."""
        numbers = self.numbers()
        if not numbers:
            return None, None
        source = self.files.open(self._path(str(numbers[-1])))
        try:
            return numbers[-1], json.loads(bytes(source.readAllBytes()).decode())
        finally:
            source.close()

    def put(self, number: int, state: dict) -> None:
        draft = self._path(f".{number}.draft")
        sink = self.files.create(draft, True)
        sink.write(bytearray(json.dumps(state).encode()))
        sink.close()
        if not self.files.rename(draft, self._path(str(number))):
            raise RuntimeError(f"commit {number} could not be made")
        for old in self.numbers()[:-KEPT]:
            self.files.delete(self._path(str(old)), False)

    def remove(self, folder: str) -> None:
        """Delete a folder beside the commits."""
        self.files.delete(self.at.getParent().suffix(f"/{folder}"), True)


def read_sink(spark: SparkSession, path: str, sink: str, schema: str) -> DataFrame:
    """What the committed batches wrote to a sink, with the number of the `batch`; empty where there is no commit."""
    commits = Commits(spark, f"{path}/commits")
    number, _ = commits.last()
    if number is None or not commits.files.exists(commits.at.getParent().suffix(f"/{sink}")):
        return spark.createDataFrame([], f"{schema}, batch int")
    return spark.read.schema(f"{schema}, batch int").parquet(f"{path}/{sink}").where(F.col("batch") <= number)
