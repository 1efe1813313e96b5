"""Tables that a job writes to the folder shared by driver and executors, and reads back: cuts lineage, and survives lost executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: The folder made where the session names none.
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only where that is unset, as in tests on one machine, a temporary folder, removed at exit."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not _made:
        _made.append(tempfile.mkdtemp(prefix="spanforge-"))
        atexit.register(shutil.rmtree, _made[0], ignore_errors=True)
    return f"file://{_made[0]}"


class Scratch:
    """Tables of one job, under one folder; ``drop`` deletes those that are no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.at, self.n = spark, f"{shared_dir(spark)}/spanforge/{name}-{uuid.uuid4().hex}", 0

    def stored(self, df: DataFrame) -> DataFrame:
        self.n += 1
        df.write.parquet(f"{self.at}/{self.n}")
        return self.spark.read.schema(df.schema).parquet(f"{self.at}/{self.n}")

    def drop(self, n: int) -> None:
        """Deletes the table that was stored as the ``n``-th."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.at}/{n}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
