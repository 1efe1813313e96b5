"""Replays that wait until all that speaks about them is ingested.

A stream of manifests is judged batch by batch. A replay is settled when it is attributed, when something speaks against it that no waiting
cures, or after so many tries; until then it waits as state and is judged again with every batch, also with one that brings nothing new. State is a
table for each batch in the shared store, written anew if a batch is repeated, so a restart goes on where the last one ended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from spanforge.operators import attribution

#: The runs and baselines that are there by now.
Known = Callable[[], tuple[DataFrame, DataFrame]]
RESULTS = ("op_id", "file", "failures", "tries", "outcome")


class Retries:
    """Judges manifests in ``foreachBatch``; ``store`` holds ``waiting`` and ``settled`` by batch."""

    def __init__(self, spark: SparkSession, store: str, known: Known, *, tries: int = 10):
        self.spark, self.store, self.known, self.tries = spark, store.rstrip("/"), known, tries

    def _read(self, kind: str, upto: int | None = None) -> DataFrame | None:
        """Rows of ``kind``, of batches before ``upto`` if it is given."""
        try:
            rows = self.spark.read.parquet(f"{self.store}/{kind}")
        except AnalysisException:
            return None
        return rows if upto is None else rows.where(F.col("batch") < upto)

    def _latest(self, upto: int | None = None) -> DataFrame | None:
        """What waits behind the last batch; it may be nothing, so batches are numbered in ``settled`` and ``waiting`` alike by a mark."""
        rows = self._read("waiting", upto)
        if rows is None:
            return None
        last = rows.agg(F.max("batch")).first()[0]
        return rows.where((F.col("batch") == (-1 if last is None else last)) & F.col("replay").isNotNull()).drop("batch")

    def step(self, arrived: DataFrame, batch: int) -> None:
        names = arrived.columns
        pending = arrived.withColumn("tries", F.lit(0))
        if (waiting := self._latest(batch)) is not None:
            pending = pending.unionByName(waiting.select(*names, "tries"))
        settled = self._read("settled", batch)
        taken = None
        if settled is not None:
            pending = pending.join(settled.select("replay"), "replay", "left_anti")
            taken = settled.where("outcome = 'attributed'").select("op_id", "recorded_op_id", "recorded_agent")
        runs, baselines = self.known()
        found = attribution.attributed(pending.drop("tries"), runs, baselines, taken).select("replay", "op_id", "file", "failures", "retryable")
        judged = pending.join(found, "replay").withColumn("tries", F.col("tries") + 1)
        outcome = F.when(F.size("failures") == 0, "attributed").when(~F.col("retryable"), "failed").when(F.col("tries") >= self.tries, "gave up").otherwise("waiting")
        judged = judged.withColumn("outcome", outcome).select(*names, *RESULTS).persist()
        # A row without a replay marks the batch where nothing waits.
        mark = judged.sparkSession.range(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in judged.schema.fields))
        judged.where("outcome <> 'waiting'").write.mode("overwrite").parquet(f"{self.store}/settled/batch={batch}")
        judged.where("outcome = 'waiting'").unionByName(mark).write.mode("overwrite").parquet(f"{self.store}/waiting/batch={batch}")
        judged.unpersist()

    def start(self, manifests: DataFrame, checkpoint: str, every: str = "60 seconds", **trigger: bool) -> StreamingQuery:
        """Runs on the stream ``manifests``, and on a tick ``every`` so often where that brings nothing."""
        ticks = self.spark.readStream.format("rate").load().where("value < 0")
        nothing = ticks.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in manifests.schema.fields))
        writer = manifests.unionByName(nothing).writeStream.foreachBatch(self.step).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"processingTime": every})).start()

    def results(self) -> DataFrame:
        """replay, outcome, tries, op_id, file, failures of all replays so far; what ``attribution.exit_code`` reads."""
        parts = [x.select("replay", *RESULTS) for x in (self._read("settled"), self._latest()) if x is not None]
        if not parts:
            raise ValueError("no batch has been judged yet")
        return parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
