"""A limit of rows of each hour on a stream, whatever its micro-batches are.

The state of an hour (of each key) is the number of rows that it has let through; it holds across micro-batches and restarts, and a timer drops
it when the watermark has passed the hour, behind which rows come too late to count. Before rows are shuffled to the state, each
partition leaves only those that may still be let through, ``most`` of each hour, so a busy hour is no hot group.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

HOUR = 3_600_000


class _Hour(StatefulProcessor):
    def __init__(self, most: int, order: list[str], columns: list[str]):
        self.most, self.order, self.columns = most, order, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.passed = handle.getValueState("passed", T.StructType([T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n = self.passed.get()[0] if self.passed.exists() else 0
        if not self.passed.exists():
            self.handle.registerTimer(int(key[-1]) * HOUR + HOUR)
        # No more than ``most`` rows of each partition come here; the earliest of all are let through.
        first = pd.DataFrame()
        for part in rows:
            first = pd.concat([first, part]).sort_values(self.order, kind="stable").head(max(self.most - n, 0))
        self.passed.update((n + len(first),))
        if len(first):
            yield first[self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.passed.clear()
        return iter(())

    def close(self) -> None:
        pass


def capped_by_hour(rows: DataFrame, most: int, *keys: str, ts: str = "ts", order: tuple[str, ...] = (), delay: str = "1 hour") -> DataFrame:
    """At most ``most`` rows of each hour of ``ts`` for each value of ``keys``: of those of one micro-batch the earliest, by ``ts`` and then ``order``. ``rows`` is a
    stream; rows later than ``delay`` behind the newest are dropped. The session keeps its state in RocksDB."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    by, columns = [ts, *order], rows.columns
    hourly = rows.withColumn("_hour", F.floor(F.unix_millis(F.col(ts).cast("timestamp")) / HOUR).cast("long"))
    schema = hourly.schema

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = pd.DataFrame()
        for batch in batches:
            kept = pd.concat([kept, batch]).sort_values(by, kind="stable")
            kept = kept.groupby([*keys, "_hour"], dropna=False, sort=False).head(most)
        if len(kept):
            yield kept

    few = hourly.mapInPandas(first, schema).withWatermark(ts, delay)
    return few.groupBy(*keys, "_hour").transformWithStateInPandas(_Hour(most, by, columns), rows.schema, "Append", "EventTime")
