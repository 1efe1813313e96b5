"""Exports that go on: windows that never lose a late span, and content that lands after its span."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_start(end: datetime, *, since: datetime | None = None, hours: float | None = None, stored: datetime | None = None) -> datetime:
    """Where the next window begins: as asked, else so many hours back, else where the last one ended, else a day back."""
    if since is not None:
        return since
    if hours is not None:
        return end - timedelta(hours=hours)
    return stored if stored is not None else end - timedelta(hours=24)


def due_operations(spans: DataFrame, start: datetime, end: datetime, pad_hours: int = 24) -> DataFrame:
    """All spans of operations that have a span in the window, up to ``pad_hours`` outside it, so that operations come whole.
    The condition on time reaches the scan."""
    ts = F.col("ts")
    inside = spans.where((ts >= F.lit(start)) & (ts < F.lit(end))).select("op_id").distinct()
    pad = timedelta(hours=pad_hours)
    return spans.where((ts >= F.lit(start - pad)) & (ts < F.lit(end + pad))).join(inside, "op_id", "left_semi")


def next_watermark(spans: DataFrame, end: datetime) -> DataFrame:
    """The newest time that was exported; the end of the window where nothing was."""
    return spans.agg(F.coalesce(F.max("ts"), F.lit(end)).alias("watermark"))


def enriched(spans: DataFrame, content: DataFrame, *, late: str = "60 seconds", delay: str = "24 hours") -> DataFrame:
    """A stream of spans (id, ts, ...) with content (id, landed, arguments, result) that lands up to ``late`` after them.
    Spans whose content does not come are given out without it, once both streams are past that time."""
    left = spans.withWatermark("ts", delay)
    right = content.select(F.col("id").alias("_id"), "landed", F.col("arguments").alias("_arguments"), F.col("result").alias("_result")).withWatermark("landed", delay)
    on = (F.col("id") == F.col("_id")) & F.expr(f"landed >= ts and landed <= ts + interval {late}")
    return left.join(right, on, "left_outer").withColumn("content_missing", F.col("_id").isNull()).drop("_id")


def sampled(rows: DataFrame, percent: float, *keys: str, seed: int = 0) -> DataFrame:
    """A share of a stream or table, by a hash of the keys. Less than one percent is refused: it may be meant as a fraction."""
    if not 1 <= percent <= 100:
        raise ValueError("a share is given in percent, from 1 to 100")
    return rows.where(F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1_000_000)) < int(percent * 10_000))
