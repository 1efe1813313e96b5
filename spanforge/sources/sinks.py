"""Sinks: runs, summaries, spans and how far they go, recordings, datasets, a registry of skills, and writes that are all or nothing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from spanforge.operators.dataset import refused_columns
from spanforge.operators.recordings import recordings
from spanforge.operators.redaction import sidecar
from spanforge.sources.commits import CommitLog
from spanforge.streaming.incremental import next_watermark


def write_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_summary(df: DataFrame, path: str) -> None:
    """CSV with a header; nothing is written of no rows."""
    if df.head(1):
        df.write.mode("overwrite").option("header", True).csv(path)


def write_recordings(interactions: DataFrame, path: str, *, strict: bool = False, folders: int = 64) -> None:
    """``interactions`` and a header for each recording, in as many folders as asked, each with whole operations; ``strict``
    leaves out operations with a truncated answer."""
    if strict:
        lossy = interactions.where("truncated").select("op_id").distinct()
        interactions = interactions.join(lossy, "op_id", "left_anti")
    dealt = interactions.withColumn("folder", F.pmod(F.xxhash64("op_id"), F.lit(folders)))
    dealt.write.mode("overwrite").partitionBy("folder").json(f"{path}/interactions")
    recordings(interactions).write.mode("overwrite").json(f"{path}/headers")


def write_spans(spans: DataFrame, path: str, **window: str) -> DataFrame:
    """Spans by day, and one row on the export next to them: what was asked (``window``), and how many spans and operations came."""
    spans.withColumn("day", F.to_date("ts")).write.mode("overwrite").partitionBy("day").parquet(f"{path}/spans")
    told = spans.agg(F.count("*").alias("spans"), F.count_distinct("op_id").alias("operations"))
    told = told.select(*(F.lit(v).alias(k) for k, v in window.items()), "*")
    told.write.mode("overwrite").json(f"{path}/meta")
    return told


def save_watermark(spans: DataFrame, end: datetime, store: str) -> None:
    """Adds where an export has ended: its newest span, or the end of its window."""
    row = next_watermark(spans, end).join(spans.agg(F.count("*").alias("exported")))
    row.withColumn("saved", F.current_timestamp()).write.mode("append").parquet(store)


def stored_watermark(spark: SparkSession, store: str) -> datetime | None:
    """Where the export that was saved last has ended, if any was."""
    try:
        return spark.read.parquet(store).agg(F.max_by("watermark", "saved")).first()[0]
    except AnalysisException:
        return None


def write_dataset(rows: DataFrame, path: str) -> None:
    """Rows for graders as JSON lines. Refused are columns of objects, and rows in which no message has content."""
    if refused := refused_columns(rows):
        raise ValueError(f"columns of objects: {', '.join(refused)}")
    if "messages" in rows.columns:
        said = F.exists("messages", lambda m: F.coalesce(m["content"], F.lit("")) != "")
        if n := rows.where(F.col("messages").isNotNull() & ~said).count():
            raise ValueError(f"{n} rows have no message with content")
    rows.write.mode("overwrite").json(path)


def write_outcomes(outcomes: DataFrame, path: str, key: str = "orchestration_key") -> DataFrame:
    """Review outcomes as JSON lines; rows, and how many of them can be joined to an operation."""
    outcomes.write.mode("overwrite").json(path)
    return outcomes.agg(F.count("*").alias("rows"), F.count_if(F.coalesce(F.col(key), F.lit("")) != "").alias("keyed"))


def write_scrubbed(rows: DataFrame, found: DataFrame, salt: str, path: str, source: str) -> DataFrame:
    """Scrubbed rows, and next to them one row on which salt and list they were scrubbed with, without either; as one version, so
    none is there without the other. Returns that row."""
    told = sidecar(rows.sparkSession, found, salt, source)
    CommitLog(rows.sparkSession, path).write(lambda _: {"rows": rows, "scrub": told})
    return read_together(rows.sparkSession, path, "scrub")


def append_summary(spark: SparkSession, text: str, path: str) -> None:
    """Adds a report to those that are there."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(path)


def append_skills(spark: SparkSession, skills: DataFrame, registry: str) -> DataFrame:
    """Adds skill bodies that ``registry`` doesn't hold, once for each hash whoever else is adding, and returns what was added. Truncated,
    failed and empty bodies are never stored. ``skills``: op_id, started, ord, skill_name, sha256, body, truncated, errored."""
    whole = skills.where("not truncated and not errored and body <> ''")
    first = whole.groupBy("sha256").agg(
        F.min_by(F.struct("skill_name", "body", F.col("started").alias("first_seen")), F.struct("ord", "op_id")).alias("x")
    ).select("sha256", "x.*")
    log = CommitLog(spark, registry)

    def new(base: int) -> dict[str, DataFrame]:
        held = log.read_all("skills", version=base)
        rows = first if held is None else first.join(held.select("sha256"), "sha256", "left_anti")
        return {} if rows.isEmpty() else {"skills": rows}

    before = log.latest()
    version = log.write(new)
    return first.limit(0) if version == before else log.read("skills", version=version)


def registered_skills(spark: SparkSession, registry: str) -> DataFrame | None:
    """All bodies that ``registry`` holds."""
    return CommitLog(spark, registry).read_all("skills")


def write_together(frames: dict[str, DataFrame], failures: DataFrame, root: str, *, after: int | None = None) -> bool:
    """Writes all of ``frames`` (name to rows) below ``root`` as its next version if there are no ``failures``, else none of them. Versions of other
    writers stay in the log; where these must follow version ``after``, another one in between is a ``Conflict``."""
    if failures.head(1):
        return False
    CommitLog(failures.sparkSession, root).write(lambda _: frames, after=after)
    return True


def read_together(spark: SparkSession, root: str, name: str, *, version: int | None = None) -> DataFrame | None:
    """The rows of ``name`` of the last version, or of the last up to ``version``."""
    return CommitLog(spark, root).read(name, version=version)


def markdown(rows: Sequence, columns: Sequence[str], *, most: int = 25) -> str:
    """A table of the first rows of a report that is small already, and how many more there are."""
    lines = [f"| {' | '.join(columns)} |", f"|{'---|' * len(columns)}"]
    lines += [f"| {' | '.join('' if r[c] is None else str(r[c]) for c in columns)} |" for r in rows[:most]]
    return "\n".join(lines + [f"and {len(rows) - most} more"] * (len(rows) > most)) + "\n"
