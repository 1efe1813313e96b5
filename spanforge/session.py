"""Session settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings; ``master`` only for local use."""
    builder = SparkSession.builder.appName("spanforge").config(map=SETTINGS | settings)
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()
