"""Graders of one's own: a function over the columns that its arguments name.

A grader is a Python function. Its arguments name columns of the table that is graded, one with a default may be absent, and settings are given by keyword.
What it returns is declared, so results are columns, and a table without a column that is needed fails when the query is analysed, not when it
runs. Of each numeric output there is one aggregate. The registry of graders is data: description, categories, display name, threshold and pinned version.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


@dataclass(frozen=True)
class Grader:
    """``outputs``: the fields of what ``grade`` returns (a dict, or the one value of a single output), as a Spark schema."""

    name: str
    grade: Callable
    outputs: str
    threshold: float | None = None
    gating: bool = False
    display_name: str = ""
    description: str = ""
    categories: tuple[str, ...] = ()
    settings: dict[str, object] = field(default_factory=dict)

    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.outputs)

    def needs(self) -> tuple[list[str], list[str]]:
        """Arguments without and with a default, but for those that settings fill."""
        given = [p for p in inspect.signature(self.grade).parameters.values() if p.name not in self.settings and p.kind not in (p.VAR_POSITIONAL, p.VAR_KEYWORD)]
        return [p.name for p in given if p.default is p.empty], [p.name for p in given if p.default is not p.empty]


def missing_columns(rows: DataFrame, grader: Grader) -> list[str]:
    return [c for c in grader.needs()[0] if c not in rows.columns]


def graded(rows: DataFrame, *graders: Grader) -> DataFrame:
    """``rows`` with a struct of outputs for each of ``graders``, under its name. Graders see only the columns that they name. One that raises
    fails the job, and one that returns nothing gives nulls."""
    for grader in graders:
        if absent := missing_columns(rows, grader):
            raise AnalysisException(f"grader {grader.name} needs columns that the table lacks: {', '.join(absent)}")
        if grader.name in rows.columns:
            raise AnalysisException(f"the table has a column {grader.name} already")
    return rows.select("*", *(_output(rows, g).alias(g.name) for g in graders))


def _output(rows: DataFrame, grader: Grader) -> Column:
    needed, optional = grader.needs()
    names = needed + [c for c in optional if c in rows.columns]
    fields, schema = grader.schema().fieldNames(), grader.schema()

    kind = to_arrow_type(schema)

    @F.arrow_udf(schema)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [grader.grade(**{n: row[n] for n in names}, **grader.settings) for row in batch.to_pylist()]
            yield pa.array([x if isinstance(x, dict) else {fields[0]: x} for x in found], kind)

    # A struct without fields can't be sent.
    return run(F.struct(*(F.col(f"`{n}`") for n in names), F.lit(0).alias("_none")))


def metrics(results: DataFrame, *graders: Grader) -> DataFrame:
    """grader, metric, n, average: one row for each numeric output, over the rows where it is not null."""
    rows = []
    for g in graders:
        for f in g.schema().fields:
            if isinstance(f.dataType, (T.NumericType, T.BooleanType)):
                value = F.col(f"`{g.name}`.`{f.name}`").cast("double")
                rows.append((g.name, f.name, value))
    sums = results.agg(*(x for i, (_, _, v) in enumerate(rows) for x in (F.count(v).alias(f"n{i}"), F.avg(v).alias(f"a{i}"))))
    return sums.select(F.inline(F.array(*(
        F.struct(F.lit(g).alias("grader"), F.lit(m).alias("metric"), F.col(f"n{i}").alias("n"), F.col(f"a{i}").alias("average")) for i, (g, m, _) in enumerate(rows)
    ))))


def passed(results: DataFrame, *graders: Grader) -> DataFrame:
    """``results`` with a verdict ``<name>_passed`` for each grader that has a threshold: its first numeric output against that; null stays null."""
    more = {}
    for g in graders:
        first = next((f.name for f in g.schema().fields if isinstance(f.dataType, T.NumericType)), None)
        if g.threshold is not None and first is not None:
            more[f"{g.name}_passed"] = F.col(f"`{g.name}`.`{first}`") >= g.threshold
    return results.withColumns(more)


def catalogue(spark: SparkSession, graders: tuple[Grader, ...], pinned: dict[str, str] | None = None) -> DataFrame:
    """name, display_name, description, categories, columns, threshold, gating, version: the registry as a table; ``pinned`` are versions that runs are held to, and a
    name there that no grader has is an error."""
    pinned = pinned or {}
    if unknown := sorted(set(pinned) - {g.name for g in graders}):
        raise ValueError(f"versions of unknown graders: {', '.join(unknown)}")
    rows = [(g.name, g.display_name or g.name, g.description, list(g.categories), sum(g.needs(), []), g.threshold, g.gating, pinned.get(g.name)) for g in graders]
    kind = "name string, display_name string, description string, categories array<string>, columns array<string>, threshold double, gating boolean, version string"
    return spark.createDataFrame(rows, kind)
