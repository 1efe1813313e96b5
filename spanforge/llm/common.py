"""What the text operators share: reading tables, splits by id, tables in the shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators between words; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The folder made where the session names none.
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    A cluster names it in ``spark.checkpoint.dir``; only where that is unset, as in tests on one
    machine, a temporary folder is made and removed at exit.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not _made:
        _made.append(tempfile.mkdtemp(prefix="spanforge-"))
        atexit.register(shutil.rmtree, _made[0], ignore_errors=True)
    return f"file://{_made[0]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts the lineage, and
    a lost executor takes nothing with it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/spanforge/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)  # texts take half the disk of the default
    return spark.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Deletes what ``stored`` has written for these frames, which nothing reads any more."""
    for df in tables:
        conf = df.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def in_split(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id never does."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def bounded_share(df: DataFrame, most: int, seed: int, *keys: str) -> DataFrame:
    """At most ``most`` rows of ``df``: all if there are no more, else those whose hash of ``keys`` is small. The hash
    alone leaves a little fewer, so the limit acts only where many rows are equal in all keys."""
    rows = df.count()
    if rows <= most:
        return df
    cut = int(0.97 * most / rows * 2**31)
    return df.where(F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(2**31)) < cut).limit(most)


def packed(docs: DataFrame, *columns: Column) -> DataFrame:
    """All columns of ``docs`` in the struct ``_own`` next to ``columns``, so that no name of theirs can clash with ours."""
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)) if docs.columns else F.struct(F.lit(0).alias("_none"))
    return docs.select(own.alias("_own"), *columns)


def unpacked(rows: DataFrame, columns: list[str], *more: str) -> DataFrame:
    """What ``packed`` has put into ``_own`` as columns again, with the columns ``more`` behind them, which replace
    those of the same name in any case."""
    new = {c.lower() for c in more}
    return rows.select(*(F.col(f"_own.`{c}`").alias(c) for c in columns if c.lower() not in new), *more)


def thinned(rows: DataFrame, groups: dict[str, int], most: int, seed: int, by: str | None = None) -> DataFrame:
    """``rows`` of a stored table, at most about ``most`` of each of ``groups``, which names the values of ``by`` and their rows (one
    group without a name if ``by`` is not given): by a hash of their number in the table, which tells equal rows apart too."""
    cuts = {k: int(0.97 * most / n * 2**31) for k, n in groups.items() if n > most}
    if not cuts:
        return rows
    place = F.pmod(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), F.lit(2**31))
    if by is None:
        return rows.where(place < next(iter(cuts.values())))
    limits = F.create_map(*(F.lit(x) for pair in cuts.items() for x in pair))
    return rows.withColumn("_place", place).where(F.col("_place") < F.coalesce(limits[F.col(by)], F.lit(2**31))).drop("_place")
