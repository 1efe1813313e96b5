"""Versions of tables in a folder, with writers that don't lose each other's work.

The log of a folder has one entry for each version. A writer writes its tables into a folder of its own, then puts the next entry, which only one
writer can: an entry that is there is never replaced. Who loses reads what has won, makes its tables anew from that, and tries again; what it had
written is removed, as it is where a write fails. Readers see the tables of entries alone, so never half of a version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another writer has put the version that this one was to follow."""


class CommitLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._files = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._log = f"{self.root}/_versions"

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def versions(self) -> list[int]:
        if not self._files.exists(self._path(self._log)):
            return []
        names = [x.getPath().getName() for x in self._files.listStatus(self._path(self._log))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[0] != ".")

    def entry(self, version: int) -> dict:
        """What a version added: ``folder``, and its ``tables``."""
        return json.loads("".join(r.value for r in self.spark.read.text(f"{self._log}/{version:020d}.json").collect()))

    def latest(self) -> int:
        """The number of the last version, 0 if there is none."""
        return max(self.versions(), default=0)

    def put(self, version: int, entry: dict) -> bool:
        """Puts the entry of ``version`` if there is none, whole or not at all."""
        self._files.mkdirs(self._path(self._log))
        at, text = self._path(f"{self._log}/{version:020d}.json"), json.dumps(entry).encode()
        staged = self._path(f"{self._log}/.{uuid.uuid4().hex}")
        if self._files.getUri().getScheme() == "file":
            # A link to a finished file fails where its name is taken; here creation without replacement is no single step.
            get, made = self._jvm.java.nio.file.Paths.get, self._jvm.java.nio.file.Files
            none = self.spark._sc._gateway.new_array(self._jvm.String, 0)
            source, target = (get(x.toUri().getPath(), none) for x in (staged, at))
            made.write(source, text, self.spark._sc._gateway.new_array(self._jvm.java.nio.file.OpenOption, 0))
            try:
                made.createLink(target, source)
                return True
            except Exception:
                if not self._files.exists(at):
                    raise
                return False
            finally:
                made.delete(source)
        try:
            out = self._files.create(at, False)
        except Exception:
            if not self._files.exists(at):
                raise
            return False
        out.write(text)
        out.close()
        return True

    def write(self, make: Callable[[int], dict[str, DataFrame]], *, after: int | None = None, tries: int = 20) -> int:
        """Adds the tables that ``make`` gives, which gets the version that they are to follow, and returns their version. If another writer was
        faster, they are made anew; where ``after`` says what they must follow, that is a ``Conflict``. No tables: nothing is written."""
        for _ in range(tries):
            base = self.latest()
            if after is not None and base != after:
                break
            folder = uuid.uuid4().hex
            try:
                tables = make(base)
                if not tables:
                    return base
                for name, df in tables.items():
                    df.write.parquet(f"{self.root}/{folder}/{name}")
                if self.put(base + 1, {"folder": folder, "tables": sorted(tables)}):
                    return base + 1
            except BaseException:
                self._remove(folder)
                raise
            self._remove(folder)
        raise Conflict(f"version {(after if after is not None else self.latest()) + 1} of {self.root} is taken")

    def _remove(self, folder: str) -> None:
        self._files.delete(self._path(f"{self.root}/{folder}"), True)

    def read(self, name: str, *, version: int | None = None) -> DataFrame | None:
        """Table ``name`` of the last version that has it, up to ``version``."""
        for v in reversed([x for x in self.versions() if version is None or x <= version]):
            entry = self.entry(v)
            if name in entry["tables"]:
                return self.spark.read.parquet(f"{self.root}/{entry['folder']}/{name}")
        return None

    def read_all(self, name: str, *, version: int | None = None) -> DataFrame | None:
        """The rows of table ``name`` of all versions up to ``version``."""
        entries = [self.entry(v) for v in self.versions() if version is None or v <= version]
        folders = [f"{self.root}/{e['folder']}/{name}" for e in entries if name in e["tables"]]
        return self.spark.read.parquet(*folders) if folders else None
