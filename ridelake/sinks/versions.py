"""Several tables that change at once: data directories that are never rewritten, and a manifest that names those of each version.

A run writes its rows into directories of its own, which no reader knows yet, and publishes one small file. Readers take
the last whole manifest and read what it names, so they see all tables of one version, whatever a run is doing
or wherever it stopped. Creating a file is atomic in every store, renaming a directory is not; nothing is renamed
here. Of two runs that began at the same version the second to publish fails and is to be repeated.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ridelake import paths
from ridelake.sinks.layers import write_partitioned

TableKinds = dict[str, tuple[T.StructType, tuple[str, ...]]]
WRITE = "write"  # names the directories of one write


@dataclass(frozen=True)
class Version:
    """Directories of each table, below its own."""

    number: int = 0
    tables: dict[str, list[str]] = field(default_factory=dict)


class VersionedTables:
    """Tables below ``root`` whose versions are listed in ``root/versions``; ``kinds`` has their schemas and partition columns."""

    def __init__(self, spark: SparkSession, root: str, kinds: TableKinds, folders: dict[str, str]):
        self.spark, self.kinds, self.folders = spark, kinds, folders
        self.manifests = f"{root}/versions"

    def _numbers(self) -> list[int]:
        return [int(c[:-5]) for c in paths.children(self.spark, self.manifests) if c.endswith(".json")]

    def _file(self, number: int) -> str:
        return f"{self.manifests}/{number:012d}.json"

    def version(self, number: int | None = None) -> Version:
        """The given or the last whole version; one that was cut off while it was written counts as not there."""
        for n in [number] if number is not None else sorted(self._numbers(), reverse=True):
            try:
                return Version(n, json.loads(paths.read_text(self.spark, self._file(n))))
            except json.JSONDecodeError:
                continue
        return Version()

    def read(self, name: str, version: Version | None = None) -> DataFrame:
        """One table as a version has it, the last one by default; no rows if it has none."""
        schema, base = self.kinds[name][0], self.folders[name]
        there = (self.version() if version is None else version).tables.get(name, [])
        if not there:
            return self.spark.createDataFrame([], schema)
        stored = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{d}" for d in there])
        return stored.select(*schema.names)

    def begin(self) -> Publication:
        return Publication(self)

    def prune(self, keep: int = 2) -> int:
        """Remove all but the last ``keep`` versions and what no kept one names; returns the directories removed.

        Readers of older versions lose them, and so does a run that has not published yet: call it while none is under way.
        """
        numbers = sorted(self._numbers())
        live: dict[str, set[str]] = {name: set() for name in self.kinds}
        for n in numbers[-keep:]:
            for name, there in self.version(n).tables.items():
                live[name] |= set(there)
        for n in numbers[:-keep]:
            paths.remove(self.spark, self._file(n))
        gone = 0
        for name, (_, by) in self.kinds.items():
            for top in paths.children(self.spark, self.folders[name]):
                found = paths.leaves(self.spark, self.folders[name], len(by), top)
                dead = [d for d in found if d not in live[name]]
                for d in [top] if len(dead) == len(found) else dead:
                    paths.remove(self.spark, f"{self.folders[name]}/{d}")
                gone += len(dead)
        return gone


class Publication:
    """New rows for some tables, visible to others all together once ``publish`` returns."""

    def __init__(self, tables: VersionedTables):
        self.of, self.before = tables, tables.version()
        self.now = Version(self.before.number, {name: list(there) for name, there in self.before.tables.items()})
        self.run, self.writes = uuid.uuid4().hex[:12], 0

    def read(self, name: str) -> DataFrame:
        """A table with what this publication has written so far."""
        return self.of.read(name, self.now)

    def _write(self, name: str, rows: DataFrame, clustered: bool) -> list[str]:
        self.writes += 1
        by, base = self.of.kinds[name][1], self.of.folders[name]
        top = f"{WRITE}={self.run}-{name}-{self.writes}"
        if by:
            write_partitioned(rows, f"{base}/{top}", list(by), mode="errorifexists", clustered=clustered)
        else:
            rows.write.mode("errorifexists").option("compression", "snappy").parquet(f"{base}/{top}")
        return paths.leaves(self.of.spark, base, len(by), top)

    def add(self, name: str, rows: DataFrame, *, clustered: bool = False) -> None:
        new = self._write(name, rows, clustered)
        self.now.tables[name] = [*self.now.tables.get(name, []), *new]

    def replace(self, name: str, rows: DataFrame, partitions: list[tuple] | None = None, *, clustered: bool = False) -> None:
        """``rows`` instead of all rows, or instead of those of some partitions (which may end empty)."""
        new = self._write(name, rows, clustered)
        by = self.of.kinds[name][1]
        left = {"/".join(f"{c}={v}" for c, v in zip(by, p)) for p in partitions or []}
        kept = [] if partitions is None else [d for d in self.now.tables.get(name, []) if d.partition("/")[2] not in left]
        self.now.tables[name] = [*kept, *new]

    def publish(self) -> Version:
        tables = self.of
        if tables.version().number != self.before.number:
            raise RuntimeError(f"version {self.before.number} is not the last one any more; repeat the run")
        done = Version(max(tables._numbers(), default=0) + 1, self.now.tables)
        paths.create_text(tables.spark, tables._file(done.number), json.dumps(done.tables))
        return done
