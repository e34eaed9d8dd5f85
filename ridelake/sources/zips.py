"""CSV members of ZIP archives as a data source: one partition for every member.

Archives are listed, and their directories read, when the scan is planned; a task then opens its own archive and reads the
bytes of its own member. Records leave as text, so that values are parsed by Spark like those of plain files.
Paths may be of any file system that Arrow knows (local, HDFS, S3, GCS); an archive may have any size.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "zip_records"
RECORDS = "source string, member string, header array<string>, record string"
_ARROW = pa.schema([("source", pa.string()), ("member", pa.string()), ("header", pa.list_(pa.string())), ("record", pa.string())])
_PER_BATCH = 8_192  # records
_LISTED_TOGETHER = 16  # archives whose directories are read at a time
WIDEST = 64  # columns that a member may have
_CSV = {"quote": '"', "escape": '"', "nullValue": "", "emptyValue": "", "multiLine": "true", "maxCharsPerColumn": "-1"}


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path there."""
    short = re.match(r"(\w+):/(?!/)", path)  # file:/x stands for file:///x
    return fs.FileSystem.from_uri(f"{short[1]}:///{path[short.end() :]}" if short else path)


@dataclass
class Member(InputPartition):
    """One CSV of one archive; without a name, nothing."""

    archive: str = ""
    name: str = ""


def records(lines: Iterable[str]) -> Iterator[str]:
    """CSV records: a line break inside quotes belongs to its record. Empty lines are none."""
    held: list[str] = []
    is_open = False
    for line in lines:
        is_open ^= line.count('"') % 2 == 1
        held.append(line)
        if not is_open:
            record = "".join(held).rstrip("\r\n")
            held = []
            if record:
                yield record
    if held:
        raise ValueError("a quote is never closed")


class ZipReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Member]:
        """Members of all archives below the path, the largest first, as each is one task."""
        files, root = file_system(self.path)
        there = files.get_file_info(root)
        if there.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [there] if there.type == fs.FileType.File else files.get_file_info(fs.FileSelector(root, recursive=True))
        archives = [f.path for f in found if f.type == fs.FileType.File and f.path.lower().endswith(".zip")]

        def members(path: str) -> list[tuple[int, Member]]:
            with files.open_input_file(path) as raw, zipfile.ZipFile(raw) as archive:
                wanted = [m for m in archive.infolist() if m.filename.lower().endswith(".csv") and not m.filename.startswith("__MACOSX")]
                return [(m.file_size, Member(path, m.filename)) for m in wanted]

        with ThreadPoolExecutor(_LISTED_TOGETHER) as pool:
            each = [m for found in pool.map(members, sorted(archives)) for m in found]
        return [m for _, m in sorted(each, key=lambda x: -x[0])] or [Member()]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        files, _ = file_system(self.path)
        with files.open_input_file(partition.archive) as raw, zipfile.ZipFile(raw) as archive, archive.open(partition.name) as member:
            rows = records(io.TextIOWrapper(member, encoding="utf-8-sig", newline=""))
            header = next(csv.reader([next(rows, "")]), [])
            if len(header) > WIDEST:
                raise ValueError(f"{partition.archive}: {partition.name} has {len(header)} columns, more than {WIDEST}")
            held: list[str] = []
            for record in rows:
                held.append(record)
                if len(held) == _PER_BATCH:
                    yield self._batch(partition, header, held)
                    held = []
            if held:
                yield self._batch(partition, header, held)

    @staticmethod
    def _batch(partition: Member, header: list[str], held: list[str]) -> pa.RecordBatch:
        n = len(held)
        return pa.RecordBatch.from_arrays(
            [pa.array([partition.archive] * n), pa.array([partition.name] * n), pa.array([header] * n, pa.list_(pa.string())), pa.array(held)], schema=_ARROW
        )


class ZipRecords(DataSource):
    """``spark.read.format("zip_records").load(path)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RECORDS

    def reader(self, schema) -> ZipReader:
        return ZipReader(self.options["path"])


def read_zip_records(spark: SparkSession, path: str) -> DataFrame:
    """(source, member, header, record) of every CSV in every archive below ``path``, or in one archive."""
    spark.dataSource.register(ZipRecords)
    return spark.read.format(FORMAT).load(path)


def by_header(rows: DataFrame, names: list[str]) -> DataFrame:
    """``source`` and the named text columns of records, found by each member's own header; a member that lacks one is an error."""
    wide = ", ".join(f"c{k} string" for k in range(WIDEST))
    # a record with fewer values than columns costs the parser an exception, so that the missing ones are written out
    padded = F.concat("record", F.repeat(F.lit(","), F.lit(WIDEST) - F.size("header")))
    parsed = rows.withColumn("values", F.from_csv(padded, wide, _CSV))
    listed = parsed.withColumn("values", F.array(*[F.col(f"values.c{k}") for k in range(WIDEST)]))

    def value(name: str) -> Column:
        place = F.array_position("header", name).cast("int")
        lacking = F.raise_error(F.concat("source", F.lit(": "), "member", F.lit(f" lacks {name}"))).cast("string")
        return F.when(place > 0, F.get("values", place - 1)).otherwise(lacking).alias(name)

    return listed.select("source", *[value(name) for name in names])
