"""Trip files: plain CSV, CSV inside ZIP archives, and the staged monthly form."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.schemas import RAW_TRIPS
from ridelake.sources.zips import by_header, read_zip_records

ARCHIVE_ROWS = T.StructType([T.StructField("source", T.StringType()), *RAW_TRIPS.fields])
_LINES_PER_FRAME = 50_000


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """All CSV files below ``path`` as text columns.

    Columns are matched to the header: a file whose header differs is an error,
    not a silent shift of values.
    """
    return (
        spark.read.schema(RAW_TRIPS)
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .csv(path)
    )


def read_trip_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several CSV files in one scan, as text columns."""
    return (
        spark.read.schema(RAW_TRIPS).option("header", True).option("enforceSchema", False).csv(paths)
    )


def read_trip_zips(spark: SparkSession, path: str) -> DataFrame:
    """Rows of every CSV in every ``*.zip`` below ``path``, with the archive they came from; a task for every CSV."""
    return by_header(read_zip_records(spark, path), RAW_TRIPS.names)


def read_trip_archives(spark: SparkSession, path: str) -> DataFrame:
    """The same through Spark's own binary files, a task for every archive, for file systems that only Spark reaches."""
    archives = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "content")
    )
    return unzip_trips(archives)


def unzip_trips(archives: DataFrame) -> DataFrame:
    """Expand ``(path, content)`` archive rows into raw trips plus ``source``.

    Archives are independent, so each task unpacks its own and streams the
    members in frames of bounded size. An archive without a CSV yields no rows.
    """
    names, lines = RAW_TRIPS.names, _LINES_PER_FRAME

    # Nested, so that it travels with the plan and workers need not import it.
    def expand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.namelist():
                        if not member.lower().endswith(".csv") or member.startswith("__MACOSX"):
                            continue
                        with archive.open(member) as raw:
                            for chunk in pd.read_csv(
                                raw, dtype=str, keep_default_na=False, na_values=[""],
                                encoding="utf-8-sig", chunksize=lines,
                            ):
                                missing = [n for n in names if n not in chunk.columns]
                                if missing:
                                    raise ValueError(f"{path}: {member} lacks {', '.join(missing)}")
                                rows = chunk[names].copy()
                                rows.insert(0, "source", path)
                                yield rows

    return archives.select("path", "content").mapInPandas(expand, ARCHIVE_ROWS)


def zip_rows(trips: DataFrame, name: str = "drop") -> DataFrame:
    """Pack raw text trips into ``(path, content)`` archives, one CSV in each.

    The inverse of :func:`unzip_trips`; every frame a task receives becomes one
    archive, so no archive grows with the table.
    """
    names = RAW_TRIPS.names
    schema = T.StructType(
        [T.StructField("path", T.StringType()), T.StructField("content", T.BinaryType())]
    )

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                body = frame[names].to_csv(index=False, quoting=csv.QUOTE_MINIMAL)
                archive.writestr("trips.csv", body)
            label = f"{name}-{frame['ride_id'].iloc[0]}.zip"
            yield pd.DataFrame({"path": [label], "content": [buffer.getvalue()]})

    return trips.select(*RAW_TRIPS.names).mapInPandas(pack, schema)


def archive_name(source: Column) -> Column:
    """The base name of an archive, which names its staged partition."""
    return F.regexp_extract(source, r"([^/]+)\.zip$", 1)
