"""Paths in whatever file system Spark uses: existence, removal, renaming."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _at(spark, path)
    return files.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in the directory ``path``; none if it does not exist."""
    files, where = _at(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []


def leaves(spark: SparkSession, base: str, depth: int, top: str = "") -> list[str]:
    """Partition directories ``depth`` levels below ``base/top``, relative to ``base``."""
    found = [top]
    for _ in range(depth):
        found = [f"{d}/{c}".lstrip("/") for d in found for c in children(spark, f"{base}/{d}") if "=" in c]
    return found


def usage(spark: SparkSession, path: str) -> tuple[int, int]:
    """Files and bytes at or below ``path``."""
    files, where = _at(spark, path)
    summary = files.getContentSummary(where)
    return summary.getFileCount(), summary.getLength()


def read_text(spark: SparkSession, path: str) -> str:
    files, where = _at(spark, path)
    stream = files.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file; an error if it exists."""
    files, where = _at(spark, path)
    stream = files.create(where, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    files, where = _at(spark, path)
    files.delete(where, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    files, where = _at(spark, path)
    if not files.rename(where, _at(spark, to)[1]):
        raise OSError(f"cannot move {path} to {to}")
