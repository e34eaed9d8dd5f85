"""Parquet writers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ridelake import paths


def write_layer(df: DataFrame, path: str, *, max_files: int | None = None) -> None:
    """Replace an unpartitioned layer.

    By default output files follow the advisory partition size. ``max_files``
    bounds the count without a shuffle; take it from measured sizes, as no fixed count survives growth.
    """
    sized = df.coalesce(max_files) if max_files else df.hint("rebalance")
    sized.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: list[str],
    *,
    dynamic: bool = True,
    mode: str = "overwrite",
    clustered: bool = False,
) -> None:
    """Write by partition; ``dynamic`` replaces only the partitions that ``df`` holds.

    Rows are rebalanced by the partition columns first, so that a partition gets
    few files, while one that holds much of the data is split over several tasks.
    ``clustered`` says that each task already holds few partitions, as when the
    rows come from files of one month each; the shuffle is then left out.
    """
    rows = df if clustered else df.hint("rebalance", *by)
    writer = rows.write.mode(mode).partitionBy(*by).option("compression", "snappy")
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("compression", "snappy").parquet(path)


def drop_partitions(spark: SparkSession, path: str, by: list[str], keys: list[tuple]) -> None:
    """Remove the partitions of the layer at ``path`` that ``keys`` name."""
    for key in keys:
        paths.remove(spark, "/".join([path, *[f"{name}={value}" for name, value in zip(by, key)]]))
    if keys:
        spark.catalog.refreshByPath(path)


def recover(spark: SparkSession, path: str) -> None:
    """Put back the version that a swap had moved aside when it was cut off."""
    if not paths.exists(spark, path) and paths.exists(spark, f"{path}.old"):
        paths.rename(spark, f"{path}.old", path)


def swap_table(df: DataFrame, path: str) -> None:
    """Replace ``path`` with ``df``, which may itself be read from ``path``.

    The new version is complete beside the old one before either is renamed.
    A crash between the renames leaves the old version as ``<path>.old``, which
    ``recover`` (and the next swap) puts back.
    """
    spark = df.sparkSession
    staged, old = f"{path}.new-{uuid.uuid4().hex[:8]}", f"{path}.old"
    df.write.mode("errorifexists").option("compression", "snappy").parquet(staged)
    recover(spark, path)
    if paths.exists(spark, path):
        paths.remove(spark, old)
        paths.rename(spark, path, old)
    paths.rename(spark, staged, path)
    paths.remove(spark, old)
    spark.catalog.refreshByPath(path)


def save_table(df: DataFrame, name: str, *, replace_schema: bool = False) -> None:
    """Save as a managed table, replacing rows or, on request, the schema too."""
    spark = df.sparkSession
    if replace_schema and spark.catalog.tableExists(name):
        staged = f"{name}_{uuid.uuid4().hex[:8]}"
        df.write.mode("errorifexists").saveAsTable(staged)
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    else:
        df.write.mode("overwrite").saveAsTable(name)


def refresh(spark: SparkSession, path: str) -> None:
    spark.catalog.refreshByPath(path)
