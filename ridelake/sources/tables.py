"""Stored layers: Parquet paths, catalog tables and views over files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ridelake import paths
from ridelake.operators.clean import typed


def read_layer(spark: SparkSession, *paths: str) -> DataFrame:
    """One or more Parquet directories in one scan."""
    return spark.read.parquet(*paths)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The layer at ``path``, or no rows where it does not exist yet.

    Only a missing path counts as empty; any other failure is raised.
    """
    if paths.exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def sql_over_path(spark: SparkSession, path: str, query: str) -> DataFrame:
    """Run ``query`` with ``{source}`` standing for the Parquet data at ``path``."""
    return spark.sql(query.replace("{source}", f"parquet.`{path}`"))


def typed_view(spark: SparkSession, path: str, schema: T.StructType, name: str) -> DataFrame:
    """A temporary view with the columns of ``schema``, parsed from the file at ``path``."""
    view = typed(spark.read.parquet(path), schema)
    view.createOrReplaceTempView(name)
    return view
