"""Daily weather files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridelake.operators.clean import prepare_weather
from ridelake.schemas import RAW_WEATHER


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """The full weather file as text columns."""
    return (
        spark.read.schema(RAW_WEATHER)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )


def load_weather(spark: SparkSession, path: str, date_format: str = "dd-MM-yyyy") -> DataFrame:
    """One typed row per date, ready to join to trips."""
    return prepare_weather(read_weather(spark, path), date_format)
