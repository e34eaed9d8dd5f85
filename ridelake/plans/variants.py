"""The two earlier jobs end to end: zipped files to a season table, and the feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.operators.clean import (
    cast_columns,
    cast_weather,
    drop_weather_extras,
    first_per_key,
    lower_columns,
    parse_weather_date,
)
from ridelake.operators.lookup import sized
from ridelake.plans.silver import build_legacy, build_notebook
from ridelake.rules import LEGACY, RuleSet
from ridelake.schemas import TYPED_TRIPS
from ridelake.session import materialise
from ridelake.sinks.layers import save_table, write_partitioned
from ridelake.sources.tables import read_layer, read_table
from ridelake.sources.trips import archive_name, read_trip_zips
from ridelake.sources.weather import read_weather

STAGE = "src_month"


def stage_archives(spark: SparkSession, zips: str, staged: str) -> None:
    """Typed trips of every archive below ``zips``, one partition per archive.

    A task holds members of one archive, so nothing needs to move before the write.
    Archives staged before are replaced, others are left alone.
    """
    rows = read_trip_zips(spark, zips)
    parsed = cast_columns(rows, {f.name: f.dataType for f in TYPED_TRIPS})
    named = parsed.withColumn(STAGE, archive_name(F.col("source"))).drop("source")
    write_partitioned(named, staged, [STAGE], clustered=True)


def legacy_weather(spark: SparkSession, path: str, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """The twelve readings and the event text, one row per date, lower-case names."""
    raw = parse_weather_date(cast_weather(read_weather(spark, path)), date_format)
    return first_per_key(lower_columns(drop_weather_extras(raw)), ["trip_date"])


def zips_to_season_table(
    spark: SparkSession,
    zips: str,
    weather: str,
    staged: str,
    out: str,
    rules: RuleSet = LEGACY,
) -> None:
    """The one-shot job: archives to staged months to one table by season."""
    stage_archives(spark, zips, staged)
    daily = sized(materialise(legacy_weather(spark, weather), "weather"))
    trips = read_layer(spark, staged).select(*TYPED_TRIPS.names)
    write_partitioned(build_legacy(trips, daily, rules), out, ["season"], dynamic=False)


def feature_table(spark: SparkSession, source: str, target: str) -> None:
    """The feature-engineering job between two catalog tables."""
    save_table(build_notebook(read_table(spark, source)), target, replace_schema=True)
