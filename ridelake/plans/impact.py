"""Weather impact on demand.

Weather is daily, so trips are counted per date first and the counts, not the
trips, meet the weather. The join then handles one row per date on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.functions.bands import celsius_bucket, to_celsius
from ridelake.functions.weather import weather_score
from ridelake.operators.lookup import left_lookup


def trips_per_day(trips: DataFrame, daily: DataFrame) -> DataFrame:
    """``trip_date``, ``trips`` and the weather readings of the date (NULL if none)."""
    per_day = trips.groupBy(F.to_date("started_at").alias("trip_date")).agg(
        F.count("*").alias("trips")
    )
    return left_lookup(per_day, daily, "trip_date")


def _total(per_day: DataFrame, label: str, group: Column) -> DataFrame:
    return per_day.groupBy(group.alias(label)).agg(F.sum("trips").alias("trips"))


def rain_impact(per_day: DataFrame) -> DataFrame:
    wet = F.when(F.col("prcp") > 0, "Rainy Day").otherwise("No Rain")
    return _total(per_day, "weather_type", wet)


def rides_by_celsius(per_day: DataFrame) -> DataFrame:
    known = per_day.filter(F.col("temp").isNotNull())
    return _total(known, "temperature_c", F.round(to_celsius(F.col("temp")), 1)).orderBy(
        "temperature_c"
    )


def rides_by_temperature(per_day: DataFrame) -> DataFrame:
    return _total(per_day, "temp", F.col("temp")).orderBy("temp")


def temperature_impact(per_day: DataFrame) -> DataFrame:
    known = per_day.filter(F.col("temp").isNotNull())
    return _total(known, "temp_bucket", celsius_bucket(F.col("temp"))).orderBy("temp_bucket")


def impact_score(per_day: DataFrame) -> DataFrame:
    """Average score over trips: every date weighs as many trips as it has."""
    score = weather_score(F.col("prcp"), F.col("temp"))
    average = F.sum(score * F.col("trips")) / F.sum("trips")
    return per_day.agg(F.round(average, 2).alias("weather_impact_score"))
