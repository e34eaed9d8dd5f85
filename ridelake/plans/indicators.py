"""Dashboard indicators over the Gold layer.

Each takes the tables of :func:`ridelake.plans.lake.read_gold`. Facts are
aggregated by key first; dimension texts are joined to the few resulting rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.plans.star import BIKE_TYPE, MEMBER, TEMPERATURE, Dimension

Gold = dict[str, DataFrame]
DIGITS = 6


def _trips() -> Column:
    return F.count("*").alias("trips")


def _named(counts: DataFrame, gold: Gold, dim: Dimension) -> DataFrame:
    """Replace a dimension key by its text."""
    return counts.join(gold[dim.name].select(dim.key, dim.natural), dim.key, "left").drop(dim.key)


def _mean_of_2_digits(value: str, digits: int = 4) -> Column:
    """Mean of a column stored with two decimals, summed exactly."""
    exact = F.sum(F.col(value).cast(T.DecimalType(18, 2)))
    return F.round(exact.cast("double") / F.count(value), digits)


def trips_by_bike_type(gold: Gold) -> DataFrame:
    return _named(gold["fact_trips"].groupBy("bike_key").agg(_trips()), gold, BIKE_TYPE)


def total_trips(gold: Gold) -> DataFrame:
    return gold["fact_trips"].agg(F.count("*").alias("total_trips"))


def member_share(gold: Gold) -> DataFrame:
    counts = gold["fact_trips"].groupBy("member_key").agg(_trips())
    total = gold["fact_trips"].agg(F.count("*").alias("n")).scalar()
    shares = counts.withColumn("share", F.round(F.col("trips") / total, DIGITS))
    return _named(shares, gold, MEMBER)


def average_distance(gold: Gold) -> DataFrame:
    return gold["fact_trips"].agg(_mean_of_2_digits("trip_distance").alias("avg_trip_distance"))


def _station_ends(gold: Gold, *keep: str) -> DataFrame:
    """One row per trip end: ``station_key`` and whether the trip departs there."""
    return (
        gold["fact_trips"]
        .select(
            *keep,
            F.explode(
                F.array(
                    F.struct(
                        F.col("start_station_key").alias("station_key"),
                        F.lit(True).alias("departs"),
                    ),
                    F.struct(
                        F.col("end_station_key").alias("station_key"),
                        F.lit(False).alias("departs"),
                    ),
                )
            ).alias("at"),
        )
        .select(*keep, "at.*")
    )


def station_utilisation(gold: Gold) -> DataFrame:
    """Share of a bike type's trip ends that a station sees.

    The totals come from the station counts, so the facts are scanned once.
    """
    ends = _station_ends(gold, "bike_key").groupBy("bike_key", "station_key").agg(
        F.count("*").alias("trip_ends")
    )
    totals = ends.groupBy("bike_key").agg(F.sum("trip_ends").alias("all_ends"))
    rates = ends.join(totals, "bike_key").select(
        "bike_key",
        "station_key",
        "trip_ends",
        F.round(F.col("trip_ends") / F.col("all_ends"), DIGITS).alias("utilisation_rate"),
    )
    stations = gold["dim_station"].select("station_key", "station_id")
    return _named(rates, gold, BIKE_TYPE).join(stations, "station_key", "left").drop("station_key")


def station_imbalance(gold: Gold) -> DataFrame:
    flows = (
        _station_ends(gold, "year", "month")
        .groupBy("year", "month", "station_key")
        .agg(
            F.count_if(~F.col("departs")).alias("inflow"),
            F.count_if(F.col("departs")).alias("outflow"),
        )
        .withColumn("imbalance_index", F.col("inflow") - F.col("outflow"))
    )
    stations = gold["dim_station"].select("station_key", "station_id")
    return flows.join(stations, "station_key", "left").drop("station_key")


def average_duration(gold: Gold) -> DataFrame:
    return gold["fact_trips"].agg(
        F.round(F.avg("trip_duration_min"), 4).alias("avg_trip_duration_min")
    )


def trips_by_temperature(gold: Gold) -> DataFrame:
    counts = gold["fact_trips"].groupBy("temp_key").agg(
        _trips(), F.round(F.avg("trip_duration_min"), 4).alias("avg_trip_duration_min")
    )
    return _named(counts, gold, TEMPERATURE)


def trips_by_hour(gold: Gold) -> DataFrame:
    return gold["fact_trips"].groupBy("start_hour").agg(_trips()).orderBy("start_hour")


def peak_hour(gold: Gold) -> DataFrame:
    """The busiest start hour, the earliest on ties."""
    counts = gold["fact_trips"].groupBy("start_hour").agg(_trips())
    return counts.orderBy(F.desc("trips"), "start_hour").limit(1)


def _ratio(flag: str) -> Column:
    return F.round(F.avg(F.col(flag).cast("int")), DIGITS)


def usage_ratio(gold: Gold, flag: str, name: str) -> DataFrame:
    """Share of trips with ``flag`` set, overall."""
    return gold["fact_trips"].agg(_ratio(flag).alias(name))


def usage_ratio_by_member(gold: Gold, flag: str, name: str) -> DataFrame:
    counts = gold["fact_trips"].groupBy("member_key").agg(_trips(), _ratio(flag).alias(name))
    return _named(counts, gold, MEMBER)


def daily_trips_by_season(gold: Gold) -> DataFrame:
    """Average trips per day with at least one trip, by season and rider category.

    Trips collapse to one row per date and category before the season is looked
    up, so counting distinct dates needs no second shuffle of the facts.
    """
    per_day = gold["fact_trips"].groupBy("date_key", "member_key").agg(_trips())
    seasons = gold["dim_date"].select("date_key", "season")
    per_season = (
        per_day.join(seasons, "date_key")
        .groupBy("season", "member_key")
        .agg(
            F.sum("trips").alias("trips"),
            F.round(F.sum("trips") / F.count("*"), 4).alias("avg_daily_trips"),
        )
    )
    return _named(per_season, gold, MEMBER)
