"""Demand indicators over typed trips: volumes, durations, stations, imbalance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.functions import times
from ridelake.functions.bands import imbalance_category
from ridelake.rules import IMBALANCE_LABELS


def _count() -> Column:
    return F.count("*").alias("trips")


def _labelled(counts: DataFrame) -> DataFrame:
    """Write the month of a result as text, once per result row and not per trip."""
    return counts.withColumn("month", times.month_label(F.col("month")))


def _average_duration(trips: DataFrame, label: str, group: Column) -> DataFrame:
    minutes = times.duration_minutes(F.col("started_at"), F.col("ended_at"), fractional=True)
    return (
        trips.filter(F.col("ended_at") > F.col("started_at"))
        .groupBy(group.alias(label))
        .agg(F.round(F.avg(minutes), 2).alias("avg_trip_duration_min"))
        .orderBy(label)
    )


def average_duration_by_month(trips: DataFrame) -> DataFrame:
    return _labelled(_average_duration(trips, "month", times.month_start(F.col("started_at"))))


def average_duration_by_day(trips: DataFrame) -> DataFrame:
    return _average_duration(trips, "trip_date", F.to_date("started_at"))


def rides_by_month_label(trips: DataFrame) -> DataFrame:
    month = times.month_start(F.col("started_at"))
    return _labelled(trips.groupBy(month.alias("month")).agg(_count()).orderBy("month"))


def rides_by_month(trips: DataFrame) -> DataFrame:
    return (
        trips.groupBy(F.date_trunc("month", "started_at").alias("month"))
        .agg(_count())
        .orderBy("month")
    )


def rides_by_hour(trips: DataFrame) -> DataFrame:
    return trips.groupBy(F.hour("started_at").alias("hour")).agg(_count()).orderBy("hour")


def rides_by_day_type(trips: DataFrame) -> DataFrame:
    day_type = F.when(times.is_weekend(F.col("started_at")), "Weekend").otherwise("Weekday")
    return trips.groupBy(day_type.alias("day_type")).agg(_count())


def rides_by(trips: DataFrame, *columns: str) -> DataFrame:
    return trips.groupBy(*columns).agg(_count())


def station_demand(trips: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` start stations of every month, ties to the lesser station id.

    Filtering on the row number lets each task drop all but its own best rows
    before the shuffle, so no month is gathered whole.
    """
    counted = (
        trips.filter(F.col("start_station_id").isNotNull())
        .groupBy(
            times.month_start(F.col("started_at")).alias("month"),
            F.col("start_station_id").alias("station_id"),
        )
        .agg(_count())
    )
    busiest = Window.partitionBy("month").orderBy(F.desc("trips"), F.asc("station_id"))
    best = (
        counted.withColumn("rank", F.row_number().over(busiest))
        .filter(F.col("rank") <= top)
        .orderBy("month", "rank")
    )
    return _labelled(best.select("month", "station_id", "trips"))


def station_imbalance(trips: DataFrame, *, keep_unknown: bool = True) -> DataFrame:
    """Arrivals minus departures per month of start and station.

    One pass and one aggregate: each trip adds a departure at one station and an
    arrival at another, which equals a FULL OUTER join of the two counts. With
    ``keep_unknown`` a missing station keeps one row per direction, as NULL keys
    never meet in that join.
    """
    month = times.month_start(F.col("started_at"))
    moves = trips.select(
        month.alias("month"),
        F.explode(
            F.array(
                F.struct(
                    F.col("start_station_id").alias("station_id"), F.lit(True).alias("departs")
                ),
                F.struct(F.col("end_station_id").alias("station_id"), F.lit(False).alias("departs")),
            )
        ).alias("move"),
    ).select("month", "move.*")
    if not keep_unknown:
        moves = moves.filter(F.col("station_id").isNotNull())
    one_sided = F.when(F.col("station_id").isNull() | F.col("month").isNull(), F.col("departs"))
    flows = (
        moves.groupBy("month", "station_id", one_sided.alias("side"))
        .agg(
            F.count_if(~F.col("departs")).alias("inflow"),
            F.count_if(F.col("departs")).alias("outflow"),
        )
        .drop("side")
    )
    return _labelled(flows).withColumn("imbalance_index", F.col("inflow") - F.col("outflow"))


def by_imbalance(imbalance: DataFrame) -> DataFrame:
    return imbalance.orderBy("month", F.desc(F.abs("imbalance_index")), "station_id")


def classified_imbalance(trips: DataFrame) -> DataFrame:
    return station_imbalance(trips, keep_unknown=False).withColumn(
        "imbalance_category", imbalance_category(F.col("imbalance_index"))
    )


def imbalance_summary(trips: DataFrame) -> DataFrame:
    return (
        classified_imbalance(trips)
        .groupBy("month", "imbalance_category")
        .agg(F.count("*").alias("station_count"))
        .orderBy("month", "imbalance_category")
    )


def imbalance_pivot(trips: DataFrame) -> DataFrame:
    """One column per category, zero where a month has no such station."""
    return (
        classified_imbalance(trips)
        .groupBy("month")
        .pivot("imbalance_category", list(IMBALANCE_LABELS))
        .agg(F.count(F.lit(1)))
        .fillna(0)
        .orderBy("month")
    )
