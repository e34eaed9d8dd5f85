"""Data-quality profile: every report is one pass unless it says otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.functions import times
from ridelake.functions.bands import to_celsius
from ridelake.functions.weather import event_flags
from ridelake.operators.clean import reject_reason
from ridelake.operators.ordering import running_total
from ridelake.rules import MAX_MINUTES, MISSING_READING, SILVER, RuleSet
from ridelake.schemas import WEATHER_EVENTS


def _tall(wide: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    """Turn a one-row table of measures into (name, value) rows."""
    return wide.unpivot([], names, label, value)


def describe_schema(df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema, start=1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, column_type string")


def null_profile(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _tall(counts, df.columns, "column_name", "nulls")


def duplicate_rides(trips: DataFrame, relative_error: float | None = None) -> DataFrame:
    """Rows beyond the first of their ride id.

    Exact counting shuffles every distinct id once; allow a relative error to
    send a sketch per task instead.
    """
    if relative_error is None:
        distinct = F.count_distinct("ride_id")
    else:
        distinct = F.approx_count_distinct("ride_id", relative_error)
    return trips.agg((F.count("*") - distinct).alias("duplicate_rides"))


def duplicated_ids(trips: DataFrame, key: str = "ride_id") -> DataFrame:
    return trips.groupBy(key).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def _fractional_minutes() -> Column:
    return times.duration_minutes(F.col("started_at"), F.col("ended_at"), fractional=True)


def trip_rule_counts(trips: DataFrame) -> DataFrame:
    counters = {
        "duration not positive": F.col("ended_at") <= F.col("started_at"),
        "duration over one day": _fractional_minutes() > MAX_MINUTES,
    }
    wide = trips.agg(*[F.count_if(test).alias(name) for name, test in counters.items()])
    return _tall(wide, list(counters), "rule", "violations")


def weather_rule_counts(per_day: DataFrame) -> DataFrame:
    """Trips on dates whose readings are impossible; ``per_day`` carries ``trips``."""
    counters = {
        "negative rain": F.col("prcp") < 0,
        "wind out of range": (F.col("wdsp") < 0) | (F.col("wdsp") > 150),
    }
    wide = per_day.agg(
        *[
            F.coalesce(F.sum(F.when(test, F.col("trips"))), F.lit(0)).alias(name)
            for name, test in counters.items()
        ]
    )
    return _tall(wide, list(counters), "rule", "violations")


def range_checks(per_day: DataFrame) -> DataFrame:
    celsius = to_celsius(F.col("temp"))
    return per_day.agg(
        F.min("trip_date").alias("first_date"),
        F.max("trip_date").alias("last_date"),
        F.min("temp").alias("min_temp"),
        F.max("temp").alias("max_temp"),
        F.round(F.min(celsius), 6).alias("min_temp_c"),
        F.round(F.max(celsius), 6).alias("max_temp_c"),
        F.min("wdsp").alias("min_wind"),
        F.max("wdsp").alias("max_wind"),
    )


def time_range(trips: DataFrame) -> DataFrame:
    return trips.agg(F.min("started_at").alias("min_date"), F.max("started_at").alias("max_date"))


def dataset_summary(trips: DataFrame) -> DataFrame:
    """Rows, distinct start points and repeated ride ids.

    Counting rows per id answers two of the three; the start points are their
    own aggregate over their own columns. Two distinct counts in one aggregate
    would send every row through it three times.
    """
    points = trips.agg(F.count_distinct("start_lat", "start_lng").alias("n")).scalar()
    per_ride = trips.groupBy("ride_id").agg(F.count("*").alias("n"))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    return per_ride.agg(
        rows.alias("total_rows"), (rows - F.count("ride_id")).alias("duplicate_rides")
    ).select("total_rows", points.alias("unique_start_points"), "duplicate_rides")


def trip_dates(trips: DataFrame) -> DataFrame:
    return trips.select(F.to_date("started_at").alias("trip_date")).distinct()


def date_gaps(dates: DataFrame) -> DataFrame:
    """Dates between the first and the last ``trip_date`` that have no row."""
    span = dates.agg(F.min("trip_date").alias("first"), F.max("trip_date").alias("last"))
    calendar = span.select(F.explode(F.sequence("first", "last")).alias("trip_date"))
    return calendar.join(dates, "trip_date", "left_anti")


def sentinel_counts(daily: DataFrame, columns: list[str]) -> DataFrame:
    wide = daily.agg(*[F.count_if(F.col(c) == MISSING_READING).alias(c) for c in columns])
    return _tall(wide, columns, "column_name", "missing_readings")


def category_audit(df: DataFrame, value: str, *labels: str) -> DataFrame:
    """Which labels each distinct value received."""
    return df.select(value, *labels).distinct().orderBy(value)


def duration_shares(trips: DataFrame, short: float = 30, long: float = MAX_MINUTES) -> DataFrame:
    minutes = _fractional_minutes()

    def share(test: Column) -> Column:
        return F.round(F.count_if(test) / F.count(minutes), 6)

    return trips.agg(
        share(minutes < short).alias("short_share"), share(minutes > long).alias("long_share")
    )


def station_concentration(trips: DataFrame) -> DataFrame:
    """Stations by trips started, with the cumulative share of all such trips.

    The running total is taken over ranges of the order, so the station list may
    grow beyond one task.
    """
    counts = (
        trips.filter(F.col("start_station_id").isNotNull())
        .groupBy(F.col("start_station_id").alias("station_id"))
        .agg(F.count("*").alias("trips"))
    )
    order = [F.desc("trips"), F.asc("station_id")]
    ranked = running_total(counts, order, "trips", "running", rank="place")
    total = ranked.agg(F.sum("trips").alias("n")).scalar()
    return ranked.select(
        "place",
        "station_id",
        "trips",
        F.round(F.col("running") / total, 6).alias("cumulative_share"),
    )


def weather_event_days(daily: DataFrame) -> DataFrame:
    """Days on which each event was reported; ``daily`` has one row per date."""
    flags = event_flags(F.col("frshtt"), prefix="", as_boolean=True)
    wide = daily.agg(*[F.count_if(flags[e]).alias(e) for e in WEATHER_EVENTS])
    return _tall(wide, list(WEATHER_EVENTS), "event", "days")


def reject_funnel(trips: DataFrame, rules: RuleSet = SILVER) -> DataFrame:
    """Trips by the first rule they fail."""
    return trips.groupBy(reject_reason(rules).alias("reason")).agg(F.count("*").alias("trips"))


def duration_histogram(
    trips: DataFrame, low: float | None = 1, high: float | None = 120, bins: int = 60
) -> DataFrame:
    """Equal-width histogram of trip minutes with densities; empty bins included.

    The last bin is closed, the others half-open. Without bounds the range is
    that of the positive durations, a one-row aggregate of the same plan. If all
    durations are equal, they are in the first bin and no density is given; without
    durations all bins are empty.
    """
    minutes = trips.filter(F.col("ended_at") > F.col("started_at")).select(
        _fractional_minutes().alias("minutes")
    )
    every = trips.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    if low is None or high is None:
        found = F.broadcast(minutes.agg(F.min("minutes").alias("__least"), F.max("minutes").alias("__most")))
        minutes, every = minutes.join(found, F.lit(True)), every.join(found, F.lit(True))
    bottom = F.col("__least") if low is None else F.lit(float(low))
    top = F.col("__most") if high is None else F.lit(float(high))
    width = (top - bottom) / bins
    position = F.coalesce(F.floor(F.try_divide(F.col("minutes") - bottom, width)).cast("int"), F.lit(0))
    counts = (
        minutes.filter(F.col("minutes").between(bottom, top))
        .groupBy(F.least(position, F.lit(bins - 1)).alias("bin"))
        .agg(F.count("*").alias("trips"))
    )
    filled = every.join(counts, "bin", "left").withColumn("trips", F.coalesce("trips", F.lit(0)))
    # At most ``bins`` rows are left here, so one task may sum them.
    total = F.sum("trips").over(Window.partitionBy())
    return filled.select(
        "bin",
        (bottom + F.col("bin") * width).alias("from_minute"),
        "trips",
        F.round(F.try_divide(F.col("trips"), total * width), 8).alias("density"),
    ).orderBy("bin")


def correlations(df: DataFrame, columns: list[str], at_once: int = 8) -> DataFrame:
    """Pearson correlation of every column pair over all rows, NULLs skipped pairwise.

    Each scan computes ``at_once`` pairs as plain aggregates: few enough for one
    compiled loop, and no row is multiplied by the number of pairs.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    tables = []
    for at in range(0, len(pairs), at_once):
        some = pairs[at : at + at_once]
        row = numbers.agg(*[F.corr(a, b).alias(f"r{k}") for k, (a, b) in enumerate(some)])
        named = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.round(f"r{k}", 6).alias("r")) for k, (a, b) in enumerate(some)]
        tables.append(row.select(F.inline(F.array(*named))))
    return reduce(DataFrame.unionAll, tables)


def describe_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation and range of numeric columns, one row per column."""
    measures = {
        "n": F.count,
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "lowest": F.min,
        "highest": F.max,
    }
    wide = df.agg(
        *[
            F.struct(*[fn(F.col(c)).cast("double").alias(m) for m, fn in measures.items()]).alias(c)
            for c in columns
        ]
    )
    tall = _tall(wide, columns, "column_name", "m")
    return tall.select(
        "column_name",
        F.col("m.n").cast("bigint").alias("n"),
        *[F.round(f"m.{m}", 4).alias(m) for m in ("mean", "stddev", "lowest", "highest")],
    )


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count and least and greatest value of text columns, one row per column."""
    wide = df.agg(
        *[
            F.struct(
                F.count(F.col(c)).alias("n"), F.min(c).alias("lowest"), F.max(c).alias("highest")
            ).alias(c)
            for c in columns
        ]
    )
    return _tall(wide, columns, "column_name", "m").select("column_name", "m.*")


def footprint(df: DataFrame) -> DataFrame:
    """Rows, columns, files and bytes behind a file-based table."""
    per_file = df.groupBy(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    ).agg(F.count("*").alias("n"))
    return per_file.agg(
        F.sum("n").alias("total_rows"),
        F.lit(len(df.columns)).alias("total_columns"),
        F.count("*").alias("files"),
        F.sum("size").alias("bytes"),
    )


def distance_summary(df: DataFrame) -> DataFrame:
    """Average distance, rows, and rows without a distance."""
    exact = F.sum(F.col("trip_distance").cast(T.DecimalType(18, 2))).cast("double")
    return df.agg(
        F.round(exact / F.count("trip_distance"), 4).alias("avg_distance"),
        F.count("*").alias("total_trips"),
        F.count_if(F.col("trip_distance").isNull()).alias("null_dist_trips"),
    )
