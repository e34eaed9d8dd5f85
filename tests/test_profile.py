from datetime import date, datetime

import numpy as np
import pytest
from helpers import raw_trips, rows
from pyspark.sql import functions as F

from ridelake.operators.clean import cast_joined, cast_trips
from ridelake.plans import demand, profile
from ridelake.session import materialise


@pytest.fixture(scope="module")
def trips(spark):
    """300 trips over three months, half of them from one station."""
    ids = spark.range(300).select(
        F.col("id").cast("string").alias("ride_id"),
        F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,cast(id % 90 as int),cast(id % 24 as int))").alias("started_at"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("start_station_id"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("s"), F.col("id") % 5)).alias("end_station_id"),
        F.col("id").alias("n"),
    )
    return materialise(
        ids.withColumn("ended_at", F.expr("started_at + make_interval(0,0,0,0,0,cast(n % 200 as int))")), "trips"
    )


def test_histogram_agrees_with_numpy(spark, trips):
    minutes = [r.n % 200 for r in trips.select("n").collect()]
    inside = [m for m in minutes if 1 <= m <= 120]
    counts, edges = np.histogram(inside, bins=60, range=(1, 120))
    density, _ = np.histogram(inside, bins=60, range=(1, 120), density=True)
    got = profile.duration_histogram(trips).collect()
    assert [r.bin for r in got] == list(range(60))
    assert [r.trips for r in got] == counts.tolist()
    assert [r.from_minute for r in got] == pytest.approx(edges[:-1].tolist())
    assert [r.density for r in got] == pytest.approx(density.tolist(), abs=1e-7)
    everything = profile.duration_histogram(trips, low=None, high=None, bins=10)
    assert everything.agg(F.sum("trips")).first()[0] == sum(m > 0 for m in minutes)


def test_imbalance_equals_the_joined_counts(trips):
    month = F.date_format("started_at", "yyyy-MM").alias("month")
    out = trips.groupBy(month, F.col("start_station_id").alias("station_id")).agg(F.count("*").alias("outflow"))
    into = trips.groupBy(month, F.col("end_station_id").alias("station_id")).agg(F.count("*").alias("inflow"))
    expected = out.join(into, ["month", "station_id"], "full").fillna(0, ["inflow", "outflow"])
    expected = expected.withColumn("imbalance_index", F.col("inflow") - F.col("outflow"))
    got = demand.station_imbalance(trips)
    columns = ("month", "station_id", "inflow", "outflow", "imbalance_index")
    assert rows(got, *columns) == rows(expected, *columns)
    known = demand.classified_imbalance(trips.filter("end_station_id IS NOT NULL"))
    sums = known.agg(F.sum("inflow"), F.sum("outflow")).first()
    assert sums[0] == sums[1] == trips.filter("end_station_id IS NOT NULL").count()


def test_pivot_holds_the_summary(trips):
    pivot = demand.imbalance_pivot(trips)
    tall = pivot.unpivot(["month"], pivot.columns[1:], "imbalance_category", "station_count")
    assert rows(tall.filter("station_count > 0")) == rows(demand.imbalance_summary(trips))


def test_top_stations_break_ties_by_id(trips):
    got = demand.station_demand(trips, top=3)
    assert got.groupBy("month").count().filter("count > 3").count() == 0
    assert got.first().station_id == "hot"
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_concentration_ends_at_one(trips):
    got = profile.station_concentration(trips).orderBy("place").collect()
    shares = [r.cumulative_share for r in got]
    assert shares == sorted(shares) and shares[-1] == 1.0 and got[0].station_id == "hot"
    assert got[0].cumulative_share == 0.5


def test_correlations_skip_nulls_pairwise(spark):
    data = [(1.0, 2.0, None), (2.0, 4.5, 1.0), (3.0, 5.0, 0.0), (4.0, None, 7.0), (5.0, 9.0, 2.0)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    expected = df.toPandas().corr()
    for x, y, r in profile.correlations(df, ["a", "b", "c"]).collect():
        assert r == pytest.approx(expected.loc[x, y], abs=1e-6)


def test_describe_agrees_with_spark_summary(trips):
    got = profile.describe_columns(trips, ["n"]).first()
    known = {r[0]: float(r[1]) for r in trips.select("n").summary("count", "mean", "stddev", "min", "max").collect()}
    assert (got.n, got.mean, got.lowest, got.highest) == (known["count"], known["mean"], known["min"], known["max"])
    assert got.stddev == pytest.approx(known["stddev"], abs=1e-4)


def test_gaps_duplicates_and_nulls(spark):
    dates = spark.createDataFrame([(date(2024, 2, 27),), (date(2024, 3, 1),)], "trip_date date")
    assert rows(profile.date_gaps(dates)) == [(date(2024, 2, 28),), (date(2024, 2, 29),)]
    same = cast_trips(raw_trips(spark, {}, {}, {"ride_id": "x", "end_lat": None}))
    assert profile.duplicate_rides(same).first()[0] == 1
    assert profile.duplicate_rides(same, relative_error=0.05).first()[0] == 1
    assert rows(profile.duplicated_ids(same)) == [("r1", 2)]
    nulls = dict(rows(profile.null_profile(same)))
    assert nulls["end_lat"] == 1 and sum(nulls.values()) == 1
    assert tuple(profile.dataset_summary(same).first()) == (3, 1, 1)


def test_schema_and_footprint(spark, trips):
    listed = profile.describe_schema(trips)
    assert listed.filter("column_name = 'started_at'").first().column_type == "timestamp"
    shape = profile.footprint(trips).first()
    assert shape.total_rows == 300 and shape.total_columns == 6 and shape.bytes > 0


def test_average_durations_ignore_reversed_trips(spark):
    t0 = datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [(t0, datetime(2024, 1, 1, 0, 0, 45)), (t0, datetime(2023, 12, 31)), (t0, datetime(2024, 1, 3))],
        "started_at timestamp, ended_at timestamp",
    )
    assert rows(demand.average_duration_by_month(df)) == [("2024-01", 1440.38)]


def test_category_audit_lists_each_pair_once(spark):
    df = spark.createDataFrame([(1.0, "a"), (1.0, "a"), (0.5, "b"), (None, "c")], "v double, label string")
    assert [tuple(r) for r in profile.category_audit(df, "v", "label").collect()] == [
        (None, "c"), (0.5, "b"), (1.0, "a"),
    ]


def test_joined_table_is_typed_in_either_case(spark):
    text = spark.createDataFrame(
        [("2024-01-01 10:00:00", "40.5", "72505", "999.9", "x", "2024-01-01")],
        "started_at string, start_lat string, STATION string, SNDP string, Temp string, trip_date string",
    )
    got = cast_joined(text)
    assert [t for _, t in got.dtypes] == ["timestamp", "double", "string", "double", "double", "date"]
    assert (got.first().SNDP, got.first().Temp) == (999.9, None)
