import dataclasses

import pytest
from helpers import days, raw_trips, rows
from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.operators import clean
from ridelake.operators.lookup import sized
from ridelake.plans import profile
from ridelake.plans.silver import build_legacy, build_notebook, build_silver
from ridelake.rules import LEGACY, SILVER
from ridelake.session import materialise


def silver_of(spark, *changes, day=({},), rules=SILVER, **kw):
    trips = clean.cast_trips(raw_trips(spark, *changes))
    return build_silver(trips, days(spark, *day), rules, **kw)


def kept(spark, column, items, **kw):
    changes = [{"ride_id": str(i), column: item} for i, item in enumerate(items)]
    got = {r.ride_id for r in silver_of(spark, *changes, **kw).collect()}
    return [str(i) in got for i in range(len(items))]


def test_schema_is_locked(spark):
    got = silver_of(spark, {}).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in schemas.SILVER]
    assert len(schemas.SILVER) == 38


def test_values_of_one_trip(spark):
    row = silver_of(spark, {}, holiday_years=[2024]).first()
    assert row.trip_duration_min == 20.0 and row.start_hour == 8 and row.trip_distance == 0.87
    assert (row.season, row.day_of_week, row.month, row.year) == ("Summer", "Thursday", 7, 2024)
    assert row.is_rush_hour and not row.weekend and not row.is_holiday and row.is_round_trip == 0
    assert (row.is_fog, row.is_rain, row.is_thunder) == (0, 1, 1)
    assert (row.temp_category, row.prcp_category, row.sndp) == ("Warm", "Moderate", 0.0)
    assert row.start_station_id == "5379.1"


def test_duration_bounds(spark):
    ends = [
        "2024-07-11 08:40:00", "2024-07-11 08:45:00", "2024-07-11 08:45:01", "2024-07-12 08:45:00",
        "2024-07-12 08:45:01", None, "junk",
    ]
    assert kept(spark, "ended_at", ends) == [False, False, True, True, False, False, False]


def test_area_edges(spark):
    lats = ["40.4774", "40.9176", "40.4773", "40.9177", None, "text"]
    assert kept(spark, "start_lat", lats) == [True, True, False, False, False, False]
    lngs = ["-74.2591", "-73.7004", "-74.2592", "-73.7003", "NaN"]
    assert kept(spark, "end_lng", lngs) == [True, True, False, False, False]


def test_required_fields(spark):
    assert kept(spark, "start_station_id", ["1", None, ""]) == [True, False, True]
    assert kept(spark, "ride_id", [None]) == [False]


def test_trip_without_weather_keeps_published_categories(spark):
    late = {"started_at": "2024-08-01 10:00:00", "ended_at": "2024-08-01 10:10:00"}
    row = silver_of(spark, late).first()
    assert (row.temp, row.temp_category, row.prcp_category, row.is_rain) == (None, "Cool", "Heavy", 0)
    unknown = silver_of(spark, late, rules=dataclasses.replace(SILVER, unknown_weather=True)).first()
    assert (unknown.temp_category, unknown.prcp_category) == (None, None)


def test_sentinel_choice(spark):
    missing = ({"temp": 999.9, "prcp": 999.9},)
    row = silver_of(spark, {}, day=missing).first()
    assert (row.temp, row.temp_category, row.prcp_category) == (0.0, "Cool", "No Rain")
    as_null = dataclasses.replace(SILVER, sentinel_value=None)
    row = silver_of(spark, {}, day=missing, rules=as_null).first()
    assert (row.temp, row.prcp) == (None, None)


def test_malformed_event_text(spark):
    assert silver_of(spark, {}, day=({"frshtt": None},)).first().is_fog == 0
    short = silver_of(spark, {}, day=({"frshtt": "01"},)).first()
    assert (short.is_rain, short.is_snow) == (1, None)


def test_repeated_rides_are_kept_unless_asked(spark):
    twice = ({}, {"end_station_name": "Other"}, {})
    assert silver_of(spark, *twice).count() == 3
    assert silver_of(spark, *twice, rules=dataclasses.replace(SILVER, dedup_rides=True)).count() == 1
    # An unusable copy must not displace a usable one.
    mixed = ({"ended_at": "2024-07-11 08:00:00"}, {})
    assert silver_of(spark, *mixed, rules=dataclasses.replace(SILVER, dedup_rides=True)).count() == 1


def test_legacy_bounds(spark):
    changes = [
        {"ride_id": "one minute", "ended_at": "2024-07-11 08:46:00"},
        {"ride_id": "61 s", "ended_at": "2024-07-11 08:46:01"},
        {"ride_id": "a day", "ended_at": "2024-07-12 08:45:00"},
        {"ride_id": "empty id", "end_station_id": ""},
        {"ride_id": "west", "start_lng": "-74.01"},
    ]
    trips = clean.cast_trips(raw_trips(spark, *changes))
    got = build_legacy(trips, days(spark, {"frshtt": None}), LEGACY)
    assert rows(got, "ride_id", "season", "sndp", "is_rain") == [("61 s", "summer", 0.0, None)]


def test_notebook_rules(spark):
    changes = [
        {"ride_id": "ok"},
        {"ride_id": "same", "end_station_id": "5379.1"},
        {"ride_id": "reversed", "ended_at": "2024-07-11 08:00:00"},
        {"ride_id": "far"},
        {"ride_id": "unknown station", "start_station_id": None},
    ]
    trips = clean.cast_trips(raw_trips(spark, *changes)).withColumn(
        "trip_distance", F.when(F.col("ride_id") == "far", 1000.1).otherwise(2.0)
    )
    joined = trips.crossJoin(days(spark, {}))
    got = build_notebook(joined)
    assert rows(got, "ride_id", "trip_distance", "is_round_trip", "month", "start_time") == [
        ("ok", 2.0, False, "July", "08:45:00"),
        ("same", None, True, "July", "08:45:00"),
        ("unknown station", 2.0, False, "July", "08:45:00"),
    ]


def test_weather_is_reduced_to_one_row_per_date(spark):
    text = spark.createDataFrame(
        [
            ("11-07-2024", "76.2", "9.3", "2.2", "0.18", "999.9", "010010"),
            ("11-07-2024", "70.0", "9.3", "2.2", "0.18", "999.9", "010010"),
            ("12-07-2024", "bad", "", None, "0", "0", "000000"),
            ("not a date", "1", "1", "1", "1", "1", "000000"),
        ],
        "DATE string, TEMP string, VISIB string, WDSP string, PRCP string, SNDP string, FRSHTT string",
    )
    got = clean.prepare_weather(text)
    assert got.columns == schemas.DAILY_WEATHER.names
    assert rows(got, F.col("trip_date").cast("string"), "temp", "visib") == [
        ("2024-07-11", 70.0, 9.3), ("2024-07-12", None, None), (None, 1.0, 1.0),
    ]


def test_reject_reasons_agree_with_the_filter(spark):
    changes = [
        {}, {"ended_at": "junk"}, {"ended_at": "2024-07-11 08:00:00"}, {"start_lat": None},
        {"end_lat": "10"}, {"start_station_id": None},
    ]
    trips = clean.cast_trips(raw_trips(spark, *changes))
    assert rows(profile.reject_funnel(trips)) == [
        ("duration out of bounds", 1), ("kept", 1), ("missing field", 1), ("no coordinates", 1),
        ("no duration", 1), ("outside area", 1),
    ]


def test_required_columns_and_types_are_checked(spark):
    with pytest.raises(ValueError, match="missing columns: ended_at"):
        clean.cast_trips(raw_trips(spark, {}).drop("ended_at"))
    wrong = silver_of(spark, {}).withColumn("month", F.col("month").cast("bigint"))
    with pytest.raises(ValueError, match="month: bigint instead of int"):
        clean.lock_schema(wrong, schemas.SILVER)


def test_weather_join_does_not_shuffle_trips(spark):
    daily = sized(materialise(days(spark, {}), "weather"))
    trips = clean.cast_trips(raw_trips(spark, {}))
    plan = build_silver(trips, daily)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    large = sized(materialise(days(spark, {}), "weather"), limit=0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = build_silver(trips, large)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert build_silver(trips, large).count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
