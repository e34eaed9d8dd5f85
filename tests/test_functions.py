import math
from datetime import date, datetime

import pytest
from helpers import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridelake.functions import geo, times, weather
from ridelake.functions.bands import banded, celsius_bucket, imbalance_category
from ridelake.rules import (
    NOTEBOOK,
    RAIN_NOTEBOOK,
    RAIN_SILVER,
    SEASONS_LOWER,
    SILVER,
    TEMP_FAHRENHEIT,
    TEMP_NOTEBOOK,
    WIND,
)

READINGS = [39.9, 40.0, 54.9, 55.0, 70.0, 74.9, 75.0, 999.9, None]


@pytest.mark.parametrize(
    "bands, items, expected",
    [
        (
            TEMP_FAHRENHEIT,
            READINGS,
            ["Cool", "Cool", "Cool", "Moderate", "Moderate", "Moderate", "Warm", "Warm", "Cool"],
        ),
        (
            TEMP_NOTEBOOK,
            READINGS,
            ["cold", "moderate", "moderate", "moderate", "moderate", "hot", "hot", "hot", "hot"],
        ),
        (
            RAIN_SILVER,
            [0.0, 0.1, 0.11, 0.3, 0.31, 0.5, 999.9, None],
            ["No Rain", "Light", "Moderate", "Moderate", "Heavy", "Heavy", "Heavy", "Heavy"],
        ),
        (
            RAIN_NOTEBOOK,
            [-1.0, 0.0, 0.1, 0.11, 0.5, 0.51, None],
            ["heavy_rain", "no_rain", "light_rain", "moderate_rain", "moderate_rain",
             "heavy_rain", "heavy_rain"],
        ),
        (WIND, [-1.0, 2.5, 2.51, 4.5, 4.51, None], ["low", "low", "moderate", "moderate", "high", "high"]),
    ],
)
def test_bands(spark, bands, items, expected):
    assert values(spark, "double", items, lambda c: banded(c, bands)) == expected


def test_unknown_band_is_null(spark):
    got = values(spark, "double", [None, 80.0], lambda c: banded(c, TEMP_FAHRENHEIT, null_is_unknown=True))
    assert got == [None, "Warm"]


def test_imbalance_categories(spark):
    got = values(spark, "bigint", [-21, -20, -6, -5, 0, 5, 6, 20, 21], imbalance_category)
    assert got == [
        "Severe shortage", "Mild shortage", "Mild shortage", "Balanced", "Balanced",
        "Mild overflow", "Mild overflow", "Mild overflow", "Severe overflow",
    ]


def test_celsius_buckets_take_the_first_match(spark):
    fahrenheit = [31.9, 32.0, 50.0, 68.0, 86.0, 86.2, None]
    assert values(spark, "double", fahrenheit, celsius_bucket) == [
        "Below 0°C", "0–10°C", "0–10°C", "10–20°C", "20–30°C", "Above 30°C", "Above 30°C",
    ]


def test_weather_score(spark):
    df = spark.createDataFrame(
        [(0.1, 68.0), (0.0, 59.0), (0.0, 77.0), (0.0, 77.2), (None, 68.0), (0.0, None)],
        "prcp double, temp double",
    )
    got = [r[0] for r in df.select(weather.weather_score(F.col("prcp"), F.col("temp"))).collect()]
    assert got == [-1, 1, 1, 0, 1, 0]


def test_sentinel(spark):
    items = [999.9, 99.99, 0.0, None]
    assert values(spark, "double", items, weather.without_sentinel) == [0.0, 99.99, 0.0, None]
    assert values(spark, "double", items, lambda c: weather.without_sentinel(c, None)) == [
        None, 99.99, 0.0, None,
    ]


def test_event_flags(spark):
    texts = ["000000", "111111", "010010", "01", "", None, "x10000"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string").orderBy("i")
    ints = df.select(*weather.event_flags(F.col("v")).values()).collect()
    assert [tuple(r) for r in ints] == [
        (0,) * 6, (1,) * 6, (0, 1, 0, 0, 1, 0), (0, 1, None, None, None, None),
        (None,) * 6, (None,) * 6, (None, 1, 0, 0, 0, 0),
    ]
    flags = df.select(*weather.event_flags(F.col("v"), as_boolean=True).values()).collect()
    assert [tuple(r) for r in flags][3:6] == [(False, True) + (False,) * 4, (False,) * 6, (False,) * 6]


def pairs(spark, items):
    return spark.createDataFrame(items, "s timestamp, e timestamp")


def test_durations(spark):
    start = datetime(2024, 1, 1, 10, 0, 0, 900000)
    df = pairs(
        spark,
        [
            (start, datetime(2024, 1, 1, 10, 0, 2, 100000)),
            (start, datetime(2024, 1, 1, 9, 55, 0)),
            (start, None),
            (start, datetime(2024, 1, 2, 10, 0, 0, 900000)),
            (start, datetime(2024, 1, 2, 10, 0, 1, 900000)),
        ],
    )
    s, e = F.col("s"), F.col("e")
    whole, exact, capped = zip(
        *df.select(
            times.duration_minutes(s, e),
            times.duration_minutes(s, e, fractional=True),
            times.capped_duration(s, e),
        ).collect()
    )
    assert whole[0] == pytest.approx(2 / 60) and exact[0] == pytest.approx(1.2 / 60)
    assert whole[2] is None and exact[2] is None and capped[2] is None
    assert capped == (0.03, None, None, 1440.0, None)


def test_calendar(spark):
    items = [date(2024, 2, 29), date(2023, 12, 31), date(2024, 7, 4), date(2024, 12, 25), date(2024, 1, 6), None]
    assert values(spark, "date", items, times.season) == ["Winter", "Winter", "Summer", "Winter", "Winter", "Fall"]
    assert values(spark, "date", [date(2024, 9, 1), date(2024, 3, 1)], lambda c: times.season(c, SEASONS_LOWER)) == ["fall", "spring"]
    assert values(spark, "date", items, times.is_weekend) == [False, True, False, False, True, None]
    assert values(spark, "date", items, times.is_holiday) == [False, False, True, True, False, None]
    assert values(spark, "date", items, lambda c: times.is_holiday(c, years=[2023])) == [False, False, False, False, False, None]
    assert values(spark, "date", items, times.date_key) == [20240229, 20231231, 20240704, 20241225, 20240106, None]
    assert values(spark, "date", items, times.day_name) == ["Thursday", "Sunday", "Thursday", "Wednesday", "Saturday", None]
    assert values(spark, "date", items, times.month_name) == ["February", "December", "July", "December", "January", None]


def test_names_equal_the_formatted_date(spark):
    year = spark.range(366).select(F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("d"))
    d = F.col("d")
    wrong = year.filter(
        (times.day_name(d) != F.date_format(d, "EEEE")) | (times.month_name(d) != F.date_format(d, "MMMM"))
    )
    assert wrong.count() == 0


def test_rush_hours(spark):
    hours = [6, 7, 9, 10, 15, 16, 18, 19, 20]
    current = values(spark, "int", hours, lambda c: times.is_rush_hour(c, SILVER.rush_hours))
    assert current == [False, True, True, False, False, True, True, False, False]
    notebook = values(spark, "int", hours, lambda c: times.is_rush_hour(c, NOTEBOOK.rush_hours))
    assert notebook == [False, True, True, False, False, True, True, True, False]


def test_round_trip(spark):
    df = spark.createDataFrame(
        [("a", "a", 1.0, 1.0), ("a", "a", 1.0, 2.0), (None, None, 1.0, 1.0), ("a", "b", 1.0, 1.0)],
        "s string, e string, p double, q double",
    )
    s, e, p, q = (F.col(c) for c in "sepq")
    got = df.select(geo.is_round_trip(s, e), geo.is_round_trip(s, e, (p, p, q, q))).collect()
    assert [tuple(r) for r in got] == [(True, True), (True, False), (False, False), (False, False)]


def distance(spark, points, **kw):
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    return [r[0] for r in df.select(geo.great_circle(*[F.col(c) for c in "abcd"], **kw)).collect()]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.floats(40.4, 40.95), st.floats(-74.3, -73.6)] * 2), min_size=1, max_size=20))
def test_distance_properties(spark, points):
    there = distance(spark, points)
    back = distance(spark, [(c, d, a, b) for a, b, c, d in points])
    other = distance(spark, points, method="haversine_atan2")
    cosine = distance(spark, points, method="cosine")
    for x, y, z, w in zip(there, back, other, cosine):
        assert x >= 0 and x == pytest.approx(y, abs=1e-9) and x == pytest.approx(z, abs=1e-9)
        assert x == pytest.approx(w, abs=1e-3)


def test_distance_edges(spark):
    same = (40.123456789, -73.987654321)
    points = [same + same, (None, 1.0, 2.0, 3.0), (0.0, 0.0, 0.0, 180.0), (math.nan, 0.0, 0.0, 0.0)]
    for method in ("haversine", "haversine_atan2", "cosine"):
        zero, absent, half, nan = distance(spark, points, method=method, unit="km")
        assert zero == pytest.approx(0, abs=1e-3) and absent is None and math.isnan(nan)
        assert half == pytest.approx(6371 * math.pi, rel=1e-6)
