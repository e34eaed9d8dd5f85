"""Small hand-made inputs."""

from datetime import datetime

from pyspark.sql import functions as F

from ridelake import schemas

TRIP = {
    "ride_id": "r1",
    "rideable_type": "classic_bike",
    "started_at": "2024-07-11 08:45:00",
    "ended_at": "2024-07-11 09:05:00",
    "start_station_name": "First St",
    "start_station_id": "5379.1",
    "end_station_name": "Second St",
    "end_station_id": "5164.05",
    "start_lat": "40.71",
    "start_lng": "-73.95",
    "end_lat": "40.72",
    "end_lng": "-73.96",
    "member_casual": "member",
}
DAY = {
    "trip_date": "2024-07-11",
    "temp": 76.2,
    "visib": 9.3,
    "wdsp": 2.2,
    "prcp": 0.18,
    "sndp": 999.9,
    "frshtt": "010010",
}


def raw_trips(spark, *changes):
    rows = [tuple({**TRIP, **change}[n] for n in schemas.RAW_TRIPS.names) for change in changes]
    return spark.createDataFrame(rows, schemas.RAW_TRIPS)


def days(spark, *changes):
    rows = [{**DAY, **change} for change in changes]
    rows = [
        tuple(
            datetime.strptime(row[n], "%Y-%m-%d").date() if n == "trip_date" else row[n]
            for n in schemas.DAILY_WEATHER.names
        )
        for row in rows
    ]
    return spark.createDataFrame(rows, schemas.DAILY_WEATHER)


def values(spark, kind, items, column):
    """``column`` evaluated over ``items`` held in a column named ``v``, in order."""
    df = spark.createDataFrame(list(enumerate(items)), f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
