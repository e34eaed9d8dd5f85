"""Column layouts of the raw, Silver and Gold layers."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
}


def layout(text: str) -> T.StructType:
    fields = [line.split() for line in text.strip().splitlines()]
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


# The column names and types below are the published layouts.

RAW_TRIPS = layout("""
    ride_id string
    rideable_type string
    started_at string
    ended_at string
    start_station_name string
    start_station_id string
    end_station_name string
    end_station_id string
    start_lat string
    start_lng string
    end_lat string
    end_lng string
    member_casual string
""")

RAW_WEATHER = layout("""
    STATION string
    DATE string
    LATITUDE string
    LONGITUDE string
    ELEVATION string
    NAME string
    TEMP string
    TEMP_ATTRIBUTES string
    DEWP string
    DEWP_ATTRIBUTES string
    SLP string
    SLP_ATTRIBUTES string
    STP string
    STP_ATTRIBUTES string
    VISIB string
    VISIB_ATTRIBUTES string
    WDSP string
    WDSP_ATTRIBUTES string
    MXSPD string
    GUST string
    MAX string
    MAX_ATTRIBUTES string
    MIN string
    MIN_ATTRIBUTES string
    PRCP string
    PRCP_ATTRIBUTES string
    SNDP string
    FRSHTT string
""")

TYPED_TRIPS = layout("""
    ride_id string
    rideable_type string
    started_at timestamp
    ended_at timestamp
    start_station_name string
    start_station_id string
    end_station_name string
    end_station_id string
    start_lat double
    start_lng double
    end_lat double
    end_lng double
    member_casual string
""")

DAILY_WEATHER = layout("""
    trip_date date
    temp double
    visib double
    wdsp double
    prcp double
    sndp double
    frshtt string
""")

SILVER = layout("""
    ride_id string
    rideable_type string
    member_casual string
    started_at timestamp
    ended_at timestamp
    trip_date date
    start_hour int
    start_station_id string
    start_station_name string
    end_station_id string
    end_station_name string
    start_lat double
    start_lng double
    end_lat double
    end_lng double
    trip_duration_min double
    trip_distance double
    is_round_trip int
    weekend boolean
    is_rush_hour boolean
    is_holiday boolean
    day_of_week string
    month int
    year int
    season string
    temp double
    visib double
    wdsp double
    prcp double
    sndp double
    is_fog int
    is_rain int
    is_snow int
    is_hail int
    is_thunder int
    is_tornado int
    temp_category string
    prcp_category string
""")

# Silver as stored: below the load that delivered the rows, then by month.
SILVER_STORED = T.StructType([*SILVER.fields, T.StructField("load", T.StringType(), True)])

DIM_DATE = layout("""
    date_key int
    trip_date date
    year int
    month int
    day_of_week string
    weekend boolean
    season string
""")

DIM_MEMBER = layout("""
    member_key bigint
    member_casual string
""")

DIM_STATION = layout("""
    station_key bigint
    station_id string
    station_name string
""")

DIM_BIKE_TYPE = layout("""
    bike_key bigint
    rideable_type string
""")

DIM_TEMPERATURE = layout("""
    temp_key bigint
    temp_category string
""")

FACT_TRIPS = layout("""
    ride_id string
    date_key int
    member_key bigint
    bike_key bigint
    temp_key bigint
    start_station_key bigint
    end_station_key bigint
    year int
    month int
    start_hour int
    trip_date date
    trip_distance double
    trip_duration_min double
    temperature double
    is_rush_hour boolean
    weekend boolean
""")

# Weather columns each rule set reads as numbers.
SILVER_WEATHER_NUMBERS = ("TEMP", "VISIB", "WDSP", "PRCP", "SNDP")
FULL_WEATHER_NUMBERS = (
    "TEMP", "DEWP", "SLP", "STP", "VISIB", "WDSP",
    "MXSPD", "GUST", "MAX", "MIN", "PRCP", "SNDP",
)
# Position of each weather event in the FRSHTT text.
WEATHER_EVENTS = ("fog", "rain", "snow", "hail", "thunder", "tornado")

# Filters over the ride ids of a stored month.
RIDE_FILTERS = layout("""
    year int
    month int
    blocks bigint
    block bigint
    bitmap binary
    load string
""")
