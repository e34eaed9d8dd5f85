"""Trips and daily weather derived from the driver tables.

The driver tables hold no rides, so every order becomes one trip and every order
date one weather day. The text runs unchanged on Spark SQL and on the checking
engine; ``{orders}`` and ``{events}`` name the source table.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from contextlib import ExitStack
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.functions import geo
from ridelake.operators.clean import typed
from ridelake.operators.lookup import left_lookup, sized
from ridelake.plans.lake import silver_to_gold, write_silver
from ridelake.session import fresh_path, materialise

ORDER_TRIPS = """
base AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st,
         o_orderdate + ((o_orderkey * 7) % 1440) * INTERVAL '1' MINUTE AS started_at,
         1000 + o_custkey % 60 AS s_id,
         1000 + (o_custkey * 13 + o_orderkey) % 60 AS e_id
  FROM {orders}
), trips AS (
  SELECT CAST(k AS STRING) AS ride_id,
         CASE WHEN st = 'F' THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
         CASE WHEN c % 4 = 0 THEN 'casual' ELSE 'member' END AS member_casual,
         started_at,
         started_at + ((k * 37) % 1500 - 15) * INTERVAL '1' MINUTE AS ended_at,
         CASE WHEN k % 97 = 0 THEN NULL ELSE CAST(s_id AS STRING) END AS start_station_id,
         CASE WHEN k % 97 = 0 THEN NULL WHEN s_id = 1007 AND k % 2 = 0 THEN 'St 1007 (alt)'
              ELSE concat('St ', CAST(s_id AS STRING)) END AS start_station_name,
         CASE WHEN k % 89 = 0 THEN NULL ELSE CAST(e_id AS STRING) END AS end_station_id,
         CASE WHEN k % 89 = 0 THEN NULL ELSE concat('St ', CAST(e_id AS STRING)) END AS end_station_name,
         CASE WHEN k % 101 = 0 THEN 41.5E0 ELSE 40.5E0 + (s_id % 60) * 0.0065E0 END AS start_lat,
         -74.2E0 + (s_id * 7 % 60) * 0.008E0 AS start_lng,
         40.5E0 + (e_id % 60) * 0.0065E0 AS end_lat,
         -74.2E0 + (e_id * 7 % 60) * 0.008E0 AS end_lng
  FROM base
)"""

ORDER_DAYS = """
days AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS trip_date,
         EXTRACT(DOY FROM o_orderdate) AS n, EXTRACT(YEAR FROM o_orderdate) AS y
  FROM {orders}
)"""

# Trips with fractional seconds, for the arrival of files.
EVENT_TRIPS = """
base AS (
  SELECT event_id AS k, user_id AS u, event_type AS st, ts AS started_at,
         CAST(FLOOR(value * 60) AS BIGINT) AS secs,
         1000 + user_id % 60 AS s_id,
         1000 + (user_id * 13 + event_id) % 60 AS e_id
  FROM {events}
), trips AS (
  SELECT CAST(k AS STRING) AS ride_id,
         CASE WHEN st = 'click' THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
         CASE WHEN u % 4 = 0 THEN 'casual' ELSE 'member' END AS member_casual,
         started_at,
         started_at + secs * INTERVAL '1' SECOND AS ended_at,
         CASE WHEN k % 97 = 0 THEN NULL ELSE CAST(s_id AS STRING) END AS start_station_id,
         CASE WHEN k % 97 = 0 THEN NULL ELSE concat('St ', CAST(s_id AS STRING)) END AS start_station_name,
         CASE WHEN k % 89 = 0 THEN NULL ELSE CAST(e_id AS STRING) END AS end_station_id,
         CASE WHEN k % 89 = 0 THEN NULL ELSE concat('St ', CAST(e_id AS STRING)) END AS end_station_name,
         CASE WHEN k % 101 = 0 THEN 41.5E0 ELSE 40.5E0 + (s_id % 60) * 0.0065E0 END AS start_lat,
         -74.2E0 + (s_id * 7 % 60) * 0.008E0 AS start_lng,
         40.5E0 + (e_id % 60) * 0.0065E0 AS end_lat,
         -74.2E0 + (e_id * 7 % 60) * 0.008E0 AS end_lng
  FROM base
)"""

EVENT_DAYS = """
days AS (
  SELECT DISTINCT CAST(ts AS DATE) AS trip_date,
         EXTRACT(DOY FROM ts) AS n, EXTRACT(YEAR FROM ts) AS y
  FROM {events}
)"""

WEATHER = """
weather AS (
  SELECT trip_date,
         CASE WHEN n % 17 = 0 THEN 999.9E0 ELSE 20E0 + (n * 3 % 750) / 10E0 END AS temp,
         CASE WHEN n % 19 = 0 THEN 999.9E0 WHEN n % 3 = 0 THEN 0E0 ELSE (n * 7 % 50) / 100E0 END AS prcp,
         (n * 5 % 60) / 10E0 AS wdsp,
         (n * 11 % 100) / 10E0 AS visib,
         CASE WHEN n % 5 = 0 THEN 0E0 ELSE 999.9E0 END AS sndp,
         CASE WHEN n % 29 = 0 THEN NULL ELSE concat(
           CAST(n % 2 AS STRING), CAST(n % 3 % 2 AS STRING), CAST(n % 5 % 2 AS STRING),
           CAST(n % 7 % 2 AS STRING), CAST(n % 11 % 2 AS STRING), '0') END AS frshtt
  FROM days WHERE (n + y) % 31 <> 0
)"""


def _run(spark: SparkSession, sf_dir: str, ctes: list[str], query: str) -> DataFrame:
    text = "WITH " + ", ".join(ctes) + " " + query
    for table in ("orders", "events"):
        text = text.replace("{" + table + "}", f"parquet.`{sf_dir}/{table}.parquet`")
    return spark.sql(text)


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with their zone-free timestamps, as the driver table has them."""
    return _run(spark, sf_dir, [ORDER_TRIPS], "SELECT * FROM trips")


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, [EVENT_TRIPS], "SELECT * FROM trips")


_once: dict[tuple[str, str, str], object] = {}


def _per_session(kind: str, spark: SparkSession, sf_dir: str, build):
    """Build a stored relation once per application and input directory."""
    key = (kind, spark.sparkContext.applicationId, sf_dir)
    if key not in _once:
        _once[key] = build()
    return _once[key]


def typed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed trips as a stored raw layer.

    The table-building plans use every column many times over. Over stored
    columns their generated code stays small enough to be compiled; with the
    derivation above inlined into each use it would not.
    """
    return _per_session(
        "trips",
        spark,
        sf_dir,
        lambda: materialise(typed(order_trips(spark, sf_dir), schemas.TYPED_TRIPS), "trips"),
    )


def _stored_weather(spark: SparkSession, sf_dir: str, days: str) -> DataFrame:
    daily = _run(spark, sf_dir, [days, WEATHER], "SELECT * FROM weather")
    return materialise(typed(daily, schemas.DAILY_WEATHER), "weather")


def daily_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored weather, one row per date, marked for broadcast if it measures small."""
    return _per_session(
        "weather", spark, sf_dir, lambda: sized(_stored_weather(spark, sf_dir, ORDER_DAYS))
    )


def event_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_session(
        "event weather", spark, sf_dir, lambda: sized(_stored_weather(spark, sf_dir, EVENT_DAYS))
    )


def joined_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored trips with their distance and weather, before any rule removed rows."""

    def build() -> DataFrame:
        corners = [F.col(c) for c in ("start_lat", "start_lng", "end_lat", "end_lng")]
        trips = typed_trips(spark, sf_dir).withColumns(
            {
                "trip_date": F.to_date("started_at"),
                "trip_distance": F.round(geo.great_circle(*corners), 2),
            }
        )
        return materialise(left_lookup(trips, daily_weather(spark, sf_dir), "trip_date"), "joined")

    return _per_session("joined", spark, sf_dir, build)


def build_lake(spark: SparkSession, sf_dir: str) -> str:
    """Load Silver and Gold from the derived trips below a new root."""
    root = fresh_path(spark, "lake")
    write_silver(typed_trips(spark, sf_dir), daily_weather(spark, sf_dir), root, "orders")
    counts = silver_to_gold(spark, root)
    if counts["silver_rows"] != counts["fact_rows"]:
        raise RuntimeError(f"fact does not match Silver: {counts}")
    return root


def lake(spark: SparkSession, sf_dir: str) -> str:
    """Root of the lake this session uses."""
    return _per_session("lake", spark, sf_dir, lambda: build_lake(spark, sf_dir))


# The readings of the full weather file that the derived weather lacks, as multiples of its temperature and wind.
_MORE_READINGS = {"DEWP": "temp * 0.5", "SLP": "1000 + n % 40", "STP": "990 + n % 30", "MXSPD": "wdsp * 2", "GUST": "wdsp * 4", "MAX": "temp + 5", "MIN": "temp - 5"}


def weather_file(spark: SparkSession, sf_dir: str, path: str, date_format: str, date: str = "trip_date", where: str = "true") -> None:
    """A raw weather CSV of all 28 columns, as one file, for the derived days."""
    daily = _run(spark, sf_dir, [ORDER_DAYS, WEATHER.replace("SELECT trip_date,", "SELECT trip_date, n,", 1)], f"SELECT * FROM weather WHERE {where}")
    known = {"DATE": F.date_format(date, date_format), "NAME": F.lit("CENTRAL PARK, NY US"), "STATION": F.lit("72505394728"), "FRSHTT": F.col("frshtt")}
    known |= {c: F.expr(e).cast("string") for c, e in _MORE_READINGS.items()}
    known |= {c: F.col(c.lower()).cast("string") for c in schemas.SILVER_WEATHER_NUMBERS}
    text = daily.select(*[known.get(c, F.lit("24")).alias(c) for c in schemas.RAW_WEATHER.names])
    # one row per calendar day of a few years: small whatever the number of trips
    text.coalesce(1).write.option("header", True).csv(path)


def zip_files(rows: DataFrame, folder: str, archive: Column, member: Column) -> None:
    """Write text trips as CSV members of ZIP files below ``folder``; a task streams whole archives."""
    names = schemas.RAW_TRIPS.names
    lines = rows.select(archive.alias("archive"), member.alias("member"), F.to_csv(F.struct(*names), {"emptyValue": "", "quoteAll": "false"}).alias("line"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ridelake.sources.zips import file_system

        files, root = file_system(folder)
        files.create_dir(root, recursive=True)
        now, inside, written = None, None, []
        with ExitStack() as held:
            for batch in batches:
                for (name, part), run in groupby(zip(*(c.to_pylist() for c in batch.columns)), itemgetter(0, 1)):
                    if now is None or now[0] != name:
                        held.close()
                        packed = held.enter_context(zipfile.ZipFile(held.enter_context(files.open_output_stream(f"{root}/{name}.zip")), "w", zipfile.ZIP_DEFLATED))
                        packed.writestr("readme.txt", "rides\n")
                        written.append(name)
                    if now != (name, part):
                        if inside is not None and now[0] == name:
                            inside.close()
                        now, inside = (name, part), held.enter_context(packed.open(part, "w"))
                        inside.write((",".join(names) + "\n").encode())
                    inside.write("".join(line + "\n" for _, _, line in run).encode())
        yield pa.RecordBatch.from_arrays([pa.array(written, pa.string())], names=["archive"])

    lines.repartition("archive").sortWithinPartitions("archive", "member").mapInArrow(pack, "archive string").count()
    from ridelake.sources.zips import file_system

    files, root = file_system(folder)
    with files.open_output_stream(f"{root}/notes.zip") as raw, zipfile.ZipFile(raw, "w") as empty:
        empty.writestr("readme.txt", "an archive without rides\n")


def as_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text, so that engines can be compared by value."""
    forms = {
        "date": lambda c: F.date_format(c, "yyyy-MM-dd"),
        "timestamp": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
        "timestamp_ntz": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
    }
    return df.select(
        *[
            forms[f.dataType.simpleString()](F.col(f.name)).alias(f.name)
            if f.dataType.simpleString() in forms
            else F.col(f.name)
            for f in df.schema
        ]
    )
