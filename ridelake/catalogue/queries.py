"""The registered queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake import schemas
from ridelake.catalogue.relations import (
    _per_session,
    as_text,
    daily_weather,
    event_trips,
    event_weather,
    joined_trips,
    lake,
    order_trips,
    typed_trips,
    weather_file,
    zip_files,
)
from ridelake.functions import geo
from ridelake.functions.bands import banded
from ridelake.functions.weather import event_flags
from ridelake.operators import clean
from ridelake.operators.colocated import colocated_lookup, store_colocated
from ridelake.operators.lookup import left_lookup, sized
from ridelake.plans import demand, impact, indicators, profile, silver, star, states, variants
from ridelake.plans.lake import (
    BY_MONTH,
    compact,
    export_silver,
    gold_tables,
    read_gold,
    raw_to_silver,
    read_silver,
    refresh_weather,
    rename_stations,
    silver_to_gold,
    write_silver,
)
from ridelake.rules import RAIN_SILVER, SILVER, TEMP_FAHRENHEIT, TEMP_NOTEBOOK, WIND
from ridelake.session import fresh_path, materialise
from ridelake.sinks.catalog import crawl, register_gold, retired_columns
from ridelake.sinks.layers import append_rows, write_partitioned
from ridelake.sources.layout import Layout
from ridelake.sources.tables import read_layer, read_or_empty, sql_over_path, typed_view
from ridelake.sources.trips import read_trip_zips, read_trips, unzip_trips, zip_rows
from ridelake.streaming.incremental import run_incremental

Query = Callable[[SparkSession, str], DataFrame]


def _on_trips(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: as_text(build(order_trips(spark, sf_dir)))


def _on_days(build: Callable[[DataFrame], DataFrame]) -> Query:
    """Over trips counted per date, with that date's weather."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        per_day = impact.trips_per_day(order_trips(spark, sf_dir), daily_weather(spark, sf_dir))
        return as_text(build(per_day))

    return run


def _on_gold(build: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: as_text(build(read_gold(spark, lake(spark, sf_dir))))


# -- tables ---------------------------------------------------------------


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(
        silver.build_silver(typed_trips(spark, sf_dir), daily_weather(spark, sf_dir))
    )


def silver_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, trip minutes and distance per stored Silver month."""
    stored = read_silver(spark, lake(spark, sf_dir))
    return stored.groupBy(*BY_MONTH).agg(
        F.count("*").alias("trips"),
        F.round(F.sum("trip_duration_min"), 4).alias("minutes"),
        F.sum(F.col("trip_distance").cast("decimal(18,2)")).cast("double").alias("miles"),
    )


def silver_unknown_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver with missing readings kept NULL and their categories unknown, counted."""
    rules = replace(SILVER, unknown_weather=True, sentinel_value=None)
    table = silver.build_silver(typed_trips(spark, sf_dir), daily_weather(spark, sf_dir), rules)
    return table.groupBy("temp_category", "prcp_category").agg(
        F.count("*").alias("trips"), F.count("temp").alias("with_temp")
    )


def distinct_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of all trips delivered twice, each ride kept once, by month."""
    trips = typed_trips(spark, sf_dir)
    table = silver.build_silver(
        trips.unionByName(trips), daily_weather(spark, sf_dir), replace(SILVER, dedup_rides=True)
    )
    return table.groupBy(*BY_MONTH).agg(F.count("*").alias("trips"))


def legacy_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(
        silver.build_legacy(typed_trips(spark, sf_dir), daily_weather(spark, sf_dir))
    )


NOTEBOOK_COLUMNS = (
    "ride_id", "start_date", "start_time", "end_date", "end_time", "start_hour", "is_rush_hour",
    "day_of_week", "month", "year", "season", "trip_duration_minutes", "is_round_trip",
    "trip_distance", "has_fog", "has_rain", "has_snow", "has_thunder",
    "prcp_category", "temp_category", "wind_category",
)


def notebook_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(silver.build_notebook(joined_trips(spark, sf_dir)).select(*NOTEBOOK_COLUMNS))


def notebook_distance_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distance_summary(silver.build_notebook(joined_trips(spark, sf_dir)))


def excessive_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips beyond the distance limit; a limit of 30 miles, as orders span one city."""
    far = clean.excessive_distance(joined_trips(spark, sf_dir), limit=30)
    return far.select(
        "ride_id", "trip_distance", "start_lat", "start_lng", "end_lat", "end_lng",
        "end_station_id", "end_station_name",
    )


def weather_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(silver.daily_features(daily_weather(spark, sf_dir)).drop("has_weather"))


def weather_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip's day re-reported as raw weather text, then reduced to one typed row per date."""
    per_trip = left_lookup(
        order_trips(spark, sf_dir).select(F.to_date("started_at").alias("trip_date")),
        daily_weather(spark, sf_dir),
        "trip_date",
    )
    text = per_trip.select(
        F.date_format("trip_date", "dd-MM-yyyy").alias("DATE"),
        *[F.col(c.lower()).cast("string").alias(c) for c in schemas.SILVER_WEATHER_NUMBERS],
        F.col("frshtt").alias("FRSHTT"),
    )
    return as_text(clean.prepare_weather(text))


def trip_distance_km(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = order_trips(spark, sf_dir)
    km = geo.great_circle(
        F.col("start_lat"), F.col("start_lng"), F.col("end_lat"), F.col("end_lng"),
        unit="km", method="haversine_atan2",
    )
    return trips.select("ride_id", F.round(km, 2).alias("distance_km"))


# -- star schema ----------------------------------------------------------


def _dimension(name: str) -> Query:
    return _on_gold(lambda gold: gold[name])


def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(read_gold(spark, lake(spark, sf_dir))["fact_trips"])


def station_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct (id, name) pair, numbered: the single-load variant."""
    stored = read_silver(spark, lake(spark, sf_dir))
    pairs = star.station_members(stored, one_per_id=False)
    return star.upsert_dimension(pairs, None, star.STATION, mode="rebuild")


RIDERS = star.Dimension(
    "dim_rider", "rider_key", "rider_id",
    schemas.layout("rider_key bigint\nrider_id string"), ("Unknown",),
)
SECOND_LOAD_YEAR = 1997


def dim_stable_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension over customers loaded in two steps; first-load keys must stay."""
    orders = read_layer(spark, f"{sf_dir}/orders.parquet").select(
        F.col("o_custkey").cast("string").alias("rider_id"), F.year("o_orderdate").alias("y")
    )
    early = orders.filter(F.col("y") < SECOND_LOAD_YEAR).select("rider_id").distinct()
    first = star.upsert_dimension(early, None, RIDERS)
    stored = materialise(first, "riders")
    everyone = orders.select("rider_id").distinct()
    return star.upsert_dimension(everyone, stored, RIDERS)


def dim_rebuild_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two steps, numbering everyone again each time."""
    orders = read_layer(spark, f"{sf_dir}/orders.parquet").select(
        F.col("o_custkey").cast("string").alias("rider_id"), F.year("o_orderdate").alias("y")
    )
    early = orders.filter(F.col("y") < SECOND_LOAD_YEAR).select("rider_id").distinct()
    stored = materialise(star.upsert_dimension(early, None, RIDERS, mode="rebuild"), "riders")
    late = orders.filter(F.col("y") >= SECOND_LOAD_YEAR).select("rider_id").distinct()
    return star.upsert_dimension(late, stored, RIDERS, mode="rebuild")


# -- profile --------------------------------------------------------------


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_profile(joined_trips(spark, sf_dir).drop("trip_distance"))


def rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = order_trips(spark, sf_dir)
    per_day = impact.trips_per_day(trips, daily_weather(spark, sf_dir))
    return profile.trip_rule_counts(trips).unionByName(profile.weather_rule_counts(per_day))


def date_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar days inside the covered span for which no weather row exists."""
    return as_text(profile.date_gaps(daily_weather(spark, sf_dir).select("trip_date")))


def sentinel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.sentinel_counts(
        daily_weather(spark, sf_dir), ["temp", "visib", "wdsp", "prcp", "sndp"]
    )


def category_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct readings with the labels both rule variants and the wind rule give them."""
    daily = silver.clean_weather(daily_weather(spark, sf_dir))
    rules = {
        "temp, current": ("temp", TEMP_FAHRENHEIT),
        "temp, notebook": ("temp", TEMP_NOTEBOOK),
        "prcp, current": ("prcp", RAIN_SILVER),
        "wdsp": ("wdsp", WIND),
    }
    tall = daily.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("rule"),
                        F.col(column).alias("reading"),
                        banded(F.col(column), bands).alias("category"),
                    )
                    for name, (column, bands) in rules.items()
                ]
            )
        ).alias("row")
    )
    return tall.select("row.*").distinct()


def event_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct event texts with the flags decoded from them."""
    daily = daily_weather(spark, sf_dir)
    flags = event_flags(F.col("frshtt"), prefix="has_", as_boolean=True)
    shown = ["has_fog", "has_rain", "has_snow", "has_thunder"]
    return profile.category_audit(
        daily.withColumns({name: flags[name] for name in shown}), "frshtt", *shown
    )


def joined_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined table as text, typed again, then described."""
    joined = joined_trips(spark, sf_dir)
    text = joined.select(*[F.col(c).cast("string").alias(c) for c in joined.columns])
    numbers = [
        "start_lat", "start_lng", "end_lat", "end_lng", "temp", "visib", "wdsp", "prcp", "sndp",
    ]
    return profile.describe_columns(clean.cast_joined(text), numbers)


def weather_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.weather_event_days(daily_weather(spark, sf_dir))


def numeric_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["trip_duration_min", "trip_distance", "start_hour", "temp", "prcp", "wdsp"]
    return profile.correlations(read_silver(spark, lake(spark, sf_dir)), columns)


def describe_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["start_lat", "start_lng", "end_lat", "end_lng", "trip_duration_min", "temp"]
    return profile.describe_columns(read_silver(spark, lake(spark, sf_dir)), columns)


def describe_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.describe_text(
        order_trips(spark, sf_dir), ["ride_id", "rideable_type", "start_station_id", "end_station_name"]
    )


def dataset_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = order_trips(spark, sf_dir)
    return trips.agg(
        F.count("*").alias("total_rows"), F.lit(len(trips.columns)).alias("total_columns")
    )


def footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.footprint(read_layer(spark, f"{sf_dir}/orders.parquet"))


def rows_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_over_path(
        spark, f"{sf_dir}/orders.parquet", "SELECT count(*) AS total_rows FROM {source}"
    )


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten trips by start time."""
    return as_text(
        order_trips(spark, sf_dir)
        .orderBy("started_at", "ride_id")
        .limit(10)
        .select("ride_id", "started_at", "ended_at", "rideable_type")
    )


# -- sources and sinks ----------------------------------------------------


def _raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived trips as a raw file would hold them: text only."""
    return order_trips(spark, sf_dir).select(
        *[F.col(name).cast("string").alias(name) for name in schemas.RAW_TRIPS.names]
    )


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "raw-csv")
    _raw_text(spark, sf_dir).write.option("header", True).csv(path)
    return as_text(clean.cast_trips(read_trips(spark, path)))


def zip_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips packed into archives, unpacked, staged by archive and read back."""
    staged = fresh_path(spark, "staged")
    rows = unzip_trips(zip_rows(_raw_text(spark, sf_dir)))
    typed = clean.typed(rows, schemas.TYPED_TRIPS)
    append_rows(typed, staged)
    return as_text(read_layer(spark, staged))


# Trips for two archives; a member is one task's, so their number follows the trips.
ARCHIVED = 500_000


def _zipped(spark: SparkSession, sf_dir: str) -> str:
    """A folder with two archives of two CSV members each for every ``ARCHIVED`` trips, and one without a CSV."""
    folder = fresh_path(spark, "zips")
    odd = lambda name, column: F.concat(F.lit(f"{name}-"), (column % 2).cast("int").cast("string"))
    text = _raw_text(spark, sf_dir)
    member = F.concat(odd("rides", F.col("ride_id").cast("long")), F.lit(".csv"))
    part = F.pmod(F.xxhash64("ride_id"), F.lit(max(1, ceil(text.count() / ARCHIVED)))).cast("string")
    zip_files(text, folder, F.concat_ws("-", odd("trips", F.year("started_at")), part), member)
    return folder


def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips read from real ZIP files, a task for every CSV member."""
    rows = read_trip_zips(spark, _zipped(spark, sf_dir))
    return as_text(clean.typed(rows, schemas.TYPED_TRIPS))


def season_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-shot job from files to files: archives, staged months, full weather CSV, table by season."""
    base = fresh_path(spark, "season-job")
    weather_file(spark, sf_dir, f"{base}/weather.csv", "yyyy-MM-dd")
    variants.zips_to_season_table(spark, _zipped(spark, sf_dir), f"{base}/weather.csv", f"{base}/staged", f"{base}/out")
    return as_text(read_layer(spark, f"{base}/out"))


# Files of a load begin on this day of January, so that loads meet inside a month.
FIRST_DAY = 11


def yearly_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV of trips and weather to Silver, a job for each year's files, and one to Gold; returns Silver.

    A year's files begin on 11 January, so a load also holds ten days of the next year, on which its job knows no holidays.
    """
    layout = Layout(fresh_path(spark, "yearly-job"))
    text = _raw_text(spark, sf_dir).withColumn("load", F.year(F.date_sub(F.to_date("started_at"), FIRST_DAY - 1)))
    years = [r["load"] for r in text.select("load").distinct().orderBy("load").collect()]  # one for each year
    for year in years:
        text.where(F.col("load") == year).drop("load").write.option("header", True).csv(layout.raw_trips(year))
        weather_file(spark, sf_dir, layout.raw_weather(year), "dd-MM-yyyy", where=f"year(trip_date - interval {FIRST_DAY - 1} day) = {year}")
        raw_to_silver(spark, layout.root, year)
    counts = silver_to_gold(spark, layout.root, [str(year) for year in years])
    if counts["silver_rows"] != counts["fact_rows"]:
        raise RuntimeError(f"fact does not match Silver: {counts}")
    return as_text(read_silver(spark, layout.root))


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature-engineering job from one catalog table to another, run twice: the second replaces table and schema."""
    base = fresh_path(spark, "features")
    database = "features_" + base.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}'")
    joined_trips(spark, sf_dir).write.saveAsTable(f"{database}.joined")
    for _ in range(2):
        variants.feature_table(spark, f"{database}.joined", f"{database}.features")
    return as_text(spark.table(f"{database}.features").select(*NOTEBOOK_COLUMNS))


def typed_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views over a file of text, with station columns and without, asked in SQL."""
    path = fresh_path(spark, "raw-text")
    _raw_text(spark, sf_dir).write.parquet(path)
    name = "rides_" + path.rsplit("-", 1)[-1]
    stations = [f for f in schemas.TYPED_TRIPS if "station" in f.name]
    typed_view(spark, path, schemas.TYPED_TRIPS, f"{name}_full")
    typed_view(spark, path, T.StructType([f for f in schemas.TYPED_TRIPS if f not in stations]), f"{name}_short")
    return spark.sql(f"""
        SELECT member_casual, 'full' AS shape, count(start_station_id) AS with_station, count(ended_at) AS with_end, round(sum(end_lat), 4) AS lat
        FROM {name}_full GROUP BY member_casual
        UNION ALL
        SELECT member_casual, 'short', 0L, count(ended_at), round(sum(end_lat), 4) FROM {name}_short GROUP BY member_casual""")


def schema_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.describe_schema(read_layer(spark, f"{sf_dir}/orders.parquet"))


def layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned layer in which the second write replaces only its own months.

    The first write stores every trip, the second the later years again with
    their distance set to zero. The earlier months must keep theirs.
    """
    path = fresh_path(spark, "layer")
    facts = read_gold(spark, lake(spark, sf_dir))["fact_trips"].select(
        "ride_id", "trip_distance", *BY_MONTH
    )
    write_partitioned(facts, path, BY_MONTH)
    later = facts.filter(F.col("year") >= 1999).withColumn("trip_distance", F.lit(0.0))
    write_partitioned(later, path, BY_MONTH)
    return read_layer(spark, path).select("ride_id", "trip_distance", *BY_MONTH)


def season_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier table partitioned by season, read back as counts."""
    path = fresh_path(spark, "by-season")
    table = silver.build_legacy(typed_trips(spark, sf_dir), daily_weather(spark, sf_dir))
    write_partitioned(table, path, ["season"], dynamic=False)
    return read_layer(spark, path).groupBy("season").agg(F.count("*").alias("trips"))


def missing_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per month plus a layer that was never written."""
    counts = demand.rides_by_month_label(order_trips(spark, sf_dir))
    absent = read_or_empty(spark, fresh_path(spark, "never-written"), counts.schema)
    return counts.unionByName(absent)


def gold_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per month through the registered external tables."""
    root = lake(spark, sf_dir)
    database = "gold_" + root.rsplit("-", 1)[-1]
    register_gold(spark, database, gold_tables(spark, root))
    fact, dates = spark.table(f"{database}.fact_trips"), spark.table(f"{database}.dim_date")
    return (
        fact.groupBy("date_key", *BY_MONTH)
        .agg(F.count("*").alias("n"))
        .join(dates.select("date_key", "season"), "date_key")
        .groupBy(*BY_MONTH, "season")
        .agg(F.sum("n").alias("trips"))
    )


def catalog_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three generations of files under one table: types grow, a column comes, a column goes; every row is still read."""
    path = fresh_path(spark, "drifting")
    table = "drifting_" + path.rsplit("-", 1)[-1]
    facts = read_gold(spark, lake(spark, sf_dir))["fact_trips"]
    year, hour, far = F.col("year"), F.col("start_hour"), F.col("trip_distance")
    generations = (
        (year <= 1996, [hour.cast("smallint").alias("start_hour"), far.cast("float").alias("trip_distance"), "weekend"]),
        (year.between(1997, 1998), [hour.cast("int").alias("start_hour"), far, "weekend", "is_rush_hour"]),
        (year >= 1999, [hour.cast("bigint").alias("start_hour"), far, "is_rush_hour"]),
    )
    for which, columns in generations:
        write_partitioned(facts.filter(which).select("ride_id", *columns, *BY_MONTH), path, BY_MONTH)
        crawl(spark, table, path, T.StructType.fromDDL("year int, month int"))
    return spark.table(table).groupBy("year", "month").agg(
        F.count("ride_id").alias("trips"),
        F.sum("start_hour").alias("hours"),
        F.sum(F.round(far * 100).cast("bigint")).alias("distance_cm"),
        F.count("weekend").alias("with_weekend"),
        F.count("is_rush_hour").alias("with_rush_hour"),
    ).withColumn("retired", F.lit(",".join(retired_columns(spark, table))))


def fact_unknown_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lake whose trips without a temperature have no category: the fact has them under key -1."""
    root = fresh_path(spark, "unknown-members")
    rules = replace(SILVER, unknown_weather=True, sentinel_value=None)
    write_silver(typed_trips(spark, sf_dir), daily_weather(spark, sf_dir), root, "all", rules)
    silver_to_gold(spark, root)
    gold = read_gold(spark, root)
    named = left_lookup(gold["fact_trips"], sized(gold["dim_temperature"]), "temp_key")
    return named.groupBy((F.col("temp_key") == star.UNKNOWN_KEY).alias("unknown"), "temp_category").agg(
        F.count(F.lit(1)).alias("trips"), F.count("temperature").alias("with_temperature")
    )


def imbalance_of_hubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories where one station takes half of all arrivals and another a quarter of the departures, so that both ends occur."""
    trips, number = order_trips(spark, sf_dir), F.col("ride_id").cast("long")
    drawn = {"end_station_id": F.when(number % 2 == 0, "HUB"), "start_station_id": F.when(number % 4 == 1, "DEPOT")}
    return as_text(demand.classified_imbalance(trips.withColumns({c: F.coalesce(to, F.col(c)) for c, to in drawn.items()})))


def station_ends_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and distance by either end's station, looked up in tables that share its buckets, as for a dimension beyond broadcast."""
    gold, parts = read_gold(spark, lake(spark, sf_dir)), []
    for role in ("start", "end"):
        path, key = fresh_path(spark, f"{role}-buckets"), f"{role}_station_key"
        names = [f"{role}_{kind}_{path.rsplit('-', 1)[-1]}" for kind in ("trips", "stations")]
        store_colocated(gold["fact_trips"].select(key, "trip_distance"), gold["dim_station"].withColumnRenamed("station_key", key), key, *names, path, buckets=16)
        found = colocated_lookup(spark, key, *names).groupBy("station_id", "station_name")
        cents = F.sum(F.round(F.col("trip_distance") * 100).cast("bigint"))
        parts.append(found.agg(F.count(F.lit(1)).alias("trips"), cents.alias("distance_cents")).withColumn("role", F.lit(role)))
    return parts[0].unionByName(parts[1])


def silver_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as one table without partitions, its files bounded by its size."""
    path = fresh_path(spark, "export")
    export_silver(spark, lake(spark, sf_dir), path)
    return as_text(read_layer(spark, path))


# Trips for one of the tasks that scatter each of two loads; a task sorts its rows by month to write them.
SCATTERED = 1_000_000


def lake_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that meet in some months, scattered over many files and then packed by size, with the fact built between."""
    root = fresh_path(spark, "compacted")
    trips, daily = typed_trips(spark, sf_dir), daily_weather(spark, sf_dir)
    odd = F.col("ride_id").cast("long") % 2 == 1
    tasks = max(4, ceil(trips.count() / SCATTERED))
    for load, rows in (("even", trips.filter(~odd)), ("odd", trips.filter(odd))):
        write_silver(rows.repartition(tasks), daily, root, load, clustered=True)
    silver_to_gold(spark, root)
    compact(spark, root)
    counts = silver_to_gold(spark, root, ["odd"])
    if counts["silver_rows"] != counts["fact_rows"]:
        raise RuntimeError(f"fact does not match Silver: {counts}")
    return fact_with_texts(spark, root)


# -- arrivals -------------------------------------------------------------


def stream_two_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping drops of files through the stream; every ride counts once.

    The first drop holds the month up to day 20, the second everything from day
    10 on, so ten days arrive twice.
    """
    base = fresh_path(spark, "arrivals-lake")
    daily = event_weather(spark, sf_dir)
    raw = event_trips(spark, sf_dir)
    day = F.dayofmonth("started_at")
    for drop, rows in (("first", raw.filter(day <= 20)), ("second", raw.filter(day >= 10))):
        text = rows.select(*[F.col(n).cast("string").alias(n) for n in schemas.RAW_TRIPS.names])
        text.write.option("header", True).csv(f"{base}/in/{drop}")
        run_incremental(spark, f"{base}/in", daily, f"{base}/lake", f"{base}/checkpoint")
    return fact_with_texts(spark, f"{base}/lake")


def fact_with_texts(spark: SparkSession, root: str) -> DataFrame:
    """The stored fact, its keys resolved to the texts they stand for."""
    gold = read_gold(spark, root)
    facts = gold["fact_trips"]
    for dim in (star.MEMBER, star.BIKE_TYPE, star.TEMPERATURE):
        facts = left_lookup(facts, sized(gold[dim.name]), dim.key)
    for role in ("start", "end"):
        named = gold["dim_station"].select(
            F.col("station_key").alias(f"{role}_station_key"),
            F.col("station_id").alias(f"{role}_station_id"),
        )
        facts = left_lookup(facts, sized(named), f"{role}_station_key")
    return facts.select(
        "ride_id", "date_key", "member_casual", "rideable_type", "temp_category",
        "start_station_id", "end_station_id", "start_hour", "trip_distance",
        F.round("trip_duration_min", 6).alias("trip_duration_min"), "is_rush_hour", "weekend",
    )


def lake_two_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that meet in some months, each carried to Gold alone: later keys leave earlier rows right."""
    root = fresh_path(spark, "two-years")
    trips, daily = typed_trips(spark, sf_dir), daily_weather(spark, sf_dir)
    first = (F.year("started_at") < 1995) | ((F.year("started_at") == 1995) & (F.col("ride_id").cast("long") % 2 == 0))
    for load, rows in (("early", trips.filter(first)), ("late", trips.filter(~first))):
        write_silver(rows, daily, root, load)
        silver_to_gold(spark, root, [load])
    return fact_with_texts(spark, root)


def lake_corrected_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load written again without one of its years: the year leaves the fact."""
    root = fresh_path(spark, "corrected")
    trips, daily = typed_trips(spark, sf_dir), daily_weather(spark, sf_dir)
    for rows in (trips, trips.filter(F.year("started_at") != 1996)):
        write_silver(rows, daily, root, "orders")
        silver_to_gold(spark, root, ["orders"])
    return fact_with_texts(spark, root)


def _states_after_three_loads(spark: SparkSession, sf_dir: str) -> str:
    """A lake whose states follow three loads: two that meet in a month, and the first one again without a year."""
    root = fresh_path(spark, "states")
    trips, daily = typed_trips(spark, sf_dir), daily_weather(spark, sf_dir)
    early = (F.year("started_at") < 1998) | ((F.year("started_at") == 1998) & (F.col("ride_id").cast("long") % 2 == 0))
    for load, rows in (("early", trips.filter(early)), ("late", trips.filter(~early)), ("early", trips.filter(early & (F.year("started_at") != 1996)))):
        write_silver(rows, daily, root, load)
        states.refresh_states(spark, root)
    return root


def _states_lake(spark: SparkSession, sf_dir: str) -> str:
    return _per_session("states", spark, sf_dir, lambda: _states_after_three_loads(spark, sf_dir))


def _on_states(build: Callable[[SparkSession, str], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(spark, _states_lake(spark, sf_dir))


def distinct_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct rides by month, and whether the stored sketch is within three standard errors of it."""
    root = _states_lake(spark, sf_dir)
    exact = read_silver(spark, root).groupBy(*BY_MONTH).agg(F.count_distinct("ride_id").alias("exact"))
    found = states.distinct_estimates(spark, root, BY_MONTH)
    near = F.abs(F.col("rides") - F.col("exact")) <= F.greatest(F.lit(1.0), 3 * states.DISTINCT_ERROR * F.col("exact"))
    return exact.join(found, BY_MONTH, "left").select(*BY_MONTH, "exact", F.coalesce(near, F.lit(False)).alias("near"))


SHARES = (0.01, 0.25, 0.5, 0.75, 0.99)


def duration_quantiles_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips in all, and whether the ranks around each quantile of the stored sketches hold the share asked for."""
    root = _states_lake(spark, sf_dir)
    asked = {r["share"]: r["minutes"] for r in states.duration_quantiles(spark, root, SHARES).collect()}
    minutes, n = F.col("trip_duration_min"), F.count(F.lit(1))
    ranks = [F.struct(F.lit(s).alias("share"), (F.count_if(minutes < v) / n).alias("below"), (F.count_if(minutes <= v) / n).alias("upto")) for s, v in sorted(asked.items())]
    rows = read_silver(spark, root).agg(n.alias("trips"), F.array(*ranks).alias("ranks")).select("trips", F.inline("ranks"))
    inside = (F.col("below") <= F.col("share") + states.RANK_ERROR) & (F.col("upto") >= F.col("share") - states.RANK_ERROR)
    return rows.select("trips", "share", inside.alias("near"))


def _as_files(rows: DataFrame, path: str) -> None:
    text = rows.select(*[F.col(n).cast("string").alias(n) for n in schemas.RAW_TRIPS.names])
    text.write.option("header", True).csv(path)


def _both_ways(spark: SparkSession, sf_dir: str, stream_first: bool) -> DataFrame:
    """The same rides by files that arrive and by a batch load; each counts once."""
    base = fresh_path(spark, "both-ways")
    daily, raw = event_weather(spark, sf_dir), event_trips(spark, sf_dir)
    _as_files(raw, f"{base}/in/all")

    def stream() -> None:
        run_incremental(spark, f"{base}/in", daily, f"{base}/lake", f"{base}/checkpoint")

    def batch() -> None:
        write_silver(materialise(clean.typed(raw, schemas.TYPED_TRIPS), "event-trips"), daily, f"{base}/lake", "events")
        silver_to_gold(spark, f"{base}/lake", ["events"])

    for step in (stream, batch) if stream_first else (batch, stream):
        step()
    return fact_with_texts(spark, f"{base}/lake")


def lake_stream_then_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both_ways(spark, sf_dir, True)


def lake_batch_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both_ways(spark, sf_dir, False)


def lake_late_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides that arrive before any weather, and the weather a run later."""
    base = fresh_path(spark, "late-weather")
    daily = event_weather(spark, sf_dir)
    _as_files(event_trips(spark, sf_dir), f"{base}/in/all")
    run_incremental(spark, f"{base}/in", daily.limit(0), f"{base}/lake", f"{base}/checkpoint")
    refresh_weather(spark, f"{base}/lake", daily)
    return fact_with_texts(spark, f"{base}/lake")


MOVED_DAYS = 20


def _moved(spark: SparkSession, sf_dir: str, stream_first: bool) -> DataFrame:
    """Every ride by files that arrive, a third of them under a later date, and the even ones by a batch load under their own.

    Each counts once, wherever the two meet: as the load has it, or else as it arrived.
    """
    base = fresh_path(spark, "moved")
    daily, raw = event_weather(spark, sf_dir), event_trips(spark, sf_dir)
    number = F.col("ride_id").cast("long")
    shift = F.when(number % 3 == 0, F.expr(f"interval {MOVED_DAYS} day")).otherwise(F.expr("interval 0 day"))
    _as_files(raw.withColumns({c: F.col(c) + shift for c in ("started_at", "ended_at")}), f"{base}/in/all")

    def stream() -> None:
        run_incremental(spark, f"{base}/in", daily, f"{base}/lake", f"{base}/checkpoint")

    def batch() -> None:
        write_silver(materialise(clean.typed(raw.where(number % 2 == 0), schemas.TYPED_TRIPS), "event-trips"), daily, f"{base}/lake", "events")
        silver_to_gold(spark, f"{base}/lake", ["events"])

    for step in (stream, batch) if stream_first else (batch, stream):
        step()
    return fact_with_texts(spark, f"{base}/lake")


def lake_moved_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moved(spark, sf_dir, False)


def lake_moved_rides_stream_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moved(spark, sf_dir, True)


def dim_station_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations after a second load under other names and a renaming over both."""
    root = fresh_path(spark, "renamed")
    trips, daily = typed_trips(spark, sf_dir), daily_weather(spark, sf_dir)
    early = F.year("started_at") < 1998
    renamed = trips.filter(~early).withColumn("start_station_name", F.concat(F.lit("New "), "start_station_name"))
    for load, rows in (("early", trips.filter(early)), ("late", renamed)):
        write_silver(rows, daily, root, load)
        silver_to_gold(spark, root, [load])
    rename_stations(spark, root)
    return read_gold(spark, root)["dim_station"].select("station_id", "station_name")


def event_duration_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average duration per day at full sub-second precision."""
    return as_text(demand.average_duration_by_day(event_trips(spark, sf_dir)))


QUERIES: dict[str, Query] = {
    "silver_trips": silver_trips,
    "silver_stored": silver_stored,
    "silver_unknown_weather": silver_unknown_weather,
    "distinct_rides": distinct_rides,
    "legacy_trips": legacy_trips,
    "notebook_features": notebook_features,
    "notebook_distance_summary": notebook_distance_summary,
    "excessive_distances": excessive_distances,
    "reject_funnel": lambda s, d: profile.reject_funnel(typed_trips(s, d)),
    "weather_clean": weather_clean,
    "weather_from_text": weather_from_text,
    "trip_distance_km": trip_distance_km,
    "dim_date": _dimension("dim_date"),
    "dim_member": _dimension("dim_member"),
    "dim_station": _dimension("dim_station"),
    "dim_bike_type": _dimension("dim_bike_type"),
    "dim_temperature": _dimension("dim_temperature"),
    "station_spellings": station_spellings,
    "dim_stable_two_loads": dim_stable_two_loads,
    "dim_rebuild_two_loads": dim_rebuild_two_loads,
    "fact_trips": fact_trips,
    "avg_duration_monthly": _on_trips(demand.average_duration_by_month),
    "avg_duration_daily": _on_trips(demand.average_duration_by_day),
    "station_demand_top10": _on_trips(demand.station_demand),
    "station_imbalance": _on_trips(lambda t: demand.by_imbalance(demand.station_imbalance(t))),
    "station_imbalance_category": _on_trips(
        lambda t: demand.by_imbalance(demand.classified_imbalance(t))
    ),
    "imbalance_summary": _on_trips(demand.imbalance_summary),
    "imbalance_pivot": _on_trips(demand.imbalance_pivot),
    "rides_by_month": _on_trips(demand.rides_by_month),
    "rides_by_month_label": _on_trips(demand.rides_by_month_label),
    "rides_by_hour": _on_trips(demand.rides_by_hour),
    "rides_by_daytype": _on_trips(demand.rides_by_day_type),
    "rides_by_type": _on_trips(lambda t: demand.rides_by(t, "member_casual", "rideable_type")),
    "rides_by_temp": _on_days(impact.rides_by_temperature),
    "rides_by_temp_c": _on_days(impact.rides_by_celsius),
    "rain_impact": _on_days(impact.rain_impact),
    "temp_bucket_impact": _on_days(impact.temperature_impact),
    "weather_score": _on_days(impact.impact_score),
    "kpi_totals": _on_gold(indicators.total_trips),
    "kpi_bike_type": _on_gold(indicators.trips_by_bike_type),
    "kpi_share": _on_gold(indicators.member_share),
    "kpi_distance": _on_gold(indicators.average_distance),
    "kpi_utilization": _on_gold(indicators.station_utilisation),
    "kpi_fact_imbalance": _on_gold(indicators.station_imbalance),
    "kpi_duration": _on_gold(indicators.average_duration),
    "kpi_duration_temp": _on_gold(indicators.trips_by_temperature),
    "kpi_hours": _on_gold(indicators.trips_by_hour),
    "kpi_peak_hour": _on_gold(indicators.peak_hour),
    "kpi_rush_ratio": _on_gold(lambda g: indicators.usage_ratio(g, "is_rush_hour", "rush_ratio")),
    "kpi_rush_ratio_member": _on_gold(
        lambda g: indicators.usage_ratio_by_member(g, "is_rush_hour", "rush_ratio")
    ),
    "kpi_weekend_ratio": _on_gold(lambda g: indicators.usage_ratio(g, "weekend", "weekend_ratio")),
    "kpi_weekend_ratio_member": _on_gold(
        lambda g: indicators.usage_ratio_by_member(g, "weekend", "weekend_ratio")
    ),
    "kpi_season_daily": _on_gold(indicators.daily_trips_by_season),
    "null_profile": null_profile,
    "rule_counts": rule_counts,
    "dup_rides": _on_trips(profile.duplicate_rides),
    "dup_start_slots": lambda s, d: as_text(
        profile.duplicated_ids(order_trips(s, d), "started_at")
    ),
    "time_range": _on_trips(profile.time_range),
    "range_checks": _on_days(profile.range_checks),
    "dataset_summary": _on_trips(profile.dataset_summary),
    "trip_dates": _on_trips(profile.trip_dates),
    "date_gaps": date_gaps,
    "sentinel_counts": sentinel_counts,
    "category_audit": category_audit,
    "short_long_share": _on_trips(profile.duration_shares),
    "station_concentration": _on_trips(profile.station_concentration),
    "weather_events": weather_events,
    "event_audit": event_audit,
    "joined_cast": joined_cast,
    "duration_histogram": _on_trips(profile.duration_histogram),
    "duration_histogram_full": _on_trips(
        lambda t: profile.duration_histogram(t, low=None, high=None, bins=100)
    ),
    "numeric_corr": numeric_corr,
    "station_imbalance_incremental": _on_states(states.station_imbalance),
    "station_demand_incremental": _on_states(states.station_demand),
    "rides_by_hour_incremental": _on_states(states.trips_by_hour),
    "corr_from_states": _on_states(lambda s, root: states.correlations(states.read_states(s, root, "moments"))),
    "distinct_by_sketch": distinct_by_sketch,
    "duration_quantiles_by_sketch": duration_quantiles_by_sketch,
    "describe_trips": describe_trips,
    "describe_text": describe_text,
    "dataset_shape": dataset_shape,
    "footprint": footprint,
    "rows_by_sql": rows_by_sql,
    "preview": preview,
    "csv_ingest": csv_ingest,
    "zip_ingest": zip_ingest,
    "zip_members": zip_members,
    "season_job": season_job,
    "yearly_job": yearly_job,
    "feature_table": feature_table,
    "typed_views": typed_views,
    "schema_of_orders": schema_of_orders,
    "layer_roundtrip": layer_roundtrip,
    "season_layer": season_layer,
    "missing_layer": missing_layer,
    "gold_catalog": gold_catalog,
    "catalog_drift": catalog_drift,
    "fact_unknown_members": fact_unknown_members,
    "imbalance_of_hubs": imbalance_of_hubs,
    "station_ends_colocated": station_ends_colocated,
    "silver_export": silver_export,
    "lake_compacted": lake_compacted,
    "stream_two_drops": stream_two_drops,
    "lake_two_years": lake_two_years,
    "lake_corrected_load": lake_corrected_load,
    "lake_stream_then_batch": lake_stream_then_batch,
    "lake_batch_then_stream": lake_batch_then_stream,
    "lake_moved_rides": lake_moved_rides,
    "lake_moved_rides_stream_first": lake_moved_rides_stream_first,
    "lake_late_weather": lake_late_weather,
    "dim_station_renamed": dim_station_renamed,
    "event_duration_by_day": event_duration_by_day,
}
