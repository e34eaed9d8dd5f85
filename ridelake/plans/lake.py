"""Batch jobs: raw files to Silver, Silver to Gold."""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake import paths, schemas
from ridelake.operators.clean import cast_trips, require_columns
from ridelake.operators.lookup import fits, sized
from ridelake.operators.membership import build_filters, possible
from ridelake.plans.silver import build_silver
from ridelake.plans.star import (
    FACT_INPUTS,
    KEYED,
    STATION,
    Dimension,
    build_fact,
    date_members,
    members_of,
    new_members,
    station_members,
    upsert_dimension,
)
from ridelake.rules import SILVER, RuleSet
from ridelake.session import materialise, scratch, together
from ridelake.sinks.catalog import GOLD_TABLES
from ridelake.sinks.files import FILE_BYTES, Held, listed, placed, untidy
from ridelake.sinks.layers import append_rows, drop_partitions, refresh, write_layer, write_partitioned
from ridelake.sinks.versions import Publication, VersionedTables
from ridelake.sources.layout import Layout
from ridelake.sources.tables import read_or_empty
from ridelake.sources.trips import read_trips
from ridelake.sources.weather import load_weather

BY_MONTH = ["year", "month"]
# The Silver load that streamed rows are stored under.
ARRIVALS = "arrivals"
_MONTHS = "year int, month int"
SLACK = 4  # files a batch load may leave for each one that its bytes fill
FILTER_FILES = 8  # at most, that one write of filters adds


def write_silver(
    trips: DataFrame,
    daily: DataFrame,
    root: str,
    load: str,
    rules: RuleSet = SILVER,
    holiday_years: Iterable[int] | None = None,
    *,
    clustered: bool = False,
) -> None:
    """Replace all Silver rows that an earlier run of the same ``load`` wrote.

    A load, such as the files of one year, may hold a few trips of a month that
    mostly belongs to another load. Loads are stored apart, so writing one never
    takes rows from another, except from the arrivals: a ride that a batch load
    delivers supersedes its streamed copy, whichever came first. The months
    that changed, those that lost all rows among them, are noted for Gold.
    """
    spark, layout = trips.sparkSession, Layout(root)

    def months() -> set[tuple[int, int]]:
        return set(months_of(read_or_empty(spark, layout.silver(load), schemas.SILVER)))

    silver = build_silver(trips, daily, rules, holiday_years)
    touched = months()
    note_changes(spark, root, load, touched)
    # a load without filters is looked through, so a stop before they are written again loses nothing
    paths.remove(spark, layout.ride_ids(load))
    write_partitioned(silver, layout.silver(load), BY_MONTH, dynamic=False, clustered=clustered)
    refresh(spark, layout.silver(load))
    note_rides(read_or_empty(spark, layout.silver(load), schemas.SILVER), root, load)
    note_changes(spark, root, load, months() - touched)
    if load != ARRIVALS:
        supersede_arrivals(spark, root, load)


def note_changes(spark: SparkSession, root: str, load: str | None, months: set[tuple[int, int]]) -> None:
    """Note months for the monthly states and, with a ``load``, for the run that carries it to Gold."""
    if months:
        rows = spark.createDataFrame(sorted(months), _MONTHS).coalesce(1)
        append_rows(rows, Layout(root).state_changes)
        if load is not None:
            append_rows(rows, Layout(root).changes(load))


def note_rides(rows: DataFrame, root: str, load: str) -> None:
    """Add filters over the ride ids of ``rows`` to those of ``load``."""
    path = Layout(root).ride_ids(load)
    # stored first, as few files would be few tasks for all of the work
    filters = materialise(build_filters(rows.select(*BY_MONTH, "ride_id"), BY_MONTH, "ride_id"), "filters")
    append_rows(filters.coalesce(FILTER_FILES), path)
    refresh(rows.sparkSession, Layout(root).ride_ids())


def stored_rides(spark: SparkSession, root: str, loads: list[str], months: list[tuple[int, int]] | None = None) -> DataFrame:
    """(load, year, month, ride_id) as Silver stores them, of some loads and, if given, months."""
    stored = read_or_empty(spark, Layout(root).silver(), schemas.SILVER_STORED).filter(F.col("load").isin(*loads))
    return (stored if months is None else stored.filter(in_months(months))).select("load", *BY_MONTH, "ride_id")


def held_rides(ids: DataFrame, root: str) -> DataFrame | None:
    """(ride_id, year, month) of those of the stored ``ids`` that Silver holds, in whatever load; None if no stored id had to be read.

    Ids are read of the months only whose filters may hold one; a load that has no filters is read whole.
    """
    spark, layout = ids.sparkSession, Layout(root)
    loads = [c.split("=", 1)[1] for c in paths.children(spark, layout.silver()) if c.startswith("load=")]
    filtered = {c.split("=", 1)[1] for c in paths.children(spark, layout.ride_ids()) if c.startswith("load=")}
    parts = []
    if plain := [load for load in loads if load not in filtered]:
        parts.append(stored_rides(spark, root, plain).join(sized(ids), "ride_id", "left_semi"))
    if filtered:
        filters = read_or_empty(spark, layout.ride_ids(), schemas.RIDE_FILTERS)
        maybe = materialise(possible(ids, filters, [*BY_MONTH, "load"], "ride_id"), "possible-rides")
        where = [tuple(r) for r in maybe.select("load", *BY_MONTH).distinct().collect()]  # at most one for each stored month
        if where:
            stored = stored_rides(spark, root, sorted({w[0] for w in where}), sorted({w[1:] for w in where}))
            parts.append(stored.join(sized(maybe), ["load", *BY_MONTH, "ride_id"], "left_semi"))
    if not parts:
        return None
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return materialise(found.select("ride_id", *BY_MONTH).distinct(), "held-rides")


def supersede_arrivals(spark: SparkSession, root: str, load: str) -> set[tuple[int, int]]:
    """Drop the arrivals that ``load`` holds too; returns the months they were in.

    The arrivals' ids are measured and, if small, sent to the load's scan, so
    that neither side is shuffled.
    """
    layout = Layout(root)
    stored = read_or_empty(spark, layout.silver(ARRIVALS), schemas.SILVER)
    ids = materialise(stored.select(*BY_MONTH, "ride_id"), "arrival-ids")
    delivered = spark.read.schema(schemas.SILVER).parquet(layout.silver(load)).select("ride_id")
    held = delivered.join(sized(ids.select("ride_id").distinct()), "ride_id", "left_semi").distinct()
    gone = materialise(ids.join(held, "ride_id", "left_semi"), "superseded")
    months = months_of(gone)
    if months:
        note_changes(spark, root, load, set(months))
        kept = stored.filter(in_months(months)).join(sized(gone.select("ride_id")), "ride_id", "left_anti")
        staged = materialise(kept, "arrivals-kept")
        write_partitioned(staged, layout.silver(ARRIVALS), BY_MONTH)
        drop_partitions(spark, layout.silver(ARRIVALS), BY_MONTH, sorted(set(months) - set(months_of(staged))))
        refresh(spark, layout.silver(ARRIVALS))
    return set(months)


def read_silver(spark: SparkSession, root: str, loads: Iterable[str] | None = None) -> DataFrame:
    stored = spark.read.schema(schemas.SILVER_STORED).parquet(Layout(root).silver())
    if loads is not None:
        stored = stored.filter(F.col("load").isin(*loads))
    return stored.select(*schemas.SILVER.names)


def months_of(silver: DataFrame) -> list[tuple[int, int]]:
    """The months present: one small row for each stored partition."""
    return [(r.year, r.month) for r in silver.select(*BY_MONTH).distinct().collect()]


def in_months(months: list[tuple[int, int]]) -> Column:
    """A filter on the partition columns, so that other months are not read."""
    if not months:
        return F.lit(False)
    years = [year for year, _ in months]
    number = F.col("year") * 100 + F.col("month")
    return F.col("year").between(min(years), max(years)) & number.isin([y * 100 + m for y, m in months])


def gold_tables(spark: SparkSession, root: str) -> VersionedTables:
    layout = Layout(root)
    folders = {name: layout.fact if name == "fact_trips" else layout.dimension(name) for name in GOLD_TABLES}
    return VersionedTables(spark, layout.gold, GOLD_TABLES, folders)


def read_gold(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The fact and all dimensions of one version, the last by default."""
    tables = gold_tables(spark, root)
    one = tables.version(version)
    return {name: tables.read(name, one) for name in [*[dim.name for dim in KEYED], "dim_date", "fact_trips"]}


def raw_to_silver(
    spark: SparkSession,
    root: str,
    year: int,
    rules: RuleSet = SILVER,
    weather_date_format: str = "dd-MM-yyyy",
    file_bytes: int = FILE_BYTES,
) -> None:
    """One year of raw CSV below ``root`` into the Silver layer.

    Raw files should hold one month each; a scan task reads from one file, so the
    rows are written where they are read, without a shuffle. What that leaves is
    listed: a month with over ``SLACK`` times the files it fills, as when one raw
    file holds a whole year, is written again, placed by size. A run stopped meanwhile is to be repeated.
    """
    layout = Layout(root)
    trips = cast_trips(read_trips(spark, layout.raw_trips(year)))
    daily = load_weather(spark, layout.raw_weather(year), weather_date_format)
    with scratch(spark):
        weather = sized(materialise(daily, "weather"))
        write_silver(trips, weather, root, str(year), rules, [year], clustered=True)
        tidy_silver(spark, root, str(year), file_bytes=file_bytes, slack=SLACK)


def grow_dimension(silver: DataFrame, gold: Publication, dim: Dimension) -> None:
    """Add the members that ``silver`` brings; stored rows are never rewritten.

    Safe to repeat: a second run finds nothing new.
    """
    added = new_members(members_of(silver, dim), gold.read(dim.name), dim)
    if added is not None:
        gold.add(dim.name, added)


def rebuild_dimension(silver: DataFrame, gold: Publication, dim: Dimension) -> None:
    """Number all members again; only right when the whole fact is rewritten too."""
    gold.replace(dim.name, upsert_dimension(members_of(silver, dim), gold.read(dim.name), dim, mode="rebuild"))


def stored_dimensions(spark: SparkSession, gold: Publication | VersionedTables) -> tuple[dict[str, DataFrame], bool]:
    """The keyed dimensions as lookup sides, and whether all of them are broadcast."""
    stored = {dim.name: gold.read(dim.name) for dim in KEYED}
    small = dict(zip(stored, together(spark, *[partial(fits, table) for table in stored.values()])))
    marked = {name: F.broadcast(t) if small[name] else t for name, t in stored.items()}
    return marked, all(small.values())


def silver_to_gold(
    spark: SparkSession,
    root: str,
    loads: Iterable[str] | None = None,
    mode: str = "stable",
) -> dict[str, int]:
    """Dimensions and fact from the Silver layer, whole or for what some loads touched.

    Every month that one of ``loads`` has rows in, or had before it was written
    again, is replaced in the fact and in ``dim_date``, from the rows of all
    loads; a month without rows is removed. A whole run replaces all months. All tables
    change at once, when the run publishes them. The ``rebuild`` mode changes keys and therefore needs a whole run. Returns the
    row counts going in and coming out, which differ only if a dimension is not
    unique; ``stored_counts`` tells what the fact then holds.
    """
    if mode == "rebuild" and loads is not None:
        raise ValueError("rebuild changes the keys of all months; run it without loads")
    with scratch(spark):
        return _to_gold(spark, root, None if loads is None else list(loads), mode)


def _to_gold(spark: SparkSession, root: str, loads: list[str] | None, mode: str) -> dict[str, int]:
    silver = require_columns(read_silver(spark, root), ["temp"])
    months: list[tuple[int, int]] = []
    if loads is not None:
        noted = read_or_empty(spark, Layout(root).changes(), T.StructType.fromDDL(f"{_MONTHS}, load string"))
        changed = months_of(noted.filter(F.col("load").isin(*loads)))
        months = sorted({*months_of(read_silver(spark, root, loads)), *changed})
        silver = silver.filter(in_months(months))
    update = {"stable": grow_dimension, "rebuild": rebuild_dimension}[mode]
    gold = gold_tables(spark, root).begin()
    replaced = None if loads is None else months
    together(
        spark,
        *[partial(update, silver, gold, dim) for dim in KEYED],
        lambda: gold.replace("dim_date", date_members(silver), replaced),
    )
    dimensions, all_broadcast = stored_dimensions(spark, gold)
    rows_in, rows_out = Observation("silver_rows"), Observation("fact_rows")
    # The observation counts what the scan delivers, so it comes after the
    # projection: columns are not pruned through it.
    counted = silver.select(*FACT_INPUTS).observe(rows_in, F.count(F.lit(1)).alias("n"))
    fact = build_fact(counted, dimensions).observe(rows_out, F.count(F.lit(1)).alias("n"))
    # Silver is stored by month. As long as no lookup shuffles, its scan tasks
    # still hold one month each when the fact is written.
    gold.replace("fact_trips", fact, replaced, clustered=all_broadcast)
    counts_now = {"silver_rows": rows_in.get["n"], "fact_rows": rows_out.get["n"]}
    gold.publish()
    for load in [None] if loads is None else loads:
        paths.remove(spark, Layout(root).changes(load))
    return counts_now


def stored_counts(spark: SparkSession, root: str) -> DataFrame:
    """(year, month, fact_rows, silver_rows) as stored; they differ where Gold has not followed Silver."""
    facts = gold_tables(spark, root).read("fact_trips").groupBy(*BY_MONTH).agg(F.count(F.lit(1)).alias("fact_rows"))
    silver = read_silver(spark, root).groupBy(*BY_MONTH).agg(F.count(F.lit(1)).alias("silver_rows"))
    return facts.join(silver, BY_MONTH, "full").na.fill(0, ["fact_rows", "silver_rows"])


def rename_stations(spark: SparkSession, root: str) -> None:
    """Give every station its most frequent name over all Silver loads; keys stay.

    Loads only add stations, under the most frequent name of the load that
    brings them. This reads three columns of the whole of Silver, so it is a
    job of its own.
    """
    gold = gold_tables(spark, root).begin()
    with scratch(spark):
        names = materialise(station_members(read_silver(spark, root)), "station-names")
        stored = gold.read(STATION.name)
        named = stored.join(names.withColumnRenamed("station_name", "now"), STATION.natural, "left")
        known = F.coalesce("now", "station_name").alias("station_name")
        gold.replace(STATION.name, named.select(*[known if c == "station_name" else c for c in stored.columns]))
        gold.publish()


def refresh_weather(spark: SparkSession, root: str, daily: DataFrame, rules: RuleSet = SILVER) -> list[tuple[int, int]]:
    """Join the weather again to arrivals that were stored before their weather, and carry them to Gold.

    Only the months that hold such rides on a day that ``daily`` (stored, one row
    per date) now has are rewritten; they are returned.
    """
    path = Layout(root).silver(ARRIVALS)
    with scratch(spark):
        stored = read_or_empty(spark, path, schemas.SILVER)
        late = stored.filter(F.col("temp").isNull()).join(sized(daily.select("trip_date")), "trip_date", "left_semi")
        months = months_of(late)
        if months:
            note_changes(spark, root, ARRIVALS, set(months))
            trips = stored.filter(in_months(months)).select(*schemas.TYPED_TRIPS.names)
            again = materialise(build_silver(trips, sized(daily), rules), "weather-again")
            write_partitioned(again, path, BY_MONTH)
            refresh(spark, Layout(root).silver())
    if months:
        silver_to_gold(spark, root, [ARRIVALS])
    return months


def tidy_silver(
    spark: SparkSession,
    root: str,
    load: str,
    months: list[tuple[int, int]] | None = None,
    file_bytes: int = FILE_BYTES,
    slack: float = 1,
) -> list[tuple[int, int]]:
    """Rewrite the months of a load whose files are too many or too large for their bytes; returns them.

    Sizes come from the store's listing, so a tidy load costs no read. The rows stay the same and nothing has to follow.
    """
    path = Layout(root).silver(load)
    held = _of_months(listed(spark, path, BY_MONTH), months)
    bad = untidy(held, file_bytes, slack)
    found = sorted((int(year), int(month)) for year, month in bad)
    if found:
        rows = materialise(read_or_empty(spark, path, schemas.SILVER).filter(in_months(found)), "tidy")
        write_partitioned(placed(rows, BY_MONTH, bad, file_bytes), path, BY_MONTH, clustered=True)
        refresh(spark, Layout(root).silver())
    return found


def _of_months(held: dict, months: list[tuple[int, int]] | None) -> dict:
    return held if months is None else {k: h for k, h in held.items() if (int(k[0]), int(k[1])) in set(months)}


def compact(
    spark: SparkSession,
    root: str,
    months: list[tuple[int, int]] | None = None,
    file_bytes: int = FILE_BYTES,
    slack: float = 1,
) -> dict[str, list[tuple[int, int]]]:
    """Give the months of every load and of the fact as many files as their bytes fill; returns what was rewritten.

    Every streamed batch appends a file per month, and a batch load whose raw
    files mix months leaves one for each task and month. Months that are well packed stay as they are.
    """
    layout, tables = Layout(root), gold_tables(spark, root)
    loads = [c.split("=", 1)[1] for c in paths.children(spark, layout.silver()) if c.startswith("load=")]
    with scratch(spark):
        done = {load: tidy_silver(spark, root, load, months, file_bytes, slack) for load in loads}
        gold = tables.begin()
        stored = gold.now.tables.get("fact_trips", [])
        bad = untidy(_of_months(listed(spark, layout.fact, BY_MONTH, stored), months), file_bytes, slack)
        done["fact_trips"] = sorted((int(year), int(month)) for year, month in bad)
        if bad:
            rows = gold.read("fact_trips").filter(in_months(done["fact_trips"]))
            gold.replace("fact_trips", placed(rows, BY_MONTH, bad, file_bytes), done["fact_trips"], clustered=True)
            gold.publish()
    return done


def export_silver(spark: SparkSession, root: str, path: str, loads: Iterable[str] | None = None, file_bytes: int = FILE_BYTES) -> int:
    """Silver as one table without partitions, in at most as many files as its listed bytes fill; returns that bound.

    Scan tasks are merged, not shuffled, so each file holds neighbouring months.
    """
    layout = Layout(root)
    named = [c.split("=", 1)[1] for c in paths.children(spark, layout.silver()) if c.startswith("load=")] if loads is None else list(loads)
    size = sum(paths.usage(spark, layout.silver(load))[1] for load in named)
    most = Held(bytes=size).wanted(file_bytes)
    write_layer(read_silver(spark, root, named), path, max_files=most)
    return most
