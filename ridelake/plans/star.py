"""Star schema: five dimensions and the trip fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake import schemas
from ridelake.functions import times
from ridelake.operators.clean import lock_schema
from ridelake.operators.lookup import left_lookup
from ridelake.operators.ordering import number_rows
from ridelake.session import materialise

UNKNOWN_KEY = -1


@dataclass(frozen=True)
class Dimension:
    """How one keyed dimension is named, keyed and defaulted."""

    name: str
    key: str
    natural: str
    schema: T.StructType
    unknown: tuple[str, ...]


# Names, keys and the texts of the unknown members.
MEMBER = Dimension("dim_member", "member_key", "member_casual", schemas.DIM_MEMBER, ("Unknown",))
STATION = Dimension(
    "dim_station", "station_key", "station_id", schemas.DIM_STATION, ("UNKNOWN", "Unknown Station")
)
BIKE_TYPE = Dimension("dim_bike_type", "bike_key", "rideable_type", schemas.DIM_BIKE_TYPE, ("Unknown",))
TEMPERATURE = Dimension(
    "dim_temperature", "temp_key", "temp_category", schemas.DIM_TEMPERATURE, ("Unknown",)
)
KEYED = (MEMBER, STATION, BIKE_TYPE, TEMPERATURE)

# The Silver columns the fact is made of.
FACT_INPUTS = (
    "ride_id", "rideable_type", "member_casual", "temp_category",
    "start_station_id", "end_station_id", "trip_date", "year", "month", "start_hour",
    "trip_distance", "trip_duration_min", "temp", "is_rush_hour", "weekend",
)


def unknown_member(spark: SparkSession, dim: Dimension) -> DataFrame:
    return spark.createDataFrame([(UNKNOWN_KEY, *dim.unknown)], dim.schema)


def date_members(silver: DataFrame) -> DataFrame:
    """``dim_date``: one row per trip date."""
    keyed = silver.withColumn("date_key", times.date_key(F.col("trip_date")))
    return lock_schema(keyed.select(*schemas.DIM_DATE.names).distinct(), schemas.DIM_DATE)


def plain_members(silver: DataFrame, dim: Dimension) -> DataFrame:
    return silver.select(dim.natural).filter(F.col(dim.natural).isNotNull()).distinct()


def station_members(silver: DataFrame, *, one_per_id: bool = True) -> DataFrame:
    """Stations seen at either end, from one pass over the trips.

    An id may carry several spellings of its name. By default it gets its most
    frequent one (the least on ties), so that ids stay unique and the fact does
    not fan out; ``one_per_id=False`` keeps every distinct pair.
    """
    ends = silver.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.col(f"{end}_station_id").alias("station_id"),
                        F.col(f"{end}_station_name").alias("station_name"),
                    )
                    for end in ("start", "end")
                ]
            )
        ).alias("at")
    ).select("at.*")
    pairs = ends.filter(F.col("station_id").isNotNull()).groupBy("station_id", "station_name").agg(
        F.count("*").alias("seen")
    )
    if not one_per_id:
        return pairs.select("station_id", "station_name")
    best = F.min(
        F.struct(
            (-F.col("seen")).alias("order"),
            F.col("station_name").isNull().alias("unnamed"),
            F.col("station_name"),
        )
    )
    return pairs.groupBy("station_id").agg(best.alias("best")).select("station_id", "best.station_name")


def members_of(silver: DataFrame, dim: Dimension) -> DataFrame:
    return station_members(silver) if dim is STATION else plain_members(silver, dim)


def new_members(new: DataFrame, existing: DataFrame, dim: Dimension) -> DataFrame | None:
    """Keyed rows for the members of ``new`` that ``existing`` lacks, None if it lacks none.

    Numbering continues after the highest key in use; members are numbered in
    the order of their natural key. A dimension without rows also gets its
    unknown member.
    """
    highest = existing.agg(F.max(dim.key).alias("key")).first()["key"]
    absent = materialise(
        new.join(existing.select(dim.natural), dim.natural, "left_anti"), f"new-{dim.name}"
    )
    if highest is not None and absent.isEmpty():
        return None
    start = max(highest or 0, 0) + 1
    added = lock_schema(number_rows(absent, [F.col(dim.natural)], dim.key, start), dim.schema)
    if highest is None:
        added = added.unionByName(unknown_member(new.sparkSession, dim))
    return added


def upsert_dimension(
    new: DataFrame, existing: DataFrame | None, dim: Dimension, *, mode: str = "stable"
) -> DataFrame:
    """The dimension after adding ``new`` to ``existing``.

    ``stable`` keeps every key ever given out, so older fact rows stay right.
    ``rebuild`` numbers all members again from 1 and suits only a single load.
    Either way the unknown member appears once, under key -1.
    """
    spark = new.sparkSession
    if existing is None:
        existing = spark.createDataFrame([], dim.schema)
    if mode == "stable":
        added = new_members(new, existing, dim)
        return existing if added is None else existing.unionByName(added)
    if mode != "rebuild":
        raise ValueError(f"unknown mode {mode!r}")
    earlier = existing.filter(F.col(dim.key) != UNKNOWN_KEY).drop(dim.key)
    if dim is STATION:
        # Several spellings may be asked for; an id already present keeps its rows.
        fresh = new.join(earlier.select(dim.natural).distinct(), dim.natural, "left_anti")
        members, order = earlier.unionByName(fresh), [F.col(dim.natural), F.col("station_name")]
    else:
        members, order = earlier.unionByName(new).distinct(), [F.col(dim.natural)]
    return lock_schema(number_rows(members, order, dim.key), dim.schema).unionByName(
        unknown_member(spark, dim)
    )


def build_dimensions(
    silver: DataFrame, existing: dict[str, DataFrame] | None = None, mode: str = "stable"
) -> dict[str, DataFrame]:
    """All five dimensions over a stored Silver table."""
    existing = existing or {}
    built = {
        dim.name: upsert_dimension(members_of(silver, dim), existing.get(dim.name), dim, mode=mode)
        for dim in KEYED
    }
    return {"dim_date": date_members(silver), **built}


def build_fact(silver: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """One row per Silver row, with dimension keys in place of the texts.

    Pass stored dimensions marked by ``operators.lookup.sized``. The station
    dimension is looked up in two roles; a text without a member gets key -1.
    """
    facts = silver.withColumns(
        {"date_key": times.date_key(F.col("trip_date")), "temperature": F.col("temp")}
    )
    keys = []
    for dim in (MEMBER, BIKE_TYPE, TEMPERATURE):
        facts = left_lookup(facts, dimensions[dim.name].select(dim.natural, dim.key), dim.natural)
        keys.append(dim.key)
    for role in ("start", "end"):
        named = dimensions[STATION.name].select(
            F.col(STATION.natural).alias(f"{role}_station_id"),
            F.col(STATION.key).alias(f"{role}_station_key"),
        )
        facts = left_lookup(facts, named, f"{role}_station_id")
        keys.append(f"{role}_station_key")
    resolved = {k: F.coalesce(F.col(k), F.lit(UNKNOWN_KEY).cast("bigint")) for k in keys}
    return lock_schema(facts.withColumns(resolved), schemas.FACT_TRIPS)
