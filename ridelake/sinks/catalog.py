"""Registration of stored layers as external catalog tables."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ridelake import paths, schemas
from ridelake.sinks.versions import WRITE, VersionedTables
from ridelake.sources.layout import Layout

GOLD_TABLES: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "dim_date": (schemas.DIM_DATE, ("year", "month")),
    "dim_member": (schemas.DIM_MEMBER, ()),
    "dim_station": (schemas.DIM_STATION, ()),
    "dim_bike_type": (schemas.DIM_BIKE_TYPE, ()),
    "dim_temperature": (schemas.DIM_TEMPERATURE, ()),
    "fact_trips": (schemas.FACT_TRIPS, ("year", "month")),
}


_RETIRED = "ridelake.retired"


def _plain(location: str) -> str:
    return location.removeprefix("file:").rstrip("/").replace("//", "/")


@dataclass(frozen=True)
class Drift:
    """What a registration changed in a table's columns."""

    added: list[str] = field(default_factory=list)
    widened: list[str] = field(default_factory=list)
    retired: list[str] = field(default_factory=list)
    restored: list[str] = field(default_factory=list)


# Types that may be read as any later one of their row, without loss.
_WIDENINGS = (
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()),
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.DoubleType()),
    (T.FloatType(), T.DoubleType()),
    (T.DateType(), T.TimestampNTZType()),
)


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds the values of both, None if there is none."""
    if a == b:
        return a
    for chain in _WIDENINGS:
        if a in chain and b in chain:
            return max(a, b, key=chain.index)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        precision = scale + max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(precision, scale) if precision <= 38 else None
    return None


def merged(table: str, known: T.StructType, found: T.StructType) -> T.StructType:
    """``known`` with its types widened to those of ``found`` and the further columns of ``found`` behind."""
    types = {f.name: f.dataType for f in known}
    both = {f.name: wider(types[f.name], f.dataType) for f in found if f.name in types}
    if bad := [f"{f.name}: {types[f.name].simpleString()} is not {f.dataType.simpleString()}" for f in found if f.name in both and both[f.name] is None]:
        raise ValueError(f"{table} differs from its declaration: {'; '.join(bad)}")
    kept = [T.StructField(f.name, both.get(f.name, f.dataType)) for f in known]
    return T.StructType([*kept, *[T.StructField(f.name, f.dataType) for f in found if f.name not in types]])


def retired_columns(spark: SparkSession, table: str) -> list[str]:
    """Columns that the last registration did not find any more; older partitions still have them."""
    noted = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return json.loads(noted.get(_RETIRED, "[]"))


def _create(spark: SparkSession, table: str, location: str, schema: T.StructType, partitions: tuple[str, ...], retired: list[str]) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{by} LOCATION '{location}' TBLPROPERTIES ('{_RETIRED}' = '{json.dumps(retired)}')")


def evolve(
    spark: SparkSession,
    table: str,
    location: str,
    schema: T.StructType,
    partitions: tuple[str, ...] = (),
    live: list[str] | None = None,
) -> Drift:
    """Create an external table or let it follow ``schema``: the data's columns now, with those of ``partitions``.

    New columns are added, NULL in older partitions. A type that grew is widened; files keep
    theirs and are read as the wider one. A column that is gone stays, for the partitions that have
    it, and is noted as retired until it comes back. A type that does not hold both is an error, and nothing changes.

    Its partitions are those found at the location or, if given, the ``live`` ones among them.
    A registration for another location is replaced; the data stays where it is.
    """
    staged = f"{table}__evolving"
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(staged):
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    if spark.catalog.tableExists(table):
        detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        if _plain(detail.get("Location", "")) != _plain(location):
            spark.sql(f"DROP TABLE {table}")
    _create(spark, table, location, schema, partitions, [])
    stored = spark.table(table).schema
    target = merged(table, stored, schema)
    before = set(retired_columns(spark, table))
    gone = [f.name for f in stored if f.name not in schema.names]
    drift = Drift(
        [f.name for f in target if f.name not in stored.names],
        [f"{f.name}: {f.dataType.simpleString()} to {target[f.name].dataType.simpleString()}" for f in stored if target[f.name].dataType != f.dataType],
        [c for c in gone if c not in before],
        [c for c in stored.names if c in before and c not in gone],
    )
    if drift.widened:
        # complete beside the old one, and found above if this is cut off between the two statements
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        last = [target[c] for c in partitions]
        _create(spark, staged, location, T.StructType([*[f for f in target if f.name not in partitions], *last]), partitions, gone)
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    elif drift.added:
        new = ", ".join(f"`{c}` {target[c].dataType.simpleString()}" for c in drift.added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({new})")
    if (drift.retired or drift.restored) and not drift.widened:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_RETIRED}' = '{json.dumps(gone)}')")
    if partitions and live is None:
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    elif partitions:
        _follow(spark, table, live)
    spark.catalog.refreshTable(table)
    return drift


def register(
    spark: SparkSession,
    table: str,
    location: str,
    schema: T.StructType,
    partitions: tuple[str, ...] = (),
    live: list[str] | None = None,
) -> list[str]:
    """``evolve`` a table to its declared ``schema``; returns the columns it had to add."""
    return evolve(spark, table, location, schema, partitions, live).added


def stored_schema(spark: SparkSession, table: str, directories: list[str]) -> T.StructType:
    """The columns of the files in some directories, under types that hold all of them.

    Spark merges the footers of directories that agree in one job; only where they do not
    is the list halved, so a few generations of files take a few jobs each.
    """
    try:
        return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*directories).schema
    except Exception as e:
        if len(directories) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
    half = len(directories) // 2
    return merged(table, stored_schema(spark, table, directories[:half]), stored_schema(spark, table, directories[half:]))


def crawl(spark: SparkSession, table: str, location: str, partitions: T.StructType = T.StructType()) -> Drift:
    """Let a table follow whatever its location holds by now: partitions, and columns as the files have them.

    Only footers of partitions that the table does not know yet are read. Their columns are the table's; see ``evolve``.
    """
    by = tuple(partitions.names)
    found = paths.leaves(spark, location, len(by))
    there = spark.catalog.tableExists(table)
    known = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()} if there and by else set()
    new = [f"{location}/{d}" for d in found if d not in known]
    if new:
        columns = stored_schema(spark, table, new)
    elif there:
        retired = retired_columns(spark, table)
        columns = T.StructType([f for f in spark.table(table).schema if f.name not in (*by, *retired)])
    else:
        raise ValueError(f"nothing to register at {location}")
    return evolve(spark, table, location, T.StructType([*columns, *partitions]), by)


def _follow(spark: SparkSession, table: str, live: list[str]) -> None:
    """Make the table's partitions the ``live`` ones, in two statements."""
    have = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}

    def named(specs: list[str]) -> list[str]:
        return ["PARTITION (" + ", ".join(f"{c} = '{v}'" for c, v in (part.split("=", 1) for part in s.split("/"))) + ")" for s in specs]

    if new := named(sorted(set(live) - have)):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(new)}")
    if old := named(sorted(have - set(live))):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(old)}")


def register_gold(spark: SparkSession, database: str, tables: VersionedTables) -> dict[str, list[str]]:
    """Register the five dimensions and the fact as the last version has them; ``write`` is a further partition column.

    The catalog's tables change one after the other; who needs one version of all reads ``lake.read_gold``.
    """
    version = tables.version()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    report = {}
    for name, (schema, by) in GOLD_TABLES.items():
        columns = T.StructType([*[f for f in schema if f.name not in by], T.StructField(WRITE, T.StringType()), *[f for f in schema if f.name in by]])
        report[name] = register(spark, f"{database}.{name}", tables.folders[name], columns, (WRITE, *by), version.tables.get(name, []))
    return report


def register_silver(spark: SparkSession, database: str, root: str) -> list[str]:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    return register(
        spark,
        f"{database}.silver_trips",
        Layout(root).silver(),
        schemas.SILVER_STORED,
        ("load", "year", "month"),
    )
