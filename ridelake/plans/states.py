"""Monthly states: what indicators need of a month, kept beside Silver, so that a load reads its own months again and no others.

Every write of Silver notes the months it touches. ``refresh_states`` reads those months once for each table of states and
replaces their partitions; indicators then read states only, a few rows a month however many trips it has:

* ``flows``: departures and arrivals by station, ``hours``: trips by hour; both exact.
* ``sketches``: distinct rides and start points (HyperLogLog), and the durations' distribution (KLL). Sketches of months merge into
  one of all, with the error of one.
* ``moments``: for every pair of columns count, means and centred sums of squares and products over the rows that have both; they
  merge into those of all months, and so into correlations, without another look at the trips.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake import paths
from ridelake.plans.lake import BY_MONTH, in_months, months_of, read_silver
from ridelake.session import together
from ridelake.sinks.layers import drop_partitions, refresh, write_partitioned
from ridelake.sources.layout import Layout
from ridelake.sources.tables import read_or_empty

LG_K = 14  # HyperLogLog: 2 ** 14 buckets
DISTINCT_ERROR = 1.04 / math.sqrt(2**LG_K)  # relative standard error, 0.8 %
KLL_K = 800  # KLL: size of a level
RANK_ERROR = 0.005  # of KLL at this size, in shares of all values, 99 % sure
MOMENT_COLUMNS = ("trip_duration_min", "trip_distance", "start_hour", "temp", "prcp", "wdsp")


def flows(silver: DataFrame) -> DataFrame:
    ends = F.array(
        F.struct(F.col("start_station_id").alias("station_id"), F.lit(1).alias("departs")),
        F.struct(F.col("end_station_id").alias("station_id"), F.lit(0).alias("departs")),
    )
    moves = silver.select(*BY_MONTH, F.explode(ends).alias("move")).select(*BY_MONTH, "move.*")
    return moves.groupBy(*BY_MONTH, "station_id").agg(
        F.sum(1 - F.col("departs")).cast("bigint").alias("arrivals"), F.sum("departs").cast("bigint").alias("departures")
    )


def hours(silver: DataFrame) -> DataFrame:
    return silver.groupBy(*BY_MONTH, "start_hour").agg(F.count(F.lit(1)).alias("trips"))


def sketches(silver: DataFrame) -> DataFrame:
    point = F.when(F.col("start_lat").isNotNull() & F.col("start_lng").isNotNull(), F.xxhash64("start_lat", "start_lng"))
    return silver.groupBy(*BY_MONTH).agg(
        F.count(F.lit(1)).alias("trips"),
        F.hll_sketch_agg("ride_id", F.lit(LG_K)).alias("rides"),
        F.hll_sketch_agg(point, F.lit(LG_K)).alias("points"),
        F.kll_sketch_agg_double("trip_duration_min", F.lit(KLL_K)).alias("durations"),
        F.min("trip_duration_min").alias("shortest"),
        F.max("trip_duration_min").alias("longest"),
    )


def _pairs(columns: list[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[i:]]


def moments(silver: DataFrame, columns: list[str] | tuple[str, ...] = MOMENT_COLUMNS, by: list[str] | None = None) -> DataFrame:
    """(*by, x, y, n, mean_x, mean_y, sxx, syy, sxy) of every pair of columns over the rows that have both, in one scan."""
    by = BY_MONTH if by is None else by
    pairs = _pairs(list(columns))
    numbers = silver.select(*by, *[F.col(c).cast("double").alias(f"_{c}") for c in columns])
    # a row for each pair: six aggregates are compiled, where six for every pair in one row would be interpreted
    each = F.array(*[F.struct(F.lit(k).alias("_pair"), F.col(f"_{a}").alias("_left"), F.col(f"_{b}").alias("_right")) for k, (a, b) in enumerate(pairs)])
    parts = {"n": F.regr_count, "mean_x": F.regr_avgx, "mean_y": F.regr_avgy, "sxx": F.regr_sxx, "syy": F.regr_syy, "sxy": F.regr_sxy}
    states = numbers.select(*by, F.inline(each)).groupBy(*by, "_pair").agg(*[f("_right", "_left").alias(name) for name, f in parts.items()])
    named = [F.get(F.array(*[F.lit(pair[side]) for pair in pairs]), F.col("_pair")).alias(name) for side, name in enumerate("xy")]
    return states.select(*by, *named, *parts)


def merged_moments(states: DataFrame, by: list[str]) -> DataFrame:
    """One state for each of ``by`` (x and y among them) from those of disjoint rows."""
    n = F.sum("n").over(Window.partitionBy(*by))
    centre = lambda c: F.sum(F.col("n") * F.col(c)).over(Window.partitionBy(*by)) / n
    # each state's own centre lies apart from the common one; a month without rows has none
    there = states.where("n > 0").withColumns({"centre_x": centre("mean_x"), "centre_y": centre("mean_y")})
    dx, dy = F.col("mean_x") - F.col("centre_x"), F.col("mean_y") - F.col("centre_y")
    return there.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.first("centre_x").alias("mean_x"),
        F.first("centre_y").alias("mean_y"),
        F.sum(F.col("sxx") + F.col("n") * dx * dx).alias("sxx"),
        F.sum(F.col("syy") + F.col("n") * dy * dy).alias("syy"),
        F.sum(F.col("sxy") + F.col("n") * dx * dy).alias("sxy"),
    )


STATES: dict[str, Callable[[DataFrame], DataFrame]] = {"flows": flows, "hours": hours, "sketches": sketches, "moments": moments}
_SCHEMAS = {
    "flows": "year int, month int, station_id string, arrivals bigint, departures bigint",
    "hours": "year int, month int, start_hour int, trips bigint",
    "sketches": "year int, month int, trips bigint, rides binary, points binary, durations binary, shortest double, longest double",
    "moments": "year int, month int, x string, y string, n bigint, mean_x double, mean_y double, sxx double, syy double, sxy double",
}


def read_states(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_or_empty(spark, Layout(root).states(name), T.StructType.fromDDL(_SCHEMAS[name]))


def refresh_states(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    """Bring the states up to what Silver holds; returns the months that were read.

    These are the noted ones, or all of Silver's where no states are stored yet. What was noted is struck off after all
    states are written, so a stop in between repeats the work and loses nothing.
    """
    layout = Layout(root)
    notes = [f"{layout.state_changes}/{c}" for c in paths.children(spark, layout.state_changes) if c.endswith(".parquet")]
    silver = read_silver(spark, root)
    if paths.exists(spark, layout.states()):
        months = months_of(spark.read.schema("year int, month int").parquet(*notes)) if notes else []
    else:
        months = months_of(silver)
    if months:
        rows = silver.where(in_months(months))

        def replace(name: str) -> None:
            path = layout.states(name)
            write_partitioned(STATES[name](rows), path, BY_MONTH)
            drop_partitions(spark, path, BY_MONTH, sorted(set(months) - set(months_of(rows))))
            refresh(spark, path)

        together(spark, *[partial(replace, name) for name in STATES])
    for note in notes:
        paths.remove(spark, note)
    return sorted(months)


def _label() -> Column:
    return F.format_string("%04d-%02d", "year", "month").alias("month")


def station_imbalance(spark: SparkSession, root: str) -> DataFrame:
    """(month, station_id, inflow, outflow, imbalance_index) of every month."""
    rows = read_states(spark, root, "flows").where("station_id is not null")
    return rows.select(_label(), "station_id", F.col("arrivals").alias("inflow"), F.col("departures").alias("outflow"), (F.col("arrivals") - F.col("departures")).alias("imbalance_index"))


def station_demand(spark: SparkSession, root: str, top: int = 10) -> DataFrame:
    """The ``top`` start stations of every month, ties to the lesser station id."""
    busiest = Window.partitionBy(*BY_MONTH).orderBy(F.desc("departures"), "station_id")
    best = read_states(spark, root, "flows").where("departures > 0 and station_id is not null").withColumn("rank", F.row_number().over(busiest)).where(F.col("rank") <= top)
    return best.select(_label(), "station_id", F.col("departures").alias("trips"))


def trips_by_hour(spark: SparkSession, root: str) -> DataFrame:
    return read_states(spark, root, "hours").groupBy("start_hour").agg(F.sum("trips").alias("trips"))


def distinct_estimates(spark: SparkSession, root: str, by: list[str] | None = None) -> DataFrame:
    """(*by, trips, rides, points): estimates of distinct rides and start points; of all months together without ``by``."""
    estimate = lambda c: F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c)
    return read_states(spark, root, "sketches").groupBy(*(by or [])).agg(F.sum("trips").alias("trips"), estimate("rides"), estimate("points"))


def duration_quantiles(spark: SparkSession, root: str, shares: tuple[float, ...]) -> DataFrame:
    """(share, minutes): the duration that the share of all trips does not exceed, to ``RANK_ERROR`` of rank."""
    whole = read_states(spark, root, "sketches").agg(F.kll_merge_agg_double("durations").alias("all"))
    each = F.array(*[F.struct(F.lit(s).alias("share"), F.kll_sketch_get_quantile_double("all", F.lit(s)).alias("minutes")) for s in shares])
    return whole.select(F.inline(each))


def duration_histogram(spark: SparkSession, root: str, bins: int) -> DataFrame:
    """(bin, from_minute, share) over equal bins from the shortest to the longest trip; shares to twice ``RANK_ERROR``."""
    whole = read_states(spark, root, "sketches").agg(
        F.kll_merge_agg_double("durations").alias("all"), F.min("shortest").alias("low"), F.max("longest").alias("high")
    )
    ends = whole.select("low", "high").first()  # two numbers; ranks are asked for constants only
    if ends["low"] is None:
        return spark.createDataFrame([], "bin int, from_minute double, share double")
    edges = [ends["low"] + (ends["high"] - ends["low"]) * k / bins for k in range(bins)]
    ranks = [F.lit(0.0), *[F.kll_sketch_get_rank_double("all", F.lit(edge)) for edge in edges[1:]], F.lit(1.0)]
    rows = [F.struct(F.lit(k).alias("bin"), F.lit(edge).alias("from_minute"), (ranks[k + 1] - ranks[k]).alias("share")) for k, edge in enumerate(edges)]
    return whole.select(F.inline(F.array(*rows)))


def correlations(states: DataFrame) -> DataFrame:
    """(x, y, r) over all rows that ``states`` stand for; NULL where a column does not vary."""
    whole = merged_moments(states, ["x", "y"])
    spread = F.sqrt(F.col("sxx") * F.col("syy"))
    return whole.select("x", "y", F.when(spread > 0, F.round(F.col("sxy") / spread, 6)).alias("r"))
