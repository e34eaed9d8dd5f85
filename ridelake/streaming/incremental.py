"""File arrivals to Silver and Gold with Structured Streaming.

Each micro-batch is one set of new files. It is cleaned, enriched and appended
to Silver and then to the fact; rides that Silver already holds, under whatever
month and load, are left out. Filters kept by month say where to look: a batch
without repeats reads no stored id. Nothing stored is rewritten, a late file for an old month
needs no recompute of that month, and running a batch again after a failure adds
only what is missing.
"""

from __future__ import annotations

from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.operators.clean import cast_trips
from ridelake.operators.lookup import sized
from ridelake.plans.lake import (
    ARRIVALS,
    BY_MONTH,
    gold_tables,
    grow_dimension,
    held_rides,
    in_months,
    months_of,
    note_changes,
    note_rides,
    stored_dimensions,
)
from ridelake.plans.silver import build_silver
from ridelake.plans.star import FACT_INPUTS, KEYED, build_fact, date_members
from ridelake.rules import SILVER, RuleSet
from ridelake.session import materialise, scratch, together
from ridelake.sinks.layers import refresh, write_partitioned
from ridelake.sources.layout import Layout


def arriving_trips(spark: SparkSession, in_dir: str, max_files: int | None = None) -> DataFrame:
    """A stream of raw text trips from CSV files below ``in_dir``."""
    reader = (
        spark.readStream.schema(schemas.RAW_TRIPS)
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(in_dir)


def load_batch(
    raw: DataFrame, daily: DataFrame, root: str, rules: RuleSet = SILVER
) -> list[tuple[int, int]]:
    """Add one batch of raw trips to both layers; returns the months it touched."""
    with scratch(raw.sparkSession):
        return _load_batch(raw, daily, root, rules)


def _load_batch(raw: DataFrame, daily: DataFrame, root: str, rules: RuleSet) -> list[tuple[int, int]]:
    spark, layout = raw.sparkSession, Layout(root)
    arrived = build_silver(cast_trips(raw), daily, replace(rules, dedup_rides=True))
    batch = materialise(arrived, "arrivals")
    # one id may come under two months in one batch: the first keeps it
    batch = first_month(batch)
    held = held_rides(materialise(batch.select("ride_id").distinct(), "batch-ids"), root)
    fresh, unposted, gold = batch, None, gold_tables(spark, root).begin()
    if held is not None:
        fresh = materialise(batch.join(sized(held.select("ride_id").distinct()), "ride_id", "left_anti"), "fresh")
        # what an earlier run of this batch stored but did not carry to the fact; a ride that Silver has in another month stays there
        own = materialise(batch.select("ride_id", *BY_MONTH).join(sized(held), ["ride_id", *BY_MONTH], "left_semi"), "stored-before")
        if months := months_of(own):
            # the month's ids meet the few of ``own`` in the scan, before anything is shuffled
            posted = gold.read("fact_trips").filter(in_months(months)).select("ride_id")
            posted = posted.join(sized(own.select("ride_id").distinct()), "ride_id", "left_semi")
            missing = materialise(own.join(posted, "ride_id", "left_anti"), "unposted-ids")
            if not missing.isEmpty():
                unposted = batch.join(sized(missing), ["ride_id", *BY_MONTH], "left_semi")
    ours = fresh if unposted is None else materialise(fresh.unionByName(unposted), "unposted")
    # A batch spans few months; each names one partition of the stored layers.
    months = sorted(months_of(ours))
    if not months:
        return months

    def add_silver() -> None:
        # filters first: one that holds more than Silver costs a look, one that holds less a repeated ride
        note_changes(spark, root, None, set(months))
        note_rides(fresh, root, ARRIVALS)
        write_partitioned(fresh, layout.silver(ARRIVALS), BY_MONTH, mode="append")

    def add_dates() -> None:
        known = gold.read("dim_date").select("date_key")
        gold.add("dim_date", date_members(ours).join(known, "date_key", "left_anti"))

    together(spark, add_silver, add_dates, *[partial(grow_dimension, ours, gold, dim) for dim in KEYED])
    dimensions, _ = stored_dimensions(spark, gold)
    gold.add("fact_trips", build_fact(ours.select(*FACT_INPUTS), dimensions))
    refresh(spark, layout.silver())
    gold.publish()
    return months


def first_month(rows: DataFrame) -> DataFrame:
    """Of an id that comes under several months the row of the first; an aggregate over ids, joined to those few alone."""
    month = F.col("year") * 100 + F.col("month")
    many = materialise(rows.groupBy("ride_id").agg(F.min(month).alias("first"), F.max(month).alias("last")).where("first < last"), "two-months")
    if many.isEmpty():
        return rows
    kept = rows.join(sized(many.select("ride_id", "first")), "ride_id", "left")
    return kept.where(F.col("first").isNull() | (F.col("first") == month)).select(*rows.columns)


def run_incremental(
    spark: SparkSession,
    in_dir: str,
    daily: DataFrame,
    root: str,
    checkpoint: str,
    rules: RuleSet = SILVER,
    max_files: int | None = None,
) -> None:
    """Process every file that arrived since the last run, then stop."""

    def post(batch: DataFrame, _batch_id: int) -> None:
        load_batch(batch, daily, root, rules)

    query = (
        arriving_trips(spark, in_dir, max_files)
        .writeStream.foreachBatch(post)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
