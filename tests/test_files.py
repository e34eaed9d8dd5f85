"""File counts that follow listed sizes."""

from math import ceil

import pytest
from helpers import TRIP, days, raw_trips, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridelake import paths, schemas
from ridelake.plans import lake
from ridelake.session import fresh_path
from ridelake.sinks import files
from ridelake.sinks.files import Held
from ridelake.sinks.layers import write_partitioned
from ridelake.sources.layout import Layout


@settings(deadline=None)
@given(st.dictionaries(st.tuples(st.integers(0, 99).map(str)), st.integers(0, 500), max_size=60), st.integers(1, 200))
def test_plan_fills_tasks_up_to_the_target(sizes, target):
    where, tasks = files.assign(sizes, target)
    assert set(where) == set(sizes)
    load, owners = [0] * tasks, [0] * tasks
    for key, (first, n) in where.items():
        assert n == max(1, ceil(sizes[key] / target))
        for t in range(first, first + n):
            load[t] += sizes[key] / n
            owners[t] += 1
        assert n == 1 or owners[first] == 1
    assert all(used <= target + 1e-6 for used in load)
    shared = [used for used, n in zip(load, owners) if used <= target / 2]
    assert len(shared) <= 1 + sum(1 for s in sizes.values() if s > target)  # no two half-empty shared tasks


def test_untidy_partitions():
    held = {("a",): Held(4, 100), ("b",): Held(1, 100), ("c",): Held(1, 250), ("d",): Held(5, 450), ("e",): Held(1, 0)}
    assert set(files.untidy(held, 100)) == {("a",), ("c",)}
    assert set(files.untidy(held, 100, slack=4)) == {("c",)}


def test_placed_rows_are_whole_and_null_partitions_have_a_place(spark):
    path = fresh_path(spark, "placed")
    made = spark.range(4000).select(
        "id", F.expr("CASE WHEN id % 4 = 0 THEN NULL ELSE concat('k ', id % 4) END").alias("k"), F.md5(F.col("id").cast("string")).alias("t")
    )
    write_partitioned(made.repartition(6), path, ["k"], clustered=True)
    held = files.listed(spark, path, ["k"])
    assert set(held) == {("k 1",), ("k 2",), ("k 3",), ("__HIVE_DEFAULT_PARTITION__",)} and all(h.files == 6 for h in held.values())
    target = max(h.bytes for h in held.values()) // 2
    out = fresh_path(spark, "placed-again")
    write_partitioned(files.placed(spark.read.parquet(path), ["k"], held, target), out, ["k"], clustered=True)
    again = files.listed(spark, out, ["k"])
    assert {k: h.files for k, h in again.items()} == {k: h.wanted(target) for k, h in held.items()}
    assert spark.read.parquet(out).select(made.columns).exceptAll(made).isEmpty() and spark.read.parquet(out).count() == 4000
    # partitions that nobody listed are not lost
    assert files.placed(spark.read.parquet(path), ["k"], {}).count() == 4000


def _raw_year(spark, root, months, per_month):
    """One raw file whose rows go round the months."""
    start = F.expr(f"make_timestamp(2024, 1 + cast(id % {months} as int), 1 + cast(id % 28 as int), 8, 0, 0)")
    fixed = {n: F.lit(v) for n, v in TRIP.items()}
    rows_ = spark.range(0, months * per_month, 1, 1).select(
        *[
            {"ride_id": F.md5(F.col("id").cast("string")), "started_at": start.cast("string"), "ended_at": (start + F.expr("interval 9 minutes")).cast("string")}.get(n, fixed[n]).alias(n)
            for n in schemas.RAW_TRIPS.names
        ]
    )
    rows_.write.option("header", True).csv(Layout(root).raw_trips(2024))
    day = {"DATE": "01-01-2024", "FRSHTT": "000000"}
    text = spark.range(1).select(*[F.lit(day.get(n, "24")).alias(n) for n in schemas.RAW_WEATHER.names])
    text.write.option("header", True).csv(Layout(root).raw_weather(2024))


@pytest.mark.parametrize("months", [1, 12])
def test_a_raw_file_of_one_month_or_twelve(spark, months):
    root, small = fresh_path(spark, "raw-files"), 48 * 1024
    _raw_year(spark, root, months, 700)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(small))
    try:
        lake.raw_to_silver(spark, root, 2024, file_bytes=small)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    held = files.listed(spark, Layout(root).silver("2024"), lake.BY_MONTH)
    assert len(held) == months
    for h in held.values():
        assert h.files <= lake.SLACK * h.wanted(small) and h.bytes / h.files <= 2 * small
    silver = lake.read_silver(spark, root)
    assert silver.count() == silver.select("ride_id").distinct().count() == 700 * months
    # a tidy load is left alone: its files stay the same ones
    kept = rows(spark.read.parquet(Layout(root).silver()).select("_metadata.file_name").distinct())
    assert lake.tidy_silver(spark, root, "2024", file_bytes=small, slack=lake.SLACK) == []
    assert rows(spark.read.parquet(Layout(root).silver()).select("_metadata.file_name").distinct()) == kept


def test_compaction_covers_all_loads(spark):
    root, daily = fresh_path(spark, "compact-all"), days(spark, {})
    from ridelake.operators.clean import cast_trips

    for load, first in (("a", 0), ("b", 40)):
        some = [{"ride_id": f"r{first + i}", "started_at": f"2024-0{7 + i % 2}-11 08:00:00", "ended_at": f"2024-0{7 + i % 2}-11 08:30:00"} for i in range(40)]
        lake.write_silver(cast_trips(raw_trips(spark, *some)).repartition(5), daily, root, load, clustered=True)
    lake.silver_to_gold(spark, root)
    facts = lambda: rows(lake.read_gold(spark, root)["fact_trips"], "ride_id", "year", "month")
    before, version = facts(), lake.gold_tables(spark, root).version().number
    both = [(2024, 7), (2024, 8)]
    done = lake.compact(spark, root)
    assert done["a"] == done["b"] == both
    assert all(h.files == 1 for load in "ab" for h in files.listed(spark, Layout(root).silver(load), lake.BY_MONTH).values())
    assert facts() == before and len(before) == 80
    assert lake.compact(spark, root) == {"a": [], "b": [], "fact_trips": []}
    assert lake.gold_tables(spark, root).version().number <= version + 1
    out = fresh_path(spark, "export")
    assert lake.export_silver(spark, root, out) == 1 and spark.read.parquet(out).count() == 80
    assert sum(c.endswith(".parquet") for c in paths.children(spark, out)) == 1


def test_a_shared_task_sorts_a_bounded_share():
    sizes = {(str(k),): 20 << 20 for k in range(8)}
    where, tasks = files.assign(sizes)
    # each has one file, and none shares its task: two would be more than a task should sort at once
    assert tasks == 8 and all(n == 1 for _, n in where.values())
    assert files.assign({("a",): 300 << 20, ("b",): 10 << 20, ("c",): 20 << 20})[1] == 3
