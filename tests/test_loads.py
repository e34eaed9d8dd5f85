"""Loads that meet, what jobs leave behind, and recovery."""

import io
import os
import zipfile

import pytest
from helpers import days, raw_trips, rows
from pyspark.sql import functions as F

from ridelake import paths, schemas
from ridelake.operators import membership
from ridelake.operators.clean import cast_trips
from ridelake.plans import lake, profile, silver
from ridelake.session import fresh_path, materialise, scratch, shared_folder
from ridelake.sinks.catalog import register
from ridelake.sinks.layers import recover, swap_table
from ridelake.sources.layout import Layout
from ridelake.sources.tables import read_or_empty
from ridelake.sources.trips import unzip_trips
from ridelake.streaming import incremental
from ridelake.streaming.incremental import load_batch


def trip(i, day, **more):
    return {"ride_id": f"r{i}", "started_at": f"2024-{day} 08:00:00", "ended_at": f"2024-{day} 08:10:00", "start_station_id": f"s{i}", **more}


def stored_ids(spark, root):
    return rows(lake.read_gold(spark, root)["fact_trips"], "ride_id", "date_key")


def test_months_that_vanish_leave_gold(spark):
    root, daily = fresh_path(spark, "vanish"), days(spark, {})
    for trips in ([trip(1, "07-11"), trip(2, "08-11")], [trip(1, "07-11")]):
        lake.write_silver(cast_trips(raw_trips(spark, *trips)), daily, root, "L")
        lake.silver_to_gold(spark, root, ["L"])
    assert stored_ids(spark, root) == [("r1", 20240711)]
    assert rows(lake.read_gold(spark, root)["dim_date"], "date_key") == [(20240711,)]
    assert rows(lake.stored_counts(spark, root)) == [(2024, 7, 1, 1)]
    assert not paths.exists(spark, Layout(root).changes("L"))


def test_a_whole_run_replaces_all_months(spark):
    root, daily = fresh_path(spark, "whole"), days(spark, {})
    for trips in ([trip(1, "07-11"), trip(2, "08-11")], [trip(1, "07-11")]):
        lake.write_silver(cast_trips(raw_trips(spark, *trips)), daily, root, "L")
        lake.silver_to_gold(spark, root, mode="rebuild")
    assert stored_ids(spark, root) == [("r1", 20240711)]
    with pytest.raises(ValueError, match="without loads"):
        lake.silver_to_gold(spark, root, ["L"], mode="rebuild")


def test_late_weather_reaches_streamed_rides(spark):
    root = fresh_path(spark, "late")
    load_batch(raw_trips(spark, trip(1, "07-11"), trip(2, "08-02")), days(spark, {}).limit(0), root)
    assert lake.refresh_weather(spark, root, days(spark, {"trip_date": "2024-07-12"})) == []
    assert lake.refresh_weather(spark, root, days(spark, {"temp": 76.2})) == [(2024, 7)]
    assert rows(lake.read_gold(spark, root)["fact_trips"], "ride_id", "temperature") == [("r1", 76.2), ("r2", None)]
    assert rows(lake.read_silver(spark, root), "ride_id", "temp") == [("r1", 76.2), ("r2", None)]


def test_jobs_and_batches_leave_no_scratch_tables(spark):
    root, daily = fresh_path(spark, "clean"), materialise(days(spark, {}), "daily")
    before = set(os.listdir(shared_folder(spark)))
    lake.write_silver(cast_trips(raw_trips(spark, trip(1, "07-11"))), daily, root, "L")
    before |= set(os.listdir(shared_folder(spark)))
    lake.silver_to_gold(spark, root, ["L"])
    load_batch(raw_trips(spark, trip(2, "07-12")), daily, root)
    assert set(os.listdir(shared_folder(spark))) <= before | {os.path.basename(root)}
    with pytest.raises(RuntimeError), scratch(spark):
        gone = materialise(spark.range(3), "gone")
        raise RuntimeError
    assert not paths.exists(spark, gone.inputFiles()[0])


def test_stored_ids_are_reduced_before_any_exchange(spark):
    root = fresh_path(spark, "reduced")
    load_batch(raw_trips(spark, trip(1, "07-11"), trip(2, "07-12")), days(spark, {}), root)
    ids = materialise(lake.read_silver(spark, root).limit(1).select("ride_id"), "batch")
    filters = read_or_empty(spark, Layout(root).ride_ids(), schemas.RIDE_FILTERS)
    plan = membership.possible(ids, filters, [*lake.BY_MONTH, "load"], "ride_id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.index("BroadcastHashJoin") > plan.index("Exchange")


def test_filters_miss_no_id_and_name_few_others(spark):
    ids = spark.range(60_000).selectExpr("cast(id % 3 as int) month", "cast(sha1(cast(id as string)) as string) ride_id")
    ids = materialise(ids.union(spark.range(40_000).selectExpr("7", "concat('hot', id)")), "ids")
    filters = materialise(membership.build_filters(ids, ["month"], "ride_id"), "filters")
    asked = materialise(ids.where("month = 1 or month = 7").select("ride_id").union(spark.range(30_000).selectExpr("concat('new', id)")), "asked")
    found = membership.possible(asked, filters, ["month"], "ride_id")
    assert found.join(ids, ["month", "ride_id"], "left_semi").count() == 60_000
    assert found.count() - 60_000 < 20  # of 390,000 tests that should fail
    sizes = dict(rows(filters.groupBy("month").agg(F.max("blocks")), "month", "max(blocks)"))
    assert sizes == {0: 32, 1: 32, 2: 32, 7: 64}
    assert membership.possible(asked, filters.limit(0), ["month"], "ride_id").count() == 0


def test_compaction_keeps_rows_and_bounds_files(spark):
    root, daily = fresh_path(spark, "compact"), days(spark, {})
    for k in range(3):
        load_batch(raw_trips(spark, trip(k, "07-11"), trip(k + 10, "08-11")), daily, root)
    before = stored_ids(spark, root)
    lake.compact(spark, root, [(2024, 7)])
    assert stored_ids(spark, root) == before
    gold = lake.gold_tables(spark, root)
    months = [d for d in gold.version().tables["fact_trips"] if d.endswith("month=7")]
    assert len(months) == 1
    for path in (f"{Layout(root).silver('arrivals')}/year=2024/month=7", f"{Layout(root).fact}/{months[0]}"):
        assert sum(f.endswith(".parquet") for f in os.listdir(path)) == 1


def test_a_swap_that_was_cut_off_is_put_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "dim")
    spark.range(3).write.parquet(path)
    real, calls = paths.rename, []

    def dies(spark, a, b):
        calls.append(a)
        if len(calls) == 2:
            raise OSError("stopped")
        real(spark, a, b)

    monkeypatch.setattr(paths, "rename", dies)
    with pytest.raises(OSError):
        swap_table(spark.range(5), path)
    monkeypatch.setattr(paths, "rename", real)
    assert not os.path.exists(path)
    recover(spark, path)
    assert spark.read.parquet(path).count() == 3
    swap_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and not os.path.exists(f"{path}.old")


def test_open_histograms_of_nothing_and_of_one_value(spark):
    one = cast_trips(raw_trips(spark, trip(1, "07-11"), trip(2, "07-12")))
    got = profile.duration_histogram(one, low=None, high=None, bins=4).collect()
    assert [(r["bin"], r["trips"], r["density"]) for r in got] == [(0, 2, None), (1, 0, None), (2, 0, None), (3, 0, None)]
    assert [r["trips"] for r in profile.duration_histogram(one.limit(0), low=None, high=None, bins=2).collect()] == [0, 0]


def test_correlations_multiply_no_rows(spark):
    plan = profile.correlations(spark.range(5).selectExpr("id a", "id * id b", "-id c", "id + 1 d"), ["a", "b", "c", "d"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("inline") < plan.index("HashAggregate") and plan.count("Range (") == 2


def test_unique_rides_are_not_sorted(spark):
    trips = cast_trips(raw_trips(spark, *[trip(k, "07-11") for k in range(5)], trip(3, "07-11", end_station_id="a"), {"ride_id": None}, {"ride_id": None}))
    out = silver.distinct_rides(materialise(trips, "rides"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "SortAggregate" not in plan.split("LeftAnti")[0]
    assert rows(out, "ride_id") == sorted([(None,), *[(f"r{k}",) for k in range(5)]], key=repr)
    assert rows(out.filter("ride_id = 'r3'"), "end_station_id") == [("5164.05",)]


def test_catalog_notices_drift_and_moves(spark, tmp_path):
    for name, n in (("a", 2), ("b", 3)):
        spark.range(n).write.parquet(str(tmp_path / name))
    schema = spark.range(1).schema
    assert register(spark, "drift", str(tmp_path / "a"), schema) == []
    register(spark, "drift", str(tmp_path / "b"), schema)
    assert spark.table("drift").count() == 3
    with pytest.raises(ValueError, match="id: bigint is not string"):
        register(spark, "drift", str(tmp_path / "b"), spark.createDataFrame([], "id string").schema)
    spark.sql("DROP TABLE drift")


def test_archives_name_what_they_lack(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("m.csv", "ride_id,started_at\n1,2\n")
    with pytest.raises(Exception, match="x.zip: m.csv lacks rideable_type"):
        unzip_trips(spark.createDataFrame([("x.zip", buffer.getvalue())], "path string, content binary")).collect()




def test_filters_sort_one_row_an_id(spark):
    ids = materialise(spark.range(5000).selectExpr("cast(id % 3 as int) month", "concat('r', id) ride_id"), "ids")
    plan = membership.build_filters(ids, ["month"], "ride_id")._jdf.queryExecution().executedPlan().toString()
    # an id's bits become rows after ids were dealt and bitmaps built, not before
    assert plan.index("Generate") < plan.index("bitmap_construct_agg") < plan.index("REPARTITION_BY_COL")


def test_a_repeated_batch_stores_ids_only(spark, monkeypatch):
    root, daily = fresh_path(spark, "again"), days(spark, {})
    batch = raw_trips(spark, trip(1, "07-11"), trip(2, "07-12"))
    load_batch(batch, daily, root)
    stored = {}
    monkeypatch.setattr(incremental, "materialise", lambda df, label: stored.setdefault(label, materialise(df, label)))
    assert load_batch(batch, daily, root) == []
    assert stored["stored-before"].columns == ["ride_id", "year", "month"] and "unposted" not in stored
