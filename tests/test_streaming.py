from helpers import days, raw_trips, rows
from pyspark.sql import functions as F

from ridelake import paths
from ridelake.operators.clean import cast_trips
from ridelake.plans import lake
from ridelake.session import fresh_path, materialise
from ridelake.sources.layout import Layout
from ridelake.streaming.incremental import load_batch, run_incremental


def trip(i, day, **more):
    return {
        "ride_id": f"r{i}", "started_at": f"2024-{day} 08:00:00", "ended_at": f"2024-{day} 08:10:00",
        "start_station_id": f"s{i}", **more,
    }


def drop(spark, base, name, *changes):
    raw_trips(spark, *changes).coalesce(1).write.option("header", True).csv(f"{base}/in/{name}")


def named(gold):
    stations = gold["dim_station"].withColumnRenamed("station_key", "start_station_key")
    return rows(
        gold["fact_trips"].join(stations, "start_station_key"), "ride_id", "date_key", "station_id", "trip_distance"
    )


def test_drops_equal_one_batch(spark):
    base, daily = fresh_path(spark, "stream"), days(spark, {})

    def run():
        run_incremental(spark, f"{base}/in", daily, f"{base}/lake", f"{base}/cp")

    drop(spark, base, "one", trip(1, "07-11"), trip(2, "08-01"), trip(3, "07-11", ended_at="bad"))
    run()
    first = lake.read_gold(spark, f"{base}/lake")
    keys = dict(rows(first["dim_station"], "station_id", "station_key"))
    # A repeated ride, a late ride for an old month, and a new month.
    drop(spark, base, "two", trip(1, "07-11"), trip(4, "07-12"), trip(4, "07-12"), trip(5, "09-09"))
    run()
    gold = lake.read_gold(spark, f"{base}/lake")
    assert keys.items() <= dict(rows(gold["dim_station"], "station_id", "station_key")).items()
    assert lake.read_silver(spark, f"{base}/lake").count() == 4

    once = fresh_path(spark, "batch")
    changes = [trip(1, "07-11"), trip(2, "08-01"), trip(4, "07-12"), trip(5, "09-09")]
    lake.write_silver(cast_trips(raw_trips(spark, *changes)), daily, once, "all")
    lake.silver_to_gold(spark, once)
    batch = lake.read_gold(spark, once)
    assert named(gold) == named(batch)
    assert rows(gold["dim_date"]) == rows(batch["dim_date"])

    # Nothing new: nothing happens.
    run()
    assert lake.read_gold(spark, f"{base}/lake")["fact_trips"].count() == 4


def test_a_repeated_batch_adds_only_what_is_missing(spark):
    root, daily = fresh_path(spark, "retry"), days(spark, {})
    batch = raw_trips(spark, trip(1, "07-11"), trip(2, "07-12"))
    # As after a crash between the layers: Silver is there, the fact is not.
    lake.write_silver(cast_trips(batch), daily, root, "2024")
    assert load_batch(batch, daily, root) == [(2024, 7)]
    kept = {n: rows(t) for n, t in lake.read_gold(spark, root).items()}
    load_batch(batch, daily, root)
    assert {n: rows(t) for n, t in lake.read_gold(spark, root).items()} == kept
    assert lake.read_silver(spark, root).groupBy("ride_id").count().filter(F.col("count") > 1).count() == 0
    assert len(kept["fact_trips"]) == 2


def test_an_empty_batch_is_harmless(spark):
    root = fresh_path(spark, "empty")
    assert load_batch(raw_trips(spark, trip(1, "07-11", ended_at=None)), days(spark, {}), root) == []


def test_only_touched_months_are_read(spark):
    root, daily = fresh_path(spark, "prune"), days(spark, {})
    load_batch(raw_trips(spark, trip(1, "07-11"), trip(2, "08-11")), daily, root)
    ids = materialise(lake.read_silver(spark, root).filter("month = 8").select("ride_id"), "ids")
    assert rows(lake.held_rides(ids, root)) == [("r2", 2024, 8)]
    stored = lake.stored_rides(spark, root, ["arrivals"], [(2024, 8)])
    assert rows(stored) == [("arrivals", 2024, 8, "r2")]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = lake.stored_rides(spark, root, ["arrivals"], [(2024, 8)])._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "ReadSchema: struct<ride_id:string>" in plan
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "load" in filters and "month" in filters and "202408" in filters


def test_a_batch_without_repeats_reads_no_stored_ids(spark, monkeypatch):
    root, daily = fresh_path(spark, "filters"), days(spark, {})
    lake.write_silver(cast_trips(raw_trips(spark, *[trip(k, "06-11") for k in range(50)])), daily, root, "early")
    load_batch(raw_trips(spark, trip(100, "07-11"), trip(101, "08-11")), daily, root)
    looked = []
    real = lake.stored_rides

    def look(*args):
        looked.append(args[2:])
        return real(*args)

    monkeypatch.setattr(lake, "stored_rides", look)
    load_batch(raw_trips(spark, *[trip(k, "07-11") for k in range(200, 400)]), daily, root)
    assert looked == [] and lake.read_gold(spark, root)["fact_trips"].count() == 202
    # one ride of each load, under other months
    load_batch(raw_trips(spark, trip(7, "09-01"), trip(101, "09-02"), trip(500, "09-03")), daily, root)
    assert looked == [(["arrivals", "early"], [(2024, 6), (2024, 8)])]
    assert rows(lake.read_gold(spark, root)["fact_trips"].filter("month = 9"), "ride_id") == [("r500",)]
    # without its filters a load is read whole, and nothing counts twice
    paths.remove(spark, Layout(root).ride_ids("early"))
    assert load_batch(raw_trips(spark, trip(8, "09-01")), daily, root) == []
    assert looked[1:] == [(["early"],)]


def test_an_id_under_two_months_of_one_batch_counts_once(spark):
    root, daily = fresh_path(spark, "twice"), days(spark, {})
    assert load_batch(raw_trips(spark, trip(1, "08-11"), trip(1, "07-11"), trip(2, "08-12")), daily, root) == [(2024, 7), (2024, 8)]
    assert rows(lake.read_gold(spark, root)["fact_trips"], "ride_id", "date_key") == [("r1", 20240711), ("r2", 20240812)]
