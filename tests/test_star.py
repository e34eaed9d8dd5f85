from dataclasses import replace

from helpers import days, raw_trips, rows
from pyspark.sql import functions as F

from ridelake import schemas
from ridelake.operators.clean import cast_trips
from ridelake.plans import lake, star
from ridelake.plans.silver import build_silver
from ridelake.rules import SILVER
from ridelake.session import fresh_path
from ridelake.sinks.layers import swap_table


def texts(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "member_casual string")


def test_first_load(spark):
    got = star.upsert_dimension(texts(spark, "member", "casual"), None, star.MEMBER)
    assert got.schema.names == schemas.DIM_MEMBER.names
    assert rows(got) == [(-1, "Unknown"), (1, "casual"), (2, "member")]


def test_stable_keys_survive_a_second_load(spark):
    first = star.upsert_dimension(texts(spark, "member"), None, star.MEMBER)
    second = star.upsert_dimension(texts(spark, "casual", "member", "annual"), first, star.MEMBER)
    assert rows(second) == [(-1, "Unknown"), (1, "member"), (2, "annual"), (3, "casual")]
    assert rows(star.upsert_dimension(texts(spark, "casual"), second, star.MEMBER)) == rows(second)


def test_rebuild_renumbers_and_keeps_one_unknown(spark):
    first = star.upsert_dimension(texts(spark, "member"), None, star.MEMBER, mode="rebuild")
    second = star.upsert_dimension(texts(spark, "casual"), first, star.MEMBER, mode="rebuild")
    assert rows(second) == [(-1, "Unknown"), (1, "casual"), (2, "member")]


def two_names(spark):
    named = [{"ride_id": str(i), "start_station_name": "B St"} for i in range(3)]
    other = [{"ride_id": "9", "start_station_name": "A St"}]
    unnamed = [{"ride_id": f"u{i}", "start_station_id": "7", "start_station_name": None} for i in range(2)]
    trips = cast_trips(raw_trips(spark, *named, *other, *unnamed))
    return build_silver(trips, days(spark, {}), SILVER)


def test_station_has_one_row_per_id(spark):
    silver = two_names(spark)
    assert rows(star.station_members(silver)) == [
        ("5164.05", "Second St"), ("5379.1", "B St"), ("7", None),
    ]
    assert star.station_members(silver, one_per_id=False).count() == 4


def test_fact_does_not_fan_out_and_resolves_keys(spark):
    silver = two_names(spark)
    dims = star.build_dimensions(silver)
    dims["dim_member"] = dims["dim_member"].filter("member_casual <> 'member'")
    fact = star.build_fact(silver, dims)
    assert [(f.name, f.dataType) for f in fact.schema] == [
        (f.name, f.dataType) for f in schemas.FACT_TRIPS
    ]
    assert fact.count() == silver.count() == 6
    assert rows(fact.select("member_key").distinct()) == [(-1,)]
    assert fact.filter("start_station_key = -1 OR end_station_key = -1 OR bike_key <> 1").count() == 0
    assert dims["dim_date"].count() == 1


def load(spark, root, *changes):
    trips = cast_trips(raw_trips(spark, *changes))
    lake.write_silver(trips, days(spark, {}), root, changes[0]["started_at"][:4])


def year_of(year, station, n):
    return [
        {
            "ride_id": f"{year}-{i}", "started_at": f"{year}-07-1{i} 08:00:00",
            "ended_at": f"{year}-07-1{i} 08:10:00", "start_station_id": station,
        }
        for i in range(n)
    ]


def test_second_year_leaves_the_first_unchanged(spark):
    root = fresh_path(spark, "lake")
    load(spark, root, *year_of(2023, "Z", 3))
    assert lake.silver_to_gold(spark, root, ["2023"]) == {"silver_rows": 3, "fact_rows": 3}
    before = lake.read_gold(spark, root)
    old_fact, old_stations = rows(before["fact_trips"]), set(rows(before["dim_station"]))

    load(spark, root, *year_of(2024, "A", 4))
    assert lake.silver_to_gold(spark, root, ["2024"]) == {"silver_rows": 4, "fact_rows": 4}
    after = lake.read_gold(spark, root)
    assert rows(after["fact_trips"].filter("year = 2023")) == old_fact
    assert after["fact_trips"].count() == 7
    assert old_stations < set(rows(after["dim_station"]))
    keys = [r[0] for r in after["dim_station"].select("station_key").collect()]
    assert len(keys) == len(set(keys)) == 4

    # Loading the same year again changes nothing.
    kept = {name: rows(table) for name, table in after.items()}
    lake.silver_to_gold(spark, root, ["2024"])
    assert {name: rows(t) for name, t in lake.read_gold(spark, root).items()} == kept


def test_rebuild_mode_replaces_stored_dimensions(spark):
    root = fresh_path(spark, "lake")
    load(spark, root, *year_of(2023, "Z", 2))
    lake.silver_to_gold(spark, root, mode="rebuild")
    load(spark, root, *year_of(2024, "A", 2))
    lake.silver_to_gold(spark, root, mode="rebuild")
    gold = lake.read_gold(spark, root)
    assert rows(gold["dim_station"], "station_key", "station_id") == [
        (-1, "UNKNOWN"), (1, "5164.05"), (2, "A"), (3, "Z"),
    ]
    joined = gold["fact_trips"].join(
        gold["dim_station"].withColumnRenamed("station_key", "start_station_key"), "start_station_key"
    )
    assert rows(joined.select("year", "station_id").distinct()) == [(2023, "Z"), (2024, "A")]


def test_swap_reads_the_table_it_replaces(spark):
    path = fresh_path(spark, "swap")
    swap_table(spark.range(3), path)
    swap_table(spark.read.parquet(path).union(spark.range(3, 5)), path)
    assert rows(spark.read.parquet(path)) == [(i,) for i in range(5)]


def test_year_filter_prunes_fact_partitions(spark):
    root = fresh_path(spark, "lake")
    load(spark, root, *year_of(2023, "Z", 2), *year_of(2024, "A", 2))
    lake.silver_to_gold(spark, root)
    fact = lake.read_gold(spark, root)["fact_trips"]
    query = fact.filter(F.col("year") == 2024).groupBy("start_hour").count()
    plan = query._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan"):]
    assert "PartitionFilters: [isnotnull(year" in scan and "ReadSchema: struct<start_hour:int>" in scan
    assert rows(query) == [(8, 2)]


def test_fact_build_shuffles_nothing(spark):
    root = fresh_path(spark, "lake")
    load(spark, root, *year_of(2024, "A", 2))
    lake.silver_to_gold(spark, root)
    dims, all_broadcast = lake.stored_dimensions(spark, lake.gold_tables(spark, root))
    plan = star.build_fact(lake.read_silver(spark, root), dims)._jdf.queryExecution().executedPlan().toString()
    assert all_broadcast and plan.count("BroadcastHashJoin") == 5
    assert "Exchange hashpartitioning" not in plan and "started_at" not in plan


def test_unknown_category_gets_the_unknown_key(spark):
    rules = replace(SILVER, unknown_weather=True)
    late = {"ride_id": "x", "started_at": "2024-08-01 10:00:00", "ended_at": "2024-08-01 10:10:00"}
    silver = build_silver(cast_trips(raw_trips(spark, {}, late)), days(spark, {}), rules)
    fact = star.build_fact(silver, star.build_dimensions(silver))
    assert rows(fact, "ride_id", "temp_key", "temperature") == [("r1", 1, 76.2), ("x", -1, None)]


def test_a_stray_trip_does_not_replace_its_month(spark):
    root = fresh_path(spark, "lake")
    load(spark, root, *year_of(2023, "Z", 3))
    lake.silver_to_gold(spark, root, ["2023"])
    # The next year's files hold one more trip of July 2023.
    stray = {**year_of(2023, "Z", 1)[0], "ride_id": "stray"}
    load(spark, root, *year_of(2024, "A", 2), stray)
    assert lake.silver_to_gold(spark, root, ["2024"]) == {"silver_rows": 6, "fact_rows": 6}
    fact = lake.read_gold(spark, root)["fact_trips"]
    assert rows(fact.groupBy("year").count()) == [(2023, 4), (2024, 2)]
    # Loading it again without the stray trip removes that one only.
    load(spark, root, *year_of(2024, "A", 2))
    lake.silver_to_gold(spark, root)
    assert rows(lake.read_gold(spark, root)["fact_trips"].groupBy("year").count()) == [(2023, 3), (2024, 2)]
