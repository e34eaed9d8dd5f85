"""Monthly states: only touched months are read, and merged states equal one pass over all rows."""

import pytest
from helpers import days, raw_trips, rows
from pyspark.sql import functions as F

from ridelake import paths
from ridelake.operators.clean import cast_trips
from ridelake.plans import demand, lake, profile, states
from ridelake.session import fresh_path, materialise
from ridelake.sources.layout import Layout
from ridelake.streaming.incremental import load_batch


def trip(i, day, **more):
    return {"ride_id": f"r{i}", "started_at": f"2024-{day} 08:00:00", "ended_at": f"2024-{day} 08:{10 + i % 40}:00", "start_station_id": f"s{i % 3}", "end_station_id": f"s{i % 2}", **more}


def write(spark, root, load, *changes):
    lake.write_silver(cast_trips(raw_trips(spark, *changes)), days(spark, {}), root, load)


def test_only_touched_months_are_read(spark):
    root = fresh_path(spark, "states")
    write(spark, root, "a", trip(1, "06-11"), trip(2, "07-11"), trip(3, "07-12"))
    assert states.refresh_states(spark, root) == [(2024, 6), (2024, 7)]
    assert states.refresh_states(spark, root) == []
    # June's files are gone: who would read them would notice
    june = f"{Layout(root).silver('a')}/year=2024/month=6"
    paths.rename(spark, june, f"{root}/june")
    write(spark, root, "b", trip(4, "07-13"), trip(5, "08-11"))
    assert states.refresh_states(spark, root) == [(2024, 7), (2024, 8)]
    paths.rename(spark, f"{root}/june", june)
    spark.catalog.refreshByPath(root)
    silver = lake.read_silver(spark, root)
    assert rows(states.station_imbalance(spark, root)) == rows(demand.station_imbalance(silver, keep_unknown=False))
    assert rows(states.station_demand(spark, root)) == rows(demand.station_demand(silver))
    assert rows(states.trips_by_hour(spark, root)) == [(8, 5)]
    assert rows(states.distinct_estimates(spark, root)) == [(5, 5, 1)]


def test_vanished_months_batches_and_stops(spark, monkeypatch):
    root = fresh_path(spark, "states")
    write(spark, root, "a", trip(1, "06-11"), trip(2, "07-11"))
    states.refresh_states(spark, root)
    write(spark, root, "a", trip(2, "07-11"))
    load_batch(raw_trips(spark, trip(9, "09-01")), days(spark, {}), root)

    def stops(*_):
        raise OSError("stopped")

    monkeypatch.setitem(states.STATES, "hours", stops)
    with pytest.raises(OSError):
        states.refresh_states(spark, root)
    monkeypatch.undo()
    assert states.refresh_states(spark, root) == [(2024, 6), (2024, 7), (2024, 9)]
    for name in states.STATES:
        assert {r["month"] for r in states.read_states(spark, root, name).collect()} == {7, 9}


def test_correlations_of_many_columns_take_one_scan(spark):
    names = [f"c{k}" for k in range(20)]
    wide = spark.range(600).select(
        (F.col("id") % 5).cast("int").alias("part"),
        *[F.when(F.pmod(F.hash("id", F.lit(k)), F.lit(7)) > 0, F.rand(k) * (k + 1) + F.col("id") * (k % 3) + 1e6).alias(n) for k, n in enumerate(names)],
    )
    wide = materialise(wide, "wide")
    found = states.moments(wide, names, ["part"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    got = {(r["x"], r["y"]): r["r"] for r in states.correlations(materialise(found, "moments")).collect()}
    want = {(r["x"], r["y"]): r["r"] for r in profile.correlations(wide, names).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=2e-6) for k in want)


def test_merged_sketches_keep_their_error(spark):
    root = fresh_path(spark, "sketches")
    silver = spark.range(60_000).selectExpr(
        "2024 year", "cast(id % 6 + 1 as int) month", "concat('r', id % 45000) ride_id", "id % 100 / 10D start_lat",
        "if(id % 10 = 0, null, 1D) start_lng", "pow(id % 20000 / 20000D, 3) * 1000 trip_duration_min",
    )
    materialise(states.sketches(silver), "x").write.partitionBy("year", "month").parquet(Layout(root).states("sketches"))
    trips, rides, points = states.distinct_estimates(spark, root).first()
    assert trips == 60_000 and rides == pytest.approx(45_000, rel=3 * states.DISTINCT_ERROR) and points == 90
    for share, minutes in rows(states.duration_quantiles(spark, root, (0.1, 0.5, 0.9))):
        assert (minutes / 1000) ** (1 / 3) == pytest.approx(share, abs=states.RANK_ERROR)
    shares = [r["share"] for r in states.duration_histogram(spark, root, 10).orderBy("bin").collect()]
    exact = [((k + 1) / 10) ** (1 / 3) - (k / 10) ** (1 / 3) for k in range(10)]
    assert shares == pytest.approx(exact, abs=2 * states.RANK_ERROR) and sum(shares) == pytest.approx(1)


def test_nothing_stored(spark):
    root = fresh_path(spark, "none")
    assert states.station_imbalance(spark, root).count() == states.duration_histogram(spark, root, 4).count() == 0
    assert states.correlations(states.read_states(spark, root, "moments")).count() == 0


def test_moments_aggregate_pairs_as_rows(spark):
    silver = materialise(spark.range(4).selectExpr("2024 year", "1 month", *[f"double(id * {k}) c{k}" for k in range(6)]), "pairs")
    found = states.moments(silver, [f"c{k}" for k in range(6)])
    # six aggregates however many pairs; more would be too large to be compiled
    assert found._jdf.queryExecution().executedPlan().toString().count("partial_") <= 12
    assert found.count() == 21 and rows(found.where("x = 'c1' and y = 'c2'").withColumn("sxy", F.round("sxy", 6)), "n", "sxy") == [(4, 10.0)]
