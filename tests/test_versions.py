"""Gold changes all at once: wherever a run stops, readers find one version of all tables."""

import json

import pytest
from helpers import days, raw_trips, rows

from ridelake import paths
from ridelake.operators.clean import cast_trips
from ridelake.plans import lake
from ridelake.session import fresh_path
from ridelake.sinks import versions
from ridelake.sources.layout import Layout
from ridelake.streaming.incremental import load_batch


def trip(i, day, **more):
    return {"ride_id": f"r{i}", "started_at": f"2024-{day} 08:00:00", "ended_at": f"2024-{day} 08:10:00", "start_station_id": f"s{i}", **more}


def write(spark, root, load, *changes):
    lake.write_silver(cast_trips(raw_trips(spark, *changes)), days(spark, {}), root, load)


def contents(spark, root):
    return {name: rows(table) for name, table in lake.read_gold(spark, root).items()}


def test_a_run_that_stops_after_any_write_changes_nothing(spark, monkeypatch):
    root = fresh_path(spark, "versions")
    write(spark, root, "a", trip(1, "06-11"), trip(2, "07-11"))
    lake.silver_to_gold(spark, root)
    before = contents(spark, root)
    write(spark, root, "b", trip(3, "07-12", member_casual="guest", rideable_type="cargo"), trip(4, "08-01"))
    real = versions.Publication._write
    for last in range(1, 8):
        written = []

        def stops(self, name, *more):
            if len(written) == last:
                raise OSError("stopped")
            written.append(name)
            return real(self, name, *more)

        monkeypatch.setattr(versions.Publication, "_write", stops)
        try:
            lake.silver_to_gold(spark, root, ["b"])
            done = True
        except OSError:
            done = False
        monkeypatch.setattr(versions.Publication, "_write", real)
        if done:
            break
        assert contents(spark, root) == before, written
    assert 3 <= last <= 6
    after = contents(spark, root)
    assert [r[0] for r in after["fact_trips"]] == ["r1", "r2", "r3", "r4"] and len(after["dim_member"]) == 3
    # as before the run, by number
    assert {n: rows(t) for n, t in lake.read_gold(spark, root, 1).items()} == before


def test_a_cut_off_manifest_is_no_version(spark):
    root = fresh_path(spark, "versions")
    write(spark, root, "a", trip(1, "06-11"))
    lake.silver_to_gold(spark, root)
    before = contents(spark, root)
    paths.create_text(spark, f"{Layout(root).gold}/versions/000000000002.json", json.dumps({"fact_trips": ["write=x"]})[:-5])
    assert contents(spark, root) == before
    load_batch(raw_trips(spark, trip(2, "06-12")), days(spark, {}), root)
    assert lake.gold_tables(spark, root).version().number == 3 and len(contents(spark, root)["fact_trips"]) == 2
    with pytest.raises(Exception, match="(?i)exist"):
        paths.create_text(spark, f"{Layout(root).gold}/versions/000000000003.json", "{}")


def test_the_second_of_two_runs_fails_and_can_be_repeated(spark):
    root = fresh_path(spark, "versions")
    write(spark, root, "a", trip(1, "06-11"))
    lake.silver_to_gold(spark, root)
    slow = lake.gold_tables(spark, root).begin()
    load_batch(raw_trips(spark, trip(2, "06-12")), days(spark, {}), root)
    with pytest.raises(RuntimeError, match="repeat the run"):
        slow.publish()
    assert len(contents(spark, root)["fact_trips"]) == 2


def test_pruning_keeps_the_last_versions_whole(spark):
    root = fresh_path(spark, "versions")
    for k, day in enumerate(("06-11", "07-11", "08-11")):
        write(spark, root, "a", *[trip(i, d) for i, d in enumerate(("06-11", "07-11", "08-11")[: k + 1])])
        lake.silver_to_gold(spark, root, ["a"])
    tables, kept = lake.gold_tables(spark, root), contents(spark, root)
    second = {n: rows(t) for n, t in lake.read_gold(spark, root, 2).items()}
    assert tables.prune(keep=2) > 0
    assert contents(spark, root) == kept and {n: rows(t) for n, t in lake.read_gold(spark, root, 2).items()} == second
    assert tables.prune(keep=1) > 0 and contents(spark, root) == kept and tables.prune(keep=1) == 0


def test_nothing_published_is_empty(spark):
    gold = lake.read_gold(spark, fresh_path(spark, "versions"))
    assert all(table.count() == 0 for table in gold.values())
