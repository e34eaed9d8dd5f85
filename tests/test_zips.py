"""ZIP members as a data source."""

import csv
import io
import zipfile

import pytest
from helpers import TRIP, rows

from ridelake import schemas
from ridelake.catalogue import queries
from ridelake.operators import clean
from ridelake.sources import zips
from ridelake.sources.trips import read_trip_archives, read_trip_zips
from ridelake.sources.zips import read_zip_records

HEADER = schemas.RAW_TRIPS.names


def trip_csv(*changes, header=HEADER):
    out = io.StringIO()
    writer = csv.DictWriter(out, header, extrasaction="ignore")
    writer.writeheader()
    for change in changes:
        writer.writerow({**TRIP, **change})
    return out.getvalue()


def archive(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name, text)


@pytest.fixture
def folder(tmp_path):
    odd = {"ride_id": "q", "start_station_name": 'A "big", round\nplace', "end_station_name": "ends with \\", "end_lat": ""}
    archive(tmp_path / "a.zip", {"one.csv": trip_csv(*({"ride_id": str(k)} for k in range(20_000))), "sub/two.CSV": "﻿" + trip_csv(odd)})
    archive(tmp_path / "deep" / "b.zip", {"x.csv": trip_csv({"ride_id": "x"}, header=["note", *reversed(HEADER)]), "__MACOSX/x.csv": "?", "y.csv": trip_csv()})
    archive(tmp_path / "c.zip", {"readme.txt": "no rides"})
    (tmp_path / "loose.csv").write_text("not,a,member\n")
    return tmp_path


def test_every_member_is_a_task_and_keeps_its_values(spark, folder):
    got = read_trip_zips(spark, str(folder))
    assert got.columns == ["source", *HEADER]
    assert read_zip_records(spark, str(folder)).rdd.getNumPartitions() == 4
    assert got.count() == 20_002
    special = rows(got.where("ride_id in ('q', 'x')"), "ride_id", "start_station_name", "end_station_name", "end_lat", "member_casual")
    assert special == [("q", 'A "big", round\nplace', "ends with \\", None, "member"), ("x", "First St", "Second St", "40.72", "member")]
    assert {r["source"].rsplit("/", 1)[-1] for r in got.select("source").distinct().collect()} == {"a.zip", "b.zip"}
    assert read_trip_archives(spark, str(folder)).count() == 20_002


def test_uris_single_archives_and_nothing(spark, folder, tmp_path):
    assert read_trip_zips(spark, f"file://{folder}").count() == read_trip_zips(spark, f"file:{folder}").count() == 20_002
    assert read_trip_zips(spark, str(folder / "deep" / "b.zip")).count() == 1
    assert read_trip_zips(spark, str(folder / "c.zip")).count() == 0
    with pytest.raises(Exception, match="none-there"):
        read_trip_zips(spark, str(folder / "none-there")).count()


def test_a_member_without_a_column_is_an_error(spark, tmp_path):
    archive(tmp_path / "bad.zip", {"m.csv": trip_csv({}, header=HEADER[1:])})
    with pytest.raises(Exception, match="bad.zip: m.csv lacks ride_id"):
        read_trip_zips(spark, str(tmp_path)).collect()
    wide = [f"c{k}" for k in range(zips.WIDEST + 1)]
    archive(tmp_path / "bad.zip", {"m.csv": ",".join(wide) + "\n1\n"})
    with pytest.raises(Exception, match="columns, more than"):
        read_trip_zips(spark, str(tmp_path)).collect()


def test_records_follow_quotes():
    assert list(zips.records(['a,"b\n', 'c""d"\n', "\n", "e\r\n"])) == ['a,"b\nc""d"', "e"]
    with pytest.raises(ValueError, match="never closed"):
        list(zips.records(['a,"b\n']))


def test_plan_parses_values_in_spark(spark, folder):
    plan = read_trip_zips(spark, str(folder)).select("ride_id")._jdf.queryExecution().executedPlan().toString()
    assert "from_csv" in plan and "MapInArrow" not in plan and "MapInPandas" not in plan


def test_archives_follow_the_trips(spark, sf_dir, monkeypatch):
    whole = queries.zip_members(spark, sf_dir)
    monkeypatch.setattr(queries, "ARCHIVED", 300)
    folder = queries._zipped(spark, sf_dir)
    assert read_trip_zips(spark, folder).rdd.getNumPartitions() >= 16
    assert rows(clean.typed(read_trip_zips(spark, folder), schemas.TYPED_TRIPS).select("ride_id")) == rows(whole.select("ride_id"))


def test_short_and_long_records_keep_their_values(spark, tmp_path):
    lines = [",".join(HEADER), "1,type", ",".join(["2", *"abcdefghijkl", "too", "many"]), ",".join(["3", *"abcdefghijk", '"quoted, last"'])]
    archive(tmp_path / "odd.zip", {"odd.csv": "\n".join(lines) + "\n"})
    read = read_trip_zips(spark, str(tmp_path))
    assert rows(read, HEADER[0], HEADER[1], HEADER[-1]) == [("1", "type", None), ("2", "a", "l"), ("3", "a", "quoted, last")]
