import csv
import io
import zipfile

import pytest
from helpers import DAY, TRIP, days, raw_trips, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake import schemas
from ridelake.operators.clean import cast_trips
from ridelake.plans import lake, variants
from ridelake.plans.silver import build_silver
from ridelake.session import fresh_path, materialise
from ridelake.sinks.catalog import register, register_gold, register_silver
from ridelake.sinks.layers import save_table, write_layer, write_partitioned
from ridelake.sources.layout import Layout
from ridelake.sources.tables import read_or_empty, read_table, sql_over_path, typed_view
from ridelake.sources.trips import read_trip_files, read_trip_zips, read_trips, unzip_trips, zip_rows

HEADER = schemas.RAW_TRIPS.names


def trip_csv(*changes, header=HEADER):
    out = io.StringIO()
    writer = csv.DictWriter(out, header, extrasaction="ignore")
    writer.writeheader()
    for change in changes:
        writer.writerow({**TRIP, **change})
    return out.getvalue()


def weather_csv(path, *changes, date="11-07-2024"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as f:
        writer = csv.DictWriter(f, schemas.RAW_WEATHER.names)
        writer.writeheader()
        for change in changes:
            base = {n: "1.5" for n in schemas.RAW_WEATHER.names}
            readings = {k.upper(): v for k, v in DAY.items() if k != "trip_date"}
            writer.writerow({**base, **readings, "DATE": date, **change})


def test_csv_folders_are_read_recursively_as_text(spark, tmp_path):
    for month in ("01", "02"):
        folder = tmp_path / month
        folder.mkdir()
        (folder / "a.csv").write_text(trip_csv({"ride_id": month}, {"ride_id": month + "b", "end_lat": ""}))
    got = read_trips(spark, str(tmp_path))
    assert rows(got, "ride_id", "start_station_id", "end_lat")[:2] == [
        ("01", "5379.1", "40.72"), ("01b", "5379.1", None),
    ]
    assert got.count() == 4 and set(t for _, t in got.dtypes) == {"string"}
    one = read_trip_files(spark, [str(tmp_path / "01" / "a.csv"), str(tmp_path / "02" / "a.csv")])
    assert one.count() == 4


def test_wrong_header_is_an_error(spark, tmp_path):
    swapped = ["rideable_type", "ride_id", *HEADER[2:]]
    (tmp_path / "a.csv").write_text(trip_csv({}, header=swapped))
    with pytest.raises(Exception, match="(?i)header"):
        read_trips(spark, str(tmp_path)).collect()


def archive(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_zip_archives(spark, tmp_path):
    archive(tmp_path / "202401.zip", {"a.csv": trip_csv({"ride_id": "1", "end_station_id": ""}), "sub/b.csv": trip_csv({"ride_id": "2"})})
    # Another column order, and a column that is not known.
    archive(tmp_path / "202402.zip", {"c.csv": trip_csv({"ride_id": "3"}, header=["note", *reversed(HEADER)])})
    archive(tmp_path / "empty.zip", {"readme.txt": "nothing here"})
    (tmp_path / "other.csv").write_text("not,a,trip\n")
    got = read_trip_zips(spark, str(tmp_path))
    assert rows(got, "ride_id", "start_station_id", "end_station_id") == [
        ("1", "5379.1", None), ("2", "5379.1", "5164.05"), ("3", "5379.1", "5164.05"),
    ]
    staged = fresh_path(spark, "staged")
    variants.stage_archives(spark, str(tmp_path), staged)
    stored = spark.read.parquet(staged)
    assert rows(stored.groupBy(variants.STAGE).count()) == [(202401, 2), (202402, 1)]
    assert dict(stored.dtypes)["started_at"] == "timestamp"


def test_packing_is_undone_by_unpacking(spark):
    raw = raw_trips(spark, {"ride_id": "a", "end_lat": None}, {"ride_id": "b", "start_station_name": 'Q "x", y'})
    back = unzip_trips(zip_rows(raw.repartition(2)))
    assert rows(back.drop("source")) == rows(raw)


def test_season_job(spark, tmp_path):
    zips = tmp_path / "zips"
    zips.mkdir()
    archive(zips / "m.zip", {"a.csv": trip_csv({"start_lng": "-73.9"}, {"ride_id": "west", "start_lng": "-74.1"})})
    weather_csv(tmp_path / "w.csv", {}, date="2024-07-11")
    out = fresh_path(spark, "season")
    variants.zips_to_season_table(spark, str(zips), str(tmp_path / "w.csv"), fresh_path(spark, "staged"), out)
    table = spark.read.parquet(out)
    assert rows(table, "ride_id", "season", "temp", "dewp", "is_rain", "sndp") == [("r1", "summer", 76.2, 1.5, 1, 0.0)]
    assert "station" not in table.columns and "temp_attributes" not in table.columns


def test_yearly_job_from_raw_files(spark, tmp_path):
    layout = Layout(str(tmp_path))
    folder = tmp_path / "raw" / "trips" / "2024"
    folder.mkdir(parents=True)
    (folder / "202407.csv").write_text(trip_csv({}, {"ride_id": "bad", "ended_at": "x"}))
    weather_csv(tmp_path / "raw" / "weather" / "2024_weather.csv", {}, {})
    lake.raw_to_silver(spark, layout.root, 2024)
    assert rows(lake.read_silver(spark, layout.root), "ride_id", "temp", "is_holiday") == [("r1", 76.2, False)]
    assert lake.silver_to_gold(spark, layout.root) == {"silver_rows": 1, "fact_rows": 1}


def test_missing_layer_is_empty_but_other_errors_surface(spark, tmp_path):
    absent = read_or_empty(spark, str(tmp_path / "none"), schemas.DIM_MEMBER)
    assert absent.count() == 0 and absent.schema == schemas.DIM_MEMBER
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part.parquet").write_text("this is not parquet")
    with pytest.raises(Exception):
        read_or_empty(spark, str(broken), schemas.DIM_MEMBER).collect()


def test_sql_and_views_over_a_path(spark):
    path = fresh_path(spark, "raw")
    raw_trips(spark, {}, {"ride_id": "2", "start_lat": "?"}).write.parquet(path)
    assert sql_over_path(spark, path, "SELECT count(*) AS n FROM {source}").first().n == 2
    typed_view(spark, path, schemas.TYPED_TRIPS, "typed_trips")
    got = spark.sql("SELECT ride_id, start_lat FROM typed_trips")
    assert rows(got) == [("2", None), ("r1", 40.71)]


def test_dynamic_overwrite_keeps_other_partitions(spark):
    path = fresh_path(spark, "layer")
    base = spark.createDataFrame([(1, 2023), (2, 2024)], "x int, year int")
    write_partitioned(base, path, ["year"])
    write_partitioned(spark.createDataFrame([(9, 2024)], "x int, year int"), path, ["year"])
    assert rows(spark.read.parquet(path)) == [(1, 2023), (9, 2024)]
    write_partitioned(spark.createDataFrame([(7, 2025)], "x int, year int"), path, ["year"], dynamic=False)
    assert rows(spark.read.parquet(path)) == [(7, 2025)]


def test_file_count_bound(spark, tmp_path):
    path = str(tmp_path / "bounded")
    write_layer(spark.range(100).repartition(9), path, max_files=3)
    assert len(list((tmp_path / "bounded").glob("*.snappy.parquet"))) == 3
    write_layer(spark.range(50), path)
    assert spark.read.parquet(path).count() == 50


def test_tables_and_schema_replacement(spark):
    save_table(spark.range(2), "plain_rows")
    save_table(spark.range(3), "plain_rows")
    assert read_table(spark, "plain_rows").count() == 3
    wider = read_table(spark, "plain_rows").withColumn("t", F.lit("x"))
    save_table(wider, "plain_rows", replace_schema=True)
    assert read_table(spark, "plain_rows").columns == ["id", "t"]
    spark.sql("DROP TABLE plain_rows")


def test_feature_table(spark):
    trips = cast_trips(raw_trips(spark, {}, {"ride_id": "x", "ended_at": None}))
    joined = trips.withColumn("trip_distance", F.lit(1.0)).crossJoin(days(spark, {}))
    save_table(joined, "joined_rows")
    variants.feature_table(spark, "joined_rows", "feature_rows")
    variants.feature_table(spark, "joined_rows", "feature_rows")
    assert rows(read_table(spark, "feature_rows"), "ride_id", "wind_category") == [("r1", "low")]
    for name in ("joined_rows", "feature_rows"):
        spark.sql(f"DROP TABLE {name}")


def test_catalog_registration(spark):
    root = fresh_path(spark, "lake")
    silver = build_silver(cast_trips(raw_trips(spark, {})), days(spark, {}))
    write_partitioned(silver, Layout(root).silver("a"), lake.BY_MONTH)
    lake.silver_to_gold(spark, root)
    register_gold(spark, "mart", lake.gold_tables(spark, root))
    register_silver(spark, "mart", root)
    assert spark.table("mart.fact_trips").count() == spark.table("mart.silver_trips").count() == 1
    # New partitions appear on the next registration, new columns are added.
    write_partitioned(
        silver.withColumns({"year": F.lit(2025), "ride_id": F.lit("r2")}), Layout(root).silver("b"), lake.BY_MONTH
    )
    assert register_silver(spark, "mart", root) == []
    assert rows(spark.table("mart.silver_trips"), "year", "ride_id") == [(2024, "r1"), (2025, "r2")]
    grown = T.StructType([*schemas.DIM_MEMBER.fields, T.StructField("label", T.StringType())])
    lake.read_gold(spark, root)["dim_member"].write.parquet(f"{root}/members")
    assert register(spark, "mart.members", f"{root}/members", schemas.DIM_MEMBER) == []
    assert register(spark, "mart.members", f"{root}/members", grown) == ["label"]
    assert spark.table("mart.members").columns == ["member_key", "member_casual", "label"]
    # The catalog follows the versions: a month written again is there once.
    lake.silver_to_gold(spark, root, ["a"])
    register_gold(spark, "mart", lake.gold_tables(spark, root))
    assert rows(spark.table("mart.fact_trips"), "ride_id", "year", "month") == [("r1", 2024, 7)]
    assert spark.table("mart.dim_member").columns == ["member_key", "member_casual", "write"]


def test_materialised_rows_survive_their_source(spark):
    stored = materialise(spark.range(5), "kept")
    assert rows(stored) == [(i,) for i in range(5)]


def test_a_month_holding_most_rows_is_written_whole(spark, tmp_path):
    skewed = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id") % 12 + 1).cast("int").alias("month")
    )
    path = str(tmp_path / "skewed")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "40k")
    try:
        write_partitioned(skewed, path, ["month"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = spark.read.parquet(path)
    assert rows(back.groupBy("month").count()) == rows(skewed.groupBy("month").count())
    assert len(list((tmp_path / "skewed" / "month=7").glob("*.parquet"))) > 1
