import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from ridelake.operators.clean import first_per_key, replace_sentinel
from ridelake.operators.lookup import fits, left_lookup, payload_bytes, sized
from ridelake.operators.ordering import number_rows, running_total
from ridelake.session import materialise, shared_folder, together


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_number_rows_is_consecutive_in_order(spark, n):
    names = [f"k{i:05d}" for i in range(n)]
    random.Random(3).shuffle(names)
    df = spark.createDataFrame([(x,) for x in names], "name string").repartition(4)
    got = number_rows(df, [F.col("name")], "key", start=11)
    assert got.schema["key"].dataType.simpleString() == "bigint"
    assert rows(got, "name", "key") == [(x, 11 + i) for i, x in enumerate(sorted(names))]


def test_number_rows_over_several_slices(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = number_rows(spark.range(2000).select(F.col("id").alias("x")), [F.desc("x")], "n")
        assert got.select("n").distinct().count() == 2000
        assert got.filter(F.col("n") + F.col("x") != 2000).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_running_total(spark):
    weights = [(f"s{i}", (i * 37) % 101) for i in range(300)]
    df = spark.createDataFrame(weights, "s string, w bigint")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = running_total(df, [F.desc("w"), F.asc("s")], "w", "total", rank="place").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    total, expected = 0, {}
    for place, (s, w) in enumerate(sorted(weights, key=lambda x: (-x[1], x[0])), start=1):
        total += w
        expected[s] = (total, place)
    assert {r.s: (r.total, r.place) for r in got} == expected


def test_first_per_key_with_a_hot_key(spark):
    hot = spark.range(9000).select(F.lit("hot").alias("k"), F.col("id").alias("v"), F.lit(None).cast("string").alias("t"))
    cold = spark.range(100).select(F.concat(F.lit("c"), "id").alias("k"), "id", F.lit("x"))
    got = first_per_key(hot.union(cold.toDF("k", "v", "t")), ["k"])
    assert got.count() == 101
    assert rows(got.filter("k = 'hot'"), "v", "t") == [(0, None)]


def test_first_per_key_puts_nulls_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "z", 2), ("b", None, 3)], "k string, t string, n int")
    assert rows(first_per_key(df, ["k"]), "k", "t", "n") == [("a", "z", 2), ("b", None, 3)]


def test_lookup_size_check(spark):
    stored = materialise(spark.range(1000).select("id", F.repeat(F.lit("x"), 100).alias("t")), "look")
    assert payload_bytes(stored) >= 100_000
    assert fits(stored) and not fits(stored, limit=1000)
    wide = spark.range(10).select("id")
    for limit in (10**9, 0):
        assert left_lookup(wide, sized(stored, limit), "id").filter("t is null").count() == 0


def test_replace_sentinel(spark):
    df = spark.createDataFrame([(999.9, 999.9)], "a double, b double")
    assert rows(replace_sentinel(df, ["a"])) == [(0.0, 999.9)]


def test_shared_folder_follows_the_setting(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_together_returns_in_order_and_raises(spark):
    assert together(spark, lambda: spark.range(3).count(), lambda: 2) == [3, 2]
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: 1, lambda: 1 // 0)
