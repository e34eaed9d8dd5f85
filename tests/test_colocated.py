"""Lookups between tables of the same buckets."""

from collections import Counter

import pytest
from helpers import rows
from pyspark.sql import functions as F

from ridelake.operators import colocated
from ridelake.session import fresh_path


@pytest.fixture
def stored(spark):
    """A third of 6,000 rows has one key, a sixth none, and one key is not in the lookup."""
    path = fresh_path(spark, "colocated")
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 == 1, None).otherwise((F.col("id") % 200).cast("int"))
    fact = spark.range(6000).select(key.alias("k"), "id")
    lookup = spark.range(199).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    tag = path.rsplit("-", 1)[-1]
    names = (f"fact_{tag}", f"lookup_{tag}")
    assert colocated.store_colocated(fact, lookup, "k", *names, path, buckets=8) == 8
    yield fact, lookup, names
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_lookup_is_right_and_moves_nothing(spark, stored):
    fact, lookup, names = stored
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a lookup beyond any broadcast
    try:
        found = colocated.colocated_lookup(spark, "k", *names)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
        assert rows(found, "k", "id", "name") == rows(fact.join(lookup, "k", "left"), "k", "id", "name")
        counted = found.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
        assert counted.count("Exchange") <= 1  # of the partial counts
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_keys_are_spread_over_buckets(spark, stored):
    _, lookup, names = stored
    sizes = Counter(r[0] for r in spark.table(names[0]).select(F.regexp_extract(F.input_file_name(), r"_(\d{5})\.c", 1)).collect())
    assert sum(sizes.values()) == 6000 and max(sizes.values()) <= 3 * 6000 / 8  # whole, the hot key's bucket would have over 2000 + rest
    slices = rows(spark.table(names[0]).filter("k = 7").select(colocated.SLICE).distinct())
    assert len(slices) == 3 and rows(spark.table(names[1]).filter("k = 7").select(colocated.SLICE)) == slices
    assert spark.table(names[1]).count() == lookup.count() + 2


def test_empty_tables(spark):
    path = fresh_path(spark, "colocated-empty")
    empty = spark.createDataFrame([], "k int, id bigint")
    colocated.store_colocated(empty, empty.select("k"), "k", "empty_fact", "empty_lookup", path)
    assert colocated.colocated_lookup(spark, "k", "empty_fact", "empty_lookup").count() == 0
    for name in ("empty_fact", "empty_lookup"):
        spark.sql(f"DROP TABLE {name}")
