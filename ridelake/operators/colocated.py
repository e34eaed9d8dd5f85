"""Lookups beyond broadcast size, by tables that are stored in the same buckets.

A fact and a dimension written here are joined bucket by bucket, as often as wanted, without an exchange or a
salt in the query. A bucket is read by one task, and adaptive execution cannot split what was never shuffled. So keys
with more rows than a bucket should hold are cut into slices when they are stored: the fact's rows are
spread over the slices, and the dimension has its row once for each. Buckets are those of (key, slice).
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.operators.lookup import payload_bytes
from ridelake.session import materialise

BUCKET_BYTES = 256 * 1024 * 1024
SLICE = "key_slice"


def bucket_count(rows: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """How many buckets the measured payload of the stored ``rows`` fills."""
    return max(1, ceil(payload_bytes(rows) / bucket_bytes))


def hot_keys(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """(hot, slices) of the keys with more than a bucket's even share of the rows; these are fewer than ``buckets``."""
    counts = materialise(rows.groupBy(F.col(key).alias("hot")).agg(F.count(F.lit(1)).alias("n")), "key-counts")
    share = max(1, ceil((counts.agg(F.sum("n")).first()[0] or 0) / buckets))
    return counts.filter(F.col("n") > share).select("hot", F.ceil(F.col("n") / share).cast("int").alias("slices"))


def store_colocated(rows: DataFrame, lookup: DataFrame, key: str, table: str, lookup_table: str, path: str, buckets: int | None = None) -> int:
    """Store ``rows`` and ``lookup`` (unique in ``key``) as two tables below ``path``, in the same buckets; returns their number.

    ``rows`` should be a stored table: it is read to be measured, counted by key and written. A null key is
    spread like any other, and finds nothing.
    """
    buckets = buckets or bucket_count(rows)
    hot = F.broadcast(materialise(hot_keys(rows, key, buckets), "hot-keys"))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.col("slices")).cast("int")
    sliced = rows.join(hot, F.col(key).eqNullSafe(F.col("hot")), "left").select(*rows.columns, F.coalesce(spread, F.lit(0)).alias(SLICE))
    slices = F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)
    repeated = lookup.join(hot, F.col(key).eqNullSafe(F.col("hot")), "left").select(*lookup.columns, F.explode(slices).alias(SLICE))
    for part, name in ((sliced, table), (repeated, lookup_table)):
        # dealt as the buckets are, so that each has one file
        dealt = part.repartition(buckets, key, SLICE)
        writer = dealt.write.bucketBy(buckets, key, SLICE).sortBy(key, SLICE).mode("errorifexists")
        writer.option("path", f"{path}/{name.rsplit('.', 1)[-1]}").saveAsTable(name)
    return buckets


def colocated_lookup(spark: SparkSession, key: str, table: str, lookup_table: str) -> DataFrame:
    """The stored rows with the columns of their lookup row, if there is one; nothing is shuffled."""
    return spark.table(table).join(spark.table(lookup_table).hint("merge"), [key, SLICE], "left").drop(SLICE)
