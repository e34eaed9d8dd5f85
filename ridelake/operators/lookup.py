"""LEFT lookups that broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest lookup side sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 16


def payload_bytes(df: DataFrame) -> int:
    """Approximate in-memory size of ``df``, by one aggregate over it."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    fixed = _ROW_OVERHEAD + 8 * len(df.columns)
    size = F.count("*") * fixed
    for name in texts:
        size = size + F.coalesce(F.sum(F.octet_length(name)), F.lit(0))
    return df.agg(size.alias("size")).first()["size"]


def fits(lookup: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a stored lookup table measures at most ``limit`` bytes."""
    return payload_bytes(lookup) <= limit


def sized(lookup: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``lookup``, marked for broadcast if it fits.

    A larger one is returned as it is: the planner then joins by shuffle, where
    adaptive execution splits the partitions of hot keys. ``lookup`` should be
    a stored table, since it is read once more to be measured.
    """
    return F.broadcast(lookup) if fits(lookup, limit) else lookup


def left_lookup(rows: DataFrame, lookup: DataFrame, on: str | list[str]) -> DataFrame:
    """Add the columns of ``lookup`` (unique in ``on``) to every row."""
    return rows.join(lookup, on, "left")
