"""Global numbering and running totals without a single-task window.

A window without PARTITION BY moves every row into one task. Here the rows are
range partitioned by the order instead, each partition is sorted and numbered
alone, and one offset per partition joins the pieces. The offsets are as many as
there are partitions, whatever the data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.session import materialise

_SLICE, _PLACE = "__slice", "__place"


def _sliced(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` with its slice number and its place in the slice, stored.

    Stored, because a range partitioning samples its bounds and must not be
    drawn twice. The generated id holds the partition in its upper 31 bits and
    the row within the partition in its lower 33.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = ranged.withColumn("__id", F.monotonically_increasing_id())
    return materialise(
        numbered.withColumns(
            {
                _SLICE: F.shiftright("__id", 33),
                _PLACE: F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)),
            }
        ).drop("__id"),
        "ranged",
    )


def _offsets(per_slice: DataFrame, value: str) -> DataFrame:
    """Sum of ``value`` over all earlier slices; one row per slice."""
    earlier = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return per_slice.select(
        _SLICE, F.coalesce(F.sum(value).over(earlier), F.lit(0)).alias("__offset")
    )


def number_rows(df: DataFrame, order: list[Column], name: str, start: int = 1) -> DataFrame:
    """Consecutive bigint numbers from ``start`` in the given total order."""
    sliced = _sliced(df, order)
    offsets = _offsets(sliced.groupBy(_SLICE).agg(F.count("*").alias("__n")), "__n")
    number = F.col("__offset") + F.col(_PLACE) + F.lit(start)
    return sliced.join(F.broadcast(offsets), _SLICE).select(
        *df.columns, number.cast("bigint").alias(name)
    )


def running_total(
    df: DataFrame, order: list[Column], value: str, name: str, rank: str | None = None
) -> DataFrame:
    """Running sum of ``value`` in the given total order, optionally with the rank."""
    sliced = _sliced(df, order)
    per_slice = sliced.groupBy(_SLICE).agg(
        F.sum(value).alias("__total"), F.count("*").alias("__n")
    )
    earlier = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        _SLICE,
        F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__before"),
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__rows_before"),
    )
    within = Window.partitionBy(_SLICE).orderBy(_PLACE).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    columns = [
        *df.columns,
        (F.sum(value).over(within) + F.col("__before")).alias(name),
    ]
    if rank:
        columns.append((F.col(_PLACE) + F.col("__rows_before") + 1).alias(rank))
    return sliced.join(F.broadcast(offsets), _SLICE).select(*columns)
