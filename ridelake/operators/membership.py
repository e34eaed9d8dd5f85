"""Which stored months may hold an id: Bloom filters kept as bitmaps beside the data.

An id belongs to one block of its month's filter, and sets ``HASHES`` of the block's bits. A block is one of Spark's
bitmaps, built by its aggregate, so a filter is a table with a row for each block: it is written by the job that writes the
month, needs no memory but its rows', and filters of later writes lie beside earlier ones. An id that no filter may
hold is stored nowhere; for the others the ids of only the months named are to be read.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.operators.lookup import sized

BLOCK_BITS = 32_768  # fixed by Spark's bitmap functions
BITS_PER_ID = 32  # four bytes an id: about one false hit in 100,000 ids and filters
HASHES = 8
_BIT_WIDTH = 15  # bits that number one of a block's
_PER_WORD = 4  # such numbers in a bigint


def _block(of: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(of, F.lit(0)), blocks)


def _bits(of: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(of, F.lit(seed)), F.lit(BLOCK_BITS)) for seed in range(1, HASHES + 1)]


def build_filters(ids: DataFrame, by: list[str], column: str) -> DataFrame:
    """(*by, blocks, block, bitmap): a filter over ``column`` for every group of ``by``, of a size that follows its rows.

    A hot group is as many blocks as it needs. Ids, not bitmaps, are shuffled, as one row with all of an id's bits, so neither
    the rows sorted nor those moved depend on how the groups lie among the tasks.
    """
    per_block = BLOCK_BITS // BITS_PER_ID
    size = F.pow(F.lit(2.0), F.ceil(F.log2(F.ceil(F.count(F.lit(1)) / per_block)))).cast("bigint").alias("blocks")
    sizes = ids.groupBy(*by).agg(size)
    spots = ids.join(sized(sizes), by).select(*by, "blocks", _block(F.col(column), F.col("blocks")).alias("block"), *_packed(F.col(column)))
    one = spots.repartition(*by, "block").groupBy(*by, "blocks", "block")
    # a bitmap for each hash, then one of all; positions count from 1
    each = one.agg(*[F.bitmap_construct_agg(F.bitmap_bit_position(bit + 1)).alias(f"bitmap_{k}") for k, bit in enumerate(_unpacked())])
    tall = each.select(*by, "blocks", "block", F.explode(F.array(*[f"bitmap_{k}" for k in range(HASHES)])).alias("bitmap"))
    return tall.groupBy(*by, "blocks", "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def _packed(of: Column) -> list[Column]:
    """An id's bits in few numbers."""
    bits = _bits(of)
    words = [bits[k : k + _PER_WORD] for k in range(0, HASHES, _PER_WORD)]
    return [reduce(Column.bitwiseOR, [F.shiftleft(bit, _BIT_WIDTH * k) for k, bit in enumerate(word)]).alias(f"bits_{w}") for w, word in enumerate(words)]


def _unpacked() -> list[Column]:
    return [F.shiftright(f"bits_{k // _PER_WORD}", _BIT_WIDTH * (k % _PER_WORD)).bitwiseAND(F.lit(BLOCK_BITS - 1)) for k in range(HASHES)]


def _is_set(bitmap: Column, bit: Column) -> Column:
    """Whether a bit is set, by the hexadecimal digit that holds it."""
    byte = F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1)))
    digit = F.substring(byte, F.when(bit % 8 < 4, 2).otherwise(1), F.lit(1))
    value = F.call_function("instr", F.lit("0123456789ABCDEF"), digit) - 1
    return F.call_function("shiftright", value, (bit % 4).cast("int")).bitwiseAND(F.lit(1)) == 1


def possible(ids: DataFrame, filters: DataFrame, by: Iterable[str], column: str) -> DataFrame:
    """(*by, column): the groups whose filters may hold an id of ``ids`` (distinct in ``column``).

    ``filters`` is scanned once and, as long as ``ids`` measures small, not shuffled.
    """
    sizes = sorted(r["blocks"] for r in filters.select("blocks").distinct().collect())  # powers of two: a few dozen at most
    if not sizes:
        return filters.select(*by).where(F.lit(False)).withColumn(column, F.lit(None).cast(ids.schema[column].dataType))
    probes = ids.select(column, F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])).alias("blocks"))
    probes = probes.withColumn("block", _block(F.col(column), F.col("blocks")))
    met = filters.join(sized(probes), ["blocks", "block"])
    held = F.lit(True)
    for bit in _bits(F.col(column)):
        held = held & _is_set(F.col("bitmap"), bit)
    return met.where(held).select(*by, column).distinct()
