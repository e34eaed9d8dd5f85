"""Shared helpers: sliced Arrow input, byte-level word hashing, graph components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.session import materialise

# Bytes of text that a task turns into arrays at a time. Arrow batches are cut to
# it, so that a task's memory follows this figure and its longest text only.
SLICE_BYTES = 2 << 20
# Most bytes of an Arrow batch. Spark's own bound is 64 MB, which a task holds in its JVM, in buffers of the next power of two, and again in Python.
BATCH_BYTES = 4 * SLICE_BYTES
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of this session end at ``BATCH_BYTES``, unless it has a bound of its own. Rows are the same."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``docs`` is called so."""
    while name in docs.columns:
        name += "_"
    return name


def sliced(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with at most ``most`` bytes in ``column`` (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        end, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            base = end[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(end, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def tidily(task: Callable) -> Callable:
    """``task`` (a function of Arrow batches); when it ends, its worker gives back the memory it took.

    Workers outlive tasks and queries. What the allocators of Python and Arrow keep for later adds up over the stages
    of a pipeline, next to a JVM that needs the room.
    """

    @wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            _powers.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
            if trim is not None:
                trim(0)

    return run


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )


def mix64(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; the longest run is kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


def _byte_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each byte's random weight, the same with A-Z as a-z, and whether the byte separates words."""
    weight = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    folded = weight.copy()
    folded[65:91] = weight[97:123]
    gap = np.zeros(256, dtype=bool)
    gap[[0x20, *range(0x09, 0x0E)]] = True
    return weight, folded, gap


_WEIGHT, _FOLDED, _GAP = _byte_tables()


def words_of(texts: pa.Array, fold: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text: all bytes, each word's first byte and end, its hash, and each text's first word.

    Words are runs of other bytes than space and 09-0D; no byte of a multi-byte UTF-8 sequence is one of these.
    A word's 64-bit hash is a polynomial over its bytes, taken from one running sum over all texts; with ``fold``
    A-Z count as a-z. Null texts have no words.
    """
    texts = texts.cast(pa.large_binary())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    cuts = offsets - offsets[0]
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return data, none, none, none.astype(np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    inside = ~_GAP[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    inner = cuts[:-1][cuts[:-1] < len(data)]
    first[inner] = inside[inner]
    final = inside.copy()
    final[:-1] &= ~inside[1:]
    final[inner[inner > 0] - 1] = inside[inner[inner > 0] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(final) + 1
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_FOLDED if fold else _WEIGHT)[data] * _power(_BASE, len(data)), out=total[1:])
    hashes = mix64((total[ends] - total[starts]) * _power(_UNBASE, len(data))[starts] + (ends - starts).astype(np.uint64))
    return data, starts, ends, hashes, np.searchsorted(starts, cuts)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, A-Z lower-cased, and where each text's words begin."""
    return words_of(texts, True)[3:]


def shingle_hashes(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word ``width``-shingles in order (repeats included) and each text's first.

    A text with fewer words is one shingle, the whole sequence; without words it has none.
    """
    words, begin = word_hashes(texts)
    count = np.diff(begin)
    have = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
    out_begin = np.concatenate([[0], np.cumsum(have)])
    text = np.repeat(np.arange(len(count)), have)
    at = begin[:-1][text] + (np.arange(out_begin[-1]) - out_begin[:-1][text])
    out = np.zeros(len(at), dtype=np.uint64)
    size = np.minimum(count, width)[text]
    for k in range(width):
        there = k < size
        step = np.zeros(len(at), dtype=np.uint64)
        step[there] = words[at[there] + k]
        out = mix64(out * np.uint64(0xC2B2AE3D27D4EB4F) + step + np.uint64(k + 1)) if k else mix64(step + size.astype(np.uint64))
    return out, out_begin


BLOOM_BITS = 1 << 26  # most bits of a filter over ids (8 MB)


def id_filter(ids: DataFrame, column: str) -> tuple[np.ndarray, int]:
    """A Bloom filter of bounded size over integer ids; what reaches the driver is the filter, in words of 64 bits."""
    count = ids.count()
    bits = min(BLOOM_BITS, 1 << max(12, (16 * max(count, 1)).bit_length()))
    spots = F.explode(F.array(*filter_spots(column, bits)))
    words = ids.select(spots.alias("spot")).groupBy(F.shiftright("spot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(spot & 63 as int)))").alias("mask"))
    held = np.zeros(bits // 64, dtype=np.int64)
    for batch in words.toArrow().to_batches():
        held[batch.column("word").to_numpy()] = batch.column("mask").to_numpy()
    return held.view(np.uint64), bits


def filter_spots(column: str, bits: int) -> list:
    return [F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(bits)).alias(f"__spot{seed}") for seed in range(3)]


def maybe_in(batch: pa.RecordBatch, words: np.ndarray) -> np.ndarray:
    there = np.ones(batch.num_rows, dtype=bool)
    for seed in range(3):
        spot = batch.column(f"__spot{seed}").to_numpy().astype(np.uint64)
        there &= (words[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63)) & np.uint64(1)).astype(bool)
    return there


def without(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``docs`` without the rows whose key is in ``ids`` (one column named like it). Rows that a filter tells apart stay where they are;
    only those it cannot are joined by a shuffle."""
    words, bits = id_filter(ids, key)
    held = docs.sparkSession.sparkContext.broadcast(words)
    names, columns = docs.columns, [f"c{k}" for k in range(len(docs.columns))]
    plain, ids, key = docs.toDF(*columns), ids.withColumnRenamed(key, columns[names.index(key)]), columns[names.index(key)]

    def part(wanted: bool):
        def keep(batches):
            for batch in batches:
                yield batch.select(columns).filter(pa.array(maybe_in(batch, held.value) == wanted))

        return plain.withColumns({f"__spot{k}": c for k, c in enumerate(filter_spots(key, bits))}).mapInArrow(tidily(keep), plain.schema)

    return part(False).union(part(True).join(ids, key, "left_anti").select(columns)).toDF(*names)


def components(edges: DataFrame, left: str, right: str, label: str = "links") -> DataFrame:
    """(node, component): the smallest node reachable over undirected ``edges``.

    Alternating large-star and small-star steps (Kiveris et al., 2014), each an aggregate
    and a join on tables that are stored in the shared folder; a node's neighbours are never
    gathered. Ends when a round changes nothing; needs about log of the longest path rounds.
    Self-loops and nulls are ignored; nodes without an edge are not returned.
    """
    pairs = (
        edges.select(F.col(left).alias("u"), F.col(right).alias("v"))
        .where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    pairs = materialise(pairs, label)
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        pairs = materialise(small, label)
        now = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    ends = pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(pairs.select("v", "v"))
    return ends.groupBy("node").agg(F.min("component").alias("component"))
