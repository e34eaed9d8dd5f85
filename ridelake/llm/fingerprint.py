"""One-permutation MinHash with optimal densification and packed low-order bits.

A text's word 5-shingles are hashed once. The hash's high bits choose one of ``BINS`` bins, whose least
remaining value is kept; an empty bin takes the value of the first non-empty bin on its own pseudo-random walk
(the same walk for every text). The low ``BITS`` bits of each bin, one byte each, are the fingerprint. The share of
equal bytes estimates the Jaccard similarity after the share that agrees by chance is taken off.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import mix64, parts, shingle_hashes, sliced, tidily

WIDTH = 5  # words in a shingle
BINS = 512
BITS = 8
STEPS = 64  # of the walk taken together by all texts
_SHIFT = np.uint64(64 - (BINS.bit_length() - 1))


def _met(step: int) -> np.ndarray:
    """The bin that each empty bin looks at in a step of its walk."""
    seed = np.arange(BINS, dtype=np.uint64) + np.array([step], dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)
    return (mix64(seed) % np.uint64(BINS)).astype(np.int64)


@lru_cache(maxsize=1)
def _walks() -> np.ndarray:
    """For each bin, the step of its walk that meets each other bin first."""
    first = np.zeros((BINS, BINS), dtype=np.int32)
    step, own = 0, np.arange(BINS)
    while not first.all():
        step += 1
        at = _met(step)
        new = first[own, at] == 0
        first[own[new], at[new]] = step
    return first


def fingerprints(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One row of ``BINS`` bytes per text, and whether it has any word. Without words the row is zero."""
    hashes, begin = shingle_hashes(texts, WIDTH)
    n = len(begin) - 1
    least = np.full(n * BINS, np.iinfo(np.uint64).max, dtype=np.uint64)
    text = np.repeat(np.arange(n, dtype=np.int64), np.diff(begin))
    np.minimum.at(least, text * BINS + (hashes >> _SHIFT).astype(np.int64), hashes << np.uint64(BINS.bit_length() - 1) >> np.uint64(1))
    least = least.reshape(n, BINS)
    full = least != np.iinfo(np.uint64).max
    low = ((least >> np.uint64(8)) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    some = full.any(axis=1)
    low[~some] = 0
    todo, step = np.flatnonzero(some & ~full.all(axis=1)), 0
    filled = full.copy()
    while len(todo) and step < STEPS:
        step += 1
        at = _met(step)
        take = ~filled[todo] & full[todo][:, at]
        low[todo] = np.where(take, low[todo][:, at], low[todo])
        filled[todo] |= take
        if step % 8 == 0:
            todo = todo[~filled[todo].all(axis=1)]
    for row in todo:  # what is still empty goes straight to the full bin that its walk meets first
        empty, there = np.flatnonzero(~filled[row]), np.flatnonzero(full[row])
        low[row, empty] = low[row, there[_walks()[np.ix_(empty, there)].argmin(axis=1)]]
    return low, some


def likeness(a: np.ndarray, b: np.ndarray, a_some: np.ndarray, b_some: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity, 0 to 1, row by row; two empty sets are alike, one is not like another."""
    chance = 1.0 / (1 << BITS)
    est = np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0.0, 1.0)
    return np.where(a_some & b_some, est, (a_some == b_some).astype(float))


def compare_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The next document follows by descending integer key; after the last comes the first. The edited text is the
    text with its last floor(n_chars / 2) code points replaced by as many from the beginning of the next one (or
    all of it). Null texts are empty. Rows with equal keys follow each other by text. Rows with a null key have no next:
    nothing replaces what is cut off, and ``near_next`` is null. A lone row is its own next.

    Rows are dealt to ranges of keys; the first row of each range is sent to the range before as well, so
    each range finds its last row's next one. Only the ranges' first keys reach the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    n = parts(spark)
    wanted = [k / (4 * n) for k in range(1, 4 * n)]
    held = rows.agg(F.percentile_approx("key", wanted, 100 * n).alias("cuts"), F.max("key").alias("top")).first()
    heads = np.array(sorted({*(held["cuts"] or []), held["top"]} - {None}), dtype=np.int64)  # greatest key of each range

    def deal(batches):
        turn = 0
        for batch in batches:
            keys = batch.column("key")
            known = keys.is_valid().to_numpy(zero_copy_only=False)
            value = keys.fill_null(0).to_numpy()
            bucket = np.searchsorted(heads, value)
            bucket[~known] = len(heads) + (turn + np.arange((~known).sum())) % n
            turn += 1
            again = np.flatnonzero(known & (heads[np.minimum(bucket, len(heads) - 1)] == value) if len(heads) else known)
            take = pa.array(np.concatenate([np.arange(len(value)), again]))
            where = np.concatenate([bucket, (bucket[again] + 1) % max(len(heads), 1)])
            extra = np.arange(len(take)) >= len(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(where.astype(np.int32)), pa.array(extra), keys.take(take), batch.column("text").take(take)], names=["bucket", "extra", "key", "text"]
            )

    schema = pa.schema(
        [("key", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )

    def answer(batch: pa.RecordBatch, whole: bool) -> pa.RecordBatch:
        """Rows with their next row behind them; the last one only serves the one before unless ``whole``."""
        keys, texts = batch.column("key").to_pylist(), batch.column("text").to_pylist()
        bucket, extra = batch.column("bucket").to_pylist(), batch.column("extra").to_pylist()
        out = [k for k in range(len(keys) - (not whole)) if not extra[k]]
        edited, follows = [], []
        for k in out:
            next_there = keys[k] is not None and k + 1 < len(keys) and bucket[k + 1] == bucket[k] and keys[k + 1] is not None
            half = len(texts[k]) // 2
            edited.append(texts[k][: len(texts[k]) - half] + (texts[k + 1][:half] if next_there else ""))
            follows.append(k + 1 if next_there else -1)
        own, some = fingerprints(batch.column("text"))
        new, new_some = fingerprints(pa.array(edited, pa.string()))
        out, follows = np.array(out, dtype=np.int64), np.array(follows, dtype=np.int64)
        near_next = likeness(own[out], own[follows], some[out], some[follows]) if len(out) else np.zeros(0)
        raw = lambda prints, there: pa.array([p.tobytes() if s else b"" for p, s in zip(prints, there)], pa.binary())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("key").take(pa.array(out)),
                pa.array([len(texts[k]) for k in out], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                raw(own[out], some[out]),
                raw(new, new_some),
                pa.array(likeness(own[out], new, some[out], new_some)),
                pa.array(near_next, mask=follows < 0),
            ],
            schema=schema,
        )

    def walk(batches):
        rest = None
        for batch in sliced(batches, "text", 2 << 20):
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0] if rest is not None else batch
            rest = batch.slice(batch.num_rows - 1)
            if batch.num_rows > 1:
                yield answer(batch, False)
        if rest is not None:
            yield answer(rest, True)

    dealt = rows.mapInArrow(tidily(deal), "bucket int, extra boolean, key long, text string").repartition(n, "bucket")
    ordered = dealt.sortWithinPartitions("bucket", "extra", F.col("key").desc_nulls_last(), "text")
    return ordered.mapInArrow(tidily(walk), "key long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double").withColumnRenamed("key", key)
