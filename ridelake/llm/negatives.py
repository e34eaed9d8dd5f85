"""Hard negatives of anchor vectors by Fagin's threshold algorithm.

Candidates are dealt to blocks of about ``ROWS``; a block keeps one list of its candidates for every dimension, sorted by that component.
An anchor reads all lists at the same depth, each from the end that its own component's sign prefers; a candidate met for the
first time is scored at once by its whole integer product with the anchor. No candidate that is still unseen can score more
than the threshold, the anchor's product with the components last read. A window of scores is done once the threshold is
strictly below its k-th best score so far, or below the window.

First the anchors meet blocks of their own label, for their positives. These fix the windows in which they then meet all
blocks. Anchors go to blocks in groups of about ``ANCHORS``, by a shuffle of blocks and groups; a label with any share of the rows is as
many blocks as it needs, and labels with few rows share blocks. A block returns k rows a window at most; the best of all blocks
are picked by a window function that limits each task's rows before the shuffle.

Rows with a null key, label or vector, or with null or non-finite components take no part. Vectors of different lengths
do not meet. Rows that are equal in all three count once; others with equal keys are rows of their own, but a row never meets one
with its own key. Ties go by key. Scaled components beyond 2 ** 25 raise an error: products are exact integers. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.common import parts
from ridelake.operators.lookup import sized
from ridelake.session import materialise

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # percent of the positive's score that a negative may have
ROWS, ANCHORS = 8192, 1024
FIRST_DEPTH = 16  # rows read of each list at first; then as many again as were read so far
LARGEST = 1 << 25


class Lists:
    """Candidates of one block with a sorted list for each dimension."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.order = np.argsort(x.T, axis=1, kind="stable")
        self.value = np.take_along_axis(x.T, self.order, axis=1)
        self.size = int(np.abs(x).max(initial=0))

    def read(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """(rows met for the first time, their scores, threshold below them), step by step; an unseen row scores at most the threshold."""
        n, d = self.x.shape
        exact = d * self.size * int(np.abs(anchor).max(initial=0)) < 1 << 53
        x, a = (self.x.astype(np.float64), anchor.astype(np.float64)) if exact else (self.x.astype(np.int64), anchor.astype(np.int64))
        up, down = np.flatnonzero(anchor < 0), np.flatnonzero(anchor > 0)
        if not len(up) + len(down):
            yield np.arange(n), np.zeros(n, dtype=np.int64), -1
            return
        seen, depth, step = np.zeros(n, dtype=bool), 0, FIRST_DEPTH
        while depth < n:
            upto = min(n, depth + step)
            met = np.zeros(n, dtype=bool)
            met[self.order[up, depth:upto].ravel()] = True
            met[self.order[down, n - upto : n - depth].ravel()] = True
            met &= ~seen
            seen |= met
            rows = np.flatnonzero(met)
            threshold = int(self.value[up, upto - 1] @ a[up]) + int(self.value[down, n - upto] @ a[down])
            yield rows, (x[rows] @ a).astype(np.int64), threshold
            if seen.all():
                return
            depth, step = upto, upto


def best(lists: Lists, keys: np.ndarray, allowed: np.ndarray, anchor: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
    """Of each window of scores the first ``k`` allowed (score, key), high scores first, ties by key."""
    found: list[list[tuple[int, int]]] = [[] for _ in windows]
    waiting = list(range(len(windows)))
    for rows, scores, threshold in lists.read(anchor):
        ok = allowed[rows]
        rows, scores = rows[ok], scores[ok]
        for w in waiting:
            low, high = windows[w]
            at = np.flatnonzero((scores >= low) & (scores <= high))
            if len(at) > 4 * k:
                at = at[scores[at] >= np.partition(scores[at], len(at) - k)[len(at) - k]]
            if len(at):
                found[w] = sorted(found[w] + list(zip(scores[at].tolist(), keys[rows[at]].tolist())), key=lambda x: (-x[0], x[1]))[:k]
        waiting = [w for w in waiting if threshold >= windows[w][0] and (len(found[w]) < k or threshold >= found[w][-1][0])]
        if not waiting:
            break
    return found


def _cells(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal ``by``, as whole tables."""
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in by], axis=1)
        cuts = [0, *(np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            here = tuple(cell[start].tolist())
            if here != now and held:
                yield pa.Table.from_batches(held)
                held = []
            now = here
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)


def _matrix(table: pa.Table, rows: np.ndarray, width: int) -> np.ndarray:
    column = table.column("x").combine_chunks().take(pa.array(rows))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), width).astype(np.int64)


_FOUND = pa.schema([("row", pa.int64()), ("window", pa.int64()), ("key", pa.int64()), ("score", pa.int64())])


def _answers(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 4, _FOUND)], schema=_FOUND)


def _search(cell: pa.Table, same: bool, k: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """The anchors of one cell against its candidates: of the same label, in one open window, or of others, in the window of each positive's score."""
    is_anchor = cell.column("is_anchor").to_numpy()
    width = cell.column("width").to_numpy()
    label = cell.column("label").to_numpy()
    keys, row = cell.column("key").to_numpy(), cell.column("row").to_numpy()
    windows_of = cell.column("windows").combine_chunks()
    # lists of one length, and of one label where only that is wanted
    kinds: dict[tuple, list[int]] = {}
    for at, kind in enumerate(zip(width.tolist(), label.tolist() if same else [None] * len(label))):
        kinds.setdefault(kind, []).append(at)
    for (n, _), members in kinds.items():
        members = np.array(members)
        candidates, anchors = members[~is_anchor[members]], members[is_anchor[members]]
        if not len(candidates) or not len(anchors):
            continue
        lists = Lists(_matrix(cell, candidates, n))
        out = []
        for at, a in zip(anchors, _matrix(cell, anchors, n)):
            allowed = keys[candidates] != keys[at]
            if same:
                scores, windows = [0], [(-(1 << 62), 1 << 62)]
            else:
                allowed &= label[candidates] != label[at]
                scores = windows_of[int(at)].as_py()
                windows = [(-(-low * p // 100), high * p // 100) for p in scores]
            for p, top in zip(scores, best(lists, keys[candidates], allowed, a, windows, k)):
                out += [(int(row[at]), p, key, score) for score, key in top]
        yield _answers(out)


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_rows: int = ROWS,
    group_anchors: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor row and each of its first
    ``positives`` rows of equal label, the first ``negatives`` rows of other labels with ``low`` to ``high`` percent of the positive's score."""
    n_parts = parts(rows.sparkSession)
    named = rows.select(
        F.col(f"`{key}`").cast("long").alias("key"),
        (F.col(f"`{label}`") if isinstance(label, str) else label).cast("string").alias("label"),
        F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double") * scale).alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = named.where(F.col("key").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(finite)
    whole = F.transform("v", lambda x: F.when(F.abs(x) <= LARGEST, F.floor(x).cast("int")).otherwise(F.raise_error(F.lit("a scaled component is beyond 2 ** 25")).cast("int")))
    one = usable.select("key", "label", whole.alias("x"), "anchor").groupBy("key", "label", "x").agg(F.max("anchor").alias("anchor"))
    one = materialise(one.withColumn("row", F.monotonically_increasing_id()).withColumn("width", F.size("x")), "vectors")
    n = one.count()
    bucket = F.pmod(F.xxhash64("label", "width"), F.lit(max(1, -(-n // block_rows))))
    dealt = one.withColumn("bucket", bucket)
    sizes = materialise(dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("n_anchors")).where("n_anchors > 0"), "bucket-sizes")
    blocks, groups = F.ceil(F.col("n") / block_rows).cast("long"), F.ceil(F.col("n_anchors") / group_anchors).cast("long")
    sizes = sizes.select("bucket", blocks.alias("blocks"), groups.alias("groups"))
    share = lambda seed, count: F.pmod(F.xxhash64("row", F.lit(seed)), count)
    each = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), count - 1))
    none = F.lit(None).cast("array<long>")

    def met(candidates: DataFrame, anchors: DataFrame, by: list[str], same: bool, k: int) -> DataFrame:
        columns = [*by, "is_anchor", "row", "key", "label", "width", "x", "windows"]
        both = candidates.withColumn("is_anchor", F.lit(False)).withColumn("windows", none).select(columns).union(anchors.withColumn("is_anchor", F.lit(True)).select(columns))
        cells = both.repartition(n_parts, *by).sortWithinPartitions(*by)

        def search(batches):
            for cell in _cells(batches, by):
                yield from _search(cell, same, k, low, high)

        return cells.mapInArrow(search, "row long, window long, key long, score long")

    near = dealt.join(sized(sizes), "bucket")
    found = met(
        near.withColumn("block", share(1, F.col("blocks"))).withColumn("group", each(F.col("groups"))),
        near.where("anchor").withColumn("group", share(2, F.col("groups"))).withColumn("block", each(F.col("blocks"))).withColumn("windows", none),
        ["bucket", "block", "group"],
        True,
        positives,
    )
    chosen = materialise(_first(found, ["row"], positives).select("row", F.col("key").alias("positive_id"), F.col("score").alias("window")), "positives")
    asked = chosen.groupBy("row").agg(F.collect_set("window").alias("windows"))  # at most ``positives`` numbers
    anchors = materialise(one.where("anchor").join(asked, "row"), "anchors")
    n_blocks, n_groups = F.lit(max(1, -(-n // block_rows))).cast("long"), F.lit(max(1, -(-anchors.count() // group_anchors))).cast("long")
    found = met(
        one.withColumn("block", share(3, n_blocks)).withColumn("group", each(n_groups)),
        anchors.withColumn("group", share(4, n_groups)).withColumn("block", each(n_blocks)),
        ["block", "group"],
        False,
        negatives,
    )
    last = _first(found, ["row", "window"], negatives).withColumnRenamed("key", "negative_id").withColumnRenamed("score", "negative_score")
    ids = anchors.select("row", F.col("key").alias("anchor_id"))
    return last.join(chosen, ["row", "window"]).join(ids, "row").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", F.col("window").alias("positive_score"), "negative_score"
    )
