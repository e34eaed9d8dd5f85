"""Pack documents' tokens into sequences: patterns of few lengths, fitted to the length histogram.

Lengths are rounded up to ``UNIT`` tokens. Every pattern of up to ``DEPTH`` rounded lengths that fills
a sequence is a column; non-negative least squares finds how often each is repeated so that the patterns
use up the histogram. The repeats are rounded, and what is left over is packed by best fit, still on the
histogram. Only the histogram (as many numbers as a sequence has units) reaches the driver.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.common import sliced, small_batches, tidily, words_of
from ridelake.session import materialise

SEQUENCE = 4096  # tokens
UNIT = 8  # tokens that lengths are rounded up to
DEPTH = 3  # documents in a pattern
SHORT_WEIGHT = 0.1  # of lengths under 1/16 of a sequence in the fit: they can fill gaps later
CACHED = 800_000  # distinct words whose tokens a task keeps
TEXT_BYTES = 512 << 10  # of text that are split into words at a time; the arrays for it take some 50 times as much

_SAFE = re.compile("[!-~À-ÖØ-öø-ÿ]+")
# The tokenizer's own splitting pattern (a fixed value of its file), for these letters in lower case.
_SPLIT = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")


class WordTokens:
    """Token ids of texts; each word between white space is encoded once per task.

    The tokenizer drops white space and joins nothing across it, so a text's ids are those of its words in order.
    Words are told apart by 64-bit hashes, a batch at a time. A new word of ASCII and Latin-1 letters is split by the
    tokenizer's pattern, and each part goes to its merge table; other words, and those with a special token's
    brackets, are encoded by the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.merges = self.whole.model
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.bytes = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self._forget()

    def _forget(self):
        self.known = np.zeros(0, dtype=np.uint64)  # hashes in order
        self.entry = np.zeros(0, dtype=np.int64)  # and the place of each one's ids below
        self.first, self.size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint32)
        # numbers and flat arrays only: millions of small lists would keep the garbage collector busy
        self.parts: dict[str, int] = {}
        self.pool = array("I")

    def _encode(self, word: str, out: array) -> None:
        if not _SAFE.fullmatch(word) or "<|" in word:
            out.extend(self.whole.encode(word, add_special_tokens=False).ids)
            return
        for part in _SPLIT.findall(word.lower()):
            place = self.parts.get(part)
            if place is None:
                start = len(self.pool)
                self.pool.extend([t.id for t in self.merges.tokenize(part.encode().decode("latin-1").translate(self.bytes))])
                self.parts[part] = place = start << 32 | len(self.pool)
            out += self.pool[place >> 32 : place & 0xFFFFFFFF]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin."""
        if len(self.known) > CACHED or len(self.parts) > CACHED // 2:
            self._forget()
        data, starts, ends, hashes, begin = words_of(texts, False)
        unique, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, unique)
        there = at < len(self.known)
        there[there] = self.known[at[there]] == unique[there]
        fresh = np.flatnonzero(~there)
        if len(fresh):
            raw = data.tobytes()
            found, stops = array("I"), array("q", [0])
            for a, b in zip(starts[sample[fresh]].tolist(), ends[sample[fresh]].tolist()):
                self._encode(raw[a:b].decode(), found)
                stops.append(len(found))
            stops = np.array(stops)
            entry = len(self.first) + np.arange(len(fresh))
            self.first = np.append(self.first, len(self.flat) + stops[:-1])
            self.size = np.append(self.size, np.diff(stops))
            self.flat = np.append(self.flat, np.array(found))
            self.known, self.entry = np.insert(self.known, at[fresh], unique[fresh]), np.insert(self.entry, at[fresh], entry)
            at = np.searchsorted(self.known, unique)
        entry = self.entry[at][which]
        size = self.size[entry]
        end = np.cumsum(size)
        ids = self.flat[np.repeat(self.first[entry] - (end - size), size) + np.arange(end[-1] if len(end) else 0)]
        return ids, np.append(0, end)[begin]


@lru_cache(maxsize=1)
def _loaded(path: str) -> WordTokens:
    """One for each worker; what it has learned of words ends with the task."""
    return WordTokens(path)


def cut(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", sequence: int = SEQUENCE, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32, part, nth[, ids]) for every document's tokens and an end id.

    Only documents longer than ``sequence`` are cut, into pieces of that and a shorter last one. Null texts
    are empty: one piece, the end id alone. Repeated rows are documents of their own. ``part`` and ``nth``
    number the pieces of one rounded length within a task; store the result before they are used.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def pieces(batches):
        tokens, part, seen = _loaded(tokenizer), TaskContext.get().partitionId(), {}
        for batch in sliced(batches, "text", TEXT_BYTES):
            which, out, ids_out = [], [], []
            flat, begin = tokens.encode(batch.column("text"))
            for k in range(batch.num_rows):
                ids = np.append(flat[begin[k] : begin[k + 1]], np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), sequence)):
                    own = ids[start : start + sequence]
                    unit = -(-len(own) // UNIT)
                    nth = seen[unit] = seen.get(unit, -1) + 1
                    which.append(k)
                    out.append((piece, start, len(own), zlib.crc32(own.tobytes()), part, nth))
                    if with_ids:
                        ids_out.append(own.astype(np.int32))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))]
            extra = [pa.array(ids_out, pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(which, pa.int64())), *columns, *extra],
                names=["key", "piece", "start", "length", "ids_crc32", "part", "nth", *["ids"] * with_ids],
            )
        tokens._forget()

    out = rows.mapInArrow(tidily(pieces), f"key {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long" + ", ids array<int>" * with_ids)
    return out.withColumnRenamed("key", key)


def non_negative(columns: list[np.ndarray], rows: int, target: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |weight * (A x - target)| (Lawson and Hanson's active set).

    A's column k has ones (added up, if repeated) in the rows ``columns[d][k]`` over all d; row ``rows`` is none.
    """
    n = len(columns[0])
    w2 = np.append(weight**2, 0.0)
    b = np.append(target, 0.0).astype(float)
    x, active, barred = np.zeros(n), [], set()

    def applied(y):
        out = np.zeros(rows + 1)
        for c in columns:
            np.add.at(out, c, y)
        return out

    def dense(picked):
        out = np.zeros((rows + 1, len(picked)))
        for c in columns:
            np.add.at(out, (c[picked], np.arange(len(picked))), 1.0)
        return out

    scale = max(1.0, float((w2 * b).max(initial=0)))
    for _ in range(4 * rows):
        r = w2 * (b - applied(x))
        gain = sum(r[c] for c in columns)
        gain[active] = -np.inf
        gain[list(barred)] = -np.inf
        # several of the best columns that share no row enter at once
        order = np.argpartition(-gain, min(64, n - 1))[:64]
        order = order[np.argsort(-gain[order], kind="stable")]
        used, fresh = set(), []
        for k in order:
            own = {int(c[k]) for c in columns} - {rows}
            if gain[k] > 1e-7 * scale and not own & used:
                fresh.append(int(k))
                used |= own
        if not fresh:
            break
        active += fresh
        while True:
            a = dense(active) * np.sqrt(w2)[:, None]
            s = np.linalg.solve(a.T @ a + 1e-9 * np.eye(len(active)), a.T @ (b * np.sqrt(w2)))
            if (s > 1e-12).all():
                x[:] = 0
                x[active] = s
                barred.clear()
                break
            now = x[active]
            low = s <= 1e-12
            if (now[low] <= 1e-12).any():  # a column that cannot move
                gone = {a for a, v, o in zip(active, s, now) if v <= 1e-12 and o <= 1e-12}
                barred |= gone & set(fresh)
                active = [k for k in active if k not in gone]
                x[list(gone)] = 0
                if not active:
                    break
                continue
            step = (now[low] / (now[low] - s[low])).min()
            x[active] = now + step * (s - now)
            gone = {a for a in active if x[a] <= 1e-12}
            x[list(gone)] = 0
            active = [k for k in active if k not in gone]
        if not active and not fresh:
            break
    return x


def plan(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in units) and repeats that use up ``histogram`` (counts by length, 0 unused) exactly."""
    capacity = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        out.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    have = np.flatnonzero(left)
    if len(have) and depth > 1:
        there = left > 0
        a, b = np.meshgrid(have, have, indexing="ij")
        pairs = a <= b
        a, b = a[pairs], b[pairs]
        rest = capacity - a - b
        two = rest == 0
        three = (rest >= b) & there[np.clip(rest, 0, capacity)] if depth > 2 else np.zeros(len(rest), dtype=bool)
        first = np.concatenate([a[two], a[three]])
        second = np.concatenate([b[two], b[three]])
        third = np.concatenate([np.full(two.sum(), capacity + 1), rest[three]])
        if len(first):
            weight = np.where(np.arange(capacity + 1) < capacity / 16, SHORT_WEIGHT, 1.0)
            x = non_negative([first, second, third], capacity + 1, left.astype(float), weight)
            for k in np.argsort(-x, kind="stable"):
                if x[k] < 0.5:
                    break
                members = [int(c[k]) for c in (first, second, third) if c[k] <= capacity]
                most = min(left[m] // members.count(m) for m in members)
                repeat = int(min(round(x[k]), most))
                if repeat:
                    for m in members:
                        left[m] -= repeat
                    out.append((tuple(sorted(members, reverse=True)), repeat))
    # best fit for the rest: the longest first, into the smallest gap that holds it
    open_: dict[int, list[list]] = {}
    for length in range(capacity, 0, -1):
        count = int(left[length])
        while count:
            gap = min((g for g in open_ if g >= length), default=None)
            if gap is None:
                members, repeat = (), count // max(1, min(count, capacity // length)) or 1
            else:
                members, repeat = open_[gap].pop()
                if not open_[gap]:
                    del open_[gap]
            space = capacity if gap is None else gap
            fit = min(space // length, count)
            many = min(repeat, count // fit)
            if many < repeat:
                open_.setdefault(space, []).append([members, repeat - many]) if gap is not None else None
            count -= many * fit
            members, space = members + (length,) * fit, space - length * fit
            (open_.setdefault(space, []) if space else out).append([members, many] if space else (members, many))
    out += [(tuple(m), r) for held in open_.values() for m, r in held]
    return [(m, int(r)) for m, r in out if r]


def pack(pieces: DataFrame, key: str = "doc_id", sequence: int = SEQUENCE) -> DataFrame:
    """``pieces`` (a stored result of ``cut``) with sequence_id and offset, gapless from 0 in each sequence.

    Pieces of one rounded length are numbered by their task's running number and the tasks before; a pattern takes
    runs of these numbers. Rows travel to one shuffle by sequence, whose groups hold ``sequence`` tokens at most.
    """
    spark = pieces.sparkSession
    unit = F.ceil(F.col("length") / F.lit(UNIT)).cast("int")
    rows = pieces.withColumn("unit", unit)
    counts = materialise(rows.groupBy("unit", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = np.zeros(-(-sequence // UNIT) + 1, dtype=np.int64)
    for r in counts.groupBy("unit").agg(F.sum("n").alias("n")).collect():
        histogram[r["unit"]] = r["n"]
    runs: dict[int, list[tuple[int, int, int]]] = {}
    taken, next_id = np.zeros(len(histogram), dtype=np.int64), 0
    for members, repeat in plan(histogram):
        for slot, u in enumerate(members):
            runs.setdefault(u, []).append((int(taken[u]), next_id, slot))
            taken[u] += repeat
        next_id += repeat
    lookup = spark.sparkContext.broadcast({u: np.array(r, dtype=np.int64) for u, r in runs.items()})
    before = Window.partitionBy("unit").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("unit", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = rows.join(offsets, ["unit", "part"]).withColumn("rank", F.col("before") + F.col("nth"))

    @F.pandas_udf("struct<sequence_id:long,slot:long>")
    def placed(u, rank):
        import pandas as pd

        seq, slot = np.zeros(len(u), dtype=np.int64), np.zeros(len(u), dtype=np.int64)
        values, ranks = u.to_numpy(), rank.to_numpy()
        for one in np.unique(values):
            at, own = np.flatnonzero(values == one), lookup.value[int(one)]
            run = np.searchsorted(own[:, 0], ranks[at], side="right") - 1
            seq[at], slot[at] = own[run, 1] + ranks[at] - own[run, 0], own[run, 2]
        return pd.DataFrame({"sequence_id": seq, "slot": slot})

    there = numbered.withColumn("at", placed("unit", "rank"))
    order = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    kept = [c for c in pieces.columns if c not in ("part", "nth")]
    return (
        there.select(*kept, F.col("at.sequence_id").alias("sequence_id"), F.col("at.slot").alias("slot"))
        .withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0)))
        .select(*kept, "sequence_id", "offset")
    )
