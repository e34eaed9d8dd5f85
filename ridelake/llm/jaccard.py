"""Exact Jaccard join of documents in the metric space of their shingle sets.

Jaccard distance is a metric, so what is known about distances to a pivot bounds all others. The join:

1. Documents that are farther than the threshold from every other are set apart. A set of n shingles
   can miss few of its own in a partner, so enough of those with low hashes must occur in another set. Sets travel
   as the low-hash shingles only, dealt by hash; a shingle that several texts of one batch hold is sent once.
2. What is left is one set per class of equal sets. Sets within the threshold share one of each one's rarest
   shingles; such a shingle is a neighbourhood, and the neighbourhood's pivot is the set with the lowest
   priority. Each set is measured against the pivots of its neighbourhoods, wherever it lies; a set within the
   threshold belongs to the pivot's region and joins its component.
3. The sets around a pivot that are not all of its component are joined recursively. By the triangle inequality only those of
   the pivot's region in the window next to the outermost others are replicated to it. Large ones are cut into blocks
   of outer members by blocks of all; within a block the sets are dealt to Voronoi regions of more pivots,
   boundary sets to every region within twice the threshold of their nearest, until few are left; these take their
   turns as pivots.

Pairs within one component are never expanded. Words are runs of other bytes than space and 09-0D, A-Z
lower-cased; a set with fewer words than a shingle has one, the whole sequence. Sets are of 64-bit hashes.
"""

from __future__ import annotations

import struct
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import components, filter_spots, id_filter, maybe_in, mix64, parts, shingle_hashes, sliced, tidily
from ridelake.operators.lookup import sized
from ridelake.session import materialise

WHOLE = 128  # sets up to this size (and their possible partners) are sent whole
OUTER, BLOCK = 256, 1024  # members of a block of pivots, and of the block they are compared with
NOBODY = np.uint32(0xFFFFFFFF)
CELL = 48  # sets that take turns as pivots instead of being dealt to regions


class Threshold:
    """Similarity of at least ``num / den``, in whole numbers."""

    def __init__(self, similarity: Fraction):
        self.num, self.den = similarity.numerator, similarity.denominator
        self.distance = 1 - self.num / self.den + 1e-9
        # hashes under it stand for a set in the first test: 5/3 of the share that a partner may lack
        self.low = np.uint64(min((1 << 63) - 1, int((1 << 64) * (1 - similarity) * 5 / 3)))

    def needed(self, n):
        """Shingles of a set of ``n`` that any partner must hold."""
        return -(-n * self.num // self.den)

    def joins(self, common, a, b):
        return self.den * common >= self.num * (a + b - common)


def _sets(texts: pa.Array, width: int):
    """Sorted distinct shingle hashes of each text."""
    hashes, begin = shingle_hashes(texts, width)
    for k in range(len(begin) - 1):
        yield np.unique(hashes[begin[k] : begin[k + 1]])


def _class(s: np.ndarray) -> int:
    """One signed 64-bit number per distinct set."""
    if not len(s):
        return 0
    both = np.array([mix64(s).sum(), np.bitwise_xor.reduce(s)], dtype=np.uint64)
    return int((mix64(both[:1] + np.uint64(len(s))) ^ mix64(both[1:])).astype(np.int64)[0])


def _sent(s: np.ndarray, limit: Threshold) -> tuple[np.ndarray, int]:
    """The shingles that stand for the set in the first test, in order, and how many of them any partner sends too."""
    low = int(np.searchsorted(s, limit.low))
    if len(s) <= WHOLE:
        return s, len(s)
    return (s, low) if len(s) * limit.num <= WHOLE * limit.den else (s[:low], low)


def _screen(docs: DataFrame, limit: Threshold, width: int) -> DataFrame:
    """(doc, n, class, near) of every row: ``near`` unless no other text can be within the threshold."""
    spark = docs.sparkSession
    n_parts = parts(spark)
    buckets = 4 * n_parts

    def first(batches):
        task, turn = TaskContext.get().partitionId(), 0
        for batch in sliced(batches, "text"):
            packet = (task << 32) + turn
            turn += 1
            seen: dict[int, int] = {}
            meta, flat, owner = [], [], []
            for k, (doc, s) in enumerate(zip(batch.column("doc").to_pylist(), _sets(batch.column("text"), width))):
                cls = _class(s)
                if cls not in seen and len(s):
                    seen[cls] = k
                    sent, tested = _sent(s, limit)
                    flat.append(sent)
                    owner.append(np.where(np.arange(len(sent)) < tested, np.uint32(k), NOBODY))
                # of a batch's equal sets the first is tested for all
                meta.append((doc is not None, doc or 0, len(s), cls, seen.get(cls, k), _sent(s, limit)[1]))
            flat = np.concatenate(flat) if flat else np.empty(0, np.uint64)
            owner = np.concatenate(owner) if owner else np.empty(0, np.uint32)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            start = np.flatnonzero(np.append(True, flat[1:] != flat[:-1])) if len(flat) else np.empty(0, np.int64)
            size = np.diff(np.append(start, len(flat)))
            local = np.repeat(size > 1, size)  # several of this batch hold it
            shared = np.bincount(owner[local & (owner != NOBODY)], minlength=batch.num_rows)
            # local ones go once and without an owner, for the other batches' sake
            hashes = np.concatenate([flat[~local], flat[start[size > 1]]])
            whose = np.concatenate([owner[~local], np.full((size > 1).sum(), NOBODY, dtype=np.uint32)])
            bucket = (mix64(hashes) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            hashes, whose, bucket = hashes[order], whose[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            own = [struct.pack("<?qqqqqq", *m, shared[k]) for k, m in enumerate(meta)]
            rows = [(-1 - int(packet) % n_parts, packet, b"".join(own), b"")]
            short = np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, :6])  # 48 bits; a clash only lets a set through
            rows += [(b, packet, short[lo:hi].tobytes(), whose[lo:hi].tobytes()) for b, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])) if hi > lo]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["bucket", "packet", "data", "whose"])

    def second(batches):
        """One bucket of hashes after another; a packet's own description passes through."""
        now, packets, hashes, whose = None, [], [], []
        for batch in batches:
            data, owners, ids = batch.column("data"), batch.column("whose"), batch.column("packet").to_pylist()
            passed = []
            for k, b in enumerate(batch.column("bucket").to_pylist()):
                if b < 0:
                    passed.append(k)
                    continue
                if b != now and packets:
                    yield answered(packets, hashes, whose)
                    packets, hashes, whose = [], [], []
                now = b
                short = np.frombuffer(data[k].as_py(), dtype=np.uint8).reshape(-1, 6)
                hashes.append(np.pad(short, ((0, 0), (0, 2))).view(np.uint64).ravel())
                whose.append(np.frombuffer(owners[k].as_py(), dtype=np.uint32))
                packets.append(ids[k])
            if passed:
                take = pa.array(passed)
                yield pa.RecordBatch.from_arrays([batch.column("packet").take(take), data.take(take), pa.array([None] * len(passed), pa.binary())], names=["packet", "meta", "counts"])
        if packets:
            yield answered(packets, hashes, whose)

    def answered(packets, hashes, whose) -> pa.RecordBatch:
        """For each packet, how many of its sets' hashes in this bucket another one holds."""
        flat, owner = np.concatenate(hashes), np.concatenate(whose)
        source = np.repeat(np.arange(len(packets)), [len(h) for h in hashes])
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        twice = np.zeros(len(flat), dtype=bool)
        twice[1:] = ordered[1:] == ordered[:-1]
        twice[:-1] |= twice[1:]
        hit = np.zeros(len(flat), dtype=bool)
        hit[order] = twice
        hit &= owner != NOBODY
        key, count = np.unique(source[hit].astype(np.uint64) << np.uint64(32) | owner[hit], return_counts=True)
        cuts = np.searchsorted((key >> np.uint64(32)).astype(np.int64), np.arange(len(packets) + 1))
        pairs = np.stack([key & np.uint64(0xFFFFFFFF), count.astype(np.uint64)], axis=1).astype(np.uint32)
        rows = [(packets[k], pairs[lo:hi].tobytes()) for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])) if hi > lo]
        return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int64()), pa.array([None] * len(rows), pa.binary()), pa.array([a for _, a in rows], pa.binary())], names=["packet", "meta", "counts"])

    def third(batches):
        """Answers come sorted by packet, its own rows' description among them."""
        now, meta, counts = None, b"", []
        for batch in batches:
            for packet, m, c in zip(batch.column("packet").to_pylist(), batch.column("meta").to_pylist(), batch.column("counts").to_pylist()):
                if packet != now:
                    if now is not None:
                        yield decide(meta, counts)
                    now, meta, counts = packet, b"", []
                meta = m if m is not None else meta
                if c is not None:
                    counts.append(c)
        if now is not None:
            yield decide(meta, counts)

    def decide(meta: bytes, counts: list[bytes]) -> pa.RecordBatch:
        rows = list(struct.iter_unpack("<?qqqqqq", meta))
        found = np.array([r[6] for r in rows], dtype=np.int64)
        for c in counts:
            pairs = np.frombuffer(c, dtype=np.uint32).reshape(-1, 2)
            np.add.at(found, pairs[:, 0], pairs[:, 1])
        # a partner may lack n - needed of the set's shingles, so the others of those it sent too are held elsewhere
        out = [(doc if known else None, n, cls, bool(n and found[same] >= tested - (n - limit.needed(n)))) for known, doc, n, cls, same, tested, _ in rows]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.bool_()))], names=["doc", "n", "class", "near"])

    dealt = docs.mapInArrow(tidily(first), "bucket int, packet long, data binary, whose binary").repartition(n_parts, "bucket").sortWithinPartitions("bucket")
    told = dealt.mapInArrow(tidily(second), "packet long, meta binary, counts binary").repartition(n_parts, "packet").sortWithinPartitions("packet")
    return told.mapInArrow(tidily(third), "doc long, n long, class long, near boolean")


def _again(docs: DataFrame, picked: DataFrame, limit: Threshold, width: int) -> DataFrame:
    """(doc, class, n, low, some, hashes) of the texts whose ids ``picked`` may hold; shuffles no text."""
    spark = docs.sparkSession
    words, bits = id_filter(picked, "doc")
    held = spark.sparkContext.broadcast(words)

    def shingle(batches):
        for batch in sliced(batches, "text"):
            take = pa.array(np.flatnonzero(maybe_in(batch, held.value)))
            rows = [(_class(s), len(s), int(np.searchsorted(s, limit.low)), s) for s in _sets(batch.column("text").take(take), width)]
            # neighbourhoods are formed over low shingles; a set with too few of them needs all
            some = [s[:m] if m > n - limit.needed(n) else s for _, n, m, s in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").take(take),
                    pa.array([c for c, *_ in rows], pa.int64()),
                    pa.array([n for _, n, *_ in rows], pa.int64()),
                    pa.array([m for _, _, m, _ in rows], pa.int64()),
                    pa.array([x.view(np.int64) for x in some], pa.list_(pa.int64())),
                    pa.array([s.tobytes() for *_, s in rows], pa.binary()),
                ],
                names=["doc", "class", "n", "low", "some", "hashes"],
            )

    rows = docs.where("doc is not null").select("doc", "text", *filter_spots("doc", bits))
    return rows.mapInArrow(tidily(shingle), "doc long, class long, n long, low long, some array<long>, hashes binary")


def _common(pivot: np.ndarray, flat: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many of the pivot's shingles each set holds."""
    at = np.searchsorted(pivot, flat)
    at[at == len(pivot)] = 0
    return np.bincount(owner[pivot[at] == flat], minlength=n)


class Block:
    """Sets of one block, joined recursively; ``comp`` holds each one's component, ``outer`` may be pivots."""

    def __init__(self, ids, comps, outer, sets, limit: Threshold):
        self.ids, self.outer, self.sets, self.limit = ids, np.array(outer, dtype=bool), sets, limit
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        self.comp = np.unique(np.array(comps), return_inverse=True)[1]
        self.links: list[tuple[int, int]] = []

    def distances(self, p: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat = np.concatenate([self.sets[r] for r in rows])
        common = _common(self.sets[p], flat, np.repeat(np.arange(len(rows)), self.size[rows]), len(rows))
        union = self.size[p] + self.size[rows] - common
        return 1 - common / union, self.limit.joins(common, self.size[p], self.size[rows])

    def link(self, p: int, rows: np.ndarray) -> None:
        for r in rows:
            if self.comp[r] != self.comp[p]:
                self.links.append((self.ids[p], self.ids[r]))
                self.comp[self.comp == self.comp[r]] = self.comp[p]

    def open(self, rows: np.ndarray) -> bool:
        """Whether a pair of different components with a pivot among them is left."""
        return len(rows) > 1 and self.outer[rows].any() and len(np.unique(self.comp[rows])) > 1

    def join(self, rows: np.ndarray) -> None:
        if not self.open(rows):
            return
        if len(rows) <= CELL:
            return self.in_turns(rows)
        t = self.limit.distance
        # pivots from as many components as possible, by size of set
        first = np.unique(self.comp[rows], return_index=True)[1]
        pivots = rows[first[np.linspace(0, len(first) - 1, min(8, len(first))).astype(int)]]
        gap = np.empty((len(pivots), len(rows)))
        for k, p in enumerate(pivots):
            gap[k], near = self.distances(p, rows)
            self.link(p, rows[near])
        if not self.open(rows):
            return
        home = gap.argmin(axis=0)
        nearest = gap[home, np.arange(len(rows))]
        cells = [rows[(home == k) | (gap[k] <= nearest + 2 * t)] for k in range(len(pivots))]
        if max(map(len, cells)) > 0.75 * len(rows):
            return self.in_turns(rows)
        for cell in cells:
            self.join(cell)

    def in_turns(self, rows: np.ndarray) -> None:
        """Each set that may be a pivot, of the rarest components first, until one component is left."""
        while self.open(rows):
            comps, count = np.unique(self.comp[rows], return_counts=True)
            weight = count[np.searchsorted(comps, self.comp[rows])] + np.where(self.outer[rows], 0, len(rows))
            at = int(weight.argmin())
            p = rows[at]
            other = rows[self.comp[rows] != self.comp[p]]
            # sizes alone rule most out
            fits = self.limit.num * np.maximum(self.size[other], self.size[p]) <= self.limit.den * np.minimum(self.size[other], self.size[p])
            other = other[fits]
            if len(other):
                self.link(p, other[self.distances(p, other)[1]])
            rows = np.delete(rows, at)


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: str = "0.85", width: int = 4) -> DataFrame:
    """(key, n_shingles, component_id) of every row.

    Rows link when the Jaccard similarity of their shingle sets is at least ``similarity``; ``component_id`` is the
    smallest integer key reachable by links. Null and empty texts have no shingle and link with nothing, not even
    with each other. Rows with a null key take no part and get a null component. Repeated rows are equal sets.
    """
    limit = Threshold(Fraction(similarity))
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    known = materialise(_screen(rows, limit, width), "jaccard-rows")
    near = known.where("doc is not null and near")
    classes = materialise(near.groupBy("class").agg(F.min("doc").alias("doc")), "jaccard-classes")
    # the filter lets a few others through; one text of each class stays
    kept = materialise(_again(rows, classes.select("doc"), limit, width).join(sized(classes), ["doc", "class"], "left_semi"), "jaccard-sets")
    edges = _edges(kept, limit)
    linked = components(edges, "a", "b", "jaccard-links").select(F.col("node").alias("class"), "component")
    member = known.select("doc", F.col("n").alias("n_shingles"), "class")
    least = member.where("doc is not null and n_shingles > 0").groupBy("class").agg(F.min("doc").alias("least"))
    named = least.join(linked, "class", "left").withColumn("component", F.coalesce("component", "class"))
    of = named.select("class", "component").join(named.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("class", "component_id")
    return member.join(of, "class", "left").select(
        F.col("doc").alias(key), "n_shingles", F.when(F.col("n_shingles") > 0, F.when(F.col("doc").isNotNull(), F.col("component_id"))).otherwise(F.col("doc")).alias("component_id")
    )


def _edges(kept: DataFrame, limit: Threshold) -> DataFrame:
    """Links between classes that make up all components."""
    n_parts = parts(kept.sparkSession)
    post = kept.select("class", "n", "low", F.size("some").alias("all"), F.explode("some").alias("h"))
    counts = post.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    high = F.expr(f"h < 0 or h >= {int(limit.low)}")
    common = post.join(counts, "h").groupBy("class").agg(
        *[F.max(c).alias(c) for c in ("n", "low", "all")],
        F.sort_array(F.collect_list(F.when(~high, F.struct("df", "h")))).alias("lows"),
        F.sort_array(F.collect_list(F.when(high, F.struct("df", "h")))).alias("highs"),
    )
    # a set's n - needed + 1 first shingles: low before high, then by count; those that no other set holds come
    # first among the low and among the high, and are no neighbourhoods
    rarest = F.floor(F.col("n") * F.lit(limit.den - limit.num) / F.lit(limit.den)) + 1
    of_low = F.greatest(F.least(rarest, "low") - (F.col("low") - F.size("lows")), F.lit(0)).cast("int")
    of_high = F.greatest(rarest - F.col("low") - (F.col("all") - F.col("low") - F.size("highs")), F.lit(0)).cast("int")
    first_of = lambda column, count: F.slice(column, F.lit(1), count)
    keys = (
        common.select("class", "n", F.explode(F.concat(first_of("lows", of_low), F.when(F.col("all") > F.col("low"), first_of("highs", of_high)).otherwise(F.slice("highs", 1, 0)))).alias("s"))
        .select("class", "n", F.col("s.h").alias("h"))
    )
    keys = materialise(keys, "jaccard-keys")
    # pivots: the lowest priority of each neighbourhood, so that neighbourhoods of the same sets choose alike
    pivots = keys.groupBy("h").agg(F.min(F.struct(F.xxhash64("class").alias("first"), "class", "n")).alias("p"), F.count(F.lit(1)).alias("size")).where("size > 1")
    met = keys.join(pivots.select("h", F.col("p.class").alias("pivot"), F.col("p.n").alias("pivot_n")), "h").where("class <> pivot")
    pairs = materialise(met.groupBy("pivot", "class").agg(F.max("n").alias("n"), F.max("pivot_n").alias("pivot_n")), "jaccard-pairs")
    sizes = materialise(pairs.groupBy("pivot").agg(F.count(F.lit(1)).alias("members")), "jaccard-sizes")
    pairs = pairs.join(sizes, "pivot")
    fits = limit.num * F.greatest("n", "pivot_n") <= limit.den * F.least("n", "pivot_n")
    near = materialise(_measure(pairs.where(fits), kept, limit, n_parts), "jaccard-measured")
    first = near.where("near").select(F.col("pivot").alias("a"), F.col("class").alias("b"))
    comp = materialise(components(first, "a", "b", "jaccard-regions").select(F.col("node").alias("class"), "component"), "jaccard-parts")
    # the sets around a pivot that are not of its component, and what of its component they may reach
    held = pairs.join(near.select("pivot", "class", "gap"), ["pivot", "class"], "left").join(comp, "class", "left").withColumn("component", F.coalesce("component", "class"))
    held = held.join(comp.select(F.col("class").alias("pivot"), F.col("component").alias("region")), "pivot", "left")
    held = materialise(held.withColumn("outer", F.col("component") != F.coalesce("region", "pivot")), "jaccard-held")
    edge = held.where("outer").groupBy("pivot").agg(
        F.count(F.lit(1)).alias("outers"), F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.min(F.coalesce("gap", F.lit(0.0))).alias("closest")
    )
    # by the triangle inequality, only members of the region in the window next to the closest outer one; by size, too
    window = (F.coalesce("gap", F.lit(1.0)) >= F.col("closest") - limit.distance) & (limit.num * F.col("n") <= limit.den * F.col("most_n")) & (limit.num * F.col("least_n") <= limit.den * F.col("n"))
    rest = held.join(edge, "pivot").where(F.col("outer") | window)
    spread = lambda count, block: F.ceil(F.col(count) / F.lit(block)).cast("int")
    rest = rest.where("members > 1").withColumn("qs", spread("outers", OUTER)).withColumn("bs", spread("members", BLOCK))
    rest = rest.withColumn("q", F.pmod(F.xxhash64("class"), F.col("qs")).cast("int")).withColumn("b", F.pmod(F.xxhash64("class", F.lit(7)), F.col("bs")).cast("int"))
    each = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    as_member = rest.withColumn("to", each("qs")).select("pivot", F.col("to").alias("q"), "b", "class", "component", (F.col("outer") & (F.col("q") == F.col("to"))).alias("pivots"))
    as_pivot = rest.where("outer").withColumn("to", each("bs")).where("to <> b").select("pivot", "q", F.col("to").alias("b"), "class", "component", F.lit(True).alias("pivots"))
    blocks = materialise(as_member.union(as_pivot), "jaccard-blocks")
    return first.union(_joined(blocks, kept, n_parts, limit))


def _measure(pairs: DataFrame, kept: DataFrame, limit: Threshold, n_parts: int) -> DataFrame:
    """(pivot, class, near, gap) of each pair; a pivot's sets are dealt to as many tasks as they need."""
    spread = F.ceil(F.col("members") / F.lit(OUTER)).cast("int")
    rows = pairs.withColumn("salt", F.pmod(F.xxhash64("class"), spread).cast("int"))
    heads = rows.select("pivot", "salt").distinct()
    wanted = rows.select("pivot", "salt", "class").withColumn("head", F.lit(False)).union(heads.withColumn("class", F.col("pivot")).withColumn("head", F.lit(True)))
    payload = kept.select("class", "hashes").join(sized(materialise(wanted, "jaccard-wanted")), "class")

    def measure(batches):
        now, pivot, out = None, None, []
        for batch in batches:
            for p, salt, cls, head, raw in zip(*(batch.column(c).to_pylist() for c in ("pivot", "salt", "class", "head", "hashes"))):
                s = np.frombuffer(raw, dtype=np.uint64)
                if head:
                    now, pivot = (p, salt), s
                elif now == (p, salt):
                    at = np.searchsorted(pivot, s)
                    at[at == len(pivot)] = 0
                    common = int((pivot[at] == s).sum())
                    out.append((p, cls, bool(limit.joins(common, len(pivot), len(s))), 1 - common / (len(pivot) + len(s) - common)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.bool_(), pa.float64()))], names=["pivot", "class", "near", "gap"])
                out = []

    ordered = payload.select("pivot", "salt", "head", "class", "hashes").repartition(n_parts, "pivot", "salt").sortWithinPartitions("pivot", "salt", F.desc("head"))
    return ordered.mapInArrow(tidily(measure), "pivot long, class long, near boolean, gap double")


def _joined(blocks: DataFrame, kept: DataFrame, n_parts: int, limit: Threshold) -> DataFrame:
    payload = kept.select("class", "hashes").join(sized(blocks), "class").select("pivot", "q", "b", "class", "component", "pivots", "hashes")

    def run(batches):
        now, rows = None, []

        def solve():
            ids, comps, outer, sets = zip(*rows)
            block = Block(ids, comps, outer, sets, limit)
            block.join(np.arange(len(ids)))
            a, b = zip(*block.links) if block.links else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for p, q, b, *rest, raw in zip(*(batch.column(c).to_pylist() for c in ("pivot", "q", "b", "class", "component", "pivots", "hashes"))):
                if (p, q, b) != now:
                    if rows:
                        yield solve()
                    now, rows = (p, q, b), []
                rows.append((*rest, np.frombuffer(raw, dtype=np.uint64)))
        if rows:
            yield solve()

    ordered = payload.repartition(n_parts, "pivot", "q", "b").sortWithinPartitions("pivot", "q", "b")
    return ordered.mapInArrow(tidily(run), "a long, b long")
