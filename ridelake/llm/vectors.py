"""Near-duplicate vectors by product quantisation over inverted lists, with exact reranking.

Coarse centroids and codebooks of the residuals' subspaces are fitted on a bounded sample; every vector gets the list
of its nearest centroid and one code per subspace. A vector searches its ``PROBES`` nearest lists: a table of products with the
codebook gives the approximate cosine with each member, and members that could reach the threshold, given the length of
what the codes leave out, are compared exactly. Lists are cut into blocks of members by blocks of searching vectors.
Only counts and a spanning forest leave a block, never its pairs. Equal vectors of a label are searched once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import components, parts
from ridelake.session import materialise

SAMPLE = 20_000  # bound on vectors that centroids and codebooks are fitted on
PER_LIST, MOST_LISTS = 256, 1024  # wanted vectors per list; bound on lists
SUBSPACES, CODES = 8, 64
PROBES = 12
ROWS = 256  # vectors in a block
COSINE = 0.93


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = ((centres**2).sum(axis=1)[None, :] - 2 * x @ centres.T).argmin(axis=1)
        count = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


class Quantiser:
    """Centroids and one codebook per subspace, for vectors of one length."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.centres = k_means(sample, lists)
        near = self.nearest(sample, 1)[:, 0]
        rest = sample - self.centres[near]
        self.cuts = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
        self.books = [k_means(rest[:, a:b], CODES, seed=a) for a, b in zip(self.cuts[:-1], self.cuts[1:])]

    def nearest(self, x: np.ndarray, n: int) -> np.ndarray:
        far = (self.centres**2).sum(axis=1)[None, :] - 2 * x @ self.centres.T
        n = min(n, len(self.centres))
        return np.argsort(far, axis=1, kind="stable")[:, :n]

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the length of what they leave out."""
        rest = x - self.centres[lists]
        codes = np.empty((len(x), len(self.books)), dtype=np.uint8)
        for k, (a, b, book) in enumerate(zip(self.cuts[:-1], self.cuts[1:], self.books)):
            codes[:, k] = ((book**2).sum(axis=1)[None, :] - 2 * rest[:, a:b] @ book.T).argmin(axis=1)
            rest[:, a:b] -= book[codes[:, k]]
        return codes, np.sqrt((rest**2).sum(axis=1))

    def approximate(self, queries: np.ndarray, lists: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Products of each query with each coded vector, by table look-ups."""
        out = queries @ self.centres[lists].T
        for k, (a, b, book) in enumerate(zip(self.cuts[:-1], self.cuts[1:], self.books)):
            out += (queries[:, a:b] @ book.T)[:, codes[:, k]]
        return out


def usable(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Unit vectors in double precision of one batch by row, which rows have one, and their length (0: none).

    Null or empty vectors, and those of zeros or with null or non-finite components, have none. Lengths may differ by batch row;
    rows of another length than the batch's first usable one are padded with zeros, which no cosine notices, as the length is part of the label.
    """
    lists = vectors.to_pylist()
    width = max((len(v) for v in lists if v), default=0)
    x, good = np.zeros((len(lists), max(width, 1))), np.zeros(len(lists), dtype=bool)
    for k, v in enumerate(lists):
        if v and None not in v:
            a = np.array(v, dtype=np.float64)
            scale = np.abs(a).max()
            if np.isfinite(scale) and scale > 0:
                a = a / scale
                x[k, : len(a)] = a / np.sqrt((a**2).sum())
                good[k] = True
    return x, good, width


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """(key, n_links, component_id, kept) of every row.

    Vectors of equal, non-null label and equal length link when their cosine is at least ``cosine``. Those without
    a usable vector, label or key link with nothing. Rows with equal keys are vectors of their own that share a component.
    """
    spark = rows.sparkSession
    n_parts = parts(spark)
    every = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), F.col(label).cast("string").alias("label"))

    def unit(batches):
        for batch in batches:
            x, good, _ = usable(batch.column("v"))
            lengths = [len(v) if v else 0 for v in batch.column("v").to_pylist()]
            take = np.flatnonzero(good)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(take)),
                    pa.array([f"{n}/{l}" for n, l in ((lengths[k], batch.column("label")[k].as_py()) for k in take)], pa.string()),
                    pa.array([x[k, : lengths[k]].tobytes() for k in take], pa.binary()),
                ],
                names=["id", "label", "x"],
            )

    good = every.where("id is not null and label is not null and v is not null").mapInArrow(unit, "id long, label string, x binary")
    good = materialise(good, "vectors")
    # one row per distinct vector of a label; copies are counted, not compared
    one = materialise(good.groupBy("label", "x").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")), "distinct-vectors")
    sizes = {r["width"]: r["n"] for r in one.groupBy(F.length("x").alias("width")).agg(F.count(F.lit(1)).alias("n")).collect()}
    held: dict[int, Quantiser] = {}
    for width, n in sizes.items():
        share = min(1.0, SAMPLE / n)
        some = one.where((F.length("x") == width) & (F.pmod(F.xxhash64("x"), F.lit(1_000_000)) < int(1_000_000 * share) + 1)).select("x").limit(2 * SAMPLE).toArrow()
        sample = np.frombuffer(b"".join(some.column("x").to_pylist()), dtype=np.float64).reshape(len(some), -1)
        held[width] = Quantiser(sample, max(1, min(MOST_LISTS, n // PER_LIST)))
    models = spark.sparkContext.broadcast(held)

    def index(batches):
        for batch in batches:
            raw = batch.column("x").to_pylist()
            widths = np.array([len(r) for r in raw])
            probes = [None] * len(raw)
            for w in np.unique(widths):
                at = np.flatnonzero(widths == w)
                x = np.frombuffer(b"".join(raw[k] for k in at), dtype=np.float64).reshape(len(at), -1)
                for k, p in zip(at, models.value[int(w)].nearest(x, PROBES)):
                    probes[k] = p.astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(probes, pa.list_(pa.int32()))], names=[*batch.schema.names, "probes"])

    indexed = materialise(one.mapInArrow(index, "label string, x binary, id long, copies long, probes array<int>"), "indexed-vectors")
    home = F.element_at("probes", 1)
    members = indexed.groupBy("label", home.alias("list")).agg(F.count(F.lit(1)).alias("members"))
    probing = indexed.select("label", F.explode("probes").alias("list")).groupBy("label", "list").agg(F.count(F.lit(1)).alias("queries"))
    cells = members.join(probing, ["label", "list"]).select("label", "list", F.ceil(F.col("members") / ROWS).cast("int").alias("mbs"), F.ceil(F.col("queries") / ROWS).cast("int").alias("qbs"))
    block = lambda count, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(count)).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    columns = ["label", "list", "mb", "qb", "member", "id", "copies", "x", "probes"]
    as_member = indexed.withColumn("list", home).join(cells, ["label", "list"]).withColumn("mb", block("mbs", 1)).withColumn("qb", each("qbs")).withColumn("member", F.lit(True)).select(columns)
    as_query = indexed.withColumn("list", F.explode("probes")).join(cells, ["label", "list"]).withColumn("qb", block("qbs", 2)).withColumn("mb", each("mbs")).withColumn("member", F.lit(False)).select(columns)

    def search(batches):
        now, rows_ = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                if row[:4] != now:
                    if rows_:
                        yield _search(rows_, models.value, cosine)
                    now, rows_ = row[:4], []
                rows_.append(row[4:] + (row[1],))
        if rows_:
            yield _search(rows_, models.value, cosine)

    ordered = as_member.union(as_query).repartition(n_parts, "label", "list", "mb", "qb").sortWithinPartitions("label", "list", "mb", "qb")
    found = materialise(ordered.mapInArrow(search, "id long, links long, other long"), "vector-links")
    comp = components(found.where("other is not null"), "id", "other", "vector-components").select(F.col("node").alias("id"), F.col("component").alias("component_id"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = one.join(links, "id", "left").join(comp, "id", "left").select("label", "x", F.coalesce("links", F.lit(0)).alias("links"), "copies", F.coalesce("component_id", "id").alias("component_id"))
    ours = good.join(named, ["label", "x"]).groupBy("id").agg(F.sum(F.col("links") + F.col("copies") - 1).alias("n_links"), F.min("component_id").alias("component_id"))
    return every.select("id").join(ours, "id", "left").select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"), F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(True)).alias("kept")
    )


def _search(rows: list[tuple], models: dict, cosine: float) -> pa.RecordBatch:
    """Partial link counts of both sides, and links that connect what is connected, of one block."""
    m = [r for r in rows if r[0]]
    q = [r for r in rows if not r[0]]
    schema = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])
    if not m or not q:
        return pa.RecordBatch.from_arrays([pa.array([], f.type) for f in schema], schema=schema)
    model = models[len(m[0][3])]
    of = m[0][5]
    x = np.frombuffer(b"".join(r[3] for r in m), dtype=np.float64).reshape(len(m), -1)
    y = np.frombuffer(b"".join(r[3] for r in q), dtype=np.float64).reshape(len(q), -1)
    lists = np.full(len(m), of)
    codes, left = model.encode(x, lists)
    a, b = np.nonzero(model.approximate(y, lists, codes) + left[None, :] >= cosine - 1e-9)
    id_m, id_q = np.array([r[1] for r in m]), np.array([r[1] for r in q])
    exact = np.einsum("ij,ij->i", y[a], x[b])
    keep = (exact >= cosine) & (id_q[a] != id_m[b])
    a, b = a[keep], b[keep]
    copies_m, copies_q = np.array([r[2] for r in m]), np.array([r[2] for r in q])
    links_q = np.bincount(a, copies_m[b], len(q)).astype(np.int64)
    # the other way round counts here only where the member does not search the list of the one that found it
    homes = np.array([r[4][0] for r in q])
    unseen = np.array([homes[i] not in m[j][4] for i, j in zip(a, b)], dtype=bool)
    links_m = np.bincount(b[unseen], copies_q[a[unseen]], len(m)).astype(np.int64)
    root = {}

    def find(k):
        while root.setdefault(k, k) != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    edges = []
    for i, j in zip(id_q[a].tolist(), id_m[b].tolist()):
        u, v = find(i), find(j)
        if u != v:
            root[u] = v
            edges.append((i, 0, j))
    out = [(int(k), int(n), None) for k, n in zip(id_q, links_q) if n] + [(int(k), int(n), None) for k, n in zip(id_m, links_m) if n] + edges
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else ((), (), ()), schema)], schema=schema)
