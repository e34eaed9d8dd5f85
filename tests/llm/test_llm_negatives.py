"""Hard negatives against brute force, the threshold's stop, edges, and the registered query against its SQL."""

import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridelake.llm import negatives
from ridelake.llm.queries import ORACLE, QUERIES

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, is_anchor):
    usable = [(i, l, tuple(math.floor(256 * x) for x in v)) for i, l, v in rows if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    usable = list(dict.fromkeys(usable))
    out = []
    for a in usable:
        if not is_anchor(a[0]):
            continue
        scored = sorted(((sum(p * q for p, q in zip(a[2], r[2])), r) for r in usable if len(r[2]) == len(a[2]) and r[0] != a[0]), key=lambda s: (-s[0], s[1][0]))
        for p, r in [s for s in scored if s[1][1] == a[1]][:5]:
            fits = [s for s in scored if s[1][1] != a[1] and 50 * p <= 100 * s[0] <= 95 * p][:3]
            out += [(a[0], r[0], k + 1, s[1][0], p, s[0]) for k, s in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    return sorted(tuple(r) for r in negatives.mine(df, F.col("vec_id") % 5 == 0, **kw).select(COLUMNS).collect())


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 60), st.integers(0, 6), st.integers(0, 2**32), st.integers(1, 4))
def test_threshold_stops_only_when_nothing_better_is_unseen(n, d, seed, spread):
    r = np.random.default_rng(seed)
    x, a = r.integers(-spread, spread + 1, (n, d)), r.integers(-spread, spread + 1, d)
    keys, allowed = r.permutation(n), r.random(n) < 0.8
    windows = [(-(1 << 62), 1 << 62)] + [tuple(sorted(r.integers(-2 * spread, 2 * spread + 1, 2).tolist())) for _ in range(3)]
    scores = x @ a
    want = [sorted(((int(scores[i]), int(keys[i])) for i in range(n) if allowed[i] and low <= scores[i] <= high), key=lambda s: (-s[0], s[1]))[:3] for low, high in windows]
    assert negatives.best(negatives.Lists(x), keys, allowed, a, windows, 3) == want


def test_reading_stops_early_and_big_products_stay_exact():
    r = np.random.default_rng(1)
    x = r.integers(-5, 6, (5000, 3))
    x[7] = 90
    lists, seen = negatives.Lists(x), 0
    for rows, _, threshold in lists.read(np.array([3, 2, 1])):
        seen += len(rows)
        if threshold < 6 * 90:
            break
    assert seen < 200
    big = np.full((3, 4), (1 << 25) - 1)
    big[1] -= 1
    got = negatives.best(negatives.Lists(big), np.arange(3), np.ones(3, dtype=bool), big[0], [(0, 1 << 62)], 3)[0]
    assert got == [(4 * ((1 << 25) - 1) ** 2, 0), (4 * ((1 << 25) - 1) ** 2, 2), (4 * ((1 << 25) - 1) * ((1 << 25) - 2), 1)]


@pytest.mark.parametrize("block,group", [(8, 2), (64, 7), (8192, 1024)])
def test_mined_rows_match_brute_force(spark, block, group):
    r = random.Random(block)
    centres = [[r.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for k in range(220):
        label = 0 if r.random() < 0.5 else r.randrange(1, 40)  # one hot label, many small ones
        rows.append((k, label, [c + r.gauss(0, 0.6) for c in r.choice(centres)]))
    rows += [(300 + k, k % 2, rows[3][2]) for k in range(12)]  # ties
    rows += [rows[5], rows[5], (5, 2, rows[9][2]), (400, None, rows[0][2]), (None, 1, rows[0][2]), (405, 1, None), (410, 1, [1.0, None] * 3), (415, 1, [float("nan")] * 6)]
    rows += [(420, 1, [float("inf")] * 6), (425, 1, [0.0] * 6), (430, 0, [1.0, 2.0]), (431, 0, [1.0, 2.0]), (432, 1, [0.7, 1.1]), (435, 1, []), (436, 1, []), (437, 2, [])]
    rows = [(i, l, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, l, v in rows]
    got = mined(spark, rows, block_rows=block, group_anchors=group)
    assert got == brute(rows, lambda i: i % 5 == 0) and len(got) > 100


def test_edges(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1.0])]) == []
    df = spark.createDataFrame([(0, "a", [1.0], 7), (1, "a", [1.0], 7), (2, "b", [0.75], 7)], "id long, kind string, v array<double>, row int")
    got = negatives.mine(df, F.col("id") == 0, key="id", vector="v", label="kind")
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 2, 65536, 49152)]
    with pytest.raises(Exception, match="2 \\*\\* 25"):
        mined(spark, [(0, 1, [1e9]), (1, 1, [1.0])])


def test_query_matches_sql(spark, sf_dir):
    engine = duckdb.connect()
    engine.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    found = engine.execute(ORACLE["op11_negatives"])
    names = [c[0] for c in found.description]
    want = sorted(tuple(row[names.index(c)] for c in COLUMNS) for row in found.fetchall())
    df = QUERIES["op11_negatives"](spark, sf_dir)
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r) for r in df.select(COLUMNS).collect()) == want and want
