"""Jaccard join, vectors, chats and mixing against brute force, and the registered queries."""

import random
from fractions import Fraction

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ridelake.llm import chat, jaccard, mixing, vectors
from ridelake.llm.common import components, without
from ridelake.llm.queries import ORACLE, QUERIES

# components


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 9), (5, 5), (None, 4), (20, 3)] + [(k, k + 1) for k in range(100, 160)]
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert out == {1: 1, 2: 1, 3: 1, 20: 1, 7: 7, 8: 7, 9: 7} | {k: 100 for k in range(100, 161)}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_without_drops_exactly(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).union(spark.sql("select null, 'n'"))
    assert {r["doc_id"] for r in without(docs, spark.range(0, 1000, 3).select(F.col("id").alias("doc_id")), "doc_id").collect()} == {None, *(k for k in range(1000) if k % 3)}


# Jaccard


def shingles(text, width):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return frozenset(zip(*[words[k:] for k in range(width)])) if len(words) >= width else frozenset([tuple(words)] if words else [])


def brute(rows, similarity, width):
    least = Fraction(similarity)
    sets = [shingles(t, width) for _, t in rows]
    comp = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if None not in (rows[a][0], rows[b][0]) and x and y and comp[a] != comp[b] and len(x & y) >= least * len(x | y):
                comp = [comp[a] if c == comp[b] else c for c in comp]
    least_id = {c: min(i for (i, _), k in zip(rows, comp) if k == c and i is not None) for (i, _), c in zip(rows, comp) if i is not None}
    return sorted((i, len(s), None if i is None else least_id[c] if s else i) for (i, _), s, c in zip(rows, sets, comp) if i is not None)


def corpus(seed, n=260):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    passages = [[r.choice(words) for _ in range(60)] for _ in range(3)]
    rows = []
    for k in range(n):
        kind = r.random()
        if kind < 0.45 and rows:  # near or exact copy of an earlier one, in chains
            text = (r.choice(rows)[1] or "").split(" ")
            for _ in range(r.choice([0, 0, 1, 2, 4, 8])):
                at = r.randrange(len(text))
                text[at : at + r.choice([0, 1, 2])] = [r.choice(words)]
        else:
            text = [r.choice(words) for _ in range(int(r.lognormvariate(4, 1)) + 1)]
            if kind > 0.6:
                text += r.choice(passages)
        text = " ".join(text)
        rows.append((k * 7 % 1009, text.upper() if kind < 0.02 else text))
    return rows


@pytest.mark.parametrize("seed, similarity, width", [(1, "0.85", 4), (2, "0.8", 5), (3, "0.6", 3)])
def test_join_is_exact(spark, seed, similarity, width):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "p", 1) for i, t in rows], "doc_id long, text string, pivot string, class int").repartition(6)
    out = jaccard.join(docs, similarity=similarity, width=width)
    assert sorted(map(tuple, out.collect())) == brute(rows, similarity, width)


def test_join_in_small_blocks(spark, monkeypatch):
    """The same, with regions cut into many blocks and cells."""
    for name, value in (("OUTER", 3), ("BLOCK", 4), ("CELL", 3), ("WHOLE", 10)):
        monkeypatch.setattr(jaccard, name, value)
    rows = corpus(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, jaccard.join(docs).collect())) == brute(rows, "0.85", 4)


def test_join_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "a b"), (5, "A  b"), (5, "A  b"), (6, "a b c d"), (7, "y " * 50_000), (8, "y " * 60_000), (9, "b a"), (None, "a b")]
    out = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows)
    assert sorted(tuple(r) for r in out if r["doc_id"] is not None) == brute(rows, "0.85", 4)
    assert [r["component_id"] for r in out if r["doc_id"] is None] == [None]
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_blocks_are_exact():
    r = np.random.default_rng(5)
    limit = jaccard.Threshold(Fraction("0.85"))
    base = np.unique(r.integers(0, 1 << 62, 400)).astype(np.uint64)
    sets = []
    for k in range(150):
        base = np.unique(np.concatenate([base[r.random(len(base)) > 0.03], r.integers(0, 1 << 62, 12).astype(np.uint64)]))
        sets.append(base)
    block = jaccard.Block(list(range(150)), list(range(150)), [True] * 150, sets, limit)
    block.join(np.arange(150))
    comp = list(range(150))
    for a in range(150):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if limit.joins(common, len(sets[a]), len(sets[b])):
                comp = [comp[a] if c == comp[b] else c for c in comp]
    assert len(set(zip(block.comp, comp))) == len(set(comp)) == len(set(block.comp))


# vectors


def test_vectors(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(700, 16))
    x[300:420] = x[0] + 0.05 * r.normal(size=(120, 16))
    x[420:560] = x[r.integers(1, 300, 140)] + 0.15 * r.normal(size=(140, 16))
    x[560:600] = 3.0 * x[5]
    rows = [(k, v.tolist(), k % 2 if k < 690 else None) for k, v in enumerate(x)]
    odd = [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 16, 1), (1003, [float("nan")] + [1.0] * 15, 1), (1004, [None] + [1.0] * 15, 1), (1005, [float("inf")] * 16, 1), (1006, [1.0, 2.0], 1), (1007, [2.0, 4.0], 1), (None, [1.0, 2.0], 1)]
    frame = spark.createDataFrame([(i, v, l, "x", "m") for i, v, l in rows + odd], "vec_id long, embedding array<double>, label int, x string, member string")
    out = {q["vec_id"]: q for q in vectors.near_duplicates(frame).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([k % 2 if k < 690 else -1 - k for k in range(700)])
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :]) & ~np.eye(700, dtype=bool)
    found = sum(out[k]["n_links"] for k in range(700))
    assert all(out[k]["n_links"] <= near[k].sum() for k in range(700)) and found >= 0.97 * near.sum()
    assert len({out[k]["component_id"] for k in range(300, 420, 2)}) == 1
    assert all(out[i]["n_links"] == 0 and out[i]["component_id"] == i and out[i]["kept"] for i, _, _ in odd[:6]) and len(out) == len(rows) + len(odd)
    assert (out[1006]["n_links"], out[1007]["component_id"], out[1007]["kept"]) == (1, 1006, False)
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


# chats

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_chats_share_turns_and_read_back(spark):
    hard = "\\### Assistant: </turn> ok"
    chats = {
        1: [("user", "hi"), ("assistant", "hello"), ("user", "a")], 2: [("user", "hi"), ("assistant", "hello"), ("user", "b"), ("assistant", "é\n🙂")], 3: [("user", "hi"), ("assistant", "other")],
        4: [("user", hard), ("assistant", hard)], 5: [("", ""), ("a:b\\\n", "<turn>")], 6: [("user", "hi")], 7: [("user", "x" * 20_000)], 8: [("user", "hi"), ("assistant", "hello"), ("user", "a")],
    }
    rows = [(c, k, r or None, t or None, "n", 0) for c, turns in chats.items() for k, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    tree = chat.build(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string, start int"), BYTES)
    out = {r["conv_id"]: r for r in chat.read_back(tree).collect()}
    assert {c: chat.parse(r["formatted"]) for c, r in out.items()} == chats
    assert {c: list(map(chat.unescape, r["learned"])) for c, r in out.items()} == {c: [t for r, t in turns if r == "assistant"] for c, turns in chats.items()}
    nodes = {r["node"]: r for r in tree.nodes.collect()}
    assert len(nodes) == 2 + 2 + 1 + 1 + 2 + 2 + 1
    stream = sorted(nodes.values(), key=lambda r: r["start"])
    assert [r["start"] for r in stream] == [0, *[r["end"] for r in stream[:-1]]]
    for n in nodes.values():
        above, p = [], n
        while p["parent"]:
            p = nodes[p["parent"]]
            above.append(p)
        # exactly the ancestors and the node itself see a node's tokens' places
        sees = {m["node"] for m in nodes.values() if m["start"] <= n["start"] < m["visible"]}
        assert sees == {n["node"], *(a["node"] for a in above)} and n["position"] == sum(a["end"] - a["start"] for a in above)
    digests = {r["conv_id"]: r for r in chat.digests(chat.read_back(tree), "conv_id").collect()}
    assert digests[4]["n_turns"] == 2 and digests[4]["loss_chars"] == len(hard)


def test_chats_without_rows(spark):
    tree = chat.build(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), BYTES)
    assert chat.digests(chat.read_back(tree), "conv_id").count() == 0


def test_repeated_and_null_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "user", None), (None, 0, "user", "z")]
    out = {r["conv_id"]: chat.parse(r["formatted"]) for r in chat.read_back(chat.build(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), BYTES)).collect()}
    assert out == {1: [("user", ""), ("user", "a"), ("user", "a")], None: [("user", "z")]}


# mixing


def test_raked_marginals_hold(spark, monkeypatch):
    r = random.Random(2)
    cells = spark.createDataFrame([(s, l, t, r.randrange(1, 1000)) for s in "abc" for l in "xy" for t in "pqr"], "source string, lang string, topic string, tokens long")
    targets = {"source": [("a", 0.5), ("b", 0.3), ("c", 0.2)], "lang": [("x", 0.4), ("y", 0.4), ("absent", 0.2)], "topic": [("p", 0.2), ("q", 0.3), ("r", 0.5)]}
    tables = {k: spark.createDataFrame(v, f"{k} string, target double") for k, v in targets.items()}
    both = []
    for most in (1000, 0):
        monkeypatch.setattr(mixing, "MOST_CELLS", most)
        out = mixing.rake(cells, tables, 40).toPandas()
        total = out["tokens"].sum()
        for level, wanted in targets.items():
            got = out.groupby(level)["weight"].sum() / total
            scale = sum(w for k, w in wanted if k in got.index)
            assert got.to_dict() == pytest.approx({k: w / scale for k, w in wanted if k in got.index}, rel=1e-4)
        both.append(out.sort_values(["source", "lang", "topic"])["weight"].to_numpy())
    assert both[0] == pytest.approx(both[1], rel=1e-4)


def test_mixing_keeps_rows_and_rates(spark):
    rows = [(k, " ".join(["w"] * (k % 50)), "en" if k % 3 else None, f"s{k % 4 % 3}") for k in range(4000)] + [(1, None, None, None), (1, None, None, None), (None, "x" * 50_000, "en", "s1")]
    docs = spark.createDataFrame([(*r, "m", 1.0) for r in rows], "doc_id long, text string, lang string, source string, mix string, rate double")
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "mix_"] and mixed.select("mix").distinct().first()[0] == "m"
    out = mixed.select("doc_id", "text", "mix_.*").toPandas()
    assert len(out) == len(rows) and out["probability"].between(0, 1).all() and out["probability"].max() == pytest.approx(1.0)
    assert out["kept"].mean() == pytest.approx(out["probability"].mean(), abs=0.03)
    assert out[(out["doc_id"] == 1) & out["text"].isna()]["kept"].nunique() == 1
    weight = (out["n_tokens"] * out["rate"]).groupby(out["source"]).sum()
    sums = out.groupby("source")["n_tokens"].sum() ** mixing.TEMPER
    assert (weight / weight.sum()).to_dict() == pytest.approx((sums / sums.sum()).to_dict(), rel=1e-3)
    assert mixing.mix(docs.limit(0)).count() == 0


# registered queries


@pytest.fixture(scope="module")
def engine(sf_dir):
    connection = duckdb.connect()
    for name in ("pages", "documents", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, engine, name):
    df = QUERIES[name](spark, sf_dir)
    result = engine.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, df.select(columns).toPandas().itertuples(index=False, name=None))) == sorted(map(str, result.df().itertuples(index=False, name=None)))


def test_accuracy_on_held_out_rows(spark, sf_dir, tmp_path):
    held = QUERIES["op1_language"](spark, sf_dir).where("held_out").join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").where("lang is not null").toPandas()
    assert (held["lang"] == held["lang_pred"]).mean() > 0.9


def test_pipeline_by_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mixture", "sequences"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        docs = corpus_pipeline.materialise(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == columns
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert now <= {i for i, _ in before} <= ids
        if name == "near_duplicates":
            assert now == {i for i, _, c in brute(before, "0.8", 5) if i == c}
        if name == "personal_data":
            assert now == {i for i, _ in before}
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).toPandas()
    assert set(out["doc_id"]) == now and out.groupby("sequence_id")["length"].sum().max() <= 4096
