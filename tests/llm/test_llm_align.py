"""Alignment of two tokenizers against the definition, on whole texts; the monoid's laws; edges; the registered query."""

import hashlib
import random
from collections import Counter, defaultdict
from functools import reduce

import duckdb
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ridelake.llm import align
from ridelake.llm.queries import BYTE_TOKENIZER, PIECE_TOKENIZER, QUERIES

FILES = align.Tokenizers(BYTE_TOKENIZER, PIECE_TOKENIZER)
LETTERS = "ab \n\t\x0b\x85\xa0 é*#<>𠀀　 中'st9▁\x00\x1c|endoftext"


@pytest.fixture(scope="module")
def pair():
    return FILES()


def whole(pair, text):
    """(id, start, end) of A's and B's tokens of the text as one piece, by the files' own libraries."""
    if not text:
        return [], []
    ids = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    out, data = [], (" " + text).encode()
    for side, table in zip(ids, (pair.a_bytes, pair.b_bytes)):
        at, tokens = 0, []
        for k in side:
            tokens.append((k, at, at + len(table[k])))
            at += len(table[k])
        if b"".join(table[k] for k in side) != data:
            return [], []
        out.append(tokens)
    return out


def brute(pair, rows):
    found = []
    for key, text in rows:
        a, b = whole(pair, text)
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] if len(a) < 400 else _links(a, b)
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, i, j = [], 0, 0
        for end in ends:
            ga, gb = [], []
            while i < len(a) and a[i][2] <= end:
                ga.append(str(a[i][0]))
                i += 1
            while j < len(b) and b[j][2] <= end:
                gb.append(str(b[j][0]))
                j += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        found.append((key, len(a), len(b), len(groups), links, ";".join(groups)))
    counts = Counter(p for f in found for p in set(f[4]))
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    return [
        (k, na, nb, ng, len(links), sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if na else "")
        for k, na, nb, ng, links, text in found
    ]


def _links(a, b):
    out, j = [], 0
    for x in a:
        while b[j][2] <= x[1]:
            j += 1
        k = j
        while k < len(b) and b[k][1] < x[2]:
            out.append((x[0], b[k][0]))
            k += 1
    return out


def by_key(rows):
    return sorted(map(tuple, rows), key=lambda r: (str(r[0]), r[1:]))


def test_words_give_the_whole_texts_tokens(pair):
    r = random.Random(3)
    texts = ["".join(r.choice(LETTERS) for _ in range(r.randint(1, 60))) for _ in range(4000)] + ["<|endoftext|> a <s>b</s> <unk> <0x0A> x", "x" * 700 + " y  "]
    for text in texts:
        cut = align.words(text.encode())
        assert cut == [b" " + part for part in align._CUT.split(text.encode())]
        assert b"".join(cut) == b" " + text.encode()
        runs = align.token_runs(pair, cut)
        got = ([], []) if None in runs else ([k for x in runs for k in x.a], [k for x in runs for k in x.b])
        a, b = whole(pair, text)
        assert got == ([k for k, _, _ in a], [k for k, _, _ in b])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=12), st.lists(st.integers(1, 4), max_size=12), st.lists(st.integers(0, 50), min_size=2, max_size=2))
def test_fragments_compose_in_any_bracketing(a, b, cuts):
    ends = lambda sizes: [sum(sizes[: k + 1]) for k in range(len(sizes))]
    run = align.Tokens(list(range(len(a))), ends(a), list(range(len(b))), ends(b))
    x, y = sorted(cuts)
    three = [align._between(run, low, high) for low, high in ((-1, x), (x, y), (y, 99))]

    def product(parts):
        out = []

        def step(left, right):
            both, closed = align.compose(left, right)
            out.append(closed)
            return both

        leaves = []
        for tokens in parts:
            f, closed = align.fragment(tokens)
            leaves.append(f)
            out.append(closed)
        return leaves, step, out

    results = []
    for bracket in (lambda f, s: s(s(f[0], f[1]), f[2]), lambda f, s: s(f[0], s(f[1], f[2]))):
        leaves, step, out = product(three)
        f = bracket(leaves, step)
        results.append((f, sorted((g.end, g.text) for g in out if g), sorted(k for g in out if g for k in g.links)))
    assert results[0] == results[1]
    f, closed = align.fragment(run)
    assert results[0][0] == f and ";".join(t for _, t in results[0][1]) == (closed.text if closed else "")


@pytest.mark.parametrize("size", [1, 7, 64])
def test_ranges_cover_every_byte_once(size):
    r = random.Random(size)
    for n in (1, 5, 40, 400):
        text = "".join(r.choice("abc é\n ") for _ in range(n)).encode()
        low, data = 0, b" " + text
        for after, upto, start, part in align.ranges(text, size):
            assert after == low < upto and start <= after and data[start : start + len(part)] == part and start + len(part) >= upto
            low = upto
        assert low == len(data)


@pytest.mark.parametrize("size,fan", [(5, 2), (9, 3), (align.RANGE, align.FAN)])
def test_documents_and_edges(spark, pair, size, fan):
    r = random.Random(11)
    words = ["the", "tokens", "über", "中文字", "a", "antidisestablishment", "x1y2", "don't", "naïve", "…"]
    rows = [(k, "".join(r.choice(words) + r.choice([" ", " ", "  ", "\n", ", ", ""]) for _ in range(r.randint(1, 40)))) for k in range(60)]
    rows += [(61, None), (62, ""), (63, " "), (64, "▁ not given back"), (65, "﻿"), (None, "null key"), (3, rows[3][1]), (3, rows[3][1]), (66, "w" * 300 + " end"), (67, " lead  and trail  ")]
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id long, text string, pair int, `n.a` int")
    got = align.digest(align.align(docs, FILES, size=size, fan=fan))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert by_key(got.collect()) == by_key(brute(pair, rows))
    if size == 9:
        none = align.digest(align.align(docs.limit(0), FILES, size=size))
        assert none.count() == 0 and none.columns == got.columns


def test_groups_are_given_in_order(spark, pair):
    text = "some words that are cut anywhere, über und über again"
    docs = spark.createDataFrame([("k", text)], "name string, body string")
    for size in (6, 1000):
        found = align.align(docs, FILES, key="name", text="body", size=size, with_groups=True)
        text_ = ";".join(r["groups"] for r in found.groups.orderBy("at").collect())
        assert hashlib.sha256(text_.encode()).hexdigest() == found.documents.first()["groups_sha256"]
        pairs = align.pair_counts(found.links).collect()
        assert reduce(lambda x, y: x and y, (p["documents"] == 1 and p["best"] and p["pair"] == p["a"] << 32 | p["b"] for p in pairs))


def test_counts_joined_by_a_shuffle_are_the_same(spark, sf_dir, monkeypatch):
    found = align.align(spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40), FILES)
    small = by_key(align.digest(found).collect())
    monkeypatch.setattr(align, "COUNTS_BYTES", 0)
    plan = align.digest(found)
    assert by_key(plan.collect()) == small


def test_query(spark, sf_dir, pair):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    assert by_key(QUERIES["op13_alignment"](spark, sf_dir).collect()) == by_key(brute(pair, rows))


def test_fast_encoder_has_the_files_vocabulary(pair):
    assert public_tokenizers.path("byte_bpe_50k.json") == BYTE_TOKENIZER
    r = random.Random(4)
    for _ in range(3000):
        text = " " + "".join(r.choice(LETTERS + "etaoin") for _ in range(r.randint(1, 40)))
        assert pair.fast.encode_ordinary(text) == pair.a.encode(text, add_special_tokens=False).ids
