"""Compression bands and base counts against plain Python, edges, and the registered query."""

import random
import re

import duckdb
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from ridelake.llm import quality
from ridelake.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """The base counts, by the letter of their definition."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    covered = {j for k, w in enumerate(windows) if windows.count(w) > 1 for j in (k, k + 1, k + 2)}
    lines, again = [], 0
    for line in text.split("\n"):
        again += bool(WORD.search(line)) and line in lines
        lines.append(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab \n\t\x0b\x85 é*#<𠀀", max_size=90)), min_size=1, max_size=6))
def test_counts_match_their_definition(texts):
    got = quality.rate(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert tuple(got[n][k] for n in NAMES) == plain(text)


def prose(r, n):
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 8))) for _ in range(600)]
    return " ".join(r.choice(words) for _ in range(n))


def test_bands_reject_repeats_and_noise_and_keep_prose():
    r = random.Random(5)
    noise = lambda n: "".join(chr(r.randrange(0x4E00, 0x9FA0)) + (" " if k % 5 == 4 else "") for k in range(n))
    good = [prose(r, n) for n in (60, 200, 1000, 5000, 20000)]
    bad = [
        " ".join(f"x{k % 7}{'y' * 60}" for k in range(400)),  # repeats below the window rule's reach are caught by the band
        " ".join("%032x" % r.getrandbits(128) for _ in range(30)) + " " + " ".join(f"n{k:05d}aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" for k in range(4000)),
        noise(6000),
        prose(r, 1500) + " " + noise(4000),  # half of the chunks
    ]
    got = quality.rate(pa.array(good + bad, pa.string()))
    assert list(got["kept"]) == [True] * len(good) + [False] * len(bad)
    assert list(got["n_chunks"]) == [-(-len(t.encode()) // quality.CHUNK) for t in good + bad]


def test_compression_of_whole_and_chunks_as_computed_apart():
    r, c = random.Random(9), zstandard.ZstdCompressor(level=quality.LEVEL)
    for size in (0, 1, 127, 128, 4095, 4096, 4097, 70000):
        text = prose(r, 20000).encode()[:size]
        ratio, good, chunks, bad, lost = quality.compression(text, quality.BANDS, 4096, c.compress)
        parts = [text[k : k + 4096] for k in range(0, size, 4096)]
        inside = []
        for p in parts:
            band = [b for b in quality.BANDS if b.from_bytes <= len(p)][-1]
            inside.append(band.least <= len(p) / len(c.compress(p)) <= band.most)
        assert chunks == len(parts) and bad == inside.count(False)
        assert lost == sum(len(p) for p, ok in zip(parts, inside) if not ok)
        if size:
            assert ratio == pytest.approx(size / len(c.compress(text)))


def test_edges(spark):
    r = random.Random(1)
    text = prose(r, 300)
    rows = [(1, None, 5, 0.5), (2, "", 5, 0.5), (3, text, 5, 0.5), (3, text, 5, 0.5), (None, text, 5, 0.5), (6, prose(r, 150_000), 5, 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int, `a.b` double")
    got = sorted(((d["doc_id"] or 0, d["n_words"], d["kept"]) for d in quality.judge(docs).collect()))
    assert got == [(0, 300, True), (1, 0, False), (2, 0, False), (3, 300, True), (3, 300, True), (6, 150_000, True)]
    kept = quality.keep(docs)
    assert kept.columns == docs.columns and kept.count() == 4 and {d["kept"] for d in kept.collect()} == {5}
    assert quality.judge(docs.limit(0)).count() == 0 and quality.keep(docs.limit(0)).count() == 0


def test_query(spark, sf_dir):
    got = {d["doc_id"]: tuple(d[n] for n in NAMES) for d in QUERIES["op12_quality"](spark, sf_dir).collect()}
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    assert got == {i: plain(t) for i, t in texts}
