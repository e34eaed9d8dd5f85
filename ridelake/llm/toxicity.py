"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text.

Folding lower-cases, drops invisible characters, and maps look-alike letters of other scripts and
digits or signs inside words to the letters they stand for. The lexicon's terms are beginnings of words and whole
words that labelled toxic texts hold far more often than others; a term's weight is its log odds. A match that lies in an
exception phrase does not count. The score is a logistic function of the matches' weight and of its share of the text's length.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import record, sliced
from ridelake.session import materialise

ROWS = 20_000  # bound on labelled rows that the lexicon and the score are fitted on
TERMS = 5_000  # bound on the lexicon
PREFIXES = (4, 5, 6, 7)  # letters of the beginnings of words that are tried as terms
LEAST_DOCS = 5  # toxic rows that must hold a term
LEAST_ODDS = 3.0  # log odds, smoothed, that a term must have

# Look-alikes and the letters they stand for.
LOOKALIKES = dict(
    zip("аеорсухіјѕԁһԛԝвкмнтαεορυικντ", "aeopcyxijsdhqwbkmhtaeopuiknt")
)
DIGITS = dict(zip("0134578@$", "oieastbas"))
_FOLD = str.maketrans(LOOKALIKES | DIGITS | {chr(0xFF41 + k): chr(0x61 + k) for k in range(26)} | {chr(0xFF10 + int(d)): v for d, v in DIGITS.items() if d.isdigit()} | dict.fromkeys(map(chr, (0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD)), None))
_ASCII_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0134578@$", b"abcdefghijklmnopqrstuvwxyzoieastbas")


def fold(text: str) -> str:
    if text.isascii():  # the same mapping, a byte at a time
        return text.encode().translate(_ASCII_FOLD).decode()
    return text.lower().translate(_FOLD)


@dataclass
class Lexicon:
    terms: dict[str, float]  # a trailing space marks a whole word
    exceptions: list[str] = field(default_factory=list)
    coefficients: tuple[float, ...] = (-4.0, 1.0, 1.0)
    _matcher: object = None

    def matcher(self):
        import ahocorasick

        if self._matcher is None:
            held = ahocorasick.Automaton()
            for term, weight in self.terms.items():
                held.add_word(fold(term), (len(fold(term)), weight))
            for phrase in self.exceptions:
                held.add_word(fold(phrase), (len(fold(phrase)), None))
            held.make_automaton()
            self._matcher = held
        return self._matcher

    def __getstate__(self):
        return self.__dict__ | {"_matcher": None}

    def matches(self, text: str) -> tuple[list[tuple[int, int, float]], int]:
        """(start, end, weight) of the matches that count, over the folded text, and its number of words.

        A term must begin a word. Of several terms at one place the heaviest counts.
        """
        low = fold(text)
        best, spared = {}, []
        if self.terms:
            for end, (size, weight) in self.matcher().iter(low + " "):
                start = end + 1 - size
                if start and low[start - 1].isalnum():
                    continue
                if weight is None:
                    spared.append((start, end + 1))
                elif start not in best or best[start][1] < weight:
                    best[start] = (end + 1, weight)
        # a phrase that begins no later than a hit and reaches farthest decides
        spared.sort()
        reach = list(accumulate((y for _, y in spared), max))
        hits = []
        for a, (b, w) in best.items():
            before = bisect_right(spared, (a, len(low) + 1))
            if not before or reach[before - 1] < b:
                hits.append((a, b, w))
        return hits, low.count(" ") + low.count("\n") + 1

    def features(self, text: str | None) -> tuple[float, float]:
        """Log of the matches' total weight, and of their weight in a thousand words."""
        hits, words = self.matches(text) if text else ([], 1)
        weight = sum(w for *_, w in hits)
        return float(np.log1p(weight)), float(np.log1p(1000.0 * weight / (words + 50)))


def _probability(features: np.ndarray, coefficients) -> np.ndarray:
    z = coefficients[0] + features @ np.array(coefficients[1:])
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def _terms(text: str) -> set[str]:
    words = {w.strip(".,;:!?\"'()") for w in fold(text).split()}
    words.discard("")
    return {w[:n] for w in words for n in PREFIXES if len(w) >= n} | {f"{w} " for w in words if len(w) > 2}


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = ROWS, exceptions: list[str] | None = None) -> Lexicon:
    """Learn the lexicon from at most about ``rows`` labelled documents, the lowest by a hash of their key.

    Rows with a null label, key or text are not used. Terms are counted in the sample's toxic texts first; those that enough of
    them hold are then counted in the others. Word pairs around a term that only clean texts repeat become exceptions.
    Without toxic rows the lexicon is empty and every score is low.
    """
    spark = docs.sparkSession
    marked = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("toxic")).dropna().groupBy("key").agg(F.max("toxic").alias("toxic"))
    picked = marked.orderBy(F.xxhash64("key"), "key").limit(rows)
    sample = materialise(docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).dropna().join(F.broadcast(picked), "key").select("text", "toxic"), "toxic-sample")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic_n, clean_n = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic_n:
        return Lexicon({}, list(exceptions or []), (-6.0, 0.0, 0.0))

    def count(batches):
        n = Counter()
        for batch in sliced(batches, "text"):
            for t in batch.column("text").to_pylist():
                n.update(_terms(t))
        for at in range(0, len(n), 50_000):
            some = list(n.items())[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in some]), pa.array([v for _, v in some], pa.int64())], names=["term", "n"])

    least = max(LEAST_DOCS, toxic_n // 500)
    common = sample.where("toxic = 1").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    toxic = {r["term"]: r["n"] for r in common.orderBy(F.desc("n"), "term").limit(20 * TERMS).collect()}
    held = spark.sparkContext.broadcast(toxic)

    def check(batches):
        n, around = Counter(), Counter()
        for batch in sliced(batches, "text"):
            for t in batch.column("text").to_pylist():
                there = [k for k in _terms(t) if k in held.value]
                n.update(there)
        for at in range(0, len(n), 50_000):
            some = list(n.items())[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in some]), pa.array([v for _, v in some], pa.int64())], names=["term", "n"])

    clean = {r["term"]: r["n"] for r in sample.where("toxic = 0").mapInArrow(check, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    odds = {k: float(np.log((v + 0.5) / (toxic_n + 1)) - np.log((clean.get(k, 0) + 0.5) / (clean_n + 1))) for k, v in toxic.items()}
    # a longer term adds nothing where a shorter one that begins it is as good
    kept: dict[str, float] = {}
    for k in sorted((k for k, o in odds.items() if o >= LEAST_ODDS), key=lambda k: (len(k), k)):
        if not any(k[:n] in kept and kept[k[:n]] >= odds[k] - 0.5 for n in range(PREFIXES[0], len(k))):
            kept[k] = odds[k]
    kept = dict(sorted(kept.items(), key=lambda x: (-x[1] * toxic[x[0]], x[0]))[:TERMS])
    lexicon = Lexicon(kept, list(exceptions or []))
    lexicon.exceptions += _exceptions(sample, lexicon, least)
    lexicon._matcher = None
    model = spark.sparkContext.broadcast(lexicon)

    def measure(batches):
        for batch in sliced(batches, "text"):
            f = [model.value.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([a for a, _ in f]), pa.array([b for _, b in f])], names=["toxic", "a", "b"])

    # bounded by `rows`: three numbers of each sampled row
    found = sample.mapInArrow(measure, "toxic int, a double, b double").toPandas()
    lexicon.coefficients = _logistic(found[["a", "b"]].to_numpy(), found["toxic"].to_numpy().astype(float))
    return lexicon


def _exceptions(sample: DataFrame, lexicon: Lexicon, least: int) -> list[str]:
    """Word pairs that hold a match in at least ``least`` clean texts of the sample and in no toxic one."""
    model = sample.sparkSession.sparkContext.broadcast(lexicon)

    def pairs(batches):
        n = {0: Counter(), 1: Counter()}
        for batch in sliced(batches, "text"):
            for t, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                low = fold(t)
                hits, _ = model.value.matches(t)
                seen = set()
                for start, end, _w in hits:
                    stop = low.find(" ", end - 1)
                    word = low[start : stop if stop >= 0 else len(low)]
                    before = low[:start].rsplit(None, 1)[-1:] if start < 200 else low[start - 200 : start].rsplit(None, 1)[-1:]
                    after = low[stop : stop + 200].split(None, 1)[:1] if stop >= 0 else []
                    seen |= {f"{b} {word}" for b in before} | {f"{word} {a}" for a in after}
                n[int(label > 0)].update(seen)
        rows = [(k, v, n[1].get(k, 0)) for k, v in n[0].items()] + [(k, 0, v) for k, v in n[1].items() if k not in n[0]]
        yield record(pa.schema([("pair", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())]), *(zip(*rows) if rows else ([], [], [])))

    found = sample.mapInArrow(pairs, "pair string, clean long, toxic long").groupBy("pair").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    return [r["pair"] for r in found.where((F.col("c") >= least) & (F.col("t") == 0)).orderBy(F.desc("c"), "pair").limit(TERMS).collect()]


def score(docs: DataFrame, lexicon: Lexicon, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, n_matches, n_words, matches) of every row; ``matches`` are (start, end, weight) over the folded text.

    Null and empty texts have no match and get the score of a text without any.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(lexicon)
    match = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("weight", pa.float64())])

    def judge(batches):
        for batch in sliced(batches, "text"):
            texts = batch.column("text").to_pylist()
            each = [model.value.matches(t) if t else ([], 1) for t in texts]
            total = np.array([sum(w for *_, w in hits) for hits, _ in each])
            words = np.array([n for _, n in each])
            p = _probability(np.column_stack([np.log1p(total), np.log1p(1000.0 * total / (words + 50))]), model.value.coefficients)
            hits = pa.array([[{"start": a, "end": b, "weight": w} for a, b, w in sorted(h)] for h, _ in each], pa.list_(match))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(p), pa.array([len(h) for h, _ in each], pa.int64()), pa.array(words, pa.int64()), hits],
                names=["key", "score", "n_matches", "n_words", "matches"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(judge, f"key {kind}, score double, n_matches long, n_words long, matches array<struct<start:int,end:int,weight:double>>").withColumnRenamed("key", key)
