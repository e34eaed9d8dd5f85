"""Language of mixed texts: scripts narrow the candidates, Viterbi labels the words.

Each word gets a score per language from letter n-grams (one to four letters, word boundaries
included) counted on labelled rows. A language whose labelled words never use a word's script
is no candidate for it. The best path through the words pays ``SWITCH`` for every change of
language; its runs are the spans. A text's language is the one with the most letters in its spans.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from ridelake.llm.common import record, sliced, tidily, unused

# Scripts by ranges of code points.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}

SWITCH = 12.0  # natural-log units that a change of language costs
SLOTS = 1 << 16  # hashed n-gram slots per length
LENGTHS = (1, 2, 3, 4)
CODE_POINTS = 0x110000
MOST_LANGUAGES = 1000  # the driver and each task hold a table of SLOTS numbers for every one
WIDEST = 32  # letters of one word that are scored; longer runs are scored in pieces of it
ROWS_PER_LANGUAGE = 1500  # bound on labelled rows per language that the model is fitted on
CACHED = 200_000  # distinct words whose scores a task keeps


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point: is it a letter, and the bit of its script (others share one)."""
    letter = np.fromiter((chr(c).isalpha() for c in range(CODE_POINTS)), dtype=bool, count=CODE_POINTS)
    script = np.where(letter, 1 << len(SCRIPTS), 0).astype(np.uint32)
    for bit, ranges in enumerate(SCRIPTS.values()):
        for low, high in ranges:
            script[low : high + 1] = np.where(letter[low : high + 1], 1 << bit, script[low : high + 1])
    return letter, script


_LETTER, _SCRIPT = _letters()


def _codes(words: list[str]) -> np.ndarray:
    """Code points by word and place, a zero column on both sides; zero where there is no letter."""
    raw = np.array(words, dtype=f"U{WIDEST}").view(np.uint32).reshape(len(words), WIDEST)
    codes = np.zeros((len(words), WIDEST + 2), dtype=np.uint32)
    codes[:, 1:-1] = np.where(_LETTER[raw], raw, 0)
    return codes


def _slots(codes: np.ndarray, length: int) -> np.ndarray:
    """The slot of the n-gram at each place; -1 where it holds no letter."""
    n = codes.shape[1] - length + 1
    h, some = np.zeros((len(codes), n), dtype=np.uint32), np.zeros((len(codes), n), dtype=bool)
    for k in range(length):
        part = codes[:, k : k + n]
        h = (h ^ part) * np.uint32(0x01000193) + np.uint32(0x9E3779B9)
        some |= part > 0
    h ^= h >> np.uint32(15)
    return np.where(some, (h % np.uint32(SLOTS)).astype(np.int64), -1)


@dataclass
class Model:
    languages: list[str]
    scripts: np.ndarray  # bits of the scripts that a language's labelled words use
    tables: np.ndarray  # length, slot, language: log probability
    prior: np.ndarray

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log scores (words x languages, best 0) and letters per word. Without a letter: all 0."""
        codes = _codes(words)
        out = np.zeros((len(words), len(self.languages)))
        for i, length in enumerate(LENGTHS):
            slots = _slots(codes, length)
            for column in slots.T:
                there = np.flatnonzero(column >= 0)
                if len(there):
                    out[there] += self.tables[i][column[there]]
        used = np.bitwise_or.reduce(_SCRIPT[codes], axis=1)
        barred = (used[:, None] & self.scripts[None, :]) == 0
        barred &= (~barred).any(axis=1, keepdims=True) & (used > 0)[:, None]
        foreign = (used > 0) & ((used[:, None] & self.scripts[None, :]) == 0).all(axis=1)
        out[foreign] = 0.0
        out = np.where(barred, -50.0, out / len(LENGTHS))
        out -= out.max(axis=1, keepdims=True, initial=-np.inf)
        return np.maximum(out, -50.0), (codes > 0).sum(axis=1)


def pieces(text: str) -> list[str]:
    """Lower-cased words between white space; longer ones than ``WIDEST`` in pieces of that."""
    words = text.lower().split()
    if any(len(w) > WIDEST for w in words):
        words = [w[i : i + WIDEST] for w in words for i in range(0, len(w), WIDEST)]
    return words


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", rows: int = ROWS_PER_LANGUAGE) -> Model:
    """Count n-grams on about ``rows`` distinct labelled texts of each language, the lowest by a hash of the text.

    Rows with a null label or text are not used; a task counts copies of a text once. Each task sums its counts before they are sent:
    one row per task and language reaches the aggregate, and one per language the driver. The number
    of languages is the bound of what is collected.
    """
    held = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).dropna()
    # a threshold on the hash instead of a sort keeps about `rows` of each language, and no row travels
    counts = {r["lang"]: r["n"] for r in labelled.select(F.col(lang).cast("string").alias("lang")).dropna().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model([], np.zeros(0, np.uint32), np.zeros((len(LENGTHS), SLOTS, 0)), np.zeros(0))
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"{len(counts)} languages; the model holds {MOST_LANGUAGES}")
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, rows / n)))])
    kept = held.where((F.pmod(F.xxhash64("text"), F.lit(1_000_000)) / 1_000_000.0) < share[F.col("lang")])
    schema = pa.schema([("lang", pa.string()), ("counts", pa.list_(pa.int64())), ("scripts", pa.list_(pa.int64()))])
    bits = len(SCRIPTS) + 1

    def count(batches):
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        met: set[int] = set()
        for batch in sliced(batches, "text"):
            each = [(l, t) for l, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()) if not (hash(t) in met or met.add(hash(t)))]
            for name in {l for l, _ in each}:
                words = [w for l, t in each if l == name for w in pieces(t)]
                n, used = sums.setdefault(name, (np.zeros((len(LENGTHS), SLOTS), np.int64), np.zeros(bits, np.int64)))
                for at in range(0, len(words), 50_000):
                    codes = _codes(words[at : at + 50_000])
                    for i, length in enumerate(LENGTHS):
                        slots = _slots(codes, length)
                        n[i] += np.bincount(slots[slots >= 0], minlength=SLOTS)
                    seen = np.bitwise_or.reduce(_SCRIPT[codes], axis=1)
                    used += np.array([(seen >> b & 1).sum() for b in range(bits)], dtype=np.int64)
        for name, (n, used) in sums.items():
            # sparse: the slots in use and their counts, one after the other
            flat = np.flatnonzero(n)
            yield record(schema, [name], [np.stack([flat, n.ravel()[flat]]).ravel().tolist()], [used.tolist()])

    languages = sorted(counts)
    place = {name: k for k, name in enumerate(languages)}
    n = np.zeros((len(LENGTHS), SLOTS, len(languages)))
    used = np.zeros((len(languages), bits))
    for row in kept.mapInArrow(tidily(count), "lang string, counts array<long>, scripts array<long>").toLocalIterator():
        flat = np.array(row["counts"], dtype=np.int64).reshape(2, -1)
        n[:, :, place[row["lang"]]] += np.bincount(flat[0], flat[1], len(LENGTHS) * SLOTS).reshape(len(LENGTHS), SLOTS)
        used[place[row["lang"]]] += row["scripts"]
    tables = np.log((n + 0.5) / (n.sum(axis=1, keepdims=True) + 0.5 * SLOTS))
    common = used > 0.01 * np.maximum(used.sum(axis=1, keepdims=True), 1)  # a stray foreign word adds no script
    scripts = (common * (1 << np.arange(bits))).sum(axis=1).astype(np.uint32)
    total = np.array([counts[k] for k in languages], dtype=float)
    return Model(languages, scripts, tables.astype(np.float32), total / total.sum())


class Words(dict):
    """Numbers words as they are looked up."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def best_paths(scores: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """The label of every word on its text's best path; texts lie one after the other.

    All texts advance together, longest first, so a step is one array operation over the texts
    that still have words. Ties prefer staying, then the lower label.
    """
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    lengths = lengths[order]
    labels = np.zeros(len(scores), dtype=np.int32)
    if not len(lengths) or not lengths[0]:
        return labels
    alive = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")  # texts with a word at each step
    came = np.zeros(scores.shape, dtype=np.int16)
    state = scores[begin[: alive[0]]]
    last = np.zeros(len(lengths), dtype=np.int64)
    for t in range(1, lengths[0]):
        n = alive[t]
        if n < len(state):
            last[n : len(state)] = state[n:].argmax(axis=1)
            state = state[:n]
        top = state.argmax(axis=1)
        other = state[np.arange(n), top][:, None] - switch
        at = begin[:n] + t
        moved = other > state
        came[at] = np.where(moved, top[:, None], -1)
        state = np.where(moved, other, state) + scores[at]
    last[: len(state)] = state.argmax(axis=1)
    now = last[: alive[-1]]
    for t in range(lengths[0] - 1, -1, -1):
        if alive[t] > len(now):
            now = np.concatenate([now, last[len(now) : alive[t]]])
        at = begin[: alive[t]] + t
        labels[at] = now
        back = came[at, now]
        now = np.where(back >= 0, back, now)
    return labels


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", switch: float = SWITCH, carry: bool = False) -> DataFrame:
    """(key, lang_pred, score, n_words, spans) for every row; with ``carry``, all columns of ``docs`` and, last, a struct of these
    (``found``, or ``common.unused`` of it).

    ``spans`` are runs of words of one language: language, first and last word (exclusive, counted over the
    pieces between white space) and letters. ``score`` is the share of the text's letters in spans of the
    predicted language, 0 to 1. A null text, or one without letters, gets ``und``, score 0 and no spans. Texts
    whose letters belong to no learned script get the commonest language and score 0. Equal totals: the
    language first in order.
    """
    extra = unused(docs, "found")
    if carry:
        rows, text_at = docs.withColumn(text, F.col(text).cast("string")), text
    else:
        rows, text_at = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")), "text"
    columns, fields = rows.columns, rows.schema
    held = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("lang", pa.string()), ("first", pa.int32()), ("end", pa.int32()), ("letters", pa.int64())])
    schema = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("n_words", pa.int64()), ("spans", pa.list_(span))])

    def label(batches):
        m = held.value
        words, scores, letters = Words(), np.zeros((0, len(m.languages)), np.float32), np.zeros(0, np.int64)
        for batch in sliced(batches, text_at):
            if len(words) > CACHED:
                words, scores, letters = Words(), scores[:0], letters[:0]
            each = [pieces(t) if t else [] for t in batch.column(text_at).to_pylist()]
            lengths = np.array([len(w) for w in each], dtype=np.int64)
            ids = np.fromiter((words[w] for ws in each for w in ws), dtype=np.int64, count=lengths.sum())
            del each
            fresh = list(words)[len(scores) :]
            for at in range(0, len(fresh), 50_000):
                s, l = m.score(fresh[at : at + 50_000])
                scores, letters = np.concatenate([scores, s.astype(np.float32)]), np.concatenate([letters, l])
            del fresh
            size = letters[ids]
            text_of = np.repeat(np.arange(len(lengths)), lengths)
            total = np.bincount(text_of, size, len(lengths)).astype(np.int64)
            if not m.languages:
                pred, score, spans = ["und"] * len(lengths), np.zeros(len(lengths)), [[]] * len(lengths)
            else:
                found = scores[ids]
                labels = best_paths(found, lengths, switch)
                known = size * (np.abs(found).max(axis=1, initial=0) > 0)
                k = len(m.languages)
                by = np.bincount(text_of * k + labels, known, len(lengths) * k).reshape(-1, k)
                best = np.where(by.max(axis=1) > 0, by.argmax(axis=1), int(m.prior.argmax()))
                within = np.bincount(text_of * k + labels, size, len(lengths) * k).reshape(-1, k)
                score = np.where(by.max(axis=1) > 0, within[np.arange(len(best)), best] / np.maximum(total, 1), 0.0)
                pred = [m.languages[b] if n else "und" for b, n in zip(best, total)]
                score = np.where(total > 0, score, 0.0)
                spans = _runs(labels, size, lengths, total, m.languages)
            out = record(schema, pred, score, lengths, pa.array(spans, schema.field("spans").type))
            found_ = pa.StructArray.from_arrays(out.columns, names=schema.names)
            yield pa.RecordBatch.from_arrays([*batch.columns, found_], names=[*columns, extra])

    kind = "struct<lang_pred:string,score:double,n_words:long,spans:array<struct<lang:string,first:int,end:int,letters:long>>>"
    if carry:
        return rows.mapInArrow(tidily(label), StructType([*fields, StructField(extra, _parse_datatype_string(kind))]))

    def lean(batches):
        for batch in label(batches):
            yield pa.RecordBatch.from_arrays([batch.column("key"), *batch.column(extra).flatten()], names=["key", *schema.names])

    out = rows.mapInArrow(tidily(lean), f"key {rows.schema['key'].dataType.simpleString()}, lang_pred string, score double, n_words long, spans array<struct<lang:string,first:int,end:int,letters:long>>")
    return out.withColumnRenamed("key", key)


def _runs(labels, size, lengths, total, languages) -> list[list[dict]]:
    ends = np.cumsum(lengths)
    begins = ends - lengths
    new = np.ones(len(labels), dtype=bool)
    new[1:] = labels[1:] != labels[:-1]
    new[begins[lengths > 0]] = True
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(labels))
    letters = np.add.reduceat(size, first) if len(first) else np.zeros(0, np.int64)
    low, high = np.searchsorted(first, begins), np.searchsorted(first, ends)
    return [
        [{"lang": languages[labels[first[r]]], "first": int(first[r] - b), "end": int(last[r] - b), "letters": int(letters[r])} for r in range(lo, hi)] if n else []
        for b, lo, hi, n in zip(begins, low, high, total)
    ]
