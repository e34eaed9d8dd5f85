"""Quality rules: compression bands beside counts of words, symbols, repeated lines and repeated word windows.

A text is compressed as a whole and in fixed chunks with zstandard. Prose of a given length compresses within a band:
below it the bytes are close to random (keys, encoded data), above it they repeat. ``BANDS`` has the limits by length, as short
texts compress less; a chunk is held to the limits of its own length. A text is rejected if its ratio leaves its band,
or if more than ``BAD_SHARE`` of its bytes lie in chunks that leave theirs.

One scan, no shuffle; a task holds a slice of texts (``common.SLICE_BYTES``) or its longest text. Null and empty texts
have no words and fail the base rules; texts of any length are compressed whole. Repeated rows are judged
alike, each on its own. Other columns are never read, whatever their names.
Word windows and lines are compared by 64-bit hashes and by text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import mix64, sliced, words_of

LEVEL = 3  # of compression
CHUNK = 4096  # bytes
BAD_SHARE = 0.25  # of a text's bytes that may lie in chunks outside their band
LEAST_WORDS = 50
REPEATED = 50  # percent of words in repeated windows that a text may have
WINDOW = 3  # words

_BLANK = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """Limits of bytes / compressed bytes, both allowed, for texts of at least so many bytes."""

    from_bytes: int
    least: float
    most: float


# Parameters: prose in Latin script has ratios of about 1.3 (some hundred bytes) to 3 (a hundred thousand).
BANDS = (
    Band(0, 0.0, float("inf")),
    Band(128, 0.90, 2.4),
    Band(256, 1.05, 2.6),
    Band(512, 1.15, 2.8),
    Band(1024, 1.25, 3.0),
    Band(2048, 1.35, 3.2),
    Band(4096, 1.40, 3.4),
    Band(16384, 1.45, 3.8),
    Band(65536, 1.50, 4.4),
)

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "n_bytes long, ratio double, n_chunks long, n_bad_chunks long, bad_bytes long"
)


def band_of(size: int, bands: Sequence[Band]) -> Band:
    """The band with the largest start that ``size`` reaches."""
    return max((b for b in bands if b.from_bytes <= size), key=lambda b: b.from_bytes)


def compression(text: bytes, bands: Sequence[Band], chunk: int, compress) -> tuple[float, bool, int, int, int]:
    """A text's ratio, whether it lies in its band, its chunks, those outside theirs, and the bytes in these."""
    if not text:
        return 0.0, True, 0, 0, 0

    def judged(part: bytes) -> tuple[float, bool]:
        ratio, band = len(part) / len(compress(part)), band_of(len(part), bands)
        return ratio, band.least <= ratio <= band.most

    ratio, good = judged(text)
    if len(text) <= chunk:
        return ratio, good, 1, int(not good), 0 if good else len(text)
    bad = [len(part) for part in (text[at : at + chunk] for at in range(0, len(text), chunk)) if not judged(part)[1]]
    return ratio, good, -(-len(text) // chunk), len(bad), sum(bad)


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(_BLANK)]
    return len(lines) - len(set(lines))


def repeated_words(hashes: np.ndarray, begin: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Per text, how many words lie in a window of ``window`` words that the text has twice or more."""
    count = np.diff(begin)
    text = np.repeat(np.arange(len(count)), count)
    n = max(0, len(hashes) - window + 1)
    whole = text[:n] == text[window - 1 :]
    at = np.flatnonzero(whole)
    key = np.zeros(len(at), dtype=np.uint64)
    for k in range(window):
        key = mix64(key * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[at + k] + np.uint64(k + 1))
    key = mix64(key + text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes), dtype=bool)
    for k in range(window):
        covered[at[twice] + k] = True
    return np.bincount(text[covered], minlength=len(count)).astype(np.int64)


def _per_text(flags: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[begin[1:]] - total[begin[:-1]]


def rate(texts: pa.Array, bands: Sequence[Band] = BANDS, chunk: int = CHUNK, least_words: int = LEAST_WORDS, repeated: int = REPEATED) -> dict[str, np.ndarray]:
    """The fields of ``FIELDS`` for each text."""
    data, starts, ends, hashes, begin = words_of(texts, False)
    # a code point is counted at the byte that is not a continuation
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    chars = np.concatenate([[0], np.cumsum(points[ends] - points[starts])])
    symbol = np.zeros(256, dtype=bool)
    symbol[[ord(c) for c in _SYMBOLS]] = True
    plain = texts.cast(pa.large_string()).to_pylist()
    raw = [(t or "").encode() for t in plain]
    cuts = np.concatenate([[0], np.cumsum([len(t) for t in raw], dtype=np.int64)]).astype(np.int64)
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    pressed = [compression(t, bands, chunk, compressor.compress) for t in raw]
    out = {
        "n_words": np.diff(begin),
        "word_chars": chars[begin[1:]] - chars[begin[:-1]],
        "n_symbols": _per_text(symbol[data], cuts),
        "n_dup_lines": np.array([repeated_lines(t or "") for t in plain], dtype=np.int64),
        "n_repeat_words": repeated_words(hashes, begin),
    }
    failed = (out["n_words"] < least_words) | (100 * out["n_repeat_words"] > repeated * out["n_words"])
    size, bad = np.diff(cuts), np.array([p[4] for p in pressed], dtype=np.int64)
    fits = np.array([p[1] for p in pressed], dtype=bool) & (bad <= BAD_SHARE * size)
    return out | {
        "base_failed": failed,
        "kept": ~failed & fits,
        "n_bytes": size,
        "ratio": np.array([p[0] for p in pressed], dtype=np.float64),
        "n_chunks": np.array([p[2] for p in pressed], dtype=np.int64),
        "n_bad_chunks": np.array([p[3] for p in pressed], dtype=np.int64),
        "bad_bytes": bad,
    }


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", bands: Sequence[Band] = BANDS, chunk: int = CHUNK) -> DataFrame:
    """(key, the fields of ``FIELDS``) of every row."""
    only = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = only.schema["key"].dataType.simpleString()

    def part(batches):
        for batch in sliced(batches, "text"):
            fields = rate(batch.column("text"), bands, chunk)
            yield pa.RecordBatch.from_arrays([batch.column("key"), *map(pa.array, fields.values())], names=["key", *fields])

    return only.mapInArrow(part, f"key {kind}, {FIELDS}").withColumnRenamed("key", key)


def keep(docs: DataFrame, text: str = "text", bands: Sequence[Band] = BANDS, chunk: int = CHUNK) -> DataFrame:
    """The rows that pass, with all their columns, whatever these are called."""
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))  # names with dots can't be told from fields
    at = f"c{docs.columns.index(text)}"

    def part(batches):
        for batch in sliced(batches, at):
            yield batch.filter(pa.array(rate(batch.column(at), bands, chunk)["kept"]))

    return plain.mapInArrow(part, plain.schema).toDF(*docs.columns)
