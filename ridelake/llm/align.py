"""Two tokenizers' tokens aligned: groups that end at the same byte, links of tokens whose bytes overlap.

A run of tokens is a fragment of an associative monoid: what stands before its first common end (open prefix), the groups
between common ends (closed), and what stands after the last (open suffix). Two neighbouring fragments compose: the left one's suffix
and the right one's prefix close one more group. So documents are cut anywhere, and fragments meet in any bracketing.

* Words (cut before a space that follows other than white space) are encoded alone, as no token of either tokenizer reaches
  across such a cut. A word's fragment is closed on both sides. Documents up to ``RANGE`` bytes are products of
  their words' fragments, which a task keeps by word.
* Longer documents are cut into byte ranges, inside words and characters. A range belongs to whatever task; it encodes the words
  that touch it and keeps the tokens that end in it. Closed groups leave at once as rows; open ends climb a
  tree of ``FAN`` children a node, one job a level, until each document is one fragment. Its groups are hashed in order as a stream.

Offsets are bytes of a space and the text. Texts that are null, empty, or not given back byte by byte by both tokenizers have no
tokens. Every row is a document of its own, repeated rows and equal or null keys too. Other columns are not read.
A word longer than a range stays in one range. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import parts, sliced, tidily
from ridelake.operators.lookup import sized
from ridelake.session import materialise

RANGE = 32 << 10  # bytes
TOGETHER = 1 << 20  # bytes of ranges that a task takes together
FAN = 16  # fragments composed by one task at a time
KEPT_WORDS, KEPT_BYTES = 250_000, 4096  # distinct words that a task keeps, and the longest
COUNTS_BYTES = 32 << 20  # of pair counts that are sent to all tasks; more are joined by a shuffle

# Before a space that follows printable ASCII or another character that is no white space (fixed list), and that is not the last byte.
_CUT = re.compile(rb"(?<=[\x21-\x7e\x80-\xbf])(?<!\xc2\x85)(?<!\xc2\xa0)(?<!\xe1\x9a\x80)(?<!\xe2\x80[\x80-\x8a\xa8\xa9\xaf])(?<!\xe2\x81\x9f)(?<!\xe3\x80\x80) (?=.)", re.S)


_CONTROLS = bytes([*range(0x20), 0x7F]).replace(b"\n", b"")
# Ends of the multi-byte white space above, before a space; the first two bytes stand for many.
_WIDE = (b"\xc2\x85 ", b"\xc2\xa0 ", b"\xe1\x9a\x80 ", b"\xe2\x80", b"\xe2\x81\x9f ", b"\xe3\x80\x80 ")


def _cut_at_every_space(text: bytes) -> bool:
    """Whether ``_CUT`` certainly cuts at all spaces of the text."""
    if text[:1] == b" " or text[-1:] == b" " or b"  " in text or b"\n " in text or len(text.translate(None, _CONTROLS)) < len(text):
        return False
    return text.isascii() or not any(x in text for x in _WIDE)


class Tokens(NamedTuple):
    """Both tokenizers' ids and the byte at which each token ends."""

    a: list[int]
    a_end: list[int]
    b: list[int]
    b_end: list[int]

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(x + y for x, y in zip(self, other)))


NONE = Tokens([], [], [], [])


class Fragment(NamedTuple):
    """Open ends of a run; ``closed``: it has a common end. Without one all tokens are in ``prefix``."""

    closed: bool
    prefix: Tokens
    suffix: Tokens


class Groups(NamedTuple):
    """Closed groups in order, the byte at which the last ends, and the pair of ids (A << 32 | B) of every link."""

    text: str
    n: int
    end: int
    links: list[int]


def groups(tokens: Tokens) -> Groups:
    """Tokens that begin and end at common ends, as groups."""
    a, a_end, b, b_end = tokens
    texts, links = [], []
    i = j = i0 = j0 = end = 0
    while i < len(a) and j < len(b):
        links.append(a[i] << 32 | b[j])
        x, y = a_end[i], b_end[j]
        if x <= y:
            i += 1
        if y <= x:
            j += 1
        if x == y:
            texts.append(",".join(map(str, a[i0:i])) + "|" + ",".join(map(str, b[j0:j])))
            i0, j0, end = i, j, x
    return Groups(";".join(texts), len(texts), end, links)


def _between(tokens: Tokens, after: int, upto: int) -> Tokens:
    a, a_end, b, b_end = tokens
    i, j = np.searchsorted(a_end, [after, upto], "right"), np.searchsorted(b_end, [after, upto], "right")
    return Tokens(a[i[0] : i[1]], a_end[i[0] : i[1]], b[j[0] : j[1]], b_end[j[0] : j[1]])


def fragment(tokens: Tokens) -> tuple[Fragment, Groups | None]:
    """The fragment of a run, and its closed groups."""
    both = np.intersect1d(tokens.a_end, tokens.b_end)
    if not len(both):
        return Fragment(False, tokens, NONE), None
    first, last = int(both[0]), int(both[-1])
    inside = groups(_between(tokens, first, last)) if last > first else None
    return Fragment(True, _between(tokens, -1, first), _between(tokens, last, 1 << 62)), inside


def compose(left: Fragment, right: Fragment) -> tuple[Fragment, Groups | None]:
    """The fragment of both in order, and the group that closes where they meet."""
    if left.closed and right.closed:
        return Fragment(True, left.prefix, right.suffix), groups(left.suffix + right.prefix)
    if left.closed:
        return Fragment(True, left.prefix, left.suffix + right.prefix), None
    return Fragment(right.closed, left.prefix + right.prefix, right.suffix), None


class Pair:
    """A byte-level BPE (A) and a sentence-piece model (B) for words with their leading space.

    ``a_bytes`` and ``b_bytes`` are the bytes of every id. A's ranks are its ids, so words of usual length go to a faster
    library with the same vocabulary and pattern; others to the file's own.
    """

    USUAL = 256  # bytes

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import sentencepiece
        import tiktoken
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [k for k in range(256) if k not in shown]
        byte = {chr(k): k for k in shown} | {chr(256 + n): k for n, k in enumerate(hidden)}
        special = {k for k, token in self.a.get_added_tokens_decoder().items() if token.special}
        level = [self.a.id_to_token(k) for k in range(self.a.get_vocab_size())]
        self.a_bytes = [t.encode() if k in special else bytes(byte[c] for c in t) for k, t in enumerate(level)]
        self.b_bytes = [self._piece(self.b.id_to_piece(k)) for k in range(self.b.get_piece_size())]
        self.a_length, self.b_length = (np.array([len(x) for x in table], dtype=np.int64) for table in (self.a_bytes, self.b_bytes))
        ranks = {t: k for k, t in enumerate(self.a_bytes) if k not in special}
        self.fast = tiktoken.Encoding("A", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _piece(piece: str) -> bytes:
        code = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(code[1], 16)]) if code else piece.replace("▁", " ").encode()

    def encode(self, words: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and for B: ids of all words one after the other, and how many each word has."""
        texts = [w.decode() for w in words]
        # words that begin with a space and end with another sign are cut off from each other by A's pattern: one call for all
        together = np.array([len(w) <= self.USUAL and w[-1] > 0x20 and w[-1] < 0x7F for w in words], dtype=bool)
        ids = np.array(self.fast.encode_ordinary("".join([t for t, x in zip(texts, together) if x])), dtype=np.int64)
        ends = np.cumsum(self.a_length[ids])
        word_ends = np.cumsum(np.array([len(w) for w in words], dtype=np.int64)[together])
        at = np.searchsorted(ends, word_ends)
        if len(word_ends) and not (ends[np.minimum(at, len(ends) - 1)] == word_ends).all():
            raise AssertionError("a token of A reaches across a cut")
        count = np.zeros(len(words), dtype=np.int64)
        count[together] = np.diff(at + 1, prepend=0)
        if not together.all():
            alone = [k for k, x in enumerate(together.tolist()) if not x]
            own = [self.fast.encode_ordinary(texts[k]) if len(words[k]) <= self.USUAL else self.a.encode(texts[k], add_special_tokens=False).ids for k in alone]
            count[alone] = [len(x) for x in own]
            flat = np.zeros(count.sum(), dtype=np.int64)
            of = np.repeat(together, count)
            flat[of], flat[~of] = ids, np.array(list(chain.from_iterable(own)), dtype=np.int64)
            ids = flat
        theirs = self.b.encode([t[1:] for t in texts], num_threads=1)
        return [(ids, count), (np.array(list(chain.from_iterable(theirs)), dtype=np.int64), np.fromiter(map(len, theirs), dtype=np.int64, count=len(theirs)))]


@lru_cache(maxsize=1)
def _loaded(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


class Tokenizers(NamedTuple):
    """Files of A and B; a worker loads them once."""

    a_path: str
    b_path: str

    def __call__(self) -> Pair:
        return _loaded(self.a_path, self.b_path)


def words(text: bytes) -> list[bytes]:
    return [b" " + part for part in (text.split(b" ") if _cut_at_every_space(text) else _CUT.split(text))]


def token_runs(pair_: Pair, distinct: list[bytes]) -> list[Tokens | None]:
    """Tokens of each word, or None where the bytes of either side are not the word's."""
    out = []
    each = [[x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] for ids, count in pair_.encode(distinct)] if distinct else [[], []]
    for word, a, b in zip(distinct, *each):
        x, y = [pair_.a_bytes[k] for k in a], [pair_.b_bytes[k] for k in b]
        good = b"".join(x) == word and b"".join(y) == word and all(x) and all(y)
        out.append(Tokens(list(a), list(accumulate(map(len, x))), list(b), list(accumulate(map(len, y)))) if good else None)
    return out


class _Grown:
    """A numpy array that grows at its end."""

    def __init__(self, width: int = 0):
        self.n, self.held = 0, np.zeros((1024, width) if width else 1024, dtype=np.int64)

    def extend(self, new: np.ndarray) -> None:
        while self.n + len(new) > len(self.held):
            self.held = np.concatenate([self.held, np.zeros_like(self.held)])
        self.held[self.n : self.n + len(new)] = new
        self.n += len(new)

    def all(self) -> np.ndarray:
        return self.held[: self.n]


class Words:
    """Fragments of distinct words by number: counts, groups and links, computed for many new words at a time."""

    def __init__(self, pair_: Pair):
        self.pair = pair_
        self.length = [pair_.a_length, pair_.b_length]
        names = [[str(k) for k in range(len(n))] for n in self.length]
        # an id and what follows it: another id of its side, the other side, another group, nothing
        self.named = [{end: np.array([n + end for n in side], dtype=object) for end in ends} for side, ends in zip(names, (",|", ",;"))]
        self.named[1][""] = np.array(names[1], dtype=object)
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.texts: list[str] = []
        self.counts = _Grown(4)  # of A, B, groups, links; -1: bytes differ
        self.links, self.begin = _Grown(), _Grown()
        self.begin.extend(np.zeros(1, dtype=np.int64))

    def add(self, new: list[bytes]) -> None:
        sides = self.pair.encode(new)
        size = np.fromiter(map(len, new), dtype=np.int64, count=len(new))
        counts, whole = [count for _, count in sides], b"".join(new)
        good = np.ones(len(new), dtype=bool)
        for (flat, count), length, table in zip(sides, self.length, (self.pair.a_bytes, self.pair.b_bytes)):
            total = np.concatenate([[0], np.cumsum(length[flat])])
            ends = np.cumsum(count)
            good &= (total[ends] - total[ends - count] == size) & (np.bincount(np.repeat(np.arange(len(new)), count), length[flat] == 0, len(new)) == 0)
            given = list(map(table.__getitem__, flat.tolist()))
            if b"".join(given) != whole:
                good &= np.array([b"".join(given[e - n : e]) == w for e, n, w in zip(ends.tolist(), count.tolist(), new)], dtype=bool)
        at = np.flatnonzero(good)
        ids = [flat if len(at) == len(new) else flat[np.repeat(good, count)] for flat, count in sides]
        a_end, b_end = (np.cumsum(length[x]) for length, x in zip(self.length, ids))
        word_end = np.cumsum(size[at])
        both, every = np.intersect1d(a_end, b_end, assume_unique=True), np.union1d(a_end, b_end)
        n_links, n_groups = np.zeros(len(new), dtype=np.int64), np.zeros(len(new), dtype=np.int64)
        n_links[at] = np.diff(np.searchsorted(every, word_end, "right"), prepend=0)
        n_groups[at] = np.diff(np.searchsorted(both, word_end, "right"), prepend=0)
        # groups in order: A's tokens of each, then B's
        upto = [np.searchsorted(end, both, "right") for end in (a_end, b_end)]
        in_a, in_b = np.searchsorted(both, a_end), np.searchsorted(both, b_end)
        before_b = np.concatenate([[0], upto[1]])
        seq = np.empty(len(a_end) + len(b_end), dtype=object)
        closes_a, closes_b = np.isin(a_end, both, assume_unique=True), np.isin(b_end, both, assume_unique=True)
        ends_word = np.isin(b_end, word_end, assume_unique=True)
        if len(both):
            name = self.named
            seq[np.arange(len(a_end)) + before_b[in_a]] = np.where(closes_a, name[0]["|"][ids[0]], name[0][","][ids[0]])
            seq[np.arange(len(b_end)) + upto[0][in_b]] = np.where(ends_word, name[1][""][ids[1]], np.where(closes_b, name[1][";"][ids[1]], name[1][","][ids[1]]))
        tokens = np.where(good, counts[0] + counts[1], 0)
        cut = np.concatenate([[0], np.cumsum(tokens)]).tolist()
        listed = seq.tolist()
        first = len(self.texts)
        self.texts += ["".join(listed[x:y]) for x, y in zip(cut, cut[1:])]
        self.number.update(zip(new, range(first, first + len(new))))
        self.counts.extend(np.stack([np.where(good, counts[0], -1), np.where(good, counts[1], 0), n_groups, n_links], axis=1))
        self.links.extend(ids[0][np.searchsorted(a_end, every)] << 32 | ids[1][np.searchsorted(b_end, every)])
        self.begin.extend(self.begin.all()[-1] + np.cumsum(n_links))

    def numbers(self, docs: list[list[bytes]]) -> list[list[int]]:
        if len(self.texts) > KEPT_WORDS:
            self.clear()
        new = list(set(chain.from_iterable(docs)).difference(self.number))
        for at in range(0, len(new), 20_000):
            self.add(new[at : at + 20_000])
        return [list(map(self.number.__getitem__, doc)) for doc in docs]

    def forget_long(self) -> None:
        """Long words leave the table with their texts; they are rare, and a table of them could be of any size."""
        if any(len(w) > KEPT_BYTES for w in self.number):
            self.clear()


def products(texts: list[list[bytes]], known: Words) -> dict[str, list]:
    """Counts, digest, text of groups, and distinct pairs with their links of each run of words; whether it has words that are all given back."""
    numbers = known.numbers(texts)
    counts, begin = known.counts.all(), known.begin.all()
    n_words = np.array([len(x) for x in numbers], dtype=np.int64)
    flat = np.fromiter(chain.from_iterable(numbers), dtype=np.int64, count=int(n_words.sum()))
    doc = np.repeat(np.arange(len(texts)), n_words)
    good = n_words > 0
    good[doc[counts[flat, 0] < 0]] = False
    kept = good[doc]
    totals = np.stack([np.bincount(doc[kept], counts[flat[kept], k], len(texts)) for k in range(4)]).astype(np.int64)
    joined = [";".join(map(known.texts.__getitem__, x)) if ok else "" for x, ok in zip(numbers, good)]
    # links of distinct words of a document, then of distinct pairs
    each, often = np.unique(doc[kept] << 32 | flat[kept], return_counts=True)
    word = each & 0xFFFFFFFF
    n = begin[word + 1] - begin[word]
    at = np.repeat(begin[word] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else n
    pairs, owner, times = known.links.all()[at], np.repeat(each >> 32, n), np.repeat(often, n)
    order = np.lexsort((pairs, owner))
    pairs, owner, times = pairs[order], owner[order], times[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(pairs)), dtype=bool), (pairs[1:] != pairs[:-1]) | (owner[1:] != owner[:-1])]))
    times = np.add.reduceat(times, first) if len(first) else times
    ends = np.searchsorted(owner[first], np.arange(len(texts) + 1))
    lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int64())) for x in (pairs[first], times)]
    return {
        "good": good,
        **{name: totals[k] for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
        "groups_sha256": [hashlib.sha256(t.encode()).hexdigest() if ok else "" for t, ok in zip(joined, good)],
        "groups": joined,
        "pairs": lists[0],
        "times": lists[1],
    }


def ranges(text: bytes, size: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(after, upto, start, bytes): byte ranges of a space and the text, and from where on the words that touch each.

    A range ends after ``size`` bytes, wherever that is, unless the word there is longer than that: then before
    it or after it.
    """
    data = b" " + text
    low = start = 0
    while low < len(data):
        wanted, after = low + size, len(data)
        high, again = len(data), len(data)
        if wanted < len(data):
            here = start
            for cut in _CUT.finditer(data, start + 1):
                if cut.start() > wanted:
                    after = cut.start()
                    break
                here = cut.start()
            if after - here <= size:
                high, again = wanted, here
            else:  # a long word
                high = again = here if here > low else after
                after = high
        yield low, high, start, data[start : max(after, high)]
        low, start = high, again


_SIDES = ("a", "a_end", "b", "b_end")
_NODE = (
    "row long, node long, good boolean, n_a long, n_b long, closed boolean, "
    + ", ".join(f"{side}_{name} array<long>" for side in ("prefix", "suffix") for name in _SIDES)
    + ", `at` long, text string, n_groups long, pairs array<long>, times array<long>"
)
_NODE_NAMES = [x.split()[0].strip("`") for x in _NODE.split(", ")]


def _node(row: int, node: int, good: bool, n_a: int, n_b: int, f: Fragment) -> tuple:
    return (row, node, good, n_a, n_b, f.closed, *f.prefix, *f.suffix, None, None, None, None, None)


def _counted(found: Groups) -> tuple:
    """(last byte, text, groups, distinct pairs, links of each)."""
    pairs, times = np.unique(np.array(found.links, dtype=np.int64), return_counts=True)
    return found.end, found.text, found.n, pairs.tolist(), times.tolist()


def _closed(row: int, counted: tuple) -> tuple:
    return (row, None, None, None, None, None, *[None] * 8, *counted)


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == most:
            yield batch()
            held = []
    if held:
        yield batch()


_SCHEMA = pa.schema(
    [
        (x.split()[0].strip("`"), {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}[x.split()[1]])
        for x in _NODE.split(", ")
    ]
)


def _leaves(rows: list[dict], known: Words) -> Iterator[tuple]:
    """Ranges' open ends and closed groups. Words are closed on both sides; only those that a range cuts are taken apart."""
    cut = []
    for r in rows:
        inner, ends, at = [], [], r["start"]
        for word in words(r["data"][1:]):
            if at < r["low"] or at + len(word) > r["high"]:
                ends.append((at, word))
            else:
                inner.append(word)
            at += len(word)
        cut.append((inner, ends))
    found = products([inner for inner, _ in cut], known)
    for k, (r, (inner, ends)) in enumerate(zip(rows, cut)):
        good, n_a, n_b, f = not inner or bool(found["good"][k]), int(found["n_a"][k]), int(found["n_b"][k]), None
        closed = []
        if inner:
            f = Fragment(True, NONE, NONE)
            end = r["start"] + sum(map(len, inner)) + sum(len(w) for at, w in ends if at < r["low"])
            closed.append((end, found["groups"][k], int(found["n_groups"][k]), found["pairs"][k].as_py(), found["times"][k].as_py()))
        runs = token_runs(known.pair, [w for _, w in ends])
        for (at, _), tokens in zip(ends, runs):
            if tokens is None:
                good = False
                break
            part = _between(Tokens(tokens.a, [x + at for x in tokens.a_end], tokens.b, [x + at for x in tokens.b_end]), r["low"], r["high"])
            n_a, n_b = n_a + len(part.a), n_b + len(part.b)
            own, inside = fragment(part)
            order = (f, own) if f is None or at >= r["low"] else (own, f)
            f, group = (own, None) if f is None else compose(*order)
            closed += [_counted(g) for g in (group, inside) if g and g.n]
        yield _node(r["row"], r["node"], good, n_a, n_b, f if good and f else Fragment(False, NONE, NONE))
        if good:
            for c in closed:
                yield _closed(r["row"], c)


def _fold(rows: Iterator[dict], last: bool) -> Iterator[tuple]:
    """Fragments of one parent after another, in order; ``last``: documents' ends close what is open."""
    now, acc = None, None

    def tokens(r: dict, side: str) -> Tokens:
        return Tokens(*(r[f"{side}_{n}"] for n in _SIDES))

    def done() -> Iterator[tuple]:
        good, n_a, n_b, f = acc
        if last and good:
            good = f.closed and f.suffix == NONE
            if good:
                first = groups(f.prefix)
                if first.n:
                    yield _closed(now[0], _counted(first))
        yield _node(now[0], now[1], good, n_a, n_b, f)

    for r in rows:
        f = Fragment(r["closed"], tokens(r, "prefix"), tokens(r, "suffix"))
        if (r["row"], r["parent"]) != now:
            if now:
                yield from done()
            now, acc = (r["row"], r["parent"]), (r["good"], r["n_a"], r["n_b"], f)
            continue
        both, group = compose(acc[3], f)
        acc = (acc[0] and r["good"], acc[1] + r["n_a"], acc[2] + r["n_b"], both)
        if group and group.n and acc[0]:
            yield _closed(now[0], _counted(group))
    if now:
        yield from done()


def _in_order(batches, names) -> Iterator[dict]:
    for batch in batches:
        for k in range(0, batch.num_rows, 64):
            yield from batch.slice(k, 64).select(names).to_pylist()


def _together(rows: Iterator[dict], most: int) -> Iterator[list[dict]]:
    """``rows`` in lists that have at most ``most`` bytes of data (or one row)."""
    held, size = [], 0
    for r in rows:
        if held and size + len(r["data"]) > most:
            yield held
            held, size = [], 0
        held.append(r)
        size += len(r["data"])
    if held:
        yield held


class Alignment(NamedTuple):
    """``documents``: id, key, n_a, n_b, n_groups, n_links, groups_sha256. ``links``: id, pair, times, one row for each distinct pair of a document.
    ``groups``: id, at, groups: texts of closed groups that end at byte ``at``, in order of it."""

    documents: DataFrame
    links: DataFrame
    groups: DataFrame


def align(docs: DataFrame, tokenizers: Callable[[], Pair], key: str = "doc_id", text: str = "text", size: int = RANGE, fan: int = FAN, with_groups: bool = False) -> Alignment:
    """Both tokenizers' alignment of every row's whole text, as stored tables. ``groups`` is empty without ``with_groups``
    for documents of one range."""
    spark = docs.sparkSession
    n_parts = parts(spark)
    every = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias("text"))
    kind = every.schema["key"].dataType.simpleString()
    long_one = F.coalesce(F.length("text") > size, F.lit(False))

    def short(batches):
        known = Words(tokenizers())
        for batch in sliced(batches, "text"):
            found = products([words(t) if t else [] for t in batch.column("text").to_pylist()], known)
            del found["good"]
            if not with_groups:
                found["groups"] = pa.nulls(batch.num_rows, pa.string())
            known.forget_long()
            yield pa.RecordBatch.from_arrays([batch.column("key"), *(v if isinstance(v, pa.Array) else pa.array(v) for v in found.values())], names=["key", *found])

    fields = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, pairs array<long>, times array<long>"
    shorts = every.where(~long_one).mapInArrow(tidily(short), f"key {kind}, {fields}")
    shorts = materialise(shorts.withColumn("id", F.monotonically_increasing_id()), "aligned")

    def cut(batches):
        schema = pa.schema([("row", pa.int64()), ("key", batch_type), ("node", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("start", pa.int64()), ("data", pa.binary())])

        def rows():
            for batch in batches:
                for k in range(batch.num_rows):
                    row, name, data = (batch.column(c)[k].as_py() for c in ("row", "key", "text"))
                    for node, (low, high, start, part) in enumerate(ranges(data, size)):
                        yield row, name, node, low, high, start, part

        yield from _batches(rows(), schema, 64)

    batch_type = _arrow_type(every)
    numbered = every.where(long_one).withColumn("row", -1 - F.monotonically_increasing_id())
    pieces = materialise(numbered.mapInArrow(tidily(cut), f"row long, key {kind}, node long, low long, high long, start long, data binary"), "byte-ranges")
    n_nodes = pieces.agg((F.max("node") + 1).alias("n")).first()["n"] or 0

    def leaves(batches):
        known = Words(tokenizers())

        def rows():
            for held in _together(_in_order(batches, ["row", "node", "low", "high", "start", "data"]), TOGETHER):
                yield from _leaves(held, known)
                known.forget_long()

        yield from _batches(rows(), _SCHEMA)

    levels = [materialise(pieces.repartition(n_parts, "row", "node").mapInArrow(tidily(leaves), _NODE), "fragments")]
    names = [n for n in _NODE_NAMES[:14] if n != "node"] + ["parent"]

    def folded(last):
        def fold(batches):
            yield from _batches(_fold(_in_order(batches, names), last), _SCHEMA)

        return fold

    while n_nodes:
        last = n_nodes <= fan
        nodes = levels[-1].where("node is not null").withColumn("parent", F.expr(f"node div {fan}"))
        nodes = nodes.repartition(n_parts, "row", "parent").sortWithinPartitions("row", "parent", "node")
        levels.append(materialise(nodes.mapInArrow(tidily(folded(last)), _NODE), "fragments"))
        if last:
            break
        n_nodes = -(-n_nodes // fan)
    roots = levels[-1].where("node is not null").select("row", "good", "n_a", "n_b")
    good = roots.where("good").select("row")
    closed = levels[0].where("node is null")
    for level in levels[1:]:
        closed = closed.union(level.where("node is null"))
    closed = closed.join(good, "row", "left_semi")

    def digest(batches):
        def rows():
            now, state, n = None, None, 0
            for r in _in_order(batches, ["row", "text", "n_groups"]):
                if r["row"] != now:
                    if now is not None:
                        yield now, state.hexdigest(), n
                    now, state, n = r["row"], hashlib.sha256(), 0
                state.update((";" if n else "").encode() + r["text"].encode())
                n += r["n_groups"]
            if now is not None:
                yield now, state.hexdigest(), n

        yield from _batches(rows(), pa.schema([("row", pa.int64()), ("groups_sha256", pa.string()), ("n_groups", pa.int64())]))

    texts = closed.select("row", "at", "text", "n_groups").repartition(n_parts, "row").sortWithinPartitions("row", "at")
    hashed = texts.mapInArrow(tidily(digest), "row long, groups_sha256 string, n_groups long")
    pairs = closed.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy("row", F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("times"))
    pairs = materialise(pairs, "long-links")
    n_links = pairs.groupBy("row").agg(F.sum("times").alias("n_links"))
    named = pieces.where("node = 0").select("row", "key")
    longs = named.join(roots, "row").join(hashed, "row", "left").join(n_links, "row", "left")
    value = lambda name, other=0: F.when(F.col("good"), F.coalesce(name, F.lit(other))).otherwise(other).alias(name)
    longs = longs.select(F.col("row").alias("id"), "key", value("n_a"), value("n_b"), value("n_groups"), value("n_links"), value("groups_sha256", ""))
    longs = materialise(longs, "aligned-long")
    documents = shorts.select(longs.columns).union(longs).withColumnRenamed("key", key)
    links = shorts.select("id", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("id", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    whole = shorts.where("groups_sha256 <> '' and groups is not null").select("id", F.lit(None).cast("long").alias("at"), "groups")
    return Alignment(documents, links.union(pairs.select("row", "pair", "times")), whole.union(closed.select("row", "at", "text")))


def _arrow_type(df: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema["key"].dataType)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, a, b, documents, best): how many documents hold a pair, and whether no other pair of its A id is in more."""
    counts = links.groupBy("pair").agg(F.count(F.lit(1)).alias("documents")).withColumn("a", F.shiftright("pair", 32))
    top = counts.groupBy("a").agg(F.max("documents").alias("top"))
    return counts.join(top, "a").select("pair", "a", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "documents", (F.col("documents") == F.col("top")).alias("best"))


def digest(found: Alignment, key: str = "doc_id") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    counts = materialise(pair_counts(found.links), "pair-counts").select("pair", "documents", "best")
    met = found.links.join(sized(counts, COUNTS_BYTES), "pair").groupBy("id").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("documents")).alias("count_sum")
    )
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    return found.documents.join(met, "id", "left").select(f"`{key}`", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
