"""Personal data and secrets replaced by keyed surrogates of the same kind and format.

Each entity is reduced to a canonical value (a phone number's national digits, an e-mail address in lower case),
and the value is permuted by a keyed Feistel network within its own format, so equal entities get equal surrogates wherever and
however they are written, and different ones of a format get different ones. Lengths, punctuation, letter case, top-level
domains, country codes and check digits are kept. Names after a title are replaced word by word by invented ones of the
same script and gender; a family name alone and with a given name gets the same surrogate, and so does every other mention of
these names in the same text, with or without a title. All distinct entities are checked
together: where a surrogate is some real value, or two values would meet, the greater value is drawn again. Redrawn names and local parts of
e-mail addresses grow, so there are always enough; in formats of fixed length a surrogate may after ``FOREIGN_ROUNDS`` draws
be a real value of another entity, as where all values are in use none else is left. After ``MOST_ROUNDS`` an error says which kind has run out.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.llm.common import sliced, tidily, unused
from ridelake.session import materialise

FOREIGN_ROUNDS = 6  # draws that look for a value no text holds
MOST_ROUNDS = 40
MOST_REDRAWN = 100_000  # entities drawn again that are sent to every task; more are joined to the texts

# Titles by the gender they tell.
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Señora", "Sra", "Г-жа", "Госпожа"],
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "Господин"],
    "n": ["Dr", "Prof"],
}
# Syllables and endings of invented names by script.
SYLLABLES = {
    "latin": "ba be bo da de di do fa fe ga go ha he ka ke ko la le li lo ma me mi mo na ne no pa pe ra re ri ro sa se so ta te to va".split(),
    "cyrillic": "ба бе бо ва ве во га го да де до за зо ка ке ко ла ле ло ма ме мо на не но па по ра ре ро са се со та те то фа".split(),
}
ENDINGS = {"latin": {"f": "lia", "m": "rk", "n": "n", "family": "wen"}, "cyrillic": {"f": "лия", "m": "рк", "n": "н", "family": "вин"}}

_GENDER = {t: g for g, titles in TITLES.items() for t in titles} | {t.upper(): g for g, titles in TITLES.items() for t in titles}
# Names of things that follow "Ms" and are no persons.
_THINGS = {"word", "excel", "office", "windows", "access", "outlook", "powerpoint", "teams", "project", "paint", "dos", "sql"}
_WORD = r"[^\W\d_]+(?:['’][^\W\d_]+)?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_ENTITY = re.compile(
    rf"""(?P<key>(?<![A-Za-z0-9])AKIA[0-9A-Z]{{16}}(?![A-Za-z0-9]))
    |(?P<hex>(?<![A-Za-z0-9])[0-9a-f]{{32,64}}(?![A-Za-z0-9]))
    |(?P<email>[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}})
    |(?P<iban>(?<![A-Za-z0-9])[A-Z]{{2}}\d{{2}}(?:[ ]?[A-Z0-9]{{4}}){{2,7}}(?:[ ]?[A-Z0-9]{{1,3}})?(?![A-Za-z0-9]))
    |(?P<ip>(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d))
    |(?P<card>(?<![\d+])\d(?:[ -]?\d){{12,18}}(?!\d))
    |(?P<ssn>(?<![\d-])\d{{3}}-\d{{2}}-\d{{4}}(?![\d-]))
    |(?P<phone>(?<![\w+])(?:\+\d{{1,3}}[ .-]?)?(?:\(\d{{2,4}}\)|\d{{2,4}})[ .-]?\d{{3,4}}[ .-]?\d{{3,4}}(?!\d))
    |(?P<name>\b(?:{"|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True))})\.?[ \u00a0](?:{_WORD}(?:[ \u00a0-](?=[^\W\d_a-zа-яß-ÿ]))?){{1,3}})""",
    re.VERBOSE,
)
_WORTH = re.compile("[0-9@]")
_HINTS = tuple(f"{t}{end}" for t in _GENDER for end in (" ", ". ", "\u00a0", ".\u00a0"))


def _script(word: str) -> str:
    return "cyrillic" if "Ѐ" <= word[0] <= "ӿ" else "latin"


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) of the entities of a text, in order."""
    if not _WORTH.search(text) and not any(h in text for h in _HINTS):
        return []
    out = []
    named: dict[str, str] = {}
    for m in _ENTITY.finditer(text):
        kind, raw = m.lastgroup, m[0]
        if kind == "name":
            title = re.match(r"[^ \u00a0.]+", raw)[0]
            words = [w for w in re.finditer(_WORD, text[m.start() : m.end()]) if w.start() > len(title) - 1]
            words = [w for w in words if w[0][0].isupper()]
            if words and words[0][0].casefold() in _THINGS:
                continue
            for k, w in enumerate(words):
                role = "family" if k == len(words) - 1 else _GENDER[title]
                kind = f"name_{role}_{_script(w[0])}"
                out.append((m.start() + w.start(), m.start() + w.end(), kind, w[0].casefold()))
                # a family name is one everywhere; single letters are no names
                if len(w[0]) > 1 and (role == "family" or w[0].casefold() not in named):
                    named[w[0].casefold()] = kind
            continue
        if kind in ("card", "phone", "ssn"):
            value = re.sub(r"\D", "", raw)
            if kind == "phone":
                if len(value) < 9:
                    continue
                value = value[-10:]
        elif kind == "iban":
            value = raw.replace(" ", "")
        else:
            value = raw.lower() if kind == "email" else raw
        out.append((m.start(), m.end(), kind, value))
    if named:
        out = _mentions(text, out, named)
    return out


def _mentions(text: str, found: list[tuple[int, int, str, str]], named: dict[str, str]) -> list[tuple[int, int, str, str]]:
    """``found`` and what else in the text is written with a capital like one of its ``named`` persons."""
    # a word that is also written small there is a word of the language
    starts, ends = [f[0] for f in found], [f[1] for f in found]
    more, common = [], set()
    for w in re.finditer(_WORD, text):
        value = w[0].casefold()
        if value not in named:
            value = re.sub(r"['’]s$", "", value)
            if value not in named:
                continue
        at = bisect_right(starts, w.start())
        if at and ends[at - 1] > w.start():
            continue
        if w[0][0].isupper():
            more.append((w.start(), w.start() + len(value), named[value], value))
        else:
            common.add(value)
    return sorted(found + [m for m in more if m[3] not in common])


class Cipher:
    """Keyed permutations of values within their format. ``attempt`` chooses another one."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _number(self, tweak: str, value: int, modulus: int) -> int:
        seed = f"{tweak}/{value}".encode()
        return int.from_bytes(hashlib.blake2b(seed, key=self.key, digest_size=64).digest(), "big") % modulus

    def permute(self, x: int, n: int, tweak: str) -> int:
        """A permutation of 0 .. n - 1: eight alternating rounds on a slightly larger rectangle, walked back into it."""
        if n < 2:
            return x
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        while True:
            left, right = divmod(x, b)
            for step in range(4):
                left = (left + self._number(f"{tweak}/{step}l", right, a)) % a
                right = (right + self._number(f"{tweak}/{step}r", left, b)) % b
            x = left * b + right
            if x < n:
                return x

    def letters(self, value: str, tweak: str, fixed: frozenset[int] = frozenset(), alphabet: str | None = None) -> str:
        """Each digit a digit, each small or capital letter one of its case; other characters and ``fixed`` places stay."""
        pools = [alphabet or ("0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz" if c.islower() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ") for c in value]
        places = [k for k, c in enumerate(value) if k not in fixed and (c in pools[k])]
        x, n = 0, 1
        for k in places:
            x, n = x * len(pools[k]) + pools[k].index(value[k]), n * len(pools[k])
        shape = "".join(c if k not in places else "9" if c.isdigit() else "a" if c.islower() else "A" for k, c in enumerate(value))
        x, out = self.permute(x, n, f"{tweak}/{shape if alphabet is None else len(value)}"), list(value)
        for k in reversed(places):
            x, at = divmod(x, len(pools[k]))
            out[k] = pools[k][at]
        return "".join(out)

    @staticmethod
    def _letters_of(x: int, n: int) -> str:
        out = []
        for _ in range(n):
            x, at = divmod(x, 26)
            out.append("abcdefghijklmnopqrstuvwxyz"[at])
        return "".join(out)

    def surrogate(self, kind: str, value: str, attempt: int) -> str:
        """The canonical surrogate of a canonical value."""
        tweak = f"{kind}/{attempt}"
        if kind == "email":
            new = self.letters(value, tweak, frozenset(range(value.rindex("."), len(value))))
            longer = max(0, attempt - 1)  # letters more, once the format has failed twice
            return self._letters_of(self._number(f"{tweak}+", int.from_bytes(value.encode(), "big"), 26**longer), longer) + new
        if kind == "hex":
            return self.letters(value, tweak, alphabet="0123456789abcdef")
        if kind == "key":
            return "AKIA" + self.letters(value[4:], tweak, alphabet="ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
        if kind == "ip":
            number = 0
            for part in value.split("."):
                number = number * 256 + int(part)
            return ".".join(map(str, self.permute(number, 1 << 32, tweak).to_bytes(4, "big")))
        if kind == "card":
            if luhn(value):
                body = value[0] + self.letters(value[1:-1], tweak)
                return next(body + d for d in "0123456789" if luhn(body + d))
            return value[0] + self.letters(value[1:], tweak)
        if kind == "iban":
            body = self.letters(value[4:], tweak)
            digits = "".join(str(int(c, 36)) for c in body + value[:2] + "00")
            return f"{value[:2]}{98 - int(digits) % 97:02d}{body}"
        if kind.startswith("name_"):
            _, role, script = kind.split("_")
            x, parts = self._number(tweak, int.from_bytes(value.encode(), "big"), 1 << 256), []
            for _ in range((3 if role == "family" else 2) + attempt):
                x, at = divmod(x, len(SYLLABLES[script]))
                parts.append(SYLLABLES[script][at])
            return "".join(parts) + ENDINGS[script][role]
        return self.letters(value, tweak)

    def replace(self, kind: str, value: str, raw: str, attempt: int) -> str:
        """The surrogate as the entity was written."""
        new = self.surrogate(kind, value, attempt)
        if kind in ("card", "phone", "ssn", "iban"):
            # what comes before the canonical digits (a country code) stays
            before, rest, out = sum(c.isalnum() for c in raw) - len(value), iter(new), []
            for c in raw:
                if c.isalnum() and before <= 0:
                    c = next(rest)
                elif c.isalnum():
                    before -= 1
                out.append(c)
            return "".join(out)
        if kind == "email":
            more = len(new) - len(raw)
            return new[:more] + "".join(n.upper() if c.isupper() else n for c, n in zip(raw, new[more:]))
        if kind.startswith("name_"):
            return new.upper() if raw.isupper() and len(raw) > 1 else new.capitalize()
        return new


def luhn(digits: str) -> bool:
    total = sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits)))
    return total % 10 == 0


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """The distinct (kind, value) of all texts."""

    def detect(batches):
        for batch in sliced(batches, text):
            found = {(k, v) for t in batch.column(text).to_pylist() if t for _, _, k, v in find(t)}
            kinds, values = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())], names=["kind", "value"])

    return docs.select(F.col(text).cast("string").alias(text)).mapInArrow(tidily(detect), "kind string, value string").distinct()


def redrawn(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, attempt) of the entities whose first surrogate does not serve, from the stored distinct ones.

    A surrogate must not be a real value of its kind nor another one's surrogate. Of several values that would meet the
    least keeps its surrogate. Each round checks all, in aggregates and joins, and draws what failed again; see the module's text for when
    it ends.
    """
    cipher = Cipher(key)

    def draw(batches):
        for batch in batches:
            new = [cipher.surrogate(*r) for r in zip(*(batch.column(c).to_pylist() for c in ("kind", "value", "attempt")))]
            yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("value"), batch.column("attempt"), pa.array(new, pa.string())], names=["kind", "value", "attempt", "surrogate"])

    now = found.withColumn("attempt", F.lit(0))
    grows = F.col("kind").startswith("name_") | (F.col("kind") == "email")
    for turn in range(MOST_ROUNDS):
        drawn = materialise(now.mapInArrow(draw, "kind string, value string, attempt int, surrogate string"), "surrogates")
        met = drawn.groupBy("kind", "surrogate").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least")).where("n > 1").drop("n")
        real = found.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("real"))
        bad = drawn.join(met, ["kind", "surrogate"], "left").join(real, ["kind", "surrogate"], "left")
        foreign = F.coalesce("real", F.lit(False)) & (grows | F.lit(turn < FOREIGN_ROUNDS))
        bad = bad.withColumn("again", foreign | F.coalesce(F.col("value") > F.col("least"), F.lit(False)))
        checked = materialise(bad.select("kind", "value", "attempt", "again"), "surrogates-checked")
        if not checked.where("again").limit(1).count():
            return checked.where("attempt > 0").select("kind", "value", "attempt")
        now = checked.select("kind", "value", (F.col("attempt") + F.col("again").cast("int")).alias("attempt"))
    left = {r["kind"]: r["n"] for r in checked.where("again").groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    raise RuntimeError(f"no distinct surrogates after {MOST_ROUNDS} draws for {left}")


def replace(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with entities replaced in ``text``, and last their number (``n_entities``, or ``common.unused`` of it); all other columns and
    rows stay as they are.

    Null texts stay null, with 0 entities. Equal texts become equal texts.
    """
    spark, cipher = docs.sparkSession, Cipher(key)
    again = redrawn(materialise(entities(docs, text), "entities"), key)
    held = again.limit(MOST_REDRAWN + 1).collect()
    rows, number = docs, unused(docs, "n_entities")
    columns, schema = rows.columns, rows.schema
    out_schema = T.StructType([*(T.StructField(text, T.StringType()) if f.name == text else f for f in schema), T.StructField(number, T.IntegerType())])
    if len(held) <= MOST_REDRAWN:
        table = spark.sparkContext.broadcast({(r["kind"], r["value"]): r["attempt"] for r in held})
    else:  # each text gets its own redrawn entities, found by a hash of the text
        table = None

        def occurrences(batches):
            for batch in sliced(batches, "text"):
                found = [(h, k, v) for h, t in zip(batch.column("mark").to_pylist(), batch.column("text").to_pylist()) if t for k, v in {e[2:] for e in find(t)}]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found) if found else ((), (), ()), (pa.int64(), pa.string(), pa.string()))], names=["mark", "kind", "value"])

        marks = rows.select(F.xxhash64(text).alias("mark"), F.col(text).cast("string").alias("text")).mapInArrow(occurrences, "mark long, kind string, value string").distinct()
        fixes = marks.join(again, ["kind", "value"]).groupBy("mark").agg(F.collect_list(F.struct("kind", "value", "attempt")).alias("fixes"))
        mark, fix = unused(rows, "mark"), unused(rows, "fixes")
        rows = rows.withColumn(mark, F.xxhash64(text)).join(fixes.select(F.col("mark").alias(mark), F.col("fixes").alias(fix)), mark, "left").select(*columns, fix)

    def rewrite(batches):
        for batch in sliced(batches, text):
            fixes = batch.column(batch.num_columns - 1).to_pylist() if table is None else None
            texts, counts = [], []
            for k, t in enumerate(batch.column(text).to_pylist()):
                found = find(t) if t else []
                attempts = table.value if table is not None else {(f["kind"], f["value"]): f["attempt"] for f in fixes[k] or ()}
                out, at = [], 0
                for start, end, kind, value in found:
                    out += [t[at:start], cipher.replace(kind, value, t[start:end], attempts.get((kind, value), 0))]
                    at = end
                texts.append("".join(out) + t[at:] if found else t)
                counts.append(len(found))
            columns_ = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*columns_, pa.array(counts, pa.int32())], names=[*columns, number])

    return rows.mapInArrow(tidily(rewrite), out_schema)
