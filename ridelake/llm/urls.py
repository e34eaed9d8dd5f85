"""Allow and block lists for URLs: a trie over reversed host labels and path segments.

A rule is a host and the beginning of a path. It fits its host and all subdomains, if the
URL's path starts with the rule's. Of the rules that fit, the one with the longest host wins,
then the one with the longest path; where the same entry is in both lists, block wins. URLs that
no rule fits get the method's own verdict, ``default`` (allow).
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rules above this number are joined on the host's suffixes instead of being sent to every task.
TRIE_RULES = 200_000

_RULE = "host string, path string, verdict string"
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty if the URL is null or has no ``://``."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    host_end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path_end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    return rest[:host_end].translate(_UPPER), rest[host_end:path_end] if path_end > host_end else ""


class Trie:
    """Host labels from the last to the first, then whole path segments, then a beginning of one."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.translate(_UPPER).split(".")):
                node = node.setdefault(("host", label), {})
            *whole, tail = path.split("/")
            for segment in whole:
                node = node.setdefault(("path", segment), {})
            ends = node.setdefault("ends", {})
            if ends.get(tail, ("", "allow"))[1] != "block":
                ends[tail] = (host.translate(_UPPER) + path, verdict)

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        segments, best, node = path.split("/"), None, self.root
        for label in reversed(host.split(".")):
            node = node.get(("host", label))
            if node is None:
                break
            best = self._longest(node, segments) or best
        return best

    @staticmethod
    def _longest(node: dict, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            ends = node.get("ends", {})
            fits = [tail for tail in ends if segment.startswith(tail)]
            if fits:
                best = ends[max(fits, key=len)]
            node = node.get(("path", segment))
            if node is None:
                break
        return best


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] | DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """(key, host, path, rule, verdict) for every row, repeated and null rows included.

    ``rules`` are (host, path, verdict) with verdict ``allow`` or ``block``; null parts count as
    empty. Up to ``TRIE_RULES`` rules are built into a trie that each task receives; more are joined.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(key).alias(key), F.col(url).cast("string").alias("url"))
    if isinstance(rules, DataFrame):
        held = rules.select("host", "path", "verdict").na.fill("").limit(TRIE_RULES + 1).collect()
        if len(held) > TRIE_RULES:
            return _joined(rows, rules.select("host", "path", "verdict").na.fill(""), key, default)
        rules = [tuple(r) for r in held]
    rules = [tuple(x or "" for x in r) for r in rules]
    if len(rules) > TRIE_RULES:
        return _joined(rows, spark.createDataFrame(rules, _RULE), key, default)
    trie = spark.sparkContext.broadcast(Trie(rules))

    def judge(batches):
        for batch in batches:
            out = []
            for value in batch.column("url").to_pylist():
                host, path = split_url(value)
                rule, verdict = trie.value.find(host, path) or (None, default)
                out.append((host, path, rule, verdict))
            columns = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), *(pa.array(c, pa.string()) for c in columns)], names=[key, "host", "path", "rule", "verdict"]
            )

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(judge, f"`{key}` {kind}, host string, path string, rule string, verdict string")


def _joined(rows: DataFrame, rules: DataFrame, key: str, default: str) -> DataFrame:
    """The same by an equi-join: each distinct (host, path) meets the rules of the suffixes of its host."""
    lower = lambda c: F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    there = F.coalesce(F.instr("url", "://"), F.lit(0)) > 0
    rest = F.expr("substring(url, instr(url, '://') + 3)")
    parsed = rows.withColumn("rest", F.when(there, rest).otherwise("")).select(
        key, lower(F.regexp_extract("rest", "^[^/?#]*", 0)).alias("host"), F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1).alias("path")
    )
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    rules = rules.select(lower(F.col("host")).alias("suffix"), F.col("path").alias("prefix"), F.col("verdict").alias("says"))
    best = (
        parsed.select("host", "path").distinct().withColumn("suffix", F.explode(suffixes)).join(rules, "suffix")
        .where(F.expr("startswith(path, prefix)"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.size(F.split("suffix", "\\.")).alias("a"), F.length("prefix").alias("b"), "says", F.concat("suffix", "prefix").alias("rule"))).alias("best"))
    )
    return parsed.join(best, ["host", "path"], "left").select(
        key, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.says", F.lit(default)).alias("verdict")
    )
