"""Mix sources to target weights: iterative proportional fitting, then calibrated sampling.

Tokens are summed by cell (source, language, topic). The cells are raked: scaled in turn until their sums by source, by
language and by topic are the targets. A cell's weight over its tokens is its rate; divided by the greatest rate
it is the probability with which each of its documents is kept, so every expected marginal share is the target and no
document is needed twice. Whether a document is kept follows from a hash of its key and text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.llm.common import unused
from ridelake.session import materialise

MOST_CELLS = 100_000  # cells raked as one array; more are raked as a table
ROUNDS, CLOSE = 200, 1e-9
TEMPER = 0.9  # exponent of the default targets: shares of tokens, evened out
LEVELS = ("source", "lang", "topic")


def n_tokens(text: Column) -> Column:
    """Words between blanks, at least one, so that no cell is empty; null counts as empty."""
    return F.coalesce(F.length(text) - F.length(F.translate(text, " \n\t", "")) + 1, F.lit(1)).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse kind of content where documents have no topic of their own: table, symbols, short or long prose."""
    share = lambda signs: (F.length(text) - F.length(F.translate(text, signs, ""))) / F.length(text)
    return (
        F.when(F.coalesce(F.length(text), F.lit(0)) == 0, "none")
        .when(share("|") > 0.005, "table")
        .when(share("!%&*$#") > 0.05, "symbols")
        .when(F.length(text) < 2000, "short")
        .otherwise("long")
    )


def tempered(cells: DataFrame, level: str, temper: float = TEMPER) -> DataFrame:
    """(level, target): shares of tokens raised to ``temper``, summing to 1."""
    sums = cells.groupBy(level).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temper)).alias("w"))
    return sums.crossJoin(F.broadcast(sums.agg(F.sum("w").alias("all")))).select(level, (F.col("w") / F.col("all")).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (levels, tokens) with ``weight``, whose sums by each level are its targets times all tokens.

    A value without a target, or with target 0, gets weight 0; targets of values that no cell has are spread over the
    others. Where targets cannot all hold (a source with one language only) the last round's weights, by topic, stand.
    """
    count = cells.count()
    if count <= MOST_CELLS:
        frame = cells.toPandas()
        weight = frame["tokens"].to_numpy(dtype=float)
        total = weight.sum()
        wanted = []
        for level, target in targets.items():
            # at most as many targets as cells are looked at
            t = target.join(cells.select(level).distinct(), level, "left_semi").toPandas()
            code, values = pd.factorize(frame[level])
            w = pd.Series(t["target"].to_numpy(dtype=float), index=t[level]).reindex(values).fillna(0.0).to_numpy()
            wanted.append((code, w / w.sum() * total if w.sum() else w))
        for _ in range(rounds):
            worst = 0.0
            for code, want in wanted:
                have = np.bincount(code, weight, len(want))
                factor = np.divide(want, have, out=np.zeros_like(want), where=have > 0)
                worst = max(worst, np.abs(factor[have > 0] - 1).max(initial=0.0))
                weight = weight * factor[code]
            if worst < CLOSE:
                break
        frame["weight"] = weight
        return cells.sparkSession.createDataFrame(frame, T.StructType([*cells.schema, T.StructField("weight", T.DoubleType())]))
    return _rake_table(cells, targets, rounds)


def _rake_table(cells: DataFrame, targets: dict[str, DataFrame], rounds: int) -> DataFrame:
    """The same as joins and aggregates, a stored table a round."""
    now = materialise(cells.withColumn("weight", F.col("tokens").cast("double")), "cells")
    total = now.agg(F.sum("weight")).first()[0]
    scaled = {}
    for level, target in targets.items():
        t = materialise(target.join(cells.select(level).distinct(), level, "left_semi"), "targets")
        all_ = t.agg(F.sum("target")).first()[0] or 1.0
        scaled[level] = t.select(level, (F.col("target") / F.lit(all_) * F.lit(total)).alias("want"))
    for _ in range(rounds):
        worst = 0.0
        for level, want in scaled.items():
            have = now.groupBy(level).agg(F.sum("weight").alias("have")).where("have > 0").join(want, level, "left")
            factor = materialise(have.select(level, (F.coalesce("want", F.lit(0.0)) / F.col("have")).alias("factor")), "factors")
            worst = max(worst, factor.agg(F.max(F.abs(F.col("factor") - 1))).first()[0] or 0.0)
            now = now.join(factor, level, "left").withColumn("weight", F.col("weight") * F.coalesce("factor", F.lit(0.0))).select(*cells.columns, "weight")
        now = materialise(now, "cells")
        if worst < CLOSE:
            break
    return now


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", topic: str | None = None, targets: dict[str, DataFrame] | None = None, seed: int = 20) -> DataFrame:
    """All columns of ``docs`` and, last, a struct of (source, lang, topic, n_tokens, rate, probability, kept), for every row (``mix``,
    or ``common.unused`` of it).

    ``targets`` maps levels (source, lang, topic) to tables (level, target); others take the tempered shares. Null values are
    a level of their own, the empty string. ``rate`` is the wanted share over the share that is there. Without a
    ``topic`` column a coarse kind of content is the topic. Repeated rows are kept or left together. The texts stay where they
    are, unless there are more than ``MOST_CELLS`` cells, which are joined by a shuffle.
    """
    t = F.col(text).cast("string")
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    levels = {"source": named(source), "lang": named(lang), "topic": named(topic) if topic else topic_of(t)}
    cells = docs.select(*[v.alias(k) for k, v in levels.items()], n_tokens(t).alias("tokens")).groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    cells = materialise(cells, "mixing-cells")
    wanted = {level: (targets or {}).get(level, tempered(cells, level)) for level in LEVELS}
    rates = materialise(rake(cells, wanted).select(*[F.col(c).alias(f"__{c}") for c in LEVELS], (F.col("weight") / F.col("tokens")).alias("__rate")), "mixing-rates")
    count, most = rates.agg(F.count(F.lit(1)), F.max("__rate")).first()
    rows = docs.withColumns({f"__{k}": v for k, v in levels.items()})
    joined = rows.join(F.broadcast(rates) if count <= MOST_CELLS else rates, [f"__{c}" for c in LEVELS])
    draw = F.pmod(F.xxhash64(F.col(key), t, F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    probability = F.col("__rate") / F.lit(most or 1.0)
    found = F.struct(*[F.col(f"__{c}").alias(c) for c in LEVELS], n_tokens(t).alias("n_tokens"), F.col("__rate").alias("rate"), probability.alias("probability"), (draw < probability).alias("kept"))
    return joined.select(*docs.columns, found.alias(unused(docs, "mix")))
