"""Documents to packed training sequences: the stages, and a run over all of them.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of ``documents``.
Null texts: the first stage rejects them. Rows with a null doc_id are never near-duplicates of others and stay. Repeated rows are near-duplicates;
one id's rows go or stay together. An empty table stays empty through all stages. Columns besides those of ``documents`` may
have any names; they are carried along under others meanwhile.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm import jaccard, langid, mixing, packing, pii
from ridelake.llm.common import small_batches, table, without
from ridelake.session import materialise

PII_KEY = b"replace this key in production"
LEAST_SCORE = 0.5  # share of a text's letters that its language must have
NEAR, WIDTH = "0.8", 5  # similarity and words of a shingle of near-duplicates


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def with_any_names(stage: Callable) -> Callable:
    """``stage`` for tables whose further columns may be called like something the operators use."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        plain = docs.toDF(*(c if c in COLUMNS else f"carried_{k}" for k, c in enumerate(docs.columns)))
        return stage(spark, plain, sf_dir).toDF(*docs.columns)

    return run


@with_any_names
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language (no letters, or none for half of them) go; the language found becomes ``lang``."""
    found = langid.identify(docs, langid.fit(docs), carry=True)
    kept = found.where((F.col("found.lang_pred") != "und") & (F.col("found.score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.col("found.lang_pred")).select(docs.columns)


@with_any_names
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    groups = jaccard.join(docs, similarity=NEAR, width=WIDTH)
    gone = materialise(groups.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct(), "near-duplicates")
    return without(docs, gone, "doc_id")


@with_any_names
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets become surrogates; ``n_chars`` follows the text."""
    return pii.replace(docs, PII_KEY).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


@with_any_names
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that sources, languages and kinds of content have evened-out shares of the tokens."""
    return mixing.mix(docs).where("mix.kept").select(docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's pieces lie in sequences of 4096 tokens."""
    pieces = packing.cut(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(materialise(pieces, "pieces"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("sequences", sequences),
]

# SQL can express neither the Viterbi paths, nor the tokenizer, nor the fitted packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
