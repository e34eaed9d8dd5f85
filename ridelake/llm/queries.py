"""The registered queries of these operators, over whole tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ridelake.llm import align, chat, fingerprint, jaccard, langid, mixing, negatives, packing, pii, quality, toxicity, urls, vectors
from ridelake.llm.common import table
from ridelake.session import materialise

BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _fold_of(key: str, modulus: int):
    return F.crc32(F.col(key).cast("string")) % modulus


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(_fold_of("doc_id", 4) != 2))
    found = langid.identify(docs, model)
    return found.select("doc_id", (_fold_of("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "n_words", F.size("spans").alias("n_spans"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "mix.*")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    tree = chat.build(table(spark, sf_dir, "conversations").select(columns).union(extra), BYTE_TOKENIZER)
    return chat.digests(chat.read_back(tree), "conv_id")


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_neighbours(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"), corpus_pipeline.PII_KEY)


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lexicon = toxicity.fit(docs, labels.where(_fold_of("doc_id", 5) != 0))
    found = toxicity.score(docs, lexicon)
    return found.select("doc_id", (_fold_of("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_matches")


# The rules of the query.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = materialise(packing.cut(table(spark, sf_dir, "documents"), WORD_TOKENIZER), "pieces")
    return packing.pack(pieces)


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=relabelled)


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.digest(align.align(table(spark, sf_dir, "documents"), align.Tokenizers(BYTE_TOKENIZER, PIECE_TOKENIZER)))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_language": op1_language,
    "op2_mixing": op2_mixing,
    "op3_chat": op3_chat,
    "op4_fingerprint": op4_fingerprint,
    "op5_pii": op5_pii,
    "op6_vectors": op6_vectors,
    "op7_jaccard": op7_jaccard,
    "op8_toxicity": op8_toxicity,
    "op9_urls": op9_urls,
    "op10_packing": op10_packing,
    "op11_negatives": op11_negatives,
    "op12_quality": op12_quality,
    "op13_alignment": op13_alignment,
    "pipeline": pipeline,
}

_PARSED = """
WITH parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages))
"""

ORACLE = {
    "op9_urls": _PARSED
    + """, rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                              ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
  best AS (
    SELECT page_id, host, path, h || p AS rule, v,
           row_number() OVER (PARTITION BY page_id ORDER BY length(h) DESC, length(p) DESC) AS place
    FROM parsed JOIN rules ON (host = h OR host LIKE '%.' || h) AND starts_with(path, p))
SELECT parsed.page_id, parsed.host, parsed.path, best.rule, coalesce(best.v, 'allow') AS verdict
FROM parsed LEFT JOIN best ON parsed.page_id = best.page_id AND place = 1
""",
    "op11_negatives": """
WITH usable AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id AND len(r.v) = len(a.v)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS place
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE place <= 3
""",
}
