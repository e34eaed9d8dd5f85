"""The pipeline as registered: the given table, a doubled one, an empty one, and columns with any names."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ridelake.llm import packing
from ridelake.llm.common import BATCH_BYTES
from ridelake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def packed(spark, sf_dir):
    return QUERIES["pipeline"](spark, sf_dir).toPandas()


def stored(docs, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_sequences_are_whole(packed, documents):
    assert 0 < len(packed) and set(packed.doc_id) <= {r["doc_id"] for r in documents.collect()}
    for _, group in packed.sort_values("offset").groupby("sequence_id"):
        assert group.offset.tolist() == [0, *group.length.cumsum().tolist()[:-1]] and group.length.sum() <= 4096
    for _, group in packed.sort_values("piece").groupby("doc_id"):
        assert group.piece.tolist() == list(range(len(group))) and group.start.tolist() == [0, *group.length.cumsum().tolist()[:-1]]


def test_empty_table(spark, documents, tmp_path):
    out = corpus_pipeline.run(spark, stored(documents.limit(0), tmp_path))
    assert out.count() == 0 and "sequence_id" in out.columns


def test_copies_under_other_ids_change_nothing(spark, documents, packed, tmp_path):
    copies = documents.withColumn("doc_id", F.col("doc_id") + 1_000_000)
    groups = corpus_pipeline.near_duplicates(spark, corpus_pipeline.language(spark, documents.union(copies), ""), "")
    once = corpus_pipeline.near_duplicates(spark, corpus_pipeline.language(spark, documents, ""), "")
    # the model learns from twice the rows; documents near its limit may change
    ids, alone = ({r["doc_id"] for r in d.select("doc_id").collect()} for d in (groups, once))
    assert max(ids) < 1_000_000 and len(ids ^ alone) <= 0.02 * len(alone)


def test_stages_keep_columns_of_any_names(spark, documents):
    odd = ["found", "mix", "n_entities", "a.b", "__spot0", "key", "class"]
    docs = documents.limit(60)
    for k, name in enumerate(odd):
        docs = docs.withColumn(name, F.lit(k))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        values = {tuple(r[len(documents.columns) :]) for r in out.collect()}
        assert values <= {tuple(range(len(odd)))}, name
    assert corpus_pipeline.sequences(spark, docs, "").count() >= 60


@pytest.mark.parametrize("step", [lambda spark, docs: corpus_pipeline.language(spark, docs, ""), lambda spark, docs: packing.cut(docs, "unused")])
def test_stages_bound_the_batches_of_their_tasks(spark, step):
    fresh = spark.newSession()  # what other tests set is not there
    docs = fresh.range(0, 40, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab c "), 200_000).alias("text"), F.lit("en").alias("lang"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    step(fresh, docs)
    found = docs.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in found) == 40 and max(r["size"] for r in found) <= BATCH_BYTES + 1_100_000
    fresh.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 20))
    step(fresh, docs)
    assert fresh.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(1 << 20)
