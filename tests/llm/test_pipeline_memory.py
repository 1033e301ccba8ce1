"""The pipeline's stages share workers, so each bounds the batches it hands them."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import bpe, jaccard, textops

SF = "/root/testdata/sf0.001"
SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def largest_batch(spark) -> int:
    """Bytes of the largest batch that a worker gets of 16 MB of documents in one part."""

    def run(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes], pa.int64())], names=["bytes"])

    docs = spark.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("word "), 800).alias("text"))
    return docs.mapInArrow(run, "bytes long").agg(F.max("bytes")).first()[0]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_hand_out_small_batches(spark, name, stage):
    before = spark.conf.get(SETTING)
    spark.conf.unset(SETTING)
    try:
        assert largest_batch(spark) > 2 * bpe.BATCH_BYTES
        docs = spark.read.parquet(f"{SF}/documents.parquet")
        stage(spark, docs, SF)
        # The caller runs what the stage returns, after it.
        assert largest_batch(spark) < 1.1 * bpe.BATCH_BYTES
    finally:
        spark.conf.set(SETTING, before)


def test_the_pipeline_leaves_the_setting_as_it_was(spark):
    before = spark.conf.get(SETTING)
    corpus_pipeline.run(spark, SF)
    assert spark.conf.get(SETTING) == before


def task_of(made) -> object:
    """The function that ``made`` hands to mapInArrow."""

    class Docs:
        def select(self, *_):
            return self

        def filter(self, *_):
            return self

        def mapInArrow(self, f, _):
            raise StopIteration(f)

    with pytest.raises(StopIteration) as stopped:
        made(Docs(), jaccard.Similarity())
    return stopped.value.value


@pytest.mark.parametrize("made", [jaccard.describe, jaccard.meetings])
def test_tasks_of_the_join_give_memory_back(made):
    textops.powers(10)
    assert textops._powers
    batch = pa.record_batch([pa.array([1, 2], pa.int64()), pa.array(["a b c d e f", None])], names=["doc_id", "text"])
    assert list(task_of(made)(iter([batch])))
    assert not textops._powers
