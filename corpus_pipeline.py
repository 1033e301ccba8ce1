"""Cleaning of a document corpus: toxicity, line dedup, near duplicates, benchmark passages, tokens.

Each stage takes and returns documents; the last adds the token ids. Stages run one after the
other in the same workers, so they all hand them batches of a few megabytes: those of 10,000
documents that Spark makes otherwise are held by the executor and by the worker, several times each.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, decontaminate, jaccard, lines, toxicity
from millrace.llm.queries import table
from millrace.llm.shipping import arrow_batches, set_arrow_batches, ship
from millrace.operators.staging import scratch_path

TOXIC = 0.5


def ready(spark: SparkSession) -> None:
    """What each stage needs of the session, until the table it returns has run."""
    ship(spark)
    set_arrow_batches(spark, bpe.BATCH_BYTES)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below ``TOXIC``."""
    ready(spark)
    tagger = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, tagger).filter(f"toxicity < {TOXIC}").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the blocks of lines that an earlier one has; n_chars follows the text."""
    ready(spark)
    kept = lines.dedup_lines(docs)
    return kept.selectExpr(*("coalesce(length(text), 0L) AS n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (five words, 0.8)."""
    ready(spark)
    groups = jaccard.jaccard_components(docs, jaccard.Similarity())
    return docs.join(groups.filter("doc_id = component_id").select("doc_id").distinct(), "doc_id", "left_semi")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    ready(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids."""
    ready(spark)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("byte_bpe", encode),
]

ORACLE_SQL = None  # trained scores, alignment and merge replay cannot be stated in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with arrow_batches(spark, bpe.BATCH_BYTES):
        for name, stage in STAGES:
            path = scratch_path(spark, f"pipeline-{name}")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
