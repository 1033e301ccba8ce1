"""The operators as registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bpe,
    decontaminate,
    fm_dedup,
    jaccard,
    lines,
    oracle,
    prefix_trie,
    quality,
    rules,
    simhash,
    suffix_dedup,
    token_files,
    toxicity,
    whitening,
)
from millrace.llm.samples import held_out
from millrace.llm.shipping import arrow_batches, ship
from millrace.operators.staging import scratch_path, stage
from millrace.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("quality_score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score"), predicted)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), 400)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = fm_dedup.remove_repeats(table(spark, sf_dir, "documents"), 50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder)
    return token_files.read(manifest, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("toxicity") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"), predicted, "toxic_spans")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN).drop("text")
    with arrow_batches(spark, bpe.BATCH_BYTES):
        ids = stage(ids, "token-ids")  # so that a task holds the encoder's tables or the decoder's, not both
    joined = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    digests = ids.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), "token_ids")
    return bpe.decode(digests, ranks).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = jaccard.Similarity(words=3, num=90, den=100)
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), rule).select("doc_id", "n_shingles", "component_id")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_token_files": op3_token_files,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_simhash": op11_simhash,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL: dict[str, str] = oracle.SQL
