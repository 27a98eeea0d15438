"""One registered query per operator, over whole tables with the parameters of production."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablecheck.llm import (
    byte_bpe,
    divergence,
    golay_near_duplicates,
    hamming_search,
    html_text,
    near_duplicates,
    packing,
    passage_quality,
    personal_data,
    phrase_counting,
    quality_rules,
    sharding,
    token_counts,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.spans(_table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf_dir, "pages"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op4_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_search.nearest(_table(spark, sf_dir, "embeddings"), k=10, every=100)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op6_passage_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return passage_quality.scores(documents, passage_quality.trained(documents, _table(spark, sf_dir, "labels")))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), 24).selectExpr(
        "doc_id", "size", "text_crc32", "'bytes' as law", "shard", "slot", "cast(null as int) as grown_shard", "virtual_slot"
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(_table(spark, sf_dir, "documents"), path, with_ids=False)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op11_golay_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golay_near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"))


def op12_phrase_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_counting.collocations(_table(spark, sf_dir, "documents"), max_words=3, threshold=10, limit=2000)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(_table(spark, sf_dir, "documents"), min_documents=30, limit=50)


QUERIES = {
    f.__name__: f
    for f in (
        op1_personal_data,
        op2_html_text,
        op3_token_counts,
        op4_hamming_search,
        op5_byte_bpe,
        op6_passage_quality,
        op7_sharding,
        op8_packing,
        op9_quality_rules,
        op10_near_duplicates,
        op11_golay_near_duplicates,
        op12_phrase_counting,
        op13_source_divergence,
    )
}
