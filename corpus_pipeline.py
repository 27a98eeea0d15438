"""From documents to packed sequences: five stages, each over all rows that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``.  ``run`` writes each stage's rows to the shared folder and reads them again, so a
lost executor repeats one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.llm import near_duplicates as near
from tablecheck.llm import packing, passage_quality, personal_data, quality_rules
from tablecheck.llm.scratch import materialise, release


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return passage_quality.accepted(docs, passage_quality.trained(docs, labels))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality_rules.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one of smallest id, rows without an id last.

    Rows are told apart by a number of their own, which is written before it is used, so that rows
    that repeat an id and rows without one are compared like all others.
    """
    rows = materialise(docs.withColumn("_row_id", F.monotonically_increasing_id()), "zstd")
    groups = near.near_duplicates(rows, key="_row_id").select(F.col("doc_id").alias("_row_id"), F.col("component_id").alias("_group"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "_row_id"))
    kept = rows.select("_row_id", "doc_id").join(groups, "_row_id").groupBy("_group").agg(first.alias("first"))
    return rows.join(kept.select("first._row_id"), "_row_id", "left_semi").select(docs.columns)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by the name of its kind."""
    clean = personal_data.masked(docs, personal_data.trained(docs))
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


STAGES = [
    ("quality classifier", quality),
    ("quality rules", rules),
    ("near duplicates", near_duplicates),
    ("personal data", personal),
    ("packing", packed),
]

#: Trained models and a tokenizer's vocabulary are not expressible in SQL; tests hold the stages
#: against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        kept = materialise(stage(spark, docs, sf_dir))
        release(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
