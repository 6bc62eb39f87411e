"""The corpus pipeline: language identification, quality rules, near duplicates, secrets, packing, one after another.

Each stage takes (spark, docs, sf_dir), works on all that the one before has kept and is written as Parquet before the
next one reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.llm import language, near_dedup, packing, quality, secrets
from billweave.llm.common import documents, stored

#: Similarity in percent from which two documents are near duplicates; op2's contract asks for more.
NEAR_PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a known language go: null texts, texts without a letter, texts that fit no language."""
    return language.accepted(docs, language.fit_languages(docs))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or the list learned from the labels go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, *quality.fit(docs, labels))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: the one with the smallest id, among equal ids by its text.

    Rows have a key of their own, as ids may be null or stand for several texts. A row that no other is near to stays.
    """
    key = "_row"
    while key in docs.columns:
        key += "_"
    # Written once, so that a row keeps its key however often it is read.
    keyed = stored(docs.withColumn(key, F.monotonically_increasing_id()), "near_rows")
    found = near_dedup.near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), NEAR_PERCENT)
    found = stored(found.select(F.col("doc_id").alias(key), "component_id"), "near_found")
    # Most rows are alone; only those of groups are put in order.
    groups = found.filter(F.col(key) != F.col("component_id")).select("component_id").distinct()
    members = found.join(groups, "component_id", "left_semi")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.sha2("text", 256), key)
    ordered = keyed.select(key, order.alias("order")).join(members, key)
    first = ordered.groupBy("component_id").agg(F.min("order")[key].alias("first"))
    goes = members.join(first, "component_id").filter(F.col(key) != F.col("first")).select(key)
    return keyed.join(goes, key, "left_anti").select(*docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced, and its number of characters is that of the new text."""
    kept = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return kept
    counted = F.length("text").cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(counted))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_stage),
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("secret scans", secret_stage),
    ("best-fit packing", packing_stage),
]
#: No SQL: the stages hold a fitted network and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
