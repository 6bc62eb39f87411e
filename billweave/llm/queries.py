"""Registered queries of the subpackage: each applies one operator to the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.llm import (
    curve_packing, fill_in_middle, filter_audit, fingerprints, language, licenses, near_dedup, packing, pieces, quality, secrets,
    sharding, token_counts,
)
from billweave.llm.common import documents


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of each document."""
    return token_counts.section_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.judged(docs, *quality.fit(docs, labels))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(documents(spark, sf_dir))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(documents(spark, sf_dir))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify(docs, language.fit_languages(docs))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


#: Each document through each order by itself: the step at which it goes is the first one whose filter it fails.
FILTER_AUDIT_SQL = r"""
WITH words AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
docs AS (
    SELECT part,
        [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
         coalesce(words.doc_id > min(words.doc_id) OVER (PARTITION BY t), false)] AS fails,
        coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
    FROM words LEFT JOIN labels ON words.doc_id = labels.doc_id),
letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
gone AS (
    SELECT *, list_position([fails[ascii(filter_order[s]) - 64] FOR s IN [1, 2, 3, 4, 5]], true) AS gone_at FROM docs, orders),
rows AS (
    SELECT part, filter_order, step, filter_order[step] AS letter,
        count(*) FILTER (gone_at IS NULL OR gone_at > step) AS kept, count(*) FILTER (gone_at = step) AS removed,
        count(*) FILTER (fails[ascii(filter_order[step]) - 64] AND gone_at < step) AS redundant,
        count(*) FILTER (fails[ascii(filter_order[step]) - 64] AND len(list_filter(fails, lambda x: x)) = 1) AS unique_fails,
        count(*) FILTER (gone_at = step AND good) AS good_lost, count(*) FILTER (gone_at = step AND toxic) AS toxic_lost
    FROM gone, (VALUES (1), (2), (3), (4), (5)) AS steps(step) GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM rows"""


def op12_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces_ = curve_packing.pack_along_curve(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces_.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(documents(spark, sf_dir))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


#: Lines put together again from a list of all of them, without any ranks found by descent.
FILL_IN_MIDDLE_SQL = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), E'[^\n]*\n|[^\n]+') AS lines,
        sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents),
drawn AS (
    SELECT *, len(lines) AS n, [CAST('0x' || hex[8 * k + 1 : 8 * k + 8] AS BIGINT) FOR k IN [0, 1, 2, 3]] AS h FROM docs),
cut AS (
    SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
            WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
    SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1 : b], '') AS middle,
        array_to_string(lines[b + 1 :], '') AS suffix FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256 FROM parts"""


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_near_duplicates, op3_fingerprints, op4_best_fit_packing, op5_sentencepiece, op6_quality_rules,
    op7_secret_scan, op8_license_scan, op9_sharding, op10_language_id, op11_filter_audit, op12_curve_packing, op13_fill_in_middle,
)}
ORACLES: dict[str, str] = {"op11_filter_audit": FILTER_AUDIT_SQL, "op13_fill_in_middle": FILL_IN_MIDDLE_SQL}
