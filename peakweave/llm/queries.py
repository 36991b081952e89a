"""The queries over the test tables, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from peakweave.llm import (
    decontamination, embedding_dedup, fill_in_middle, licenses, oracles, packing, pii, quality_classifier, quality_rules,
    recurrent_lm, simhash, token_counts, toxicity, vector_codes)
from peakweave.llm.common import crc_mod, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    divisor, held = toxicity.HELD_OUT
    return toxicity.score(docs, toxicity.fit(docs, labels, crc_mod("doc_id", divisor) != held))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), encode_special_tokens=False))


def op4_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.group(table(spark, sf_dir, "documents")))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.spans(table(spark, sf_dir, "documents")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.sections(table(spark, sf_dir, "documents"), encode_special_tokens=False)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.find_matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    divisor, held = quality_classifier.HELD_OUT
    return quality_classifier.score(docs, quality_classifier.fit(docs, labels, crc_mod("doc_id", divisor) != held))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(table(spark, sf_dir, "embeddings"))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.group(table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest(fill_in_middle.transform(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_licenses, op2_toxicity, op3_packing, op4_recurrent_lm, op5_simhash, op6_pii, op7_token_counts,
        op8_decontamination, op9_quality_rules, op10_quality_classifier, op11_vector_codes, op12_embedding_dedup,
        op13_fill_in_middle)}


def oracle_sql() -> dict[str, str]:
    return {"op1_licenses": oracles.license_sql(), "op8_decontamination": oracles.decontamination_sql(),
            "op9_quality_rules": oracles.quality_rules_sql(), "op11_vector_codes": oracles.vector_codes_sql(),
            "op12_embedding_dedup": oracles.embedding_dedup_sql(), "op13_fill_in_middle": oracles.fill_in_middle_sql()}
