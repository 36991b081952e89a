"""The corpus pipeline: filter, deduplicate, decontaminate, redact, pack.

Each stage takes (spark, docs, sf_dir) and decides about every document its predecessor kept; all but the last return the
columns of `documents`. Stages are written as Parquet and read again, so a lost executor costs no more than its stage.
No stage's result can be stated in SQL as a whole (a trained classifier, XXH64 fingerprints, a tokenizer), so ORACLE_SQL is
None and the tests compare with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakweave.llm import decontamination, packing, pii, quality_classifier, simhash
from peakweave.llm.common import crc_mod, table, written
from peakweave.session import prepare


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject; it learns from labelled rows outside the held-out fold."""
    prepare(spark)
    divisor, held = quality_classifier.HELD_OUT
    scorer = quality_classifier.fit(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", divisor) != held)
    return quality_classifier.keep(docs, scorer)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    prepare(spark)
    return simhash.keep_one(docs)


def unseen_by_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verbatim window of a benchmark item."""
    prepare(spark)
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind."""
    prepare(spark)
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with ids and their checksum."""
    prepare(spark)
    return packing.pack(docs, encode_special_tokens=False).withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", one_of_each),
    ("decontamination", unseen_by_benchmark),
    ("pii", without_personal_data),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
