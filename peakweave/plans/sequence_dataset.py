"""Sequences from cleaned text to tokenised, normalised, split and sharded datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakweave.functions.sequences import attention_mask, encode
from peakweave.operators.joins import matrix_lookup
from peakweave.operators.ordering import exact_split, with_record_id_by_split
from peakweave.sources.datasets import write_dataset, write_json_shards
from peakweave.sources.text import read_regex_delimited


def load_splits(spark: SparkSession, train: str | Sequence[str], test: str | Sequence[str]) -> DataFrame:
    """The two text files as one frame with a split column."""
    return read_regex_delimited(spark, train).withColumn("split", F.lit("train")).unionByName(
        read_regex_delimited(spark, test).withColumn("split", F.lit("test")))


def build_raw_dataset(spark: SparkSession, train: str, test: str, directory: str,
                      order_by: Sequence[str] = ("sample", "pos", "seq", "peak_value")) -> None:
    """Text files to a dataset directory with contiguous record ids over both splits."""
    write_dataset(with_record_id_by_split(load_splits(spark, train, test), order_by), directory)


def tokenize(sequences: DataFrame, min_length: int = 0) -> DataFrame:
    """Add input_ids and attention_mask; drop sequences shorter than min_length.

    The mask is all ones, so the length test is on the text: it runs before tokenising.
    """
    kept = sequences.filter(F.length("seq") >= min_length) if min_length else sequences
    tokens = kept.withColumn("input_ids", encode("seq"))
    return tokens.withColumn("attention_mask", attention_mask("input_ids"))


def add_norm_peak(tokenized: DataFrame, matrix: DataFrame, strict: bool = True) -> DataFrame:
    """Normalised peak values from the sample × peak matrix; seq and attention_mask are dropped."""
    return matrix_lookup(tokenized, matrix, strict).drop("seq", "attention_mask")


def export_json(dataset: DataFrame, directory: str, num_shards: int = 500, ratio: float | None = None,
                seed: int = 42) -> None:
    """Split off a validation part (when a ratio is given) and write JSON-lines shards."""
    split = exact_split(dataset, "record_id", ratio, seed) if ratio is not None else dataset
    write_json_shards(split, directory, num_shards)
