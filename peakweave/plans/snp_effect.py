"""Variant effect input: variants merged with the sequences of their windows, filtered to one cell type."""

from __future__ import annotations

from pyspark.sql import DataFrame

from peakweave.operators import joins


def snp_effect_input(snp: DataFrame, sequences: DataFrame, samples: DataFrame, keep: str = "last",
                     position: str = "file_pos", salts: int | None = None) -> DataFrame:
    """Merge, keep the listed samples and single-base alleles, add the variant's offset in its window.

    Both filters run before the join: alleles on the variant side (after duplicates
    are resolved, which must see every row), samples on the sequence side.
    """
    variants = joins.single_base_alleles(joins.deduplicate_variants(snp, keep, position))
    listed = joins.in_sample_list(sequences, samples, "sample")
    merged = joins.merge_variants(variants, listed, "all", position, salts)
    return joins.with_variant_offset(merged)
