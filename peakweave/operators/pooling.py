"""Adaptive average pooling of long blocks, distributed over rows.

`functions.arrays.adaptive_pool` works on a block already held in one row. Here the
block is spread over many rows (a sample's cells), of any number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakweave.operators.ordering import ordered_scan


def pool_rows(df: DataFrame, group: str, order_by: Sequence[str], vector: str, rows: int,
              block: str = "block") -> DataFrame:
    """One row per group: its row vectors, averaged in order to `rows` rows, as `block`.

    A vector at position p of L counts for the output rows floor(p·rows/L) to
    ceil((p+1)·rows/L)-1. Positions come from a range sort, and the means are
    combined map-side, so a group holding most of the data is still spread out.
    """
    narrow = df.select(group, *[c for c in order_by if c != group], vector)
    placed = ordered_scan(narrow, order_by, [group], index="__p")
    sizes = placed.groupBy(group).agg((F.max("__p") + 1).alias("__len")).withColumnRenamed(group, "__g")
    sized = placed.join(sizes, F.col(group) == F.col("__g")).drop("__g")
    p, n = F.col("__p"), F.col("__len")
    first = F.floor(p * rows / n)
    last = F.ceil((p + 1) * rows / n) - 1
    spread = sized.select(group, F.explode(F.sequence(first, last)).alias("__i"),
                          array_to_vector(F.col(vector)).alias("__v"))
    means = spread.groupBy(group, "__i").agg(Summarizer.mean(F.col("__v")).alias("__m"))
    # `rows` small vectors per group: the collected list has a fixed length
    ordered = F.array_sort(F.collect_list(F.struct("__i", vector_to_array("__m").alias("m"))))
    return means.groupBy(group).agg(F.transform(ordered, lambda s: s["m"]).alias(block))


def masked_mean_rows(df: DataFrame, group: str, vector: str, keep: str | None = None,
                     column: str = "embedding") -> DataFrame:
    """Mean of each group's row vectors where `keep` holds, combined map-side."""
    kept = df.filter(F.expr(keep)) if keep else df
    mean = kept.groupBy(group).agg(Summarizer.mean(array_to_vector(F.col(vector))).alias("__m"))
    return mean.select(group, vector_to_array("__m").alias(column))
