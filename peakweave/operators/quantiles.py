"""Exact quantiles of groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakweave.operators.joins import join_groups
from peakweave.operators.ordering import ordered_scan


def group_quantiles(df: DataFrame, value: str, points: Mapping[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """One row per group with the linearly interpolated quantiles, one column per point.

    Values are collapsed to distinct ones with their counts, range-sorted, and the values
    at the positions next to each point picked by running count. No task ever holds a
    group, as the built-in exact percentile would, and one frequent value is one row.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("__x")).filter("__x is not null")
    distinct = rows.groupBy(*keys, "__x").agg(F.count(F.lit(1)).alias("__c"))
    placed = ordered_scan(distinct, ["__x"], keys, sums={"__upto": "__c"})
    sizes = placed.groupBy(*keys).agg(F.max("__upto").alias("__n"))
    sized = join_groups(placed, sizes, keys)
    at = {name: (F.col("__n") - 1) * F.lit(float(q)) for name, q in points.items()}

    def holds(position):
        return (position >= F.col("__upto") - F.col("__c")) & (position < F.col("__upto"))

    near = F.lit(False)
    for p in at.values():
        near = near | holds(F.floor(p)) | holds(F.ceil(p))
    picked = sized.filter(near).groupBy(*keys).agg(*[
        c for name, p in at.items() for c in (
            F.max(F.when(holds(F.floor(p)), F.col("__x"))).alias(f"__lo_{name}"),
            F.max(F.when(holds(F.ceil(p)), F.col("__x"))).alias(f"__hi_{name}"),
            F.max(p - F.floor(p)).alias(f"__f_{name}"))])
    return picked.select(*keys, *[
        (F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__f_{n}")).alias(n) for n in points])


def median_absolute_deviation(df: DataFrame, value: str, keys: Sequence[str] = (), column: str = "mad") -> DataFrame:
    """Median distance from the group's median."""
    keys = list(keys)
    middle = group_quantiles(df, value, {"__m": 0.5}, keys)
    joined = join_groups(df, middle, keys)
    spread = joined.select(*keys, F.abs(F.col(value) - F.col("__m")).alias("__d"))
    return group_quantiles(spread, "__d", {column: 0.5}, keys)
