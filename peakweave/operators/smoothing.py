"""Local quadratic regression (loess) of one variable per group, as a distributed computation.

The curve is fitted only at the vertices of a one-dimensional k-d tree — their number
depends on the span, not on the data — and blended in between by cubic Hermite
polynomials of the fitted values and slopes. Every fit is a weighted sum over all rows
of its group; all groups go through the same passes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakweave.operators.checks import require
from peakweave.operators.joins import join_groups
from peakweave.operators.ordering import ordered_scan
from peakweave.session import materialize

MOMENTS = [f"s{p}" for p in range(5)] + [f"t{p}" for p in range(3)]


def _cut_ranks(lo: int, hi: int, leaf: int) -> list[int]:
    """Ranks m such that the tree cuts between m and m+1: halves until a leaf is small enough."""
    if hi - lo + 1 <= leaf:
        return []
    middle = (lo + hi) // 2
    return _cut_ranks(lo, middle, leaf) + [middle] + _cut_ranks(middle + 1, hi, leaf)


def _grid(placed: DataFrame, by: list[str], span: float, cell: float) -> DataFrame:
    """(by, __q, __v): rows in a window and the vertices in order, one row per group."""
    @F.pandas_udf("array<bigint>")
    def cuts(n: pd.Series) -> pd.Series:
        return n.map(lambda n: _cut_ranks(0, n - 1, max(1, int(n * span * cell))))

    sizes = materialize(placed.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), F.min("__x").alias("__lo"), F.max("__x").alias("__hi")))
    inner = sizes.select(*by, F.explode(cuts("__n")).alias("__c"))
    beside = inner.select(*by, "__c", F.explode(F.array("__c", F.col("__c") + 1)).alias("__i"))
    middles = join_groups(beside, placed.select(*by, "__i", "__x"), [*by, "__i"]).groupBy(*by, "__c").agg(
        (F.sum("__x") / 2).alias("__p")).select(*by, "__p")
    lo, hi = F.col("__lo"), F.col("__hi")
    margin = 0.005 * F.greatest(hi - lo, 1e-3 * F.greatest(F.abs(lo), F.abs(hi)) + 1e-30)
    ends = sizes.select(*by, F.explode(F.array(lo - margin, hi + margin)).alias("__p"))
    # as many vertices as the span asks for
    vertices = ends.unionByName(middles).groupBy(*by).agg(F.array_sort(F.collect_set("__p")).alias("__v"))
    q = F.least(F.col("__n"), F.floor(F.col("__n") * span + 1e-5))
    grid = join_groups(vertices, sizes.select(*by, q.alias("__q")), by)
    return materialize(require(grid, F.col("__q") >= 3, "too few rows for a quadratic fit with this span"))


def _solved(by: list[str], schema: T.StructType):
    """Value and slope of the fit at each vertex from its moments."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values, slopes = [], []
            for m in frame[[*MOMENTS, "__h"]].to_numpy(float):
                a = np.array([[m[i + j] for j in range(3)] for i in range(3)])
                c = np.linalg.lstsq(a, m[5:8], rcond=1e-12)[0]
                values.append(c[0])
                slopes.append(c[1] / m[8])
            yield frame.assign(value=values, slope=slopes)[[f.name for f in schema.fields]]

    return run


def local_regression(df: DataFrame, x: str, y: str, order_by: Sequence[str], span: float = 0.3, cell: float = 0.2,
                     column: str = "fitted", by: Sequence[str] = ()) -> DataFrame:
    """Add the loess fit of y on x inside each group; `order_by` breaks ties of x."""
    by = list(by)
    placed = materialize(ordered_scan(
        df.withColumns({"__x": F.col(x).cast("double"), "__y": F.col(y).cast("double")}), ["__x", *order_by], by, index="__i"))
    grid = _grid(placed, by, span, cell)
    rows = join_groups(placed.select(*by, "__i", "__x", "__y"), grid, by)
    # the q nearest rows are neighbours in order: the best window of q consecutive ones
    ends = rows.select(*by, (F.col("__i") - (F.col("__q") - 1)).alias("__i"), F.col("__x").alias("__end"))
    windows = join_groups(rows.select(*by, "__i", "__x", "__v"), ends, [*by, "__i"])
    reach = windows.select(*by, "__x", "__end", F.posexplode("__v").alias("k", "v")).groupBy(*by, "k", "v").agg(
        F.greatest(F.min(F.greatest(F.col("v") - F.col("__x"), F.col("__end") - F.col("v"))), F.lit(1e-300)).alias("h"))
    spots = reach.groupBy(*by).agg(F.collect_list(F.struct("k", "v", "h")).alias("__spots"))
    u = (F.col("__x") - F.col("v")) / F.col("h")
    near = join_groups(placed.select(*by, "__x", "__y"), spots, by).select(
        *by, "__x", "__y", F.inline("__spots")).withColumn("u", u).filter(F.abs("u") < 0.999)
    w = F.when(F.abs("u") > 0.001, F.pow(1 - F.pow(F.abs("u"), F.lit(3)), F.lit(3))).otherwise(1.0)
    moments = near.withColumn("w", w).groupBy(*by, "k", "v").agg(
        *[F.sum(F.col("w") * F.pow("u", F.lit(p))).alias(f"s{p}") for p in range(5)],
        *[F.sum(F.col("w") * F.col("__y") * F.pow("u", F.lit(p))).alias(f"t{p}") for p in range(3)],
        F.first("h").alias("__h"))
    schema = T.StructType([*[placed.schema[b] for b in by], *T._parse_datatype_string(
        "k int, v double, value double, slope double").fields])
    fits = moments.mapInPandas(_solved(by, schema), schema).groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("k", "v", "value", "slope"))).alias("__f"))
    blended = join_groups(placed, materialize(fits), by)
    return blended.withColumn(column, _blend(F.col("__x"), F.col("__f"))).drop("__x", "__y", "__i", "__f")


def _blend(x: Column, fits: Column) -> Column:
    """Cubic Hermite interpolation between the two vertices around x; all x lie inside the vertices."""
    above = F.size(F.filter(fits, lambda f: f["v"] < x))
    left, right = F.get(fits, above - 1), F.get(fits, above)
    width = right["v"] - left["v"]
    h = (x - left["v"]) / width
    return ((1 - h) * (1 - h) * (1 + 2 * h) * left["value"] + h * h * (3 - 2 * h) * right["value"]
            + width * (h * (1 - h) * (1 - h) * left["slope"] - h * h * (1 - h) * right["slope"]))
