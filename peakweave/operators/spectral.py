"""Discrete Fourier transforms of series of any length, spread over the cluster.

A transform whose length is a product m1·m2 takes two passes (the four-step method): the
series as a matrix, m1-point transforms of its columns, a twiddle factor per cell, and
m2-point transforms of its rows. A task holds columns or rows, which have about the square
root of the length. A series of any length n becomes such a transform by chirps: with
j·k = (j² + k² - (k - j)²) / 2 it is a convolution with a chirp, which is a product of
transforms of a power of two of at least 2n - 1 points.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakweave.operators.joins import join_groups
from peakweave.session import materialize


def _complex_product(a: tuple[Column, Column], b: tuple[Column, Column]) -> tuple[Column, Column]:
    return a[0] * b[0] - a[1] * b[1], a[0] * b[1] + a[1] * b[0]


def _small_transforms(length: str, turn: bool, sign: int):
    """Transform the sparse array of each row (`at`, `re`, `im`) to `length` points, with the twiddle factors if asked for."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            real, imaginary = [], []
            for at, re, im, size, line, m1, m2 in zip(*(frame[c] for c in ("at", "re", "im", length, "line", "m1", "m2"))):
                x = np.zeros(size, dtype=complex)
                x[np.asarray(at)] = np.asarray(re) + 1j * np.asarray(im)
                y = np.fft.fft(x) if sign < 0 else np.fft.ifft(x) * size
                if turn:
                    y *= np.exp(sign * 2j * np.pi * line * np.arange(size) / (m1 * m2))
                real.append(y.real)
                imaginary.append(y.imag)
            yield frame.drop(columns=["at"]).assign(re=real, im=imaginary)

    return run


def _power_of_two_transform(df: DataFrame, by: Sequence[str], sign: int) -> DataFrame:
    """(by, m1, m2, i, re, im) of a transform with m1·m2 points per group; absent points are zero."""
    keys = [*by, "m1", "m2"]
    fields = [df.schema[k] for k in keys]
    for step, length, width in ((0, "m1", "m2"), (1, "m2", "m1")):
        line, at = (F.col("i") % F.col("m2"), F.floor(F.col("i") / F.col("m2"))) if step == 0 else (F.col("line"), F.col("at"))
        rows = df.select(*keys, line.alias("line"), at.alias("at"), "re", "im")
        # one column or row of the matrix: the square root of the series
        packed = rows.groupBy(*keys, "line").agg(F.collect_list(F.struct("at", "re", "im")).alias("x")).select(
            *keys, "line", *[F.col(f"x.{c}").alias(c) for c in ("at", "re", "im")])
        schema = T.StructType([*fields, *T._parse_datatype_string("line bigint, re array<double>, im array<double>").fields])
        done = packed.mapInPandas(_small_transforms(length, step == 0, sign), schema)
        cells = done.select(*keys, "line", F.posexplode(F.arrays_zip("re", "im")).alias("k", "x"))
        # a column's k-th value belongs to the k-th row next
        df = cells.select(*keys, F.col("k").cast("bigint").alias("line"), F.col("line").alias("at"), "x.re", "x.im") if step == 0 else (
            cells.select(*keys, (F.col("line") + F.col("m1") * F.col("k")).alias("i"), "x.re", "x.im"))
    return df


def fourier(df: DataFrame, by: Sequence[str], index: str = "i", inverse: bool = False) -> DataFrame:
    """(by, index, n, re, im): the transform of each group's series (index, re, im), whose indices run from 0 without gaps.

    The inverse is divided by n. A group's n points may be any number of at least one.
    """
    by = list(by)
    sign = 1 if inverse else -1
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    bits = F.ceil(F.log2(F.greatest(2 * F.col("n") - 1, F.lit(2)))).cast("int")
    low = F.floor(bits / 2).cast("int")
    sizes = materialize(sizes.withColumns({"m1": F.pow(F.lit(2.0), low).cast("bigint"), "m2": F.pow(F.lit(2.0), bits - low).cast("bigint")}))
    n, i = F.col("n"), F.col("i")

    def chirp(direction: int, j: Column) -> tuple[Column, Column]:
        """exp(direction · iπ j² / n); j² is reduced as a whole number first."""
        angle = F.lit(np.pi) * F.pmod(j * j, 2 * n) / n
        return F.cos(angle), direction * F.sin(angle)

    placed = join_groups(df.select(*by, F.col(index).cast("bigint").alias("i"), F.col("re").cast("double"), F.col("im").cast("double")), sizes, by)
    re, im = _complex_product((F.col("re"), F.col("im")), chirp(sign, i))
    first = _power_of_two_transform(placed.select(*by, "m1", "m2", "i", re.alias("re"), im.alias("im")), by, -1)
    # the other factor is the same for all series of one length
    lengths = sizes.select("n", "m1", "m2").distinct()
    m = F.col("m1") * F.col("m2")
    wrapped = lengths.select("n", "m1", "m2", F.explode(F.sequence(1 - n, n - 1)).alias("j"))
    c, s = chirp(-sign, F.col("j"))
    second = _power_of_two_transform(wrapped.select("n", "m1", "m2", F.pmod("j", m).alias("i"), c.alias("re"), s.alias("im")), ["n"], -1)
    lengthened = join_groups(first, sizes.select(*by, "n"), by)
    both = lengthened.join(second.select("n", "i", F.col("re").alias("re2"), F.col("im").alias("im2")), ["n", "i"])
    re, im = _complex_product((F.col("re"), F.col("im")), (F.col("re2"), F.col("im2")))
    back = _power_of_two_transform(both.select(*by, "m1", "m2", "i", re.alias("re"), im.alias("im")), by, 1)
    out = join_groups(back, sizes.select(*by, "n"), by).filter(i < n)
    re, im = _complex_product((F.col("re") / m, F.col("im") / m), chirp(sign, i))
    scale = 1 / n if inverse else F.lit(1.0)
    return out.select(*by, i.alias(index), "n", (re * scale).alias("re"), (im * scale).alias("im"))


def frequency(index: str = "i", n: str = "n") -> Column:
    """Cycles per point of a transform's k-th value, without sign."""
    return F.least(F.col(index), F.col(n) - F.col(index)) / F.col(n)


def high_frequency_share(spectrum: DataFrame, by: Sequence[str], threshold: float, column: str = "share") -> DataFrame:
    """Per group the share of its energy around the mean above `threshold` cycles per point; null for a constant series."""
    energy = F.col("re") * F.col("re") + F.col("im") * F.col("im")
    moving = F.sum(F.when(F.col("i") > 0, energy))
    # rounding leaves a constant series some energy, of no size beside its own
    return spectrum.groupBy(*by).agg(F.when(moving > 1e-20 * F.sum(energy), F.sum(
        F.when(frequency() > threshold, energy).otherwise(0.0)) / moving).alias(column))


def low_pass(spectrum: DataFrame, by: Sequence[str], threshold: float) -> DataFrame:
    """(by, i, value): the series without what lies above `threshold` cycles per point."""
    kept = frequency() <= threshold
    cut = spectrum.select(*by, "i", *[F.when(kept, F.col(c)).otherwise(0.0).alias(c) for c in ("re", "im")])
    return fourier(cut, by, inverse=True).select(*by, "i", F.col("re").alias("value"))
