import numpy as np
import pytest
from pyspark.sql import functions as F

from peakweave.metrics.reliability import online_reliability
from peakweave.operators.spectral import fourier, high_frequency_share, low_pass


def series(spark, curves):
    rows = [(g, i, float(v.real), float(v.imag)) for g, x in curves.items() for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "g string, i int, re double, im double").repartition(3)


def collected(df, curves):
    out = {g: np.zeros(len(x), dtype=complex) for g, x in curves.items()}
    for r in df.collect():
        assert r.n == len(curves[r.g])
        out[r.g][r.i] = r.re + 1j * r.im
    return out


def test_transforms_of_any_length_and_back(spark):
    rng = np.random.default_rng(1)
    curves = {f"n{n}": rng.normal(size=n) + 1j * rng.normal(size=n) for n in (1, 2, 7, 16, 97, 291)}
    curves["same length"] = rng.normal(size=97) + 0j
    curves[None] = rng.normal(size=5) + 0j
    df = series(spark, curves)
    spectrum = fourier(df, ["g"])
    for g, x in collected(spectrum, curves).items():
        np.testing.assert_allclose(x, np.fft.fft(curves[g]), atol=1e-9)
    for g, x in collected(fourier(spectrum, ["g"], inverse=True), curves).items():
        np.testing.assert_allclose(x, curves[g], atol=1e-9)


def test_shares_and_filter(spark):
    t = np.arange(200)
    curves = {"slow": 5 + np.sin(2 * np.pi * t / 100), "mixed": np.sin(2 * np.pi * t / 100) + 2 * np.cos(2 * np.pi * t / 4), "flat": np.full(31, 0.1)}
    df = series(spark, {g: x + 0j for g, x in curves.items()})
    spectrum = fourier(df, ["g"])
    shares = {r.g: r.share for r in high_frequency_share(spectrum, ["g"], 0.05).collect()}
    assert shares["slow"] == pytest.approx(0, abs=1e-12) and shares["mixed"] == pytest.approx(0.8) and shares["flat"] is None
    smooth = {}
    for r in low_pass(spectrum, ["g"], 0.05).collect():
        smooth.setdefault(r.g, {})[r.i] = r.value
    np.testing.assert_allclose([smooth["mixed"][k] for k in range(200)], np.sin(2 * np.pi * t / 100), atol=1e-9)
    np.testing.assert_allclose([smooth["flat"][k] for k in range(31)], 0.1, atol=1e-12)


def test_a_long_curve_is_in_no_task_whole(spark):
    """A million points: tasks transform arrays of about a thousand."""
    n = 1_000_000
    wave = lambda i: F.sin(2 * np.pi * 12_345 * i / n) + 0.5
    df = spark.range(n).select(F.lit("a").alias("g"), F.col("id").alias("i"), wave(F.col("id")).alias("re"), F.lit(0.0).alias("im"))
    spectrum = fourier(df, ["g"])
    top = {r.i: r for r in spectrum.orderBy(F.desc(F.hypot("re", "im"))).limit(4).collect()}
    others = set(top) - {0, 12_345, n - 12_345}
    assert len(top) == 4 and len(others) == 1
    assert top[0].re == pytest.approx(n / 2)
    for k in (12_345, n - 12_345):
        assert np.hypot(top[k].re, top[k].im) == pytest.approx(n / 2, rel=1e-9)
    assert all(np.hypot(top[k].re, top[k].im) < 1e-4 for k in others)


def test_filtered_reliability(spark):
    rng = np.random.default_rng(3)
    rows, curves = [], {}
    for run in range(4):
        x = np.cumsum(rng.normal(size=50)) + run
        curves[run] = x
        rows += [(run, t, float(v)) for t, v in enumerate(x)]
    df = spark.createDataFrame(rows, "run int, t int, value double")
    row = online_reliability(df, (24, 49), 25, 25, freq_thresh=0.1).first()
    shares, medians = [], []
    for x in curves.values():
        f = np.fft.fft(x)
        high = np.minimum(np.arange(50), 50 - np.arange(50)) / 50 > 0.1
        shares.append((abs(f[high]) ** 2).sum() / (abs(f[1:]) ** 2).sum())
        y = np.fft.ifft(np.where(high, 0, f)).real
        medians.append([np.median(y[:25]), np.median(y[25:])])
    scale = np.mean([np.quantile(x, 0.95) - x[0] for x in curves.values()])
    assert row.high_freq_energy_within_runs == pytest.approx(np.mean(shares))
    assert row.stddev_across_runs == pytest.approx(np.std(medians, axis=0).mean() / scale)
    plain = [[np.median(x[:25]), np.median(x[25:])] for x in curves.values()]
    assert row.median_perf_during_training == pytest.approx(np.mean(plain))
