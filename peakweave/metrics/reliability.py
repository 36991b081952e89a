"""Reliability of training curves (run, t, value): dispersion and risk over time and across runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakweave.functions.numeric import ratio
from peakweave.operators.joins import join_groups
from peakweave.operators.ordering import ordered_scan
from peakweave.operators.quantiles import group_quantiles
from peakweave.operators.spectral import fourier, high_frequency_share, low_pass
from peakweave.session import materialize

# 20 evaluation points, every 100 000 steps from 50 000 on.
EVAL_POINTS = tuple(range(50_000, 2_000_000, 100_000))


def spread(df: DataFrame, value: str, keys: Sequence[str], alpha: float) -> DataFrame:
    """Per group: median, iqr, mad, stddev (population) and the mean of the lower and the upper tail.

    A tail holds the values at or below the alpha quantile, or at or above the 1 - alpha
    one. All quantiles come from one sort, the mad from a second.
    """
    keys = list(keys)
    data = materialize(df.select(*keys, F.col(value).alias("__v")))
    cuts = group_quantiles(data, "__v", {"__q1": 0.25, "__mid": 0.5, "__q3": 0.75, "__lo": alpha, "__hi": 1 - alpha}, keys)
    joined = materialize(join_groups(data, cuts, keys))
    x = F.col("__v")
    stats = joined.groupBy(*keys).agg(
        F.first("__mid").alias("median"), (F.first("__q3") - F.first("__q1")).alias("iqr"),
        F.stddev_pop(x).alias("stddev"), F.avg(F.when(x <= F.col("__lo"), x)).alias("lower_cvar"),
        F.avg(F.when(x >= F.col("__hi"), x)).alias("upper_cvar"))
    away = joined.select(*keys, F.abs(x - F.col("__mid")).alias("__d"))
    return join_groups(stats, group_quantiles(away, "__d", {"mad": 0.5}, keys), keys)


def curve_range(df: DataFrame) -> DataFrame:
    """(run, baseline): 95th percentile of the run minus its first value."""
    top = group_quantiles(df, "value", {"__p95": 0.95}, ["run"])
    first = df.groupBy("run").agg(F.min_by("value", "t").alias("__first"))
    return join_groups(top, first, ["run"]).select("run", (F.col("__p95") - F.col("__first")).alias("baseline"))


def _windows(df: DataFrame, eval_points: Sequence[int], size: int) -> DataFrame:
    """Each row once per window (e - size, e] it falls into."""
    points = F.array(*[F.lit(int(e)) for e in eval_points])
    inside = F.filter(points, lambda e: (F.col("t") <= e) & (F.col("t") > e - size))
    return df.withColumn("eval", F.explode(inside))


def online_reliability(df: DataFrame, eval_points: Sequence[int] = EVAL_POINTS, window_size: int = 100_000,
                       window_size_trimmed: int = 99_000, alpha: float = 0.05,
                       freq_thresh: float | None = 0.01) -> DataFrame:
    """One row of metrics over training curves, scaled by each run's curve range.

    `high_freq_energy_within_runs` is the mean share of a curve's energy around its mean above
    `freq_thresh` cycles per point, and the metrics across runs see the curves without that
    part. None leaves both out.
    """
    df = materialize(df.select("run", "t", F.col("value").cast("double").alias("value")))
    base = materialize(curve_range(df))
    # one sort gives the places, the peaks and, by the place before, the changes
    placed = materialize(ordered_scan(df, ["t"], ["run"], index="i", maxima={"peak": "value"}))
    past = placed.select("run", (F.col("i") + 1).alias("i"), F.col("value").alias("__past"))
    diffs = materialize(join_groups(placed, past, ["run", "i"]).select("run", "t", (F.col("value") - F.col("__past")).alias("d")))

    def scaled(frame, names):
        """Means over all runs (and windows) of the named columns in units of the run's range."""
        return join_groups(frame, base, ["run"]).agg(*[
            F.avg(ratio(c if isinstance(c, Column) else F.col(c), F.col("baseline"), None)).alias(name) for name, c in names.items()])

    within = spread(_windows(diffs, eval_points, window_size_trimmed), "d", ["run", "eval"], alpha)
    parts = [scaled(within, {f"{c}_within_runs": c for c in ("iqr", "mad", "stddev")})]
    # changes, falls from the peak and values share one sort
    kinds = {"diffs": diffs.select("run", F.col("d").alias("x")), "drawdown": placed.select("run", (F.col("peak") - F.col("value")).alias("x")),
             "raw": df.select("run", F.col("value").alias("x"))}
    tagged = None
    for kind, frame in kinds.items():
        frame = frame.withColumn("kind", F.lit(kind))
        tagged = frame if tagged is None else tagged.unionByName(frame)
    parts.append(scaled(spread(tagged, "x", ["run", "kind"], alpha), {
        f"{c}_on_{kind}": F.when(F.col("kind") == kind, F.col(c)) for kind in kinds for c in ("lower_cvar", "upper_cvar")}))
    parts.append(placed.groupBy("run").agg(F.max(F.col("peak") - F.col("value")).alias("m")).agg(F.avg("m").alias("max_drawdown")))
    smooth = df
    if freq_thresh is not None:
        spectrum = materialize(fourier(placed.select("run", "i", F.col("value").alias("re"), F.lit(0.0).alias("im")), ["run"]))
        share = high_frequency_share(spectrum, ["run"], freq_thresh)
        parts.append(share.agg(F.avg("share").alias("high_freq_energy_within_runs")))
        smooth = join_groups(placed.select("run", "t", "i"), low_pass(spectrum, ["run"], freq_thresh), ["run", "i"]).select("run", "t", "value")
    # every run's median in the window stands for the run at that point
    medians = materialize(group_quantiles(_windows(smooth, eval_points, window_size), "value", {"m": 0.5}, ["run", "eval"]))
    across = spread(medians, "m", ["eval"], alpha).join(F.broadcast(base.agg(F.avg("baseline").alias("__b"))))
    names = {"iqr": "iqr_across_runs", "mad": "mad_across_runs", "stddev": "stddev_across_runs",
             "lower_cvar": "lower_cvar_on_across", "upper_cvar": "upper_cvar_on_across"}
    parts.append(across.agg(*[F.avg(ratio(F.col(c), F.col("__b"), None)).alias(n) for c, n in names.items()]))
    if freq_thresh is not None:
        medians = group_quantiles(_windows(df, eval_points, window_size), "value", {"m": 0.5}, ["run", "eval"])
    parts.append(medians.agg(F.avg("m").alias("median_perf_during_training")))
    out = parts[0]
    for part in parts[1:]:
        out = out.join(F.broadcast(part))  # one row each
    return out


def offline_reliability(df: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Per run (a fixed policy) over its rollouts, scaled by the run's median performance."""
    stats = spread(df.select("run", F.col("value").cast("double").alias("value")), "value", ["run"], alpha)
    return stats.select(
        "run", *[ratio(F.col(c), F.col("median"), None).alias(f"{c}_across_rollouts")
                 for c in ("iqr", "mad", "stddev", "lower_cvar", "upper_cvar")],
        F.col("median").alias("median_perf_across_rollouts"))
