"""Regression and correlation metrics over `prediction` and `reference`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakweave.functions.numeric import correlation_p_value, ratio
from peakweave.metrics.core import Metric, register, weight_column
from peakweave.operators.joins import join_groups
from peakweave.operators.ordering import average_ranks, lag_difference
from peakweave.session import materialize

EPS = 2.220446049250313e-16  # double precision machine epsilon


def _p() -> Column:
    return F.col("prediction").cast("double")


def _r() -> Column:
    return F.col("reference").cast("double")


def _mean_metric(name: str, error: Column, weight: str | None, finish=lambda x: x) -> Metric:
    w = weight_column(weight)
    return Metric(name, {"e": F.sum(w * error), "w": F.sum(w)}, {name: lambda s: finish(ratio(s["e"], s["w"], None))})


def _errors() -> dict[str, Column]:
    p, r = _p(), _r()
    d = p - r
    dl = F.log1p(p) - F.log1p(r)
    return {
        "squared": d * d,
        "absolute": F.abs(d),
        "percentage": F.abs(d) / F.greatest(F.abs(r), F.lit(EPS)),
        "symmetric": 2 * F.abs(d) / (F.greatest(F.abs(r), F.lit(EPS)) + F.greatest(F.abs(p), F.lit(EPS))),
        "squared_log": dl * dl,
    }


@register("mse")
def mse(squared: bool = True, weight: str | None = None, name: str | None = None) -> Metric:
    """Mean squared error, or its root."""
    finish = (lambda x: x) if squared else F.sqrt
    return _mean_metric(name or "mse", _errors()["squared"], weight, finish)


@register("rmse")
def rmse(weight: str | None = None) -> Metric:
    return mse(False, weight, "rmse")


@register("mae")
def mae(weight: str | None = None) -> Metric:
    return _mean_metric("mae", _errors()["absolute"], weight)


@register("mape")
def mape(weight: str | None = None) -> Metric:
    return _mean_metric("mape", _errors()["percentage"], weight)


@register("smape")
def smape(weight: str | None = None) -> Metric:
    return _mean_metric("smape", _errors()["symmetric"], weight)


@register("msle")
def msle(weight: str | None = None) -> Metric:
    return _mean_metric("msle", _errors()["squared_log"], weight)


@register("mse_msle")
def mse_msle(alpha: float = 2.0, beta: float = 10.0) -> Metric:
    """alpha·mse + beta·msle."""
    e = _errors()
    return _mean_metric("mse_msle", alpha * e["squared"] + beta * e["squared_log"], None)


@register("mae_msle")
def mae_msle(alpha: float = 2.0, beta: float = 10.0) -> Metric:
    e = _errors()
    return _mean_metric("mae_msle", alpha * e["absolute"] + beta * e["squared_log"], None)


@register("r_squared")
def r_squared() -> Metric:
    """1 - residual / total sum of squares, rounded to 3 decimals; null when the reference is constant."""
    d = _p() - _r()
    return Metric(
        "r_squared",
        {"ssr": F.sum(d * d), "var": F.var_pop(_r()), "n": F.count(_r())},
        {"r_squared": lambda s: F.round(1 - ratio(s["ssr"], s["var"] * s["n"], None), 3)})


@register("pearsonr")
def pearsonr(p_value: bool = True) -> Metric:
    def r(s):  # null for a single row and where a side is constant
        return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ratio(s["c"], s["sp"] * s["sr"], None)))

    finish = {"pearsonr": lambda s: F.when(s["sp"] * s["sr"] > 0, r(s))}
    if p_value:
        finish["p-value"] = lambda s: correlation_p_value(F.when(s["sp"] * s["sr"] > 0, r(s)), s["n"])
    both = _p().isNotNull() & _r().isNotNull()
    return Metric("pearsonr", {"c": F.covar_pop(_p(), _r()), "sp": F.stddev_pop(F.when(both, _p())),
                               "sr": F.stddev_pop(F.when(both, _r())), "n": F.count(F.lit(1))}, finish)


@register("perplexity")
def perplexity(loss: str = "loss") -> Metric:
    """exp of the mean loss; overflows to infinity."""
    return Metric("perplexity", {"l": F.avg(F.col(loss).cast("double"))}, {"perplexity": lambda s: F.exp(s["l"])})


@register("spearmanr")
def spearmanr(p_value: bool = True) -> Metric:
    def compute(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        out = rank_correlation(df, keys)
        p = [correlation_p_value("spearmanr", "n").alias("spearmanr_pvalue")] if p_value else []
        return out.select(*keys, "spearmanr", *p)

    return Metric("spearmanr", compute=compute)


def rank_correlation(df: DataFrame, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Spearman correlation from average ranks, per group; returns spearmanr and n.

    `weight` names a column that says how many rows a row stands for. Rows are first collapsed to distinct (prediction, reference) pairs with counts,
    and ranks are computed once per distinct value. Ranks are centred on their known
    mean before squaring, which keeps the sums exact enough at any row count.
    """
    keys = list(keys)
    copies = F.sum(weight) if weight else F.count(F.lit(1))
    pairs = materialize(df.groupBy(*keys, _p().alias("x"), _r().alias("y")).agg(copies.alias("c")))
    ranked = pairs
    for value, rank in (("x", "rx"), ("y", "ry")):
        table = average_ranks(pairs, value, rank, keys, weight="c").drop("n")
        ranked = join_groups(ranked, table, [*keys, value])
    totals = pairs.groupBy(*keys).agg(F.sum("c").alias("n"))
    ranked = join_groups(ranked, totals, keys)
    middle = (F.col("n") + 1) / 2
    a, b, c = F.col("rx") - middle, F.col("ry") - middle, F.col("c")
    sums = ranked.groupBy(*keys).agg(F.sum(c * a * b).alias("ab"), F.sum(c * a * a).alias("aa"),
                                     F.sum(c * b * b).alias("bb"), F.first("n").alias("n"))
    return sums.select(*keys, ratio(F.col("ab"), F.sqrt(F.col("aa") * F.col("bb")), None).alias("spearmanr"), "n")


def multioutput(df: DataFrame, error: str, weight: str | None = None, squared: bool = True,
                aggregate: str | Sequence[float] = "uniform_average") -> DataFrame:
    """mse / mae / mape / smape over ARRAY columns: one error per output position.

    `raw_values` returns the array `value`; `uniform_average` and explicit weights a scalar.
    A root (squared=False) is taken per output, before averaging.
    """
    kind = {"mse": "squared", "mae": "absolute", "mape": "percentage", "smape": "symmetric"}[error]
    w = weight_column(weight).alias("__w")
    flat = df.select(w, F.posexplode(F.arrays_zip("prediction", "reference")).alias("i", "z")).select(
        "__w", "i", F.col("z.prediction").alias("prediction"), F.col("z.reference").alias("reference"))
    per = flat.groupBy("i").agg(ratio(F.sum(F.col("__w") * _errors()[kind]), F.sum("__w"), None).alias("v"))
    if not squared:
        per = per.withColumn("v", F.sqrt("v"))
    if aggregate == "uniform_average":
        return per.agg(F.avg("v").alias("value"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"])  # one per output
    raw = per.agg(ordered.alias("value"))
    if aggregate == "raw_values":
        return raw
    weights = F.array(*[F.lit(float(x)) for x in aggregate])
    products = F.zip_with("value", weights, lambda v, x: v * x)
    total = F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
    return raw.select((total / float(sum(aggregate))).alias("value"))


def mase(df: DataFrame, training: DataFrame, order_by: Sequence[str], series: Sequence[str] = (),
         period: int = 1, value: str = "value", weight: str | None = None) -> DataFrame:
    """Mean absolute error scaled by the naive seasonal error of the training series, per series."""
    keys = list(series)
    naive = lag_difference(training, value, order_by, period, keys, "__d").groupBy(*keys).agg(
        F.avg(F.abs("__d")).alias("__naive"))
    w = weight_column(weight)
    error = df.groupBy(*keys).agg(ratio(F.sum(w * F.abs(_p() - _r())), F.sum(w), None).alias("__mae"))
    joined = join_groups(error, naive, keys)
    return joined.select(*keys, (F.col("__mae") / F.greatest("__naive", F.lit(EPS))).alias("mase"))


def text_perplexity(tokens: DataFrame, text_id: str, nll: str = "nll", mask: str | None = None) -> DataFrame:
    """exp(mean token loss) per text; null for a text whose tokens are all masked."""
    m = F.col(mask).cast("double") if mask else F.lit(1.0)
    return tokens.groupBy(text_id).agg(F.exp(ratio(F.sum(F.col(nll) * m), F.sum(m), None)).alias("perplexity"))


def corpus_perplexity(tokens: DataFrame, text_id: str, nll: str = "nll", mask: str | None = None) -> DataFrame:
    """The mean of the texts' perplexities; texts without a counted token are left out."""
    return text_perplexity(tokens, text_id, nll, mask).agg(F.avg("perplexity").alias("mean_perplexity"))
