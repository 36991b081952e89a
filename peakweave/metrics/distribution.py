"""Gap between two distributions of feature vectors, from the divergence frontier of their clusters."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakweave.functions.arrays import l2_normalize, let
from peakweave.session import materialize


def cluster_histograms(p: DataFrame, q: DataFrame, num_buckets: int, explained: float = 0.9,
                       redo: int = 5, max_iter: int = 500, seed: int = 25, vector: str = "features") -> DataFrame:
    """(cluster, p, q): each side's share per k-means cluster of the joint, normalised, PCA-reduced vectors.

    `num_buckets` is the caller's: the centres are held by every task, so their number must not follow the data.
    """
    both = p.select(F.lit("p").alias("side"), F.col(vector).alias("v")).unionByName(
        q.select(F.lit("q").alias("side"), F.col(vector).alias("v")))
    data = materialize(both.select("side", array_to_vector(l2_normalize("v")).alias("x")))
    sizes = {row["side"]: row["count"] for row in data.groupBy("side").count().collect()}  # two rows
    width = len(data.first()["x"])
    model = PCA(k=width, inputCol="x", outputCol="z").fit(data)
    kept, total = 0, 0.0
    while kept < width and total < explained:
        total += float(model.explainedVariance[kept])
        kept += 1
    reduced = materialize(model.transform(data).select(
        "side", array_to_vector(F.slice(vector_to_array("z"), 1, kept)).alias("z")))
    fits = [KMeans(k=num_buckets, maxIter=max_iter, seed=seed + i, featuresCol="z", predictionCol="cluster").fit(reduced)
            for i in range(redo)]
    best = min(fits, key=lambda m: m.summary.trainingCost)
    counts = best.transform(reduced).groupBy("cluster").agg(
        F.count_if(F.col("side") == "p").alias("n_p"), F.count_if(F.col("side") == "q").alias("n_q"))
    return counts.select("cluster", (F.col("n_p") / sizes["p"]).alias("p"), (F.col("n_q") / sizes["q"]).alias("q"))


def frontier_area(histograms: DataFrame, points: int = 25, scaling: float = 5.0) -> DataFrame:
    """Area under the curve (exp(-c·KL(q‖r)), exp(-c·KL(p‖r))) over mixtures r = w·p + (1-w)·q."""
    step = (1 - 2e-6) / (points - 1)
    weights = F.explode(F.array(*[F.lit(1e-6 + i * step) for i in range(points)]))
    mixed = histograms.select("p", "q", weights.alias("w")).withColumn("r", F.col("w") * F.col("p") + (1 - F.col("w")) * F.col("q"))

    def kl(a: str) -> Column:
        return F.sum(F.when(F.col(a) > 0, F.col(a) * F.log(F.col(a) / F.col("r"))).otherwise(0.0))

    curve = mixed.groupBy("w").agg(F.exp(-scaling * kl("q")).alias("x"), F.exp(-scaling * kl("p")).alias("y"))
    entries = F.concat(F.array(F.struct(F.lit(1.0).alias("x"), F.lit(0.0).alias("y")),
                               F.struct(F.lit(0.0).alias("x"), F.lit(1.0).alias("y"))),
                       F.collect_list(F.struct("x", "y")))  # one entry per mixture

    def area(first: str, second: str) -> Column:
        # along the curve: of points with one abscissa the higher comes first
        ordered = F.transform(
            F.array_sort(F.transform("c", lambda s: F.struct(s[first].alias("a"), (-s[second]).alias("b")))),
            lambda s: F.struct(s["a"].alias("a"), (-s["b"]).alias("b")))
        return let(ordered, lambda o: F.aggregate(
            F.sequence(F.lit(1), F.size(o) - 1), F.lit(0.0),
            lambda acc, i: acc + (F.get(o, i)["a"] - F.get(o, i - 1)["a"]) * (F.get(o, i)["b"] + F.get(o, i - 1)["b"]) / 2))

    return curve.agg(entries.alias("c")).select(((area("x", "y") + area("y", "x")) / 2).alias("mauve"))


def mauve(p: DataFrame, q: DataFrame, num_buckets: int, points: int = 25, scaling: float = 5.0, **options) -> DataFrame:
    return frontier_area(cluster_histograms(p, q, num_buckets, **options), points, scaling)
