"""Mahalanobis distance, coreference clusters, and aggregates of given per-row scores."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakweave.functions.arrays import dot
from peakweave.functions.numeric import ratio
from peakweave.operators.quantiles import group_quantiles


def covariance(df: DataFrame, vector: str) -> DataFrame:
    """One row: n, the mean vector and the flattened sum of centred outer products.

    Each batch of rows becomes one matrix product in its task; only d×d sums are shuffled.
    """
    center = df.agg(vector_to_array(Summarizer.mean(array_to_vector(F.col(vector)))).alias("mu"))
    rows = df.select(F.col(vector).cast("array<double>").alias("v")).join(F.broadcast(center))  # one row

    def gram(batches):
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["v"]) - np.asarray(pdf["mu"].iloc[0])
                yield pd.DataFrame({"n": [len(x)], "g": [(x.T @ x).ravel()]})

    partial = rows.mapInPandas(gram, "n long, g array<double>")
    summed = partial.agg(F.sum("n").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("g"))).alias("g"))
    return summed.join(F.broadcast(center))


def mahalanobis(df: DataFrame, reference: DataFrame, vector: str = "embedding", per_dimension: bool = False) -> DataFrame:
    """Add `mahalanobis`, the squared distance of each row's vector from the reference distribution.

    As in the original, one scalar (the grand mean) is subtracted from every dimension;
    `per_dimension` subtracts the mean vector instead. A singular covariance is
    pseudo-inverted. Only the d×d covariance reaches the driver.
    """
    row = covariance(reference, vector).first()
    d, n = len(row["mu"]), row["n"]
    if n < 2:
        raise ValueError("the reference distribution needs at least two rows")
    cov = np.array(row["g"]).reshape(d, d) / (n - 1)
    try:
        inverse = np.linalg.inv(cov)
    except np.linalg.LinAlgError:
        inverse = np.linalg.pinv(cov)
    center = np.array(row["mu"]) if per_dimension else np.full(d, np.mean(row["mu"]))
    # d×d values in one broadcast row
    consts = df.sparkSession.createDataFrame([(center.tolist(), inverse.tolist())],
                                             "__c array<double>, __inv array<array<double>>")
    shifted = df.join(F.broadcast(consts)).withColumn(
        "__x", F.zip_with(vector, "__c", lambda x, c: x.cast("double") - c))
    form = dot(F.transform("__inv", lambda r: dot(r, F.col("__x"))), F.col("__x"))
    return shifted.withColumn("mahalanobis", form).drop("__c", "__inv", "__x")


def aggregate_scores(df: DataFrame, column: str, how: str = "mean") -> DataFrame:
    """Mean, sum or exact median of given per-row scores."""
    if how == "median":
        return group_quantiles(df, column, {column: 0.5})
    return df.agg({"mean": F.avg, "sum": F.sum}[how](column).alias(column))


# --- coreference -----------------------------------------------------------------------------

def _one_side(own: DataFrame, other: DataFrame) -> DataFrame:
    """Numerators and denominators of the four scores, with `own` as the measured side."""
    size = own.groupBy("doc", "cluster").agg(F.count(F.lit(1)).alias("size"))
    other_size = other.groupBy("doc", F.col("cluster").alias("theirs")).agg(F.count(F.lit(1)).alias("their_size"))
    links = own.join(other.select("doc", "mention", F.col("cluster").alias("theirs")), ["doc", "mention"]).groupBy(
        "doc", "cluster", "theirs").agg(F.count(F.lit(1)).alias("n"))
    links = links.join(other_size, ["doc", "theirs"])
    per = links.groupBy("doc", "cluster").agg(
        F.sum("n").alias("found"), F.count(F.lit(1)).alias("parts"), F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs"), F.min("their_size").alias("their_size"))
    full = size.join(per, ["doc", "cluster"], "left").na.fill(0)
    s = F.col("size")
    kept = F.when(s == 1, ((F.col("found") == 1) & (F.col("their_size") == 1)).cast("double")).otherwise(
        ratio(F.col("pairs"), s * (s - 1) / 2))
    return full.agg(
        F.sum("found").cast("double").alias("mentions_n"), F.sum(s).alias("mentions_d"),
        F.sum(F.col("found") - F.col("parts")).cast("double").alias("muc_n"), F.sum(s - 1).alias("muc_d"),
        F.sum(F.col("squares") / s).alias("bcub_n"), F.sum(s).alias("bcub_d"),
        F.sum(s * kept).alias("lea_n"), F.sum(s).alias("lea_d"))


def coreference(key: DataFrame, system: DataFrame, keep_singletons: bool = True) -> DataFrame:
    """mentions, MUC, B³ and LEA recall / precision / f1 from (doc, cluster, mention) tables."""
    if not keep_singletons:
        def big(df):
            sizes = df.groupBy("doc", "cluster").count().filter("count > 1").select("doc", "cluster")
            return df.join(sizes, ["doc", "cluster"], "left_semi")

        key, system = big(key), big(system)
    rec = _one_side(key, system)
    prec = _one_side(system, key)
    both = rec.select([F.col(c).alias(f"r_{c}") for c in rec.columns]).join(
        F.broadcast(prec.select([F.col(c).alias(f"p_{c}") for c in prec.columns])))
    out = []
    for m in ("mentions", "muc", "bcub", "lea"):
        r, p = (ratio(F.col(f"{x}_{m}_n"), F.col(f"{x}_{m}_d")) for x in "rp")
        out += [r.alias(f"{m}/recall"), p.alias(f"{m}/precision"), ratio(2 * p * r, p + r).alias(f"{m}/f1")]
    return both.select(*out)
