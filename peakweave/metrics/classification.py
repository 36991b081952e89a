"""Classification metrics from confusion counts.

All of them start from weighted counts per (reference, prediction) pair — two-phase
aggregated, at most classes² rows — so the data are scanned once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peakweave.functions.numeric import ratio
from peakweave.metrics.core import Metric, register, weight_column


@register("accuracy")
def accuracy(normalize: bool = True, weight: str | None = None) -> Metric:
    """Share (or weight) of rows with prediction = reference; arrays must match whole."""
    w = weight_column(weight)
    hit = F.col("prediction").eqNullSafe(F.col("reference")).cast("double")
    return Metric("accuracy", {"hit": F.sum(w * hit), "w": F.sum(w)},
                  {"accuracy": lambda s: ratio(s["hit"], s["w"], None) if normalize else s["hit"]})


@register("brier_score")
def brier_score(pos_label=1, weight: str | None = None) -> Metric:
    w = weight_column(weight)
    d = F.col("prediction").cast("double") - (F.col("reference") == F.lit(pos_label)).cast("double")
    return Metric("brier_score", {"e": F.sum(w * d * d), "w": F.sum(w)}, {"brier_score": lambda s: ratio(s["e"], s["w"], None)})


def confusion_counts(df: DataFrame, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """(reference, prediction, w) with the summed weight of each pair that occurs."""
    return df.groupBy(*keys, "reference", "prediction").agg(F.sum(weight_column(weight)).alias("w"))


def confusion_matrix(df: DataFrame, labels: Sequence | None = None, weight: str | None = None,
                     normalize: str | None = None) -> DataFrame:
    """One row per cell of the matrix, absent ones 0; normalised over `true` rows, `pred` columns or `all`."""
    counts = confusion_counts(df, weight=weight)
    if labels is None:
        # distinct classes: at most as many rows as the matrix has rows
        label = counts.select(F.explode(F.array("reference", "prediction")).alias("label")).distinct()
        listed = label.agg(F.array_sort(F.collect_list("label")).alias("labels"))
    else:
        listed = df.sparkSession.range(1).select(F.array(*[F.lit(v) for v in labels]).alias("labels"))
    grid = listed.select("labels", F.explode("labels").alias("reference")).select(
        "reference", F.explode("labels").alias("prediction"))
    full = grid.join(counts, ["reference", "prediction"], "left").select(
        "reference", "prediction", F.coalesce("w", F.lit(0.0)).alias("value"))
    if normalize is None:
        return full
    over = {"true": Window.partitionBy("reference"), "pred": Window.partitionBy("prediction"),
            "all": Window.partitionBy()}[normalize]
    return full.withColumn("value", ratio(F.col("value"), F.sum("value").over(over)))


def class_counts(df: DataFrame, keys: Sequence[str] = (), weight: str | None = None,
                 multilabel: bool = False) -> DataFrame:
    """Per class: tp, pred (predicted), true (support). Multilabel rows hold 0/1 arrays, one slot per class."""
    if multilabel:
        w = weight_column(weight).alias("__w")
        slots = df.select(*keys, w, F.posexplode(F.arrays_zip("prediction", "reference")).alias("label", "z"))
        p, r = F.col("z.prediction") == 1, F.col("z.reference") == 1
        one = F.col("__w")
        return slots.groupBy(*keys, "label").agg(
            F.sum(F.when(p & r, one).otherwise(0.0)).alias("tp"), F.sum(F.when(p, one).otherwise(0.0)).alias("pred"),
            F.sum(F.when(r, one).otherwise(0.0)).alias("true"))
    zero = F.lit(0.0)
    hit = F.when(F.col("reference") == F.col("prediction"), F.col("w")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("reference").alias("label"), hit.alias("tp"), zero.alias("pred"), F.col("w").alias("true")),
        F.struct(F.col("prediction").alias("label"), zero.alias("tp"), F.col("w").alias("pred"), zero.alias("true")))
    return confusion_counts(df, keys, weight).select(*keys, F.inline(sides)).groupBy(*keys, "label").agg(
        F.sum("tp").alias("tp"), F.sum("pred").alias("pred"), F.sum("true").alias("true"))


def class_scores(tp: Column, pred: Column, true: Column, zero_division: float = 0.0) -> dict[str, Column]:
    return {
        "precision": ratio(tp, pred, zero_division),
        "recall": ratio(tp, true, zero_division),
        "f1": ratio(2 * tp, pred + true, zero_division),
    }


def precision_recall_f1(df: DataFrame, average: str | None = "binary", pos_label=1, labels: Sequence | None = None,
                        weight: str | None = None, zero_division: float = 0.0, multilabel: bool = False,
                        keys: Sequence[str] = ()) -> DataFrame:
    """precision, recall, f1 with average binary / micro / macro / weighted / samples / None (one row per class)."""
    keys = list(keys)
    if average == "samples":
        return _per_sample(df, keys, weight, zero_division)
    counts = class_counts(df, keys, weight, multilabel)
    if labels is not None:
        wanted = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(v) for v in labels])).alias("label"))
        counts = (counts.join(F.broadcast(wanted), "label", "left_semi") if keys
                  else wanted.join(counts, "label", "left").na.fill(0.0, ["tp", "pred", "true"]))
    scored = counts.withColumns(class_scores(F.col("tp"), F.col("pred"), F.col("true"), zero_division))
    names = ("precision", "recall", "f1")
    if average is None:
        return scored.select(*keys, "label", *names, F.col("true").alias("support"))
    if average == "binary":
        # a group without the positive class still has a row
        own = {n: F.coalesce(F.sum(F.when(F.col("label") == F.lit(pos_label), F.col(n))), F.lit(0.0))
               for n in ("tp", "pred", "true")}
        sums = counts.groupBy(*keys).agg(*[c.alias(n) for n, c in own.items()])
        done = class_scores(F.col("tp"), F.col("pred"), F.col("true"), zero_division)
        return sums.select(*keys, *[done[n].alias(n) for n in names])
    if average == "macro":
        return scored.groupBy(*keys).agg(*[F.avg(n).alias(n) for n in names])
    if average == "micro":
        sums = scored.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in ("tp", "pred", "true")])
        done = class_scores(F.col("tp"), F.col("pred"), F.col("true"), zero_division)
        return sums.select(*keys, *[done[n].alias(n) for n in names])
    if average == "weighted":
        return scored.groupBy(*keys).agg(*[
            ratio(F.sum(F.col(n) * F.col("true")), F.sum("true"), zero_division).alias(n) for n in names])
    raise ValueError(f"unknown average {average!r}")


def _per_sample(df: DataFrame, keys: list[str], weight: str | None, zero_division: float) -> DataFrame:
    """Scores of each multilabel row on its own, then averaged."""
    def ones(column):
        return F.size(F.filter(column, lambda x: x == 1)).cast("double")

    both = F.size(F.filter(F.arrays_zip("prediction", "reference"),
                           lambda z: (z["prediction"] == 1) & (z["reference"] == 1))).cast("double")
    scores = class_scores(both, ones("prediction"), ones("reference"), zero_division)
    w = weight_column(weight)
    return df.groupBy(*keys).agg(*[ratio(F.sum(w * s), F.sum(w), None).alias(n) for n, s in scores.items()])


def _factory(name: str):
    @register(name)
    def build(average="binary", pos_label=1, labels=None, weight=None, zero_division=0.0, multilabel=False) -> Metric:
        def compute(df, keys):
            scores = precision_recall_f1(df, average, pos_label, labels, weight, zero_division, multilabel, keys)
            return scores.select(*keys, *(["label"] if average is None else []), name)

        return Metric(name, compute=compute)

    return build


precision, recall, f1 = _factory("precision"), _factory("recall"), _factory("f1")


def matthews(df: DataFrame, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Matthews correlation of any number of classes; 0 when a side is constant."""
    keys = list(keys)
    p, t = F.col("pred"), F.col("true")
    sums = class_counts(df, keys, weight).groupBy(*keys).agg(
        F.sum("tp").alias("c"), F.sum("true").alias("s"), F.sum(p * t).alias("pt"),
        F.sum(p * p).alias("pp"), F.sum(t * t).alias("tt"))
    c, s, pt, pp, tt = (F.col(x) for x in ("c", "s", "pt", "pp", "tt"))
    return sums.select(*keys, ratio(c * s - pt, F.sqrt((s * s - pp) * (s * s - tt))).alias("matthews_correlation"))


def matthews_multilabel(df: DataFrame, average: str | None = None, weight: str | None = None) -> DataFrame:
    """Matthews correlation per column of 0/1 arrays (`slot`), or their mean (average='macro')."""
    w = weight_column(weight).alias("w")
    slots = df.select(w, F.posexplode(F.arrays_zip("prediction", "reference")).alias("slot", "z")).select(
        "w", "slot", F.col("z.prediction").alias("prediction"), F.col("z.reference").alias("reference"))
    per = matthews(slots, ["slot"], "w")
    return per.agg(F.avg("matthews_correlation").alias("matthews_correlation")) if average == "macro" else per


@register("matthews_correlation")
def matthews_correlation(weight: str | None = None) -> Metric:
    return Metric("matthews_correlation", compute=lambda df, keys: matthews(df, keys, weight))


# --- segmentation ----------------------------------------------------------------------------

def segmentation_counts(df: DataFrame, num_labels: int, ignore_index: int | None, label_map: dict | None = None,
                        reduce_labels: bool = False) -> DataFrame:
    """Per category 0 … num_labels-1: intersect, pred, label and union pixel counts over ARRAY<ARRAY<INT>> maps."""
    pixels = df.select(F.explode(F.arrays_zip(F.flatten("prediction").alias("p"), F.flatten("reference").alias("l"))))
    pixels = pixels.select(F.col("col.p").alias("p"), F.col("col.l").alias("l"))
    if label_map:
        # as successive assignments: an earlier replacement may be replaced again
        label = F.col("l")
        for old, new in label_map.items():
            label = F.when(label == old, F.lit(new)).otherwise(label)
        pixels = pixels.withColumn("l", label)
    if reduce_labels:
        pixels = pixels.withColumn("l", F.when(F.col("l").isin(0, 255), 255).otherwise(F.col("l") - 1))
    if ignore_index is not None:
        pixels = pixels.filter(F.col("l") != ignore_index)
    pairs = pixels.groupBy("p", "l").agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    same = F.when(F.col("p") == F.col("l"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("l").alias("category"), same.alias("i"), zero.alias("p"), F.col("n").alias("l")),
        F.struct(F.col("p").alias("category"), zero.alias("i"), F.col("n").alias("p"), zero.alias("l")))
    per = pairs.select(F.inline(sides)).filter(F.col("category").between(0, num_labels - 1)).groupBy("category").agg(
        F.sum("i").alias("intersect"), F.sum("p").alias("pred"), F.sum("l").alias("label"))
    every = df.sparkSession.range(num_labels).select(F.col("id").cast("int").alias("category"))
    return every.join(per, "category", "left").na.fill(0, ["intersect", "pred", "label"]).withColumn(
        "union", F.col("pred") + F.col("label") - F.col("intersect"))


def mean_iou(df: DataFrame, num_labels: int, ignore_index: int | None, nan_to_num: float | None = None,
             label_map: dict | None = None, reduce_labels: bool = False) -> DataFrame:
    """mean_iou, mean_accuracy, overall_accuracy and the two per-category arrays (null: category absent)."""
    per = segmentation_counts(df, num_labels, ignore_index, label_map, reduce_labels).withColumns({
        "iou": ratio(F.col("intersect"), F.col("union"), None),
        "acc": ratio(F.col("intersect"), F.col("label"), None)})
    rows = F.array_sort(F.collect_list(F.struct("category", "iou", "acc")))  # num_labels entries
    out = per.agg(
        F.avg("iou").alias("mean_iou"), F.avg("acc").alias("mean_accuracy"),
        ratio(F.sum("intersect"), F.sum("label"), None).alias("overall_accuracy"),
        F.transform(rows, lambda r: r["iou"]).alias("per_category_iou"),
        F.transform(rows, lambda r: r["acc"]).alias("per_category_accuracy"))
    if nan_to_num is None:
        return out
    fill = F.lit(float(nan_to_num))
    return out.select(*[
        F.transform(c, lambda x: F.coalesce(x, fill)).alias(c) if c.startswith("per_") else F.coalesce(c, fill).alias(c)
        for c in out.columns])
