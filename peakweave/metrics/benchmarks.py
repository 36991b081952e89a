"""Benchmark suites: which metrics a named task is scored with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakweave.metrics import qa, textgen
from peakweave.metrics.classification import accuracy, matthews_correlation, precision_recall_f1
from peakweave.metrics.core import evaluate
from peakweave.metrics.ranking import precision_at_k
from peakweave.metrics.regression import pearsonr, spearmanr

# The task names of each suite.
GLUE_ACCURACY = ("sst2", "mnli", "mnli_mismatched", "mnli_matched", "qnli", "rte", "wnli", "hans")
SUPER_GLUE_ACCURACY = ("copa", "rte", "wic", "wsc", "wsc.fixed", "boolq", "axg")
INDIC_ACCURACY = ("wnli", "copa", "sna", "csqa", "wstp", "inltkh", "bbca", "iitp-mr", "iitp-pr", "actsa-sc", "md")


def _accuracy(df: DataFrame) -> DataFrame:
    return evaluate(df, [accuracy()])


def _f1(df: DataFrame, average: str = "binary") -> DataFrame:
    return precision_recall_f1(df, average).select("f1")


def _both(df: DataFrame, average: str = "binary") -> DataFrame:
    return _accuracy(df).join(F.broadcast(_f1(df, average)))  # one row each


def glue(df: DataFrame, task: str) -> DataFrame:
    if task == "cola":
        return evaluate(df, [matthews_correlation()])
    if task == "stsb":
        return evaluate(df, [pearsonr(p_value=False), spearmanr(p_value=False)]).select(
            F.col("pearsonr").alias("pearson"), "spearmanr")
    if task in ("mrpc", "qqp"):
        return _both(df)
    if task in GLUE_ACCURACY:
        return _accuracy(df)
    raise KeyError(f"unknown task {task!r}")


def super_glue(df: DataFrame, task: str, references: DataFrame | None = None) -> DataFrame:
    """For `record`, df holds the predictions and `references` the questions."""
    if task == "axb":
        return evaluate(df, [matthews_correlation()])
    if task == "cb":
        return _both(df, "macro")
    if task == "record":
        return qa.record(df, references)
    if task == "multirc":
        return qa.multirc(df)
    if task in SUPER_GLUE_ACCURACY:
        return _accuracy(df)
    raise KeyError(f"unknown task {task!r}")


def xnli(df: DataFrame) -> DataFrame:
    return _accuracy(df)


def indic_glue(df: DataFrame, task: str, right: DataFrame | None = None) -> DataFrame:
    """For `cvit-mkb-clsr`, df and `right` hold the vectors of the two languages."""
    if task == "cvit-mkb-clsr":
        return precision_at_k(df, right)
    if task == "wiki-ner":
        return _both(df)
    if task in INDIC_ACCURACY:
        return _accuracy(df)
    raise KeyError(f"unknown task {task!r}")


def xtreme_s(df: DataFrame, task: str, key: str | None = None) -> DataFrame:
    if task == "fleurs-lang_id":
        return _accuracy(df)
    if task == "minds14":
        return _f1(df, "macro").join(F.broadcast(_accuracy(df)))
    if task == "covost2":
        return textgen.sacrebleu(df, key).select(F.col("score").alias("bleu"))
    if task in ("mls", "fleurs-asr", "voxpopuli", "babel"):
        return evaluate(df, [textgen.wer(), textgen.cer()])
    raise KeyError(f"unknown task {task!r}")
