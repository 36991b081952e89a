"""Quality rules with risk-controlled thresholds.

Every text gets a few rule values. Labelled good documents set the cutoffs: for each stratum (a band of text lengths)
and rule, a grid of cutoffs is walked from the mildest on; a cutoff is admissible while the exact binomial
(Clopper-Pearson) upper bound on its false rejection rate stays within LIMIT. All tests together hold with probability
1 - DELTA: each rule and stratum may err with DELTA / (rules x strata) (Bonferroni), and a walk that stops at its first
failure (fixed-sequence testing) needs no further correction inside. The strictest admissible cutoff is used; a stratum
without enough labels to prove any cutoff rejects nothing by that rule. The risk of all rules together is LIMIT at most
since each rule gets LIMIT / rules.

A trial is a distinct text: rows that repeat an id, a label or a text prove nothing more. The labelled rows meet the values
in one join, and what reaches the driver is a count per stratum, rule and grid step: a table of fixed size.

Defined cases: a null text has no words and fails the base rule; `kept` is never null; an id that stands with several texts
is one trial, of the text with the least hash; an id or text with labels that contradict each other is none, and null labels
do not count; texts whose 64-bit hashes agree count as one; repeated document rows give repeated results; other columns are
ignored by `apply`.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakweave.llm.common import map_texts, space_words, utf8, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
LIMIT = 0.02
DELTA = 0.05
#: Lower ends of the length bands, in words.
STRATA = (0, 100, 400, 1600)
SYMBOLS = b"#*$%&|<>"
#: Rule: the values to cut above, from mild to strict.
GRID = {
    "symbol_ratio": tuple(round(0.6 - 0.02 * i, 2) for i in range(30)),
    "dup_line_ratio": tuple(round(1 - 0.04 * i, 2) for i in range(25)),
    "repeat_ratio": tuple(round(0.5 - 0.02 * i, 2) for i in range(25)),
    "long_word_ratio": tuple(round(0.6 - 0.02 * i, 2) for i in range(30)),
    "upper_ratio": tuple(round(1 - 0.04 * i, 2) for i in range(25)),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_long_words", "n_upper")
NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)
NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)


def code_points(data: bytes) -> int:
    """Characters of UTF-8 bytes: all bytes but continuations."""
    return len(data) - len(data.translate(None, bytes(range(0x00, 0x80)) + bytes(range(0xC0, 0x100))))


def counts(text: bytes) -> tuple[int, ...]:
    """The values of COUNTS for one whole text."""
    words = space_words(text)
    n = len(words)
    lines = [line for line in text.split(b"\n") if line.split()]
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated, end = 0, 0
    if len(windows) < n - 2:
        for at, window in enumerate(zip(words, words[1:], words[2:])):
            if windows[window] > 1:
                repeated += at + 3 - max(at, end)
                end = at + 3
    return (n, code_points(b"".join(words)), len(text.translate(None, NOT_SYMBOLS)), len(lines) - len(set(lines)), repeated,
            len(lines), sum(len(w) > 15 for w in words), len(text.translate(None, NOT_UPPER)))


def measure(docs: DataFrame) -> DataFrame:
    """`doc_id`, the counts of every document and `twin`, a hash of its text."""

    def run(batch: pa.RecordBatch) -> dict:
        texts = utf8(batch.column("text"))
        values = np.array([counts(t) for t in texts], dtype=np.int64).reshape(-1, len(COUNTS))
        twins = np.array([xxhash.xxh64_intdigest(t) for t in texts], dtype=np.uint64).view(np.int64)
        return {"doc_id": batch.column("doc_id"), "twin": pa.array(twins)} | {
            c: pa.array(values[:, i]) for i, c in enumerate(COUNTS)}

    return map_texts(docs, ["doc_id", "text"], f"doc_id {dict(docs.dtypes)['doc_id']}, twin bigint, " + ", ".join(
        f"{c} bigint" for c in COUNTS), run)


def rules() -> dict[str, Column]:
    """Rule values from the counts; 0 where there is nothing to measure."""
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return {"symbol_ratio": ratio("n_symbols", "word_chars"), "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
            "repeat_ratio": ratio("n_repeat_words", "n_words"), "long_word_ratio": ratio("n_long_words", "n_words"),
            "upper_ratio": ratio("n_upper", "word_chars")}


def stratum() -> Column:
    """The number of the length band, from 0."""
    return sum((F.col("n_words") >= low).cast("int") for low in STRATA[1:])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial(n, p), summed from the place of k outwards by the ratio of neighbouring terms."""
    if k >= n:
        return 1.0
    lower = k < n * p
    at = k if lower else k + 1
    term = math.exp(math.lgamma(n + 1) - math.lgamma(at + 1) - math.lgamma(n - at + 1) + at * math.log(p) + (n - at) * math.log1p(-p))
    total, odds = 0.0, p / (1 - p)
    # terms fall from the place of k on, away from the mean
    while 0 <= at <= n and term > 1e-18 * total:
        total += term
        term *= at / ((n - at + 1) * odds) if lower else (n - at) / (at + 1) * odds
        at += -1 if lower else 1
    return min(1.0, total if lower else max(0.0, 1 - total))


def within_risk(rejected: int, n: int, limit: float, error: float) -> bool:
    """The exact upper bound on the rate is at most `limit`: seeing so few rejections has probability `error` at most there."""
    return n > 0 and binomial_tail(rejected, n, limit) <= error


def thresholds(measured: DataFrame, labels: DataFrame, limit: float = LIMIT, delta: float = DELTA) -> dict:
    """(stratum, rule): the strictest cutoff whose false rejections are proven to be within the risk."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("least"), F.max("quality").alias("most"))
    one_text = measured.join(known, "doc_id").groupBy("doc_id").agg(
        F.min(F.struct("twin", *COUNTS)).alias("text"), F.first("least").alias("least"), F.first("most").alias("most"))
    trials = one_text.groupBy("text").agg(F.min("least").alias("least"), F.max("most").alias("most")).filter("least = 1")
    held = trials.select("text.*").filter(~base_failed()).select(stratum().alias("stratum"), *[
        v.alias(n) for n, v in rules().items()])
    counted = held.groupBy("stratum").agg(F.count("*").alias("n"), *[
        F.sum((F.col(rule) > cut).cast("long")).alias(f"{rule}_{i}") for rule, cuts in GRID.items()
        for i, cut in enumerate(cuts)]).collect()
    chosen = {}
    for row in counted:
        for rule, cuts in GRID.items():
            for i, cut in enumerate(cuts):
                if not within_risk(row[f"{rule}_{i}"], row["n"], limit / len(GRID), delta / (len(GRID) * len(STRATA))):
                    break
                chosen[row["stratum"], rule] = cut
    return chosen


def apply(measured: DataFrame, chosen: dict) -> DataFrame:
    """The counts with `base_failed`, `stratum`, `kept` and the `failed_rules`."""
    values = rules()
    fails = [F.when(sum(((stratum() == s) & (values[rule] > cut)).cast("int") for (s, r), cut in chosen.items() if r == rule) > 0,
                    F.lit(rule)) for rule in GRID if any(r == rule for _, r in chosen)]
    failed = F.array_compact(F.array(*fails)) if fails else F.array().cast("array<string>")
    return measured.select(
        "doc_id", *COUNTS[:5], base_failed().alias("base_failed"), stratum().alias("stratum"),
        F.array_join(failed, ",").alias("failed_rules"), (~base_failed() & (F.size(failed) == 0)).alias("kept"))


def judge(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, delta: float = DELTA) -> DataFrame:
    """Measure all documents once, choose the cutoffs from the labelled ones and apply them."""
    measured = written(measure(docs), "quality-counts")
    return apply(measured, thresholds(measured, labels, limit, delta))
