"""Question answering: squad, squad_v2, record, cuad and multi-sentence reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakweave.functions import text as tx
from peakweave.functions.ngrams import shared_grams
from peakweave.functions.numeric import ratio
from peakweave.metrics.textgen import dealt, size_of
from peakweave.operators.joins import join_groups, last_per_key, unique_by
from peakweave.operators.ordering import ordered_scan
from peakweave.session import materialize, store


def answer_scores(df: DataFrame, key: str, f1_if_empty: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """Per row the key, the columns to `carry`, `exact` and `f1`, the best over its gold answers.

    `df` has prediction STRING and answers ARRAY<STRING>. Token overlap is a multiset
    intersection. With `f1_if_empty` two empty token lists agree (F1 1); otherwise no
    overlap is F1 0. Rows are questions of their own, also where ids repeat.
    """
    keep = list(dict.fromkeys([key, *carry]))
    exact = F.exists("answers", lambda a: tx.normalize_answer(a) == tx.normalize_answer(F.col("prediction")))

    def tokens(c):
        return tx.words(tx.normalize_answer(c))

    known = df.select(*keep, "prediction", "answers").filter("answers is not null")
    tokenized = dealt(known).select(
        *keep, exact.cast("double").alias("exact"), tokens(F.col("prediction")).alias("hyp"), F.transform("answers", tokens).alias("refs"))
    counted = tokenized.select(*keep, "exact", size_of(F.col("hyp")).alias("h"), F.transform("refs", size_of).alias("sizes"),
                               shared_grams(F.col("hyp"), F.col("refs"), 1).alias("shared"))

    def f1(m, k):
        h, r, same = F.col("h"), F.get("sizes", k), m[0]
        p, q = ratio(same, h), ratio(same, r)
        value = ratio(2 * p * q, p + q)
        if f1_if_empty:
            value = F.when((h == 0) | (r == 0), ((h == 0) & (r == 0)).cast("double")).otherwise(value)
        return F.coalesce(value, F.lit(0.0))

    return counted.select(*keep, F.coalesce("exact", F.lit(0.0)).alias("exact"),
                          F.coalesce(F.array_max(F.transform("shared.each", f1)), F.lit(0.0)).alias("f1"))


def one_answer_each(predictions: DataFrame, key: str, last_by: str | None = None) -> DataFrame:
    """One prediction per question: the last by `last_by`, or the only one; without an order two of them fail the job."""
    if last_by is not None:
        return last_per_key(predictions, key, last_by)
    return unique_by(predictions, [key], "a question has two predictions and no order is given")


def _means(predictions: DataFrame, references: DataFrame, key: str, scale: float, last_by: str | None,
           by: Sequence[str] = ()) -> DataFrame:
    """Means over all questions; those without a prediction score 0 and count, and so does each of several with one id."""
    questions = references.select(*dict.fromkeys([*by, key]), "answers")
    answered = questions.join(one_answer_each(predictions.select(*_needed(key, last_by), "prediction"), key, last_by), key)
    sums = answer_scores(answered, key, carry=by).groupBy(*by).agg(F.sum("exact").alias("__e"), F.sum("f1").alias("__f"))
    totals = references.groupBy(*by).agg(F.count(F.lit(1)).alias("__total"))
    return join_groups(totals, sums, by, "left").select(*by, *[
        ratio(scale * F.coalesce(c, F.lit(0.0)), F.col("__total"), None).alias(name)
        for c, name in (("__e", "exact_match"), ("__f", "f1"))])


def _needed(key: str, last_by: str | None) -> list[str]:
    return list(dict.fromkeys([key, *([last_by] if last_by else [])]))


def squad(predictions: DataFrame, references: DataFrame, key: str = "id", last_by: str | None = None,
          by: Sequence[str] = ()) -> DataFrame:
    """exact_match and f1 in percent over all questions; of several predictions the last by `last_by` counts.

    `by` names columns of the references to group by.
    """
    return _means(predictions, references, key, 100.0, last_by, by)


def record(predictions: DataFrame, references: DataFrame, key: str = "id", last_by: str | None = None,
           by: Sequence[str] = ()) -> DataFrame:
    """exact_match and f1 as fractions; of several predictions the last by `last_by` counts."""
    return _means(predictions, references, key, 1.0, last_by, by)


def _answerable_rows(predictions: DataFrame, references: DataFrame, key: str, extra: list[str]) -> DataFrame:
    """Per question: has_ans, na (no-answer probability), whether it has a text, exact, f1; null where unanswered."""
    usable = F.filter("answers", lambda a: tx.normalize_answer(a) != "")
    gold = references.select(
        key, (F.size("answers") > 0).alias("has_ans"),
        F.when(F.size(usable) > 0, usable).otherwise(F.array(F.lit(""))).alias("answers"))
    given = predictions.select(key, *extra, F.col("no_answer_probability").alias("na"), "prediction",
                               (F.length("prediction") > 0).alias("has_text"), F.lit(True).alias("__given"))
    joined = gold.join(given, key, "left")
    about = [*extra, "has_ans", "na", "has_text"]
    scored = answer_scores(joined.filter("__given"), key, f1_if_empty=True, carry=about)
    none = joined.filter("__given IS NULL").withColumns({c: F.lit(None).cast("double") for c in ("exact", "f1")})
    columns = [key, *about, "exact", "f1"]
    return scored.select(*columns).unionByName(none.select(*columns))


def squad_v2(predictions: DataFrame, references: DataFrame, key: str = "id", threshold: float = 1.0,
             order_by: str | None = None, last_by: str | None = None) -> DataFrame:
    """Scores with unanswerable questions, split by HasAns / NoAns, and the best thresholds.

    `predictions` has no_answer_probability. Questions without a prediction score 0.
    Equal probabilities are swept in the order of `order_by` (the key by default).
    """
    predictions = one_answer_each(predictions, key, last_by)
    rows = materialize(_answerable_rows(predictions, references, key, [order_by] if order_by and order_by != key else []))
    no_answer = (~F.col("has_ans")).cast("double")

    def after(c):
        picked = F.when(F.col("na") > threshold, no_answer).otherwise(F.col(c))
        return F.when(F.col("na").isNull(), 0.0).otherwise(picked)

    scored = rows.withColumns({"e": after("exact"), "f": after("f1")})

    def mean(c, cond=None):
        return (100 * F.avg(c if cond is None else F.when(cond, F.col(c))))

    has = F.col("has_ans")
    out = scored.agg(
        mean("e").alias("exact"), mean("f").alias("f1"), F.count(F.lit(1)).alias("total"),
        mean("e", has).alias("HasAns_exact"), mean("f", has).alias("HasAns_f1"), F.count_if(has).alias("HasAns_total"),
        mean("e", ~has).alias("NoAns_exact"), mean("f", ~has).alias("NoAns_f1"),
        F.count_if(~has).alias("NoAns_total"))
    for score, name in (("exact", "best_exact"), ("f1", "best_f1")):
        out = out.join(F.broadcast(_best_threshold(rows, score, name, [order_by or key])))  # one row
    return out


def _best_threshold(rows: DataFrame, score: str, name: str, tie: list[str]) -> DataFrame:
    """The first threshold on the no-answer probability with the highest running score."""
    step = F.when(F.col("has_ans"), F.col(score)).when(F.col("has_text"), -1.0).otherwise(0.0)
    known = rows.filter(F.col("na").isNotNull()).withColumn("d", step)
    swept = ordered_scan(known.select("na", *tie, "d"), ["na", *tie], index="i", sums={"run": "d"})
    best = swept.agg(F.max_by(F.struct("run", "na"), F.struct("run", -F.col("i"))).alias("b"),
                     F.count(F.lit(1)).alias("n"))
    start = rows.agg(F.count_if(~F.col("has_ans")).alias("start"))
    both = best.join(F.broadcast(start))
    better = F.coalesce(F.col("b.run") > 0, F.lit(False))
    return both.select(
        (100 * (F.col("start") + F.when(better, F.col("b.run")).otherwise(0.0)) / F.col("n")).alias(name),
        F.when(better, F.col("b.na")).otherwise(0.0).alias(f"{name}_thresh"))


def answer_precision_recall(predictions: DataFrame, references: DataFrame, key: str = "id") -> DataFrame:
    """Average precision (percent) when answers are given in the order of the no-answer probability.

    For the exact and the F1 score, and for an oracle that knows which questions have an
    answer. Equal probabilities are one step of the curve.
    """
    rows = _answerable_rows(predictions, references, key, [])
    total = rows.agg(F.count_if("has_ans").alias("n"))
    known = rows.filter(F.col("na").isNotNull()).select("na", key, *[
        F.when(F.col("has_ans"), score).otherwise(0.0).alias(f"own_{name}")
        for name, score in (("exact", F.col("exact")), ("f1", F.col("f1")), ("oracle", F.lit(1.0)))])
    names = ("exact", "f1", "oracle")
    swept = ordered_scan(known, ["na", key], index="i", sums={n: f"own_{n}" for n in names})
    steps = swept.groupBy("na").agg(
        (F.max("i") + 1).alias("seen"),
        *[F.max_by(n, "i").alias(n) for n in names],
        *[F.min_by(F.col(n) - F.col(f"own_{n}"), "i").alias(f"before_{n}") for n in names])
    return steps.join(F.broadcast(total)).agg(*[
        (100 * F.sum(F.col(n) / F.col("seen") * (F.col(n) - F.col(f"before_{n}")) / F.col("n"))).alias(f"pr_{n}_ap")
        for n in names])


# --- span lists ------------------------------------------------------------------------------

IOU_THRESHOLD = 0.5


def span_scores(df: DataFrame, key: str) -> DataFrame:
    """Per question precision and recall of predicted spans (arrays) against gold spans; null where undefined.

    Spans match at Jaccard 0.5, or by containment when the question is about parties.
    """
    by_substring = F.col(key).cast("string").contains("Parties")

    def match(p, g):
        return (tx.jaccard(p, g) >= IOU_THRESHOLD) | (by_substring & F.contains(p, g))

    preds, golds = F.col("prediction"), F.col("answers")
    tp = F.size(F.filter(golds, lambda g: F.exists(preds, lambda p: match(p, g))))
    fp = F.size(F.filter(preds, lambda p: ~F.exists(golds, lambda g: match(p, g))))
    fn = F.size(golds) - tp
    # the last compared pair counts when no pair is equal, so any equal pair decides
    hit = F.exists(preds, lambda p: F.exists(golds, lambda g: tx.normalize_answer(p) == tx.normalize_answer(g)))
    return df.select(key, ratio(tp.cast("double"), tp + fp, None).alias("precision"),
                     ratio(tp.cast("double"), tp + fn, None).alias("recall"), hit.cast("double").alias("exact"))


def cuad(predictions: DataFrame, references: DataFrame, key: str = "id", last_by: str | None = None) -> DataFrame:
    """exact_match, f1, aupr, precision at recall 0.8 and 0.9; of several predictions the last by `last_by` counts.

    A question without gold spans has no recall and makes the summed f1 (and the area,
    reported as 0) undefined.
    """
    answered = references.join(one_answer_each(predictions, key, last_by), key, "inner")
    # comparing spans is the work: the sums and both passes of the sort read the scores
    rows = store(span_scores(answered, key), "span-scores")
    total = references.agg(F.count(F.lit(1)).alias("total"))
    p, r = F.col("precision"), F.col("recall")
    f1 = F.when((p == 0) & (r == 0), 0.0).otherwise(2 * p * r / (p + r))
    f1 = F.when(p.isNull() | r.isNull(), F.lit(float("nan"))).otherwise(f1)
    sums = rows.select(f1.alias("f"), "exact", r.isNull().alias("gap"), p.isNull().alias("pgap")).agg(
        F.sum("f").alias("f"), F.sum("exact").alias("e"), F.max("gap").alias("gap"), F.max("pgap").alias("pgap"))
    # highest precision at this recall or beyond: a running maximum from the right
    points = rows.filter(r.isNotNull()).select("recall", "precision", key)
    best = ordered_scan(points, [F.col("recall").desc(), F.col("precision").desc(), key], index="i",
                        maxima={"best": F.coalesce("precision", F.lit(0.0))})
    tied = best.groupBy("recall").agg(F.max("i").alias("last"), F.max_by("best", "i").alias("low"),
                                      F.min_by("best", "i").alias("high"))
    nxt = ordered_scan(tied, [F.col("recall").desc()], index="j")
    shifted = nxt.select((F.col("j") + 1).alias("j"), F.col("recall").alias("r1"), F.col("low").alias("p1"))
    # between two recalls: from the last point of the lower one to the first of the higher one
    area = nxt.join(shifted, "j").agg(
        F.sum((F.col("r1") - F.col("recall")) * (F.col("p1") + F.col("high")) / 2).alias("area"))
    at = best.agg(*[
        F.coalesce(F.max_by("best", F.when(r >= level, F.col("i"))), F.lit(0.0)).alias(f"prec_at_{name}_recall")
        for level, name in ((0.8, "80"), (0.9, "90"))])
    joined = sums.join(F.broadcast(total)).join(F.broadcast(area)).join(F.broadcast(at))
    undefined = F.coalesce(F.col("gap") | F.col("pgap"), F.lit(False))
    return joined.select(
        (100 * F.coalesce("e", F.lit(0.0)) / F.col("total")).alias("exact_match"),
        (100 * F.coalesce("f", F.lit(0.0)) / F.col("total")).alias("f1"),
        F.when(undefined, 0.0).otherwise(F.coalesce("area", F.lit(0.0))).alias("aupr"),
        "prec_at_80_recall", "prec_at_90_recall")


def multirc(df: DataFrame, question: str = "question") -> DataFrame:
    """exact_match (questions with all answers right), f1_m (mean macro F1 per question), f1_a (over all answers)."""
    from peakweave.metrics.classification import precision_recall_f1

    per_question = precision_recall_f1(df, "macro", keys=[question]).agg(F.avg("f1").alias("f1_m"))
    right = df.groupBy(question).agg(F.min((F.col("prediction") == F.col("reference")).cast("double")).alias("ok"))
    overall = precision_recall_f1(df, "binary").select(F.col("f1").alias("f1_a"))
    return right.agg(F.avg("ok").alias("exact_match")).join(F.broadcast(per_question)).join(F.broadcast(overall))
