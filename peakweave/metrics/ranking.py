"""ROC AUC, retrieval evaluation, in-batch contrastive scores and pass@k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakweave.functions.arrays import let, pool
from peakweave.functions.numeric import ratio
from peakweave.metrics.core import Metric, register, weight_column
from peakweave.operators.joins import batch_similarities, centered, join_groups
from peakweave.operators.neighbours import STRIPE, nearest
from peakweave.operators.ordering import ordered_scan

# --- ROC AUC ---------------------------------------------------------------------------------


def auc(df: DataFrame, keys: Sequence[str] = (), max_fpr: float | None = None) -> DataFrame:
    """Area under the ROC curve from rows (score, positive, w), per group.

    Rows are collapsed to one per distinct score, then swept from the highest score
    down with distributed running sums; tied scores form one step of the curve.
    """
    keys = list(keys)
    positive = F.sum(F.when(F.col("positive"), F.col("w")).otherwise(0.0))
    negative = F.sum(F.when(F.col("positive"), 0.0).otherwise(F.col("w")))
    steps = df.groupBy(*keys, "score").agg(positive.alias("dp"), negative.alias("dn"))
    swept = ordered_scan(steps, [F.col("score").desc()], keys, sums={"cp": "dp", "cn": "dn"})
    if max_fpr is None or max_fpr == 1:
        area = F.sum(F.col("dn") * (F.col("cp") - F.col("dp") / 2))
        return swept.groupBy(*keys).agg(ratio(area, F.sum("dp") * F.sum("dn"), None).alias("roc_auc"))
    totals = swept.groupBy(*keys).agg(F.sum("dp").alias("np"), F.sum("dn").alias("nn"))
    swept = join_groups(swept, totals, keys)
    # the step runs from (x0, y0) to (x1, y1); only its part left of max_fpr counts
    x0 = ratio(F.col("cn") - F.col("dn"), F.col("nn"), None)
    x1 = ratio(F.col("cn"), F.col("nn"), None)
    y0 = ratio(F.col("cp") - F.col("dp"), F.col("np"), None)
    slope = ratio(ratio(F.col("dp"), F.col("np"), None), ratio(F.col("dn"), F.col("nn"), None))
    right = F.least(x1, F.lit(float(max_fpr)))
    width = F.greatest(right - x0, F.lit(0.0))
    # null where a class is absent
    partial = F.sum(F.when((F.col("np") > 0) & (F.col("nn") > 0), width * (y0 + slope * width / 2)))
    lowest = max_fpr * max_fpr / 2
    return swept.groupBy(*keys).agg((0.5 * (1 + (partial - lowest) / (max_fpr - lowest))).alias("roc_auc"))


def roc_auc(df: DataFrame, mode: str = "binary", average: str | None = "macro", multi_class: str = "ovr",
            max_fpr: float | None = None, weight: str | None = None, pos_label=1) -> DataFrame:
    """Binary, multiclass (ovr / ovo over probability arrays) or multilabel (0/1 arrays) ROC AUC.

    average: macro, weighted, micro (multilabel) or None (one row per class).
    """
    w = weight_column(weight).alias("w")
    if mode == "binary":
        rows = df.select(F.col("prediction").cast("double").alias("score"),
                         (F.col("reference") == F.lit(pos_label)).alias("positive"), w)
        return auc(rows, max_fpr=max_fpr)
    if mode == "multilabel":
        rows = df.select(w, F.posexplode(F.arrays_zip("prediction", "reference")).alias("label", "z")).select(
            "label", F.col("z.prediction").cast("double").alias("score"),
            (F.col("z.reference") == 1).alias("positive"), "w")
    elif mode == "multiclass":
        rows = df.select("reference", w, F.posexplode("prediction").alias("label", "score")).select(
            "label", F.col("score").cast("double").alias("score"),
            (F.col("reference") == F.col("label")).alias("positive"), "w")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "multiclass" and multi_class == "ovo":
        return _one_vs_one(df, average)
    if average == "micro":
        return auc(rows.drop("label"), max_fpr=max_fpr)
    per = auc(rows, ["label"], max_fpr)
    if average is None:
        return per
    if average == "macro":
        return per.agg(F.avg("roc_auc").alias("roc_auc"))
    support = rows.groupBy("label").agg(F.sum(F.when(F.col("positive"), F.col("w")).otherwise(0.0)).alias("s"))
    return per.join(support, "label").agg(
        ratio(F.sum(F.col("roc_auc") * F.col("s")), F.sum("s"), None).alias("roc_auc"))


def _one_vs_one(df: DataFrame, average: str | None) -> DataFrame:
    """Mean over unordered class pairs of the two directed AUCs, optionally weighted by pair prevalence."""
    own = df.select("reference", "prediction", F.posexplode("prediction").alias("other", "other_score"))
    own = own.filter(F.col("other") != F.col("reference"))
    mine = F.element_at("prediction", F.col("reference") + 1).cast("double")
    lo, hi = F.least("reference", "other"), F.greatest("reference", "other")
    # each row serves both directed AUCs of a pair: as positive with its own score, as negative with the other's
    sides = F.array(
        F.struct(F.col("reference").alias("target"), mine.alias("score"), F.lit(True).alias("positive")),
        F.struct(F.col("other").alias("target"), F.col("other_score").cast("double").alias("score"),
                 F.lit(False).alias("positive")))
    rows = own.select(lo.alias("lo"), hi.alias("hi"), F.inline(sides)).withColumn("w", F.lit(1.0))
    directed = auc(rows, ["lo", "hi", "target"])
    pairs = directed.groupBy("lo", "hi").agg(F.avg("roc_auc").alias("a"))
    if average != "weighted":
        return pairs.agg(F.avg("a").alias("roc_auc"))
    counts = rows.filter("positive").groupBy("lo", "hi").agg(F.count(F.lit(1)).alias("n"))
    return pairs.join(counts, ["lo", "hi"]).agg(
        ratio(F.sum(F.col("a") * F.col("n")), F.sum("n"), None).alias("roc_auc"))


@register("roc_auc")
def roc_auc_metric(**options) -> Metric:
    def compute(df, keys):
        if not keys:
            return roc_auc(df, **options)
        rows = df.select(*keys, F.col("prediction").cast("double").alias("score"),
                         (F.col("reference") == F.lit(options.get("pos_label", 1))).alias("positive"),
                         weight_column(options.get("weight")).alias("w"))
        return auc(rows, keys, options.get("max_fpr"))

    return Metric("roc_auc", compute=compute)


# --- retrieval -------------------------------------------------------------------------------

# The cut-offs of the report.
CUTOFFS = (5, 10, 15, 20, 30, 100, 200, 500, 1000)


def ranked_run(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """The run with judged relevance, rank from 1, and running counts of relevant and judged non-relevant rows.

    Ranking is by score, ties by docid, both descending. A query of any length is
    ranked by a range sort over the whole cluster.
    """
    judged = qrels.select("query", "docid", F.col("rel").alias("__rel"))
    joined = run.select("query", "docid", F.col("score").cast("double").alias("score")).join(
        judged, ["query", "docid"], "left").select(
        "query", "docid", "score", F.coalesce("__rel", F.lit(0)).alias("rel"),
        F.col("__rel").isNotNull().alias("judged"))
    hit = (F.col("rel") > 0).cast("long")
    miss = (F.col("judged") & (F.col("rel") <= 0)).cast("long")
    scanned = ordered_scan(joined, [F.col("score").desc(), F.col("docid").desc()], ["query"], "__i",
                           {"hits": hit, "misses": miss}, once=True)
    return scanned.withColumn("rank", F.col("__i") + 1).drop("__i")


def _ideal_dcg(qrels: DataFrame) -> DataFrame:
    ranked = ordered_scan(qrels.filter("rel > 0").select("query", "docid", "rel"),
                          [F.col("rel").desc(), "docid"], ["query"], "__i")
    gain = F.col("rel") / F.log2(F.col("__i") + 2)
    return ranked.groupBy("query").agg(
        *[F.sum(F.when(F.col("__i") < k, gain)).alias(f"ideal_{k}") for k in CUTOFFS])


def trec_per_query(run: DataFrame, qrels: DataFrame, map_depth: int = 10_000, rank_depth: int = 1_000) -> DataFrame:
    """All measures per query of the run that has judgements."""
    ranked = ranked_run(run, qrels)
    needs = qrels.groupBy("query").agg(F.count_if(F.col("rel") > 0).alias("n_rel"),
                                       F.count_if(F.col("rel") <= 0).alias("n_nonrel"))
    rows = ranked.join(needs, "query")
    rank, hits, relevant = F.col("rank"), F.col("hits"), F.col("rel") > 0
    R, N = F.col("n_rel"), F.col("n_nonrel")
    bound = F.least(R, N)
    above = F.least(F.col("misses"), R)
    bpref = F.when(bound > 0, 1 - above / bound).otherwise(1.0)
    gain = F.col("rel") / F.log2(rank + 1)
    per = rows.groupBy("query").agg(
        F.count(F.lit(1)).alias("num_ret"), F.first("n_rel").alias("num_rel"),
        F.count_if(relevant).alias("num_rel_ret"),
        F.sum(F.when(relevant & (rank <= map_depth), hits / rank)).alias("__ap"),
        F.sum(F.when(relevant & (rank <= rank_depth), bpref)).alias("__bpref"),
        F.count_if(relevant & (rank <= R) & (rank <= rank_depth)).alias("__rp"),
        F.min(F.when(relevant & (rank <= rank_depth), rank)).alias("__first"),
        *[F.count_if(relevant & (rank <= k)).alias(f"__p{k}") for k in CUTOFFS],
        *[F.sum(F.when(rank <= k, gain)).alias(f"__d{k}") for k in CUTOFFS],
    ).join(_ideal_dcg(qrels), "query", "left")
    zero = F.lit(0.0)
    n = F.col("num_rel")
    return per.select(
        "query", "num_ret", "num_rel", "num_rel_ret",
        ratio(F.coalesce("__ap", zero), n).alias("map"),
        ratio(F.coalesce("__bpref", zero), n).alias("bpref"),
        ratio(F.col("__rp"), n).alias("Rprec"),
        F.coalesce(1 / F.col("__first"), zero).alias("recip_rank"),
        *[(F.col(f"__p{k}") / k).alias(f"P@{k}") for k in CUTOFFS],
        *[F.coalesce(F.coalesce(f"__d{k}", zero) / F.col(f"ideal_{k}"), zero).alias(f"NDCG@{k}") for k in CUTOFFS])


def trec_eval(run: DataFrame, qrels: DataFrame, map_depth: int = 10_000, rank_depth: int = 1_000,
              by: Sequence[str] = ()) -> DataFrame:
    """The report row: counts, then measures averaged over queries.

    By the report's definition, ranks beyond `map_depth` do not count for map, nor those beyond `rank_depth` for bpref,
    Rprec and recip_rank; the defaults are the usual ones. `by` names columns of the run, one value per query.
    """
    per = trec_per_query(run, qrels, map_depth, rank_depth)
    if by:
        per = per.join(run.select(*by, "query").distinct(), "query")
    averaged = ["bpref", "Rprec", "recip_rank", *[f"P@{k}" for k in CUTOFFS], *[f"NDCG@{k}" for k in CUTOFFS]]
    return per.groupBy(*by).agg(
        F.sum("num_ret").alias("num_ret"), F.sum("num_rel").alias("num_rel"),
        F.sum("num_rel_ret").alias("num_rel_ret"), F.count(F.lit(1)).alias("num_q"),
        F.avg("map").alias("map"),
        F.exp(F.avg(F.log(F.greatest("map", F.lit(1e-5))))).alias("gm_map"),
        *[F.avg(f"`{c}`").alias(c) for c in averaged])


# --- contrastive -----------------------------------------------------------------------------

def with_batch(df: DataFrame, size: int, index: str) -> DataFrame:
    """Batches of `size` consecutive rows of a contiguous 0-based index; `idx` is the place inside."""
    return df.withColumns({"batch": F.floor(F.col(index) / size), "idx": F.pmod(F.col(index), F.lit(size))})


def _first_argmax(sims: Column) -> Column:
    return F.array_position(sims, F.array_max(sims)) - 1


def retrieval_accuracy(left: DataFrame, right: DataFrame, batch: str = "batch") -> DataFrame:
    """Share of rows whose best match in the batch is their own partner, in both directions."""
    def one(a, b, name):
        rows = batch_similarities(a, b, batch)
        best = F.element_at("others", (_first_argmax(F.col("sims")) + 1).cast("int"))
        return rows.agg(F.avg((best == F.col("idx")).cast("double")).alias(name))

    return one(left, right, "seq_acc").join(F.broadcast(one(right, left, "scrna_acc")))


def token_maximum(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """One vector per row from its token vectors: the largest value of each dimension."""
    return df.withColumn(vector, pool(vector, "max")[0])


def clip_loss(left: DataFrame, right: DataFrame, temperature: float = 0.0, batch: str = "batch",
              tokens: bool = False) -> DataFrame:
    """Symmetric contrastive loss per batch: mean -log softmax of the own pair, over rows and columns.

    With `tokens` an embedding is an array of token vectors, of which the maximum is compared.
    """
    if tokens:
        left, right = token_maximum(left), token_maximum(right)

    def one(a, b, name):
        rows = batch_similarities(a, b, batch).withColumn(
            "sims", F.transform("sims", lambda s: s * F.exp(F.lit(float(temperature)))))
        lse = let(F.array_max("sims"), lambda top: top + F.log(
            F.aggregate("sims", F.lit(0.0), lambda acc, s: acc + F.exp(s - top))))
        own = F.element_at("sims", F.array_position("others", F.col("idx")).cast("int"))
        return rows.groupBy(batch).agg(F.avg(lse - own).alias(name))

    return one(left, right, "__l").join(one(right, left, "__r"), batch).select(
        batch, ((F.col("__l") + F.col("__r")) / 2).alias("clip_loss"))


def combined_loss(pairs: DataFrame, left: DataFrame, right: DataFrame, alpha: float, beta: float,
                  temperature: float = 0.0, batch: str = "batch", tokens: bool = False) -> DataFrame:
    """alpha·mse + beta·contrastive loss per batch; `pairs` has batch, prediction, reference."""
    d = F.col("prediction").cast("double") - F.col("reference").cast("double")
    errors = pairs.groupBy(batch).agg(F.avg(d * d).alias("mse"))
    return errors.join(clip_loss(left, right, temperature, batch, tokens), batch).select(
        batch, (alpha * F.col("mse") + beta * F.col("clip_loss")).alias("loss"))


# --- cross-lingual retrieval -----------------------------------------------------------------

def precision_at_k(left: DataFrame, right: DataFrame, id_column: str = "id", vector: str = "embedding", k: int = 10,
                   stripe: int = STRIPE) -> DataFrame:
    """Share of left rows whose own partner is among their k nearest right rows by centred cosine distance.

    Rows without a partner do not count. Equal distances order by id.
    """
    a, b = (centered(df.select(F.col(id_column).alias("id"), F.col(vector).alias("embedding"))) for df in (left, right))
    found = nearest(a, b, k, stripe=stripe).join(right.select(F.col(id_column).alias("id")), "id", "left_semi")
    hit = F.exists("near", lambda n: n["id"] == F.col("id"))
    return found.agg(F.avg(hit.cast("double")).alias(f"precision@{k}"))


# --- functional correctness ------------------------------------------------------------------

def pass_at_k(df: DataFrame, task: str = "task_id", passed: str = "passed", ks: Sequence[int] = (1, 10, 100)) -> DataFrame:
    """Mean unbiased pass@k over tasks: 1 - C(n-c, k) / C(n, k); null where a task has fewer than k samples."""
    per = df.groupBy(task).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(passed)).alias("c"))
    n, c = F.col("n"), F.col("c")

    def estimate(k):
        factors = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: (n - c - j) / (n - j))
        missed = F.aggregate(factors, F.lit(1.0), lambda acc, x: acc * x)
        return F.when(n - c < k, 1.0).otherwise(1 - missed)

    return per.agg(*[F.when(F.min("n") >= k, F.avg(estimate(k))).alias(f"pass@{k}") for k in ks])
