"""Numeric, classification, ranking and tagging metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from peakweave.metrics import benchmarks, evaluate, get
from peakweave.metrics import classification as c
from peakweave.metrics import ranking as rk
from peakweave.metrics import regression as rg
from peakweave.metrics import tagging
from peakweave.metrics.distances import aggregate_scores, coreference, covariance, mahalanobis
from peakweave.metrics.distribution import mauve
from peakweave.metrics.qa import multirc
from peakweave.metrics.reliability import offline_reliability, online_reliability
from peakweave.operators.neighbours import nearest
from peakweave.operators.quantiles import group_quantiles
from peakweave.plans.queries.registry import query, r
from peakweave.plans.queries.views import table, view
from peakweave.session import scratch_path
from peakweave.sources.datasets import append_metrics

EPS = "2.220446049250313e-16"


def rounded(df, digits=6, skip=()):
    return df.select(*[F.col(f"`{n}`") if n in skip or t not in ("double", "float") else r(F.col(f"`{n}`"), digits).alias(n)
                       for n, t in df.dtypes])


# --- regression ------------------------------------------------------------------------------

REG_SQL = f"""SELECT grp, round(avg(pow(prediction - reference, 2)), 6) + 0.0 AS mse, round(sqrt(avg(pow(prediction - reference, 2))), 6) + 0.0 AS rmse,
round(avg(abs(prediction - reference)), 6) + 0.0 AS mae, round(avg(2 * abs(prediction - reference) / (greatest(abs(reference), {EPS}) + greatest(abs(prediction), {EPS}))), 6) + 0.0 AS smape,
round(avg(pow(ln(1 + prediction) - ln(1 + reference), 2)), 6) + 0.0 AS msle,
round(0.0001 * avg(pow(prediction - reference, 2)) + 5 * avg(pow(ln(1 + prediction) - ln(1 + reference), 2)), 6) + 0.0 AS mse_msle,
round(2 * avg(abs(prediction - reference)) + 10 * avg(pow(ln(1 + prediction) - ln(1 + reference), 2)), 6) + 0.0 AS mae_msle,
round(corr(prediction, reference), 6) + 0.0 AS pearsonr,
round(1 - sum(pow(prediction - reference, 2)) / (var_pop(reference) * count(*)), 3) + 0.0 AS r_squared
FROM reg_pairs GROUP BY grp"""


@query(REG_SQL, ("reg_pairs",))
def regression_report(spark, sf):
    """Nine metrics per group, fused into one scan."""
    wanted = ["mse", "rmse", "mae", "smape", "msle", get("mse_msle", alpha=1e-4, beta=5), "mae_msle",
              get("pearsonr", p_value=False), "r_squared"]
    return rounded(evaluate(view(spark, sf, "reg_pairs"), wanted, ["grp"]))


@query(f"""SELECT round(sum(l_quantity * pow(l_discount - l_tax, 2)) / sum(l_quantity), 6) + 0.0 AS mse, round(sum(l_quantity * abs(l_discount - l_tax)) / sum(l_quantity), 6) + 0.0 AS mae,
round(sum(l_quantity * abs(l_extendedprice - l_extendedprice) / 1) / sum(l_quantity), 6) + 0.0 AS zero FROM lineitem""")
def weighted_errors(spark, sf):
    out = evaluate(view(spark, sf, "reg_pairs"), [get("mse", weight="weight"), get("mae", weight="weight")])
    same = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("prediction"), F.col("l_extendedprice").alias("reference"), "l_quantity")
    none = evaluate(same, [get("mae", weight="l_quantity")]).select(F.col("mae").alias("zero"))
    return rounded(out.join(F.broadcast(none)))  # one row each


@query(f"""SELECT round(avg(abs(value - (value * 0.9 + 1)) / greatest(abs(value * 0.9 + 1), {EPS})), 6) + 0.0 AS mape FROM events""")
def percentage_error(spark, sf):
    rows = table(spark, sf, "events").select(F.col("value").alias("prediction"), (F.col("value") * 0.9 + 1).alias("reference"))
    return rounded(evaluate(rows, ["mape"]))


@query("""SELECT round(avg(pow(cast(cast(l_discount AS FLOAT) AS DOUBLE) - cast(cast(l_tax AS FLOAT) AS DOUBLE), 2)), 9) + 0.0 AS mse FROM lineitem""")
def float32_error(spark, sf):
    """Inputs rounded to float32 first."""
    return rounded(evaluate(view(spark, sf, "reg_pairs").drop("weight"), ["mse"], cast_float32=True), 9)


RANK_SQL = """x AS (SELECT {g} {x} AS x, {y} AS y FROM {t}),
ranks AS (SELECT {o} rank() OVER ({p} ORDER BY x) + (count(*) OVER (PARTITION BY {o} x) - 1) / 2.0::DOUBLE AS rx,
  rank() OVER ({p} ORDER BY y) + (count(*) OVER (PARTITION BY {o} y) - 1) / 2.0::DOUBLE AS ry FROM x)"""


@query("WITH " + RANK_SQL.format(g="l_returnflag AS grp,", x="l_discount", y="l_tax", t="lineitem", o="grp,", p="PARTITION BY grp")
       + " SELECT grp, round(corr(rx, ry), 6) + 0.0 AS spearmanr, count(*) AS n FROM ranks GROUP BY grp")
def rank_correlation(spark, sf):
    """Spearman with heavy ties, per group."""
    return rounded(rg.rank_correlation(view(spark, sf, "reg_pairs"), ["grp"]))


@query("WITH " + RANK_SQL.format(g="", x="l_extendedprice", y="l_quantity", t="lineitem", o="", p="")
       + " SELECT round(corr(rx, ry), 6) + 0.0 AS spearmanr FROM ranks")
def rank_correlation_continuous(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("prediction"), F.col("l_quantity").alias("reference"))
    return rounded(evaluate(rows, [get("spearmanr", p_value=False)]))


# P(|T| >= t) as an integral over the angle whose sine is the coefficient, by Simpson's rule.
P_VALUE_SQL = """(SELECT 2 * exp(lgamma((n - 1) / 2) - lgamma((n - 2) / 2)) / sqrt(pi()) * sum((CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
* pow(cos(asin(abs({c})) + i * (pi() / 2 - asin(abs({c}))) / 4000), n - 3)) * (pi() / 2 - asin(abs({c}))) / 12000 FROM range(4001) u(i))"""


@query(f"""WITH v AS (SELECT p_brand, cast(p_size AS DOUBLE) AS x, p_retailprice AS y FROM part),
k AS (SELECT p_brand, x, y, rank() OVER (PARTITION BY p_brand ORDER BY x) + (count(*) OVER (PARTITION BY p_brand, x) - 1) / 2 AS rx,
rank() OVER (PARTITION BY p_brand ORDER BY y) + (count(*) OVER (PARTITION BY p_brand, y) - 1) / 2 AS ry FROM v),
c AS (SELECT p_brand, corr(x, y) AS r, corr(rx, ry) AS s, count(*) AS n FROM k GROUP BY p_brand)
SELECT p_brand, round(r, 6) + 0.0 AS pearsonr, round({P_VALUE_SQL.format(c='r')}, 6) + 0.0 AS "p-value", round(s, 6) + 0.0 AS spearmanr,
round({P_VALUE_SQL.format(c='s')}, 6) + 0.0 AS spearmanr_pvalue FROM c""")
def correlation_p_values(spark, sf):
    """Coefficients with two-sided p-values per part brand."""
    rows = table(spark, sf, "part").select("p_brand", F.col("p_size").cast("double").alias("prediction"),
                                           F.col("p_retailprice").alias("reference"))
    return rounded(evaluate(rows, ["pearsonr", "spearmanr"], ["p_brand"]))


@query("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts, event_id) AS i FROM series),
naive AS (SELECT a.series_id, avg(abs(a.value - b.value)) AS d FROM o a JOIN o b ON a.series_id = b.series_id AND a.i = b.i + 7 GROUP BY a.series_id),
err AS (SELECT user_id AS series_id, avg(abs(value - (value * 0.9 + 1))) AS e FROM events GROUP BY user_id)
SELECT err.series_id, round(e / greatest(d, """ + EPS + """), 6) + 0.0 AS mase FROM err JOIN naive ON err.series_id = naive.series_id""", ("series",))
def scaled_error(spark, sf):
    """Seasonal scaled error per series."""
    rows = table(spark, sf, "events").select(F.col("user_id").alias("series_id"), F.col("value").alias("prediction"),
                                             (F.col("value") * 0.9 + 1).alias("reference"))
    return rounded(rg.mase(rows, view(spark, sf, "series"), ["ts", "event_id"], ["series_id"], 7))


@query("""SELECT round((sqrt(avg(pow(l_discount - l_tax, 2))) + sqrt(avg(pow(l_quantity - l_linenumber, 2)))) / 2, 6) + 0.0 AS value FROM lineitem""")
def multioutput_rmse(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.array(F.col("l_discount"), F.col("l_quantity")).alias("prediction"),
        F.array(F.col("l_tax"), F.col("l_linenumber").cast("double")).alias("reference"))
    return rounded(rg.multioutput(rows, "mse", squared=False))


@query("""SELECT round((0.3 * avg(abs(l_discount - l_tax)) + 0.7 * avg(abs(l_quantity - l_linenumber))) / 1.0, 6) + 0.0 AS value FROM lineitem""")
def multioutput_mae_weights(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.array(F.col("l_discount"), F.col("l_quantity")).alias("prediction"),
        F.array(F.col("l_tax"), F.col("l_linenumber").cast("double")).alias("reference"))
    return rounded(rg.multioutput(rows, "mae", aggregate=[0.3, 0.7]))


@query("SELECT round(exp(avg(l_discount)), 6) AS perplexity FROM lineitem")
def loss_perplexity(spark, sf):
    return rounded(evaluate(table(spark, sf, "lineitem"), [get("perplexity", loss="l_discount")]))


@query("""SELECT user_id, round(exp(sum(value / 50 * (event_type <> 'error')::INT) / sum((event_type <> 'error')::INT)), 6) AS perplexity FROM events GROUP BY user_id""")
def token_perplexity(spark, sf):
    tokens = table(spark, sf, "events").select("user_id", (F.col("value") / 50).alias("nll"),
                                               (F.col("event_type") != "error").cast("int").alias("mask"))
    return rounded(rg.text_perplexity(tokens, "user_id", mask="mask"))


@query("""SELECT round(avg(p), 6) AS mean_perplexity FROM (SELECT exp(sum(value / 50 * (event_type <> 'error')::INT) / sum((event_type <> 'error')::INT)) AS p FROM events GROUP BY user_id)""")
def corpus_perplexity(spark, sf):
    """The mean over texts."""
    tokens = table(spark, sf, "events").select("user_id", (F.col("value") / 50).alias("nll"),
                                               (F.col("event_type") != "error").cast("int").alias("mask"))
    return rounded(rg.corpus_perplexity(tokens, "user_id", mask="mask"))


@query("""SELECT cast(1 AS INTEGER) AS step, round(avg(pow(l_discount - l_tax, 2)), 9) + 0.0 AS mse, round(avg(abs(l_discount - l_tax)), 9) + 0.0 AS mae FROM lineitem""")
def metrics_record(spark, sf):
    """One evaluation appended to a metrics table and read back."""
    path = scratch_path(spark, "metrics")
    append_metrics(evaluate(view(spark, sf, "reg_pairs"), ["mse", "mae"]), path, 1)
    return rounded(spark.read.schema("step int, mse double, mae double").json(path), 9)


@query("""SELECT cast(i AS INTEGER) AS i, cast(j AS INTEGER) AS j, round(covar_samp(cast(embedding[i + 1] AS DOUBLE), cast(embedding[j + 1] AS DOUBLE)), 6) + 0.0 AS value
FROM embeddings, range(64) a(i), range(64) b(j) GROUP BY 1, 2""")
def covariance_entries(spark, sf):
    """The covariance the distances stand on."""
    flat = covariance(table(spark, sf, "embeddings"), "embedding").select(
        "n", F.size("mu").alias("d"), F.posexplode("g").alias("at", "g"))
    return flat.select(F.floor(F.col("at") / F.col("d")).cast("int").alias("i"), (F.col("at") % F.col("d")).cast("int").alias("j"),
                       r(F.col("g") / (F.col("n") - 1)).alias("value"))


@query("SELECT cast(64 * (count(*) - 1) AS DOUBLE) AS total FROM embeddings")
def mahalanobis_total(spark, sf):
    """Over the reference itself, squared distances from the mean vector add up to dimensions times (rows - 1)."""
    cells = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return mahalanobis(cells, cells, per_dimension=True).agg(r(F.sum("mahalanobis"), 4).alias("total"))


@query()
def mahalanobis_distance(spark, sf):
    """Squared distances from the embedding distribution (a matrix inverse has no SQL form)."""
    cells = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return mahalanobis(cells, cells).select("vec_id", r("mahalanobis", 4).alias("mahalanobis"))


@query("SELECT round(avg(n_chars), 6) + 0.0 AS mean, cast(sum(n_chars) AS DOUBLE) AS total, median(n_chars) AS middle FROM documents")
def score_aggregates(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("n_chars").cast("double").alias("s"))
    parts = {"mean": "mean", "sum": "total", "median": "middle"}
    frames = [aggregate_scores(docs, "s", how).withColumnRenamed("s", name) for how, name in parts.items()]
    return rounded(frames[0].join(F.broadcast(frames[1])).join(F.broadcast(frames[2])))


# --- classification --------------------------------------------------------------------------

def flags(spark, sf):
    """Three-class pairs of any size: line status and return flag against each other."""
    flag = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    guess = F.when(F.col("l_discount") < 0.03, 0).when(F.col("l_discount") < 0.07, 1).otherwise(2)
    return table(spark, sf, "lineitem").select(guess.alias("prediction"), flag.alias("reference"),
                                               F.col("l_quantity").alias("w"), "l_linestatus")


FLAGS_SQL = """flags AS (SELECT CASE WHEN l_discount < 0.03 THEN 0 WHEN l_discount < 0.07 THEN 1 ELSE 2 END AS prediction,
  CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS reference, l_quantity AS w, l_linestatus FROM lineitem),
classes AS (SELECT k AS label, sum(w) FILTER (WHERE prediction = k AND reference = k) AS tp, sum(w) FILTER (WHERE prediction = k) AS pred,
  sum(w) FILTER (WHERE reference = k) AS true_ FROM flags, range(3) t(k) GROUP BY k),
scores AS (SELECT *, tp / pred AS precision, tp / true_ AS recall, 2 * tp / (pred + true_) AS f1 FROM classes)"""


@query(f"""WITH {FLAGS_SQL} SELECT round(avg((prediction = reference)::INT), 6) + 0.0 AS accuracy,
round(sum(w * pow(0.5 - (reference = 1)::INT, 2)) / sum(w), 6) + 0.0 AS brier FROM flags""")
def accuracy_and_brier(spark, sf):
    df = flags(spark, sf)
    acc = evaluate(df, ["accuracy"])
    brier = evaluate(df.withColumn("prediction", F.lit(0.5)), [get("brier_score", weight="w")])
    return rounded(acc.join(F.broadcast(brier.withColumnRenamed("brier_score", "brier"))))


@query("SELECT round(avg(pow(toxic - (quality = 1)::INT, 2)), 6) + 0.0 AS brier_score FROM labels")
def brier_score(spark, sf):
    return rounded(evaluate(view(spark, sf, "cls_pairs"), ["brier_score"]))


@query(f"""WITH {FLAGS_SQL}, cells AS (SELECT reference, prediction, sum(w) AS w FROM flags GROUP BY 1, 2)
SELECT cast(reference AS INTEGER) AS reference, cast(prediction AS INTEGER) AS prediction, round(w / sum(w) OVER (PARTITION BY reference), 6) + 0.0 AS value FROM cells""")
def confusion_matrix(spark, sf):
    """Weighted, normalised over the true rows."""
    return rounded(c.confusion_matrix(flags(spark, sf), weight="w", normalize="true"))


def _average(name: str, sql: str, **options):
    @query(f"WITH {FLAGS_SQL} {sql}", name=name)
    def run(spark, sf, options=options):
        return rounded(c.precision_recall_f1(flags(spark, sf), weight="w", **options))

    return run


_ROUND3 = "round({0}, 6) + 0.0 AS precision, round({1}, 6) + 0.0 AS recall, round({2}, 6) + 0.0 AS f1"
_average("scores_binary", "SELECT " + _ROUND3.format("precision", "recall", "f1") + " FROM scores WHERE label = 1", average="binary")
_average("scores_macro", "SELECT " + _ROUND3.format("avg(precision)", "avg(recall)", "avg(f1)") + " FROM scores", average="macro")
_average("scores_micro", "SELECT " + _ROUND3.format("sum(tp) / sum(pred)", "sum(tp) / sum(true_)", "2 * sum(tp) / (sum(pred) + sum(true_))")
         + " FROM scores", average="micro")
_average("scores_weighted", "SELECT " + _ROUND3.format(*[f"sum({x} * true_) / sum(true_)" for x in ("precision", "recall", "f1")])
         + " FROM scores", average="weighted")
_average("scores_per_class", "SELECT cast(label AS INTEGER) AS label, " + _ROUND3.format("precision", "recall", "f1") + ", true_ AS support FROM scores",
         average=None)


@query(f"""WITH {FLAGS_SQL}, g AS (SELECT l_linestatus, prediction AS p, reference AS t, sum(w) AS w FROM flags GROUP BY 1, 2, 3),
s AS (SELECT l_linestatus, sum(w) AS s, sum(w) FILTER (WHERE p = t) AS c FROM g GROUP BY 1),
pk AS (SELECT l_linestatus, p AS k, sum(w) AS n FROM g GROUP BY 1, 2), tk AS (SELECT l_linestatus, t AS k, sum(w) AS n FROM g GROUP BY 1, 2),
x AS (SELECT pk.l_linestatus, sum(pk.n * tk.n) AS pt, sum(pk.n * pk.n) AS pp, sum(tk.n * tk.n) AS tt FROM pk JOIN tk ON pk.k = tk.k AND pk.l_linestatus = tk.l_linestatus GROUP BY 1)
SELECT s.l_linestatus, round((c * s - pt) / sqrt((s * s - pp) * (s * s - tt)), 6) + 0.0 AS matthews_correlation FROM s JOIN x ON s.l_linestatus = x.l_linestatus""")
def matthews(spark, sf):
    """Weighted multiclass Matthews correlation per line status."""
    return rounded(evaluate(flags(spark, sf), [get("matthews_correlation", weight="w")], ["l_linestatus"]))


def multilabel(spark, sf):
    bit = lambda cond: cond.cast("int")
    return table(spark, sf, "lineitem").select(
        F.array(bit(F.col("l_discount") > 0.05), bit(F.col("l_tax") > 0.04)).alias("prediction"),
        F.array(bit(F.col("l_quantity") > 25), bit(F.col("l_returnflag") == "R")).alias("reference"))


ML_SQL = """ml AS (SELECT (l_discount > 0.05)::INT AS p0, (l_tax > 0.04)::INT AS p1, (l_quantity > 25)::INT AS r0, (l_returnflag = 'R')::INT AS r1 FROM lineitem)"""


@query(f"""WITH {ML_SQL}, s AS (SELECT p0 * r0 + p1 * r1 AS tp, p0 + p1 AS p, r0 + r1 AS r FROM ml)
SELECT round(avg(CASE WHEN p > 0 THEN tp / p ELSE 0 END), 6) + 0.0 AS precision, round(avg(CASE WHEN r > 0 THEN tp / r ELSE 0 END), 6) + 0.0 AS recall,
round(avg(CASE WHEN p + r > 0 THEN 2 * tp / (p + r) ELSE 0 END), 6) + 0.0 AS f1 FROM s""")
def scores_per_sample(spark, sf):
    return rounded(c.precision_recall_f1(multilabel(spark, sf), "samples"))


@query(f"""WITH {ML_SQL}, s AS (SELECT 0 AS slot, corr(p0, r0) AS m FROM ml UNION ALL SELECT 1, corr(p1, r1) FROM ml)
SELECT cast(slot AS INTEGER) AS slot, round(m, 6) + 0.0 AS matthews_correlation FROM s""")
def matthews_multilabel(spark, sf):
    """For 0/1 columns this equals their Pearson correlation."""
    return rounded(c.matthews_multilabel(multilabel(spark, sf)))


AUC_SQL = """SELECT {k} (sum(rk) FILTER (WHERE y) - count(*) FILTER (WHERE y) * (count(*) FILTER (WHERE y) + 1) / 2.0::DOUBLE)
  / (count(*) FILTER (WHERE y) * count(*) FILTER (WHERE NOT y)) AS a FROM
  (SELECT *, rank() OVER ({p} ORDER BY s) + (count(*) OVER (PARTITION BY {k} s) - 1) / 2.0::DOUBLE AS rk FROM rows_) {g}"""


@query("WITH rows_ AS (SELECT cast(score AS DOUBLE) AS s, reference = 1 AS y FROM cls_pairs) SELECT round(a, 6) AS roc_auc FROM ("
       + AUC_SQL.format(k="", p="", g="") + ")", ("cls_pairs",))
def roc_auc_binary(spark, sf):
    rows = view(spark, sf, "cls_pairs").select(F.col("score").alias("prediction"), "reference")
    return rounded(rk.roc_auc(rows))


@query("WITH rows_ AS (SELECT l_linestatus, l_extendedprice AS s, l_returnflag = 'R' AS y FROM lineitem) SELECT l_linestatus, round(a, 6) AS roc_auc FROM ("
       + AUC_SQL.format(k="l_linestatus,", p="PARTITION BY l_linestatus", g="GROUP BY l_linestatus") + ")")
def roc_auc_by_group(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_linestatus", F.col("l_extendedprice").alias("prediction"),
                                               (F.col("l_returnflag") == "R").cast("int").alias("reference"))
    return rounded(evaluate(rows, ["roc_auc"], ["l_linestatus"]))


def probabilities(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.array(F.col("l_discount"), F.col("l_tax"), F.col("l_quantity") / 100).alias("prediction"),
        F.pmod("l_linenumber", F.lit(3)).cast("int").alias("reference"))


PROB_SQL = "probs AS (SELECT l_discount AS s0, l_tax AS s1, l_quantity / 100 AS s2, l_linenumber % 3 AS ref FROM lineitem)"


@query(f"WITH {PROB_SQL}, rows_ AS (SELECT label, CASE label WHEN 0 THEN s0 WHEN 1 THEN s1 ELSE s2 END AS s, ref = label AS y FROM probs, range(3) t(label)), per AS ("
       + AUC_SQL.format(k="label,", p="PARTITION BY label", g="GROUP BY label") + ") SELECT round(avg(a), 6) AS roc_auc FROM per")
def roc_auc_one_vs_rest(spark, sf):
    return rounded(rk.roc_auc(probabilities(spark, sf), "multiclass"))


MULTI_SQL = "multi AS (SELECT l_discount AS s0, l_quantity / 100 AS s1, l_returnflag = 'R' AS y0, l_linestatus = 'F' AS y1 FROM lineitem)"


@query(f"WITH {MULTI_SQL}, rows_ AS (SELECT 0 AS label, s0 AS s, y0 AS y FROM multi UNION ALL SELECT 1, s1, y1 FROM multi), per AS ("
       + AUC_SQL.format(k="label,", p="PARTITION BY label", g="GROUP BY label") + "), micro AS (" + AUC_SQL.format(k="", p="", g="")
       + """), n AS (SELECT label, count(*) FILTER (WHERE y) AS n FROM rows_ GROUP BY label)
SELECT (SELECT round(avg(a), 6) FROM per) AS macro, (SELECT round(sum(a * n) / sum(n), 6) FROM per JOIN n USING (label)) AS weighted, (SELECT round(a, 6) FROM micro) AS micro""")
def roc_auc_multilabel(spark, sf):
    """Two labels per row: averaged, weighted by their positives, and all decisions together."""
    rows = table(spark, sf, "lineitem").select(
        F.array(F.col("l_discount"), F.col("l_quantity") / 100).alias("prediction"),
        F.array((F.col("l_returnflag") == "R").cast("int"), (F.col("l_linestatus") == "F").cast("int")).alias("reference"))
    parts = [rk.roc_auc(rows, "multilabel", average).select(F.col("roc_auc").alias(average)) for average in ("macro", "weighted", "micro")]
    return rounded(parts[0].join(F.broadcast(parts[1])).join(F.broadcast(parts[2])))  # one row each


@query(f"""WITH {PROB_SQL}, dirs AS (SELECT * FROM (VALUES (0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1)) t(a_, b_)),
rows_ AS (SELECT a_, b_, CASE a_ WHEN 0 THEN s0 WHEN 1 THEN s1 ELSE s2 END AS s, ref = a_ AS y FROM probs, dirs WHERE ref IN (a_, b_)), per AS ("""
       + AUC_SQL.format(k="a_, b_,", p="PARTITION BY a_, b_", g="GROUP BY a_, b_") + ") SELECT round(avg(a), 6) AS roc_auc FROM per")
def roc_auc_one_vs_one(spark, sf):
    return rounded(rk.roc_auc(probabilities(spark, sf), "multiclass", multi_class="ovo"))


@query("""WITH steps AS (SELECT l_extendedprice AS s, count(*) FILTER (WHERE l_returnflag = 'R') AS dp, count(*) FILTER (WHERE l_returnflag <> 'R') AS dn FROM lineitem GROUP BY 1),
run AS (SELECT *, sum(dp) OVER w AS cp, sum(dn) OVER w AS cn, sum(dp) OVER () AS np, sum(dn) OVER () AS nn FROM steps WINDOW w AS (ORDER BY s DESC)),
seg AS (SELECT (cn - dn) / nn AS x0, cn / nn AS x1, (cp - dp) / np AS y0, cp / np AS y1 FROM run),
cut AS (SELECT *, least(x1, 0.25) AS xe FROM seg WHERE x0 < 0.25 AND x1 > x0),
area AS (SELECT sum((xe - x0) * (y0 + y0 + (y1 - y0) * (xe - x0) / (x1 - x0)) / 2) AS a FROM cut)
SELECT round(0.5 * (1 + (a - 0.03125) / (0.25 - 0.03125)), 6) AS roc_auc FROM area""")
def roc_auc_partial(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("prediction"),
                                               (F.col("l_returnflag") == "R").cast("int").alias("reference"))
    return rounded(rk.roc_auc(rows, max_fpr=0.25))


IOU_SQL = """px AS (SELECT cast(floor(abs(cast(embedding[d] AS DOUBLE)) * 20) AS INTEGER) AS l,
  cast(floor(abs(cast(embedding[65 - d] AS DOUBLE)) * 5) + floor(abs(cast(embedding[d] AS DOUBLE)) * 17) AS INTEGER) AS p FROM embeddings, range(1, 65) t(d)),
kept AS (SELECT * FROM px WHERE l <> 4),
per AS (SELECT k, count(*) FILTER (WHERE l = k AND p = k) AS i, count(*) FILTER (WHERE p = k) AS np, count(*) FILTER (WHERE l = k) AS nl FROM kept, range(8) t(k) GROUP BY k)"""


def label_maps(spark, sf):
    vec = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    cols = table(spark, sf, "embeddings").select(vec.alias("v"))
    label = F.transform("v", lambda x: F.floor(x * 20).cast("int"))
    guess = F.zip_with("v", F.reverse("v"), lambda x, y: (F.floor(y * 5) + F.floor(x * 17)).cast("int"))
    rows = lambda c: F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice(c, i * 8 + 1, 8))
    return cols.select(guess.alias("p"), label.alias("l")).select(rows(F.col("p")).alias("prediction"), rows(F.col("l")).alias("reference"))


@query(f"""WITH {IOU_SQL} SELECT round(avg(CASE WHEN np + nl - i > 0 THEN i / (np + nl - i) END), 6) AS mean_iou, round(avg(CASE WHEN nl > 0 THEN i / nl END), 6) AS mean_accuracy,
round(sum(i) / sum(nl), 6) AS overall_accuracy FROM per""")
def segmentation_iou(spark, sf):
    """Pixel counts over 8×8 label maps; one label is ignored."""
    return rounded(c.mean_iou(label_maps(spark, sf), 8, 4).select("mean_iou", "mean_accuracy", "overall_accuracy"))


@query(f"WITH {IOU_SQL} SELECT cast(k AS INTEGER) AS category, i AS intersect, np AS pred, nl AS label, np + nl - i AS \"union\" FROM per")
def segmentation_counts(spark, sf):
    return c.segmentation_counts(label_maps(spark, sf), 8, 4).select("category", "intersect", "pred", "label", "union")


# --- suites ----------------------------------------------------------------------------------

@query(f"""WITH {FLAGS_SQL}, b AS (SELECT (prediction > 0)::INT AS p, (reference > 0)::INT AS t FROM flags)
SELECT round(avg((p = t)::INT), 6) + 0.0 AS accuracy, round(2 * sum(p * t) / (sum(p) + sum(t)), 6) + 0.0 AS f1 FROM b""")
def suite_paraphrase(spark, sf):
    """Accuracy and F1 of a binary task."""
    df = flags(spark, sf).select((F.col("prediction") > 0).cast("int").alias("prediction"), (F.col("reference") > 0).cast("int").alias("reference"))
    return rounded(benchmarks.glue(df, "mrpc"))


@query("WITH " + RANK_SQL.format(g="", x="l_discount", y="l_tax", t="lineitem", o="", p="")
       + " SELECT (SELECT round(corr(l_discount, l_tax), 6) + 0.0 FROM lineitem) AS pearson, round(corr(rx, ry), 6) + 0.0 AS spearmanr FROM ranks")
def suite_similarity(spark, sf):
    return rounded(benchmarks.glue(view(spark, sf, "reg_pairs"), "stsb"))


UNWEIGHTED_SQL = FLAGS_SQL.replace("l_quantity AS w", "1.0 AS w")


@query(f"WITH {UNWEIGHTED_SQL} SELECT round((SELECT avg((prediction = reference)::INT) FROM flags), 6) + 0.0 AS accuracy, round(avg(f1), 6) + 0.0 AS f1 FROM scores")
def suite_entailment(spark, sf):
    return rounded(benchmarks.super_glue(flags(spark, sf).drop("w"), "cb"))


@query(f"WITH {UNWEIGHTED_SQL} SELECT round((SELECT avg((prediction = reference)::INT) FROM flags), 6) + 0.0 AS accuracy FROM scores LIMIT 1")
def suite_cross_lingual(spark, sf):
    return rounded(benchmarks.xnli(flags(spark, sf)))


@query("""WITH a AS (SELECT l_orderkey AS q, (l_discount > 0.05)::INT AS p, (l_quantity > 25)::INT AS r FROM lineitem),
k AS (SELECT q, label, sum((p = label AND r = label)::INT) AS tp, sum((p = label)::INT) AS np, sum((r = label)::INT) AS nr FROM a, range(2) t(label) GROUP BY q, label),
m AS (SELECT q, avg(2 * tp / (np + nr)) AS f1 FROM k WHERE np + nr > 0 GROUP BY q), em AS (SELECT q, min((p = r)::INT) AS ok FROM a GROUP BY q)
SELECT (SELECT round(avg(ok), 6) + 0.0 FROM em) AS exact_match, round(avg(f1), 6) + 0.0 AS f1_m,
(SELECT round(2 * sum(p * r) / (sum(p) + sum(r)), 6) + 0.0 FROM a) AS f1_a FROM m""")
def suite_multi_sentence(spark, sf):
    """Several answers per question: all right, mean macro F1, overall F1."""
    df = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("question"), (F.col("l_discount") > 0.05).cast("int").alias("prediction"),
                                             (F.col("l_quantity") > 25).cast("int").alias("reference"))
    return rounded(multirc(df))


# --- ranking ---------------------------------------------------------------------------------

TREC_SQL = """judged AS (SELECT r.query, r.docid, r.score, coalesce(q.rel, 0) AS rel, q.rel IS NOT NULL AS j FROM trec_run r LEFT JOIN trec_qrels q ON r.query = q.query AND r.docid = q.docid),
ranked AS (SELECT *, row_number() OVER w AS rk, sum((rel > 0)::INT) OVER w AS hits, sum((j AND rel <= 0)::INT) OVER w AS misses FROM judged WINDOW w AS (PARTITION BY query ORDER BY score DESC, docid DESC ROWS UNBOUNDED PRECEDING)),
needs AS (SELECT query, sum((rel > 0)::INT) AS R, sum((rel <= 0)::INT) AS N FROM trec_qrels GROUP BY query),
ideal AS (SELECT query, rel, row_number() OVER (PARTITION BY query ORDER BY rel DESC) AS rk FROM trec_qrels),
idcg AS (SELECT query, sum(rel / log2(rk + 1)) FILTER (WHERE rk <= 10) AS i10, sum(rel / log2(rk + 1)) FILTER (WHERE rk <= 100) AS i100 FROM ideal GROUP BY query),
per AS (SELECT k.query, count(*) AS num_ret, any_value(R) AS num_rel, sum((rel > 0)::INT) AS num_rel_ret,
  coalesce(sum(hits / rk) FILTER (WHERE rel > 0), 0) / any_value(R) AS map,
  coalesce(sum(1 - least(misses, R) / least(R, N)) FILTER (WHERE rel > 0), 0) / any_value(R) AS bpref,
  sum((rel > 0 AND rk <= R)::INT) / any_value(R) AS rprec, coalesce(1 / min(rk) FILTER (WHERE rel > 0), 0) AS rr,
  sum((rel > 0 AND rk <= 5)::INT) / 5 AS p5, sum((rel > 0 AND rk <= 100)::INT) / 100 AS p100,
  coalesce(sum(rel / log2(rk + 1)) FILTER (WHERE rk <= 10), 0) / any_value(i10) AS n10, coalesce(sum(rel / log2(rk + 1)) FILTER (WHERE rk <= 100), 0) / any_value(i100) AS n100
  FROM ranked k JOIN needs n ON k.query = n.query JOIN idcg i ON i.query = k.query GROUP BY k.query)"""


@query(f"""WITH {TREC_SQL} SELECT cast(sum(num_ret) AS BIGINT) AS num_ret, cast(sum(num_rel) AS BIGINT) AS num_rel, cast(sum(num_rel_ret) AS BIGINT) AS num_rel_ret, count(*) AS num_q, round(avg(map), 6) AS map,
round(exp(avg(ln(greatest(map, 1e-5)))), 6) AS gm_map, round(avg(bpref), 6) AS bpref, round(avg(rprec), 6) AS "Rprec", round(avg(rr), 6) AS recip_rank,
round(avg(p5), 6) AS "P@5", round(avg(p100), 6) AS "P@100", round(avg(n10), 6) AS "NDCG@10", round(avg(n100), 6) AS "NDCG@100" FROM per""", ("trec_run", "trec_qrels"))
def retrieval_report(spark, sf):
    out = rk.trec_eval(view(spark, sf, "trec_run"), view(spark, sf, "trec_qrels"))
    keep = ["num_ret", "num_rel", "num_rel_ret", "num_q", "map", "gm_map", "bpref", "Rprec", "recip_rank", "P@5", "P@100", "NDCG@10", "NDCG@100"]
    return rounded(out.select(*[F.col(f"`{k}`") for k in keep]))


@query(f"""WITH {TREC_SQL} SELECT query % 4 AS grp, count(*) AS num_q, round(avg(map), 6) AS map, round(avg(n10), 6) AS "NDCG@10" FROM per GROUP BY 1""", ("trec_run", "trec_qrels"))
def retrieval_by_group(spark, sf):
    """Found by name, averaged per group of queries; run and judgements in one frame."""
    run, qrels = view(spark, sf, "trec_run"), view(spark, sf, "trec_qrels")
    rows = run.join(qrels, ["query", "docid"], "full").withColumn("grp", F.col("query") % 4)
    return rounded(evaluate(rows, ["trec_eval"], ["grp"]).select("grp", "num_q", "map", "`NDCG@10`"))


@query(f"""WITH {TREC_SQL} SELECT query, num_ret, cast(num_rel AS BIGINT) AS num_rel, cast(num_rel_ret AS BIGINT) AS num_rel_ret, round(map, 6) AS map, round(bpref, 6) AS bpref, round(n10, 6) AS "NDCG@10" FROM per""",
       ("trec_run", "trec_qrels"))
def retrieval_per_query(spark, sf):
    out = rk.trec_per_query(view(spark, sf, "trec_run"), view(spark, sf, "trec_qrels"))
    return rounded(out.select("query", "num_ret", "num_rel", "num_rel_ret", "map", "bpref", "`NDCG@10`"))


def two_views(spark, sf, key="id"):
    cells = table(spark, sf, "embeddings").select(F.col("vec_id").alias(key), F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    other = cells.withColumn("embedding", F.zip_with("embedding", F.reverse("embedding"), lambda x, y: x + y * 0.8))
    return cells, other


TWO_SQL = """l AS (SELECT vec_id AS id, list_transform(embedding, lambda x: cast(x AS DOUBLE)) AS v FROM embeddings),
rr AS (SELECT id, list_transform(range(1, 65), lambda i: v[i] + v[65 - i] * 0.8) AS v FROM l)"""
SIM_SQL = """sims AS (SELECT l.id // 72 AS batch, l.id AS i, rr.id AS j, list_dot_product(l.v, rr.v) AS s FROM l JOIN rr ON l.id // 72 = rr.id // 72)"""


@query("""SELECT vec_id, cast(d - 1 AS INTEGER) AS d, round(cast(greatest(embedding[d], embedding[d + 16], embedding[d + 32], embedding[d + 48]) AS DOUBLE), 6) + 0.0 AS value
FROM embeddings, range(1, 17) t(d)""")
def token_maximum(spark, sf):
    """Four token vectors of sixteen values each, compared value by value."""
    blocks = F.array(*[F.slice("embedding", 16 * i + 1, 16) for i in range(4)])
    rows = rk.token_maximum(table(spark, sf, "embeddings").select("vec_id", blocks.alias("embedding")))
    return rows.select("vec_id", F.posexplode("embedding").alias("d", "value")).select("vec_id", "d", r("value").alias("value"))


@query(f"""WITH {TWO_SQL}, {SIM_SQL}, a AS (SELECT i, max_by(j, s) AS best FROM sims GROUP BY i), b AS (SELECT j, max_by(i, s) AS best FROM sims GROUP BY j)
SELECT round((SELECT avg((i = best)::INT) FROM a), 6) + 0.0 AS seq_acc, round((SELECT avg((j = best)::INT) FROM b), 6) + 0.0 AS scrna_acc""")
def contrastive_accuracy(spark, sf):
    left, right = (rk.with_batch(d, 72, "id") for d in two_views(spark, sf))
    return rounded(rk.retrieval_accuracy(left, right))


@query(f"""WITH {TWO_SQL}, {SIM_SQL}, t AS (SELECT batch, i, j, s * exp(0.5) AS s FROM sims),
a AS (SELECT batch, i, ln(sum(exp(s))) - sum(CASE WHEN i = j THEN s END) AS x FROM t GROUP BY batch, i), b AS (SELECT batch, j, ln(sum(exp(s))) - sum(CASE WHEN i = j THEN s END) AS x FROM t GROUP BY batch, j)
SELECT batch, round(((SELECT avg(x) FROM a WHERE a.batch = q.batch) + (SELECT avg(x) FROM b WHERE b.batch = q.batch)) / 2, 6) + 0.0 AS clip_loss FROM (SELECT DISTINCT batch FROM t) q""")
def contrastive_loss(spark, sf):
    left, right = (rk.with_batch(d, 72, "id") for d in two_views(spark, sf))
    return rounded(rk.clip_loss(left, right, 0.5))


@query(f"""WITH {TWO_SQL}, {SIM_SQL}, t AS (SELECT batch, i, j, s * exp(0.5) AS s FROM sims),
a AS (SELECT batch, i, ln(sum(exp(s))) - sum(CASE WHEN i = j THEN s END) AS x FROM t GROUP BY batch, i), b AS (SELECT batch, j, ln(sum(exp(s))) - sum(CASE WHEN i = j THEN s END) AS x FROM t GROUP BY batch, j),
e AS (SELECT vec_id // 72 AS batch, avg(pow(cast(embedding[1] AS DOUBLE) - cast(embedding[2] AS DOUBLE), 2)) AS mse FROM embeddings GROUP BY 1)
SELECT batch, round(2 * mse + 0.5 * ((SELECT avg(x) FROM a WHERE a.batch = e.batch) + (SELECT avg(x) FROM b WHERE b.batch = e.batch)) / 2, 6) + 0.0 AS loss FROM e""")
def combined_loss(spark, sf):
    """Squared error and contrastive loss, weighted."""
    left, right = (rk.with_batch(d, 72, "id") for d in two_views(spark, sf))
    pairs = left.select("batch", F.col("embedding")[0].alias("prediction"), F.col("embedding")[1].alias("reference"))
    return rounded(rk.combined_loss(pairs, left, right, 2.0, 0.5, 0.5))


@query(f"""WITH {TWO_SQL}, d AS (SELECT k FROM range(1, 65) t(k)),
ml AS (SELECT list(m ORDER BY k) AS m FROM (SELECT k, avg(v[k]) AS m FROM l, d GROUP BY k)), mr AS (SELECT list(m ORDER BY k) AS m FROM (SELECT k, avg(v[k]) AS m FROM rr, d GROUP BY k)),
a AS (SELECT id, list_transform(range(1, 65), lambda k: v[k] - m[k]) AS v FROM l, ml), b AS (SELECT id, list_transform(range(1, 65), lambda k: v[k] - m[k]) AS v FROM rr, mr),
s AS (SELECT a.id AS i, b.id AS j, list_cosine_similarity(a.v, b.v) AS s FROM a, b), own AS (SELECT i, s FROM s WHERE i = j),
n AS (SELECT s.i, count(*) FILTER (WHERE s.j <> s.i AND s.s > own.s + 1e-12) AS nearer FROM s JOIN own ON own.i = s.i GROUP BY s.i)
SELECT round(avg((nearer < 10)::INT), 6) + 0.0 AS "precision@10" FROM n""")
def nearest_partner_precision(spark, sf):
    """Partner among the ten nearest by centred cosine."""
    left, right = two_views(spark, sf)
    return rounded(rk.precision_at_k(left, right))


@query("""WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT id, e, sqrt(list_dot_product(e, e)) AS size FROM v),
d AS (SELECT a.id, b.id AS neighbour, round(1 - list_dot_product(a.e, b.e) / (a.size * b.size), 12) AS distance FROM u a JOIN u b ON a.id <> b.id),
k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS place FROM d)
SELECT id, cast(place AS INTEGER) AS place, neighbour, round(distance, 6) + 0.0 AS distance FROM k WHERE place <= 10""")
def nearest_neighbours(spark, sf):
    """The ten nearest other vectors of each vector, with their cosine distances."""
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    found = nearest(rows, rows, 10, skip_self=True)
    return found.select("id", F.posexplode("near").alias("place", "n")).select(
        "id", (F.col("place") + 1).alias("place"), F.col("n.id").alias("neighbour"), r("n.distance").alias("distance"))


@query("""WITH per AS (SELECT task_id, count(*) AS n, count(*) FILTER (WHERE passed) AS c FROM pass_rows GROUP BY task_id)
SELECT round(avg(c / n), 6) + 0.0 AS "pass@1",
round(avg(CASE WHEN n - c < 10 THEN 1.0 ELSE 1 - list_reduce(list_transform(range(10), lambda j: (n - c - j) / (n - j)), lambda a, b: a * b) END), 6) + 0.0 AS "pass@10" FROM per""", ("pass_rows",))
def pass_at_k(spark, sf):
    return rounded(rk.pass_at_k(view(spark, sf, "pass_rows"), ks=(1, 10)))


# --- tagging ---------------------------------------------------------------------------------

# windows of 64 consecutive events are the sentences
TAG = {"click": "B-A", "view": "I-A", "error": "O", "signup": "I-B", "purchase": "B-B"}


def tag_rows(spark, sf, *more):
    names = F.create_map(*[x for k, v in TAG.items() for x in (F.lit(k), F.lit(v))])
    tag = names[F.col("event_type")]
    guess = F.when(F.col("value") < 5, "O").when(F.col("value") > 40, "I-A").otherwise(tag)
    rows = table(spark, sf, "events").select((F.col("event_id") / 64).cast("long").alias("sent"), "event_id", guess.alias("p"), tag.alias("t"))
    packed = rows.groupBy("sent").agg(F.array_sort(F.collect_list(F.struct("event_id", "p", "t"))).alias("x"))  # 64 entries
    return packed.select(F.col("x.p").alias("prediction"), F.col("x.t").alias("reference"), (F.col("sent") % 3).alias("grp")).select(
        "prediction", "reference", *more)


TAG_SQL = """tags AS (SELECT event_id // 64 AS sent, event_id AS pos, CASE event_type WHEN 'click' THEN 'B-A' WHEN 'view' THEN 'I-A' WHEN 'error' THEN 'O' WHEN 'signup' THEN 'I-B' ELSE 'B-B' END AS t, value FROM events),
both_ AS (SELECT 'true' AS side, sent, pos, t FROM tags UNION ALL SELECT 'pred', sent, pos, CASE WHEN value < 5 THEN 'O' WHEN value > 40 THEN 'I-A' ELSE t END FROM tags)"""


@query(f"""WITH {TAG_SQL}, marks AS (SELECT *, t[1] AS m, CASE WHEN t = 'O' THEN '' ELSE t[3] END AS k FROM both_),
near AS (SELECT *, lag(m, 1, 'O') OVER w AS pm, lag(k, 1, '') OVER w AS pk FROM marks WINDOW w AS (PARTITION BY side, sent ORDER BY pos)),
starts AS (SELECT *, sum((m <> 'O' AND (m = 'B' OR pm = 'O' OR pk <> k))::INT) OVER (PARTITION BY side, sent ORDER BY pos) AS chunk FROM near),
spans AS (SELECT side, sent, chunk, any_value(k) AS type, min(pos) AS a, max(pos) AS b FROM starts WHERE m <> 'O' GROUP BY side, sent, chunk),
n AS (SELECT type, sent % 3 AS grp, count(*) FILTER (WHERE side = 'pred') AS np, count(*) FILTER (WHERE side = 'true') AS nt FROM spans GROUP BY type, grp),
hit AS (SELECT p.type, p.sent % 3 AS grp, count(*) AS tp FROM spans p JOIN spans t ON p.side = 'pred' AND t.side = 'true' AND p.sent = t.sent AND p.type = t.type AND p.a = t.a AND p.b = t.b GROUP BY p.type, p.sent % 3),
x AS (SELECT n.type, n.grp, tp, np, nt FROM n JOIN hit ON n.type = hit.type AND n.grp = hit.grp), y AS (SELECT * FROM x UNION ALL SELECT 'overall', grp, sum(tp), sum(np), sum(nt) FROM x GROUP BY grp),
acc AS (SELECT a.sent % 3 AS grp, avg((a.t = b.t)::INT) AS acc FROM both_ a JOIN both_ b ON a.side = 'pred' AND b.side = 'true' AND a.pos = b.pos GROUP BY 1)
SELECT y.grp, type, round(tp / np, 6) AS precision, round(tp / nt, 6) AS recall, round(2 * tp / (np + nt), 6) AS f1, cast(nt AS BIGINT) AS number, CASE WHEN type = 'overall' THEN (SELECT round(acc, 6) FROM acc WHERE acc.grp = y.grp) END AS accuracy FROM y""")
def entity_report_by_group(spark, sf):
    """Found by name, per type and overall in each group of sequences."""
    return rounded(evaluate(tag_rows(spark, sf, "grp"), ["seqeval"], ["grp"]))


@query(f"""WITH {TAG_SQL}, marks AS (SELECT *, t[1] AS m, CASE WHEN t = 'O' THEN '' ELSE t[3] END AS k FROM both_),
near AS (SELECT *, lag(m, 1, 'O') OVER w AS pm, lag(k, 1, '') OVER w AS pk FROM marks WINDOW w AS (PARTITION BY side, sent ORDER BY pos)),
starts AS (SELECT *, sum((m <> 'O' AND (m = 'B' OR pm = 'O' OR pk <> k))::INT) OVER (PARTITION BY side, sent ORDER BY pos) AS chunk FROM near),
spans AS (SELECT side, sent, chunk, any_value(k) AS type, min(pos) AS a, max(pos) AS b FROM starts WHERE m <> 'O' GROUP BY side, sent, chunk),
n AS (SELECT type, count(*) FILTER (WHERE side = 'pred') AS np, count(*) FILTER (WHERE side = 'true') AS nt FROM spans GROUP BY type),
hit AS (SELECT p.type, count(*) AS tp FROM spans p JOIN spans t ON p.side = 'pred' AND t.side = 'true' AND p.sent = t.sent AND p.type = t.type AND p.a = t.a AND p.b = t.b GROUP BY p.type),
x AS (SELECT n.type, tp, np, nt FROM n JOIN hit ON n.type = hit.type), y AS (SELECT * FROM x UNION ALL SELECT 'overall', sum(tp), sum(np), sum(nt) FROM x),
acc AS (SELECT avg((a.t = b.t)::INT) AS acc FROM both_ a JOIN both_ b ON a.side = 'pred' AND b.side = 'true' AND a.pos = b.pos)
SELECT type, round(tp / np, 6) AS precision, round(tp / nt, 6) AS recall, round(2 * tp / (np + nt), 6) AS f1, cast(nt AS BIGINT) AS number, CASE WHEN type = 'overall' THEN (SELECT round(acc, 6) FROM acc) END AS accuracy FROM y""")
def entity_report(spark, sf):
    """Entity spans from chunk tags, per type and overall."""
    return rounded(tagging.seqeval(tag_rows(spark, sf)))


@query(f"""WITH {TAG_SQL}, marks AS (SELECT *, t[1] AS m, CASE WHEN t = 'O' THEN '' ELSE t[3] END AS k FROM both_),
near AS (SELECT *, lag(m, 1, 'O') OVER w AS pm, lag(k, 1, '') OVER w AS pk FROM marks WINDOW w AS (PARTITION BY side, sent ORDER BY pos)),
cut AS (SELECT *, sum((m = 'B' OR m = 'O' OR pk <> k)::INT) OVER (PARTITION BY side, sent ORDER BY pos) AS run FROM near),
spans AS (SELECT side, sent, run, min_by(m, pos) AS first_m, any_value(k) AS type, min(pos) AS a, max(pos) AS b FROM cut WHERE m <> 'O' GROUP BY side, sent, run),
good AS (SELECT * FROM spans WHERE first_m = 'B'),
n AS (SELECT type, count(*) FILTER (WHERE side = 'pred') AS np, count(*) FILTER (WHERE side = 'true') AS nt FROM good GROUP BY type),
hit AS (SELECT p.type, count(*) AS tp FROM good p JOIN good t ON p.side = 'pred' AND t.side = 'true' AND p.sent = t.sent AND p.type = t.type AND p.a = t.a AND p.b = t.b GROUP BY p.type)
SELECT n.type, cast(tp AS DOUBLE) AS tp, cast(np AS DOUBLE) AS pred, cast(nt AS DOUBLE) AS "true" FROM n JOIN hit ON n.type = hit.type""")
def entity_counts_strict(spark, sf):
    """Only entities that open with B count."""
    return tagging.entity_counts(tag_rows(spark, sf), scheme="IOB2")


@query(f"""WITH {TAG_SQL}, pairs AS (SELECT a.t AS p, b.t AS r FROM both_ a JOIN both_ b ON a.side = 'pred' AND b.side = 'true' AND a.pos = b.pos),
labels_ AS (SELECT DISTINCT t AS k FROM both_),
per AS (SELECT k, count(*) FILTER (WHERE p = k AND r = k) AS tp, count(*) FILTER (WHERE p = k) AS np, count(*) FILTER (WHERE r = k) AS nr FROM pairs, labels_ GROUP BY k),
s AS (SELECT k AS label, tp / np AS precision, tp / nr AS recall, 2 * tp / (np + nr) AS f1, nr AS support FROM per)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM (
SELECT * FROM s UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), cast(sum(support) AS BIGINT) FROM s
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), cast(sum(support) AS BIGINT) FROM s
UNION ALL SELECT 'accuracy', a, a, a, NULL FROM (SELECT avg((p = r)::INT) AS a FROM pairs))""")
def token_report(spark, sf):
    return rounded(tagging.poseval(tag_rows(spark, sf)))


COREF_SQL = """k AS (SELECT user_id % 5 AS doc, user_id AS cluster, event_id AS mention FROM events),
s AS (SELECT user_id % 5 AS doc, user_id % 30 AS cluster, event_id AS mention FROM events)"""


@query(f"""WITH {COREF_SQL}, links AS (SELECT k.doc, k.cluster AS a, s.cluster AS b, count(*) AS n FROM k JOIN s ON k.doc = s.doc AND k.mention = s.mention GROUP BY 1, 2, 3),
ks AS (SELECT doc, cluster, count(*) AS size FROM k GROUP BY 1, 2), ss AS (SELECT doc, cluster, count(*) AS size FROM s GROUP BY 1, 2),
kl AS (SELECT ks.*, coalesce(sum(n), 0) AS found, count(n) AS parts, coalesce(sum(n * n), 0) AS sq, coalesce(sum(n * (n - 1) / 2), 0) AS pr FROM ks LEFT JOIN links l ON l.doc = ks.doc AND l.a = ks.cluster GROUP BY 1, 2, 3),
sl AS (SELECT ss.*, coalesce(sum(n), 0) AS found, count(n) AS parts, coalesce(sum(n * n), 0) AS sq, coalesce(sum(n * (n - 1) / 2), 0) AS pr FROM ss LEFT JOIN links l ON l.doc = ss.doc AND l.b = ss.cluster GROUP BY 1, 2, 3),
r AS (SELECT sum(found) / sum(size) AS m, sum(found - parts) / sum(size - 1) AS muc, sum(sq / size) / sum(size) AS b, sum(size * pr / (size * (size - 1) / 2)) / sum(size) AS lea FROM kl),
p AS (SELECT sum(found) / sum(size) AS m, sum(found - parts) / sum(size - 1) AS muc, sum(sq / size) / sum(size) AS b, sum(size * pr / (size * (size - 1) / 2)) / sum(size) AS lea FROM sl)
SELECT round(r.m, 6) AS "mentions/recall", round(p.m, 6) AS "mentions/precision", round(2 * r.m * p.m / (r.m + p.m), 6) AS "mentions/f1",
round(r.muc, 6) AS "muc/recall", round(p.muc, 6) AS "muc/precision", round(2 * r.muc * p.muc / (r.muc + p.muc), 6) AS "muc/f1",
round(r.b, 6) AS "bcub/recall", round(p.b, 6) AS "bcub/precision", round(2 * r.b * p.b / (r.b + p.b), 6) AS "bcub/f1",
round(r.lea, 6) AS "lea/recall", round(p.lea, 6) AS "lea/precision", round(2 * r.lea * p.lea / (r.lea + p.lea), 6) AS "lea/f1" FROM r, p""")
def coreference_scores(spark, sf):
    events = table(spark, sf, "events")
    doc = F.pmod("user_id", F.lit(5)).alias("doc")
    key = events.select(doc, F.col("user_id").alias("cluster"), F.col("event_id").alias("mention"))
    system = events.select(doc, F.pmod("user_id", F.lit(30)).alias("cluster"), F.col("event_id").alias("mention"))
    return rounded(coreference(key, system))


# --- reliability and distributions -----------------------------------------------------------

@query("""SELECT l_suppkey, round(quantile_cont(l_extendedprice, 0.1::DOUBLE), 4) AS p10, round(median(l_extendedprice), 4) AS p50,
round(quantile_cont(l_extendedprice, 0.95::DOUBLE), 4) AS p95 FROM lineitem GROUP BY 1""")
def exact_quantiles(spark, sf):
    out = group_quantiles(table(spark, sf, "lineitem"), "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p95": 0.95}, ["l_suppkey"])
    return rounded(out, 4)


def curves(spark, sf):
    return table(spark, sf, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("t"), "value")


OFFLINE_SQL = """c AS (SELECT user_id AS run, value AS x FROM events),
m AS (SELECT run, median(x) AS med, quantile_cont(x, 0.75::DOUBLE) - quantile_cont(x, 0.25::DOUBLE) AS iqr, stddev_pop(x) AS sd, quantile_cont(x, 0.05::DOUBLE) AS lo, quantile_cont(x, 0.95::DOUBLE) AS hi FROM c GROUP BY run),
d AS (SELECT c.run, median(abs(x - med)) AS mad, avg(x) FILTER (WHERE x <= lo) AS lcv, avg(x) FILTER (WHERE x >= hi) AS ucv FROM c JOIN m ON c.run = m.run GROUP BY c.run)"""


@query(f"""WITH {OFFLINE_SQL} SELECT m.run, round(iqr / med, 6) + 0.0 AS iqr_across_rollouts, round(mad / med, 6) + 0.0 AS mad_across_rollouts, round(sd / med, 6) + 0.0 AS stddev_across_rollouts,
round(lcv / med, 6) + 0.0 AS lower_cvar_across_rollouts, round(ucv / med, 6) + 0.0 AS upper_cvar_across_rollouts, round(med, 6) + 0.0 AS median_perf_across_rollouts FROM m JOIN d ON m.run = d.run""")
def reliability_offline(spark, sf):
    return rounded(offline_reliability(curves(spark, sf)))


ONLINE_SQL = """c AS (SELECT user_id AS run, event_id AS t, value AS x FROM events),
o AS (SELECT *, x - lag(x) OVER w AS d, max(x) OVER (PARTITION BY run ORDER BY t ROWS UNBOUNDED PRECEDING) - x AS dd FROM c WINDOW w AS (PARTITION BY run ORDER BY t)),
b AS (SELECT run, quantile_cont(x, 0.95::DOUBLE) - min_by(x, t) AS base FROM c GROUP BY run),
cut AS (SELECT run, quantile_cont(d, 0.05::DOUBLE) AS dl, quantile_cont(d, 0.95::DOUBLE) AS dh, quantile_cont(dd, 0.05::DOUBLE) AS wl, quantile_cont(dd, 0.95::DOUBLE) AS wh FROM o GROUP BY run),
tails AS (SELECT o.run, avg(d) FILTER (WHERE d <= dl) AS a1, avg(d) FILTER (WHERE d >= dh) AS a2, avg(dd) FILTER (WHERE dd <= wl) AS a3, avg(dd) FILTER (WHERE dd >= wh) AS a4, max(dd) AS mdd FROM o JOIN cut ON o.run = cut.run GROUP BY o.run),
ev AS (SELECT unnest([2500, 5000, 7500, 10000]) AS e),
win AS (SELECT run, e, quantile_cont(d, 0.75::DOUBLE) - quantile_cont(d, 0.25::DOUBLE) AS iqr, stddev_pop(d) AS sd FROM o, ev WHERE t <= e AND t > e - 2400 AND d IS NOT NULL GROUP BY run, e),
med AS (SELECT run, e, median(x) AS m FROM c, ev WHERE t <= e AND t > e - 2500 GROUP BY run, e),
acr AS (SELECT e, quantile_cont(m, 0.75::DOUBLE) - quantile_cont(m, 0.25::DOUBLE) AS iqr, stddev_pop(m) AS sd FROM med GROUP BY e)"""


@query(f"""WITH {ONLINE_SQL} SELECT (SELECT round(avg(iqr / nullif(base, 0)), 5) FROM win JOIN b ON win.run = b.run) + 0.0 AS iqr_within_runs, (SELECT round(avg(sd / nullif(base, 0)), 5) FROM win JOIN b ON win.run = b.run) + 0.0 AS stddev_within_runs,
round(avg(a1 / nullif(base, 0)), 5) + 0.0 AS lower_cvar_on_diffs, round(avg(a2 / nullif(base, 0)), 5) + 0.0 AS upper_cvar_on_diffs, round(avg(a3 / nullif(base, 0)), 5) + 0.0 AS lower_cvar_on_drawdown, round(avg(a4 / nullif(base, 0)), 5) + 0.0 AS upper_cvar_on_drawdown, round(avg(mdd), 5) + 0.0 AS max_drawdown,
(SELECT round(avg(iqr) / (SELECT avg(base) FROM b), 5) FROM acr) + 0.0 AS iqr_across_runs, (SELECT round(avg(sd) / (SELECT avg(base) FROM b), 5) FROM acr) + 0.0 AS stddev_across_runs, (SELECT round(avg(m), 5) FROM med) + 0.0 AS median_perf_during_training FROM tails JOIN b ON tails.run = b.run""")
def reliability_online(spark, sf):
    """Windowed dispersion, tail risks of changes and drawdown, and dispersion across runs."""
    out = online_reliability(curves(spark, sf), (2500, 5000, 7500, 10000), 2500, 2400, freq_thresh=None)
    return rounded(out.select("iqr_within_runs", "stddev_within_runs", "lower_cvar_on_diffs", "upper_cvar_on_diffs", "lower_cvar_on_drawdown",
                              "upper_cvar_on_drawdown", "max_drawdown", "iqr_across_runs", "stddev_across_runs", "median_perf_during_training"), 5)


@query("""WITH c AS (SELECT user_id AS run, event_id AS t, value AS x, row_number() OVER w - 1 AS j, count(*) OVER (PARTITION BY user_id) AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
f AS (SELECT run, n, k, sum(x * cos(2 * pi() * (j * k % n) / n)) AS re, -sum(x * sin(2 * pi() * (j * k % n) / n)) AS im FROM c, unnest(range(n)) u(k) GROUP BY run, n, k),
e AS (SELECT run, sum(re * re + im * im) FILTER (WHERE least(k, n - k) / n > 0.1) / sum(re * re + im * im) FILTER (WHERE k > 0) AS share FROM f GROUP BY run),
s AS (SELECT c.run, t, sum(re * cos(2 * pi() * (j * k % c.n) / c.n) - im * sin(2 * pi() * (j * k % c.n) / c.n)) / any_value(c.n) AS x FROM c JOIN f ON f.run = c.run AND least(k, c.n - k) / c.n <= 0.1 GROUP BY c.run, t),
b AS (SELECT avg(base) AS base FROM (SELECT quantile_cont(x, 0.95::DOUBLE) - min_by(x, t) AS base FROM c GROUP BY run)),
m AS (SELECT run, e, median(x) AS m FROM s, unnest([2500, 5000, 7500, 10000]) u(e) WHERE t <= e AND t > e - 2500 GROUP BY run, e),
a AS (SELECT e, quantile_cont(m, 0.75::DOUBLE) - quantile_cont(m, 0.25::DOUBLE) AS iqr, stddev_pop(m) AS sd FROM m GROUP BY e)
SELECT (SELECT round(avg(share), 6) FROM e) + 0.0 AS high_freq_energy_within_runs, (SELECT round(avg(iqr) / any_value(base), 5) FROM a, b) + 0.0 AS iqr_across_runs,
(SELECT round(avg(sd) / any_value(base), 5) FROM a, b) + 0.0 AS stddev_across_runs""")
def reliability_frequencies(spark, sf):
    """High-frequency energy of the curves, and dispersion across runs behind a low-pass filter."""
    out = online_reliability(curves(spark, sf), (2500, 5000, 7500, 10000), 2500, 2400, freq_thresh=0.1)
    return out.select(r("high_freq_energy_within_runs").alias("high_freq_energy_within_runs"),
                      *[r(c, 5).alias(c) for c in ("iqr_across_runs", "stddev_across_runs")])


@query()
def distribution_gap(spark, sf):
    """Divergence-frontier area between two halves of the embeddings (clustered, so no SQL form)."""
    vectors = table(spark, sf, "embeddings").select("label", F.col("embedding").alias("features"))
    return mauve(vectors.filter("label < 5"), vectors.filter("label >= 5"), num_buckets=20, redo=2, max_iter=50)
