import math
import random

import numpy as np
import pandas as pd
import pytest

from peakweave.functions.numeric import _incomplete_beta, correlation_p_value, t_two_sided
from peakweave.metrics import evaluate, get
from peakweave.metrics import classification as c
from peakweave.metrics import ranking as rk
from peakweave.metrics import regression as r
from peakweave.metrics.distances import coreference, mahalanobis


def pairs(spark, p, r, w=None, kind="double"):
    rows = [tuple(x) for x in (zip(p, r, w) if w else zip(p, r))]
    return spark.createDataFrame(rows, f"prediction {kind}, reference {kind}" + (", w double" if w else ""))


def test_regression_against_numpy(spark):
    p, q = np.array([1.5, -2.0, 4.25, 0.5, 3.0]), np.array([1.0, -1.0, 4.0, 0.25, 5.0])
    row = evaluate(pairs(spark, p.tolist(), q.tolist()), ["mse", "rmse", "metrics/mae", "mape", "smape", "r_squared"]).first()
    gap = np.abs(p - q)
    assert row.mse == pytest.approx((gap**2).mean())
    assert row.rmse == pytest.approx(math.sqrt((gap**2).mean()))
    assert row.mae == pytest.approx(gap.mean())
    assert row.mape == pytest.approx((gap / np.abs(q)).mean())
    assert row.smape == pytest.approx((2 * gap / (np.abs(p) + np.abs(q))).mean())
    assert row.r_squared == round(1 - (gap**2).sum() / ((q - q.mean()) ** 2).sum(), 3)


def test_mase(spark):
    p, q, series = [4.0, 1.0, 6.5], [3.0, 1.5, 5.0], [2.0, 4.0, 3.0, 7.0]
    training = spark.createDataFrame(list(enumerate(series)), "t int, value double")
    want = np.abs(np.subtract(p, q)).mean() / np.abs(np.diff(series)).mean()
    assert r.mase(pairs(spark, p, q), training, ["t"]).first().mase == pytest.approx(want)


def test_correlations(spark):
    p, q = [3.0, 1.0, 4.0, 1.5, 9.0, 2.0], [2.0, 7.0, 1.0, 8.0, 2.5, 6.0]
    row = evaluate(pairs(spark, p, q), ["pearsonr", "spearmanr", "mse"]).first()
    rank = lambda v: np.argsort(np.argsort(v))
    assert row.pearsonr == pytest.approx(np.corrcoef(p, q)[0, 1])
    assert row.spearmanr == pytest.approx(np.corrcoef(rank(p), rank(q))[0, 1])
    # the p-value is the tail of Student's t; its integral by the trapezoid rule
    for value, found in ((row.pearsonr, row["p-value"]), (row.spearmanr, row.spearmanr_pvalue)):
        t, free = abs(value) * math.sqrt(4 / (1 - value**2)), 4
        x = np.linspace(t, 4000, 4_000_001)
        density = math.gamma(2.5) / (math.sqrt(free * math.pi) * math.gamma(2)) * (1 + x * x / free) ** -2.5
        assert found == pytest.approx(2 * np.trapezoid(density, x), abs=1e-6)


def test_p_value_of_many_rows_follows_the_normal_tail():
    for n in (10**6, 10**10, 10**12):
        for t in (0.5, 1.96, 5.0):
            r_ = t / math.sqrt(n - 2 + t * t)
            found = correlation_p_value.func(pd.Series([r_]), pd.Series([n]))[0]
            assert found == pytest.approx(math.erfc(t / math.sqrt(2)), abs=1e-6 if n == 10**6 else 1e-9)
    both = [f(t, 10_000) for t in (0.3, 2.5) for f in (t_two_sided, lambda t, v: _incomplete_beta(v / 2, 0.5, v / (v + t * t)))]
    assert both[0] == pytest.approx(both[1], abs=1e-10) and both[2] == pytest.approx(both[3], abs=1e-10)


def test_grouped_evaluation_with_ties(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), float(rng.randrange(5)), float(rng.randrange(5))) for _ in range(80)]
    df = spark.createDataFrame(rows, "g string, prediction double, reference double")

    def ranks(v):
        s = sorted(v)
        return [s.index(x) + (s.count(x) + 1) / 2 for x in v]

    got = {x.g: x for x in evaluate(df, ["mae", "spearmanr"], ["g"]).collect()}
    for g in "ab":
        p, q = zip(*[(x, y) for h, x, y in rows if h == g])
        assert got[g].spearmanr == pytest.approx(np.corrcoef(ranks(p), ranks(q))[0, 1])
        assert got[g].mae == pytest.approx(np.mean(np.abs(np.subtract(p, q))))


def test_multioutput_and_loss(spark):
    p, q = [[1.0, 3.0], [2.5, -1.0], [0.0, 4.0]], [[2.0, 3.5], [2.0, -3.0], [0.5, 4.0]]
    df = spark.createDataFrame(list(zip(p, q)), "prediction array<double>, reference array<double>")
    squares, gaps = (np.subtract(p, q) ** 2).mean(axis=0), np.abs(np.subtract(p, q)).mean(axis=0)
    assert r.multioutput(df, "mse", aggregate="raw_values").first().value == pytest.approx(squares.tolist())
    assert r.multioutput(df, "mse").first().value == pytest.approx(squares.mean())
    assert r.multioutput(df, "mae", aggregate=[0.3, 0.7]).first().value == pytest.approx(gaps @ [0.3, 0.7])
    assert r.multioutput(df, "mse", squared=False).first().value == pytest.approx(np.sqrt(squares).mean())
    df = pairs(spark, [1.0, 2.0], [2.0, 4.0])
    msle = np.mean((np.log1p([1, 2]) - np.log1p([2, 4])) ** 2)
    row = evaluate(df, [get("msle"), get("mse_msle", alpha=1e-4, beta=5), get("mae_msle")]).first()
    assert (row.msle, row.mse_msle, row.mae_msle) == pytest.approx((msle, 1e-4 * 2.5 + 5 * msle, 3 + 10 * msle))
    loss = spark.createDataFrame([(1000.0,)], "loss double")
    assert evaluate(loss, ["perplexity"]).first().perplexity == math.inf


def test_classification_goldens(spark):
    df = pairs(spark, [0, 1, 1, 2, 1, 0], [0, 1, 2, 0, 1, 2], kind="int")
    assert evaluate(df, ["accuracy"]).first().accuracy == 0.5
    assert evaluate(df, [get("accuracy", normalize=False)]).first().accuracy == 3.0
    cells = {(x.reference, x.prediction): x.value for x in c.confusion_matrix(df).collect()}
    assert [[cells[i, j] for j in range(3)] for i in range(3)] == [[1, 0, 1], [0, 2, 0], [1, 1, 0]]
    rowwise = {(x.reference, x.prediction): x.value for x in c.confusion_matrix(df, normalize="true").collect()}
    assert rowwise[0, 0] == 0.5 and rowwise[0, 1] == 0
    df = pairs(spark, [0, 0, 1, 1, 0], [0, 1, 0, 1, 0], [0.9, 0.5, 3.9, 1.2, 0.3], kind="int")
    assert evaluate(df, ["f1", "precision"]).first().f1 == 0.5
    assert round(evaluate(df, [get("f1", pos_label=0)]).first().f1, 2) == 0.67
    assert round(evaluate(df, [get("f1", weight="w")]).first().f1, 2) == 0.35
    assert evaluate(df, [get("precision", weight="w")]).first().precision == pytest.approx(0.23529411764705882)
    df = pairs(spark, [0, 1, 0, 1, 1], [0, 0, 1, 1, 1], kind="int")
    assert evaluate(df, ["recall"]).first().recall == pytest.approx(0.6666666666666666)
    assert evaluate(df, [get("recall", pos_label=0)]).first().recall == 0.5
    df = pairs(spark, [1, 2, 2, 0, 3, 3], [1, 3, 2, 0, 3, 2], [0.5, 3.0, 1.0, 1.0, 1.0, 2.0], kind="int")
    assert round(evaluate(df, ["matthews_correlation"]).first().matthews_correlation, 2) == 0.54
    assert round(evaluate(df, [get("matthews_correlation", weight="w")]).first().matthews_correlation, 2) == 0.1


def test_averages_against_hand_counts(spark):
    df = pairs(spark, [0, 2, 1, 0, 0, 1], [0, 1, 2, 0, 1, 2], kind="int")
    macro = c.precision_recall_f1(df, "macro").first()
    assert macro.precision == pytest.approx(0.2222222)
    assert macro.f1 == pytest.approx(0.26666666)
    assert c.precision_recall_f1(df, "micro").first().f1 == pytest.approx(1 / 3)
    assert c.precision_recall_f1(df, "weighted").first().precision == pytest.approx(0.2222222)
    per = {x.label: x.precision for x in c.precision_recall_f1(df, None, zero_division=1).collect()}
    assert per == pytest.approx({0: 2 / 3, 1: 0.0, 2: 0.0})
    assert {x.label for x in c.precision_recall_f1(df, None, labels=[0, 7]).collect()} == {0, 7}
    multi = spark.createDataFrame([([1, 0, 1], [1, 1, 1]), ([0, 1, 0], [0, 1, 1])], "prediction array<int>, reference array<int>")
    assert c.precision_recall_f1(multi, "samples").first().recall == pytest.approx((2 / 3 + 1 / 2) / 2)
    assert c.precision_recall_f1(multi, "macro", multilabel=True).first().recall == pytest.approx((1 + 0.5 + 0.5) / 3)
    assert evaluate(multi, ["accuracy"]).first().accuracy == 0.0
    assert c.matthews_multilabel(multi, "macro").first().matthews_correlation == pytest.approx(1 / 3)


def test_brier(spark):
    df = spark.createDataFrame(list(zip([0.1, 0.9, 0.8, 0.3], ["spam", "ham", "ham", "spam"])), "prediction double, reference string")
    assert evaluate(df, [get("brier_score", pos_label="ham")]).first().brier_score == pytest.approx((.01 + .01 + .04 + .09) / 4)
    df = spark.createDataFrame(list(zip([0.1, 0.9, 0.8, 0.3], [0, 0, 1, 1])), "prediction double, reference int")
    assert evaluate(df, ["brier_score"]).first().brier_score == pytest.approx(0.3375)


SCORES = [[0.3, 0.5, 0.2], [0.7, 0.2, 0.1], [0.005, 0.99, 0.005], [0.2, 0.3, 0.5], [0.1, 0.1, 0.8], [0.1, 0.7, 0.2]]


def test_roc_auc(spark):
    df = spark.createDataFrame(list(zip([.5, .2, .99, .3, .1, .7], [1, 0, 1, 1, 0, 0])), "prediction double, reference int")
    assert round(rk.roc_auc(df).first().roc_auc, 2) == 0.78
    multi = spark.createDataFrame(list(zip(SCORES, [1, 0, 1, 2, 2, 0])), "prediction array<double>, reference int")
    assert round(rk.roc_auc(multi, "multiclass").first().roc_auc, 2) == 0.85
    label = [[1, 1, 0], [1, 1, 0], [0, 1, 0], [0, 0, 1], [0, 1, 1], [1, 0, 1]]
    df = spark.createDataFrame(list(zip(SCORES, label)), "prediction array<double>, reference array<int>")
    got = {x.label: round(x.roc_auc, 2) for x in rk.roc_auc(df, "multilabel", None).collect()}
    assert got == {0: 0.83, 1: 0.38, 2: 0.94}


def brute_auc(rows):
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_roc_auc_brute(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(12) / 10, int(rng.random() < 0.4)) for _ in range(120)]
    df = spark.createDataFrame(rows, "prediction double, reference int").repartition(5)
    assert rk.roc_auc(df).first().roc_auc == pytest.approx(brute_auc(rows))
    # the partial area by tracing the curve
    P, N = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    pts = [(0.0, 0.0)]
    for s in sorted({s for s, _ in rows}, reverse=True):
        pts.append((sum(1 for t, y in rows if t >= s and not y) / N, sum(1 for t, y in rows if t >= s and y) / P))
    m = 0.3
    grid = sorted({x for x, _ in pts if x <= m} | {m})
    xs, ys = [x for x, _ in pts], [y for _, y in pts]
    area = 0.0
    for (x0, y0), (x1, y1) in zip(pts, pts[1:]):
        if x0 < m and x1 > x0:
            xe = min(x1, m)
            ye = y0 + (y1 - y0) * (xe - x0) / (x1 - x0)
            area += (xe - x0) * (y0 + ye) / 2
    want = 0.5 * (1 + (area - m * m / 2) / (m - m * m / 2))
    assert rk.roc_auc(df, max_fpr=m).first().roc_auc == pytest.approx(want)
    multi = spark.createDataFrame(list(zip(SCORES, [1, 0, 1, 2, 2, 0])), "prediction array<double>, reference int")
    data = list(zip(SCORES, [1, 0, 1, 2, 2, 0]))
    total = []
    for a in range(3):
        for b in range(a + 1, 3):
            sub = [(s, y) for s, y in data if y in (a, b)]
            total.append((brute_auc([(s[a], y == a) for s, y in sub]) + brute_auc([(s[b], y == b) for s, y in sub])) / 2)
    assert rk.roc_auc(multi, "multiclass", multi_class="ovo").first().roc_auc == pytest.approx(np.mean(total))


def test_mean_iou_golden(spark):
    pred = [[[1, 2], [3, 4], [5, 255]], [[2, 7], [9, 2], [3, 6]], [[2, 2, 3], [8, 2, 4], [3, 255, 2]]]
    true = [[[0, 3], [5, 4], [6, 255]], [[1, 7], [9, 2], [3, 6]], [[1, 2, 2], [8, 2, 1], [3, 255, 1]]]
    df = spark.createDataFrame(list(zip(pred, true)), "prediction array<array<int>>, reference array<array<int>>")
    row = c.mean_iou(df, 10, 255).first()
    assert row.mean_iou == pytest.approx(0.4775)
    assert row.mean_accuracy == pytest.approx(0.5916666666666666)
    assert row.overall_accuracy == pytest.approx(0.5263157894736842)
    assert row.per_category_iou == pytest.approx([0, 0, .375, .4, .5, 0, .5, 1, 1, 1])
    assert row.per_category_accuracy == pytest.approx([0, 0, .75, 2 / 3, 1, 0, .5, 1, 1, 1])
    one = spark.createDataFrame([([[0, 1]], [[1, 2]])], "prediction array<array<int>>, reference array<array<int>>")
    assert c.mean_iou(one, 3, 255, reduce_labels=True).first().overall_accuracy == 1.0
    assert c.mean_iou(one, 4, 255, nan_to_num=-1.0).first().per_category_iou == [0.0, 0.0, 0.0, -1.0]
    assert c.mean_iou(one, 4, 255, label_map={1: 0, 2: 1}).first().overall_accuracy == 1.0


def test_mahalanobis_golden(spark):
    ref = spark.createDataFrame([([0.0, 1.0],), ([1.0, 0.0],)], "embedding array<double>")
    x = spark.createDataFrame([([0.0, 1.0],)], "embedding array<double>")
    assert mahalanobis(x, ref).first().mahalanobis == pytest.approx(0.5)
    with pytest.raises(ValueError):
        mahalanobis(x, x)


def test_trec_golden_and_brute(spark):
    run = spark.createDataFrame([(0, "doc_2", 1.5), (0, "doc_1", 1.2)], "query int, docid string, score double")
    qrels = spark.createDataFrame([(0, "doc_1", 2)], "query int, docid string, rel int")
    assert rk.trec_eval(run, qrels).first()["P@5"] == pytest.approx(0.2)
    rng = random.Random(11)
    score = {(q, d): rng.randrange(30) / 10 for q in range(4) for d in range(40) if rng.random() < 0.8}
    rel = {(q, d): rng.choice([0, 0, 1, 2]) for q in range(4) for d in range(40) if rng.random() < 0.6}
    run = spark.createDataFrame([(q, d, s) for (q, d), s in score.items()], "query int, docid int, score double").repartition(5)
    qrels = spark.createDataFrame([(q, d, v) for (q, d), v in rel.items()], "query int, docid int, rel int")
    got = {x.query: x for x in rk.trec_per_query(run, qrels).collect()}
    for q in range(4):
        docs = sorted((d for qq, d in score if qq == q), key=lambda d: (-score[q, d], -d))
        gains = [rel.get((q, d), 0) for d in docs]
        R = sum(v > 0 for (qq, _), v in rel.items() if qq == q)
        N = sum(v == 0 for (qq, _), v in rel.items() if qq == q)
        hits, ap, bp, miss = 0, 0.0, 0.0, 0
        for i, d in enumerate(docs, 1):
            if gains[i - 1] > 0:
                hits += 1
                ap += hits / i
                bp += 1 - min(miss, R) / min(R, N)
            elif (q, d) in rel:
                miss += 1
        ideal = sorted((v for (qq, _), v in rel.items() if qq == q), reverse=True)
        ndcg = sum(g / math.log2(i + 2) for i, g in enumerate(gains[:10])) / sum(g / math.log2(i + 2) for i, g in enumerate(ideal[:10]))
        assert got[q].map == pytest.approx(ap / R)
        assert got[q].bpref == pytest.approx(bp / R)
        assert got[q]["NDCG@10"] == pytest.approx(ndcg)
        assert got[q].Rprec == pytest.approx(sum(g > 0 for g in gains[:R]) / R)
        assert got[q].recip_rank == pytest.approx(1 / (1 + next(i for i, g in enumerate(gains) if g > 0)))


def test_contrastive(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(6, 4)), rng.normal(size=(6, 4))
    left = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(a)], "i int, embedding array<double>")
    right = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(b)], "i int, embedding array<double>")
    left, right = rk.with_batch(left, 3, "i"), rk.with_batch(right, 3, "i")
    row = rk.retrieval_accuracy(left, right).first()
    sims = [a[k:k + 3] @ b[k:k + 3].T for k in (0, 3)]
    assert row.seq_acc == pytest.approx(np.mean([s.argmax(1) == np.arange(3) for s in sims]))
    assert row.scrna_acc == pytest.approx(np.mean([s.argmax(0) == np.arange(3) for s in sims]))
    got = {x.batch: x.clip_loss for x in rk.clip_loss(left, right, 0.5).collect()}
    for k, s in enumerate(sims):
        s = s * np.exp(0.5)
        rows = -np.mean(np.diag(s) - np.log(np.exp(s).sum(1)))
        cols = -np.mean(np.diag(s) - np.log(np.exp(s).sum(0)))
        assert got[k] == pytest.approx((rows + cols) / 2)


@pytest.mark.parametrize("block", [3, 100])
def test_precision_at_k(spark, block):
    rng = np.random.default_rng(4)
    a = rng.normal(size=(20, 5))
    b = a + rng.normal(size=(20, 5)) * 1.2
    left = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(a)], "id int, embedding array<double>")
    right = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(b)], "id int, embedding array<double>")
    x, y = a - a.mean(0), b - b.mean(0)
    sims = (x / np.linalg.norm(x, axis=1)[:, None]) @ (y / np.linalg.norm(y, axis=1)[:, None]).T
    want = np.mean([i in np.argsort(-s)[:3] for i, s in enumerate(sims)])
    assert rk.precision_at_k(left, right, k=3, stripe=block).first()["precision@3"] == pytest.approx(want)


def test_pass_at_k(spark):
    rows = [("a", i < 3) for i in range(10)] + [("b", i < 1) for i in range(10)] + [("c", False) for _ in range(10)]
    got = rk.pass_at_k(spark.createDataFrame(rows, "task_id string, passed boolean"), ks=(1, 5, 20)).first()
    want = lambda k: np.mean([1 - math.comb(10 - c_, k) / math.comb(10, k) for c_ in (3, 1, 0)])
    assert got["pass@1"] == pytest.approx(want(1))
    assert got["pass@5"] == pytest.approx(want(5))
    assert got["pass@20"] is None


def test_coreference(spark):
    schema = "doc string, cluster int, mention string"
    key = spark.createDataFrame([("d", 1, m) for m in "abc"] + [("d", 2, m) for m in "defg"], schema)
    system = spark.createDataFrame([("d", 1, m) for m in "ab"] + [("d", 2, m) for m in "cd"] + [("d", 3, m) for m in "fghi"], schema)
    row = coreference(key, system).first()
    # worked example of the link-based evaluation paper
    assert row["muc/recall"] == pytest.approx(0.4)
    assert row["muc/precision"] == pytest.approx(0.4)
    assert row["bcub/recall"] == pytest.approx((4 / 3 + 1 / 3 + 1 / 4 + 4 / 4) / 7)
    assert row["bcub/precision"] == pytest.approx((4 / 2 + 1 / 2 + 1 / 2 + 4 / 4) / 8)
    assert row["lea/recall"] == pytest.approx((3 * (1 / 3) + 4 * (1 / 6)) / 7)
    assert row["lea/precision"] == pytest.approx((2 * 1 + 2 * 0 + 4 * (1 / 6)) / 8)
    same = coreference(key, key).first()
    assert all(v == 1.0 for v in same)
