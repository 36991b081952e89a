"""Null groups, absent classes, repeated ids, constant groups and zero denominators."""

import pytest
from pyspark.sql import functions as F

from peakweave.metrics import evaluate, get, qa
from peakweave.metrics import ranking as rk
from peakweave.metrics import textgen as tg
from peakweave.metrics import regression as r
from peakweave.operators import joins
from peakweave.operators.quantiles import median_absolute_deviation
from peakweave.sources.matrix import read_wide_matrix


def test_every_group_has_one_row(spark):
    rows = [(None, 1, 1), (None, 0, 1), (None, 3, 2), ("a", 2, 2), ("a", 2, 2), ("one", 1, 0)]
    df = spark.createDataFrame(rows, "g string, prediction int, reference int")
    metrics = ["accuracy", "precision", "recall", "f1", "r_squared", "mse", "spearmanr", "pearsonr", get("roc_auc", pos_label=1),
               "matthews_correlation"]
    found = {x.g: x for x in evaluate(df, metrics, ["g"]).collect()}
    assert set(found) == {None, "a", "one"} and evaluate(df, metrics, ["g"]).count() == 3
    assert found[None].recall == 0.5 and found["a"].f1 == 0.0  # class 1 never occurs in a
    assert found["a"].r_squared is None and found["a"].mse == 0.0 and found["a"].roc_auc is None
    assert found[None].spearmanr is not None and found["one"].spearmanr is None
    assert evaluate(df.filter("g = 'a'"), ["accuracy", "f1"]).first().f1 == 0.0


def test_degenerate_denominators_are_null(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 0.0), ("b", 1.0, 2.0, 1.0)], "g string, prediction double, reference double, w double")
    found = {x.g: x.mse for x in evaluate(df, [get("mse", weight="w")], ["g"]).collect()}
    assert found == {"a": None, "b": 1.0}
    tokens = spark.createDataFrame([("x", 1.0, 0), ("x", 2.0, 0), ("y", 0.0, 1)], "t string, nll double, m int")
    per = {x.t: x.perplexity for x in r.text_perplexity(tokens, "t", mask="m").collect()}
    assert per == {"x": None, "y": 1.0}
    assert r.corpus_perplexity(tokens, "t", mask="m").first().mean_perplexity == 1.0
    one_class = spark.createDataFrame([("a", 0.5, True, 1.0), (None, 0.2, True, 1.0), (None, 0.9, False, 1.0)],
                                      "g string, score double, positive boolean, w double")
    areas = {x.g: x.roc_auc for x in rk.auc(one_class, ["g"], max_fpr=0.5).collect()}
    assert areas["a"] is None and areas[None] is not None


def test_median_deviation_of_a_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 5.0), ("a", 2.0)], "g string, v double")
    assert {x.g: x.mad for x in median_absolute_deviation(df, "v", ["g"]).collect()} == {None: 2.0, "a": 0.0}


def test_the_last_of_two_predictions_counts(spark):
    preds = spark.createDataFrame([("q", "wrong", 1), ("q", "right answer", 2)], "id string, prediction string, at int")
    refs = spark.createDataFrame([("q", ["right answer"])], "id string, answers array<string>")
    row = qa.squad(preds, refs, last_by="at").first()
    assert (row.exact_match, row.f1) == (100.0, 100.0)
    with pytest.raises(Exception, match="two predictions"):
        qa.squad(preds, refs).collect()


def test_lookups_refuse_repeated_keys(spark):
    matrix = spark.createDataFrame([("s", "p", 1.0), ("s", "p", 2.0)], "sample string, pos string, value double")
    with pytest.raises(Exception, match="twice"):
        joins.matrix_lookup(spark.createDataFrame([("s", "p")], "sample string, pos string"), matrix).collect()
    rows = spark.createDataFrame([(1, "x")], "record_id int, y string")
    twice = spark.createDataFrame([(1, 0.5), (1, 0.6)], "record_id int, p double")
    with pytest.raises(Exception, match="two predictions"):
        joins.realign(twice, rows).collect()


def test_wide_matrix_missing_cells_and_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("sample,p1,p2\ns1,1.5,NA\ns2,,2\n")
    (tmp_path / "b.csv").write_text("sample,p2,p1\r\ns3,7,nan\r\n")
    rows = read_wide_matrix(spark, str(tmp_path)).collect()
    assert {(x.sample, x.pos): x.value for x in rows} == {
        ("s1", "p1"): 1.5, ("s1", "p2"): None, ("s2", "p1"): None, ("s2", "p2"): 2.0, ("s3", "p2"): 7.0, ("s3", "p1"): None}
    (tmp_path / "c.csv").write_text("sample,p1\ns4,abc\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_wide_matrix(spark, str(tmp_path / "c.csv")).collect()


def test_group_join_keeps_nulls_on_both_sides(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "g string, a int")
    b = spark.createDataFrame([(None, 3), ("y", 4)], "g string, b int")
    full = {x.g: (x.a, x.b) for x in joins.join_groups(a, b, ["g"], "full").collect()}
    assert full == {None: (1, 3), "x": (2, None), "y": (None, 4)}
    assert joins.join_groups(a, b.select(F.max("b").alias("b")), []).count() == 2


def test_corpus_metrics_by_name(spark):
    texts = spark.createDataFrame([(1, "a small red kite flies", ["a small red kite flies"], "a kite")],
                                  "id int, prediction string, references array<string>, source string")
    for name, column in (("bleu", "bleu"), ("google_bleu", "google_bleu"), ("rouge", "rouge1")):
        assert evaluate(texts, [name]).first()[column] == pytest.approx(1.0)
    assert evaluate(texts, ["sacrebleu"]).first().score == pytest.approx(100)
    answers = spark.createDataFrame([(1, "kite", ["a kite"])], "id int, prediction string, answers array<string>")
    assert evaluate(answers, ["squad"]).first().exact_match == 100.0
    run = spark.createDataFrame([(1, 5, 0.5, 1), (1, 6, 0.4, None)], "query int, docid int, score double, rel int")
    assert evaluate(run, ["trec_eval"]).first()["P@5"] == pytest.approx(0.2)
    with pytest.raises(ValueError, match="whole corpus"):
        evaluate(answers, ["squad_v2"], ["id"])
    assert [tuple(x)[:2] for x in evaluate(texts, ["bleu"], ["source"]).collect()] == [("a kite", pytest.approx(1.0))]


def test_texts_that_share_an_id_are_texts_of_their_own(spark):
    schema = "id int, prediction string, references array<string>, source string, grp string"
    rows = [(1, "a small red kite flies", ["a small red bird flies", "one"], "a kite", "x"), (1, "two boats cross the lake", ["two boats cross a lake", "two"], "boats", "x"),
            (None, "the lake at dawn is still", ["the lake at dawn", "still"], "lake", "y"), (1, "a small red kite flies", ["a small red bird flies", "one"], "a kite", None)]
    shared = spark.createDataFrame(rows, schema)
    own = spark.createDataFrame([(k, *r[1:]) for k, r in enumerate(rows)], schema)
    def flat(row, first=0):
        return [x for v in tuple(row)[first:] for x in (v if isinstance(v, list) else [v])]

    for score in (tg.bleu, tg.sacrebleu, tg.google_bleu, tg.chrf, tg.rouge, tg.sari, tg.nist, tg.wiki_split):
        assert flat(score(shared, "id").first()) == pytest.approx(flat(score(own, "id").first())), score.__name__
        groups = {r.grp: r for r in score(shared, "id", by=["grp"]).collect()}
        assert set(groups) == {"x", "y", None}
        alone = score(own.filter("grp = 'x'"), "id").first()
        assert flat(groups["x"], 1) == pytest.approx(flat(alone)), score.__name__
    assert tg.rouge_rows(shared, "id", ("rouge1",)).count() == 4 and tg.sari_rows(shared, "id").count() == 4


def test_gleu_of_two_texts_under_one_id(spark):
    rows = [(1, "a b c d", "a b c x"), (1, "a b c d", "a b c x")]
    df = spark.createDataFrame(rows, "id int, prediction string, reference string")
    assert tg.google_bleu(df, "id").first().google_bleu == pytest.approx(6 / 10)


def test_questions_that_share_an_id_count_each(spark):
    preds = spark.createDataFrame([("q", "right answer", 0.1), ("r", "x", 0.2)], "id string, prediction string, no_answer_probability double")
    refs = spark.createDataFrame([("q", ["right answer"]), ("q", ["right answer", "x"]), ("s", ["y"])], "id string, answers array<string>")
    assert tuple(qa.squad(preds, refs).first()) == pytest.approx((200 / 3, 200 / 3))
    assert tuple(qa.squad(preds, refs.limit(2)).first()) == pytest.approx((100.0, 100.0))
    row = qa.squad_v2(preds, refs).first()
    assert (row.exact, row.f1, row.total) == (pytest.approx(200 / 3), pytest.approx(200 / 3), 3)
    spans = spark.createDataFrame([("a", ["x y"], 1), ("a", ["x y"], 2), ("a", ["q"], 3)], "id string, prediction array<string>, at int")
    gold = spark.createDataFrame([("a", ["x y"]), ("b", ["z"])], "id string, answers array<string>")
    with pytest.raises(Exception, match="two predictions"):
        qa.cuad(spans, gold).collect()
    assert qa.cuad(spans.withColumn("at", -F.col("at")), gold, last_by="at").first().exact_match == 50.0


def test_metrics_of_one_pass(spark, tmp_path):
    """Four corpus metrics by group scan the file once and give what each gives alone."""
    rows = [(k, f"the {a} kite flies over {b} hills", [f"the {b} kite flies over {a} hills", "a kite"], k % 2) for k, (a, b) in enumerate(["xy", "yz", "xx", "zz"])]
    spark.createDataFrame(rows, "id int, prediction string, references array<string>, grp int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    together = evaluate(df, ["bleu", "sacrebleu", "google_bleu", "nist_mt"], ["grp"])
    found = {r.grp: r for r in together.collect()}
    executed = together._jdf.queryExecution().executedPlan().toString()
    final = executed.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1
    for name, column in (("bleu", "bleu"), ("sacrebleu", "score"), ("google_bleu", "google_bleu"), ("nist_mt", "nist_mt")):
        for r in evaluate(df, [name], ["grp"]).collect():
            assert found[r.grp][column] == pytest.approx(r[column])
    assert found[0]["sacrebleu_precisions"] == pytest.approx([100 * p for p in found[0]["precisions"]])
    assert evaluate(df, [get("bleu", max_order=2), "sacrebleu"]).first().bleu == pytest.approx(tg.bleu(df, "id", 2).first().bleu)


def test_every_metric_has_its_name(spark):
    pairs = spark.createDataFrame([(1, 1, "q"), (0, 1, "q")], "prediction int, reference int, question string")
    assert evaluate(pairs, [get("glue", task="sst2")]).first().accuracy == 0.5
    assert evaluate(pairs, [get("super_glue", task="boolq")]).first().accuracy == 0.5
    assert evaluate(pairs, ["xnli"]).first().accuracy == evaluate(pairs, [get("indic_glue", task="wnli")]).first().accuracy == 0.5
    assert evaluate(pairs, [get("xtreme_s", task="fleurs-lang_id")]).first().accuracy == 0.5
    series = spark.createDataFrame([("a", t, float(t * t)) for t in range(5)], "s string, t int, value double")
    errors = spark.createDataFrame([("a", 1.0, 3.0)], "s string, prediction double, reference double")
    assert evaluate(errors, [get("metrics/mase", training=series, order_by=["t"])], ["s"]).first().mase == pytest.approx(2 / 4)
    vectors = spark.createDataFrame([([0.0, 1.0],), ([1.0, 0.0],), ([2.0, 2.0],)], "embedding array<double>")
    assert evaluate(vectors, [get("mahalanobis", reference=vectors)]).count() == 3
    mentions = spark.createDataFrame([("d", 1, "a"), ("d", 1, "b")], "doc string, cluster int, mention string")
    assert evaluate(mentions, [get("coval", system=mentions)]).first()["muc/recall"] == 1.0
    runs = spark.createDataFrame([(1, t, float(t)) for t in range(9)], "run int, t int, value double")
    assert evaluate(runs, [get("rl_reliability", config="offline")]).first().median_perf_across_rollouts == 4.0
