import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from peakweave.functions.ngrams import reference_grams, shared_grams
from peakweave.functions.text import word_edit_distance
from peakweave.metrics import textgen as tg

ORDER = 5


def grams(tokens, n):
    return Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))


def texts(alphabet):
    pick = random.Random(len(alphabet))
    some = lambda: None if pick.random() < 0.1 else [pick.choice(alphabet) for _ in range(pick.randrange(25))]
    rows = [(k, some(), [some() for _ in range(pick.randrange(4))]) for k in range(60)]
    long = [pick.choice(alphabet) for _ in range(2000)]
    return [*rows, (60, long, [long[100:], long[:50] * 3])]


@pytest.mark.parametrize("alphabet", [list("abc"), [f"w{k}" for k in range(3000)], ["é", "😀", "b", "\n"]])
def test_shared_grams(spark, alphabet):
    rows = texts(alphabet)
    df = spark.createDataFrame(rows, "id int, hyp array<string>, refs array<array<string>>").repartition(2)
    found = {r.id: r for r in df.select("id", shared_grams(F.col("hyp"), F.col("refs"), ORDER).alias("s"),
                                        reference_grams(F.col("hyp"), F.col("refs"), ORDER).alias("g")).collect()}
    for k, hyp, refs in rows:
        hyp, refs, got = hyp or [], [r or [] for r in refs], found[k]
        spelled = {}
        for n in range(1, ORDER + 1):
            mine, theirs = grams(hyp, n), [grams(r, n) for r in refs]
            assert [e[n - 1] for e in got.s.each] == [(mine & t).total() for t in theirs]
            most = Counter()
            for t in theirs:
                most |= t
                for g in t:
                    spelled[n, " ".join(g)] = (sum(x[g] for x in theirs), [(i, min(mine[g], x[g])) for i, x in enumerate(theirs) if x[g] and mine[g]])
            assert got.s.most[n - 1] == (mine & most).total()
        assert {(g.order, g.gram): (g.n, [tuple(h) for h in g.hits]) for g in got.g} == spelled
    if len(alphabet) < 10:
        joined = df.select("id", F.array_join("hyp", "").alias("hyp"), F.transform("refs", lambda r: F.array_join(r, "")).alias("refs"))
        for r in joined.select("id", shared_grams(F.col("hyp"), F.col("refs"), ORDER, characters=True).alias("s")).collect():
            assert r.s == found[r.id].s


@pytest.mark.parametrize("score", [tg.chrf, tg.bleu, tg.sacrebleu, tg.google_bleu])
def test_grams_are_no_rows(spark, score):
    """N-grams are counted inside a text's row: none is exploded, and the texts are dealt out once."""
    df = spark.createDataFrame([(1, "a b", ["a c", "b"])], "id int, prediction string, references array<string>")
    plan = score(df, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("RepartitionByExpression") == 1


def test_nist_with_one_and_several_references(spark):
    """A second reference equal to the first changes the counts of the corpus alike for words and n-grams, not the score."""
    pairs = [("a red kite rises", "a red kite climbs"), ("two small boats cross", "two boats cross the lake"), ("", "x"), ("p q", "p q")]
    rows = [(k, p, [r], [r, r]) for k, (p, r) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "id int, prediction string, one array<string>, two array<string>")
    one, two = (tg.nist(df.withColumnRenamed(c, "references"), "id").first().nist_mt for c in ("one", "two"))
    assert one == pytest.approx(two) and one > 0
    mixed = df.select("id", "prediction", F.array("id").alias("grp"), F.when(F.col("id") < 2, F.col("one")).otherwise(F.array(
        F.col("one")[0], F.lit(""))).alias("references"))
    assert tg.nist(mixed, "id").first().nist_mt == pytest.approx(one)


def test_edit_distance_keeps_lists_in_arrow(spark):
    """Token lists reach the function as Arrow arrays, not as a frame of Python strings."""
    assert word_edit_distance.evalType == F.arrow_udf("int")(lambda x: x).evalType
    df = spark.createDataFrame([(["a", "b"], ["a", "c", "d"]), ([], ["x"])], "a array<string>, b array<string>")
    assert [r.d for r in df.select(word_edit_distance("a", "b").alias("d")).collect()] == [2, 1]
