import math
import os
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from peakweave.metrics import evaluate
from peakweave.metrics import textgen as tg
from peakweave.operators import gram_counts
from peakweave.operators.gram_counts import reference_gains

ORDER = 4


def grams(tokens, n):
    return Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))


def expected(rows, order):
    """(group, order): gain, den, h, r."""
    sums = {}
    for group in {r[0] for r in rows}:
        own = [(hyp or [], [r or [] for r in refs]) for g, hyp, refs in rows if g == group and refs]
        counts = [Counter() for _ in range(order + 1)]
        for _, refs in own:
            for r in refs:
                counts[0][()] += len(r)
                for n in range(1, order + 1):
                    counts[n] += grams(r, n)
        for n in range(1, order + 1) if own else ():
            best = [max((sum(math.log2(counts[n - 1][g[:-1]] / counts[n][g]) * c for g, c in sorted((grams(hyp, n) & grams(r, n)).items())), len(r))
                        for r in refs) for hyp, refs in own]
            sums[group, n] = (sum(b[0] for b in best), sum(max(len(hyp) - n + 1, 0) for hyp, _ in own),
                              sum(len(hyp) for hyp, _ in own), sum(b[1] for b in best))
    return sums


@pytest.mark.parametrize("words", [3, 40, 3000])
@pytest.mark.parametrize("block", [1, 60, 1 << 20])
def test_gains_by_brute_force(spark, words, block):
    """Blocks of one text and of all, owners of many n-grams, null sides, texts without references, null as a group."""
    pick = random.Random(words)
    some = lambda: None if pick.random() < 0.1 else [f"é{pick.randrange(words)}" for _ in range(pick.randrange(14))]
    rows = [(pick.choice([None, "a", "b c"]), some(), [some() for _ in range(pick.randrange(4))]) for _ in range(80)]
    rows += [rows[0], (None, ["x"] * 300, [["x"] * 200, ["x", "y"] * 70]), ("none", ["x"], [])]
    df = spark.createDataFrame(rows, "grp string, hyp array<string>, refs array<array<string>>").repartition(3, F.length("grp"))
    df = df.sortWithinPartitions(*df.columns)
    for order in (1, 2, ORDER):
        found = {(r.grp, r.order): (r.gain, r.den, r.h, r.r) for r in reference_gains(df, ["grp"], order, block, owners=5).collect()}
        want = expected(rows, order)
        assert found.keys() == want.keys()
        for k, sums in want.items():
            assert found[k] == pytest.approx(sums)
    whole = {r.order: r.gain for r in reference_gains(df, [], ORDER, block, owners=5).collect()}
    assert whole == pytest.approx({n: s[0] for (_, n), s in expected([(0, *r[1:]) for r in rows], ORDER).items()})


def test_groups_of_any_type(spark):
    """Negative zero is zero, and a time keeps its zone."""
    rows = [(0.0, ["a", "b"], [["a", "b"]]), (-0.0, ["a", "c"], [["a", "c"]]), (float("nan"), ["a"], [["a", "z"]])]
    df = spark.createDataFrame(rows, "grp double, hyp array<string>, refs array<array<string>>").repartition(1).sortWithinPartitions("hyp")
    gains = {str(r.grp): r.gain for r in reference_gains(df, ["grp"], 2).filter("order = 2").collect()}
    assert gains == pytest.approx({"0.0": 2.0, "nan": 0.0})
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        times = df.select(F.expr("array(struct(timestamp'2020-01-01 12:00:00' as t))").alias("grp"), "hyp", "refs")
        assert reference_gains(times, ["grp"], 1).select(F.col("grp")[0].t.cast("string")).first()[0] == "2020-01-01 12:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_references_that_gain_the_same(spark):
    """The longer counts, whatever the order in which its n-grams stand."""
    hyp = [f"w{k}" for k in range(60)]
    back = [w for k in range(0, 60, 2) for w in (hyp[k + 1], hyp[k])]
    rows = [(hyp, [hyp[::-1], [*back, "q"], hyp[::-1]])] + [([], [hyp[:k]]) for k in range(60)]
    df = spark.createDataFrame(rows, "hyp array<string>, refs array<array<string>>").repartition(1).sortWithinPartitions("hyp")
    assert reference_gains(df, [], 1).first().r == 61 + sum(range(60))


def test_grams_are_packed():
    """A block's questions and what is kept of it are a few times its text, not a hundred times."""
    pick = random.Random(1)
    vocabulary = ["".join(pick.choice("abcdefghij") for _ in range(3 + int(pick.expovariate(0.3)))) for _ in range(2000)]
    texts = [[vocabulary[min(int(pick.expovariate(0.005)), 1999)] for _ in range(80)] for _ in range(400)]
    table = pa.table({"hyp": texts, "refs": [[t[:70], t[5:]] for t in texts]})
    asked = list(gram_counts._asked(table, [], 5, 16, 0))
    size = sum(len(w) + 1 for t in texts for w in [*t[:70], *t[5:]])
    assert sum(len(data) for _, _, data, _ in asked) < 4 * size
    windows = sum(len(gram_counts._unpacked(data)[1]) for _, kind, data, _ in asked if kind == 2)
    assert 0 < windows <= 400 * 145


def test_report_writes_no_grams(spark):
    """Four metrics deal the texts out once each at most, make no row of an n-gram and leave nothing in the shared folder."""
    kept = lambda: sum(len(f) for _, _, f in os.walk(spark.conf.get("spark.checkpoint.dir")))
    df = spark.createDataFrame([(k, k % 2, "a b c", ["a b", "b c d"]) for k in range(20)], "id int, grp int, prediction string, references array<string>")
    before = kept()
    out = evaluate(df, ["bleu", "sacrebleu", "google_bleu", "nist_mt"], ["grp"])
    assert len(out.collect()) == 2 and kept() == before
    for plan in (out, tg.nist(df, "id")):
        plan = plan._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and plan.count("RepartitionByExpression [__h") <= 2
