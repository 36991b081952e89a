import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from peakweave.functions import text as tx
from peakweave.metrics import evaluate, get
from peakweave.metrics import qa, tagging
from peakweave.metrics import textgen as tg
from peakweave.metrics.benchmarks import glue, super_glue, xtreme_s


def texts(spark, preds, refs, sources=None):
    rows = [(i, p, r, (sources or preds)[i]) for i, (p, r) in enumerate(zip(preds, refs))]
    return spark.createDataFrame(rows, "id int, prediction string, references array<string>, source string")


def pair(spark, preds, refs):
    return spark.createDataFrame(list(zip(preds, refs)), "prediction string, reference string")


def test_tokenize_13a(spark):
    df = spark.createDataFrame([("It's 3.5, a&amp;b <skipped>x-\ny 1-2.",)], "t string")
    assert df.select(tx.tokenize_13a("t").alias("x")).first().x == ["It's", "3.5", ",", "a", "&", "b", "xy", "1", "-", "2", "."]


def grams(words, n):
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


HYPS = ["a red kite rises over the wet field", "two small boats cross the lake at dawn and return"]
REFS = [["a red kite climbs over the wet green field", "the red kite rises above the field"],
        ["two boats cross the lake at first light", "at dawn two small boats cross the lake and come back"]]


def plain_bleu(hyps, refs, closest):
    """Corpus BLEU of order 4 over space-separated words; the reference length is the shortest or the closest one."""
    match, total, hyp_len, ref_len = [0] * 4, [0] * 4, 0, 0
    for h, rs in zip(hyps, refs):
        h, rs = h.split(), [r.split() for r in rs]
        hyp_len += len(h)
        ref_len += min((abs(len(r) - len(h)), len(r)) if closest else (len(r), len(r)) for r in rs)[1]
        for n in range(1, 5):
            best = Counter()
            for r in rs:
                best |= grams(r, n)
            match[n - 1] += sum((grams(h, n) & best).values())
            total[n - 1] += max(0, len(h) - n + 1)
    bp = 1.0 if hyp_len > ref_len else math.exp(1 - ref_len / hyp_len)
    return bp * math.exp(sum(math.log(m / t) for m, t in zip(match, total)) / 4), hyp_len, ref_len


def test_bleu(spark):
    row = tg.bleu(texts(spark, HYPS, REFS), "id").first()
    want, hyp_len, ref_len = plain_bleu(HYPS, REFS, closest=False)
    assert row.bleu == pytest.approx(want)
    assert (row.translation_length, row.reference_length) == (hyp_len, ref_len)
    row = tg.bleu(texts(spark, HYPS, [[h] for h in HYPS]), "id").first()
    assert row.bleu == pytest.approx(1.0)
    assert tg.bleu(texts(spark, HYPS, REFS).limit(0), "id").count() == 1  # an empty corpus is no error


def test_sacrebleu(spark):
    row = tg.sacrebleu(texts(spark, HYPS, REFS), "id").first()
    assert row.score == pytest.approx(100 * plain_bleu(HYPS, REFS, closest=True)[0])
    uneven = texts(spark, ["a", "b"], [["a"], ["b", "c"]])
    with pytest.raises(Exception, match="same number"):
        tg.sacrebleu(uneven, "id").collect()


@pytest.mark.parametrize("lo,hi", [(1, 4), (2, 4), (2, 6)])
@pytest.mark.parametrize("n_refs", [1, 2])
def test_google_bleu(spark, n_refs, lo, hi):
    refs = [r[:n_refs] for r in REFS]
    hits = most = 0
    for h, rs in zip(HYPS, refs):
        options = []
        for r in rs:
            h_grams, r_grams = Counter(), Counter()
            for n in range(lo, hi + 1):
                h_grams += grams(h.split(), n)
                r_grams += grams(r.split(), n)
            same, larger = sum((h_grams & r_grams).values()), max(sum(h_grams.values()), sum(r_grams.values()))
            options.append((same / larger, same, larger))
        best = max(options, key=lambda o: o[0])
        hits, most = hits + best[1], most + best[2]
    assert tg.google_bleu(texts(spark, HYPS, refs), "id", lo, hi).first().google_bleu == pytest.approx(hits / most)


@pytest.mark.parametrize("word_order", [0, 2])
@pytest.mark.parametrize("lowercase", [False, True])
def test_chrf(spark, word_order, lowercase):
    hyps, refs = ["The Kite rises", "small boats cross the lake"], ["the kite climbs up", "two small boats cross a lake"]
    precision, recall = [], []
    for kind, orders in (("chars", 6), ("words", word_order)):
        for n in range(1, orders + 1):
            same = h_total = r_total = 0
            for h, r in zip(hyps, refs):
                h, r = (x.lower() if lowercase else x for x in (h, r))
                h, r = (list(x.replace(" ", "")) if kind == "chars" else x.split() for x in (h, r))
                same += sum((grams(h, n) & grams(r, n)).values())
                h_total, r_total = h_total + sum(grams(h, n).values()), r_total + sum(grams(r, n).values())
            precision.append(same / h_total)
            recall.append(same / r_total)
    p, r = sum(precision) / len(precision), sum(recall) / len(recall)
    row = tg.chrf(texts(spark, hyps, [[x] for x in refs]), "id", word_order=word_order, lowercase=lowercase).first()
    assert row.score == pytest.approx(100 * 5 * p * r / (4 * p + r))


def test_rouge(spark):
    assert list(tg.rouge(texts(spark, HYPS, [[h] for h in HYPS]), "id").first()) == [pytest.approx(1.0)] * 4
    # five of the six words of the prediction are in the reference of seven, all in its order
    row = tg.rouge(texts(spark, ["an owl sat\nby the barn"], [["an owl was\nsat by a barn the", "x"]]), "id").first()
    assert row.rouge1 == pytest.approx(2 * 1 * (6 / 8) / (1 + 6 / 8))


def test_alignment_helpers_against_tables():
    rng = random.Random(9)
    for _ in range(60):
        a = [rng.choice("abcd") for _ in range(rng.randrange(9))]
        b = [rng.choice("abcd") for _ in range(rng.randrange(9))]
        e = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        lcs = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                same = a[i - 1] == b[j - 1]
                e[i][j] = min(e[i - 1][j] + 1, e[i][j - 1] + 1, e[i - 1][j - 1] + (not same))
                lcs[i][j] = lcs[i - 1][j - 1] + 1 if same else max(lcs[i - 1][j], lcs[i][j - 1])
        assert tx.edit_counts(a, b) == e[-1][-1]
        assert tx.lcs_size(a, b) == lcs[-1][-1]
        i, j, want = len(a), len(b), set()
        while i and j:
            if a[i - 1] == b[j - 1]:
                want.add(i - 1)
                i, j = i - 1, j - 1
            elif lcs[i][j - 1] > lcs[i - 1][j]:
                j -= 1
            else:
                i -= 1
        assert tx._lcs_positions(a, b) == want and len(want) == lcs[-1][-1]


def test_sari_and_wiki_split(spark):
    # one gram: nothing right is kept (0), nothing wrong deleted (0), nothing to add (1); two grams: the pair is rightly
    # gone (1, 1, 1); longer ones do not occur (1, 1, 1)
    row = tg.sari(texts(spark, ["b"], [["a"]], ["a b"]), "id").first()
    assert row.sari == pytest.approx(100 * (3 / 4 + 3 / 4 + 1) / 3)
    same = texts(spark, ["a new text"], [["a new text"]], ["an old text"])
    assert tg.sari(same, "id").first().sari == pytest.approx(100)
    row = tg.wiki_split(texts(spark, HYPS, [r[:1] for r in REFS], ["a kite", "two boats"]), "id").first()
    assert row.sacrebleu == pytest.approx(100 * plain_bleu(HYPS, [r[:1] for r in REFS], closest=True)[0])
    assert row.exact == 0.0


def test_nist(spark):
    refs = [r[0] for r in REFS]
    seen, words = Counter(), 0
    for r in refs:
        words += len(r.split())
        for n in range(1, 6):
            seen += grams(r.split(), n)
    score = 0.0
    for n in range(1, 6):
        gained = total = 0
        for h, r in zip(HYPS, refs):
            for g, c in (grams(h.split(), n) & grams(r.split(), n)).items():
                gained += c * math.log2((seen[g[:-1]] if n > 1 else words) / seen[g])
            total += max(0, len(h.split()) - n + 1)
        score += gained / total
    ratio = min(1.0, sum(len(h.split()) for h in HYPS) / words)
    score *= math.exp(math.log(0.5) / math.log(1.5) ** 2 * math.log(ratio) ** 2) if ratio < 1 else 1
    assert tg.nist(texts(spark, HYPS, [[r] for r in refs]), "id").first().nist_mt == pytest.approx(score)


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, last = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(row[j] + 1, last[j + 1] + 1, last[j] + (x != y)))
    return row[-1]


def test_error_rates(spark):
    hyps, refs = ["a grey owl sleeps  here", "Rain", "日本の 雨"], ["the grey owls sleep", "rain fell", "日本で雨"]
    row = evaluate(pair(spark, hyps, refs), ["wer", "cer"]).first()
    squeezed = [[" ".join(x.split()) for x in side] for side in (hyps, refs)]
    assert row.cer == pytest.approx(sum(map(plain_distance, *squeezed)) / sum(map(len, squeezed[1])))
    assert row.wer == pytest.approx(sum(plain_distance(h.split(), r.split()) for h, r in zip(hyps, refs))
                                    / sum(len(r.split()) for r in refs))
    nulls = evaluate(pair(spark, [None, "b", "c"], ["a", None, "c d"]), ["wer", "cer"]).first()
    assert (nulls.wer, nulls.cer) == (0.5, pytest.approx(2 / 3))
    none = evaluate(pair(spark, [None], ["a"]), ["wer", "cer"]).first()
    assert (none.wer, none.cer) == (None, None)


def test_exact_match(spark):
    df = pair(spark, ["owl!", "barn", "running", "room7"], ["an owl", "barn", "RUNNING", "room"])
    assert evaluate(df, ["exact_match"]).first().exact_match == 0.25
    ways = dict(regexes_to_ignore=["an ", "runn"], ignore_case=True, ignore_punctuation=True)
    assert evaluate(df, [get("exact_match", **ways)]).first().exact_match == 0.5
    ways = dict(regexes_to_ignore=["an ", "runn", "RUNN"], ignore_case=True, ignore_punctuation=True, ignore_numbers=True)
    assert evaluate(df, [get("exact_match", **ways)]).first().exact_match == 1.0


QA_P = "id string, prediction string, no_answer_probability double"
QA_R = "id string, answers array<string>"


def test_squad(spark):
    preds = spark.createDataFrame([("a", "on 4 May", 0.0)], QA_P)
    refs = spark.createDataFrame([("a", ["on 4 May"])], QA_R)
    assert tuple(qa.squad(preds, refs).first()) == (100.0, 100.0)
    row = qa.squad_v2(preds, refs).first()
    assert (row.exact, row.f1, row.total, row.HasAns_exact, row.best_exact, row.best_exact_thresh) == (100, 100, 1, 100, 100, 0)
    refs = spark.createDataFrame([("a", ["On the 4 May", "late on 4 May"]), ("b", ["x"])], QA_R)
    row = qa.squad(preds, refs).first()
    assert (row.exact_match, row.f1) == (50.0, 50.0)
    row = qa.record(spark.createDataFrame([("a", "the 4 th day it", 0.0)], QA_P), refs).first()
    assert (row.exact_match, row.f1) == (0.0, pytest.approx((2 / 7) / 2))


def test_squad_v2_thresholds(spark):
    preds = [("a", "x", 0.1), ("b", "wrong", 0.2), ("c", "", 0.3), ("d", "guess", 0.9), ("e", "y z", 0.95)]
    refs = [("a", ["x"]), ("b", ["y"]), ("c", []), ("d", []), ("e", ["y z w"])]
    row = qa.squad_v2(spark.createDataFrame(preds, QA_P), spark.createDataFrame(refs, QA_R), threshold=0.5).first()
    # above 0.5 the answer is replaced by "no answer"
    assert row.exact == pytest.approx(100 * (1 + 0 + 1 + 1 + 0) / 5)
    assert (row.HasAns_total, row.NoAns_total) == (3, 2)
    assert row.NoAns_exact == 100.0
    # sweep: 2, +1, +0, +0, -1, +0 (exact) or +0.8 (f1)
    assert (row.best_exact, row.best_exact_thresh) == (pytest.approx(60.0), 0.1)
    assert (row.best_f1, row.best_f1_thresh) == (pytest.approx(60.0), 0.1)


def test_cuad(spark):
    spans = ["First party:", "the lessee/tenant: North Pier Boats Ltd."]
    preds = spark.createDataFrame([("Lease__Parties", spans)], "id string, prediction array<string>")
    refs = spark.createDataFrame([("Lease__Parties", spans)], QA_R)
    row = qa.cuad(preds, refs).first()
    assert (row.exact_match, row.f1, row.aupr, row.prec_at_80_recall, row.prec_at_90_recall) == (100, 100, 0, 1, 1)
    preds = spark.createDataFrame([("a", ["x y", "q"]), ("b", ["m"]), ("c", ["t"]), ("d", ["k", "l"])], "id string, prediction array<string>")
    refs = spark.createDataFrame([("a", ["x y"]), ("b", ["m", "n"]), ("c", ["u"]), ("d", ["k", "l"])], QA_R)
    row = qa.cuad(preds, refs).first()
    # (recall, precision): c (0, 0), b (.5, 1), a (1, .5), d (1, 1); after the running maximum all precisions are 1
    assert row.aupr == pytest.approx(1.0)
    assert row.f1 == pytest.approx(100 * (2 / 3 + 2 / 3 + 0 + 1) / 4)
    assert row.prec_at_80_recall == 1.0


def test_multirc_and_suites(spark):
    rows = [("q1", 1, 1), ("q1", 0, 0), ("q2", 1, 0), ("q2", 1, 1)]
    df = spark.createDataFrame(rows, "question string, prediction int, reference int")
    row = super_glue(df, "multirc").first()
    assert row.exact_match == 0.5
    assert row.f1_m == pytest.approx((1.0 + (2 / 3) / 2) / 2)
    assert row.f1_a == pytest.approx(0.8)
    assert glue(df, "mrpc").first().accuracy == 0.75
    assert "spearmanr" in glue(df, "stsb").columns
    assert xtreme_s(df, "minds14").first().f1 == pytest.approx((0.8 + 2 / 3) / 2)
    with pytest.raises(KeyError):
        glue(df, "nope")


def tags(spark, p, r):
    return spark.createDataFrame([(x.split(), y.split()) for x, y in zip(p, r)], "prediction array<string>, reference array<string>")


def test_seqeval(spark):
    df = tags(spark, ["O B-GENE I-GENE I-GENE O", "B-CELL O O"], ["O O B-GENE I-GENE O", "B-CELL O O"])
    rows = {x.type: x for x in tagging.seqeval(df).collect()}
    assert rows["overall"].f1 == 0.5
    assert rows["CELL"].f1 == 1.0
    assert rows["overall"].accuracy == pytest.approx(6 / 8)
    assert rows["GENE"].number == 1


@pytest.mark.parametrize("seq,scheme,want", [
    ("I-A I-A O I-B", None, {("A", 0, 1), ("B", 3, 3)}),
    ("B-A I-B I-B", None, {("A", 0, 0), ("B", 1, 2)}),
    ("B-A B-A O", None, {("A", 0, 0), ("A", 1, 1)}),
    ("S-A E-A I-A O", None, {("A", 0, 0), ("A", 1, 1), ("A", 2, 2)}),
    ("I-A I-A O B-B", "IOB2", {("B", 3, 3)}),
    ("B-A I-A I-B", "IOB2", {("A", 0, 1)}),
    ("I-A E-A E-B I-A", "IOE2", {("A", 0, 1), ("B", 2, 2)}),
    ("B-A I-A E-A S-B B-A O", "IOBES", {("A", 0, 2), ("B", 3, 3)}),
    ("B-A L-A U-B B-C", "BILOU", {("A", 0, 1), ("B", 2, 2)}),
    ("I-A I-A B-A I-B", "IOB1", {("A", 0, 1), ("A", 2, 2), ("B", 3, 3)}),
    ("O", None, set()), ("", None, set()),
])
def test_entity_spans(spark, seq, scheme, want):
    df = spark.createDataFrame([(seq.split(),)], "t array<string>")
    got = df.select(tagging.entity_spans("t", scheme=scheme).alias("s")).first().s
    assert {(x.type, x.start, x.end) for x in got} == want


def test_suffix_tags(spark):
    df = spark.createDataFrame([("PER-B PER-I O LOC-B".split(),)], "t array<string>")
    got = df.select(tagging.entity_spans("t", suffix=True).alias("s")).first().s
    assert {(x.type, x.start, x.end) for x in got} == {("PER", 0, 1), ("LOC", 3, 3)}


def test_poseval(spark):
    df = tags(spark, ["DET NOUN VERB ADV DET NOUN NOUN PUNCT"], ["DET NOUN VERB ADV DET VERB NOUN PUNCT"])
    rows = {x.label: x for x in tagging.poseval(df).collect()}
    assert rows["accuracy"].f1 == 7 / 8
    assert rows["VERB"].recall == 0.5
    assert set(rows) == {"ADV", "DET", "NOUN", "PUNCT", "VERB", "accuracy", "macro avg", "weighted avg"}
