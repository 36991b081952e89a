"""Toxicity, language model, quality classifier and rules: exact parts against plain counts, learned parts by their use."""

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from peakweave.llm import quality_classifier, quality_rules, recurrent_lm, toxicity
from peakweave.llm.common import crc_mod
from tests.llm.helpers import ODD, clash, crc, frame, lower, prose, spaced, stored

INSULTS = ("grubface", "grubfeet", "vilehead", "viletoe")


def labelled(spark, n=240, seed=3):
    """Texts with labels: every fourth toxic, every fifth of low quality."""
    rng = random.Random(seed)
    texts, labels = [], []
    for k in range(n):
        ws = prose(rng, rng.randrange(20, 120)).split()
        if k % 4 == 0:
            for _ in range(1 + len(ws) // 25):
                ws.insert(rng.randrange(len(ws)), rng.choice(INSULTS) + rng.choice("abcd"))
        text = " ".join(ws)
        if k % 5 == 0:
            text = " ".join(w + "***" for w in ws) if k % 2 else (ws[0] + " ") * len(ws)
        texts.append(text)
        labels.append((k, int(k % 5 != 0), int(k % 4 == 0)))
    return texts, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_character_model_is_a_distribution_and_shares_its_lowest_order():
    model = toxicity.Model([(b"bad worse bad", 1), (b"good fine good day", 0), (b"worse bad", 1)])
    for levels in model.levels:
        for context in (b"", b"b", b"wor", b"zz", b"good"):
            data = np.frombuffer(b"\0" * 4 + context, np.uint8).astype(np.int64)
            p = model.shared
            probability = p.copy()
            for order in range(1, toxicity.ORDER + 1):
                tail = 0
                for b in data[len(data) - order + 1 :] if order > 1 else []:
                    tail = tail * 256 + int(b)
                probability = levels[order - 1].refine(np.arange(256) + (tail << 8), probability)
            assert abs(probability.sum() - 1) < 1e-9
    assert model.weigh([b"bad"])[0] > 0 > model.weigh([b"good"])[0]
    assert abs(model.weigh([b"\xff\xfe"])[0]) < abs(model.weigh([b"bad"])[0])


def test_toxicity_finds_unseen_forms_in_held_out_texts(spark):
    texts, labels = labelled(spark)
    docs = frame(spark, texts + ODD)
    learn = crc_mod("doc_id", 3) != 1
    rows = {r["doc_id"]: r for r in toxicity.score(clash(docs), toxicity.fit(docs, labels, learn)).collect()}
    assert len(rows) == len(texts) + len(ODD)
    held = [k for k in range(len(texts)) if crc(k, 3) == 1]
    assert all(rows[k]["held_out"] == (crc(k, 3) == 1) and 0 <= rows[k]["score"] <= 1 for k in rows)
    assert np.mean([rows[k]["predicted"] == int(k % 4 == 0) for k in held]) > 0.93
    assert len({rows[len(texts) + k]["score"] for k in range(3)}) == 1
    one = toxicity.score(docs, toxicity.fit(docs, labels.filter("toxic = 0"), learn))
    assert {r["score"] for r in one.select("score").distinct().collect()} == {0.0}
    nulls = labels.select(F.lit(None).cast("bigint").alias("doc_id"), "toxic").unionByName(
        labels.select("doc_id", F.lit(None).cast("int").alias("toxic")))
    assert toxicity.score(docs, toxicity.fit(docs, nulls, learn)).filter("score <> 0").count() == 0
    assert toxicity.score(frame(spark, []), toxicity.fit(docs, labels, learn)).count() == 0


def test_quality_classifier_on_held_out_texts(spark):
    texts, labels = labelled(spark)
    docs = frame(spark, texts + ODD)
    learn = crc_mod("doc_id", 5) != 0
    scorer = quality_classifier.fit(docs, labels, learn)
    rows = {r["doc_id"]: r for r in quality_classifier.score(clash(docs), scorer).collect()}
    held = [k for k in range(len(texts)) if crc(k, 5) == 0]
    assert np.mean([rows[k]["predicted"] == int(k % 5 != 0) for k in held]) > 0.93
    kept = quality_classifier.keep(clash(docs), scorer)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, r in rows.items() if r["predicted"])
    assert kept.columns == clash(docs).columns
    unlearned = quality_classifier.fit(docs, labels.limit(0), learn)
    assert quality_classifier.keep(docs, unlearned).count() == docs.count()
    assert quality_classifier.keep(frame(spark, []), scorer).count() == 0


def test_temperature_recovers_a_known_scale():
    rng = np.random.default_rng(0)
    z = rng.normal(size=4000) * 2
    y = (rng.random(4000) < 1 / (1 + np.exp(-z))).astype(float)
    assert 2.4 < quality_classifier.temperature(3 * z, y) < 3.7


def test_language_model_counts_equal_a_plain_unigram(spark, tmp_path, monkeypatch):
    rng = random.Random(9)
    texts = ODD + [prose(rng, rng.randrange(1, 80), 900) for _ in range(60)] + [prose(rng, 3000)] + ["w1 w2"] * 5
    monkeypatch.setattr(recurrent_lm, "LOOKUP", 40)
    docs = stored(clash(frame(spark, texts)), tmp_path / "docs")
    rows = {r["doc_id"]: r for r in recurrent_lm.score(docs).collect()}
    tokens = [[*spaced(t), ""] for t in texts]
    counts = Counter(w for k, ws in enumerate(tokens) if crc(k, 7) != 2 for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    for k, ws in enumerate(tokens):
        r = rows[k]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (crc(k, 7) == 2, len(ws), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in ws)
        assert abs(r["base_score"] - sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws)) < 1e-6
        assert r["score"] < 0 and math.isfinite(r["score"])
    assert recurrent_lm.score(stored(frame(spark, []), tmp_path / "none")).count() == 0
    assert lower("Ä B") == "Ä b"


def small_vocabulary():
    counts = Counter({f"w{k}": 300 // (k + 1) + 1 for k in range(300)}) + Counter({"": 40, "rare": 1, "é1": 2})
    shapes = {}
    for w, c in counts.items():
        n, v = shapes.get(recurrent_lm.shape(w.encode()), (0, 0))
        shapes[recurrent_lm.shape(w.encode())] = (n + c, v + 1)
    top = counts.most_common(280)
    return recurrent_lm.Vocabulary(top, (sum(counts.values()), len(counts)), shapes)


def texts_of(vocabulary, lengths, seed=1):
    rng = random.Random(seed)
    return [vocabulary.read([f"w{int(rng.paretovariate(1)) % 290}".encode() for _ in range(n)])[0] for n in lengths]


def test_state_is_carried_over_windows_and_not_between_texts():
    vocabulary = small_vocabulary()
    network = recurrent_lm.Network(vocabulary)
    texts = texts_of(vocabulary, [0, 3, 200, 31, 32, 33, 90])
    together = recurrent_lm.likelihoods(network, texts)
    alone = [recurrent_lm.likelihoods(network, [t])[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-3)


def test_symbols_are_a_distribution():
    network = recurrent_lm.Network(small_vocabulary())
    state = np.random.default_rng(0).normal(size=(1, recurrent_lm.HIDDEN)).astype(np.float32)
    every = np.arange(recurrent_lm.HEAD + recurrent_lm.SHAPES)
    logp, _ = network.read_out(np.repeat(state, len(every), axis=0), every, False)
    assert abs(np.exp(logp).sum() - 1) < 1e-4


def test_gradients_equal_differences_and_training_helps():
    vocabulary = small_vocabulary()
    network = recurrent_lm.Network(vocabulary)
    lanes = recurrent_lm.Lanes(texts_of(vocabulary, [6, 5, 9, 2]), 2)
    _, x, fresh, y = next(lanes.windows(8))
    state = np.zeros((x.shape[1], recurrent_lm.HIDDEN), np.float32)
    grads, _, _ = network.gradients(x, fresh, y, state)
    real = int((y >= 0).sum())
    for name in network.shapes:
        flat = network.parts[name].reshape(-1)
        at = int(np.abs(grads[name]).reshape(-1).argmax())
        losses = []
        for step in (1e-2, -1e-2):
            flat[at] += step
            losses.append(-network.gradients(x, fresh, y, state)[2] / real)
            flat[at] -= step
        assert abs((losses[0] - losses[1]) / 2e-2 - grads[name].reshape(-1)[at]) < 2e-2 * abs(grads[name].reshape(-1)[at]) + 2e-4, name
    texts = texts_of(vocabulary, [40] * 200)
    before = recurrent_lm.likelihoods(network, texts).sum()
    seen = recurrent_lm.train(network, texts, {})
    assert seen == sum(map(len, texts)) and recurrent_lm.likelihoods(network, texts).sum() > before


def test_shape_column_equals_shape(spark):
    words = ["", "a", "abc", "abcd", "é", "ab1", "abc\u0085", "abc\n"[:3], "x" * 16, "x" * 17, "日本語", "a-b.c"]
    rows = spark.createDataFrame([(w,) for w in words], "word string").select("word", recurrent_lm.shape_column()).collect()
    assert [r[1] for r in rows] == [recurrent_lm.shape(r[0].encode()) for r in rows]
    assert recurrent_lm.shapes_of([w.encode() for w in words]).tolist() == [recurrent_lm.shape(w.encode()) for w in words]


def plain_counts(text):
    ws = [w for w in spaced_case(text)]
    lines = [x for x in (text or "").split("\n") if spaced_case(x)]
    seen = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    repeat = {j for i in range(len(ws) - 2) if seen[tuple(ws[i : i + 3])] > 1 for j in range(i, i + 3)}
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeat))


def spaced_case(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_rule_counts_equal_a_plain_count(spark):
    rng = random.Random(4)
    texts = ODD + [prose(rng, 60) + "\n" + "a b c d\na b c d\n\n" + "é😀 x y " * rng.randrange(3) for _ in range(20)] + ["a a a a", "a b a b a b"]
    rows = {r["doc_id"]: r for r in quality_rules.measure(clash(frame(spark, texts))).collect()}
    for k, text in enumerate(texts):
        assert tuple(rows[k][c] for c in quality_rules.COUNTS[:5]) == plain_counts(text), text


def test_cutoffs_reject_few_good_texts_and_catch_bad_ones(spark, monkeypatch):
    rng = random.Random(6)
    texts, labels = [], []
    for k in range(3000):
        ws = [f"{rng.choice('abcdefgh')}{rng.randrange(500)}" for _ in range(120)]
        bad = k % 10 == 0
        texts.append(" ".join(w + "***" if bad else w for w in ws))
        labels.append((k, int(not bad)))
    docs = frame(spark, texts + ODD)
    known = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id bigint, quality int")
    rows = {r["doc_id"]: r for r in quality_rules.judge(docs, known).collect()}
    assert sum(not rows[k]["kept"] for k, good in labels if good) <= quality_rules.LIMIT * 2700
    assert not any(rows[k]["kept"] for k, good in labels if not good)
    assert all(r["base_failed"] and not r["kept"] for k, r in rows.items() if k >= 3000)
    few = {r["doc_id"]: r for r in quality_rules.judge(docs, known.limit(50)).collect()}
    assert all(few[k]["kept"] for k, _ in labels)  # too few labels prove nothing
    assert quality_rules.judge(frame(spark, []), known).count() == 0


def test_repeated_rows_prove_nothing_about_good_texts(spark):
    """One clean text many times, by row, by id and by label, beside eight good ones that a strict cutoff would reject."""
    rng = random.Random(16)
    words = lambda tail: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(500)}{tail}" for _ in range(120))
    clean, odd = words(""), [words("***") for _ in range(8)]
    texts = [clean] * 9000 + odd
    docs = frame(spark, texts)
    docs = docs.unionByName(docs.filter("doc_id = 5").crossJoin(spark.range(3000).select()))
    labels = spark.createDataFrame([(k, 1) for k in range(len(texts))], "doc_id bigint, quality int")
    labels = labels.unionByName(labels.filter("doc_id = 5").crossJoin(spark.range(3000).select()))
    rows = quality_rules.judge(docs, labels)
    assert rows.count() == len(texts) + 3000 and rows.filter("kept").count() == len(texts) + 3000


def test_contradicting_labels_are_no_trials(spark):
    rng = random.Random(17)
    texts = [" ".join(f"{rng.choice('abc')}{rng.randrange(500)}" for _ in range(60)) for _ in range(3)]
    docs = frame(spark, [*texts, texts[2]])
    labels = spark.createDataFrame([(0, 1), (1, 1), (1, 0), (2, 1), (3, 0), (0, None), (None, 1)], "doc_id bigint, quality int")
    seen = []
    plain = quality_rules.within_risk
    quality_rules.within_risk = lambda rejected, n, *rest: bool(seen.append(n)) or plain(rejected, n, *rest)
    try:
        quality_rules.thresholds(quality_rules.measure(docs), labels)
    finally:
        quality_rules.within_risk = plain
    assert set(seen) == {1}  # of the first text alone


def test_copies_are_dropped_within_a_class_only():
    rng = random.Random(18)
    ordinary = [" ".join(f"w{rng.randrange(5000)}" for _ in range(12)) for _ in range(60)]
    toxic = [t + " vileface grubtoe" for t in ordinary]
    sample = [(t.encode(), k) for pair in zip(ordinary, toxic) for k, t in enumerate(pair)]
    assert toxicity.without_copies(sample) == sample
    assert toxicity.without_copies(sample * 2) == sample
    long = [(" ".join(f"w{rng.randrange(5000)}" for _ in range(900)).encode(), 1)]
    assert toxicity.without_copies(long * 3 + [(b"", 1), (b"", 1), (b"one", 1)]) == [*long, (b"", 1), (b"one", 1)]


def test_binomial_tail_is_exact():
    assert quality_rules.binomial_tail(10**7, 10**9, 0.0101) < 1e-20
    assert quality_rules.binomial_tail(10**7, 10**9, 0.0099) > 1 - 1e-9
    for k, n, p in ((0, 10, 0.1), (3, 20, 0.2), (5, 5, 0.5), (40, 1000, 0.05), (60, 1000, 0.05), (999, 1000, 0.9), (4, 40, 0.3)):
        assert abs(quality_rules.binomial_tail(k, n, p) - min(1, sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))) < 1e-9
    assert not quality_rules.within_risk(0, 0, 0.1, 0.05)


def chained(rng, n):
    """A text in which each word leaves four choices for the next."""
    at, out = rng.randrange(300), []
    for _ in range(n):
        out.append(f"w{at}")
        at = (at * 7 + rng.choice((1, 2, 3, 5))) % 300
    return " ".join(out)


def test_language_model_learns_for_held_out_texts_whatever_the_files(spark, tmp_path):
    rng = random.Random(12)
    docs = frame(spark, [chained(rng, rng.randrange(50, 250)) for _ in range(1400)])
    gain = []
    for files in (1, 48):
        docs.repartition(files).write.parquet(str(tmp_path / str(files)))
        # a partition per file
        read = spark.read.parquet(str(tmp_path / str(files))).repartition(files)
        held = [r for r in recurrent_lm.score(read).collect() if r["held_out"]]
        gain.append(sum(r["score"] - r["base_score"] for r in held) / sum(r["n_tokens"] for r in held))
    assert min(gain) > 0.3 and abs(gain[0] - gain[1]) < 0.1


def test_symbols_follow_the_measured_vocabulary():
    top = [("", 100), *((f"w{k}", 1000 - k) for k in range(900))]
    shapes = {}
    for w, c in top:
        n, v = shapes.get(recurrent_lm.shape(w.encode()), (0, 0))
        shapes[recurrent_lm.shape(w.encode())] = (n + c, v + 1)
    vocabulary = recurrent_lm.Vocabulary(top, (sum(c for _, c in top), len(top)), shapes)
    assert recurrent_lm.HEAD < vocabulary.head < recurrent_lm.HEAD_MOST and vocabulary.head % recurrent_lm.CLASS_SIZE == 0
    assert vocabulary.counts[: vocabulary.head].sum() >= recurrent_lm.COVERED * vocabulary.tokens
    network = recurrent_lm.Network(vocabulary)
    assert network.hidden > recurrent_lm.HIDDEN
    every = np.arange(vocabulary.head + recurrent_lm.SHAPES)
    logp, _ = network.read_out(np.ones((len(every), network.hidden), np.float32), every, False)
    assert abs(np.exp(logp).sum() - 1) < 1e-4


def test_labelled_sample_has_one_row_per_id_and_a_byte_bound(spark, monkeypatch):
    from peakweave.llm import common

    rows = [(k, f"text {k}") for k in range(40)] + [(3, "copy")] * 500 + [(4, None)] * 9
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id bigint, toxic int")
    sample = common.labelled_sample(docs, labels, "toxic", 3000, F.lit(True))
    assert sorted(sample) == sorted(("copy" if k == 3 else f"text {k}", k % 2) for k in range(40))
    for per_class in (5, 12, 19):
        few = Counter(label for _, label in common.labelled_sample(docs, labels, "toxic", per_class, F.lit(True)))
        assert max(few.values()) <= per_class
    monkeypatch.setattr(common, "SAMPLE_BYTES", 50)
    bounded = common.labelled_sample(docs, labels, "toxic", 3000, F.lit(True))
    assert set(bounded) <= set(sample)
    assert all(36 <= sum(len(t) for t, y in bounded if y == label) <= 50 for label in (0, 1))
