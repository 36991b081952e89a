"""The models against plain versions: dictionaries and loops in place of sorted arrays and matrices."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from peakweave.llm import quality_classifier, recurrent_lm, toxicity
from tests.llm.helpers import prose, words


def sample(seed, n=90):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        text = prose(rng, rng.randrange(3, 40), 80)
        out.append((text + " grubface vile" if k % 3 == 0 else text, int(k % 3 == 0)))
    return out


def plain_levels(texts):
    """n-gram counts by order: of words once per text at the highest, of different longer grams below."""
    times = Counter(w for t in texts for w in set(words(t)))
    top = Counter()
    for w, n in times.items():
        padded = b"\0" * (toxicity.ORDER - 1) + w.encode() + b" "
        for i in range(toxicity.ORDER - 1, len(padded)):
            top[padded[i - toxicity.ORDER + 1 : i + 1]] += n
    levels = {toxicity.ORDER: top}
    for order in range(toxicity.ORDER - 1, 0, -1):
        levels[order] = Counter(g[1:] for g in levels[order + 1])
    return levels


def plain_probability(levels, start, context, char):
    p = start[char]
    for order in range(1, toxicity.ORDER + 1):
        head = context[len(context) - order + 1 :] if order > 1 else b""
        own = {g: c for g, c in levels[order].items() if g[:-1] == head}
        if own:
            seen = own.get(head + bytes([char]), 0)
            p = ((seen - toxicity.DISCOUNT if seen else 0) + toxicity.DISCOUNT * len(own) * p) / sum(own.values())
    return p


def test_evidence_of_words_equals_plain_kneser_ney():
    texts = sample(1, 30)
    model = toxicity.Model([(t.encode(), y) for t, y in texts])
    levels = [plain_levels([t for t, y in texts if y == label]) for label in (0, 1)]
    shared = np.full(256, 0.1)
    for level in levels:
        for g, c in level[1].items():
            shared[g[0]] += c
    shared /= shared.sum()
    asked = [b"grubface", b"grubfeet", b"vile", b"w1", b"unseen", "é".encode(), b"q"]
    for word, got in zip(asked, model.weigh(asked)):
        padded, ratio = b"\0" * (toxicity.ORDER - 1) + word + b" ", 0.0
        for i in range(toxicity.ORDER - 1, len(padded)):
            p = [plain_probability(level, shared, padded[:i], padded[i]) for level in levels]
            ratio += math.log(p[1] / p[0])
        assert got == pytest.approx(ratio), word


def test_quality_scores_equal_a_plain_network():
    texts = sample(2)
    scorer = quality_classifier.Scorer(texts)
    index = quality_classifier.index_vectors()
    ids = [[zlib.crc32(w) % quality_classifier.BUCKETS for w in quality_classifier.RUNS.findall(t.encode())] for t, _ in texts]
    near = {}
    for k, own in enumerate(ids):
        if k % 5:  # every fifth text calibrates
            for i, a in enumerate(own):
                for j in range(max(0, i - quality_classifier.NEAR), min(len(own), i + quality_classifier.NEAR + 1)):
                    if i != j:
                        near[a] = near.get(a, 0) + index[own[j]].astype(float)

    def vector(b):
        v = near.get(b, 0 * index[b])
        v = v if np.abs(v).sum() else index[b]
        return v / max(np.linalg.norm(v), 1e-6)

    net = scorer.network
    for text in [texts[0][0], texts[1][0], "", "never seen ***", "one"]:
        own = [zlib.crc32(w) % quality_classifier.BUCKETS for w in quality_classifier.RUNS.findall(text.encode())]
        x = np.zeros(2 * quality_classifier.DIMENSIONS + 2)
        if own:
            x[: quality_classifier.DIMENSIONS] = sum(vector(b) for b in own) / len(own)
            x[quality_classifier.DIMENSIONS : -2] = sum(vector(b) for b in set(own)) / len(set(own))
            x[-2:] = math.log1p(len(own)), len(set(own)) / len(own)
        x = (x - net.mean) / net.scale
        a, b, c, d = net.parts
        hidden = [math.tanh(sum(x[i] * a[i, j] for i in range(len(x))) + b[j]) for j in range(quality_classifier.HIDDEN)]
        logit = sum(h * w for h, w in zip(hidden, c)) + d[0]
        assert scorer.scores([text.encode()])[0] == pytest.approx(1 / (1 + math.exp(-logit / scorer.temperature)), abs=1e-4)


def test_recurrent_likelihood_equals_a_plain_recurrence():
    rng = np.random.default_rng(3)
    network = recurrent_lm.Network(head=64)
    network.flat[:] = rng.normal(scale=0.4, size=len(network.flat))
    p, h, head = network.parts, network.hidden, network.head
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    texts = [rng.integers(0, head + recurrent_lm.SHAPES, n).astype(np.int16) for n in (1, 5, 70)]
    for text, got in zip(texts, recurrent_lm.likelihoods(network, texts)):
        state, last, total = np.zeros(h), 0, 0.0
        for symbol in text.tolist():
            g, u = (p["inputs"][last] + p["gates"]).astype(float), state @ p["state"]
            update, reset = sigmoid(g[:h] + u[:h]), sigmoid(g[h : 2 * h] + u[h : 2 * h])
            new = np.tanh(g[2 * h :] + reset * u[2 * h :])
            state = update * state + (1 - update) * new
            scores = state @ p["to_class"] + p["class_bias"]
            cls = symbol // recurrent_lm.CLASS_SIZE if symbol < head else symbol - head + head // recurrent_lm.CLASS_SIZE
            total += scores[cls] - np.log(np.exp(scores).sum())
            if symbol < head:
                block = slice(cls * recurrent_lm.CLASS_SIZE, (cls + 1) * recurrent_lm.CLASS_SIZE)
                inner = p["to_word"][block] @ state + p["word_bias"][block]
                total += inner[symbol % recurrent_lm.CLASS_SIZE] - np.log(np.exp(inner).sum())
            last = symbol
        assert got == pytest.approx(total, rel=1e-3, abs=1e-2)


def test_words_are_those_of_the_pattern():
    assert words("Ab-1 é") == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "ab-1 é")
