"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney models over the characters of words, of toxic and of ordinary texts. A word counts once per
text, lower orders count contexts instead of occurrences, and both models end in the same lowest order, the continuation
counts of both classes together: a rare expression, unseen in either class, falls back to the shared counts and says
nothing for either side, while the unseen form of a known stem is still recognised. Copies in the sample count once.

A text's evidence is the difference of the two log-likelihoods, length-normalised over the whole text and over its most
suspicious stretch of words; a logistic fit turns both into a probability, on evidence from models that have not
counted the text in question.

The models are fitted on at most PER_CLASS labelled texts of each class and are small arrays in the tasks; each text is
scored once, whole, without a shuffle.

Defined cases: a null or empty text carries no evidence; when one class has no labelled text every score is the share of
the other in the labels (0 or 1; 0 without labels); repeated rows get equal scores; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from peakweave.llm.common import alnum_words, held_crc, labelled_sample, logistic, map_texts, utf8

PER_CLASS = 3000
#: Characters of an n-gram; five bytes and their key fit a long.
ORDER = 5
DISCOUNT = 0.75
#: Hashes that a sketch of a text's shingles has at least.
SKETCHED = 8
#: Words of the most suspicious stretch.
STRETCH = 8
FOLDS = 3
HELD_OUT = (3, 1)
THRESHOLD = 0.7
#: Words whose evidence a Python worker remembers; beyond that it starts afresh between batches.
REMEMBERED = 500_000


def without_copies(texts: list[tuple[bytes, int]], shingle: int = 5, most: float = 0.5) -> list[tuple[bytes, int]]:
    """The texts of a sample without those that share over `most` of their shingles with earlier ones of their class.

    Shingles are compared by a sketch, those whose hash is divisible by 16. A text of which fewer than SKETCHED are meets
    the others of that kind with all its shingles.
    """
    seen: dict[tuple[int, bool], set[int]] = {}
    kept = []
    for text, label in texts:
        words = alnum_words(text)
        own = {zlib.crc32(b" ".join(words[i : i + shingle])) for i in range(max(1, len(words) - shingle + 1))}
        sketch = {h for h in own if h % 16 == 0}
        short = len(sketch) < SKETCHED
        own, earlier = own if short else sketch, seen.setdefault((label, short), set())
        if len(own & earlier) <= most * len(own):
            kept.append((text, label))
        earlier |= own
    return kept


def characters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words' bytes with room for contexts between them; the places to predict (the blank behind a word too) and
    their words."""
    data = np.frombuffer(b"".join(b"\0" * (ORDER - 1) + w + b" " for w in words), np.uint8).astype(np.int64)
    width = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    owner = np.repeat(np.arange(len(words)), width)
    return data, np.arange(len(owner)) + (ORDER - 1) * (owner + 1), owner


def keys(data: np.ndarray, places: np.ndarray, order: int) -> np.ndarray:
    """The `order` bytes that end at each place, as one number."""
    key = np.zeros(len(places), dtype=np.int64)
    for back in range(order - 1, -1, -1):
        key = key * 256 + data[places - back]
    return key


class Level:
    """Counts of one order with the totals of their contexts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams, self.counts = grams, counts
        self.contexts, at = np.unique(grams >> 8, return_inverse=True)
        self.total, self.kinds = np.bincount(at, weights=counts), np.bincount(at)

    def refine(self, key: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probabilities of this order; an unseen context keeps those of the order below."""
        if not len(self.grams):
            return lower
        at = np.minimum(np.searchsorted(self.grams, key), len(self.grams) - 1)
        context = np.minimum(np.searchsorted(self.contexts, key >> 8), len(self.contexts) - 1)
        own = np.where(self.grams[at] == key, self.counts[at] - DISCOUNT, 0.0)
        mixed = (own + DISCOUNT * self.kinds[context] * lower) / self.total[context]
        return np.where(self.contexts[context] == key >> 8, mixed, lower)


class Model:
    """Both classes' levels over the shared lowest order, and the evidence of words."""

    def __init__(self, texts: list[tuple[bytes, int]]):
        self.levels = []
        shared = np.full(256, 0.1)
        for label in (0, 1):
            texts_with = Counter(w for t, y in texts if y == label for w in set(alnum_words(t)))
            words = sorted(texts_with)
            data, places, owner = characters(words)
            times = np.array([texts_with[w] for w in words], dtype=float)
            grams, at = np.unique(keys(data, places, ORDER), return_inverse=True)
            levels = [Level(grams, np.bincount(at, weights=times[owner], minlength=len(grams)))]
            for order in range(ORDER - 1, 0, -1):
                grams, counts = np.unique(grams & (256**order - 1), return_counts=True)
                levels.append(Level(grams, counts.astype(float)))
            shared[grams] += counts
            self.levels.append(levels[::-1])
        self.shared = shared / shared.sum()
        self.known: dict[bytes, float] = {}

    def weigh(self, words: list[bytes]) -> np.ndarray:
        """The log-likelihood ratio of each word."""
        data, places, owner = characters(words)
        start = self.shared[data[places]]
        found = [start, start]
        for order in range(1, ORDER + 1):
            key = keys(data, places, order)
            found = [levels[order - 1].refine(key, p) for levels, p in zip(self.levels, found)]
        return np.bincount(owner, weights=np.log(found[1] / found[0]), minlength=len(words))

    def features(self, texts: list[bytes]) -> np.ndarray:
        """Evidence per word of each whole text, and of the stretch where it is largest."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        split = [alnum_words(t) for t in texts]
        new = list({w for words in split for w in words if w not in self.known})
        for at in range(0, len(new), 50_000):
            part = new[at : at + 50_000]
            self.known.update(zip(part, self.weigh(part).tolist()))
        out = np.zeros((len(texts), 2))
        for k, words in enumerate(split):
            if words:
                sums = np.concatenate([[0.0], np.cumsum([*map(self.known.__getitem__, words)])])
                width = min(STRETCH, len(words))
                out[k] = sums[-1] / len(words), (sums[width:] - sums[:-width]).max() / STRETCH
        return out


class Scorer:
    """Models of all sample texts, and a calibration on evidence that each text got from models without it."""

    def __init__(self, sample: list[tuple[str, int]]):
        texts = without_copies([(t.encode(), y) for t, y in sample])
        labels = {y for _, y in texts}
        self.constant = None if len(labels) == 2 else float(max(labels, default=0))
        if self.constant is not None:
            return
        y = np.array([label for _, label in texts], dtype=float)
        fold = np.arange(len(texts)) % FOLDS
        x = np.zeros((len(texts), 2))
        for k in range(FOLDS):
            x[fold == k] = Model([t for t, f in zip(texts, fold) if f != k]).features(
                [t for (t, _), f in zip(texts, fold) if f == k])
        self.model = Model(texts)
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        self.weights = logistic((x - self.mean) / self.scale, y, ridge=0.1)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        parts = [self.model.features(texts[at : at + 1024]) for at in range(0, len(texts), 1024)]
        z = ((np.concatenate(parts) - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = PER_CLASS, sample_bytes: int | None = None) -> Scorer:
    return Scorer(labelled_sample(docs, labels, "toxic", per_class, learn, sample_bytes))


def score(docs: DataFrame, scorer: Scorer, held_out: tuple[int, int] = HELD_OUT, threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id`, `held_out`, `score` and `predicted` of every document."""

    def run(batch: pa.RecordBatch) -> dict:
        scores = scorer.scores(utf8(batch.column("text")))
        held = held_crc(batch.column("doc_id").to_pylist(), held_out[0])
        return {"doc_id": batch.column("doc_id"), "held_out": [h == held_out[1] for h in held], "score": scores,
                "predicted": (scores >= threshold).astype(np.int32)}

    return map_texts(docs, ["doc_id", "text"],
                     f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double, predicted int", run)
