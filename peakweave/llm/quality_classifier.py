"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

A word is a run of letters and digits or a run of signs, hashed to one of BUCKETS. Each bucket has a fixed sparse random
index vector; a word's vector is the sum of the index vectors that stood near it in the sample (its own index vector where
it was never seen). A document is described by the mean of its word vectors, by the mean over its different words, and by
its length and the share of different words. A tanh layer and a logistic output, trained in numpy, give a logit; dividing
it by a temperature, chosen on texts kept from training, makes it a calibrated probability.

Training uses at most PER_CLASS labelled texts of each class; vectors and network are arrays of fixed size in the tasks.

Defined cases: a null or empty text is described by zeros; when one class has no labelled text every score is the share of
the other in the labels (0 or 1; 1 without labels, so nothing is rejected unlearned); repeated rows get equal scores; other
columns are ignored by `score` and kept by `keep`.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from peakweave.llm.common import held_crc, labelled_sample, map_texts, utf8

PER_CLASS = 3000
BUCKETS = 1 << 16
DIMENSIONS = 64
NONZERO = 4
NEAR = 2
HIDDEN = 32
EPOCHS = 60
HELD_OUT = (5, 0)
THRESHOLD = 0.3
RUNS = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\x00-\x20\x30-\x39\x41-\x5a\x61-\x7a\x80-\xff]+")


def index_vectors() -> np.ndarray:
    """NONZERO entries of +1 or -1 per bucket."""
    rng = np.random.default_rng(11)
    out = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32)
    at = rng.integers(0, DIMENSIONS, size=(BUCKETS, NONZERO))
    out[np.arange(BUCKETS)[:, None], at] = rng.choice(np.array([-1, 1], dtype=np.float32), size=(BUCKETS, NONZERO))
    return out


def buckets(text: bytes) -> np.ndarray:
    crc = zlib.crc32
    return np.array([crc(w) for w in RUNS.findall(text)], dtype=np.int64) % BUCKETS


def word_vectors(texts: list[np.ndarray]) -> np.ndarray:
    """Unit word vectors from the neighbours in `texts`."""
    index = index_vectors()
    vectors = np.zeros_like(index)
    for at in range(0, len(texts), 256):
        block = texts[at : at + 256]
        for step in range(1, NEAR + 1):
            here = np.concatenate([np.concatenate([x[:-step], x[step:]]) for x in block])
            there = np.concatenate([np.concatenate([x[step:], x[:-step]]) for x in block])
            if len(here):
                order = np.argsort(here, kind="stable")
                firsts = np.flatnonzero(np.diff(here[order], prepend=-1))
                vectors[here[order][firsts]] += np.add.reduceat(index[there[order]], firsts, axis=0)
    seen = np.abs(vectors).sum(axis=1) > 0
    vectors[~seen] = index[~seen]
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)


def describe(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The pooled vectors and the two lengths of one text."""
    out = np.zeros(2 * DIMENSIONS + 2, dtype=np.float32)
    if len(ids):
        kinds, n = np.unique(ids, return_counts=True)
        found = vectors[kinds]
        out[:DIMENSIONS] = n.astype(np.float32) @ found / len(ids)
        out[DIMENSIONS:-2] = found.mean(axis=0)
        out[-2:] = np.log1p(len(ids)), len(kinds) / len(ids)
    return out


class Network:
    """A two-layer network trained by Adam on whole-sample steps of mini-batches."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        rng = np.random.default_rng(5)
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-4)
        x = (x - self.mean) / self.scale
        self.parts = [rng.normal(size=(x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN),
                      rng.normal(size=HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
        first, second = [np.zeros_like(p) for p in self.parts], [np.zeros_like(p) for p in self.parts]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), 128):
                rows, step = order[at : at + 128], step + 1
                for k, g in enumerate(self._gradient(x[rows], y[rows])):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.parts[k] = self.parts[k] - 3e-3 * (first[k] / (1 - 0.9**step)) / (
                        np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)

    def _gradient(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        a, b, c, d = self.parts
        h = np.tanh(x @ a + b)
        error = (1 / (1 + np.exp(-np.clip(h @ c + d, -30, 30))) - y) / len(x)
        back = error[:, None] * c * (1 - h * h)
        return [x.T @ back + 1e-4 * a, back.sum(axis=0), h.T @ error + 1e-4 * c, np.array([error.sum()])]

    def logit(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.parts
        return np.tanh((x - self.mean) / self.scale @ a + b) @ c + d


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the smallest log-loss, on a fixed grid."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 101))
    loss = [np.logaddexp(0, np.where(y == 1, -1, 1) * logits / t).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


class Scorer:
    """Word vectors, network and temperature; four of five texts train, the others calibrate."""

    def __init__(self, sample: list[tuple[str, int]]):
        y = np.array([label for _, label in sample], dtype=float)
        self.constant = None if len(set(y)) == 2 else float(max(y, default=1))
        if self.constant is not None:
            return
        texts = [buckets(t.encode()) for t, _ in sample]
        kept = np.arange(len(y)) % 5 == 0
        if len(set(y[kept])) < 2 or len(set(y[~kept])) < 2:
            kept[:] = False
        self.vectors = word_vectors([t for t, k in zip(texts, kept) if not k])
        x = np.array([describe(t, self.vectors) for t in texts])
        self.network = Network(x[~kept], y[~kept])
        self.temperature = temperature(self.network.logit(x[kept]), y[kept]) if kept.any() else 1.0

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        x = np.array([describe(buckets(t), self.vectors) for t in texts])
        return 1 / (1 + np.exp(-np.clip(self.network.logit(x) / self.temperature, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = PER_CLASS, sample_bytes: int | None = None) -> Scorer:
    return Scorer(labelled_sample(docs, labels, "quality", per_class, learn, sample_bytes))


def score(docs: DataFrame, scorer: Scorer, held_out: tuple[int, int] = HELD_OUT, threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id`, `held_out`, `score` and `predicted` of every document."""

    def run(batch: pa.RecordBatch) -> dict:
        scores = scorer.scores(utf8(batch.column("text")))
        held = held_crc(batch.column("doc_id").to_pylist(), held_out[0])
        return {"doc_id": batch.column("doc_id"), "held_out": [h == held_out[1] for h in held], "score": scores,
                "predicted": (scores >= threshold).astype(np.int32)}

    return map_texts(docs, ["doc_id", "text"],
                     f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double, predicted int", run)


def keep(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that reach the threshold, all columns kept."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(scorer.scores(utf8(batch.column("text"))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
