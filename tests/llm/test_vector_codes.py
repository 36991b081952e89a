"""Vector codes against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest

from peakweave.llm import vector_codes
from tests.llm.helpers import stored

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, near string, code string, copies string"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, "x", "n", "c", "k") for r in rows], SCHEMA.replace("float", kind))


def plain(rows, entries=256, rounds=4, parts=4):
    """Code and error of each row, and the codebooks, by Python integers."""
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    lengths = {}
    for _, v, _ in kept:
        if len(v) % parts == 0:
            lengths[len(v)] = lengths.get(len(v), 0) + 1
    length = min(lengths, key=lambda k: (-lengths[k], k), default=0)
    fit = [r for r in kept if len(r[1]) == length]
    starts = {}
    for i, v, _ in fit:
        if i is not None:
            starts[i] = min(starts.get(i, v), v)
    w = length // parts
    books = [[starts[i][p * w : (p + 1) * w] for i in sorted(starts)[:entries]] for p in range(parts)]
    if not starts:
        return [(i, None, None, lab) for i, _, lab in kept], books

    def near(part, book):
        found = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in book]
        return found.index(min(found)), min(found)

    for _ in range(rounds):
        groups = [{} for _ in range(parts)]
        for _, v, _ in fit:
            for p in range(parts):
                part = v[p * w : (p + 1) * w]
                groups[p].setdefault(near(part, books[p])[0], []).append(part)
        for p in range(parts):
            for e, members in groups[p].items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    out = []
    for i, v, lab in kept:
        if len(v) != length:
            out.append((i, None, None, lab))
            continue
        found = [near(v[p * w : (p + 1) * w], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found), lab))
    return out, books


def expected(rows, **kw):
    coded, books = plain(rows, **kw)
    sums = {}
    for _, _, e, lab in coded:
        sums[lab] = (sums.get(lab) or 0) + e if e is not None else sums.get(lab)
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted(((i, c, e, sums[lab], sha) for i, c, e, lab in coded), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def cloud(seed, n, length=8, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, length))
    x = (centres[rng.integers(0, 7, n)] + spread * rng.normal(size=(n, length))).astype(np.float32)
    return [(int(k), [float(v) for v in x[k]], int(k % 3) if k % 5 else None) for k in rng.permutation(n)]


def test_codes_equal_plain_integers(spark, tmp_path):
    rows = cloud(1, 420) + [(1000, None, 1), (1001, [0.5, None] * 4, 1), (1002, [float("nan")] + [0.0] * 7, 1),
                            (1003, [float("-inf")] * 8, None), (1004, [-0.0001] * 8, 2)]
    rows += [(1005, [0.25] * 8, 1)] * 60 + [(3, [9.0] * 8, 1), (None, [0.25] * 8, 2), (2000, [1.0] * 5, 2), (2001, [], 0)]
    assert got(vector_codes.digest(stored(frame(spark, rows), tmp_path / "a"))) == expected(rows)


def test_few_ids_ties_large_values_and_no_rows(spark, tmp_path):
    few = [(7, [1.0, -1.0, 0.0, 2.0], 1), (8, [1.0, -1.0, 0.0, 2.0], 1), (9, [-3.0, 5.0, 0.0, 2.0], None), (9, [-3.0, 4.0, 0.0, 2.0], None)]
    assert got(vector_codes.digest(stored(frame(spark, few), tmp_path / "a"))) == expected(few)
    large = [(k, [float(v) * 2.0**40 for v in vec], lab) for k, vec, lab in cloud(3, 60)]
    answer = [(i, c, e if e < 1 << 63 else None) for i, c, e, _ in plain(large)[0]]
    coded, books = vector_codes.encode(stored(frame(spark, large), tmp_path / "b"))
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in coded.collect()) == sorted(answer)
    assert [b.tolist() for b in books] == plain(large)[1]
    wide = frame(spark, [(1, [1e300, -1e300, 0.0, 0.0], 1), (2, [5.0, 5.0, 5.0, 5.0], 1)], "double")
    assert [(r["vec_id"], r["error"]) for r in vector_codes.digest(stored(wide, tmp_path / "c")).orderBy("vec_id").collect()] == [(1, 0), (2, 0)]
    unnamed = [(None, [1.0] * 4, 1), (None, None, 1)]
    assert got(vector_codes.digest(stored(frame(spark, unnamed), tmp_path / "d"))) == expected(unnamed)
    assert got(vector_codes.digest(stored(frame(spark, []), tmp_path / "e"))) == []


@pytest.mark.parametrize("spread", [0.02, 3.0])
def test_bounds_prune_without_loss(spread):
    """Clustered parts evaluate a part of the entries only; with and without pruning the answer is the exact one."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(256, 4)) * 2000
    x = (centres[rng.integers(0, 256, 3000)] + spread * 100 * rng.normal(size=(3000, 4))).astype(np.int64)
    book = x[:256].copy()
    book[200] = book[10]  # a tie
    fixed = vector_codes.pivots(book)
    near = vector_codes.roots(vector_codes.distances(x, fixed)).astype(np.float32).astype(float)
    index, best, evaluated = vector_codes.nearest(x, near, book, vector_codes.roots(vector_codes.distances(book, fixed)))
    every = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    assert index.tolist() == every.argmin(axis=1).tolist() and best.tolist() == every.min(axis=1).tolist()
    assert evaluated < 0.5 * x.shape[0] * 256


def test_decoding_gives_the_entries(spark, tmp_path):
    rows = cloud(9, 50)
    coded, books = vector_codes.encode(stored(frame(spark, rows), tmp_path / "a"))
    vectors = {i: [math.floor(1024 * v) for v in x] for i, x, _ in rows}
    for r in coded.collect():
        assert sum((a - b) ** 2 for a, b in zip(vectors[r["vec_id"]], vector_codes.decoded(r["code"], books))) == r["error"]


def test_vectors_without_components(spark, tmp_path):
    """Nothing tells them apart: all have the first entry's code and no error."""
    rows = [(k, [], k % 2) for k in range(5)]
    found = vector_codes.digest(stored(frame(spark, rows), tmp_path / "a")).collect()
    assert [(r["code"], r["error"], r["label_error"]) for r in found] == [("00000000", 0, 0)] * 5
    odd = [(k, [1.0, 2.0], 1) for k in range(3)]
    assert [r["code"] for r in vector_codes.digest(stored(frame(spark, odd), tmp_path / "b")).collect()] == [None] * 3
