"""Embedding near duplicates against all pairs."""

import math

import numpy as np
import pytest

from peakweave.llm import embedding_dedup
from tests.llm.helpers import stored

SCHEMA = "vec_id bigint, embedding array<float>, label int, node string, unit string, copies string, cell string"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, "n", "u", "k", "c") for r in rows], SCHEMA.replace("float", kind))


def plain(rows, limit=0.93):
    """(vec_id, n_links, component_id, kept) of each row by all pairs."""
    def usable(v, lab):
        return lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        a, b = np.array(a, float), np.array(b, float)
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))

    n = len(rows)
    links = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if usable(a, la) and usable(b, lb) and la == lb and len(a) == len(b) and cosine(a, b) >= limit:
                links[i].append(j)
                links[j].append(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), least, rows[i][0] == least))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def cloud(seed, n, length=6, groups=9, spread=0.12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, length))
    x = (centres[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, length))).astype(np.float32)
    x *= rng.uniform(0.1, 10, size=(n, 1)).astype(np.float32)
    return [(int(k), [float(v) for v in x[k]], [1, 1, 2, None][k % 4]) for k in rng.permutation(n)]


def test_groups_equal_all_pairs(spark, tmp_path):
    rows = cloud(1, 260) + [(900, None, 1), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (902, [0.0] * 6, 1), (903, [-0.0] * 6, 1),
                            (904, [float("nan")] * 6, 1), (905, [float("inf")] * 6, 1), (906, [], 1)]
    rows += [(950 + k, [1.0, 2.0, 3.0, -0.0, 0.0, 1.0], 2) for k in range(40)] + [(955, [1.0, 2.0, 3.0, 0.0, 0.0, 1.0], 2)]
    rows += [(None, [1.0, 2.0, 3.0, 0.0, 0.0, 1.0], 2), (None, [5.0, -9.0, 1.0, 1.0, 1.0, 1.0], 7), (3, [1.0, 0.0], 1), (4, [1.0, 0.01], 1)]
    docs = stored(frame(spark, rows), tmp_path / "a")
    found = embedding_dedup.group(docs)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert got(found) == plain(rows)
    # many cells and stripes, few sampled points
    assert got(embedding_dedup.group(docs, stripe=16, sample=64)) == plain(rows)


def test_extreme_lengths_limits_and_no_rows(spark, tmp_path):
    rows = [(1, [1e300, 1e300], 1), (2, [1e-310, 1e-310], 1), (3, [3e-320, 0.0], 1), (4, [1.0, 0.0], 1), (5, [0.0, 1.0], 1)]
    assert got(embedding_dedup.group(stored(frame(spark, rows, "double"), tmp_path / "a"))) == plain(rows)
    assert got(embedding_dedup.group(stored(frame(spark, []), tmp_path / "b"))) == []
    alone = [(1, None, 1), (2, [1.0], None)]
    assert got(embedding_dedup.group(stored(frame(spark, alone), tmp_path / "c"))) == [(1, 0, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("spread,k", [(0.05, 16), (0.5, 16), (3.0, 64)])
def test_no_pair_is_lost_across_cells(spread, k):
    """Every pair at the limit meets in one cell exactly: as two of its own rows, or as a row and a guest."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(16, 8))
    x = centres[rng.integers(0, 16, 700)] + spread * rng.normal(size=(700, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cells = embedding_dedup.Cells(embedding_dedup.kmeans(x, k), 0.93)
    home, near = cells.home(x)
    cells.widest = np.array([near[home == c, c].min(initial=1.0) for c in range(k)])
    row, cell = cells.guests(home, near)
    guests = set(zip(row.tolist(), cell.tolist()))
    i, j = embedding_dedup.linked(x, x, 0.93)
    for a, b in zip(i.tolist(), j.tolist()):
        met = (home[a] == home[b]) + ((a, home[b]) in guests) + ((b, home[a]) in guests)
        assert met == 1
    if spread == 0.05:
        assert len(guests) < 0.5 * len(x)


def test_connections_of_pairs():
    rng = np.random.default_rng(3)
    i, j = rng.integers(0, 400, 250), rng.integers(0, 400, 250)
    smallest = np.arange(400)
    for a in range(0, 250, 50):
        embedding_dedup.joined(smallest, i[a : a + 50], j[a : a + 50])
    parent = list(range(400))
    for _ in range(400):
        for a, b in zip(i.tolist(), j.tolist()):
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert smallest.tolist() == parent
