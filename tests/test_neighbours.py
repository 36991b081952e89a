import numpy as np
import pytest

from peakweave.operators.neighbours import nearest


def frame(spark, x, first=0):
    return spark.createDataFrame([(first + i, None if v is None else [float(c) for c in v]) for i, v in enumerate(x)],
                                 "id bigint, embedding array<double>").repartition(3)


def plain(x, y, k, skip_self=False):
    unit = lambda v: np.array(v) / max(np.linalg.norm(v), 1e-12)
    out = {}
    for i, a in enumerate(x):
        if a is None:
            out[i] = []
            continue
        far = sorted((round(float(1 - unit(a) @ unit(b)), 9), j) for j, b in enumerate(y) if b is not None and not (skip_self and i == j))
        out[i] = far[:k]
    return out


def got(df):
    return {r["id"]: [(round(n["distance"], 9) + 0.0, n["id"]) for n in r["near"]] for r in df.collect()}


@pytest.mark.parametrize("spread,stripe,cells", [(0.05, 8192, 256), (0.05, 7, 16), (2.0, 16, 9)])
def test_lists_equal_all_pairs(spark, spread, stripe, cells):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 6))
    x = list(centres[rng.integers(0, 12, 150)] + spread * rng.normal(size=(150, 6))) + [None, np.zeros(6)]
    y = list(centres[rng.integers(0, 12, 170)] + spread * rng.normal(size=(170, 6))) + [None, np.zeros(6)] + [np.ones(6)] * 12
    for left, right, own in ((x, y, False), (y, y, True)):
        want = plain(left, right, 5, own)
        assert got(nearest(frame(spark, left), frame(spark, right), 5, skip_self=own, stripe=stripe, cells=cells)) == want


def test_few_or_no_right_rows(spark):
    x = [[1.0, 0.0], [0.0, 1.0], None]
    assert got(nearest(frame(spark, x), frame(spark, x), 10)) == plain(x, x, 10)
    assert got(nearest(frame(spark, x), frame(spark, x), 10, skip_self=True)) == plain(x, x, 10, True)
    assert got(nearest(frame(spark, x), frame(spark, []), 3)) == {0: [], 1: [], 2: []}
    assert got(nearest(frame(spark, []), frame(spark, x), 3)) == {}


def test_clustered_rows_meet_a_few_cells_only(spark, monkeypatch):
    """The rows sent to cells grow with the rows, not with rows times cells."""
    from peakweave.operators import neighbours

    sent = []
    plain_materialize = neighbours.materialize

    def counted(df):
        out = plain_materialize(df)
        if out.columns == ["id", "v", "cell"]:
            sent.append(out.count())
        return out

    monkeypatch.setattr(neighbours, "materialize", counted)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 16))
    x = centres[np.arange(600) % 20] + 0.02 * rng.normal(size=(600, 16))
    nearest(frame(spark, x), frame(spark, x), 5, cells=20).count()
    assert sent[0] == 600 and sum(sent[1:]) < 3 * 600


def test_unclustered_rows_are_sent_to_blocks(spark, monkeypatch):
    """Without clusters a row goes once to each block, however many cells it must meet."""
    from peakweave.operators import neighbours

    sent = []
    plain_group = neighbours._nearest_in_group

    def counted(*options):
        run, rows = plain_group(*options), spark.sparkContext.accumulator(0)
        sent.append(rows)

        def group(table):
            rows.add(table.num_rows)
            return run(table)

        return group

    monkeypatch.setattr(neighbours, "_nearest_in_group", counted)
    x = list(np.random.default_rng(9).normal(size=(400, 24)))
    # equal distances in different cells order by id
    x += [np.eye(24)[i % 3] for i in (0, 1, 2, 1, 0, 2)]
    assert got(nearest(frame(spark, x), frame(spark, x), 5, skip_self=True, stripe=120, cells=20)) == plain(x, x, 5, True)
    blocks = -(-len(x) // 120) * 2
    assert sum(r.value for r in sent) < len(x) * (3 + 2 * blocks)
    # with one block, a row is sent twice as a left row and twice as a right row
    sent.clear()
    nearest(frame(spark, x), frame(spark, x), 5, skip_self=True, cells=20).count()
    assert sum(r.value for r in sent) <= 4 * len(x)
