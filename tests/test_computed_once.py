import glob
import os

import pytest

from peakweave.metrics import evaluate, qa
from peakweave.metrics.reliability import online_reliability
from peakweave.session import shared_dir


def saved(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def test_retrieval_rows_are_computed_once(spark, tmp_path):
    """Run and judgements come from one stored frame, not from the frame's own inputs once per use."""
    rows = [(q, d, float(d), d % 2, q % 2) for q in range(4) for d in range(5)]
    df = saved(spark.createDataFrame(rows, "query int, docid int, score double, rel int, grp int"), str(tmp_path / "run"))
    report = evaluate(df, ["trec_eval"], ["grp"])
    assert not [f for f in report.inputFiles() if "/run/" in f]
    # relevant: documents 3 and 1, on places 2 and 4
    assert {(r.grp, r.num_q, r.map) for r in report.collect()} == {(0, 2, 0.5), (1, 2, 0.5)}


def test_spans_are_compared_once(spark, tmp_path):
    """Sums and curve read stored scores of the questions."""
    preds = saved(spark.createDataFrame([("a", ["x y"]), ("b", ["z", "q"])], "id string, prediction array<string>"), str(tmp_path / "preds"))
    refs = saved(spark.createDataFrame([("a", ["x y"]), ("b", ["z"])], "id string, answers array<string>"), str(tmp_path / "refs"))
    out = qa.cuad(preds, refs)
    assert not [f for f in out.inputFiles() if "/preds/" in f]
    row = out.first()
    assert (row.exact_match, row.f1) == (pytest.approx(100.0), pytest.approx(100 * (1 + 2 / 3) / 2))


def test_curves_are_sorted_once(spark):
    """Changes come from the places of the sort that gives the peaks, without a sort of their own."""
    folder = os.path.join(shared_dir(spark).removeprefix("file:"), "ordered-rows-*")
    before = len(glob.glob(folder))
    rows = [(run, t, float((t * 7 + (run or 0)) % 5)) for run in (1, 2, None) for t in range(1, 41)]
    curves = spark.createDataFrame(rows, "run int, t int, value double")
    row = online_reliability(curves, (20, 40), 20, 20, freq_thresh=None).first()
    assert len(glob.glob(folder)) == before
    assert row.max_drawdown == 4.0
    tails = []
    for run in (1, 2, 0):
        values = [v for r, _, v in rows if (r or 0) == run]
        diffs = sorted(b - a for a, b in zip(values, values[1:]))
        ordered = sorted(values)
        base = ordered[37] + (ordered[38] - ordered[37]) * (0.95 * 39 - 37) - values[0]
        at = 0.05 * (len(diffs) - 1)
        cut = diffs[int(at)] + (diffs[int(at) + 1] - diffs[int(at)]) * (at - int(at))
        low = [d for d in diffs if d <= cut]
        if base:
            tails.append(sum(low) / len(low) / base)
    assert row.lower_cvar_on_diffs == pytest.approx(sum(tails) / len(tails))
