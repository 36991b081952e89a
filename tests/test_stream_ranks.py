import numpy as np
import pytest
from pyspark.sql import functions as F

from peakweave.metrics import evaluate, get
from peakweave.metrics.ranking import auc
from peakweave.streaming import jobs, ranks

SCHEMA = "prediction double, reference double, grp string"


def arrivals(seed=5):
    rng = np.random.default_rng(seed)
    files = []
    for _ in range(5):
        x = rng.integers(0, 30, 120) / 4
        files.append([(float(a), float(a + rng.integers(0, 9)), ["a", "b", None][k % 3]) for k, a in enumerate(x)])
    files[1] += [(None, 1.0, "a"), (2.0, None, "a"), (float("nan"), 1.0, "b"), (-0.0, 0.0, "b"), (0.0, 0.0, "b")] + [(7.0, 7.0, "a")] * 300
    return files


def test_spearman_of_a_stream_equals_the_batch_after_each_restart(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    seen = []
    for part in (arrivals()[:2], arrivals()[2:]):
        for rows in part:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
            seen += rows
        stream = jobs.read_parquet_stream(spark, source, SCHEMA, files_per_batch=1)
        ranks.accumulate_pairs(stream, out, checkpoint, ["grp"], slots=3).awaitTermination()
        batch = spark.createDataFrame(seen, SCHEMA)
        want = {r.grp: r.spearmanr for r in evaluate(batch, [get("spearmanr", p_value=False)], ["grp"]).collect()}
        found = {r.grp: r for r in ranks.rank_metrics(spark, out, ["spearmanr"], ["grp"]).collect()}
        assert {g: r.spearmanr for g, r in found.items()} == pytest.approx(want)
        assert sum(r.n for r in found.values()) == len(seen)
    # five micro-batches leave runs of two levels, not five
    runs = spark.read.parquet(out).filter("n is not null")
    assert runs.agg(F.max("level")).first()[0] >= 1
    assert ranks.counted_pairs(spark, out, ["grp"]).agg(F.sum("n")).first()[0] == len(seen)


def test_auc_and_unknown_metrics(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rng = np.random.default_rng(2)
    rows = [(float(rng.integers(0, 20)), float(rng.integers(0, 2)), "a") for _ in range(200)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(source)
    ranks.accumulate_pairs(jobs.read_parquet_stream(spark, source, SCHEMA), out, out + "-c").awaitTermination()
    batch = spark.createDataFrame(rows, SCHEMA).select(F.col("prediction").alias("score"), (F.col("reference") == 1).alias("positive"), F.lit(1.0).alias("w"))
    assert ranks.rank_metrics(spark, out, ["roc_auc"]).first().roc_auc == pytest.approx(auc(batch).first().roc_auc)
    with pytest.raises(KeyError, match="known"):
        ranks.rank_metrics(spark, out, ["other"])
    with pytest.raises(ValueError, match="slot"):
        ranks.accumulate_pairs(jobs.read_parquet_stream(spark, source, SCHEMA).withColumn("slot", F.lit(1)), out, out + "-d", ["slot"])


def test_merging_runs():
    a = ranks.merged((np.array([2.0, np.nan, -0.0]), np.array([1.0, 1.0, 0.0]), np.array([1, 2, 3])))
    b = ranks.merged(a, (np.array([0.0, np.nan]), np.array([-0.0, 1.0]), np.array([5, 5])))
    assert b[0].tolist()[:2] == [0.0, 2.0] and np.isnan(b[0][2]) and b[2].tolist() == [8, 1, 7]
    assert [len(c) for c in ranks.merged((np.zeros(0), np.zeros(0), np.zeros(0, dtype=np.int64)))] == [0, 0, 0]


def test_few_slots_are_spread_over_parts(spark, tmp_path):
    """However few the slots, a group's state is dealt over many keys, and the stream hands on plain rows."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(float(i), float(i % 2), "a") for i in range(2000)]
    for part in (rows[:1000], rows[1000:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    ranks.accumulate_pairs(jobs.read_parquet_stream(spark, source, SCHEMA, files_per_batch=1), out, out + "-c", slots=2).awaitTermination()
    runs = spark.read.parquet(out)
    assert dict(runs.dtypes)["p"] == "double"
    sizes = [r["count"] for r in runs.filter("n is not null and level = 1").groupBy("slot", "part").count().collect()]
    assert sum(sizes) == 2000 and len(sizes) > 100 and max(sizes) < 60
    # (prediction, reference) alternate, so AUC is 1000 * 1001 / 2 of the pairs
    assert ranks.rank_metrics(spark, out, ["roc_auc"]).first().roc_auc == pytest.approx(1001 / 2000)
