import numpy as np
import pytest

import __spark_entry__ as entry
from peakweave.metrics import core
from peakweave.metrics.distribution import frontier_area, mauve
from peakweave.metrics.reliability import offline_reliability, online_reliability
from peakweave.operators import joins
from peakweave.plans.features import collate, model_input
from peakweave.plans.snp_effect import snp_effect_input
from peakweave.streaming import jobs

SEQ = "sample string, pos string, seq string"


def test_snp_effect(spark):
    snp = spark.createDataFrame([
        (0, "chr1:100-600", "chr1_150", "T", "C"), (1, "chr1:100-600", "chr1_170", "T", "C"),
        (2, "chr1:700-900", "chr1_710", "AT", "C"), (3, "chr2:5-9", "chr2_6", "A", None),
        (4, "chr3:5-9", "chr3_6", "A", "G")], "file_pos int, phenotype_id string, variant_id string, A1 string, A2 string")
    seqs = spark.createDataFrame([("a", "chr1:100-600", "AC"), ("b", "chr1:100-600", "GG"), ("a", "chr1:700-900", "T"),
                                  ("a", "chr2:5-9", "T"), ("c", "chr3:5-9", "T")], SEQ)
    samples = spark.createDataFrame([("a",), ("c",), ("c",)], "sample string")
    for salts in (None, 3):
        got = {(r.phenotype_id, r.variant_id, r.sample_id, r.snp_relative_pos) for r in snp_effect_input(snp, seqs, samples, salts=salts).collect()}
        assert got == {("chr1:100-600", "chr1_170", "a", 70), ("chr3:5-9", "chr3_6", "c", 1)}
    # a last variant with long alleles hides an earlier one of the same window
    long = snp.unionByName(spark.createDataFrame([(9, "chr3:5-9", "chr3_7", "AA", "G")], snp.schema))
    assert snp_effect_input(long, seqs, samples).count() == 1
    assert joins.merge_variants(snp, seqs, keep="all").count() == 7


def test_model_input_and_collate(spark):
    rows = spark.createDataFrame([("a", [7, 8], 0, 1.5), ("b", [9], 1, 2.5), ("a", [7] * 6, 2, 3.5)],
                                 "sample string, input_ids array<int>, record_id long, peak double")
    cells = spark.createDataFrame([("a", i, [float(i), 0.0]) for i in range(3)], "sample string, cell_id int, embedding array<double>")
    out = model_input(rows, cells, "peak", 4, 2)
    got = {r.sample_record_id: r for r in out.collect()}
    assert set(got) == {0, 2}
    assert (got[0].seq_input_ids, got[0].seq_len, got[2].seq_input_ids, got[2].seq_len) == ([4, 4, 7, 8], 2, [7] * 4, 4)
    assert got[0].cell_embedding == [[0.5, 0.0], [1.5, 0.0]]
    batch = collate(out, 8).first()
    assert batch.peak_value == [1.5, 3.5] and "sample" not in batch.asDict()


def test_matrix_realign_errors(spark):
    a = spark.createDataFrame([(1,), (2,)], "record_id int")
    with pytest.raises(Exception, match="do not match"):
        joins.realign(a.limit(1), a).collect()


def test_streaming_matches_batch(spark, tmp_path):
    from peakweave.metrics import evaluate

    src = str(tmp_path / "in")
    df = spark.createDataFrame([(i, i % 3, float(i), float(i * i % 7)) for i in range(50)], "record_id long, g int, prediction double, reference double")
    df.repartition(6).write.json(src)
    schema = "record_id long, g int, prediction double, reference double"

    def stream():
        return jobs.read_json_stream(spark, src, schema, 2)

    out = str(tmp_path / "metrics")
    jobs.accumulate_metrics(stream(), ["mse", "r_squared"], out, str(tmp_path / "c1"), ["g"]).awaitTermination()
    want = {r.g: (r.mse, r.r_squared) for r in evaluate(df, ["mse", "r_squared"], ["g"]).collect()}
    got = {r.g: (r.mse, r.r_squared) for r in jobs.newest_metrics(spark, out).collect()}
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g])
    with pytest.raises(ValueError):
        jobs.accumulate_metrics(stream(), ["spearmanr"], out, str(tmp_path / "c2"))
    sink = str(tmp_path / "taken")
    jobs.write_parquet_stream(jobs.take_stream(stream(), 7), sink, str(tmp_path / "c3")).awaitTermination()
    assert spark.read.parquet(sink).count() == 7
    sink = str(tmp_path / "slice")
    jobs.write_parquet_stream(jobs.worker_slice(stream(), 1, 4), sink, str(tmp_path / "c4")).awaitTermination()
    assert {r.record_id for r in spark.read.parquet(sink).collect()} == set(range(1, 50, 4))
    # a second run over the same checkpoint finds nothing new
    jobs.write_parquet_stream(jobs.worker_slice(stream(), 1, 4), sink, str(tmp_path / "c4")).awaitTermination()
    assert spark.read.parquet(sink).count() == 13


def test_reliability(spark):
    rng = np.random.default_rng(8)
    runs = {r: rng.normal(size=200).cumsum() + 50 for r in range(3)}
    df = spark.createDataFrame([(r, t, float(v)) for r, vs in runs.items() for t, v in enumerate(vs)], "run int, t int, value double")
    row = online_reliability(df, (99, 199), 100, 90, freq_thresh=None).first()
    base = {r: np.quantile(v, 0.95) - v[0] for r, v in runs.items()}
    assert row.max_drawdown == pytest.approx(np.mean([(np.maximum.accumulate(v) - v).max() for v in runs.values()]))
    low = [np.diff(v)[np.diff(v) <= np.quantile(np.diff(v), 0.05)].mean() / base[r] for r, v in runs.items()]
    assert row.lower_cvar_on_diffs == pytest.approx(np.mean(low))
    off = {r.run: r for r in offline_reliability(df.select("run", "value")).collect()}
    for r, v in runs.items():
        m = np.median(v)
        assert off[r].iqr_across_rollouts == pytest.approx((np.quantile(v, .75) - np.quantile(v, .25)) / m)
        assert off[r].mad_across_rollouts == pytest.approx(np.median(np.abs(v - m)) / m)


def test_frontier(spark):
    same = spark.createDataFrame([(0, 0.5, 0.5), (1, 0.5, 0.5)], "cluster int, p double, q double")
    apart = spark.createDataFrame([(0, 1.0, 0.0), (1, 0.0, 1.0)], "cluster int, p double, q double")
    assert frontier_area(same).first().mauve == pytest.approx(1.0, abs=1e-3)
    assert frontier_area(apart).first().mauve < 0.05
    rng = np.random.default_rng(1)
    p = spark.createDataFrame([(v.tolist(),) for v in rng.normal(size=(60, 4)) + [5, 0, 0, 0]], "features array<double>")
    q = spark.createDataFrame([(v.tolist(),) for v in rng.normal(size=(60, 4)) - [5, 0, 0, 0]], "features array<double>")
    assert mauve(p, q, num_buckets=4, redo=1).first().mauve < 0.2


def test_registry():
    assert {"mse", "wer", "roc_auc", "f1", "spearmanr"} <= set(core.names())
    with pytest.raises(KeyError):
        core.get("nope")


def test_catalogue_is_consistent():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert len(queries) > 100


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["phenotype_id", "variant_id", "slope", "A1", "A2", "sample_id", "sequence", "snp_relative_pos"]
    assert df.count() > 0


def test_slices_are_dealt_in_one_reading(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(200).withColumnRenamed("id", "record_id").repartition(5).write.parquet(source)
    query = jobs.deal_to_workers(jobs.read_parquet_stream(spark, source, "record_id long", files_per_batch=2), 3, sink, sink + "-c")
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 200
    for worker in range(3):
        own = [r.record_id for r in spark.read.parquet(f"{sink}/worker={worker}").collect()]
        assert sorted(own) == list(range(worker, 200, 3))


def test_the_newest_metrics_are_read_alone(spark, tmp_path):
    for epoch, value in ((2, 1.0), (10, 3.0), (9, 2.0)):
        spark.createDataFrame([(value,)], "mse double").write.parquet(str(tmp_path / "m" / f"epoch={epoch}"))
    newest = jobs.newest_metrics(spark, str(tmp_path / "m"))
    assert [tuple(r) for r in newest.collect()] == [(3.0,)]
    assert all("epoch=10" in f for f in newest.inputFiles())


def test_salted_join_deals_large_facts_over_more_tasks(spark, monkeypatch, capsys):
    """What a task sorts is bounded by rows, not by the session's number of shuffle partitions."""
    from peakweave.operators import joins

    facts = spark.createDataFrame([(i % 7 if i % 5 else None, i) for i in range(400)], "k int, x int")
    table = spark.createDataFrame([(k, k * 10) for k in range(7)], "k int, y int")
    want = sorted((r.k, r.x, r.y) for r in joins.salted_join(facts, table, ["k"], salts=3).collect())
    monkeypatch.setattr(joins, "TASK_ROWS", 20)
    spread = joins.salted_join(facts, table, ["k"], salts=3)
    spread.explain()
    assert "Broadcast" not in capsys.readouterr().out
    assert spread.rdd.getNumPartitions() == 20
    assert sorted((r.k, r.x, r.y) for r in spread.collect()) == want and len(want) == 320
