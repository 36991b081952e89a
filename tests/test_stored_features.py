import numpy as np
import pytest
from pyspark.sql import functions as F

from peakweave.plans import features, stored_features


@pytest.fixture
def inputs(spark):
    rng = np.random.default_rng(1)
    rows = [(i, ["a", "b", "c", "none"][min(3, int(rng.integers(0, 9)) // 3) if i % 3 else 0], float(i) / 4, [int(x) for x in rng.integers(6, 12, 5 + i % 4)])
            for i in range(230)]
    tokenized = spark.createDataFrame(rows, "record_id bigint, sample string, label double, input_ids array<int>").repartition(3)
    cells = spark.createDataFrame([(k, s, [float(v) for v in rng.normal(size=3)]) for k, s in enumerate("aabbbccccc")], "cell_id int, sample string, embedding array<double>")
    return tokenized, cells


def test_batches_carry_each_block_once(spark, inputs, tmp_path):
    tokenized, cells = inputs
    stored_features.store_features(tokenized, cells, "feat", str(tmp_path), "label", 8, 4, buckets=3, part_rows=40)
    try:
        assert "block" not in spark.table("feat_sequences").columns
        assert spark.table("feat_blocks").schema["block"].dataType.simpleString() == "array<array<float>>"
        # the sample of a third of the rows has several parts
        assert spark.table("feat_sequences").filter("sample = 'a'").select("part").distinct().count() > 1
        batches = stored_features.read_batches(spark, "feat", 16)
        plan = batches._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 2, plan
        full = 0
        for r in batches.collect():
            n = len(r.seq_len)
            assert {len(r[c]) for c in (*stored_features.ROWS, "block_index")} == {n} and n <= 16
            full += n == 16
            assert sorted(set(r.block_index)) == list(range(len(r.blocks)))
            assert all(x != y for x, y in zip(r.blocks, r.blocks[1:]))
        assert full >= 230 // 16 - 3
        want = {r.sample_record_id: r for r in features.model_input(tokenized, cells, "label", 8, 4).collect()}
        got = {r.sample_record_id: r for r in stored_features.single_rows(batches).collect()}
        assert set(got) == set(want)
        for k, r in want.items():
            assert (got[k].seq_input_ids, got[k].seq_len, got[k].peak_value) == (r.seq_input_ids, r.seq_len, r.peak_value)
            np.testing.assert_allclose(got[k].cell_embedding, r.cell_embedding, rtol=1e-6)
    finally:
        for kind in ("sequences", "blocks"):
            spark.sql(f"DROP TABLE IF EXISTS feat_{kind}")


def test_no_cells_no_batches(spark, inputs, tmp_path):
    tokenized, cells = inputs
    stored_features.store_features(tokenized, cells.filter("false"), "nofeat", str(tmp_path), "label", 8, 4, buckets=2)
    try:
        assert stored_features.read_batches(spark, "nofeat").count() == 0
        assert stored_features.single_rows(stored_features.read_batches(spark, "nofeat")).columns[-1] == "cell_embedding"
    finally:
        for kind in ("sequences", "blocks"):
            spark.sql(f"DROP TABLE IF EXISTS nofeat_{kind}")
