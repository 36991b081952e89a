import numpy as np
import pytest
from pyspark.sql import functions as F

from peakweave.functions import arrays as a
from peakweave.functions import sequences as s
from peakweave.operators import joins
from peakweave.operators.pooling import masked_mean_rows, pool_rows


def one(spark, expr, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]) if cols else spark.range(1)
    return df.select(expr.alias("x")).first().x


def test_encode_decode(spark):
    assert one(spark, s.encode("t"), t="ACGTNaX") == [7, 8, 9, 10, 11, 6, 6]
    assert one(spark, s.encode("t"), t="") == []
    assert one(spark, s.decode(F.array(*map(F.lit, [0, 7, 8, 6, 1])))) == "[CLS]AC[UNK][SEP]"


def test_specials(spark):
    a_, b_ = F.array(F.lit(7), F.lit(8)), F.array(F.lit(9))
    assert one(spark, s.add_special_tokens(a_)) == [0, 7, 8, 1]
    assert one(spark, s.add_special_tokens(a_, b_)) == [0, 7, 8, 1, 9, 1]
    assert one(spark, s.special_tokens_mask(a_, b_)) == [1, 0, 0, 1, 0, 1]
    assert one(spark, s.token_type_ids(a_, b_)) == [0, 0, 0, 0, 1, 1]


def test_padding(spark):
    ids = F.array(F.lit(7), F.lit(8))
    assert one(spark, s.pad_left(ids, 4)) == [4, 4, 7, 8]
    assert one(spark, s.pad_left(F.array(F.lit(7), F.lit(8), F.lit(9)), 2)) == [8, 9]
    assert one(spark, s.pad_right(ids, 4, 0)) == [7, 8, 0, 0]
    assert one(spark, s.pad_mask(ids, 3)) == [1, 1, 0]
    assert one(spark, s.trim_left_padded(F.array(*map(F.lit, [4, 4, 7, 8])), F.lit(2))) == [7, 8]


def test_variant_offset(spark):
    rows = [("chr1:2050048-2050549", "chr1_2050397", 349), ("chr1:3810120-3810621", "chr1_3810287", 167),
            ("chr1:10525152-10525653", "chr1_10525470", 318)]
    df = spark.createDataFrame(rows, "p string, v string, want int")
    assert all(r.want == r.got for r in df.withColumn("got", s.variant_offset("v", "p")).collect())
    got = df.select(s.parse_interval("p").alias("i")).first().i
    assert (got.chrom, got.start, got.end) == ("chr1", 2050048, 2050549)


def adaptive(block, n):
    L = len(block)
    return [np.mean(block[(i * L) // n: -((-(i + 1) * L) // n)], axis=0) for i in range(n)]


@pytest.mark.parametrize("L,n", [(3, 2), (1, 3), (7, 7), (10, 4), (4, 10)])
def test_adaptive_pool(spark, L, n):
    rng = np.random.default_rng(L * 31 + n)
    block = rng.normal(size=(L, 3))
    df = spark.createDataFrame([(block.tolist(),)], "b array<array<double>>")
    got = df.select(a.adaptive_pool("b", n).alias("x")).first().x
    np.testing.assert_allclose(got, adaptive(block, n))
    long = spark.createDataFrame([("s", i, v.tolist()) for i, v in enumerate(block)],
                                 "g string, i int, v array<double>").repartition(3)
    got = pool_rows(long, "g", ["i"], "v", n).first().block
    np.testing.assert_allclose(got, adaptive(block, n))


def test_pool_modes(spark):
    block = np.arange(12.0).reshape(4, 3) ** 1.5
    df = spark.createDataFrame([(block.tolist(),)], "b array<array<double>>")
    means = np.cumsum(block, 0) / np.arange(1, 5)[:, None]
    want = {"first": block[:2], "last": block[-2:], "mean": means[-2:], "max": block.max(0)[None], "sum": block.sum(0)[None]}
    for mode, expected in want.items():
        np.testing.assert_allclose(df.select(a.pool("b", mode, 2).alias("x")).first().x, expected)
    np.testing.assert_allclose(df.select(a.pool("b", "mean", 9).alias("x")).first().x, means)
    np.testing.assert_allclose(df.select(a.sequence_pool("b", "sum", 3).alias("x")).first().x, np.cumsum(block, 0)[-3:])
    np.testing.assert_allclose(df.select(a.sequence_pool("b", "pool", length=F.lit(2)).alias("x")).first().x, means[1:2])
    assert len(df.select(a.sequence_pool("b", "ragged", length=F.lit(3)).alias("x")).first().x) == 3
    np.testing.assert_allclose(df.select(a.masked_mean("b", F.lit(2)).alias("x")).first().x, block[:2].mean(0))
    with pytest.raises(NotImplementedError):
        a.pool("b", "weighted")
    long = spark.createDataFrame([("s", i, v.tolist()) for i, v in enumerate(block)], "g string, i int, v array<double>")
    np.testing.assert_allclose(masked_mean_rows(long, "g", "v", "i < 2").first().embedding, block[:2].mean(0))


def test_attach_cells_drops_unmatched(spark):
    seqs = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "sample string, record_id int")
    cells = spark.createDataFrame([("a", 0, [1.0, 2.0]), ("a", 1, [3.0, 4.0])], "sample string, cell_id int, embedding array<double>")
    for salts in (None, 3):
        got = joins.attach_cells(seqs, cells, 1, salts).collect()
        assert {r.record_id: r.cell_embedding for r in got} == {1: [[2.0, 3.0]], 2: [[2.0, 3.0]]}
    assert [(r["sample"], r.n_sequences) for r in joins.samples_without_cells(seqs, cells).collect()] == [("b", 1)]


def test_matrix_lookup_strict(spark):
    seqs = spark.createDataFrame([("a", "p"), ("a", "q")], "sample string, pos string")
    matrix = spark.createDataFrame([("a", "p", 0.1)], "sample string, pos string, value double")
    got = {r.pos: r for r in joins.matrix_lookup(seqs, matrix, strict=False).collect()}
    assert got["q"].norm_peak_value is None
    assert got["p"].norm_peak_value == np.float32(0.1)
    assert got["p"].log1p_norm_peak_value == np.log1p(np.float32(0.1))
    with pytest.raises(Exception, match="not in the matrix"):
        joins.matrix_lookup(seqs, matrix).collect()


def test_stream_is_not_shuffled_to_a_small_table(spark, tmp_path):
    """The pooled cells are stored, so their size is known and a small table is broadcast; json shards may be finished when written."""
    from peakweave.operators import joins
    from peakweave.plans import sequence_dataset
    from peakweave.sources.datasets import write_json_shards
    from peakweave.streaming import jobs

    rows = spark.createDataFrame([(i, str(i % 4), float(i), "ACGTN"[: i % 5 + 1]) for i in range(20)], "record_id long, sample string, peak_value double, seq string")
    shards = str(tmp_path / "shards")
    write_json_shards(rows, shards, 3, compression="gzip", finish=lambda df: sequence_dataset.tokenize(df).drop("seq", "attention_mask"))
    schema = "record_id long, sample string, peak_value double, input_ids array<int>"
    cells = spark.createDataFrame([(c, str(c % 3), [float(c), 1.0]) for c in range(9)], "cell_id int, sample string, embedding array<double>")
    pooled = joins.pool_cells(cells, 2)
    batch = jobs.attach_pooled_cells(spark.read.schema(schema).option("recursiveFileLookup", "true").json(shards), pooled, seq_max_len=4)
    assert batch.columns == ["sample", "seq_input_ids", "seq_len", "peak_value", "sample_record_id", "cell_embedding"]
    sink = str(tmp_path / "sink")
    stream = jobs.attach_pooled_cells(jobs.read_json_stream(spark, shards, schema), pooled, seq_max_len=4)
    query = jobs.write_parquet_stream(stream, sink, sink + "-c")
    query.awaitTermination()
    found = spark.read.parquet(sink).collect()
    assert sorted(r.sample_record_id for r in found) == [i for i in range(20) if i % 4 < 3]
    want = {i: [] for i in range(20)}
    assert {r.sample_record_id: (r.seq_len, len(r.seq_input_ids)) for r in found} == {i: (min(i % 5 + 1, 4), 4) for i in want if i % 4 < 3}
    # a shuffle would have kept its state of partitions; the broadcast plan reads the stored table by name
    assert any("pooled-cells" in f for f in batch.inputFiles())
