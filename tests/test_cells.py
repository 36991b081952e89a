import numpy as np
import pytest
from pyspark.sql import functions as F

from peakweave.operators import cells as cl
from peakweave.operators.quantiles import group_quantiles, median_absolute_deviation
from peakweave.sources.matrix import CellMatrix, read_cell_matrix, write_cell_matrix

RNG = np.random.default_rng(12)
DENSE = RNG.poisson(1.2, size=(40, 25)) * RNG.integers(1, 9, size=(40, 25))
DENSE[:, 7] = 0
DENSE[3] = 0


@pytest.fixture(scope="module")
def matrix(spark):
    rows = [(f"c{i:02d}", f"g{j:02d}", float(v)) for i, r in enumerate(DENSE) for j, v in enumerate(r) if v]
    obs = spark.createDataFrame([(f"c{i:02d}", f"s{i % 3}", "T") for i in range(40)], "cell_id string, sample string, cell_type string")
    var = spark.createDataFrame([(f"g{j:02d}", f"N{j}") for j in range(25)], "gene string, gene_name string")
    return CellMatrix(obs, var, spark.createDataFrame(rows, "cell_id string, gene string, value double").repartition(5))


def dense(df, column):
    out = np.zeros(DENSE.shape)
    for r in df.collect():
        out[int(r.cell_id[1:]), int(r.gene[1:])] = r[column]
    return out


def test_qc(matrix):
    full = cl.add_qc(matrix)
    cells = {r.cell_id: r for r in full.obs.collect()}
    assert cells["c03"].total_counts == 0 and cells["c03"].n_genes_by_counts == 0
    assert cells["c01"].total_counts == DENSE[1].sum()
    genes = {r.gene: r for r in full.var.collect()}
    assert genes["g07"].pct_dropout_by_counts == 100.0
    assert genes["g02"].mean_counts == pytest.approx(DENSE[:, 2].mean())
    assert genes["g02"].pct_dropout_by_counts == pytest.approx(100 * (DENSE[:, 2] == 0).mean())


def test_cells_are_filtered_before_genes(matrix):
    kept = cl.filter_cells_then_genes(matrix, 16, 20)
    rows = (DENSE > 0).sum(1) >= 16
    cols = (DENSE[rows] > 0).sum(0) >= 20
    assert {r.cell_id for r in kept.obs.collect()} == {f"c{i:02d}" for i in np.where(rows)[0]}
    assert {r.gene for r in kept.var.collect()} == {f"g{j:02d}" for j in np.where(cols)[0]}
    assert kept.counts.count() == (DENSE[np.ix_(rows, cols)] > 0).sum()


def test_normalise_and_bin(matrix):
    out = cl.bin_expression(cl.normalize_log1p(matrix.counts))
    totals = DENSE.sum(1, keepdims=True)
    logged = np.log1p(np.divide(DENSE * 1e4, totals, where=totals > 0, out=np.zeros(DENSE.shape)))
    np.testing.assert_allclose(dense(out, "X_log1p"), logged)
    got = dense(out, "X_binned")
    for i, row in enumerate(logged):
        live = row[row > 0]
        if not len(live):
            continue
        # a hair above each value decides ties between a value and an interpolated edge for the value
        edges = np.quantile(live, np.linspace(0, 1, 50))
        np.testing.assert_array_equal(got[i][row > 0], np.digitize(live + 1e-9, edges))
    assert got.max() == 50


def test_highly_variable_genes(matrix):
    got = [r.gene for r in cl.highly_variable_genes(matrix.counts, matrix.obs, 6).collect()]
    x = DENSE[:, DENSE.sum(0) > 0]
    names = [f"g{j:02d}" for j in range(25) if DENSE[:, j].sum() > 0]
    mean, var = x.mean(0), x.var(0, ddof=1)
    disp = var / mean
    edges = np.percentile(mean, np.arange(10, 105, 5))
    which = np.array([(edges < m).sum() for m in mean])
    norm = np.full(len(mean), -np.inf)
    for b in set(which):
        d = disp[which == b] - np.median(disp[which == b])
        mad = np.median(np.abs(d)) / 0.6744897501960817
        if mad:
            norm[which == b] = d / mad
    assert got == [names[i] for i in sorted(range(len(names)), key=lambda i: (-round(norm[i], 9), names[i]))[:6]]
    assert cl.highly_variable_genes(matrix.counts, matrix.obs, 5, batch="sample").count() == 5


def test_quality_gate(matrix, spark):
    vocab = spark.createDataFrame([(f"N{j}", j + 3) for j in range(10)], "gene string, id int")
    with pytest.raises(Exception, match="too few genes"):
        cl.prepare_for_binning(matrix, vocab).counts.count()
    out = cl.prepare_for_binning(matrix, vocab, cl.CellParams(min_matched_fraction=0.4, n_hvg=4))
    assert out.counts.select("gene").distinct().count() == 4


def test_rank_recipe_and_tokens(matrix, spark):
    gene_map = spark.createDataFrame([(f"N{j}", f"E{j}") for j in range(20)], "key string, value string")
    params = cl.CellParams(min_genes_per_cell=5, min_cells_per_gene=3)
    kept, var = cl.prepare_for_ranking(matrix, gene_map, params)
    assert var.count() == 24 and kept.var.count() == 19
    tokens = spark.createDataFrame([(f"E{j}", 100 + j, 1.0 + j % 3) for j in range(15)], "ensembl_id string, token int, median double")
    got = {r.cell_id: r.input_ids for r in cl.rank_tokens(kept, tokens, model_input_size=5).collect()}
    for cell, ids in got.items():
        row = DENSE[int(cell[1:])]
        scored = [(-row[j] / row.sum() * 1e4 / (1.0 + j % 3), 100 + j) for j in range(15) if row[j] > 0 and j != 7]
        assert ids == [t for _, t in sorted(scored)[:5]]
    with pytest.raises(ValueError):
        cl.rank_tokens(kept, tokens, keep=("nope",))


def test_binned_tokens(matrix, spark):
    vocab = spark.createDataFrame([("<cls>", 0), ("<pad>", 1)] + [(f"N{j}", j + 3) for j in range(24)], "gene string, id int")
    out = cl.prepare_for_binning(matrix, vocab, cl.CellParams())
    rows = {r.cell_id: r for r in cl.binned_tokens(out, vocab).collect()}
    assert len({len(r.genes) for r in rows.values()}) == 1
    assert rows["c03"].genes[0] == 0 and set(rows["c03"].genes[1:]) == {1}
    assert set(rows["c03"]["values"][1:]) == {-2.0} and rows["c01"]["values"][0] == 0.0
    short = cl.binned_tokens(out, vocab, max_length=4, padding=False).collect()
    assert max(len(r.genes) for r in short) == 4 and all(r.genes[0] == 0 for r in short)
    full = cl.binned_tokens(out, vocab, include_zero=True, padding=False).collect()
    assert {len(r.genes) for r in full} == {1 + out.var.count()}


def test_raw_counts_and_ids(matrix, spark):
    var = matrix.var.withColumn("ensembl_id", F.lit("E"))
    assert cl.map_gene_ids(var, None).count() == 25
    with pytest.raises(ValueError):
        cl.map_gene_ids(matrix.var, None)
    with pytest.warns(UserWarning):
        assert cl.gene_name_column(matrix.var.drop("gene_name")) == "gene"
    raw = matrix.with_(raw=matrix.counts.withColumn("value", F.lit(1.0)), var=matrix.var.limit(3))
    assert cl.with_raw_counts(raw, cl.CellParams(use_raw=True)).counts.select("gene").distinct().count() <= 3
    with pytest.warns(UserWarning):
        assert cl.with_raw_counts(raw, cl.CellParams(use_raw=True, count_raw_data=True)).counts is raw.counts


def test_matrix_round_trip(matrix, spark, tmp_path):
    write_cell_matrix(matrix.with_(raw=matrix.counts), str(tmp_path / "m"))
    back = read_cell_matrix(spark, str(tmp_path / "m"))
    assert back.raw is not None
    row = back.shape().first()
    assert (row.n_cells, row.n_genes) == (40, 25)


def test_group_quantiles(spark):
    data = {g: RNG.normal(size=n).round(2) for g, n in (("a", 1), ("b", 2), ("c", 57))}
    df = spark.createDataFrame([(g, float(v)) for g, vs in data.items() for v in vs], "g string, v double").repartition(6)
    for r in group_quantiles(df, "v", {"q": 0.3, "m": 0.5}, ["g"]).collect():
        assert r.q == pytest.approx(np.quantile(data[r.g], 0.3))
        assert r.m == pytest.approx(np.median(data[r.g]))
    assert group_quantiles(df, "v", {"m": 0.9}).first().m == pytest.approx(np.quantile(np.concatenate(list(data.values())), 0.9))
    for r in median_absolute_deviation(df, "v", ["g"]).collect():
        assert r.mad == pytest.approx(np.median(np.abs(data[r.g] - np.median(data[r.g]))))


def loess(x, y, at, span=0.3):
    """Direct local quadratic fits."""
    q = int(len(x) * span + 1e-5)
    out = []
    for v in at:
        d = np.abs(x - v)
        h = np.sort(d)[q - 1]
        w = np.where(d < h, (1 - (d / h) ** 3) ** 3, 0)
        out.append(np.polyfit(x - v, y, 2, w=np.sqrt(w))[-1])
    return np.array(out)


def test_local_regression(spark):
    from peakweave.operators.smoothing import local_regression

    rng = np.random.default_rng(6)
    x = np.sort(rng.uniform(-2, 3, 400))
    df = spark.createDataFrame([(i, float(v), float(v * v - v)) for i, v in enumerate(x)], "i int, x double, y double").repartition(4)
    got = {r.i: r.fitted for r in local_regression(df, "x", "y", ["i"]).collect()}
    # a quadratic is reproduced at the vertices, and cubic blending keeps it in between
    np.testing.assert_allclose([got[i] for i in range(400)], x * x - x, atol=1e-8)
    y = np.sin(2 * x) + rng.normal(size=400) * 0.1
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "i int, x double, y double")
    got = {r.i: r.fitted for r in local_regression(df, "x", "y", ["i"]).collect()}
    np.testing.assert_allclose([got[i] for i in range(400)], loess(x, y, x), atol=0.02)


def test_variance_stabilized_genes(spark):
    rng = np.random.default_rng(3)
    counts = rng.poisson(rng.gamma(2, 2, size=(1, 80)), size=(60, 80))
    rows = [(i, j, float(v)) for i, r in enumerate(counts) for j, v in enumerate(r) if v]
    df = spark.createDataFrame(rows, "cell_id int, gene int, value double").repartition(3)
    obs = spark.createDataFrame([(i,) for i in range(60)], "cell_id int")
    got = [r.gene for r in cl.variance_stabilized_genes(df, obs, 10).collect()]
    mean, var = counts.mean(0), counts.var(0, ddof=1)
    sd = np.sqrt(10 ** loess(np.log10(mean), np.log10(var), np.log10(mean)))
    x = np.minimum(counts, mean + sd * np.sqrt(60))
    norm = (60 * mean ** 2 + (x ** 2).sum(0) - 2 * mean * x.sum(0)) / (59 * sd ** 2)
    assert len(set(got) & set(np.argsort(-norm)[:12])) >= 9


def test_rank_tokens_read_the_counts_once_more_after_the_statistics(spark, matrix, tmp_path):
    write_cell_matrix(matrix, str(tmp_path / "m"))
    stored = read_cell_matrix(spark, str(tmp_path / "m"))
    ids = spark.createDataFrame([(f"N{j}", f"E{j}") for j in range(25)], "key string, value string")
    tokens = spark.createDataFrame([(f"E{j}", 3 * j, 1.0 + j) for j in range(25)], "ensembl_id string, token int, median double")
    prepared, _ = cl.prepare_for_ranking(stored, ids, cl.CellParams(min_genes_per_cell=5, min_cells_per_gene=5))
    out = cl.rank_tokens(prepared, tokens, keep=("cell_type", "sample", "adata_order"))
    found = {r.cell_id: r.input_ids for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") <= 4 and plan.count("/counts") <= 2, plan
    i = 1
    want = sorted((j for j in range(25) if DENSE[i, j] and (DENSE[:, j] > 0).sum() >= 5), key=lambda j: (-DENSE[i, j] / (1.0 + j), 3 * j))
    assert found["c01"] == [3 * j for j in want]


def test_recipes_by_name():
    assert cl.recipe("rank") == (cl.prepare_for_ranking, cl.rank_tokens)
    assert cl.recipe("bin") == (cl.prepare_for_binning, cl.binned_tokens)
    with pytest.raises(KeyError, match="known"):
        cl.recipe("other")


def test_stabilized_genes_by_batch(spark):
    """Each batch has the values it has alone; genes are merged by median rank, then by the number of batches."""
    rng = np.random.default_rng(8)
    sizes, rows, cells = (40, 55, 30), [], []
    for b, n in enumerate(sizes):
        name = [None, "b1", "b2"][b]
        counts = rng.poisson(rng.gamma(2, 2 + b, size=(1, 70)), size=(n, 70))
        counts[:, 5] = 0 if b else counts[:, 5]  # a gene two batches have no counts of
        cells += [(100 * b + i, name) for i in range(n)]
        rows += [(100 * b + i, j, float(v)) for i, r in enumerate(counts) for j, v in enumerate(r) if v]
    df = spark.createDataFrame(rows, "cell_id int, gene int, value double").repartition(3)
    obs = spark.createDataFrame(cells, "cell_id int, batch string")
    together = {(r.batch, r.gene): r.variance_norm for r in cl.stabilized_variance(df, obs, batch="batch").collect()}
    ranks = {}
    for name in (None, "b1", "b2"):
        own = obs.filter(F.col("batch").eqNullSafe(F.lit(name)))
        alone = {r.gene: r.variance_norm for r in cl.stabilized_variance(df.join(own, "cell_id", "left_semi"), own).collect()}
        assert {g: v for (b, g), v in together.items() if b == name} == pytest.approx(alone)
        for i, g in enumerate(sorted(alone, key=lambda g: (-round(alone[g], 9), g))):
            if i < 20:
                ranks.setdefault(g, []).append(i)
    want = sorted(ranks, key=lambda g: (np.median(ranks[g]), -len(ranks[g]), g))[:20]
    got = cl.variance_stabilized_genes(df, obs, 20, batch="batch").collect()
    assert [r.gene for r in got] == want
    assert [(r.n_batches, r.median_rank) for r in got] == [(len(ranks[g]), np.median(ranks[g])) for g in want]
    assert got[0].variance_norm == pytest.approx(sum(v for (_, g), v in together.items() if g == want[0]) / 3)


def test_binning_recipe_selects_per_batch(spark):
    rng = np.random.default_rng(4)
    counts = rng.poisson(rng.gamma(2, 2, size=(1, 60)), size=(50, 60))
    rows = [(i, j, float(v)) for i, r in enumerate(counts) for j, v in enumerate(r) if v]
    obs = spark.createDataFrame([(i, i % 2) for i in range(50)], "cell_id int, batch int")
    var = spark.createDataFrame([(j, f"N{j}") for j in range(60)], "gene int, gene_name string")
    vocab = spark.createDataFrame([(f"N{j}",) for j in range(60)], "gene string")
    matrix = CellMatrix(obs, var, spark.createDataFrame(rows, "cell_id int, gene int, value double"))
    params = cl.CellParams(n_hvg=12, hvg_flavor="seurat_v3", min_matched_fraction=0.5)
    out = cl.prepare_for_binning(matrix, vocab, params, batch="batch")
    assert out.counts.select("gene").distinct().count() == 12
