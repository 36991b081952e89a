"""Single-cell queries."""

from __future__ import annotations

import warnings

from pyspark.sql import functions as F

from peakweave.operators import cells as cl
from peakweave.plans.queries.registry import joined, query, r
from peakweave.plans.queries.views import table, view
from peakweave.session import scratch_path
from peakweave.sources import datasets, matrix as mx
from peakweave.sources.matrix import CellMatrix


def cell_matrix(spark, sf, raw: bool = False) -> CellMatrix:
    counts = view(spark, sf, "counts")
    return CellMatrix(view(spark, sf, "obs"), view(spark, sf, "var_genes"), counts,
                      counts.withColumn("value", F.col("value") * 2) if raw else None)


def gene_map(spark, sf):
    return view(spark, sf, "var_genes").filter("ensembl_id is not null").select(
        F.col("gene_name").alias("key"), F.col("ensembl_id").alias("value"))


def vocabulary(spark, sf):
    """Token ids of the genes with an ensembl id, and the special tokens."""
    genes = view(spark, sf, "var_genes").filter("ensembl_id is not null").select(
        F.col("gene_name").alias("gene"), (F.col("gene") + 3).cast("int").alias("id"))
    special = spark.createDataFrame([("<cls>", 0), ("<pad>", 1), ("<eoc>", 2)], "gene string, id int")
    return genes.unionByName(special)


# --- scan and shape --------------------------------------------------------------------------

@query("""SELECT cell_id, sample, cell_type, gene, gene_name, value FROM obs LEFT JOIN counts USING (cell_id) LEFT JOIN var_genes USING (gene)""",
       ("obs", "var_genes", "counts"))
def cell_matrix_scan(spark, sf):
    """obs / var / counts written as parquet triplets and read back, every value with its cell and gene."""
    path = scratch_path(spark, "cell-matrix")
    mx.write_cell_matrix(cell_matrix(spark, sf), path)
    back = mx.read_cell_matrix(spark, path)
    rows = back.obs.join(back.counts, "cell_id", "left").join(back.var.select("gene", "gene_name"), "gene", "left")
    return rows.select("cell_id", "sample", "cell_type", "gene", "gene_name", "value")


@query("SELECT sample, count(*) AS n_cells FROM obs GROUP BY sample", ("obs",))
def cells_per_sample(spark, sf):
    return cl.cells_per_sample(view(spark, sf, "obs"))


@query("SELECT cell_id, cell_type FROM obs WHERE sample = '7'", ("obs",))
def cells_of_one_sample(spark, sf):
    """Equality filter, pushed to the scan."""
    return view(spark, sf, "obs").filter(F.col("sample") == "7").select("cell_id", "cell_type")


# --- genes -----------------------------------------------------------------------------------

@query("SELECT gene, gene_name, ensembl_id FROM var_genes", ("var_genes",))
def map_gene_names(spark, sf):
    """Gene names to ids by dictionary; unmapped genes stay with null."""
    var = view(spark, sf, "var_genes").drop("ensembl_id")
    return cl.map_gene_ids(var, gene_map(spark, sf)).select("gene", "gene_name", "ensembl_id")


@query("SELECT gene, cast(CASE WHEN ensembl_id IS NULL THEN -1 ELSE gene + 3 END AS INTEGER) AS id_in_vocab FROM var_genes", ("var_genes",))
def vocabulary_membership(spark, sf):
    return cl.vocabulary_ids(view(spark, sf, "var_genes"), vocabulary(spark, sf)).select("gene", "id_in_vocab")


@query("SELECT gene, cast(CASE WHEN ensembl_id IS NULL THEN -1 ELSE gene + 7 END AS INTEGER) AS id_in_vocab FROM var_genes", ("var_genes",))
def gene_key_fallback(spark, sf):
    """Without a column of gene names the gene key itself is looked up."""
    var = view(spark, sf, "var_genes")
    vocab = var.filter("ensembl_id is not null").select("gene", (F.col("gene") + 7).cast("int").alias("id"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return cl.vocabulary_ids(var.drop("gene_name"), vocab).select("gene", "id_in_vocab")


@query("SELECT count(*) AS n_genes, count(ensembl_id) AS n_matched, count(ensembl_id) / count(*) AS fraction FROM var_genes", ("var_genes",))
def matched_gene_fraction(spark, sf):
    var = view(spark, sf, "var_genes")
    matched = F.col("ensembl_id").isNotNull()
    cl.require_matched_fraction(var, matched, 0.6).agg(F.count(F.lit(1))).first()  # the gate itself
    return cl.matched_fraction(var, matched)


@query("SELECT cell_id, c.gene, value * 2 AS value FROM counts c JOIN var_genes v ON c.gene = v.gene WHERE ensembl_id IS NOT NULL", ("counts", "var_genes"))
def raw_counts_of_kept_genes(spark, sf):
    matrix = cell_matrix(spark, sf, raw=True)
    matrix = matrix.with_(var=matrix.var.filter("ensembl_id is not null"))
    return cl.with_raw_counts(matrix, cl.CellParams(use_raw=True)).counts.select("cell_id", "gene", "value")


# --- quality control -------------------------------------------------------------------------

@query("SELECT cell_id, count(*) FILTER (WHERE value > 0) AS n_genes_by_counts, sum(value) AS total_counts FROM counts GROUP BY cell_id", ("counts",))
def cell_quality(spark, sf):
    return cl.cell_qc(view(spark, sf, "counts"))


@query("""SELECT gene, count(*) FILTER (WHERE value > 0) AS n_cells_by_counts, round(sum(value) / (SELECT count(*) FROM obs), 9) AS mean_counts,
round((1 - count(*) FILTER (WHERE value > 0) / (SELECT count(*) FROM obs)) * 100, 6) AS pct_dropout_by_counts, sum(value) AS total_counts FROM counts GROUP BY gene""",
       ("counts", "obs"))
def gene_quality(spark, sf):
    """Means and dropout over all cells, absent zeros included."""
    out = cl.gene_qc(view(spark, sf, "counts"), view(spark, sf, "obs"))
    return out.withColumns({"mean_counts": r("mean_counts", 9), "pct_dropout_by_counts": r("pct_dropout_by_counts")})


KEPT_SQL = """kept_cells AS (SELECT cell_id FROM counts WHERE value > 0 GROUP BY cell_id HAVING count(*) >= {cells}),
left_counts AS (SELECT * FROM counts WHERE cell_id IN (SELECT cell_id FROM kept_cells)),
kept_genes AS (SELECT gene FROM left_counts WHERE value > 0 GROUP BY gene HAVING count(*) >= {genes})"""


@query(f"WITH {KEPT_SQL.format(cells=4, genes=18)} SELECT cell_id, gene, value FROM left_counts WHERE gene IN (SELECT gene FROM kept_genes)", ("counts",))
def filter_cells_then_genes(spark, sf):
    """Cells with few genes go first; genes are then counted on the remaining cells."""
    return cl.filter_cells_then_genes(cell_matrix(spark, sf), 4, 18).counts.select("cell_id", "gene", "value")


COUNT_FILTER_SQL = """kept_genes AS (SELECT gene FROM counts GROUP BY gene HAVING sum(value) >= {genes}),
some_counts AS (SELECT * FROM counts WHERE gene IN (SELECT gene FROM kept_genes)),
kept_cells AS (SELECT cell_id FROM some_counts GROUP BY cell_id HAVING sum(value) >= {cells}),
kept AS (SELECT * FROM some_counts WHERE cell_id IN (SELECT cell_id FROM kept_cells))"""


@query(f"WITH {COUNT_FILTER_SQL.format(genes=700, cells=50)} SELECT cell_id, gene, value FROM kept", ("counts",))
def filter_by_counts(spark, sf):
    return cl.filter_by_counts(cell_matrix(spark, sf), 700, 50).counts.select("cell_id", "gene", "value")


@query("""SELECT cell_id, gene, value, round(value * 10000 / sum(value) OVER (PARTITION BY cell_id), 6) + 0.0 AS normed,
round(ln(1 + value * 10000 / sum(value) OVER (PARTITION BY cell_id)), 6) + 0.0 AS log1p FROM counts""", ("counts",))
def normalize_log1p(spark, sf):
    out = cl.normalize_log1p(view(spark, sf, "counts"))
    return out.select("cell_id", "gene", "value", r("X_normed").alias("normed"), r("X_log1p").alias("log1p"))


HVG_SQL = """moments AS (SELECT {b} gene, sum(value) / any_value(n) AS mean,
  (sum(value * value) / any_value(n) - pow(sum(value) / any_value(n), 2)) * any_value(n) / (any_value(n) - 1) AS variance
  FROM data GROUP BY {b} gene),
disp AS (SELECT *, variance / CASE WHEN mean = 0 THEN 1e-12 ELSE mean END AS dispersion FROM moments),
edges AS (SELECT {b} quantile_cont(mean, [0.1::DOUBLE,0.15,0.2,0.25,0.3,0.35,0.4,0.45,0.5,0.55,0.6,0.65,0.7,0.75,0.8,0.85,0.9,0.95,1.0]) AS e FROM disp {g}),
binned AS (SELECT d.*, len(list_filter(e, lambda x: x < mean)) AS mean_bin FROM disp d {j}),
centred AS (SELECT *, dispersion - median(dispersion) OVER (PARTITION BY {b} mean_bin) AS dev FROM binned),
scaled AS (SELECT *, median(abs(dev)) OVER (PARTITION BY {b} mean_bin) / 0.6744897501960817 AS mad FROM centred),
scored AS (SELECT *, CASE WHEN mad <> 0 THEN dev / mad END AS dispersion_norm FROM scaled)"""


@query("WITH data AS (SELECT gene, value, (SELECT count(*) FROM obs) AS n FROM counts),\n"
       + HVG_SQL.format(b="", g="", j=", edges")
       + " SELECT gene, round(dispersion_norm, 6) + 0.0 AS dispersion_norm FROM scored ORDER BY round(scored.dispersion_norm, 9) DESC NULLS LAST, gene LIMIT 300",
       ("counts", "obs"))
def highly_variable_genes(spark, sf):
    """Top genes by dispersion against genes of similar mean; the top-n is the feature."""
    out = cl.highly_variable_genes(view(spark, sf, "counts"), view(spark, sf, "obs"), 300)
    return out.select("gene", r("dispersion_norm").alias("dispersion_norm"))


@query("""WITH batches AS (SELECT cell_type, count(*) AS n FROM obs GROUP BY cell_type),
data AS (SELECT o.cell_type, gene, value, n FROM counts c JOIN obs o ON c.cell_id = o.cell_id JOIN batches b ON b.cell_type = o.cell_type),
""" + HVG_SQL.format(b="cell_type,", g="GROUP BY cell_type", j="JOIN edges e ON e.cell_type = d.cell_type")
       + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY cell_type ORDER BY round(dispersion_norm, 9) DESC NULLS LAST, gene) AS place FROM scored)
SELECT gene, count(*) FILTER (WHERE place <= 300) AS n_batches, round(sum(coalesce(dispersion_norm, 0)) / (SELECT count(*) FROM batches), 6) + 0.0 AS dispersion_norm
FROM ranked GROUP BY gene ORDER BY n_batches DESC, round(sum(coalesce(ranked.dispersion_norm, 0)) / (SELECT count(*) FROM batches), 9) DESC, gene LIMIT 300""", ("counts", "obs"))
def highly_variable_genes_by_batch(spark, sf):
    out = cl.highly_variable_genes(view(spark, sf, "counts"), view(spark, sf, "obs"), 300, batch="cell_type")
    return out.select("gene", "n_batches", r("dispersion_norm").alias("dispersion_norm"))


# Loess in SQL: cuts of the tree by recursion, reach and moments per vertex, the 3x3 system by Cramer's rule. {b} is the group.
STABLE_SQL = """WITH RECURSIVE cell AS (SELECT cell_id, {b} AS b FROM obs), size AS (SELECT b, count(*)::DOUBLE AS cells FROM cell GROUP BY b),
c AS (SELECT cell_id, gene, value, b FROM counts JOIN cell USING (cell_id)),
mo AS (SELECT b, gene, sum(value) / cells AS mean, (sum(value * value) / cells - pow(sum(value) / cells, 2)) * cells / (cells - 1) AS variance FROM c JOIN size USING (b) GROUP BY b, gene, cells),
x AS (SELECT *, log10(mean) AS x, log10(variance) AS y, row_number() OVER (PARTITION BY b ORDER BY log10(mean), gene) - 1 AS i, count(*) OVER (PARTITION BY b) AS n FROM mo WHERE variance > 0),
g AS (SELECT b, n, least(n, floor(n * 0.3 + 1e-5))::BIGINT AS q, greatest(1, floor(n * 0.3 * 0.2))::BIGINT AS leaf, min(x) AS lo, max(x) AS hi FROM x GROUP BY b, n),
seg AS (SELECT b, 0::BIGINT AS a, n - 1 AS z, leaf FROM g UNION ALL
SELECT b, CASE WHEN h = 0 THEN a ELSE (a + z) // 2 + 1 END, CASE WHEN h = 0 THEN (a + z) // 2 ELSE z END, leaf FROM seg, (VALUES (0), (1)) t(h) WHERE z - a + 1 > leaf),
pt AS (SELECT DISTINCT b, v FROM (SELECT b, unnest([lo - m, hi + m]) AS v FROM (SELECT *, 0.005 * greatest(hi - lo, 1e-3 * greatest(abs(lo), abs(hi)) + 1e-30) AS m FROM g)
UNION ALL SELECT seg.b, sum(x.x) / 2 FROM seg JOIN x ON x.b = seg.b AND x.i IN ((a + z) // 2, (a + z) // 2 + 1) WHERE z - a + 1 > leaf GROUP BY seg.b, (a + z) // 2)),
win AS (SELECT x.b, x.x, e.x AS e FROM x JOIN g USING (b) JOIN x e ON e.b = x.b AND e.i = x.i + q - 1),
sp AS (SELECT pt.b, v, min(greatest(v - x, e - v)) AS h FROM pt JOIN win USING (b) GROUP BY ALL),
nr AS (SELECT sp.b, v, h, (x - v) / h AS u, y FROM sp JOIN x USING (b) WHERE abs((x - v) / h) < 0.999),
wt AS (SELECT *, CASE WHEN abs(u) > 0.001 THEN pow(1 - pow(abs(u), 3), 3) ELSE 1 END AS w FROM nr),
su AS (SELECT b, v, h, sum(w) AS s0, sum(w * u) AS s1, sum(w * u * u) AS s2, sum(w * pow(u, 3)) AS s3, sum(w * pow(u, 4)) AS s4, sum(w * y) AS t0, sum(w * y * u) AS t1, sum(w * y * u * u) AS t2 FROM wt GROUP BY ALL),
f AS (SELECT b, v, (t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)) / d AS f, (s0 * (t1 * s4 - t2 * s3) - t0 * (s1 * s4 - s2 * s3) + s2 * (s1 * t2 - s2 * t1)) / d / h AS s
FROM (SELECT *, s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2) AS d FROM su)),
p AS (SELECT *, lead(v) OVER o AS v1, lead(f) OVER o AS f1, lead(s) OVER o AS s1 FROM f WINDOW o AS (PARTITION BY b ORDER BY v)),
fit AS (SELECT x.b, gene, (1 - h) * (1 - h) * (1 + 2 * h) * f + h * h * (3 - 2 * h) * f1 + (v1 - v) * (h * (1 - h) * (1 - h) * s - h * h * (1 - h) * s1) AS fit
FROM x JOIN p ON p.b = x.b AND x.x > v AND x.x <= v1, (SELECT 1) one, LATERAL (SELECT (x.x - v) / (v1 - v) AS h) l),
sc AS (SELECT mo.b, mo.gene, mean, cells, sqrt(pow(10, coalesce(fit, 0))) AS sd FROM mo JOIN size USING (b) LEFT JOIN fit ON fit.b = mo.b AND fit.gene = mo.gene),
nv AS (SELECT b, gene, (cells * mean * mean + sum(pow(least(value, mean + sd * sqrt(cells)), 2)) - 2 * mean * sum(least(value, mean + sd * sqrt(cells)))) / ((cells - 1) * sd * sd) AS norm
FROM c JOIN sc USING (b, gene) GROUP BY b, gene, cells, mean, sd)"""


@query(STABLE_SQL.format(b="0") + " SELECT gene, round(norm, 4) + 0.0 AS variance_norm FROM nv ORDER BY round(norm, 9) DESC, gene LIMIT 300", ("obs", "counts"))
def variance_stabilized_genes(spark, sf):
    """Top genes by clipped standardised variance."""
    return cl.variance_stabilized_genes(view(spark, sf, "counts"), view(spark, sf, "obs"), 300).select(
        "gene", r("variance_norm", 4).alias("variance_norm"))


@query(STABLE_SQL.format(b="cell_type") + """, k AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY round(norm, 9) DESC, gene) - 1 AS i FROM nv),
m AS (SELECT gene, count(*) FILTER (WHERE i < 300) AS n_batches, median(i) FILTER (WHERE i < 300) AS median_rank, sum(norm) / (SELECT count(*) FROM size) AS norm FROM k GROUP BY gene)
SELECT gene, n_batches, cast(median_rank AS DOUBLE) AS median_rank, round(norm, 4) + 0.0 AS variance_norm FROM m ORDER BY median_rank NULLS LAST, n_batches DESC, gene LIMIT 300""", ("obs", "counts"))
def variance_stabilized_genes_by_batch(spark, sf):
    """The same with an expected variance per batch, merged by median rank."""
    out = cl.variance_stabilized_genes(view(spark, sf, "counts"), view(spark, sf, "obs"), 300, batch="cell_type")
    return out.select("gene", "n_batches", "median_rank", r("variance_norm", 4).alias("variance_norm"))


BIN_SQL = """placed AS (SELECT *, count(*) OVER (PARTITION BY cell_id ORDER BY {v} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS k,
  count(*) OVER (PARTITION BY cell_id) AS m FROM {t}),
binned AS (SELECT *, cast(len(list_filter(range(50), lambda j: j * (m - 1) <= 49 * k)) AS INTEGER) AS bin FROM placed)"""


@query(f"WITH {BIN_SQL.format(v='value', t='counts')} SELECT cell_id, gene, value, bin FROM binned", ("counts",))
def bin_expression(spark, sf):
    """51 quantile bins per cell over the non-zero values."""
    return cl.bin_expression(view(spark, sf, "counts"), "value").select("cell_id", "gene", "value", F.col("X_binned").alias("bin"))


# --- recipes ---------------------------------------------------------------------------------

RANK_PREP_SQL = f"""{KEPT_SQL.format(cells=4, genes=18)},
n_counts AS (SELECT cell_id, sum(value) AS n_counts FROM counts GROUP BY cell_id),
prepared AS (SELECT c.cell_id, c.gene, value, n_counts, ensembl_id, gene_median FROM left_counts c JOIN n_counts n ON c.cell_id = n.cell_id
  JOIN var_genes v ON v.gene = c.gene WHERE c.gene IN (SELECT gene FROM kept_genes) AND ensembl_id IS NOT NULL)"""
RANK_PARAMS = cl.CellParams(min_genes_per_cell=4, min_cells_per_gene=18)


def ranked_matrix(spark, sf):
    matrix = cell_matrix(spark, sf)
    return cl.prepare_for_ranking(matrix.with_(var=matrix.var.drop("ensembl_id")), gene_map(spark, sf), RANK_PARAMS)


@query(f"WITH {RANK_PREP_SQL} SELECT cell_id, gene, value, n_counts FROM prepared", ("counts", "var_genes"))
def prepare_for_ranking(spark, sf):
    """Ids, quality control, filters, gate, unmatched genes dropped; n_counts as before the filters."""
    matrix, _ = ranked_matrix(spark, sf)
    return matrix.counts.join(matrix.obs.select("cell_id", "n_counts"), "cell_id").select("cell_id", "gene", "value", "n_counts")


@query(f"""WITH {KEPT_SQL.format(cells=4, genes=18)} SELECT gene, gene_name, ensembl_id, ensembl_id IS NOT NULL AS has_ensembl_match
FROM var_genes WHERE gene IN (SELECT gene FROM kept_genes)""", ("counts", "var_genes"))
def gene_table_export(spark, sf):
    """The gene table as CSV, taken before the unmatched genes are dropped."""
    path = scratch_path(spark, "var-csv")
    _, var = ranked_matrix(spark, sf)
    datasets.write_csv(var.select("gene", "gene_name", "ensembl_id", "has_ensembl_match"), path)
    return spark.read.csv(path, header=True, schema="gene long, gene_name string, ensembl_id string, has_ensembl_match boolean")


@query(f"""WITH {RANK_PREP_SQL}, genes AS (SELECT count(*) AS n, count(ensembl_id) AS m FROM var_genes WHERE gene IN (SELECT gene FROM kept_genes))
SELECT (SELECT count(*) FROM kept_cells) AS preprocessed__n_cells, m AS preprocessed__n_genes, round(m / n, 9) AS fract_genes_in_vocab, 4 AS min_genes_per_cell FROM genes""",
       ("counts", "var_genes"))
def run_config_record(spark, sf):
    """Lineage record of a preparation run, written and read as JSON."""
    path = scratch_path(spark, "run-config")
    matrix, var = ranked_matrix(spark, sf)
    summary = cl.run_summary(matrix, var, F.col("ensembl_id").isNotNull())
    datasets.write_run_config(summary, {"min_genes_per_cell": 4}, path)
    back = spark.read.schema("preprocessed__n_cells long, preprocessed__n_genes long, fract_genes_in_vocab double, min_genes_per_cell int").json(path)
    return back.withColumn("fract_genes_in_vocab", r("fract_genes_in_vocab", 9))


BIN_PREP_SQL = f"""in_vocab AS (SELECT cell_id, c.gene, value FROM counts c JOIN var_genes v ON c.gene = v.gene WHERE ensembl_id IS NOT NULL),
kept_genes AS (SELECT gene FROM in_vocab GROUP BY gene HAVING sum(value) >= 700),
kept AS (SELECT * FROM in_vocab WHERE gene IN (SELECT gene FROM kept_genes)),
logged AS (SELECT *, ln(1 + value * 10000 / sum(value) OVER (PARTITION BY cell_id)) AS x FROM kept)"""
BIN_PARAMS = cl.CellParams(min_counts_per_gene=700)


def binned_matrix(spark, sf, **params):
    matrix = cell_matrix(spark, sf)
    options = {**BIN_PARAMS.__dict__, **params}
    return cl.prepare_for_binning(matrix, vocabulary(spark, sf), cl.CellParams(**options))


@query(f"WITH {BIN_PREP_SQL}, {BIN_SQL.format(v='x', t='logged')} SELECT cell_id, gene, value, round(x, 6) + 0.0 AS log1p, bin FROM binned",
       ("counts", "var_genes"))
def prepare_for_binning(spark, sf):
    """Vocabulary gate, count filter, normalise, log1p and bin."""
    return binned_matrix(spark, sf).counts.select("cell_id", "gene", "value", r("X_log1p").alias("log1p"), F.col("X_binned").alias("bin"))


TOKENS_SQL = f"""WITH {BIN_PREP_SQL}, {BIN_SQL.format(v='x', t='logged')},
packed AS (SELECT cell_id, list(gene + 3 ORDER BY gene) AS g, list(bin ORDER BY gene) AS b FROM binned GROUP BY cell_id),
cells AS (SELECT o.cell_id, coalesce(g, []) AS g, coalesce(b, []) AS b FROM obs o LEFT JOIN packed p ON p.cell_id = o.cell_id),
width AS (SELECT max(len(g)) AS w FROM cells)"""


@query(TOKENS_SQL + """ SELECT cell_id, array_to_string(list_concat([0], g, list_transform(range(w - len(g)), lambda x: 1)), ',') AS genes,
array_to_string(list_concat([0], b, list_transform(range(w - len(b)), lambda x: -2)), ',') AS "values" FROM cells, width""", ("counts", "var_genes", "obs"))
def binned_tokens(spark, sf):
    """Gene ids and bins per cell, <cls> first, padded to the longest cell."""
    out = cl.binned_tokens(binned_matrix(spark, sf), vocabulary(spark, sf))
    return out.select("cell_id", joined("genes").alias("genes"), joined(F.transform("values", lambda v: v.cast("int"))).alias("values"))


@query(TOKENS_SQL + """ SELECT cell_id, array_to_string(list_concat([0], g), ',') AS genes, cast(1 + len(b) AS INTEGER) AS length FROM cells""", ("counts", "var_genes", "obs"))
def binned_tokens_ragged(spark, sf):
    out = cl.binned_tokens(binned_matrix(spark, sf), vocabulary(spark, sf), padding=False)
    return out.select("cell_id", joined("genes").alias("genes"), F.size("values").alias("length"))


@query(f"""WITH {BIN_PREP_SQL}, sampled AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY md5(concat_ws('|', '0', cast(cell_id AS VARCHAR), cast(gene AS VARCHAR))), gene) AS place FROM logged)
SELECT o.cell_id, coalesce(string_agg(cast(gene + 3 AS VARCHAR), ',' ORDER BY gene), '') AS genes FROM obs o LEFT JOIN sampled s ON s.cell_id = o.cell_id AND place <= 3 GROUP BY o.cell_id""",
       ("counts", "var_genes", "obs"))
def binned_tokens_sampled(spark, sf):
    """Cells longer than the limit keep a seeded sample of genes; <cls> always stays."""
    out = cl.binned_tokens(binned_matrix(spark, sf), vocabulary(spark, sf), max_length=4, padding=False)
    return out.select("cell_id", F.array_join(F.slice("genes", F.lit(2), F.size("genes") - 1), ",").alias("genes"))


RANK_SQL = f"""WITH {RANK_PREP_SQL}, scored AS (SELECT cell_id, gene * 3 AS token, value / n_counts * 10000 / gene_median AS x FROM prepared),
ranked AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY x DESC, token) AS place FROM scored),
packed AS (SELECT cell_id, string_agg(cast(token AS VARCHAR), ',' ORDER BY place) AS ids, count(*) AS n FROM ranked WHERE place <= 2048 GROUP BY cell_id)
SELECT o.cell_id, o.cell_type, o.sample, o.cell_id AS adata_order, coalesce(ids, '') AS input_ids, cast(coalesce(n, 0) AS INTEGER) AS length
FROM obs o JOIN kept_cells k ON k.cell_id = o.cell_id LEFT JOIN packed p ON p.cell_id = o.cell_id"""


@query(RANK_SQL, ("counts", "var_genes", "obs"))
def rank_tokens(spark, sf):
    """Gene tokens of each cell by median-scaled expression, highest first."""
    matrix, _ = ranked_matrix(spark, sf)
    tokens = view(spark, sf, "var_genes").filter("ensembl_id is not null").select(
        "ensembl_id", (F.col("gene") * 3).alias("token"), F.col("gene_median").alias("median"))
    return cl.rank_tokens(matrix, tokens).withColumn("input_ids", joined("input_ids"))


@query(RANK_SQL, ("counts", "var_genes", "obs"))
def recipe_by_name(spark, sf):
    """Preparation and tokens of a cell model found by its name."""
    prepare, tokens_of = cl.recipe("rank")
    matrix = cell_matrix(spark, sf)
    prepared, _ = prepare(matrix.with_(var=matrix.var.drop("ensembl_id")), gene_map(spark, sf), RANK_PARAMS)
    tokens = view(spark, sf, "var_genes").filter("ensembl_id is not null").select(
        "ensembl_id", (F.col("gene") * 3).alias("token"), F.col("gene_median").alias("median"))
    return tokens_of(prepared, tokens).withColumn("input_ids", joined("input_ids"))


@query("""SELECT cast(label AS VARCHAR) AS sample, array_to_string([cast(floor(cast(c AS DOUBLE) * 1000000) AS BIGINT) FOR c IN embedding], ',') AS millionths FROM embeddings""")
def cell_embedding_dataset(spark, sf):
    """The embedding table as (sample, embedding) rows, value by value."""
    path = scratch_path(spark, "cell-embedding")
    datasets.write_dataset(view(spark, sf, "cell_embedding").select("sample", "embedding"), path, ("sample",))
    back = spark.read.schema("embedding array<float>, sample string").parquet(path)
    return back.select("sample", joined(F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000000))).alias("millionths"))
