"""Single-cell preparation on long-form counts, where absent pairs are zeros."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peakweave.functions.numeric import ratio
from peakweave.operators.checks import require
from peakweave.operators.joins import join_groups
from peakweave.operators.ordering import ordered_scan
from peakweave.operators.smoothing import local_regression
from peakweave.session import materialize
from peakweave.sources.matrix import CellMatrix


@dataclass(frozen=True)
class CellParams:
    """The settings of the two preparation recipes."""

    min_matched_fraction: float = 0.6
    min_genes_per_cell: int = 10
    min_cells_per_gene: int = 10
    min_counts_per_gene: int = 3
    min_counts_per_cell: int = 0  # 0: keep all cells
    target_sum: float = 1e4
    n_bins: int = 51
    n_hvg: int = 0  # below 1: keep all genes
    hvg_flavor: str = "cell_ranger"
    count_raw_data: bool = False
    use_raw: bool = False


# --- gene dictionary -----------------------------------------------------------------------

def gene_name_column(var: DataFrame, wanted: str = "gene_name") -> str:
    """The gene-name column, or the gene key itself when that column is missing."""
    if wanted in var.columns:
        return wanted
    warnings.warn(f"no column {wanted!r} in var, using 'gene'", stacklevel=2)
    return "gene"


def map_gene_ids(var: DataFrame, gene_map: DataFrame | None, gene_col: str = "gene_name") -> DataFrame:
    """Add ensembl_id from a (key, value) dictionary; unmapped genes get null.

    Without a dictionary the column must already be there.
    """
    if gene_map is None:
        if "ensembl_id" not in var.columns:
            raise ValueError("var has no ensembl_id column and no gene map was given")
        return var
    name = gene_name_column(var, gene_col)
    lookup = gene_map.select(F.col("key").alias(name), F.col("value").alias("ensembl_id"))
    return var.drop("ensembl_id").join(lookup, name, "left")


def vocabulary_ids(var: DataFrame, vocab: DataFrame, gene_col: str = "gene_name") -> DataFrame:
    """Add id_in_vocab: the (gene, id) vocabulary's id, or -1."""
    name = gene_name_column(var, gene_col)
    lookup = vocab.select(F.col("gene").alias(name), F.col("id").alias("__id"))
    return var.join(lookup, name, "left").withColumn("id_in_vocab", F.coalesce("__id", F.lit(-1))).drop("__id")


def matched_fraction(var: DataFrame, matched) -> DataFrame:
    """One row: n_genes, n_matched, fraction."""
    return var.agg(F.count(F.lit(1)).alias("n_genes"), F.count_if(matched).alias("n_matched")).withColumn(
        "fraction", F.col("n_matched") / F.col("n_genes"))


def require_matched_fraction(var: DataFrame, matched, minimum: float) -> DataFrame:
    """Pass var through; the job fails when too few genes are matched."""
    measured = matched_fraction(var, matched).select(F.col("fraction").alias("__fraction"))
    gated = var.join(F.broadcast(measured))  # one row
    return require(gated, F.col("__fraction") >= minimum,
                   "too few genes of the dataset are in the vocabulary").drop("__fraction")


def restrict_genes(counts: DataFrame, var: DataFrame) -> DataFrame:
    return counts.join(var.select("gene"), "gene", "left_semi")


def restrict_cells(counts: DataFrame, obs: DataFrame) -> DataFrame:
    return counts.join(obs.select("cell_id"), "cell_id", "left_semi")


def with_raw_counts(matrix: CellMatrix, params: CellParams) -> CellMatrix:
    """Replace counts by the raw matrix, restricted to the genes kept in var."""
    if not params.use_raw:
        return matrix
    if params.count_raw_data:
        warnings.warn("the matrix already holds raw counts; use_raw is ignored", stacklevel=2)
        return matrix
    if matrix.raw is None:
        raise ValueError("use_raw needs a raw matrix")
    return matrix.with_(counts=restrict_genes(matrix.raw, matrix.var), raw=None)


# --- quality control ------------------------------------------------------------------------

def cell_qc(counts: DataFrame) -> DataFrame:
    return counts.groupBy("cell_id").agg(
        F.count_if(F.col("value") > 0).alias("n_genes_by_counts"), F.sum("value").alias("total_counts"))


def gene_qc(counts: DataFrame, obs: DataFrame) -> DataFrame:
    """Per gene: cells, mean over all cells (zeros included), dropout percentage, total."""
    per_gene = counts.groupBy("gene").agg(
        F.count_if(F.col("value") > 0).alias("n_cells_by_counts"), F.sum("value").alias("total_counts"))
    cells = obs.agg(F.count(F.lit(1)).alias("__cells"))
    return per_gene.join(F.broadcast(cells)).select(  # one row
        "gene", "n_cells_by_counts",
        (F.col("total_counts") / F.col("__cells")).alias("mean_counts"),
        ((1 - F.col("n_cells_by_counts") / F.col("__cells")) * 100).alias("pct_dropout_by_counts"),
        "total_counts")


def count_statistics(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What `cell_qc` and the sums of `gene_qc` are made of, from one scan: (cell_id, n, total) and (gene, n, total).

    Both are written once, a row per cell and a row per gene, and are not computed again by what reads them.
    """
    both = materialize(counts.groupingSets([["cell_id"], ["gene"]], "cell_id", "gene").agg(
        F.grouping("gene").alias("__of_cell"), F.count_if(F.col("value") > 0).alias("n"), F.sum("value").alias("total")))
    per_cell = both.filter("__of_cell = 1").select("cell_id", "n", "total")
    return per_cell, both.filter("__of_cell = 0").select("gene", "n", "total")


def add_qc(matrix: CellMatrix, statistics: tuple[DataFrame, DataFrame] | None = None) -> CellMatrix:
    per_cell, per_gene = statistics or count_statistics(matrix.counts)
    obs = matrix.obs.join(per_cell.select("cell_id", F.col("n").alias("n_genes_by_counts"), F.col("total").alias("total_counts")),
                          "cell_id", "left").na.fill(0, ["n_genes_by_counts", "total_counts"])
    cells = matrix.obs.agg(F.count(F.lit(1)).alias("__cells"))
    genes = per_gene.join(F.broadcast(cells)).select(  # one row
        "gene", F.col("n").alias("n_cells_by_counts"), (F.col("total") / F.col("__cells")).alias("mean_counts"),
        ((1 - F.col("n") / F.col("__cells")) * 100).alias("pct_dropout_by_counts"), F.col("total").alias("total_counts"))
    var = matrix.var.join(genes, "gene", "left").na.fill(
        {"n_cells_by_counts": 0, "mean_counts": 0.0, "pct_dropout_by_counts": 100.0, "total_counts": 0.0})
    return matrix.with_(obs=obs, var=var)


def cells_with_genes(counts: DataFrame, minimum: int) -> DataFrame:
    """Cells in which at least `minimum` genes are counted."""
    n = counts.groupBy("cell_id").agg(F.count_if(F.col("value") > 0).alias("n_genes"))
    return n.filter(F.col("n_genes") >= minimum)


def genes_with_cells(counts: DataFrame, minimum: int) -> DataFrame:
    """Genes counted in at least `minimum` cells."""
    n = counts.groupBy("gene").agg(F.count_if(F.col("value") > 0).alias("n_cells"))
    return n.filter(F.col("n_cells") >= minimum)


def filter_cells_then_genes(matrix: CellMatrix, min_genes: int, min_cells: int, per_cell: DataFrame | None = None) -> CellMatrix:
    """Drop cells with few genes, then genes found in few of the remaining cells; `per_cell` is from `count_statistics`."""
    if per_cell is None:
        cells = cells_with_genes(matrix.counts, min_genes)
    else:
        cells = per_cell.filter(F.col("n") >= min_genes).select("cell_id", F.col("n").alias("n_genes"))
    counts = matrix.counts.join(cells.select("cell_id"), "cell_id", "left_semi")
    genes = materialize(genes_with_cells(counts, min_cells))  # a row per gene, read by var and by the counts
    return matrix.with_(
        obs=matrix.obs.join(cells, "cell_id"),
        var=matrix.var.join(genes, "gene"),
        counts=counts.join(genes.select("gene"), "gene", "left_semi"))


def filter_by_counts(matrix: CellMatrix, min_gene_counts: int, min_cell_counts: int = 0) -> CellMatrix:
    """Drop genes with a small total, then (optionally) cells with a small total."""
    genes = matrix.counts.groupBy("gene").agg(F.sum("value").alias("n_counts")).filter(
        F.col("n_counts") >= min_gene_counts)
    counts = matrix.counts.join(genes.select("gene"), "gene", "left_semi")
    obs = matrix.obs
    if min_cell_counts:
        cells = counts.groupBy("cell_id").agg(F.sum("value").alias("n_counts")).filter(
            F.col("n_counts") >= min_cell_counts)
        counts = counts.join(cells.select("cell_id"), "cell_id", "left_semi")
        obs = obs.join(cells, "cell_id")
    return matrix.with_(obs=obs, var=matrix.var.join(genes, "gene"), counts=counts)


# --- normalisation, variable genes, binning --------------------------------------------------

def normalize_log1p(counts: DataFrame, target_sum: float = 1e4) -> DataFrame:
    """Layers X_normed (each cell sums to target_sum) and X_log1p.

    A cell has at most one row per gene, so its total is a window sum: one shuffle on
    the cell, which binning and packing by cell then reuse.
    """
    total = F.sum("value").over(Window.partitionBy("cell_id"))
    return counts.withColumn("X_normed", ratio(F.col("value") * target_sum, total)).withColumn(
        "X_log1p", F.log1p("X_normed"))


def gene_moments(counts: DataFrame, obs: DataFrame, value: str, batch: str | None = None) -> DataFrame:
    """Mean and ddof-1 variance per gene (and batch) over all cells, zeros included."""
    keys = ["gene"] + ([batch] if batch else [])
    x = F.col(value).cast("double")
    data = counts.join(obs.select("cell_id", batch), "cell_id") if batch else counts
    sums = data.groupBy(*keys).agg(F.sum(x).alias("__s"), F.sum(x * x).alias("__q"))
    cells = obs.groupBy(*([batch] if batch else [])).agg(F.count(F.lit(1)).alias("__n"))
    joined = join_groups(sums, cells, [batch] if batch else [])
    n = F.col("__n")
    mean = F.col("__s") / n
    return joined.select(*keys, mean.alias("mean"),
                         ratio((F.col("__q") / n - mean * mean) * n, n - 1, None).alias("variance"))


def normalized_dispersion(moments: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    """Dispersion (variance / mean) against genes of similar mean.

    Genes fall into 20 bins between the mean's percentiles 10, 15, …, 100; inside a
    bin the median is subtracted and the median absolute deviation (scaled to a
    normal's deviation) divided out. The input has one row per gene.
    """
    disp = moments.withColumn("dispersion", F.col("variance") / F.when(F.col("mean") == 0, 1e-12).otherwise(F.col("mean")))
    disp = materialize(disp)  # one row per gene and batch, read three times
    # a group has one value per gene at most, which bounds what an exact percentile holds
    cuts = [F.lit(p / 100) for p in range(10, 105, 5)]
    edges = disp.groupBy(*batch).agg(F.percentile("mean", F.array(*cuts)).alias("__edges"))
    # right-closed bins: a mean equal to an edge belongs to the bin below it
    binned = join_groups(disp, edges, batch).withColumn(
        "mean_bin", F.size(F.filter("__edges", lambda e: e < F.col("mean")))).drop("__edges")
    keys = [*batch, "mean_bin"]
    medians = binned.groupBy(*keys).agg(F.median("dispersion").alias("__median"))
    centred = join_groups(binned, medians, keys).withColumn("__dev", F.col("dispersion") - F.col("__median"))
    mads = centred.groupBy(*keys).agg((F.median(F.abs("__dev")) / F.lit(0.6744897501960817)).alias("__mad"))
    return join_groups(centred, mads, keys).withColumn(
        "dispersion_norm", ratio(F.col("__dev"), F.col("__mad"), None)).drop("__dev", "__median", "__mad")


def highly_variable_genes(counts: DataFrame, obs: DataFrame, n_top: int, value: str = "value",
                          batch: str | None = None) -> DataFrame:
    """The n_top genes by normalised dispersion, ties by gene.

    Scores are compared at nine decimals, so that the order of a distributed sum
    cannot decide between equal genes.

    With a batch column the genes are ranked per batch, and kept by the number of
    batches that select them, then by their mean normalised dispersion over all batches.
    """
    scored = normalized_dispersion(gene_moments(counts, obs, value, batch), [batch] if batch else [])
    order = [F.round("dispersion_norm", 9).desc_nulls_last(), F.col("gene")]
    if batch is None:
        return scored.orderBy(*order).limit(n_top)
    ranked = ordered_scan(scored, order, [batch], index="__i")
    merged = ranked.groupBy("gene").agg(
        F.count_if(F.col("__i") < n_top).alias("n_batches"),
        F.sum(F.coalesce("dispersion_norm", F.lit(0.0))).alias("__sum"))
    batches = obs.agg(F.count_distinct(batch).alias("__b"))
    merged = merged.join(F.broadcast(batches)).withColumn("dispersion_norm", F.col("__sum") / F.col("__b"))
    return merged.select("gene", "n_batches", "dispersion_norm").orderBy(
        F.col("n_batches").desc(), F.round("dispersion_norm", 9).desc(), "gene").limit(n_top)


def stabilized_variance(counts: DataFrame, obs: DataFrame, value: str = "value", span: float = 0.3,
                        batch: str | None = None) -> DataFrame:
    """Per gene (and batch): mean, variance and the variance of the clipped, standardised counts.

    The expected variance comes from a local regression of log variance on log mean, one
    per batch; counts are clipped at the square root of the number of cells in its units.
    """
    by = [batch] if batch else []
    moments = materialize(gene_moments(counts, obs, value, batch))
    logged = moments.filter("variance > 0").select(
        *by, "gene", F.log10("mean").alias("__lm"), F.log10("variance").alias("__lv"))
    fitted = local_regression(logged, "__lm", "__lv", ["gene"], span, column="__fit", by=by).select(*by, "gene", "__fit")
    cells = obs.groupBy(*by).agg(F.count(F.lit(1)).cast("double").alias("__n"))
    scale = join_groups(join_groups(moments, fitted, [*by, "gene"], "left"), cells, by).select(
        *by, "gene", "mean", "variance", "__n", F.sqrt(F.pow(F.lit(10.0), F.coalesce("__fit", F.lit(0.0)))).alias("__sd"))
    ceiling = F.col("mean") + F.col("__sd") * F.sqrt("__n")
    x = F.least(F.col(value).cast("double"), ceiling)
    data = counts.join(obs.select("cell_id", batch), "cell_id") if batch else counts
    sums = join_groups(data, scale, [*by, "gene"]).groupBy(*by, "gene").agg(
        F.sum(x).alias("__s"), F.sum(x * x).alias("__q"), F.first("mean").alias("mean"),
        F.first("variance").alias("variance"), F.first("__n").alias("__n"), F.first("__sd").alias("__sd"))
    n, mean = F.col("__n"), F.col("mean")
    norm = (n * mean * mean + F.col("__q") - 2 * mean * F.col("__s")) / ((n - 1) * F.col("__sd") * F.col("__sd"))
    return sums.select(*by, "gene", "mean", "variance", norm.alias("variance_norm"))


def variance_stabilized_genes(counts: DataFrame, obs: DataFrame, n_top: int, value: str = "value",
                              span: float = 0.3, batch: str | None = None) -> DataFrame:
    """The n_top genes by the variance of their clipped, standardised counts (flavor seurat_v3), ties by gene.

    With a batch column each batch has its own expected variances and ranks its genes; a
    gene's rank is the median of its ranks below n_top, ties go to the gene more batches
    put there, and `variance_norm` is the mean over all batches. A batch does not rank
    genes it has no counts of.
    """
    scored = stabilized_variance(counts, obs, value, span, batch)
    order = [F.round("variance_norm", 9).desc(), F.col("gene")]
    if batch is None:
        return scored.orderBy(*order).limit(n_top)
    ranked = ordered_scan(scored, order, [batch], index="__i")
    chosen = F.when(F.col("__i") < n_top, F.col("__i"))
    # a gene has one rank per batch
    merged = ranked.groupBy("gene").agg(F.median(chosen).alias("median_rank"), F.count(chosen).alias("n_batches"),
                                        F.sum("variance_norm").alias("__sum"))
    batches = obs.select(batch).distinct().agg(F.count(F.lit(1)).alias("__b"))
    return merged.join(F.broadcast(batches)).select(  # one row
        "gene", "n_batches", "median_rank", (F.col("__sum") / F.col("__b")).alias("variance_norm")).orderBy(
        F.col("median_rank").asc_nulls_last(), F.col("n_batches").desc(), "gene").limit(n_top)


def bin_expression(counts: DataFrame, value: str = "X_log1p", n_bins: int = 51, column: str = "X_binned") -> DataFrame:
    """Per-cell quantile bins of the non-zero values: how many of the n_bins-1 edges lie at or below a value.

    The edges are evenly spaced quantiles of the cell's n non-zero values. A value with
    k others at or below it lies at position k of n-1, so edge j of m counts when
    j·(n-1) <= m·k: whole-number arithmetic, where interpolated edges would make
    ties depend on rounding. Zeros stay in bin 0. A cell has one row per gene at most.
    """
    x = F.col(value)
    keys = ["cell_id", x > 0]
    upto = F.count(F.lit(1)).over(
        Window.partitionBy(*keys).orderBy(x).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    last = n_bins - 2
    ranked = counts.withColumns({"__k": upto - 1, "__n": n})
    k, n = F.col("__k"), F.col("__n")
    place = F.when(k == n - 1, last + 1).otherwise(F.expr(f"(__k * {last}) div (__n - 1)") + 1)
    return ranked.withColumn(column, F.when(x > 0, place).otherwise(0).cast("int")).drop("__k", "__n")


# --- composed recipes ------------------------------------------------------------------------

def prepare_for_ranking(matrix: CellMatrix, gene_map: DataFrame | None, params: CellParams = CellParams(),
                        gene_col: str = "gene_name") -> tuple[CellMatrix, DataFrame]:
    """Rank recipe: ids, raw counts, QC, cell and gene filters, quality gate, unmatched genes dropped.

    Returns the matrix and the gene table as it was before the unmatched genes left.
    """
    matrix = matrix.with_(var=map_gene_ids(matrix.var, gene_map, gene_col))
    matrix = with_raw_counts(matrix, params)
    statistics = count_statistics(matrix.counts)
    matrix = add_qc(matrix, statistics)
    matrix = matrix.with_(obs=matrix.obs.withColumn("n_counts", F.col("total_counts")))  # before the filters
    matrix = filter_cells_then_genes(matrix, params.min_genes_per_cell, params.min_cells_per_gene, statistics[0])
    matched = F.col("ensembl_id").isNotNull()
    # a row per gene, read by the gate, by the counts and by the caller
    var = materialize(require_matched_fraction(matrix.var.withColumn("has_ensembl_match", matched), matched,
                                               params.min_matched_fraction))
    kept = var.filter(matched)
    return matrix.with_(
        obs=matrix.obs.withColumn("adata_order", F.col("cell_id")), var=kept,
        counts=restrict_genes(matrix.counts, kept)), var


def prepare_for_binning(matrix: CellMatrix, vocab: DataFrame, params: CellParams = CellParams(),
                        gene_col: str = "gene_name", batch: str | None = None) -> CellMatrix:
    """Bin recipe: vocabulary gate and filter, raw counts, count filters, normalise, variable genes, bin."""
    in_vocab = F.col("id_in_vocab") >= 0
    var = vocabulary_ids(matrix.var, vocab.select("gene", F.lit(1).alias("id")), gene_col)
    var = require_matched_fraction(var, in_vocab, params.min_matched_fraction).filter(in_vocab)
    matrix = with_raw_counts(matrix.with_(var=var), params)
    matrix = matrix.with_(counts=restrict_genes(matrix.counts, matrix.var))
    matrix = filter_by_counts(matrix, params.min_counts_per_gene, params.min_counts_per_cell)
    counts = normalize_log1p(matrix.counts, params.target_sum)
    if params.n_hvg >= 1:
        counts = materialize(counts)  # read by the selection and by the result
        if params.hvg_flavor == "seurat_v3" or params.count_raw_data:
            kept = variance_stabilized_genes(counts, matrix.obs, params.n_hvg, batch=batch).select("gene")
        else:
            kept = highly_variable_genes(counts, matrix.obs, params.n_hvg, batch=batch).select("gene")
        matrix = matrix.with_(var=matrix.var.join(kept, "gene", "left_semi"))
        counts = counts.join(kept, "gene", "left_semi")
    return matrix.with_(counts=bin_expression(counts, n_bins=params.n_bins))


def run_summary(matrix: CellMatrix, var_before: DataFrame, matched) -> DataFrame:
    """One row for the lineage record: cells, genes, matched fraction."""
    shape = matrix.shape().select(F.col("n_cells").alias("preprocessed__n_cells"),
                                  F.col("n_genes").alias("preprocessed__n_genes"))
    fraction = matched_fraction(var_before, matched).select(F.col("fraction").alias("fract_genes_in_vocab"))
    return shape.join(F.broadcast(fraction))


# --- tokens ----------------------------------------------------------------------------------

def binned_tokens(matrix: CellMatrix, vocab: DataFrame, layer: str = "X_binned", gene_col: str = "gene_name",
                  cls_token: str = "<cls>", pad_token: str = "<pad>", pad_value: int = -2,
                  max_length: int | None = 1200, include_zero: bool = False, padding: bool = True,
                  seed: int = 0) -> DataFrame:
    """Per cell its gene ids and bin values in gene order, <cls> (value 0) first.

    Unknown genes take the pad id. Cells longer than max_length keep <cls> and a
    seeded sample of genes, the others are left out (None keeps all); with padding every row is filled to the longest row
    (max_length at most) with the pad id and pad_value.
    """
    special = {r["gene"]: r["id"] for r in vocab.filter(F.col("gene").isin(cls_token, pad_token)).collect()}
    name = gene_name_column(matrix.var, gene_col)
    ids = matrix.var.join(vocab.select(F.col("gene").alias(name), F.col("id").alias("__id")), name, "left").select(
        "gene", F.coalesce("__id", F.lit(special[pad_token])).cast("int").alias("gene_id"))
    entries = matrix.counts.select("cell_id", "gene", F.col(layer).cast("double").alias("v"))
    tokens = (entries if include_zero else entries.filter("v > 0")).join(ids, "gene")
    # a cell holds one row per gene at most, so its list has a fixed bound
    packed = tokens.groupBy("cell_id").agg(F.array_sort(F.collect_list(F.struct("gene", "gene_id", "v"))).alias("t"))
    cells = matrix.obs.select("cell_id").join(packed, "cell_id", "left").withColumn(
        "t", F.coalesce("t", F.array().cast(packed.schema["t"].dataType)))
    if include_zero:
        # the dense row of a cell comes from the one array of all genes, not from cells x genes rows
        genes = ids.agg(F.array_sort(F.collect_list(F.struct("gene", "gene_id"))).alias("__genes"))
        held = F.map_from_entries(F.transform("t", lambda s: F.struct(s["gene"], s["v"])))
        cells = cells.join(F.broadcast(genes)).withColumn("__held", held).withColumn("t", F.transform(  # one row
            "__genes", lambda g: F.struct(g["gene"].alias("gene"), g["gene_id"].alias("gene_id"), F.coalesce(
                F.try_element_at("__held", g["gene"]), F.lit(0.0)).alias("v")))).drop("__genes", "__held")
    if max_length:
        cells = cells.withColumn("t", F.when(F.size("t") > max_length - 1, _sampled("t", max_length - 1, seed)).otherwise(
            F.col("t")))
    rows = cells.select(
        "cell_id",
        F.concat(F.array(F.lit(special[cls_token]).cast("int")), F.transform("t", lambda s: s["gene_id"])).alias("genes"),
        F.concat(F.array(F.lit(0.0)), F.transform("t", lambda s: s["v"])).alias("values"))
    if not padding:
        return rows
    rows = materialize(rows)  # packed once: the width comes from the rows themselves
    longest = rows.agg(F.coalesce(F.max(F.size("genes")), F.lit(1)).alias("__w"))
    fill = F.greatest(F.col("__w") - F.size("genes"), F.lit(0))
    return rows.join(F.broadcast(longest)).select(  # one row
        "cell_id",
        F.concat("genes", F.array_repeat(F.lit(special[pad_token]).cast("int"), fill)).alias("genes"),
        F.concat("values", F.array_repeat(F.lit(float(pad_value)), fill)).alias("values"))


def _sampled(tokens: str, n: int, seed: int):
    """n of a cell's genes by a seeded hash, back in gene order."""
    def place(s):
        return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("cell_id").cast("string"), s["gene"].cast("string")))

    shuffled = F.array_sort(F.transform(tokens, lambda s: F.struct(
        place(s).alias("h"), s["gene"].alias("gene"), s["gene_id"].alias("gene_id"), s["v"].alias("v"))))
    return F.array_sort(F.transform(F.slice(shuffled, 1, n), lambda s: F.struct(
        s["gene"].alias("gene"), s["gene_id"].alias("gene_id"), s["v"].alias("v"))))


def rank_tokens(matrix: CellMatrix, gene_tokens: DataFrame, model_input_size: int = 2048,
                keep: Sequence[str] = ("cell_type", "sample", "adata_order"), target_sum: float = 10_000.0,
                gene_key: str = "ensembl_id") -> DataFrame:
    """Per cell the token ids of its genes, highest median-scaled expression first.

    `gene_tokens` has (gene_key, token, median); genes without a token are left out.
    Equal scores order by token; of a cell's genes the first `model_input_size` stay, the others are left out.
    Cells whose `filter_pass` is 0 are dropped.
    """
    obs = matrix.obs.filter("filter_pass = 1") if "filter_pass" in matrix.obs.columns else matrix.obs
    missing = [c for c in keep if c not in obs.columns]
    if missing:
        raise ValueError(f"obs lacks the columns {missing}")
    scale = matrix.var.select("gene", gene_key).join(gene_tokens, gene_key).select("gene", "token", "median")
    scored = (
        matrix.counts.filter(F.col("value") > 0).join(scale, "gene")
        .join(obs.select("cell_id", F.col("n_counts").alias("__n")), "cell_id")
        .select("cell_id", "token", (F.col("value") / F.col("__n") * target_sum / F.col("median")).alias("x"))
    )
    # a cell holds one row per gene at most, so its list has a fixed bound
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("x")).alias("x"), "token")))
    packed = scored.groupBy("cell_id").agg(
        F.transform(F.slice(ranked, 1, model_input_size), lambda s: s["token"]).alias("input_ids"))
    ids = F.coalesce("input_ids", F.array().cast(packed.schema["input_ids"].dataType))
    return obs.select("cell_id", *keep).join(packed, "cell_id", "left").withColumn("input_ids", ids).withColumn(
        "length", F.size("input_ids"))


def cells_per_sample(obs: DataFrame) -> DataFrame:
    return obs.groupBy("sample").agg(F.count(F.lit(1)).alias("n_cells"))


# What a named cell model needs: the preparation of the matrix and the tokens made of it.
RECIPES = {"rank": (prepare_for_ranking, rank_tokens), "bin": (prepare_for_binning, binned_tokens)}


def recipe(name: str):
    """(preparation, tokenizer) of a cell model by name."""
    if name not in RECIPES:
        raise KeyError(f"unknown cell recipe {name!r}; known: {sorted(RECIPES)}")
    return RECIPES[name]
