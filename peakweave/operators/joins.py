"""Lookup, sample and variant joins.

No side is forced to broadcast unless its size is bounded; Spark broadcasts the
others by their measured size, and splits skewed keys of a shuffle join at run time.
`salted_join` splits hot keys by construction where the looked-up side is small per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakweave.functions.arrays import center, dot, l2_normalize
from peakweave.functions.numeric import float32, log1p_float32
from peakweave.functions.sequences import variant_offset
from peakweave.operators.checks import require
from peakweave.operators.pooling import pool_rows

#: Rows of a salted join that one task sorts.
TASK_ROWS = 1 << 20


def salted_join(facts: DataFrame, table: DataFrame, on: Sequence[str], how: str = "inner", salts: int = 16,
                spread_by: Sequence[str] | None = None) -> DataFrame:
    """Join with every key cut into `salts` parts; the unique-keyed `table` is repeated per part.

    Both sides are sorted: the repeated table is larger than Spark takes it for, and a broadcast
    of it would stand whole in every task. Facts of more rows than the session's shuffle partitions hold at TASK_ROWS each are dealt
    over as many partitions as they need, so that what a task sorts does not grow with them.
    """
    spread = spread_by or [c for c in facts.columns if c not in on]
    left = facts.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    right = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    tasks = -(-facts.count() // TASK_ROWS)
    if tasks > int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        left, right = (side.repartition(tasks, *on, "__salt") for side in (left, right))
    return left.join(right.hint("merge"), [*on, "__salt"], how).drop("__salt")


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on group keys where null is a group like any other; without keys both sides are one row."""
    keys = list(keys)
    if not keys:
        return left.join(F.broadcast(right))
    renamed = right.withColumnsRenamed({k: f"__on_{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"__on_{k}"))
    joined = left.join(renamed, match, how)
    if how in ("full", "right"):
        joined = joined.withColumns({k: F.coalesce(k, f"__on_{k}") for k in keys})
    return joined.drop(*[f"__on_{k}" for k in keys])


def unique_by(df: DataFrame, keys: Sequence[str], message: str) -> DataFrame:
    """The rows, failing the job when two share a key; the shuffle is the one a join on the key needs anyway."""
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), F.first(F.struct(*others)).alias("__r"))
    return require(grouped, F.col("__rows") == 1, message).select(*keys, "__r.*")


def matrix_lookup(sequences: DataFrame, matrix: DataFrame, strict: bool = True, value: str = "value") -> DataFrame:
    """Add norm_peak_value and log1p_norm_peak_value (both float32) looked up by (sample, pos).

    A pair missing from the long-form matrix fails the job when strict, else gives null;
    a pair that stands there twice fails it in any case.
    """
    found = unique_by(matrix.select("sample", "pos", F.col(value).alias("__x"), F.lit(True).alias("__found")),
                      ["sample", "pos"], "a sample and peak stand twice in the matrix")
    joined = sequences.join(found, ["sample", "pos"], "left")
    if strict:
        joined = require(joined, F.col("__found").isNotNull(), "sample or peak not in the matrix")
    return joined.withColumns({
        "norm_peak_value": float32("__x"),
        "log1p_norm_peak_value": log1p_float32("__x"),
    }).drop("__x", "__found")


def pool_cells(cells: DataFrame, rows: int, order_by: Sequence[str] = ("cell_id",)) -> DataFrame:
    """(sample, cell_embedding): each sample's cells in order, pooled to a fixed number of rows."""
    return pool_rows(cells, "sample", order_by, "embedding", rows, "cell_embedding")


def attach_cells(sequences: DataFrame, cells: DataFrame, rows: int, salts: int | None = None) -> DataFrame:
    """Each sequence with the pooled cells of its sample; sequences without cells are dropped.

    Cells are pooled once per sample before the join, never per sequence.
    """
    pooled = pool_cells(cells, rows)
    if salts:
        return salted_join(sequences, pooled, ["sample"], "inner", salts)
    return sequences.join(pooled, "sample")


def samples_without_cells(sequences: DataFrame, cells: DataFrame) -> DataFrame:
    """Samples of the sequences that have no cell, with their row counts."""
    wanted = sequences.groupBy("sample").agg(F.count(F.lit(1)).alias("n_sequences"))
    known = cells.select("sample").distinct()  # combined map-side: a hot sample ships one row per task
    return wanted.join(known, "sample", "left_anti")


def deduplicate_variants(snp: DataFrame, keep: str, position: str) -> DataFrame:
    """One row per phenotype (`last` in file order), or all of them."""
    if keep == "all":
        return snp
    if keep != "last":
        raise ValueError("keep must be 'last' or 'all'")
    others = [c for c in snp.columns if c != "phenotype_id"]
    best = F.max_by(F.struct(*others), F.col(position))  # combined map-side: a hot phenotype ships one row per task
    return snp.groupBy("phenotype_id").agg(best.alias("__s")).select("phenotype_id", "__s.*")


def merge_variants(snp: DataFrame, sequences: DataFrame, keep: str = "last", position: str = "file_pos",
                   salts: int | None = None) -> DataFrame:
    """Variants joined to the sequences of their window; columns as in the merged table."""
    unique = deduplicate_variants(snp, keep, position).drop(position)
    seqs = sequences.select(F.col("pos").alias("phenotype_id"), F.col("sample").alias("sample_id"),
                            F.col("seq").alias("sequence"))
    joined = (salted_join(seqs, unique, ["phenotype_id"], "inner", salts) if salts
              else seqs.join(unique, "phenotype_id"))
    return joined.select("phenotype_id", *[c for c in unique.columns if c != "phenotype_id"], "sample_id", "sequence")


def in_sample_list(df: DataFrame, samples: DataFrame, column: str = "sample_id") -> DataFrame:
    listed = samples.select(F.col("sample").alias(column))
    return df.join(listed, column, "left_semi")


def single_base_alleles(df: DataFrame, a1: str = "A1", a2: str = "A2") -> DataFrame:
    """Only rows whose two alleles have one character each (null alleles are dropped)."""
    return df.filter((F.length(a1) == 1) & (F.length(a2) == 1))


def with_variant_offset(df: DataFrame, column: str = "snp_relative_pos") -> DataFrame:
    return df.withColumn(column, variant_offset("variant_id", "phenotype_id"))


def realign(predictions: DataFrame, source: DataFrame, key: str = "record_id") -> DataFrame:
    """Predictions back on their source rows by id; a row missing or repeated on either side fails the job."""
    left = unique_by(source.withColumn("__s", F.lit(True)), [key], "a source row stands twice")
    right = unique_by(predictions.withColumn("__p", F.lit(True)), [key], "a row has two predictions")
    joined = left.join(right, key, "full")
    both = F.col("__s").isNotNull() & F.col("__p").isNotNull()
    return require(joined, both, "predictions and source rows do not match").drop("__s", "__p")


def last_per_key(df: DataFrame, key: str, order_by: str) -> DataFrame:
    """Of several rows with one id, the last in order."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order_by)).alias("__r")).select(key, "__r.*")


def batch_similarities(left: DataFrame, right: DataFrame, batch: str, vector: str = "embedding",
                       index: str = "idx") -> DataFrame:
    """Each left row with its dot products to the right rows of its batch, in index order (`sims`).

    A batch is a fixed number of rows, so its vectors fit one array; pairs are never
    turned into rows.
    """
    block = right.groupBy(batch).agg(
        F.array_sort(F.collect_list(F.struct(F.col(index).alias("j"), F.col(vector).alias("v")))).alias("__block"))
    return left.join(block, batch).select(
        batch, index, F.transform("__block", lambda s: s["j"]).alias("others"),
        F.transform("__block", lambda s: dot(F.col(vector), s["v"])).alias("sims"))


def centered(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Subtract the mean vector and scale to unit length."""
    mean = df.agg(vector_to_array(Summarizer.mean(array_to_vector(F.col(vector)))).alias("__mean"))
    shifted = df.join(F.broadcast(mean)).withColumn(vector, center(vector, "__mean")).drop("__mean")
    return shifted.withColumn(vector, l2_normalize(vector))
