"""Wide sample × peak matrices and single-cell triplets."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Cells that mean "missing".
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
           "NULL", "NaN", "None", "n/a", "nan", "null")


def read_wide_matrix(spark: SparkSession, path: str, index: str = "sample", column_name: str = "pos",
                     value_name: str = "value", separator: str = ",") -> DataFrame:
    """CSV files with one row per sample and one column per peak, as (sample, pos, value) rows.

    Files are read as text and exploded against their own header, so a matrix of
    100 000 columns never becomes a 100 000-column schema and files may order their
    columns differently. Headers stay in Spark, one row per file. A cell that means
    "missing" is null; any other text that is no number fails the job.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__file"))
    lines = lines.withColumn("value", F.regexp_replace("value", r"\r$", ""))
    is_header = F.col("value").startswith(index + separator)
    headers = lines.filter(is_header).groupBy("__file").agg(F.first("value").alias("__header"))
    if headers.isEmpty():
        raise ValueError(f"no header line starting with {index!r} in {path}")
    cells = lines.filter(~is_header).join(headers, "__file").select(
        F.split("value", separator).alias("__cells"), F.split("__header", separator).alias("__names"))
    named = cells.select(F.col("__cells")[0].alias(index), F.posexplode(F.arrays_zip("__names", "__cells")).alias("__i", "__c"))
    cell = F.when(~F.col("__c.__cells").isin(*MISSING), F.col("__c.__cells")).cast("double")
    return named.filter("__i > 0").select(index, F.col("__c.__names").alias(column_name), cell.alias(value_name))


def melt(df: DataFrame, index: str = "sample", column_name: str = "pos", value_name: str = "value") -> DataFrame:
    """A wide DataFrame to long form; missing cells are dropped."""
    columns = [c for c in df.columns if c != index]
    return df.unpivot([index], columns, column_name, value_name).filter(F.col(value_name).isNotNull())


@dataclass(frozen=True)
class CellMatrix:
    """A count matrix in long form: cells, genes, and the non-zero counts (zeros are absent)."""

    obs: DataFrame  # cell_id, sample, …
    var: DataFrame  # gene, …
    counts: DataFrame  # cell_id, gene, value, …layers
    raw: DataFrame | None = None  # cell_id, gene, value

    def with_(self, **frames) -> "CellMatrix":
        return replace(self, **frames)

    def shape(self) -> DataFrame:
        """One row: n_cells, n_genes."""
        return self.obs.agg(F.count(F.lit(1)).alias("n_cells")).join(
            F.broadcast(self.var.agg(F.count(F.lit(1)).alias("n_genes"))))


def read_cell_matrix(spark: SparkSession, directory: str) -> CellMatrix:
    """obs / var / counts (and raw, when present) under one directory of parquet tables."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{directory}/raw")
    has_raw = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    read = spark.read.parquet
    return CellMatrix(read(f"{directory}/obs"), read(f"{directory}/var"), read(f"{directory}/counts"),
                      read(f"{directory}/raw") if has_raw else None)


def write_cell_matrix(matrix: CellMatrix, directory: str, mode: str = "errorifexists") -> None:
    for name in ("obs", "var", "counts", "raw"):
        frame = getattr(matrix, name)
        if frame is not None:
            frame.write.mode(mode).parquet(f"{directory}/{name}")
