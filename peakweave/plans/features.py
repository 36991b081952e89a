"""Model input: padded tokens, the chosen label, and the pooled cells of the same sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakweave.functions.sequences import PAD, cropped_length, pad_left
from peakweave.operators.joins import attach_cells
from peakweave.operators.ordering import with_record_id


def model_input(tokenized: DataFrame, cells: DataFrame, label: str = "log1p_norm_peak_value", seq_max_len: int = 501,
                cell_rows: int = 501, pad_id: int = PAD, salts: int | None = None) -> DataFrame:
    """seq_input_ids, seq_len, peak_value, cell_embedding, sample_record_id; rows without cells are dropped."""
    rows = tokenized.select(
        "sample", pad_left("input_ids", seq_max_len, pad_id).alias("seq_input_ids"),
        cropped_length("input_ids", seq_max_len).alias("seq_len"),
        F.col(label).alias("peak_value"), F.col("record_id").alias("sample_record_id"))
    return attach_cells(rows, cells, cell_rows, salts)


def collate(rows: DataFrame, batch_size: int, order_by: str = "sample_record_id") -> DataFrame:
    """Column-wise batches of `batch_size` consecutive rows; text columns are left out."""
    columns = [c for c, t in rows.dtypes if t != "string"]
    placed = with_record_id(rows.select(*columns), [order_by], "__i")
    entry = F.struct("__i", *columns)
    packed = placed.groupBy(F.floor(F.col("__i") / batch_size).alias("batch")).agg(
        F.array_sort(F.collect_list(entry)).alias("__rows"))  # batch_size rows
    return packed.select("batch", *[
        F.col(f"__rows.{c}").alias(c) for c in columns])
