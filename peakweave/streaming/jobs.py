"""Structured Streaming: the batch operators on arriving JSON or parquet files.

Tokenising, padding and projections are stateless, so the batch functions are used
unchanged. Queries run with an available-now trigger: all files present are processed
in bounded micro-batches, and a later run continues from the checkpoint.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from peakweave.functions.sequences import PAD, cropped_length, pad_left
from peakweave.metrics.core import Metric, get
from peakweave.session import store


def read_json_stream(spark: SparkSession, directory: str, schema: T.StructType | str,
                     files_per_batch: int = 50) -> DataFrame:
    """JSON-lines shards as a stream; sub-directories such as split=…/shard=… are included."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .option("recursiveFileLookup", "true").json(directory))


def read_parquet_stream(spark: SparkSession, directory: str, schema: T.StructType | str, pattern: str = "*.parquet",
                        files_per_batch: int = 50) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .option("pathGlobFilter", pattern).parquet(directory))


def worker_slice(stream: DataFrame, worker: int, workers: int, index: str = "record_id") -> DataFrame:
    """Every workers-th row from `worker` on, by the contiguous row index."""
    return stream.filter(F.pmod(F.col(index), F.lit(workers)) == worker)


def deal_to_workers(stream: DataFrame, workers: int, directory: str, checkpoint: str, index: str = "record_id") -> StreamingQuery:
    """Write every worker's slice as a folder worker=… below `directory`, reading each file of the stream once.

    Rows are dealt by the contiguous row index, as in `worker_slice`; a worker reads (or
    streams) its own folder only.
    """
    dealt = stream.withColumn("worker", F.pmod(F.col(index), F.lit(workers)).cast("int"))
    return write_parquet_stream(dealt, directory, checkpoint, ["worker"])


def attach_pooled_cells(stream: DataFrame, pooled: DataFrame, label: str = "peak_value", seq_max_len: int = 501,
                        pad_id: int = PAD) -> DataFrame:
    """Tokenised stream rows with the pooled cells of their sample (a static table).

    Rows of samples without cells are dropped, as in the batch join. The table is
    stored once, so the micro-batches read it instead of pooling again, and Spark knows its
    size: a small one is broadcast, and the stream is not shuffled. Rows are padded after the join.
    """
    joined = stream.select("sample", "input_ids", F.col(label).alias("peak_value"), F.col("record_id").alias("sample_record_id")).join(
        store(pooled, "pooled-cells"), "sample")
    return joined.select(
        "sample", pad_left("input_ids", seq_max_len, pad_id).alias("seq_input_ids"),
        cropped_length("input_ids", seq_max_len).alias("seq_len"), "peak_value", "sample_record_id",
        *[c for c in pooled.columns if c != "sample"])


def write_parquet_stream(stream: DataFrame, directory: str, checkpoint: str,
                         partitions: Sequence[str] = ()) -> StreamingQuery:
    """Append to a parquet directory; exactly once through the checkpoint and the sink's commit log."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.trigger(availableNow=True).start(directory)


def take_stream(stream: DataFrame, n: int) -> DataFrame:
    """The first n rows that arrive (append mode only)."""
    return stream.limit(n)


def accumulate_metrics(stream: DataFrame, metrics: Sequence[Metric | str], directory: str, checkpoint: str,
                       group_by: Sequence[str] = ()) -> StreamingQuery:
    """Keep the sufficient statistics of fused metrics as streaming state, one row per group.

    Every micro-batch writes the finished metrics so far as a folder of its own below
    `directory`; `newest_metrics` reads the last complete one. Writing one again after a
    failure gives the same table, and none is missing meanwhile.
    """
    metrics = [get(m) if isinstance(m, str) else m for m in metrics]
    unfit = [m.name for m in metrics if m.compute is not None]
    if unfit:
        raise ValueError(f"{unfit} need the whole data; `streaming.ranks` accumulates spearmanr and roc_auc")
    keys = list(group_by)
    partials = [c.alias(f"__{m.name}_{k}") for m in metrics for k, c in m.partials.items()]
    finished = [expr({k: F.col(f"__{m.name}_{k}") for k in m.partials}).alias(name)
                for m in metrics for name, expr in m.finish.items()]
    stats = stream.groupBy(*keys).agg(*partials)

    def publish(batch: DataFrame, epoch: int) -> None:
        batch.select(*keys, *finished).write.mode("overwrite").parquet(f"{directory}/epoch={epoch}")

    return (stats.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
            .foreachBatch(publish).trigger(availableNow=True).start())


def newest_metrics(spark: SparkSession, directory: str) -> DataFrame:
    """The metrics of the last epoch that was written whole; earlier ones are listed, not read."""
    files = spark.read.parquet(directory).inputFiles()
    newest = max(int(found.group(1)) for found in (re.search(r"/epoch=(\d+)/", f) for f in files) if found)
    return spark.read.parquet(f"{directory}/epoch={newest}")
