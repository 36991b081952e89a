"""Dataset directories, JSON-lines shards, dictionaries, and the matching writers."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakweave.operators.ordering import with_shard


def read_dataset(spark: SparkSession, directory: str, split: str | None = None) -> DataFrame:
    """A dataset directory; `split` (and cell type) are partition columns, pruned by the filter."""
    df = spark.read.parquet(directory)
    return df.filter(F.col("split") == split) if split else df


def write_dataset(df: DataFrame, directory: str, partitions: Sequence[str] = ("split",),
                  mode: str = "errorifexists") -> None:
    """One directory per split (and cell type)."""
    df.write.mode(mode).partitionBy(*partitions).parquet(directory)


def read_json_lines(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """JSON-lines shards, plain or compressed (codec by suffix); no schema inference pass."""
    return spark.read.schema(schema).json(paths)


def write_json_shards(df: DataFrame, directory: str, num_shards: int = 500, index: str = "record_id",
                      shard_mode: str = "strided", compression: str = "none", mode: str = "errorifexists",
                      finish: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """JSON-lines export, one directory per split and shard of the contiguous `index`.

    Rows are rebalanced on (split, shard): adaptive execution joins small shards into one
    task and lets several tasks write a large one, each its own file. `finish` derives wide
    columns where the rows are written, so that they are not shuffled.
    """
    sharded = with_shard(df, num_shards, index, shard_mode)
    keys = [c for c in ("split", "shard") if c in sharded.columns]
    dealt = sharded.hint("rebalance", *keys)
    ((finish(dealt) if finish else dealt).write.mode(mode).option("compression", compression)
     .partitionBy(*keys).json(directory))


def write_parquet_shards(df: DataFrame, directory: str, num_shards: int, index: str = "record_id",
                         mode: str = "errorifexists") -> None:
    """Per-shard output of wide rows, such as embeddings; rebalanced like the JSON shards."""
    sharded = with_shard(df, num_shards, index)
    keys = [c for c in ("split", "shard") if c in sharded.columns]
    sharded.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).parquet(directory)


def write_csv(df: DataFrame, directory: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(directory, header=True)


def append_metrics(df: DataFrame, directory: str, step: int | None = None) -> None:
    """Append one evaluation's metrics row to a metrics table."""
    row = df if step is None else df.withColumn("step", F.lit(step))
    row.write.mode("append").json(directory)


def write_run_config(frame: DataFrame, params: Mapping, directory: str, mode: str = "errorifexists") -> None:
    """Lineage record: the one-row `frame` of measured values joined by the parameters, keys sorted."""
    full = frame.select("*", *[F.lit(v if not isinstance(v, (dict, list)) else json.dumps(v)).alias(k)
                               for k, v in params.items()])
    full.select(*sorted(full.columns)).coalesce(1).write.mode(mode).json(directory)


def read_dictionary(spark: SparkSession, path: str, key: str = "key", value: str = "value",
                    whole_file: bool = True) -> DataFrame:
    """JSON objects as (key, value) rows: one object per file, or one per line (whole_file=False)."""
    if not path.endswith(".json"):
        raise ValueError(f"dictionary must be a .json file, got {path}")
    text = spark.read.text(path, wholetext=whole_file)
    return text.select(F.explode(F.from_json("value", "map<string,string>")).alias(key, value))


def dictionary_frame(spark: SparkSession, mapping: Mapping, key: str = "key", value: str = "value") -> DataFrame:
    """An in-memory dictionary as (key, value) rows."""
    return spark.createDataFrame([(str(k), str(v)) for k, v in mapping.items()], f"{key} string, {value} string")


def from_rows(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    """Small in-memory records as a DataFrame; the schema is given, not inferred."""
    return spark.createDataFrame(list(rows), schema)


def from_generator(seeds: DataFrame, generate, schema: T.StructType | str) -> DataFrame:
    """Rows made by `generate(pandas_frame) -> iterator of pandas frames`, one call per batch of seed rows."""

    def run(batches):
        for batch in batches:
            yield from generate(batch)

    return seeds.mapInPandas(run, schema)
