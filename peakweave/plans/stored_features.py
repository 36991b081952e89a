"""Model input stored apart and joined when it is read.

A sample's pooled block has some hundred thousand numbers and thousands of sequences, so it is
not copied onto them. Two tables hold the sequences and the blocks, in float32 and bucketed
alike by sample and part: reading joins them bucket by bucket without a shuffle, and a batch
carries each block it needs once, with an index column that says which block a row belongs to.

A sample with more than `part_rows` sequences has several parts, so that one sample never fills
a bucket by itself; its block is stored once per part.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakweave.functions.sequences import PAD, cropped_length, pad_left
from peakweave.operators.joins import join_groups, pool_cells

ROWS = ("seq_input_ids", "seq_len", "peak_value", "sample_record_id")
PLACE = ("sample", "part")


def store_features(tokenized: DataFrame, cells: DataFrame, name: str, directory: str,
                   label: str = "log1p_norm_peak_value", seq_max_len: int = 501, cell_rows: int = 501, pad_id: int = PAD,
                   buckets: int = 200, part_rows: int = 20_000) -> None:
    """Write the tables `name`_sequences and `name`_blocks below `directory`; sequences of samples without cells are dropped.

    The bucketing is part of the catalog's description of the tables.
    """
    rows = tokenized.select(
        "sample", pad_left("input_ids", seq_max_len, pad_id).alias("seq_input_ids"),
        cropped_length("input_ids", seq_max_len).alias("seq_len"),
        F.col(label).cast("float").alias("peak_value"), F.col("record_id").alias("sample_record_id"))
    pooled = pool_cells(cells, cell_rows).select(
        "sample", F.transform("cell_embedding", lambda v: v.cast("array<float>")).alias("block"))
    # a narrow row per sample
    parts = rows.groupBy("sample").agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("parts")).join(
        pooled.select("sample"), "sample", "left_semi")
    placed = join_groups(rows, parts, ["sample"]).withColumn(
        "part", F.pmod(F.xxhash64("sample_record_id"), "parts").cast("int")).drop("parts")
    blocks = pooled.join(parts, "sample").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    for frame, kind in ((placed, "sequences"), (blocks, "blocks")):
        # one file per bucket: a bucket's rows are together and in order when they are read
        (frame.repartition(buckets, *PLACE).write.bucketBy(buckets, *PLACE).sortBy(*PLACE)
         .option("path", os.path.join(directory, f"{name}_{kind}")).saveAsTable(f"{name}_{kind}"))


def _with_block(size: int):
    """The rows of one sample's part as rows of at most `size`, each with the block."""

    def run(rows: pa.Table, blocks: pa.Table) -> pa.Table:
        out = {c: [] for c in (*ROWS, "block")}
        if blocks.num_rows:
            block = blocks.column("block")[0]
            for at in range(0, rows.num_rows, size):
                for c in ROWS:
                    out[c].append(rows.column(c).slice(at, size).to_pylist())
                out["block"].append(block.as_py())
        return pa.table({c: pa.array(v, type=_TYPES[c]) for c, v in out.items()})

    return run


_TYPES = {"seq_input_ids": pa.list_(pa.list_(pa.int32())), "seq_len": pa.list_(pa.int32()), "peak_value": pa.list_(pa.float32()),
          "sample_record_id": pa.list_(pa.int64()), "block": pa.list_(pa.list_(pa.float32()))}
_LISTS = "seq_input_ids array<array<int>>, seq_len array<int>, peak_value array<float>, sample_record_id array<bigint>"


def _batched(size: int):
    """Batches of `size` rows from the smaller ones that come in; only the last of a task is short."""

    def cut(held: list[dict], n: int) -> tuple[dict, list[dict]]:
        batch = {c: [] for c in (*ROWS, "block_index")} | {"blocks": []}
        while held and n:
            part = held[0]
            here = min(n, len(part["seq_len"]))
            for c in ROWS:
                batch[c] += part[c][:here]
            if not batch["blocks"] or batch["blocks"][-1] is not part["block"]:
                batch["blocks"].append(part["block"])
            batch["block_index"] += [len(batch["blocks"]) - 1] * here
            rest = {c: part[c][here:] for c in ROWS} | {"block": part["block"]}
            held = ([rest] if rest["seq_len"] else []) + held[1:]
            n -= here
        return batch, held

    def table(batch: dict) -> pa.RecordBatch:
        types = _TYPES | {"blocks": pa.list_(_TYPES["block"]), "block_index": pa.list_(pa.int32())}
        names = [*ROWS, "blocks", "block_index"]
        return pa.RecordBatch.from_arrays([pa.array([batch[c]], type=types[c]) for c in names], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0
        for incoming in batches:
            for part in incoming.to_pylist():
                # one object per block, so that a block that comes again is known
                if held and np.array_equal(held[-1]["block"], part["block"]):
                    part["block"] = held[-1]["block"]
                held.append(part)
                waiting += len(part["seq_len"])
                while waiting >= size:
                    batch, held = cut(held, size)
                    waiting -= size
                    yield table(batch)
        if waiting:
            yield table(cut(held, waiting)[0])

    return run


def read_batches(spark: SparkSession, name: str, batch_size: int = 72) -> DataFrame:
    """A row per batch: the columns of its rows as arrays, `blocks` and, per row, its `block_index`.

    The two tables are joined bucket by bucket; nothing is shuffled, and a block is read once
    per part of its sample.
    """
    rows, blocks = spark.table(f"{name}_sequences"), spark.table(f"{name}_blocks")
    joined = rows.groupBy(*PLACE).cogroup(blocks.groupBy(*PLACE)).applyInArrow(
        _with_block(batch_size), f"{_LISTS}, block array<array<float>>")
    return joined.mapInArrow(_batched(batch_size), f"{_LISTS}, blocks array<array<array<float>>>, block_index array<int>")


def single_rows(batches: DataFrame) -> DataFrame:
    """The rows of the batches, each with its block: the columns `model_input` gives."""
    zipped = batches.select("blocks", F.explode(F.arrays_zip(*ROWS, "block_index")).alias("r"))
    return zipped.select(*[F.col(f"r.{c}").alias(c) for c in ROWS], F.get("blocks", F.col("r.block_index")).alias("cell_embedding"))
