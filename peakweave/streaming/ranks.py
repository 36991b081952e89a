"""Rank metrics of a stream: Spearman correlation and ROC AUC, exact at every epoch.

Both follow from how often each (prediction, reference) pair occurred. The counts are
keyed state: a pair belongs to one of `slots` slots of its group and there to one part, and
a part holds its pairs in sorted runs, one per level. A micro-batch becomes a run of level 0;
where a level is taken, the two runs are merged into one of the next level, as a binary
counter carries. So a pair is rewritten once per doubling of its part, a group of any size is
spread over at least SPREAD parts, and no state value holds more than a part's share. A run
stands in the state as the bytes of its three columns.

The stream hands on only the levels that changed, a row per pair; the newest version of each
level, found from the narrow columns of the epochs, is the whole count table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from peakweave.operators.joins import join_groups
from peakweave.session import store

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RUN = "p binary, r binary, n binary"
PAIR = "p double, r double, n bigint"
KINDS = (np.dtype("<f8"), np.dtype("<f8"), np.dtype("<i8"))
#: State keys of a group, at least, however few its slots are.
SPREAD = 128


def merged(*runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One sorted run of the pairs of several, equal ones with their counts added; NaN equals NaN, -0 equals 0."""
    p, r, n = (np.concatenate(c) for c in zip(*runs))
    p, r = (np.where(np.isnan(c), np.nan, c + 0.0) for c in (p, r))
    order = np.lexsort((r, p))
    p, r, n = p[order], r[order], n[order]
    same = np.zeros(len(p), dtype=bool)
    same[1:] = (p.view(np.int64)[1:] == p.view(np.int64)[:-1]) & (r.view(np.int64)[1:] == r.view(np.int64)[:-1])
    first = np.flatnonzero(~same)
    return p[first], r[first], np.add.reduceat(n, first) if len(n) else n


def _runs(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for frame in frames:
        yield frame["p"].to_numpy(float), frame["r"].to_numpy(float), frame["n"].to_numpy(np.int64)


class SortedRuns(StatefulProcessor):
    """The state of one part of a slot: a run per occupied level."""

    def __init__(self, keys: Sequence[str]):
        self.keys = list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.levels = handle.getMapState("levels", "level int", RUN)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        run, level, emptied = merged(*_runs(rows)), 0, []
        while self.levels.containsKey((level,)):
            held = self.levels.getValue((level,))
            run = merged(tuple(np.frombuffer(c, dtype=t) for c, t in zip(held, KINDS)), run)
            self.levels.removeKey((level,))
            emptied.append(level)
            level += 1
        self.levels.updateValue((level,), tuple(c.astype(t).tobytes() for c, t in zip(run, KINDS)))
        place = dict(zip([*self.keys, "slot", "part"], key))
        gone = len(emptied)
        # first a row without a count for each level that was emptied, then the pairs
        yield pd.DataFrame({
            **{k: pd.Series([v] * (gone + len(run[2])), dtype=object if v is None else None) for k, v in place.items()},
            "level": np.concatenate([np.array(emptied, dtype=int), np.full(len(run[2]), level)]),
            "p": np.concatenate([np.full(gone, np.nan), run[0]]), "r": np.concatenate([np.full(gone, np.nan), run[1]]),
            "n": pd.Series(pd.array(np.concatenate([np.zeros(gone, dtype=np.int64), run[2]]), dtype="Int64")).mask(
                np.arange(gone + len(run[2])) < gone)})

    def close(self) -> None:
        pass


def accumulate_pairs(stream: DataFrame, directory: str, checkpoint: str, group_by: Sequence[str] = (),
                     slots: int = 32) -> StreamingQuery:
    """Count the (prediction, reference) pairs of a stream per group; `rank_metrics` finishes them.

    Rows without a prediction or a reference form pairs with null and count as in the batch
    metrics. Equal pairs of a batch of rows are added up before the shuffle. Each epoch is a
    folder below `directory`; written again after a failure it is the same.
    """
    spark = stream.sparkSession
    keys = list(group_by)
    taken = {"slot", "part", "level", "p", "r", "n"} & set(keys)
    if taken:
        raise ValueError(f"group columns cannot be named {sorted(taken)}")
    kinds = [f for f in stream.schema.fields if f.name in keys]
    names = [f.name for f in kinds]
    pairs = stream.select(*names, F.col("prediction").cast("double").alias("p"), F.col("reference").cast("double").alias("r"))
    narrow = T.StructType([*kinds, T.StructField("p", T.DoubleType()), T.StructField("r", T.DoubleType()),
                           T.StructField("gaps", T.IntegerType()), T.StructField("n", T.LongType())])

    def added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            columns = [f.name for f in narrow.fields]
            yield frame.groupby(columns[:-1], dropna=False, sort=False).size().reset_index(name="n")[columns]

    # null and NaN are not told apart on the way through pandas: a bit each for the prediction and the reference
    bits = [F.col("p").isNull(), F.col("r").isNull(), F.coalesce(F.isnan("p"), F.lit(False)), F.coalesce(F.isnan("r"), F.lit(False))]
    gaps = sum((b.cast("int") * (1 << k) for k, b in enumerate(bits)), F.lit(0))
    counted = pairs.withColumn("gaps", gaps).mapInPandas(added, narrow)
    places = {"slot": F.pmod(F.xxhash64("p", "r"), F.lit(slots)).cast("int"),
              "part": F.pmod(F.xxhash64(F.lit("part"), "p", "r"), F.lit(-(-SPREAD // slots))).cast("int")}
    state = T.StructType([*kinds, *[T.StructField(c, T.IntegerType()) for c in ("gaps", "slot", "part", "level")],
                          *T._parse_datatype_string(PAIR).fields])
    runs = counted.withColumns(places).groupBy(*names, "gaps", "slot", "part").transformWithStateInPandas(
        SortedRuns([*names, "gaps"]), state, "Update", "none")

    def publish(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{directory}/epoch={epoch}")

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    try:
        # the query keeps the settings of its start
        return (runs.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
                .foreachBatch(publish).trigger(availableNow=True).start())
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def _held_pairs(spark: SparkSession, directory: str, keys: list[str]) -> DataFrame:
    """(group, prediction, reference, n) of the newest runs; a pair may stand in runs of several levels."""
    epochs = spark.read.parquet(directory)
    place = [*keys, "gaps", "slot", "part", "level"]
    # a row per run: stored, so that its size is known to the join
    newest = store(epochs.groupBy(*place).agg(F.max("epoch").alias("epoch")), "newest-runs")
    rows = join_groups(epochs.filter("n is not null"), newest, [*place, "epoch"])

    def value(c: str, k: int):
        has = lambda bit: F.col("gaps").bitwiseAND(F.lit(1 << bit)) > 0
        return F.when(has(k + 2), F.lit(float("nan"))).when(~has(k), F.col(c))

    return rows.select(*keys, value("p", 0).alias("prediction"), value("r", 1).alias("reference"), "n")


def counted_pairs(spark: SparkSession, directory: str, group_by: Sequence[str] = ()) -> DataFrame:
    """(group, prediction, reference, n): the pairs of all epochs written so far."""
    keys = list(group_by)
    return _summed(_held_pairs(spark, directory, keys), keys)


def _summed(pairs: DataFrame, keys: list[str]) -> DataFrame:
    return pairs.groupBy(*keys, "prediction", "reference").agg(F.sum("n").alias("n"))


def rank_metrics(spark: SparkSession, directory: str, metrics: Sequence[str] = ("spearmanr",),
                 group_by: Sequence[str] = (), pos_label=1) -> DataFrame:
    """The metrics over everything counted so far, one row (per group): spearmanr, roc_auc."""
    from peakweave.metrics.ranking import auc
    from peakweave.metrics.regression import rank_correlation

    keys = list(group_by)
    pairs = _held_pairs(spark, directory, keys)
    out = None
    for name in metrics:
        if name == "spearmanr":
            part = rank_correlation(_summed(pairs, keys), keys, weight="n")
        elif name == "roc_auc":
            # the sweep adds up equal scores itself
            part = auc(pairs.select(*keys, F.col("prediction").alias("score"), (F.col("reference") == F.lit(pos_label)).alias("positive"),
                                    F.col("n").cast("double").alias("w")), keys)
        else:
            raise KeyError(f"unknown rank metric {name!r}; known: roc_auc, spearmanr")
        out = part if out is None else join_groups(out, part, keys, "full")
    return out
