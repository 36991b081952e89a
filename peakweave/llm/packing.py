"""Packing along a space-filling curve.

Each document is encoded once. Its token ids, hashed into BUCKETS counts and scaled to length one, are projected to three
dimensions; the Hilbert key of that point orders the documents, so that similar ones stand together. Documents are
range-sorted by the key and laid end to end, and the line is cut every `size` tokens: a sequence holds neighbours of the
curve, and only the very last one can be short.

The ids are written once and shuffled once. Only narrow rows (number, key, length) are sorted; their running sum is taken
inside the sorted partitions, and what earlier partitions add is a table of one row per partition. Equal keys, such as
those of copies, are ordered by row number and so spread over partitions.

Defined cases: null and empty texts consist of the end token; a null id is kept as such; repeated rows are packed each;
other columns are ignored by `pack`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peakweave.llm.common import written
from peakweave.llm.tokens import VOCABULARY, encode_batch, pieces

SIZE = 2048
END = 1
BUCKETS = 256
DIMENSIONS = 3
BITS = 16
STEP = 256
#: Coordinates beyond this many are cut off; a projected unit vector stays far inside.
REACH = 1.0


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place on the Hilbert curve of points with whole coordinates of `bits` bits (Skilling's transposed form)."""
    x = points.astype(np.uint64).T.copy()
    n, none, one = len(x), np.uint64(0), np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        low = np.uint64((1 << bit) - 1)
        for i in range(n):
            mirrored = (x[i] >> np.uint64(bit)) & one == one
            exchanged = np.where(mirrored, none, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(mirrored, low, exchanged)
            if i:
                x[i] ^= exchanged
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> np.uint64(bit)) & one == one, np.uint64((1 << bit) - 1), none)
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(bit)) & one)
    return key.astype(np.int64)


def projection() -> np.ndarray:
    """Bucket counts to coordinates: fixed normal directions."""
    return np.random.default_rng(7).normal(size=(BUCKETS, DIMENSIONS)) / np.sqrt(BUCKETS / 4)


def bucket(ids: np.ndarray) -> np.ndarray:
    """The bucket of each id: the top byte of a multiplicative hash."""
    return (ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(24)


def curve_keys(vectors: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents given as bucket counts."""
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    at = (vectors / np.maximum(length, 1)) @ projection()
    cells = np.clip((at + REACH) / (2 * REACH), 0, 1) * ((1 << BITS) - 1)
    return hilbert_key(cells.astype(np.int64))


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY, encode_special_tokens: bool = True) -> DataFrame:
    """`row`, `doc_id`, `key`, `n_tokens` with the end token, and `ids`, little-endian unsigned 16- or 32-bit numbers."""

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for at in range(0, len(texts), STEP):
                encoder = pieces(vocabulary, encode_special_tokens)
                ids = [np.append(x, np.int32(END)) for x in encode_batch(texts[at : at + STEP], encoder)]
                vectors = np.array([np.bincount(bucket(x), minlength=BUCKETS) for x in ids], dtype=float)
                yield pa.RecordBatch.from_arrays([
                    batch.column("row")[at : at + STEP], batch.column("doc_id")[at : at + STEP],
                    pa.array(curve_keys(vectors)), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.astype("<u4").tobytes() if x.max() >> 16 else x.astype("<u2").tobytes() for x in ids],
                             pa.binary())], names=["row", "doc_id", "key", "n_tokens", "ids"])

    numbered = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    return numbered.mapInArrow(
        run, f"row bigint, doc_id {dict(docs.dtypes)['doc_id']}, key bigint, n_tokens bigint, ids binary")


def along_curve(lengths: DataFrame) -> DataFrame:
    """`row` and `before`, the tokens of all documents that come earlier on the curve."""

    def run(batches):
        total = 0
        for batch in batches:
            ends = total + np.cumsum(batch.column("n_tokens").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("part"), batch.column("n_tokens"),
                 pa.array(ends - batch.column("n_tokens").to_numpy())], names=["row", "part", "n_tokens", "inside"])
            total = int(ends[-1]) if len(ends) else total

    placed = lengths.select("row", "key", "n_tokens").orderBy("key", "row").withColumn("part", F.spark_partition_id())
    summed = written(placed.select("row", "part", "n_tokens").mapInArrow(
        run, "row bigint, part int, n_tokens bigint, inside bigint"), "packing-curve")
    parts = summed.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    # one row per partition
    earlier = parts.select("part", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("earlier"))
    return summed.join(F.broadcast(earlier), "part").select("row", (F.col("earlier") + F.col("inside")).alias("before"))


def pack(docs: DataFrame, size: int = SIZE, vocabulary: str = VOCABULARY, encode_special_tokens: bool = True) -> DataFrame:
    """One row per piece: `doc_id`, `start` in its document, `length`, `ids` (32-bit little-endian), `doc_tokens`,
    `sequence_id` and `offset` in the sequence."""
    tokens = written(encoded(docs, vocabulary, encode_special_tokens), "packing-tokens")
    wide = tokens.drop("key").join(along_curve(tokens).hint("shuffle_hash"), "row")

    def run(batches):
        for batch in batches:
            before = batch.column("before").to_numpy()
            count = batch.column("n_tokens").to_numpy()
            first, last = before // size, (before + count - 1) // size
            n = last - first + 1
            owner = np.repeat(np.arange(len(n)), n)
            sequence = first[owner] + np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
            start = np.maximum(sequence * size - before[owner], 0)
            end = np.minimum((sequence + 1) * size - before[owner], count[owner])
            ids = []
            for k, data in enumerate(batch.column("ids").to_pylist()):
                width = "<u2" if len(data) == 2 * count[k] else "<u4"
                ids.append(np.frombuffer(data, dtype=width).astype("<u4"))
            cut = [ids[o][a:b].tobytes() for o, a, b in zip(owner.tolist(), start.tolist(), end.tolist())]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(owner)), pa.array(start), pa.array(end - start),
                pa.array(cut, pa.binary()), pa.array(count[owner]), pa.array(sequence),
                pa.array(before[owner] + start - sequence * size)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return wide.select("doc_id", "n_tokens", "ids", "before").mapInArrow(
        run, f"doc_id {dict(docs.dtypes)['doc_id']}, start bigint, length bigint, ids binary, doc_tokens bigint, "
             "sequence_id bigint, offset bigint")


def digest(packed: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
