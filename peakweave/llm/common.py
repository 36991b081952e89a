"""Helpers the text operators share."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peakweave.session import scratch_path

#: Bytes of text, as UTF-8, that a labelled sample has of each class at most.
SAMPLE_BYTES = 32_000_000

#: A key is hot when it has more than one row in this many.
HOT = 1000

# Lower-cases A-Z and turns every byte that is not in a word `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` into a blank. Bytes of
# 0x80 and above belong to characters outside ASCII, all of which are word characters.
ALNUM_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: computed once, safe when executors are lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], copies: str = "copies") -> DataFrame:
    """`rows` with what `groups` has for their keys; `copies` says how many rows have the key. Both are stored tables or cheap.

    A key with more than one row in HOT is sent to the rows by broadcast, fewer than HOT of them whatever the size of the
    table; the other keys are joined by a shuffle in which no key has more than that share. Keys must not be null.
    """
    groups = written(groups, "groups")
    total = groups.agg(F.coalesce(F.sum(copies), F.lit(0)).alias("n")).first()["n"]
    hot = F.col(copies) * HOT > total
    largest, others = F.broadcast(groups.filter(hot).drop(copies)), groups.filter(~hot).drop(copies)
    return rows.join(largest, keys).unionByName(
        rows.join(largest.select(*keys), keys, "left_anti").join(others.hint("merge"), keys))


def crc_mod(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return pc.fill_null(column, "").cast(pa.binary()).to_pylist()


def lowered(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes with A-Z in lower case; null is empty."""
    return pc.ascii_lower(pc.fill_null(column, "")).cast(pa.binary()).to_pylist()


def alnum_words(text: bytes) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z in lower case."""
    return text.translate(ALNUM_WORDS).split()


def space_words(text: bytes) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`: `bytes.split` parts at just these six bytes."""
    return text.split()


def map_texts(df: DataFrame, columns: list[str], schema: str, fn: Callable[[pa.RecordBatch], dict]) -> DataFrame:
    """Apply `fn` to Arrow batches of `columns`; it returns the output columns as lists or arrays."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [out[f.name].cast(f.type) if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], type=f.type)
                     for f in target], schema=target)

    return df.select(*columns).mapInArrow(run, schema)


def held_crc(doc_ids: list, divisor: int) -> list[int]:
    """crc32 of each id as text, modulo `divisor`."""
    return [zlib.crc32(b"" if i is None else str(i).encode()) % divisor for i in doc_ids]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, learn: Column,
                    sample_bytes: int | None = None) -> list[tuple[str, int]]:
    """At most `per_class` labelled texts of each class, or all of fewer, among the rows `learn` admits.

    An id is taken when its hash falls below the share its class needs; an id labelled twice counts once, as the larger
    label, and one with several rows counts once, with the least of its texts. The driver receives at most `per_class`
    texts of a class, whole, and `sample_bytes` of them (SAMPLE_BYTES by default): in the order of their ids' hashes, a text
    that doesn't fit in what is left is passed over, so that under a tight bound the sample has shorter texts.
    """
    known = labels.filter(learn).filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(label).cast("int").alias("label"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / float(1 << 32)
    wanted = F.lit(False)
    for value, size in sizes.items():
        wanted = wanted | ((F.col("label") == value) & (place < min(1.0, per_class / size)))
    chosen = known.filter(wanted)
    # a row per id before anything is collected; about two times `per_class` narrow rows on either side
    found = written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.first("label").alias("label")), "labelled-sample")
    narrow = found.select("doc_id", "label", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes")).collect()
    taken, room, left = [], dict.fromkeys(sizes, per_class), dict.fromkeys(sizes, sample_bytes or SAMPLE_BYTES)
    for r in sorted(narrow, key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"])):
        if room[r["label"]] and r["bytes"] <= left[r["label"]]:
            room[r["label"]] -= 1
            left[r["label"]] -= r["bytes"]
            taken.append(r["doc_id"])
    if len(taken) < len(narrow):
        kept = docs.sparkSession.createDataFrame([(i,) for i in taken], found.select("doc_id").schema)
        found = found.join(F.broadcast(kept), "doc_id")
    texts = {r["doc_id"]: (r["text"] or "", r["label"]) for r in found.collect()}
    return [texts[i] for i in taken]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights, the intercept last, by Newton steps on the penalised likelihood."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty @ w
        change = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w)), gradient)
        size = np.abs(change).max()
        w -= change * min(1.0, 5 / max(size, 1e-12))
        if size < 1e-8:
            break
    return w
