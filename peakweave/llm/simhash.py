"""SimHash near-duplicates with pivot distance tables.

Each distinct fingerprint gets a table row: its Hamming distances to PIVOTS reference fingerprints, block by block (four
blocks of 16 bits). Two fingerprints within two bits differ in two blocks at most, so in some pair of blocks all their
coordinates are equal: equal coordinates of a pair of blocks propose the candidates. A candidate is discarded when any
coordinate of the whole distance table differs by more than the limit (each pivot's distance obeys the triangle
inequality), and what survives is verified bit by bit.

Hot keys: copies collapse to one fingerprint first. A key that holds more than DENSE fingerprints is not paired; its
members meet at the centres of their radius-1 balls instead (two points within two bits share a centre), each linked to
the centre's smallest member. That keeps every connection with a linear number of links. Links become components by
large-star and small-star rounds, each written to shared storage. Fingerprints and components that hold more than a
thousandth of the rows find their documents by broadcast, fewer than a thousand of them; the others by a shuffle.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; a null id is never the smallest
of its group unless all are null; repeated rows are copies; other columns are ignored, and kept by `keep_one`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakweave.llm.common import attach, lowered, map_texts, space_words, written

SHINGLE = 3
MAX_BITS = 2
SEED = 42
PIVOTS = 16
BLOCK_BITS = 16
BLOCKS = 64 // BLOCK_BITS
DENSE = 32


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes; zero without words."""
    words = space_words(text)
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate([[0], ends[:-1]])
        shingles = [joined[a:b] for a, b in zip(starts.tolist(), (ends[shingle - 1 :] - 1).tolist())]
    hash_ = xxhash.xxh64_intdigest
    values = np.array([hash_(s, SEED) for s in shingles], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), 1 << 16):
        part = values[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(values)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, row: str | None = None) -> DataFrame:
    """`row` (the column with that number in `docs`, or a number given here), `doc_id` and `fp`, the fingerprint as a signed long."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"row": batch.column("row"), "doc_id": batch.column("doc_id"),
                "fp": [fingerprint(t, shingle) for t in lowered(batch.column("text"))]}

    numbered = docs.select("doc_id", "text", (F.col(row) if row else F.monotonically_increasing_id()).alias("row"))
    return map_texts(numbered, ["row", "doc_id", "text"],
                     f"row bigint, doc_id {dict(docs.dtypes)['doc_id']}, fp bigint", run)


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints as signed longs, the same on every run."""
    return [signed(xxhash.xxh64_intdigest(f"pivot {i}", SEED)) for i in range(n)]


def distances(fp: Column, mask: int = -1) -> Column:
    """The Hamming distances to the pivots over the bits of `mask`: one row of the distance table."""
    return F.array(*[F.bit_count(fp.bitwiseXOR(F.lit(p)).bitwiseAND(F.lit(mask))).cast("byte") for p in pivots()])


def coordinates_apart(a: str, b: str) -> Column:
    """The largest difference between two rows of the distance table."""
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def signed(bits: int) -> int:
    return int(np.uint64(bits).astype(np.int64))


def links(points: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b), a < b, between distinct fingerprints: enough of them that all within `max_bits` are connected."""
    if max_bits != BLOCKS // 2:
        raise ValueError(f"{BLOCKS} blocks serve a distance of {BLOCKS // 2}")
    pairs = [(i, j) for i in range(BLOCKS) for j in range(i + 1, BLOCKS)]
    masks = [signed(((1 << BLOCK_BITS) - 1) << (BLOCK_BITS * b)) for b in range(BLOCKS)]
    tabled = points.select("fp", *[distances(F.col("fp"), m).alias(f"near_{b}") for b, m in enumerate(masks)])
    placed = tabled.select("fp", F.explode(F.array(*[
        F.struct(F.lit(n).alias("pair"), F.xxhash64(F.lit(n), f"near_{i}", f"near_{j}").alias("key"))
        for n, (i, j) in enumerate(pairs)])).alias("k")).select("fp", "k.pair", "k.key")
    shared = placed.groupBy("pair", "key").agg(F.count("*").alias("members")).filter("members > 1")
    members = written(placed.join(shared, ["pair", "key"]).withColumn("table", distances(F.col("fp"))), "simhash-members")

    left = members.filter(F.col("members") <= DENSE).select("pair", "key", F.col("fp").alias("a"), F.col("table").alias("table_a"))
    right = left.withColumnsRenamed({"a": "b", "table_a": "table_b"})
    near = left.join(right, ["pair", "key"]).filter("a < b").filter(
        coordinates_apart("table_a", "table_b") <= max_bits).select("a", "b")

    # ball centres: the point itself and its one-bit neighbours outside the key's equal blocks
    free = [[b for b in range(64) if b // BLOCK_BITS not in p] for p in pairs]
    flips = F.element_at(F.array(*[
        F.array(*[F.lit(f).cast("bigint") for f in (0, *[signed(1 << b) for b in bits])]) for bits in free]),
        F.col("pair") + 1)
    balls = members.filter(F.col("members") > DENSE).select(
        "pair", "key", "fp", F.explode(flips).alias("flip")).select(
        "pair", "key", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
    hubs = balls.groupBy("pair", "key", "centre").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    around = balls.join(hubs.drop("n"), ["pair", "key", "centre"]).filter("hub < fp").select(
        F.col("hub").alias("a"), F.col("fp").alias("b"))
    return near.unionByName(around).distinct().filter(
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every linked node: large-star and small-star rounds until all edges are stars at their smallest."""
    edges = written(edges.select("a", "b"), "simhash-edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(
            F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b")),
                              F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")
        edges = written(small.filter("a < b").distinct(), "simhash-edges")
        # settled when the same edges come out again: their number, sums and a hash of them
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        state = now


def group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, row: str | None = None) -> DataFrame:
    """One row per document: `row`, `doc_id`, `fp`, `root` (the class) and `component_id`, the smallest id links reach."""
    prints = written(fingerprints(docs, shingle, row), "simhash-fingerprints")
    points = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "simhash-points")
    stars = components(links(points.select("fp"), max_bits))
    # an unlinked point is its own class; the classes' smallest ids come from the points, not from the documents
    roots = written(points.join(stars.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", "copies", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    smallest = roots.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
    named = attach(roots, smallest, ["root"], "members").select("fp", "root", "component_id", "copies")
    return attach(prints, named, ["fp"]).select("row", "doc_id", "fp", "root", "component_id")


def digest(grouped: DataFrame) -> DataFrame:
    """Fingerprints as 16 lowercase hex digits beside the classes."""
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents with one of each class: the one of the smallest id, and of rows that share it the first.

    Rows are numbered once and stored with their number, by which the chosen ones are found again: another split of the
    files, as after a change of executors, cannot move it.
    """
    row = "row"
    while row in docs.columns:
        row += "_"
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-documents")
    first = group(numbered, shingle, max_bits, row).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("kept"))
    return numbered.join(first.select(F.col("kept.row").alias(row)), row, "left_semi").select(*docs.columns)
