"""Product quantisation of whole-number vectors, with LAESA pivots.

Components become integers, vectors are cut into PARTS equal parts, and each part position has a codebook that ROUNDS of
assignment and averaging improve, all in integers. A part's distances to PIVOTS fixed points, entries of the first
codebook that lie far apart, are computed once and stored with it. In each round the driver sends the codebooks with
their entries' distances to the pivots; the largest difference of two such distances is a lower bound of the distance
itself. Entries are met in the order of their bounds: the FIRST nearest by bound are evaluated exactly, then of the rest
only those whose bound doesn't exceed the best found. Bounds are floats, so a margin above their rounding error is left;
distances are whole numbers, and ties go to the lower index.

A round is one scan of the stored parts. A task sends one row per entry, its count and component sums, which are added up
as decimals; the driver receives the codebooks only, whose size is PARTS x ENTRIES x part length whatever the table's.

Defined cases: a vector that is null or holds a null or non-finite component is dropped. Codebooks are for the vectors of
the most frequent length that PARTS divides (of ties, the smallest); vectors of other lengths are kept with null code and
error. Codebooks start from the smallest distinct ids that are not null, of an id that stands twice from its least vector;
with fewer than ENTRIES ids they are shorter, without any id or row there is no code. Repeated rows count each. Integers
beyond the range of a long are its ends; large ones are computed as Python integers, and an error beyond a long is null.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakweave.llm.common import attach, written

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
PIVOTS = 8
FIRST = 16
STEP = 2048
#: Lower bounds are lowered by this share of the largest distance: stored distances have 24 bits.
MARGIN = 1e-6

Book = list[np.ndarray]


def whole(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """`vec_id`, `label` and `x`, the integers, of the vectors that have only finite components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col("embedding").isNotNull() & finite).select(
        "vec_id", "label", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("x"))


def matrix(column: pa.ListArray, length: int) -> np.ndarray:
    """Lists of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def exact(x: np.ndarray, book: np.ndarray) -> bool:
    """Whether all squared distances are exact in a double, and so in a long."""
    most = max(int(abs(a).max(initial=0)) for a in (x, book))
    return (2 * most) ** 2 * max(1, x.shape[1]) < 1 << 52


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all entries: whole numbers, as doubles where these are exact."""
    if exact(x, book):
        a, b = x.astype(float), book.astype(float)
        return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
    a, b = x.astype(object), book.astype(object)
    return np.stack([((a - e) ** 2).sum(axis=1) for e in b], axis=1) if x.shape[1] else np.zeros((len(a), len(b)), object)


def pair_distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of each row to the entry beside it."""
    kind = np.int64 if exact(x, book) else object
    apart = x.astype(kind) - book.astype(kind)
    return (apart * apart).sum(axis=-1) if x.shape[-1] else np.zeros(apart.shape[:-1], kind)


def roots(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(float))


def pivots(book: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Entries far apart: the first, then each time the one farthest from those chosen."""
    chosen = [0]
    apart = roots(distances(book, book))
    while len(chosen) < min(n, len(book)):
        chosen.append(int(apart[chosen].min(axis=0).argmax()))
    return book[chosen]


def nearest(x: np.ndarray, near: np.ndarray, book: np.ndarray, book_near: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of each row's nearest entry, and the number of distances evaluated.

    `near` and `book_near` are the rows' and the entries' distances to the pivots.
    """
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    bound = np.zeros((len(x), len(book)))
    for p in range(near.shape[1]):
        np.maximum(bound, np.abs(near[:, p, None] - book_near[:, p]), out=bound)
    bound -= MARGIN * (near.max(initial=0) + book_near.max(initial=0)) + MARGIN
    head = np.argpartition(bound, FIRST, axis=1)[:, :FIRST] if FIRST < len(book) else np.tile(np.arange(len(book)), (len(x), 1))
    rows = np.arange(len(x))
    found = pair_distances(np.repeat(x, head.shape[1], axis=0), book[head.ravel()]).reshape(head.shape)
    best = found.min(axis=1)
    index = np.where(found == best[:, None], head, len(book)).min(axis=1)
    left = bound <= roots(best)[:, None]
    left[rows[:, None], head] = False
    count = left.sum(axis=1)
    evaluated = head.size + int(count.sum())
    # rows with many entries left evaluate them in one product, the others one by one
    many = count * 4 > len(book)
    if many.any():
        every = distances(x[many], book)
        every = np.where(left[many], every, np.inf)
        at = every.argmin(axis=1)
        _better(best, index, np.flatnonzero(many), at, every[np.arange(len(at)), at])
    r, e = np.nonzero(left & ~many[:, None])
    if len(r):
        squared = pair_distances(x[r], book[e])
        order = np.lexsort((e, squared, r))
        one = order[np.concatenate([[True], np.diff(r[order]) > 0])]
        _better(best, index, r[one], e[one], squared[one])
    return index, best, evaluated


def _better(best: np.ndarray, index: np.ndarray, rows: np.ndarray, at: np.ndarray, squared: np.ndarray) -> None:
    take = (squared < best[rows]) | ((squared == best[rows]) & (at < index[rows]))
    best[rows[take]], index[rows[take]] = squared[take], at[take]


def prepared(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES) -> tuple[DataFrame, Book, Book]:
    """The stored parts with their distances to the pivots (`vec_id`, `label`, `x`, `near`), first codebooks and pivots.

    `near` is null for vectors of another length than the codebooks'.
    """
    kept = whole(vectors, scale)
    sizes = kept.groupBy(F.size("x").alias("size")).count().filter(F.col("size") % parts == 0)
    top = sizes.orderBy(F.desc("count"), "size").first()
    length = top["size"] if top else 0
    usable = kept.filter((F.size("x") == length) & F.col("vec_id").isNotNull())
    ids = [r["vec_id"] for r in usable.select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
    starts = usable.filter(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("x").alias("x")).collect() if ids else []
    first = np.array([r["x"] for r in sorted(starts, key=lambda r: r["vec_id"])], dtype=np.int64).reshape(len(starts), length)
    books = np.split(first, parts, axis=1)
    fixed = [pivots(b) if len(b) else b for b in books]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), length) if length else np.zeros((batch.num_rows, 0), np.int64)
            near = np.concatenate([roots(distances(p, f)) for p, f in zip(np.split(x, parts, axis=1), fixed)], axis=1)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1, dtype=np.int32) * near.shape[1], pa.int32()), pa.array(near.ravel().astype(np.float32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["vec_id", "label", "x", "near"])

    kinds = dict(kept.dtypes)
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, x array<bigint>, near array<float>"
    fits = (F.size("x") == length) & F.lit(bool(len(first)))
    table = kept.filter(fits).mapInArrow(run, schema).unionByName(
        kept.filter(~fits).withColumn("near", F.lit(None).cast("array<float>")))
    return written(table, "vector-parts"), books, fixed


def assigned(batch: pa.RecordBatch, books: Book, fixed: Book) -> Iterator[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """Steps of a batch: the integers, and index and squared distance of each part."""
    n, length = len(fixed[0]), sum(b.shape[1] for b in books)
    near_entries = [roots(distances(b, f)) for b, f in zip(books, fixed)]
    x = matrix(batch.column("x"), length) if length else np.zeros((batch.num_rows, 0), np.int64)
    near = matrix(batch.column("near"), n * len(books)).astype(float)
    for at in range(0, len(x), STEP):
        step, beside = x[at : at + STEP], near[at : at + STEP]
        parts = zip(np.split(step, len(books), axis=1), np.split(beside, len(books), axis=1), books, near_entries)
        yield step, [nearest(*p)[:2] for p in parts]


def sums(books: Book, fixed: Book) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's rows: for each entry met the count and the component sums of its parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(b.shape, dtype=object) for b in books]
        counts = [np.zeros(len(b), dtype=np.int64) for b in books]
        for batch in batches:
            for step, found in assigned(batch, books, fixed):
                for p, (part, (index, _)) in enumerate(zip(np.split(step, len(books), axis=1), found)):
                    order = np.argsort(index, kind="stable")
                    met, at, n = np.unique(index[order], return_index=True, return_counts=True)
                    # a step of STEP longs below 2**50 cannot overflow
                    rows = part[order] if int(abs(part).max(initial=0)) >> 50 == 0 else part[order].astype(object)
                    totals[p][met] += np.add.reduceat(rows, at, axis=0).astype(object)
                    counts[p][met] += n
        rows = [(p, e, int(c), [Decimal(int(v)) for v in totals[p][e]]) for p in range(len(books)) for e, c in enumerate(counts[p]) if c]
        if rows:
            part, entry, count, total = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count, pa.int64()),
                 pa.array(total, pa.list_(pa.decimal128(38, 0)))], names=["part", "entry", "count", "sums"])

    return run


def improved(parts: DataFrame, books: Book, fixed: Book) -> Book:
    """The codebooks of the next round; an entry without parts stays."""
    width = books[0].shape[1]
    found = parts.filter("near is not null").mapInArrow(
        sums(books, fixed), "part int, entry int, count bigint, sums array<decimal(38,0)>").groupBy("part", "entry").agg(
        F.sum("count").alias("count"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"))
    out = [b.copy() for b in books]
    for r in found.collect():  # a row per entry
        out[r["part"]][r["entry"]] = [int(s) // r["count"] for s in r["sums"][:width]]
    return out


def encode(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Book]:
    """(`vec_id`, `label`, `code`, `error`) of each vector, and the codebooks, one array of entries per part."""
    table, books, fixed = prepared(vectors, scale, parts, entries)
    if not len(books[0]):
        return table.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error")), books
    for _ in range(rounds):
        books = improved(table, books, fixed)
    digits = max(2, len(f"{entries - 1:x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = [], []
            for _, found in assigned(batch, books, fixed):
                codes += ["".join(f"{i:0{digits}x}" for i in row) for row in zip(*(index.tolist() for index, _ in found))]
                errors += [sum(map(int, row)) for row in zip(*(squared.tolist() for _, squared in found))]
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()),
                pa.array([e if e >> 63 == 0 else None for e in errors], pa.int64())], names=["vec_id", "label", "code", "error"])

    kinds = dict(table.dtypes)
    coded = table.filter("near is not null").select("vec_id", "label", "x", "near").mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint")
    rest = table.filter("near is null").select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    return coded.unionByName(rest), books


def decoded(code: str, books: Book) -> list[int]:
    """The integers that a code stands for."""
    digits = len(code) // len(books)
    return [int(v) for p, b in enumerate(books) for v in b[int(code[p * digits : (p + 1) * digits], 16)]]


def digest(vectors: DataFrame) -> DataFrame:
    """Codes with their errors, the errors' sum over equal labels and a hash of the codebooks."""
    coded, books = encode(vectors)
    coded = written(coded, "vector-codes")
    text = ",".join(str(int(v)) for b in books for v in b.ravel())
    # null is a label of its own
    keyed = coded.withColumns({"unlabelled": F.col("label").isNull(), "group": F.coalesce("label", F.lit(0).cast(dict(coded.dtypes)["label"]))})
    totals = keyed.groupBy("unlabelled", "group").agg(
        F.count("*").alias("copies"), F.sum(F.col("error").cast("decimal(38,0)")).cast("bigint").alias("label_error"))
    return attach(keyed, totals, ["unlabelled", "group"]).select(
        "vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"))
