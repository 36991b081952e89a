"""Exact nearest neighbours by cosine distance, without a product of all pairs.

Vectors have unit length, so the cosine distance orders like the distance in space and
the triangle inequality can rule rows out. The right rows fall into cells around pivots.
A left row first meets right rows of its own cell; its k-th distance there is a bound, and
of all cells it then meets only those that reach inside the bound: a cell whose pivot is
farther than the bound plus the cell's radius has no neighbour of it. Where vectors form
clusters a row meets a few cells, whatever their number.

Rows are not sent to cells but to blocks: several small cells, or a stripe of a large one.
A left row goes once to each block with a cell it must meet, so it is sent at most GRID times
until blocks reach STRIPE rows, and never more often than there are blocks. The left rows of
a block are cut by hash as well, so a task gets two lots of at most STRIPE rows. It walks
through its cells, multiplies a cell with the rows that must meet it, and looks closer only
at products inside the bound. The lists of a row, one per block, are merged by an aggregate
that never holds more than k of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakweave.functions.arrays import l2_normalize
from peakweave.session import materialize

#: Cells at most; the pivots are a bounded table.
CELLS = 256
#: Rows of one side in a task at most, and at least where that leaves more than one task.
STRIPE = 65536
LEAST = 2048
#: Blocks per side as long as they stay below STRIPE rows.
GRID = 12
BLOCK = 1024
#: Right rows multiplied at once.
WIDTH = 8192
#: Distances are compared at this many decimals, so that equal ones order by id.
DIGITS = 12


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _apart(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances in space of unit rows to the pivots."""
    return np.sqrt(np.maximum(2 - 2 * (x @ pivots.T), 0))


def choose_pivots(rows: DataFrame, cells: int = CELLS) -> np.ndarray:
    """Rows far apart among a sample by hash: at most four candidates per cell reach the driver."""
    total = rows.count()
    wanted = max(1, min(cells, int(np.sqrt(total))))
    share = min(1.0, 4.0 * wanted / max(total, 1))
    place = F.pmod(F.xxhash64("v"), F.lit(1 << 32)) / float(1 << 32)
    found = rows.filter(place < share).select("v").distinct().limit(8 * cells).toArrow()
    candidates = _matrix(found.column("v")) if found.num_rows else _matrix(rows.select("v").limit(1).toArrow().column("v"))
    candidates = candidates[np.lexsort(candidates.T)]
    chosen = [0]
    nearest = _apart(candidates, candidates[:1])[:, 0]
    while len(chosen) < min(wanted, len(candidates)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _apart(candidates, candidates[chosen[-1:]])[:, 0])
    return candidates[chosen]


def _with_cells(rows: DataFrame, visits, schema: str) -> DataFrame:
    """A row for each cell that `visits` (rows to (row, cell) places and further columns) names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                row, cell = visits(part)
                out = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([out.column("id"), out.column("v"), pa.array(cell.astype(np.int32))],
                                                 names=["id", "v", "cell"])

    return rows.mapInArrow(run, schema)


def _best(row: np.ndarray, value: np.ndarray, col: np.ndarray, k: int) -> np.ndarray:
    """The places of each row's k entries that come first by (value, col), in that order."""
    order = np.lexsort((col, value, row))
    at = row[order]
    return order[np.arange(len(at)) - np.searchsorted(at, at, side="left") < k]


def _closest(x: np.ndarray, y: np.ndarray, rank: np.ndarray, own: np.ndarray, bound: np.ndarray, k: int, digits: int,
             pieces: list[tuple[int, int, np.ndarray | None]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, value, rank): per row of x its k nearest of y inside its bound; equal distances order by `rank` of y.

    A piece is a run of y, in the order of ranks, and the rows of x that meet it (None: all).
    `own` is the place in y of the row itself, to be left out, or -1.
    """
    margin = 10.0**-digits
    floor = 1 - bound - margin
    found = [(np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=np.int64))]
    held = 0
    for start, stop, rows in pieces:
        for at in range(start, stop, WIDTH):
            end = min(at + WIDTH, stop)
            near = x if rows is None else x[rows]
            s = near @ y[at:end].T
            mine = own if rows is None else own[rows]
            self_rows = np.flatnonzero((mine >= at) & (mine < end))
            s[self_rows, mine[self_rows] - at] = -np.inf
            hit = s >= (floor if rows is None else floor[rows])[:, None]
            some = np.count_nonzero(hit)
            if not some:
                continue
            if some > 4 * k * len(near) and some > hit.size // 32:
                # many inside the bound: the first k by (distance, place) of this piece only
                far = np.round(1 - s, digits)
                col = np.argsort(far, axis=1, kind="stable")[:, :k]
                row, col = np.repeat(np.arange(len(near)), col.shape[1]), col.ravel()
                value = far[row, col]
            else:
                row, col = np.nonzero(hit)
                value = np.round(1 - s[row, col], digits)
            inside = np.isfinite(value)
            row, col, value = row[inside], col[inside], value[inside]
            found.append((row if rows is None else rows[row], value, rank[col + at]))
            held += len(row)
            if held > 8 * k * len(x):
                found = [_trimmed(found, k)]
                row, value, _ = found[0]
                held = len(row)
                full = np.flatnonzero(np.bincount(row, minlength=len(x)) == k)
                last = np.searchsorted(row, full, side="right") - 1
                floor[full] = np.maximum(floor[full], 1 - value[last] - margin)
    return _trimmed(found, k)


def _trimmed(found: list, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row, value, col = (np.concatenate(c) for c in zip(*found))
    best = _best(row, value, col, k)
    return row[best], value[best], col[best]


def _nearest_in_group(k: int, digits: int, skip_self: bool, pivots: np.ndarray, radius: np.ndarray):
    """For the rows of one block: per left row the ids and distances of its k nearest right rows inside its bound.

    The right rows stand in the order of their cells (-1: any left row meets them); a left row without a bound meets all.
    """

    def run(group: pa.Table) -> pa.Table:
        right = group.filter(pc.equal(group.column("side"), 1)).sort_by([("id", "ascending")])
        left = group.filter(pc.equal(group.column("side"), 0))
        ids = right.column("id").combine_chunks()
        lists, apart, counts = [ids.slice(0, 0)], [np.zeros(0)], [np.zeros(0, dtype=int)]
        if left.num_rows and right.num_rows:
            # equal distances order by id: y stands by cell, and `by_cell` has the ranks of its ids
            cells = right.column("cell").to_numpy()
            by_cell = np.argsort(cells, kind="stable")
            y = _matrix(right.column("v"))[by_cell]
            edges = np.flatnonzero(np.diff(cells[by_cell], prepend=-2))
            runs = list(zip(cells[by_cell][edges], edges, [*edges[1:], len(y)]))
            back = np.argsort(by_cell)
            mine = np.full(left.num_rows, -1)
            if skip_self:
                known = pc.index_in(left.column("id"), value_set=ids).to_numpy(zero_copy_only=False).astype(float)
                mine[~np.isnan(known)] = back[known[~np.isnan(known)].astype(int)]
            x = _matrix(left.column("v"))
            bounds = left.column("bound").to_numpy(zero_copy_only=False).astype(float)
            bounds = np.where(np.isnan(bounds), np.inf, bounds)
            for at in range(0, len(x), BLOCK):
                part, bound = x[at : at + BLOCK], bounds[at : at + BLOCK]
                meets = _reached(part, bound, pivots, radius, digits)
                pieces = []
                for cell, start, stop in runs:
                    rows = None if cell < 0 or meets[:, cell].all() else np.flatnonzero(meets[:, cell])
                    if rows is None or len(rows):
                        pieces.append((start, stop, rows))
                row, value, rank = _closest(part, y, by_cell, mine[at : at + BLOCK], bound, k, digits, pieces)
                lists.append(ids.take(pa.array(rank)))
                apart.append(value)
                counts.append(np.bincount(row, minlength=len(part)))
        sizes = np.concatenate(counts) if len(counts) > 1 else np.zeros(left.num_rows, dtype=int)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        structs = pa.StructArray.from_arrays([pa.array(np.concatenate(apart)), pa.concat_arrays(lists)], names=["distance", "id"])
        return pa.table({"id": left.column("id").combine_chunks(), "near": pa.ListArray.from_arrays(offsets, structs)})

    return run


def _reached(x: np.ndarray, bound: np.ndarray, pivots: np.ndarray, radius: np.ndarray, digits: int) -> np.ndarray:
    """Which cells reach inside the bound of a row: cosine distances become distances in space."""
    limit = np.sqrt(np.maximum(2 * (bound + 10.0**-digits), 0)) + 1e-7
    return _apart(x, pivots) - radius <= limit[:, None]


def nearest(left: DataFrame, right: DataFrame, k: int = 10, id_column: str = "id", vector: str = "embedding",
            skip_self: bool = False, cells: int = CELLS, stripe: int = STRIPE, digits: int = DIGITS) -> DataFrame:
    """(id, near): each left row with its k nearest right rows by cosine distance, as (distance, id), nearest first.

    Equal distances order by id; ids are unique on each side. Vectors have one length and are
    scaled to unit length here. `skip_self` leaves out the right row of the same id. A null
    vector, and one with a null or NaN component, meets nothing: its list is empty. Fewer right
    rows than k give shorter lists.
    """
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")))
    unit = lambda df: df.select(F.col(id_column).alias("id"), F.when(whole, l2_normalize(vector)).alias("v"))
    a = materialize(unit(left))
    known = a.filter("v is not null")
    b = materialize(unit(right).filter("v is not null"))
    if b.isEmpty():
        return a.select("id", F.array().cast(f"array<struct<distance:double,id:{dict(a.dtypes)['id']}>>").alias("near"))
    pivots = choose_pivots(b, cells)
    wanted = k + 1 if skip_self else k

    def home(batch: pa.RecordBatch):
        return np.arange(batch.num_rows), _apart(_matrix(batch.column("v")), pivots).argmin(axis=1)

    kind = dict(b.dtypes)["id"]
    schema = f"id {kind}, v array<double>, cell int"
    placed = materialize(_with_cells(b, home, schema))
    # a row per cell: how many it holds and how far they reach
    reach = F.sqrt(F.greatest(2 - 2 * F.aggregate(F.zip_with("v", F.col("p"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))
    table = b.sparkSession.createDataFrame([(i, p.tolist()) for i, p in enumerate(pivots)], "cell int, p array<double>")
    sizes = np.zeros(len(pivots), dtype=np.int64)
    radius = np.zeros(len(pivots))
    for r in placed.join(F.broadcast(table), "cell").groupBy("cell").agg(  # CELLS rows at most
            F.count(F.lit(1)).alias("n"), F.max(reach).alias("r")).collect():
        sizes[r["cell"]], radius[r["cell"]] = r["n"], r["r"]
    size = int(min(stripe, max(LEAST, -(-int(sizes.sum()) // GRID))))
    stripes = np.maximum(1, -(-sizes // size))

    def first(batch: pa.RecordBatch):
        """The nearest cells until they hold `wanted` rows."""
        apart = _apart(_matrix(batch.column("v")), pivots)
        order = apart.argsort(axis=1, kind="stable")
        before = np.cumsum(sizes[order], axis=1) - sizes[order]
        row, place = np.nonzero(before < wanted)
        return row, order[row, place]

    own = lambda n, *more: F.pmod(F.xxhash64("id", *more), n).cast("int")
    at = lambda numbers, c: F.element_at(F.array(*[F.lit(int(n)) for n in numbers]), F.col(c) + 1)
    one_of = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    lists = f"id {kind}, near array<struct<distance:double,id:{kind}>>"

    def merge(found: DataFrame) -> DataFrame:
        # at most one list of k per block met
        best = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k)
        return found.groupBy("id").agg(best.alias("near"))

    def met(ours: DataFrame, theirs: DataFrame, lots: int) -> DataFrame:
        """Lists of the k nearest per left row (id, v, bound, lot) from the right rows (id, v, cell, lot) of its lots."""
        # the left rows of a lot are cut by hash: as many parts as their own number asks for
        numbers = {r["lot"]: r["n"] for r in ours.groupBy("lot").agg(F.count(F.lit(1)).alias("n")).collect()}
        parts = at([max(1, -(-numbers.get(b, 0) // size)) for b in range(lots)], "lot")
        a = ours.select("id", "v", F.lit(-1).alias("cell"), "bound", F.lit(0).alias("side"), "lot", own(parts, F.lit(1)).alias("part"))
        b = theirs.filter(F.col("lot").isin(list(numbers))).select(
            "id", "v", "cell", F.lit(None).cast("double").alias("bound"), F.lit(1).alias("side"), "lot", one_of(parts).alias("part"))
        return merge(a.unionByName(b).groupBy("lot", "part").applyInArrow(_nearest_in_group(k, digits, skip_self, pivots, radius), lists))

    # a bound: the k-th distance in one stripe of the row's own cell
    start = materialize(_with_cells(known, first, schema))
    base = np.cumsum(stripes) - stripes
    stood = (at(base, "cell") + own(at(stripes, "cell"))).alias("lot")
    begun = met(start.select("id", "v", F.lit(None).cast("double").alias("bound"), stood),
                placed.select("id", "v", F.lit(-1).alias("cell"), stood), int(stripes.sum()))
    bounded = materialize(known.join(begun.select("id", F.when(F.size("near") >= k, F.element_at("near", -1)["distance"]).alias("bound")), "id"))

    # cells to blocks: small ones share a block, the stripes of a large one have a block each
    opens = np.zeros(len(sizes), dtype=np.int64)
    blocks, fill = 0, size
    for c, n in enumerate(sizes):
        if stripes[c] > 1:
            opens[c], blocks, fill = blocks, blocks + int(stripes[c]), size
        else:
            if fill + n > size:
                blocks, fill = blocks + 1, 0
            opens[c], fill = blocks - 1, fill + n
    inside = (np.arange(blocks) >= opens[:, None]) & (np.arange(blocks) < (opens + stripes)[:, None]) & (sizes > 0)[:, None]

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each block with a cell that reaches inside the bound; without k rows yet there is no bound."""
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                part = batch.slice(begin, BLOCK)
                bound = part.column("bound").to_numpy(zero_copy_only=False).astype(float)
                reach = _reached(_matrix(part.column("v")), np.where(np.isnan(bound), np.inf, bound), pivots, radius, digits)
                row, block = np.nonzero(reach.astype(np.float32) @ inside.astype(np.float32))
                out = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([out.column("id"), out.column("v"), out.column("bound"), pa.array(block.astype(np.int32))],
                                                 names=["id", "v", "bound", "lot"])

    visits = bounded.mapInArrow(rest, f"id {kind}, v array<double>, bound double, lot int")
    dealt = placed.select("id", "v", "cell", (at(opens, "cell") + own(at(stripes, "cell"))).alias("lot"))
    found = met(visits, dealt, blocks)
    return a.select("id").join(found, "id", "left").withColumn("near", F.coalesce("near", F.array().cast(dict(found.dtypes)["near"])))
