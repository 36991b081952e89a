"""Near-duplicate vectors by spherical k-means cells, exact for the limit.

Equal vectors of a label collapse to one point with a number of copies. Spherical k-means, fitted on a sample of SAMPLE
points at most, gives unit centres; every point belongs to the cell of its most similar centre. Points within the limit
differ by at most `reach` = sqrt(2 - 2 limit) in space, which gives what can lie across a border: a point x of cell c can
have a partner in cell d only if x lies within `reach` of the plane that parts the two cells, and if its angle to d's
centre is at most the widest angle inside d plus the limit's angle. Such a point is a guest of d. Guests go to the cell of
lower number only, so that each pair meets once, and no pair is lost. The number of cells is that of 1, 4, 16, ... with
the least work as estimated from the sample: where vectors have no clusters almost all would be guests, and few cells are
cheaper; results don't depend on it.

Inside a cell points are dealt by hash into stripes of about STRIPE rows, and a task gets two of them; their cosine
products are taken block by block. A task returns, per point, its linked vectors and the smallest point it is connected
with: pairs are counted, never emitted, so a group of n near copies gives n rows, not n squared. Connections become
components by star contraction, each round in shared storage.

Defined cases: a vector that is null, zero, or holds a null or non-finite component, and one whose label is null, links
with nothing; only vectors of one length are compared; repeated rows and ids are vectors each; a null id is never the
smallest of its group unless all are null. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakweave.llm.common import attach, written
from peakweave.llm.simhash import components

LIMIT = 0.93
SAMPLE = 20_000
CENTRE_BYTES = 16_000_000
STRIPE = 4096
BLOCK = 1024
ROUNDS = 12
#: Products this close to the limit are taken again, component by component.
DOUBT = 1e-9
#: Pairs whose products take as long as moving one row.
PAIRS_PER_ROW = 200.0


def unit(vector: np.ndarray) -> np.ndarray | None:
    """The vector at length one; none for a vector without a direction."""
    most = np.abs(vector).max(initial=0)
    if not np.isfinite(most) or most == 0:
        return None
    scaled = np.ldexp(vector, -int(np.frexp(most)[1]))  # exact, so that squares neither overflow nor vanish
    return scaled / np.sqrt((scaled * scaled).sum())


def units(vectors: DataFrame) -> DataFrame:
    """`vec_id`, `label`, `unit`, the doubles of the vector at length one or null, and `twin`, a hash of the vector."""
    kinds = dict(vectors.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, twins = [], []
            labels = batch.column("label").is_valid().to_pylist()
            for v, labelled in zip(batch.column("embedding"), labels):
                own = v.values
                u = None
                if labelled and own is not None and not own.null_count:
                    raw = own.to_numpy(zero_copy_only=False).astype("<f8") + 0.0  # no negative zero
                    u = unit(raw)
                found.append(None if u is None else u.astype("<f8").tobytes())
                twins.append(None if u is None else hashlib.blake2b(raw.tobytes(), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(found, pa.binary()),
                                              pa.array(twins, pa.binary())], names=["vec_id", "label", "unit", "twin"])

    return vectors.select("vec_id", "label", "embedding").mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, unit binary, twin binary")


def rows_of(column: pa.Array) -> np.ndarray:
    """Units of one length as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(len(column), -1)


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres by spherical k-means from evenly spaced rows; a centre without members stays."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        home = (x @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, home, x)
        length = np.sqrt((total * total).sum(axis=1))
        moved = length > 1e-9
        centres[moved] = total[moved] / length[moved, None]
    return centres


class Cells:
    """Centres with what decides who is a guest of a cell."""

    def __init__(self, centres: np.ndarray, limit: float):
        self.centres = centres
        self.limit = limit
        gaps = 2 - 2 * (centres @ centres.T)
        self.margin = np.sqrt(2 - 2 * limit) * np.sqrt(np.maximum(gaps, 0)) + 1e-9
        self.widest = np.full(len(centres), -1.0)  # cosine of the widest angle inside each cell

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and products with all centres."""
        near = x @ self.centres.T
        return near.argmax(axis=1), near

    def guests(self, home: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of the cells below a row's own that can hold a partner of it."""
        own = near[np.arange(len(near)), home]
        angle = np.minimum(np.arccos(np.clip(self.widest, -1, 1)) + np.arccos(self.limit) + 1e-7, np.pi)
        can = (own[:, None] - near <= self.margin[home]) & (near >= np.cos(angle) - 1e-9)
        can &= np.arange(len(self.centres)) < home[:, None]
        return np.nonzero(can)

    def work(self, x: np.ndarray, labels: np.ndarray, times: float) -> float:
        """Rows moved and pairs compared, in rows, if each row of `x` stood for `times` points."""
        home, near = self.home(x)
        self.widest = np.ones(len(self.centres))
        np.minimum.at(self.widest, home, near[np.arange(len(x)), home])
        row, cell = self.guests(home, near)
        groups = len(self.centres) * (int(labels.max(initial=0)) + 1)
        own = np.bincount(labels * len(self.centres) + home, minlength=groups) * times
        came = np.bincount(labels[row] * len(self.centres) + cell, minlength=groups) * times
        moved = (own + came) * np.ceil((own + came) / STRIPE)
        return float((moved + (own * own / 2 + own * came) / PAIRS_PER_ROW).sum())


def fit_cells(points: DataFrame, limit: float, sample: int = SAMPLE) -> dict[int, Cells]:
    """Cells for the most frequent length of unit vectors; those of other lengths have one cell.

    The driver receives about `sample` points, chosen by hash, and the centres are at most CENTRE_BYTES.
    """
    sizes = points.groupBy(F.octet_length("unit").alias("bytes")).count().orderBy(F.desc("count"), "bytes").first()
    if sizes is None:
        return {}
    share = min(1.0, sample / sizes["count"])
    place = F.pmod(F.xxhash64("twin", "label"), F.lit(1 << 32)) / float(1 << 32)
    taken = points.filter((F.octet_length("unit") == sizes["bytes"]) & (place < share)).select("label", "unit", "twin").toArrow().sort_by("twin")
    if not taken.num_rows:
        return {}
    x = rows_of(taken.column("unit"))
    labels = np.unique(np.array(taken.column("label").to_pylist(), dtype=object).astype(str), return_inverse=True)[1]
    best, least = None, np.inf
    k = 1
    while k * k <= len(x) and k * sizes["bytes"] <= CENTRE_BYTES:
        cells = Cells(kmeans(x, k), limit)
        cost = cells.work(x, labels, 1 / share)
        if cost < least:
            best, least = cells, cost
        k *= 4
    return {sizes["bytes"]: best}


def with_widest(points: DataFrame, cells: dict[int, Cells]) -> dict[int, Cells]:
    """The cells with the widest angle of all points in them: a number per cell comes to the driver."""
    for size, c in cells.items():
        def run(batches: Iterator[pa.RecordBatch], c: Cells = c) -> Iterator[pa.RecordBatch]:
            widest = np.ones(len(c.centres))
            for batch in batches:
                home, near = c.home(rows_of(batch.column("unit")))
                np.minimum.at(widest, home, near[np.arange(len(near)), home])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(widest))), pa.array(widest)], names=["cell", "widest"])

        found = points.filter(F.octet_length("unit") == size).select("unit").mapInArrow(
            run, "cell bigint, widest double").groupBy("cell").agg(F.min("widest").alias("widest"))
        for r in found.collect():
            c.widest[r["cell"]] = r["widest"]
    return cells


def placed(points: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """A row for each cell a point belongs to or is a guest of: `node`, `label`, `bytes`, `cell`, `own`, `copies`, `unit`."""
    kinds = dict(points.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column("unit")).to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                for start in range(0, len(at), BLOCK):
                    part = batch.take(pa.array(at[start : start + BLOCK]))
                    n = part.num_rows
                    if size in cells:
                        home, near = cells[size].home(rows_of(part.column("unit")))
                        row, cell = cells[size].guests(home, near)
                    else:
                        home, row, cell = np.zeros(n, int), np.zeros(0, int), np.zeros(0, int)
                    out = part.take(pa.array(np.concatenate([np.arange(n), row])))
                    yield pa.RecordBatch.from_arrays([
                        out.column("node"), out.column("label"), pa.array(np.full(out.num_rows, size), pa.int32()),
                        pa.array(np.concatenate([home, cell])), pa.array(np.arange(out.num_rows) < n),
                        out.column("copies"), out.column("unit")],
                        names=["node", "label", "bytes", "cell", "own", "copies", "unit"])

    return points.select("node", "label", "copies", "unit").mapInArrow(
        run, f"node bigint, label {kinds['label']}, bytes int, cell bigint, own boolean, copies bigint, unit binary")


def linked(a: np.ndarray, b: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all products of `limit` or more."""
    products = a @ b.T
    i, j = np.nonzero(products >= limit - DOUBT)
    unsure = np.flatnonzero(products[i, j] < limit + DOUBT)
    wrong = unsure[(a[i[unsure]] * b[j[unsure]]).sum(axis=1) < limit]
    return np.delete(i, wrong), np.delete(j, wrong)


def joined(smallest: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Let the pairs (i, j) be connected: `smallest` is the least member of each one's component, in place."""
    while True:
        a, b = smallest[i], smallest[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(smallest, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = smallest[smallest]
            if (up == smallest).all():
                break
            smallest[:] = up


def compared(limit: float):
    """For a group of rows of one cell: the linked vectors of each node and the least node it is connected with."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        low, high = key[-2].as_py(), key[-1].as_py()
        own, stripe = group.column("own").to_numpy(), group.column("stripe").to_numpy()
        # own rows of the lower stripe, its guests, the same of the upper stripe
        order = np.lexsort((~own, stripe != low))
        group = group.take(pa.array(order))
        own, stripe = own[order], stripe[order]
        node, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
        x = rows_of(group.column("unit"))
        first = int((stripe == low).sum())
        own_low, own_high = int(own[:first].sum()), int(own[first:].sum())
        # pairs to compare: own rows with all rows behind them, and guests of one side with the other's own rows
        if low == high:
            pairs = [((0, own_low), (0, first))]
        else:
            pairs = [((0, own_low), (first, len(x))), ((own_low, first), (first, first + own_high))]
        count = np.zeros(len(x), dtype=np.int64)
        smallest = np.arange(len(x))
        for (a, b), (c, d) in pairs:
            for at in range(a, b, BLOCK):
                upto = min(at + BLOCK, b)
                for to in range(max(c, at) if low == high else c, d, BLOCK):
                    i, j = linked(x[at:upto], x[to : min(to + BLOCK, d)], limit)
                    i, j = i + at, j + to
                    if low == high:
                        behind = i < j
                        i, j = i[behind], j[behind]
                    np.add.at(count, i, copies[j])
                    np.add.at(count, j, copies[i])
                    joined(smallest, i, j)
        met = np.flatnonzero(count)
        # the least node of a component is that of the least id, not of the least place
        root = np.full(len(x), np.iinfo(np.int64).max)
        np.minimum.at(root, smallest, node)
        return pa.table({"node": node[met], "linked": count[met], "root": root[smallest[met]]})

    return run


def links(points: DataFrame, limit: float = LIMIT, stripe: int = STRIPE, sample: int = SAMPLE) -> DataFrame:
    """`node`, `linked` (vectors linked with it) and `root` (a node it is connected with) for every cell a node has links in."""
    cells = with_widest(points, fit_cells(points, limit, sample))
    places = written(placed(points, cells), "embedding-places")
    group = ["label", "bytes", "cell"]
    # the stripes of a group follow from its size
    sizes = places.groupBy(*group).agg(F.count("*").alias("rows")).withColumn("stripes", F.ceil(F.col("rows") / stripe).cast("int"))
    striped = attach(places, sizes, group, "rows").withColumn("stripe", F.pmod(F.xxhash64("node"), "stripes").cast("int"))
    dealt = striped.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("stripes") - 1))).select(
        *group, "node", "own", "copies", "unit", "stripe", F.least("stripe", "other").alias("low"), F.greatest("stripe", "other").alias("high"))
    return dealt.groupBy(*group, "low", "high").applyInArrow(compared(limit), "node bigint, linked bigint, root bigint")


def group(vectors: DataFrame, limit: float = LIMIT, stripe: int = STRIPE, sample: int = SAMPLE) -> DataFrame:
    """One row per vector: `vec_id`, `n_links`, `component_id` and `kept`, whether it represents its group."""
    rows = written(units(vectors), "embedding-units")
    valid = rows.filter("unit is not null")
    points = written(valid.groupBy("label", "twin").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("unit").alias("unit")).withColumn(
        "node", F.monotonically_increasing_id()), "embedding-points")
    found = written(links(points, limit, stripe, sample), "embedding-links")
    stars = components(found.filter("node != root").select(F.col("root").alias("a"), F.col("node").alias("b")))
    counts = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    named = points.drop("unit").join(counts, "node", "left").join(stars, "node", "left").withColumns(
        {"root": F.coalesce("root", "node"), "n_links": F.col("copies") - 1 + F.coalesce("linked", F.lit(0))})
    named = written(named, "embedding-roots")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
    ready = attach(named, smallest, ["root"], "members").select("label", "twin", "copies", "n_links", "component_id")
    done = attach(valid.select("vec_id", "label", "twin"), ready, ["label", "twin"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("unit is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def keep_one(vectors: DataFrame, limit: float = LIMIT) -> DataFrame:
    """The vectors that represent their group, and those that link with nothing."""
    return group(vectors, limit).filter("kept").select("vec_id")
