"""Positions, running sums, ranks, exact splits and shards without a single-task sort.

Spark rows have no position, so everything here takes an explicit order. A total
order (ties broken by further columns) makes the result deterministic.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peakweave.operators.checks import require
from peakweave.session import materialize, store

_PID, _SEQ, _ROW = "__pid", "__seq", "__row"


def _columns(keys: Sequence[str | Column]) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def ordered_scan(
    df: DataFrame,
    order_by: Sequence[str | Column],
    partition_by: Sequence[str] = (),
    index: str | None = None,
    sums: Mapping[str, str | Column] | None = None,
    maxima: Mapping[str, str | Column] | None = None,
    once: bool = False,
) -> DataFrame:
    """Add a 0-based `index` and inclusive running `sums` / `maxima` per group.

    The rows are range-sorted on (partition_by, order_by), so a group of any size
    is spread over as many partitions as it needs. Each partition then computes its
    own running values, and the totals of the earlier partitions of the same group
    are added. A group reaches into a partition from an earlier one at most once
    per partition, so that carry table has fewer rows than there are partitions and
    is safe to broadcast.

    A range sort looks at its input twice, once for the bounds. With `once` the input is
    computed a single time and written with a number per row; only the groups, the keys, the
    summed values and that number are sorted, and the rows find their results by the number.
    The number also comes last in the order, so that copies of one row are spread too;
    without it rows equal in all sort keys stay in one partition. Where the keys are all the
    columns there are and only places are wanted, the sorted rows are kept, and none is looked up.
    """
    sums = dict(sums or {})
    maxima = dict(maxima or {})
    groups = list(partition_by)
    order = [*[F.col(g) for g in groups], *_columns(order_by)]
    if not once:
        return _running(materialize(df.orderBy(*order)), groups, index, sums, maxima)
    stored = store(df.withColumn(_ROW, F.monotonically_increasing_id()), "ordered-rows")
    if index and not (sums or maxima or groups) and set(df.columns) <= {k for k in order_by if isinstance(k, str)}:
        # places are columns, so the sorted rows may be stored and read in any order
        tagged = stored.orderBy(*order, _ROW).drop(_ROW, index).withColumns({_PID: F.spark_partition_id(), _SEQ: F.monotonically_increasing_id()})
        return _with_offsets(store(tagged, "sorted-rows"), index)
    names = [*([index] if index else []), *sums, *maxima]
    values = {n: (F.col(c) if isinstance(c, str) else c) for n, c in {**sums, **maxima}.items()}
    narrow = stored.select("*", *[c.alias(f"__in_{n}") for n, c in values.items()]).orderBy(*order, _ROW).select(
        *groups, *[f"__in_{n}" for n in values], _ROW)
    placed = _running(materialize(narrow), groups, index, {n: f"__in_{n}" for n in sums}, {n: f"__in_{n}" for n in maxima})
    return stored.drop(*names).join(placed.select(_ROW, *names), _ROW).select(*[c for c in df.columns if c not in names], *names)


def _running(placed: DataFrame, groups: list[str], index: str | None, sums: Mapping, maxima: Mapping) -> DataFrame:
    """The running values over rows that stand in order in their partitions."""
    tagged = placed.withColumns({_PID: F.spark_partition_id(), _SEQ: F.monotonically_increasing_id()})
    if not sums and not maxima and not groups:
        return _with_offsets(tagged, index)

    tagged = tagged.withColumns(
        {f"__v_{n}": (F.col(c) if isinstance(c, str) else c) for n, c in {**sums, **maxima}.items()}
    )
    totals = tagged.groupBy(_PID, *groups).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(f"__v_{n}").alias(f"__t_{n}") for n in sums],
        *[F.max(f"__v_{n}").alias(f"__t_{n}") for n in maxima],
    )
    earlier = Window.partitionBy(*groups).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        _PID,
        *groups,
        F.sum("__n").over(earlier).alias("__c_n"),
        *[F.sum(f"__t_{n}").over(earlier).alias(f"__c_{n}") for n in sums],
        *[F.max(f"__t_{n}").over(earlier).alias(f"__c_{n}") for n in maxima],
    ).filter(F.col("__c_n").isNotNull())

    local = Window.partitionBy(_PID, *groups).orderBy(_SEQ).rowsBetween(Window.unboundedPreceding, 0)
    running = {"__rn": F.row_number().over(Window.partitionBy(_PID, *groups).orderBy(_SEQ))}
    running |= {n: F.sum(f"__v_{n}").over(local) for n in sums}
    running |= {n: F.max(f"__v_{n}").over(local) for n in maxima}
    scanned = tagged.withColumns(running)

    keyed = carry.select(*[F.col(c).alias(f"__k_{c}") for c in (_PID, *groups)],
                         *[c for c in carry.columns if c.startswith("__c_")])
    match = F.col(_PID) == F.col(f"__k_{_PID}")
    for g in groups:
        match = match & F.col(g).eqNullSafe(F.col(f"__k_{g}"))
    joined = scanned.join(F.broadcast(keyed), match, "left")
    out = {}
    if index:
        out[index] = F.coalesce("__c_n", F.lit(0)) + F.col("__rn") - 1
    for n in sums:
        out[n] = F.coalesce(F.col(n) + F.col(f"__c_{n}"), F.col(n), F.col(f"__c_{n}"))
    for n in maxima:
        out[n] = F.greatest(n, f"__c_{n}")
    return joined.withColumns(out).select(*placed.columns, *out)


def _with_offsets(tagged: DataFrame, index: str) -> DataFrame:
    """Global positions from the per-partition row counts: no second shuffle of the rows."""
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumnRenamed(_PID, "__p").select(
        "__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off")
    )
    base = [c for c in tagged.columns if c not in (_PID, _SEQ)]
    local = F.expr(f"{_SEQ} & 8589934591")  # the low 33 bits count the rows of the partition
    return tagged.join(F.broadcast(offsets), F.col(_PID) == F.col("__p")).select(
        *base, (F.col("__off") + local).alias(index)
    )


def with_record_id(df: DataFrame, order_by: Sequence[str | Column], column: str = "record_id",
                   start: int = 0) -> DataFrame:
    """Contiguous ids `start`, `start`+1, … in the given order."""
    out = ordered_scan(df, order_by, index=column, once=True)
    return out.withColumn(column, F.col(column) + F.lit(start)) if start else out


def with_file_order_id(scan: DataFrame, column: str = "record_id", start: int = 0) -> DataFrame:
    """Contiguous ids in the order the rows stand in their files, files by path; `scan` reads files directly.

    Rows stay where they are read: each split counts its rows, and a row's id is its place in
    its split plus the rows of all earlier splits, a table with one row per split. Should the
    files be split another way when they are read again, the job fails.
    """
    place = {"__file": F.col("_metadata.file_path"), "__block": F.col("_metadata.file_block_start")}
    tagged = scan.select("*", *[c.alias(n) for n, c in place.items()], F.monotonically_increasing_id().alias("__m"))
    counts = tagged.groupBy(*place).agg(F.count(F.lit(1)).alias("__n"), F.min("__m").alias("__first"))
    before = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*place, (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + start).alias("__shift"))
    found = require(tagged.join(offsets, [*place], "left"), F.col("__shift").isNotNull(), "the files were split another way")
    return found.withColumn(column, F.col("__m") + F.col("__shift")).drop(*place, "__m", "__shift")


def with_record_id_by_split(df: DataFrame, order_by: Sequence[str | Column], split: str = "split",
                            splits: Sequence[str] = ("train", "test"), column: str = "record_id") -> DataFrame:
    """Ids run through the splits in turn: the second starts where the first ends. A row of another split fails the job."""
    rank = F.array_position(F.array(*[F.lit(s) for s in splits]), F.col(split))
    known = require(df, F.col(split).isin(*splits), "a row belongs to none of the splits")
    return ordered_scan(known, [rank, *order_by], index=column, once=True)


def zip_by(left: DataFrame, right: DataFrame, left_order: Sequence, right_order: Sequence) -> DataFrame:
    """Pair two frames by position in their own orders; unequal lengths are an error."""
    a = ordered_scan(left, left_order, index="__i", once=True)
    b = ordered_scan(right, right_order, index="__j", once=True)
    joined = a.join(b, F.col("__i") == F.col("__j"), "full")
    both = F.col("__i").isNotNull() & F.col("__j").isNotNull()
    checked = F.when(both, F.lit(True)).otherwise(
        F.raise_error(F.lit("the two inputs have different lengths")).cast("boolean"))
    return joined.filter(checked).drop("__i", "__j")


def average_ranks(df: DataFrame, value: str, rank: str = "rank", partition_by: Sequence[str] = (),
                  weight: str | None = None) -> DataFrame:
    """One row per distinct value: its count `n` and average rank (ties share the mean position)."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    distinct = df.groupBy(*partition_by, value).agg(n.alias("n"))
    scanned = ordered_scan(distinct, [value], partition_by, sums={"__upto": "n"})
    return scanned.withColumn(rank, F.col("__upto") - F.col("n") + (F.col("n") + 1) / 2).drop("__upto")


def shuffle_key(key: str | Column, seed: int) -> Column:
    """A seeded pseudo-random sort key that any SQL engine can reproduce."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def exact_split(df: DataFrame, key: str, ratio: float, seed: int, column: str = "split",
                names: tuple[str, str] = ("train", "validation")) -> DataFrame:
    """Tag exactly ceil(ratio·n) rows as validation: the first in the seeded shuffle order.

    `key` is unique per row. The cut is found from counts per hash prefix and then
    inside the one prefix that contains it, so the rows themselves are never
    shuffled: the result is a comparison with a literal, evaluated in the scan.
    """
    hashed = df.select(F.col(key).alias("k"), shuffle_key(key, seed).alias("h"))
    prefix = F.substring("h", 1, 4)
    # 65536 prefixes at most, counted in one scan
    counts = sorted(hashed.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    total = sum(row["n"] for row in counts)
    wanted = min(math.ceil(ratio * total), total)
    test, train = F.lit(names[1]), F.lit(names[0])
    if wanted <= 0:
        return df.withColumn(column, train)
    nth, at = wanted, counts[0]
    for at in counts:
        if nth <= at["n"]:
            break
        nth -= at["n"]
    # `nth` rows of one prefix: 1/65536 of the keys, spread evenly by the hash
    inside = ordered_scan(hashed.filter(prefix == at["p"]), ["h", "k"], index="i")
    cut = inside.filter(F.col("i") == nth - 1).first()
    h = shuffle_key(key, seed)
    is_test = (h < cut["h"]) | ((h == cut["h"]) & (F.col(key) <= F.lit(cut["k"])))
    return df.withColumn(column, F.when(is_test, test).otherwise(train))


def shuffle_rows(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Seeded shuffle: a distributed sort by the hash of the unique key."""
    return df.orderBy(shuffle_key(key, seed), key)


def with_shard(df: DataFrame, num_shards: int, index: str = "record_id", mode: str = "strided",
               total: int | None = None, column: str = "shard") -> DataFrame:
    """Shard of a contiguous 0-based index, with the row's position inside its shard in `row_index`.

    `strided` takes every n-th row; `contiguous` cuts equal ranges, the first
    `total % n` of them one row longer. Both are arithmetic on the index: no shuffle.
    """
    i = F.col(index)
    if mode == "strided":
        shard = F.pmod(i, F.lit(num_shards))
        position = F.floor(i / num_shards)
    elif mode == "contiguous":
        if total is None:
            total = (df.agg(F.max(index)).first()[0] or 0) + 1
        size, longer = divmod(total, num_shards)
        edge = longer * (size + 1)
        shard = F.when(i < edge, F.floor(i / (size + 1))).otherwise(longer + F.floor((i - edge) / max(size, 1)))
        position = F.when(i < edge, F.pmod(i, F.lit(size + 1))).otherwise(F.pmod(i - edge, F.lit(max(size, 1))))
    else:
        raise ValueError(f"mode must be 'strided' or 'contiguous', not {mode!r}")
    return df.withColumns({column: shard.cast("int"), "row_index": position.cast("long")})


def head(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The first n rows in order (a top-n, not a full sort)."""
    return df.orderBy(*_columns(order_by)).limit(n)


def lag_difference(df: DataFrame, value: str, order_by: Sequence[str | Column], period: int = 1,
                   partition_by: Sequence[str] = (), column: str = "difference") -> DataFrame:
    """value[t] - value[t-period] inside each group; the first `period` rows of a group have none.

    Rows meet their predecessor by (group, position), which spreads one long series
    over the cluster where a window would hold it in a single task.
    """
    placed = ordered_scan(df, order_by, partition_by, index="__i", once=True).withColumn("__i", F.col("__i").cast("long"))
    past = placed.select(*[F.col(g).alias(f"__g_{g}") for g in partition_by],
                         (F.col("__i") + period).alias("__at"), F.col(value).alias("__past"))
    match = F.col("__i") == F.col("__at")
    for g in partition_by:
        match = match & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    return placed.join(past, match).select(*df.columns, (F.col(value) - F.col("__past")).alias(column))
