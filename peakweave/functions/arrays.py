"""Vector and block expressions: norms, dot products and row-local pooling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """body(value) with `value` evaluated once per row, however often the lambda bodies use it."""
    return F.transform(F.array(value), body)[0]


def array_sum(values: str | Column) -> Column:
    return F.aggregate(_col(values), F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def dot(a: str | Column, b: str | Column) -> Column:
    return array_sum(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")))


def l2_norm(v: str | Column) -> Column:
    return F.sqrt(array_sum(F.transform(_col(v), lambda x: x.cast("double") * x.cast("double"))))


def l2_normalize(v: str | Column, eps: float = 1e-12) -> Column:
    v = _col(v)
    return let(F.greatest(l2_norm(v), F.lit(eps)), lambda norm: F.transform(v, lambda x: x.cast("double") / norm))


def center(v: str | Column, mean: str | Column) -> Column:
    return F.zip_with(_col(v), _col(mean), lambda x, m: x.cast("double") - m)


def _mean_rows(block: Column) -> Column:
    n = F.size(block)
    total = F.aggregate(
        F.slice(block, F.lit(2), F.greatest(n - 1, F.lit(0))),
        F.transform(block[0], lambda x: x.cast("double")),
        lambda acc, row: F.zip_with(acc, row, lambda a, b: a + b.cast("double")),
    )
    return F.transform(total, lambda x: x / n)


def adaptive_pool(block: str | Column, rows: int) -> Column:
    """Average an L×d block to `rows` rows; row i covers floor(i·L/rows) … ceil((i+1)·L/rows)-1."""
    block = _col(block)
    size = F.size(block)

    def one(i):
        start = F.floor(i * size / rows).cast("int")
        end = F.ceil((i + 1) * size / rows).cast("int")
        return _mean_rows(F.slice(block, start + 1, end - start))

    return F.when(size > 0, F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), one))


def _running_sums(block: Column, keep: int) -> Column:
    """The last `keep` running row sums of a block.

    The rows before them are folded into one, so only `keep` rows are ever built.
    """
    doubles = F.transform(block, lambda r: F.transform(r, lambda x: x.cast("double")))
    early = F.greatest(F.size(doubles) - keep, F.lit(0))
    zero = F.transform(doubles[0], lambda x: F.lit(0.0))
    add = lambda acc, row: F.zip_with(acc, row, lambda a, b: a + b)
    base = F.aggregate(F.slice(doubles, F.lit(1), early), zero, add)
    sums = F.aggregate(
        F.slice(doubles, early + 1, F.size(doubles) - early),
        F.array(base),
        lambda acc, row: F.concat(acc, F.array(add(F.element_at(acc, -1), row))),
    )
    return F.slice(sums, F.lit(2), F.size(doubles) - early)


def _last(block: Column, k: int) -> Column:
    size = F.size(block)
    return F.slice(block, F.greatest(size - k, F.lit(0)) + 1, F.least(size, F.lit(k)))


def _columnwise(block: Column, fn) -> Column:
    """Fold the rows of a block into one row."""
    doubles = F.transform(block, lambda r: F.transform(r, lambda x: x.cast("double")))
    return F.aggregate(F.slice(doubles, F.lit(2), F.greatest(F.size(doubles) - 1, F.lit(0))), doubles[0],
                       lambda acc, row: F.zip_with(acc, row, fn))


def pool(block: str | Column, mode: str, rows: int = 1) -> Column:
    """Pool a sequence of row vectors.

    first / last: that many rows; mean: the last `rows` cumulative means; adaptive;
    max / sum over all rows (one row).
    """
    block = _col(block)
    if mode == "first":
        return F.slice(block, 1, rows)
    if mode == "last":
        return _last(block, rows)
    if mode == "mean":
        early = F.greatest(F.size(block) - rows, F.lit(0))
        return F.transform(_running_sums(block, rows),
                           lambda row, i: F.transform(row, lambda x: x / (early + i + 1)))
    if mode == "adaptive":
        return adaptive_pool(block, rows)
    if mode == "max":
        return F.array(_columnwise(block, lambda a, b: F.greatest(a, b)))
    if mode == "sum":
        return F.array(_columnwise(block, lambda a, b: a + b))
    raise NotImplementedError("mode must be one of first, last, mean, adaptive, max, sum")


def sequence_pool(block: str | Column, mode: str, rows: int | None = None, length: str | Column | None = None) -> Column:
    """Decoder pooling: last, first, pool (cumulative mean), sum (cumulative sum) or ragged.

    With `length` the block is first cut to that many rows; `ragged` needs it.
    """
    block = _col(block)
    if length is not None:
        block = F.slice(block, F.lit(1), _col(length))
    if mode == "ragged":
        if length is None:
            raise ValueError("ragged pooling needs a length")
        return block
    keep = 1 if rows is None else rows
    if mode == "pool":
        return pool(block, "mean", keep)
    if mode == "sum":
        return _running_sums(block, keep)
    if mode in ("first", "last"):
        return pool(block, mode, keep)
    raise NotImplementedError("mode must be one of last, first, pool, sum, ragged")


def masked_mean(block: str | Column, length: str | Column) -> Column:
    """Mean of the first `length` rows (the non-padding positions)."""
    return _mean_rows(F.slice(_col(block), F.lit(1), _col(length)))
