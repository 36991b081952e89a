"""The metric protocol, its registry, and one-scan evaluation of several metrics.

A metric is either *fused* — it lists aggregate columns (sufficient statistics) and
the expressions that finish them — or *computed*, a function of the whole DataFrame.
All fused metrics of one call share a single scan and a single two-phase aggregation.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakweave.operators.joins import join_groups


@dataclass(frozen=True)
class Metric:
    """`partials` and `finish` for fused metrics, `compute` for the others.

    Of the computed ones, those with the same `shared` pass, a function and its options, are finished
    from one run of it by their `columns`; `more` are options of the pass that a metric needs besides.
    """

    name: str
    partials: dict[str, Column] = field(default_factory=dict)
    finish: dict[str, Column] = field(default_factory=dict)
    compute: Callable[[DataFrame, Sequence[str]], DataFrame] | None = None
    shared: tuple | None = None
    columns: tuple[Column, ...] = ()
    more: tuple = ()


_FACTORIES: dict[str, Callable[..., Metric]] = {}
_MODULES = ("regression", "classification", "ranking", "textgen", "named")


def register(name: str):
    """Decorator: make a factory available as `get(name, **options)`."""

    def add(factory):
        _FACTORIES[name] = factory
        return factory

    return add


def get(name: str, **options) -> Metric:
    """A metric by name; a path such as `metrics/mse` means its last part."""
    for module in _MODULES:
        importlib.import_module(f"peakweave.metrics.{module}")
    key = name.rstrip("/").rsplit("/", 1)[-1]
    if key not in _FACTORIES:
        raise KeyError(f"unknown metric {name!r}; known: {sorted(_FACTORIES)}")
    return _FACTORIES[key](**options)


def names() -> list[str]:
    for module in _MODULES:
        importlib.import_module(f"peakweave.metrics.{module}")
    return sorted(_FACTORIES)


def weight_column(weight: str | None) -> Column:
    return F.col(weight).cast("double") if weight else F.lit(1.0)


def evaluate(df: DataFrame, metrics: Sequence[Metric | str], group_by: Sequence[str] = (),
             cast_float32: bool = False) -> DataFrame:
    """All metrics in one row (per group).

    `cast_float32` rounds scalar predictions and references to float32 first. A column that
    two computed metrics give has the later metric's name in front in its second place.
    """
    metrics = [get(m) if isinstance(m, str) else m for m in metrics]
    keys = list(group_by)
    if cast_float32:
        df = df.withColumns({c: F.col(c).cast("float").cast("double") for c in ("prediction", "reference")
                             if dict(df.dtypes)[c] in ("double", "float")})
    fused = [m for m in metrics if m.compute is None]
    result = None
    if fused:
        partials = [c.alias(f"__{m.name}_{k}") for m in fused for k, c in m.partials.items()]
        stats = df.groupBy(*keys).agg(*partials)
        finished = []
        for m in fused:
            own = {k: F.col(f"__{m.name}_{k}") for k in m.partials}
            finished += [expr(own).alias(k) for k, expr in m.finish.items()]
        result = stats.select(*keys, *finished)
    passes: dict[tuple, list[Metric]] = {}
    for m in metrics:
        if m.shared:
            passes.setdefault(m.shared, []).append(m)
    taken = set(result.columns if result is not None else keys)
    for m in metrics:
        if m.compute is None or (m.shared and m is not passes[m.shared][0]):
            continue
        if m.shared:
            part = _finished(m.shared, passes[m.shared], df, keys, taken)
        else:
            part = m.compute(df, keys)
            part = part.withColumnsRenamed({c: f"{m.name}_{c}" for c in part.columns if c not in keys and c in taken})
        taken |= set(part.columns)
        result = part if result is None else join_groups(result, part, keys, "full")
    return result


def _finished(shared: tuple, members: Sequence[Metric], df: DataFrame, keys: list[str], taken: set[str]) -> DataFrame:
    """The columns of all metrics of one pass."""
    run, options = shared
    sums = run(df, by=keys, **dict(options), **dict(x for m in members for x in m.more))
    columns, taken = [], set(taken)
    for m in members:
        names = sums.select(*m.columns).columns
        columns += [c.alias(f"{m.name}_{n}" if n in taken else n) for c, n in zip(m.columns, names)]
        taken |= set(names)
    return sums.select(*keys, *columns)
