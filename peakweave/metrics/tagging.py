"""Sequence labelling: entity spans from chunk tags, and flat token reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakweave.functions.arrays import let
from peakweave.functions.numeric import ratio
from peakweave.metrics.classification import accuracy, class_counts, class_scores
from peakweave.metrics.core import evaluate
from peakweave.operators.joins import join_groups


def _parts(tag: Column, suffix: bool) -> tuple[Column, Column]:
    """Chunk mark (B, I, …) and entity type of one tag."""
    if suffix:  # PER-B
        mark = F.substring(tag, -1, 1)
        kind = F.when(F.instr(tag, "-") > 0, F.regexp_replace(tag, "-[^-]*$", ""))
    else:  # B-PER
        mark = F.substring(tag, 1, 1)
        kind = F.when(F.instr(tag, "-") > 0, F.regexp_replace(tag, "^[^-]*-", ""))
    kind = F.coalesce(kind, F.lit("_"))
    return mark, F.when(kind == "", "_").otherwise(kind)


def entity_spans(tags: str | Column, suffix: bool = False, scheme: str | None = None) -> Column:
    """Entities of one tag sequence as ARRAY<STRUCT<type, start, end>>, computed inside the row.

    Lenient by default: a chunk starts at B or S, or at any other mark after O or after
    another type; it ends before O, before B or S, after E or S, or where the type
    changes. Starts and ends come in pairs, so zipping the two lists gives the spans.
    With a scheme only well-formed entities count (see `strict_spans`).
    """
    tags = F.col(tags) if isinstance(tags, str) else tags
    if scheme is not None:
        return strict_spans(tags, scheme, suffix)
    n = F.size(tags)
    outside = F.struct(F.lit("O").alias("m"), F.lit("_").alias("t"))

    def parse(t):
        mark, kind = _parts(t, suffix)
        return F.struct(mark.alias("m"), kind.alias("t"))

    # every position next to its left neighbour; one O is put on both sides
    padded = F.concat(F.array(outside), F.transform(tags, parse), F.array(outside))
    steps = let(padded, lambda p: F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(
        i.alias("i"), F.get(p, i).alias("a"), F.get(p, i + 1).alias("b"))))

    def starts(s):
        a, b = s["a"], s["b"]
        return (b["m"].isin("B", "S") | (a["m"].isin("E", "S", "O") & b["m"].isin("E", "I"))
                | (~b["m"].isin("O", ".") & (a["t"] != b["t"])))

    def ends(s):
        a, b = s["a"], s["b"]
        return (a["m"].isin("E", "S") | (a["m"].isin("B", "I") & b["m"].isin("B", "S", "O"))
                | (~a["m"].isin("O", ".") & (a["t"] != b["t"])))

    def spans(s):
        begin = F.transform(F.filter(s, starts), lambda x: F.struct(x["b"]["t"].alias("type"), x["i"].alias("start")))
        end = F.transform(F.filter(s, ends), lambda x: x["i"] - 1)
        return F.zip_with(begin, end, lambda x, y: F.struct(
            x["type"].alias("type"), x["start"].alias("start"), y.alias("end")))

    found = let(steps, spans)
    return F.when(n > 0, found).otherwise(F.slice(found, 1, 0))


# The tagging schemes known by name.
SCHEMES = ("IOB1", "IOB2", "IOE1", "IOE2", "IOBES", "BILOU")


def strict_spans(tags: Column, scheme: str, suffix: bool = False) -> Column:
    """Well-formed entities only, e.g. for IOB2 one B and the I of the same type that follow it."""
    if scheme not in SCHEMES:
        raise ValueError(f"scheme must be one of {SCHEMES}")
    n = F.size(tags)
    parts = F.struct(F.transform(tags, lambda t: _parts(t, suffix)[0]).alias("m"),
                     F.transform(tags, lambda t: _parts(t, suffix)[1]).alias("t"))

    def spans(p):
        places = F.sequence(F.lit(0), n - 1)

        def linked(i, j):
            return F.coalesce(F.get(p["t"], i) == F.get(p["t"], j), F.lit(False))

        def mark(i):
            return F.coalesce(F.get(p["m"], i), F.lit("O"))

        def opens(i):
            follows = linked(i, i - 1)
            if scheme == "IOB2":
                return mark(i) == "B"
            if scheme == "IOB1":
                inside = mark(i - 1).isin("I", "B") & follows
                return ((mark(i) == "B") & inside) | ((mark(i) == "I") & ~inside)
            if scheme in ("IOE2", "IOE1"):
                return mark(i).isin("I", "E") & ~((mark(i - 1) == "I") & follows)
            return mark(i).isin("B", "S", "U")

        def goes_on(i):
            """Position i continues into i+1."""
            if scheme in ("IOB2", "IOB1"):
                return mark(i).isin("B", "I") & (mark(i + 1) == "I") & linked(i, i + 1)
            if scheme in ("IOE2", "IOE1"):
                return (mark(i) == "I") & mark(i + 1).isin("I", "E") & linked(i, i + 1)
            return mark(i).isin("B", "I") & mark(i + 1).isin("I", "E", "L") & linked(i, i + 1)

        def complete(s):
            if scheme == "IOE2":
                return mark(s["end"]) == "E"
            if scheme in ("IOBES", "BILOU"):
                single = mark(s["start"]).isin("S", "U")
                return F.when(single, s["start"] == s["end"]).otherwise(mark(s["end"]).isin("E", "L"))
            return F.lit(True)

        def from_stops(stops):
            # an entity ends at the first stop at or after its start
            return F.transform(F.filter(places, opens), lambda i: F.struct(
                F.get(p["t"], i).alias("type"), i.alias("start"),
                F.array_min(F.filter(stops, lambda j: j >= i)).alias("end")))

        return F.filter(let(F.filter(places, lambda i: ~goes_on(i)), from_stops), complete)

    found = let(parts, spans)
    return F.when(n > 0, found).otherwise(F.slice(found, 1, 0))


def entity_counts(df: DataFrame, suffix: bool = False, scheme: str | None = None, weight: str | None = None,
                  by: Sequence[str] = ()) -> DataFrame:
    """Per type: tp, pred, true over all sequences (`prediction` and `reference` are ARRAY<STRING>)."""
    w = F.col(weight) if weight else F.lit(1.0)
    spans = df.select(*by, w.cast("double").alias("w"), entity_spans("prediction", suffix, scheme).alias("p"),
                      entity_spans("reference", suffix, scheme).alias("r"))
    spans = spans.withColumn("both", F.array_intersect("p", "r"))

    def tagged(column, name):
        return F.transform(column, lambda s: F.struct(s["type"].alias("type"), F.lit(name).alias("side")))

    rows = spans.select(*by, "w", F.explode(F.concat(tagged("p", "pred"), tagged("r", "true"), tagged("both", "tp"))).alias("s"))
    return rows.groupBy(*by, F.col("s.type").alias("type")).agg(*[
        F.sum(F.when(F.col("s.side") == side, F.col("w")).otherwise(0.0)).alias(side) for side in ("tp", "pred", "true")])


def seqeval(df: DataFrame, suffix: bool = False, scheme: str | None = None, mode: str | None = None,
            weight: str | None = None, zero_division: float = 0.0, by: Sequence[str] = ()) -> DataFrame:
    """One row per entity type plus `overall` (micro): precision, recall, f1, number; overall has the tag accuracy.

    A scheme takes effect with mode='strict', as well-formedness is a strict-mode notion.
    """
    counts = entity_counts(df, suffix, scheme if mode == "strict" else None, weight, by)
    zipped = F.arrays_zip("prediction", "reference")
    right = F.size(F.filter(zipped, lambda z: z["prediction"] == z["reference"]))
    correct = df.groupBy(*by).agg(ratio(F.sum(right).cast("double"), F.sum(F.size(zipped)), None).alias("accuracy"))
    sums = counts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("tp", "pred", "true")])
    total = join_groups(correct, sums, by, "left").select(  # a group without entities has its overall row too
        *by, F.lit("overall").alias("type"), *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("tp", "pred", "true")])
    scores = class_scores(F.col("tp"), F.col("pred"), F.col("true"), zero_division)
    rows = counts.unionByName(total).select(*by, "type", *[c.alias(n) for n, c in scores.items()],
                                            F.col("true").cast("long").alias("number"))
    return join_groups(rows, correct, by).withColumn(
        "accuracy", F.when(F.col("type") == "overall", F.col("accuracy")))


def poseval(df: DataFrame, zero_division: float = 0.0) -> DataFrame:
    """Flat token report: one row per tag, `macro avg`, `weighted avg` and `accuracy` (in the f1 column)."""
    flat = df.select(F.explode(F.arrays_zip("prediction", "reference")).alias("z")).select("z.prediction", "z.reference")
    counts = class_counts(flat)
    scored = counts.select(F.col("label").cast("string").alias("label"), *[
        c.alias(n) for n, c in class_scores(F.col("tp"), F.col("pred"), F.col("true"), zero_division).items()],
        F.col("true").cast("long").alias("support"))
    names = ("precision", "recall", "f1")
    macro = scored.agg(*[F.avg(n).alias(n) for n in names], F.sum("support").alias("support")).withColumn(
        "label", F.lit("macro avg"))
    weighted = scored.agg(*[ratio(F.sum(F.col(n) * F.col("support")), F.sum("support")).alias(n) for n in names],
                          F.sum("support").alias("support")).withColumn("label", F.lit("weighted avg"))
    acc = evaluate(flat, [accuracy()]).select(
        F.lit("accuracy").alias("label"), *[F.col("accuracy").alias(n) for n in names], F.lit(None).cast("long").alias("support"))
    return scored.unionByName(macro).unionByName(weighted).unionByName(acc)
