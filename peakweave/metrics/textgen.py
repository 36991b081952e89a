"""Text-generation metrics as corpus aggregates over `prediction` and `references`.

A row is a text, whatever its id: ids may repeat or be null. The n-grams a prediction shares
with its references are counted inside the row, on whole batches of rows, so only the raw
texts are dealt out and only sums per group are shuffled. Where n-grams of all texts are needed
(NIST) `operators.gram_counts` counts them. `by` names columns to score groups by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakweave.functions import text as tx
from peakweave.functions.ngrams import shared_grams
from peakweave.functions.numeric import ratio
from peakweave.metrics.core import Metric, register
from peakweave.operators.gram_counts import reference_gains
from peakweave.operators.joins import join_groups


# --- n-gram core -----------------------------------------------------------------------------

#: What tells one text from another: a hash of the row and a number among rows with that hash.
TEXT = ["__h", "__n"]


def as_references(df: DataFrame) -> DataFrame:
    """Give every row `references`, wrapping a single `reference`."""
    return df if "references" in df.columns else df.withColumn("references", F.array("reference"))


def dealt(df: DataFrame) -> DataFrame:
    """The rows placed by a hash (`__h`) of the whole row, before they are tokenised.

    The number of partitions is fixed: by the size of the raw text it would become too few for the n-grams.
    """
    columns = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn("__h", F.xxhash64(*columns)).repartition(partitions, "__h")


def spread_texts(df: DataFrame) -> DataFrame:
    """Give every row an identity of its own (TEXT) and place it by that, before it is tokenised.

    The identity follows from the whole row, so it is the same whenever the rows are read, and
    rows that share an id are texts of their own. What is counted per text is grouped by it
    and more, so it needs no further shuffle of the texts.
    """
    columns = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    same = Window.partitionBy("__h").orderBy(*columns)
    return dealt(df).withColumn("__n", F.row_number().over(same))


def sided(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, prediction, references); a row without a list of references is no text."""
    return as_references(df).select(*by, "prediction", "references").filter("references is not null")


def size_of(tokens: Column) -> Column:
    """Number of tokens, 0 for a null side."""
    return F.greatest(F.size(tokens), F.lit(0))


def gram_counts(tokens: DataFrame, max_order: int, separator: str = " ", by: Sequence[str] = ()) -> DataFrame:
    """(by, TEXT, order, gram, k, c): how often an n-gram occurs in the prediction (k = -1) and in reference k.

    Order 0 has one row per side, whose count is the side's number of tokens.
    """
    def of_order(column, n):
        return F.transform(tx.ngrams(column, n, separator),
                           lambda g: F.struct(F.lit(n).alias("order"), g.alias("gram"), F.lit(1).alias("w")))

    def grams(column):
        size = F.struct(F.lit(0).alias("order"), F.lit("").alias("gram"), F.greatest(F.size(column), F.lit(0)).alias("w"))
        empty = F.array().cast("array<struct<order:int,gram:string,w:int>>")
        return F.concat(F.array(size), *[F.coalesce(of_order(column, n), empty) for n in range(1, max_order + 1)])

    sides = tokens.select(*by, *TEXT, F.explode(F.concat(
        F.array(F.struct(F.lit(-1).alias("k"), F.col("hyp").alias("t"))),
        F.transform("refs", lambda t, k: F.struct(k.alias("k"), t.alias("t"))))).alias("s"))
    rows = sides.select(*by, *TEXT, F.col("s.k").alias("k"), F.explode(grams(F.col("s.t"))).alias("g")).select(
        *by, *TEXT, "k", "g.order", "g.gram", "g.w")
    return rows.groupBy(*by, *TEXT, "order", "gram", "k").agg(F.sum("w").alias("c"))


def _count_where(cond: Column) -> Column:
    return F.sum(F.when(cond, F.col("c")).otherwise(0))


def _possible(size: Column, n: int) -> Column:
    """The n-grams of so many tokens."""
    return F.greatest(size - (n - 1), F.lit(0))


def corpus_sums(df: DataFrame, key: str, max_order: int = 4, tokenizer: tx.Tokenizer = tx.tokenize_13a,
                by: Sequence[str] = (), min_order: int = 1, best: bool = False) -> DataFrame:
    """One row (per group) of what BLEU, sacreBLEU and GLEU are made of, from one pass over the texts.

    Matches m1… and possible n-grams p1… by order, sys_len, the lengths of the shortest and of the
    closest references (ties: the shorter), the least and the largest number of references. With `best`
    also what GLEU needs, the matches and the larger total of each row's best reference, orders from
    `min_order` on.
    """
    orders = range(1, max_order + 1)
    tokens = dealt(sided(df, by)).select(*by, tokenizer(F.col("prediction")).alias("hyp"), F.transform("references", tokenizer).alias("refs"))
    sizes = F.transform("refs", size_of)
    closest = F.array_min(F.transform(sizes, lambda s: F.struct(F.abs(s - size_of(F.col("hyp"))).alias("gap"), s.alias("s"))))["s"]
    per_text = tokens.select(
        *by, size_of(F.col("hyp")).alias("h"), sizes.alias("sizes"), F.array_min(sizes).alias("short"), closest.alias("close"),
        F.size("refs").alias("n_refs"), shared_grams(F.col("hyp"), F.col("refs"), max_order).alias("shared"))
    per_text = per_text.withColumns({f"m{n}": F.col("shared.most")[n - 1] for n in orders})
    if best:
        used = [n for n in orders if n >= min_order]
        total = lambda size: sum((_possible(size, n) for n in used), F.lit(0))

        def scored(m, k):
            hit, most = sum((m[n - 1] for n in used), F.lit(0)), F.greatest(total(F.col("h")), total(F.get("sizes", k)))
            return F.struct(ratio(hit, most).alias("ratio"), (-k).alias("k"), hit.alias("__tp"), most.alias("__all"))

        # best ratio, then the earliest reference; a row without n-grams on either side has none
        options = F.filter(F.transform("shared.each", scored), lambda x: x["__all"] > 0)
        per_text = per_text.withColumn("best", F.array_max(options))
    d = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("double")
    return per_text.groupBy(*by).agg(
        *[d(f"m{n}").alias(f"m{n}") for n in orders], *[d(_possible(F.col("h"), n)).alias(f"p{n}") for n in orders],
        d("h").alias("sys_len"), d("short").alias("short_len"), d("close").alias("close_len"),
        F.min("n_refs").alias("least_refs"), F.max("n_refs").alias("most_refs"),
        *([d("best.__tp").alias("best_hits"), d("best.__all").alias("best_all")] if best else []))


def bleu_columns(max_order: int = 4, smooth: bool = False) -> list[Column]:
    orders = range(1, max_order + 1)
    m, p = {n: F.col(f"m{n}") for n in orders}, {n: F.col(f"p{n}") for n in orders}
    precisions = [(m[n] + 1) / (p[n] + 1) if smooth else ratio(m[n], p[n]) for n in orders]
    arr = F.array(*precisions)
    logs = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + F.log(x))
    mean = F.when(F.array_min(arr) > 0, F.exp(logs / max_order)).otherwise(0.0)
    rate = ratio(F.col("sys_len"), F.col("short_len"))
    bp = F.when(rate > 1, 1.0).when(rate > 0, F.exp(1 - 1 / rate)).otherwise(0.0)
    return [(mean * bp).alias("bleu"), arr.alias("precisions"), bp.alias("brevity_penalty"), rate.alias("length_ratio"),
            F.col("sys_len").cast("long").alias("translation_length"), F.col("short_len").cast("long").alias("reference_length")]


def bleu(df: DataFrame, key: str, max_order: int = 4, smooth: bool = False,
         tokenizer: tx.Tokenizer = tx.tokenize_13a, by: Sequence[str] = ()) -> DataFrame:
    """bleu, precisions, brevity_penalty, length_ratio, translation_length, reference_length."""
    return corpus_sums(df, key, max_order, tokenizer, by).select(*by, *bleu_columns(max_order, smooth))


def lowered(df: DataFrame) -> DataFrame:
    return as_references(df).withColumns({"prediction": F.lower("prediction"), "references": F.transform("references", F.lower)})


def sacrebleu_columns(smooth_method: str = "exp", smooth_value: float | None = None, use_effective_order: bool = False,
                       max_order: int = 4) -> list[Column]:
    orders = range(1, max_order + 1)
    m, p = {n: F.col(f"m{n}") for n in orders}, {n: F.col(f"p{n}") for n in orders}
    percent, zeros = [], F.lit(0)
    for n in orders:
        empty = m[n] == 0
        zeros = zeros + F.when(empty & (p[n] > 0), 1).otherwise(0)
        if smooth_method == "exp":
            low = 100.0 / (F.pow(F.lit(2.0), zeros) * p[n])
        elif smooth_method == "floor":
            low = 100.0 * (0.1 if smooth_value is None else smooth_value) / p[n]
        else:
            low = F.lit(0.0)
        value = F.when(empty, low).otherwise(100.0 * m[n] / p[n])
        if smooth_method == "add-k" and n > 1:
            k = 1.0 if smooth_value is None else smooth_value
            value = 100.0 * (m[n] + k) / (p[n] + k)
        percent.append(F.when(p[n] > 0, value).otherwise(0.0))
    sys_len, ref_len = F.col("sys_len"), F.col("close_len")
    bp = F.when(sys_len >= ref_len, 1.0).when(sys_len > 0, F.exp(1 - ref_len / sys_len)).otherwise(0.0)
    arr = F.array(*percent)
    used = F.size(F.filter(F.array(*[p[n] for n in orders]), lambda x: x > 0)) if use_effective_order else F.lit(max_order)
    chosen = F.slice(arr, F.lit(1), F.greatest(used, F.lit(1)))
    logs = F.aggregate(chosen, F.lit(0.0), lambda acc, x: acc + F.log(x))
    any_match = F.greatest(*[m[n] for n in orders]) > 0
    score = F.when(any_match & (F.array_min(chosen) > 0), bp * F.exp(logs / used)).otherwise(0.0)
    alike = F.col("least_refs") == F.col("most_refs")
    checked = F.when(F.coalesce(alike, F.lit(True)), score).otherwise(
        F.raise_error(F.lit("all rows need the same number of references")).cast("double"))
    return [checked.alias("score"), F.array(*[m[n].cast("long") for n in orders]).alias("counts"),
            F.array(*[p[n].cast("long") for n in orders]).alias("totals"), arr.alias("precisions"), bp.alias("bp"),
            sys_len.cast("long").alias("sys_len"), ref_len.cast("long").alias("ref_len")]


def sacrebleu(df: DataFrame, key: str, smooth_method: str = "exp", smooth_value: float | None = None,
              lowercase: bool = False, use_effective_order: bool = False,
              tokenizer: tx.Tokenizer = tx.tokenize_13a, max_order: int = 4, by: Sequence[str] = ()) -> DataFrame:
    """score, counts, totals, precisions (percent), bp, sys_len, ref_len.

    All rows (of a group) must have the same number of references.
    """
    sums = corpus_sums(lowered(df) if lowercase else df, key, max_order, tokenizer, by)
    return sums.select(*by, *sacrebleu_columns(smooth_method, smooth_value, use_effective_order, max_order))


def google_bleu_columns() -> list[Column]:
    return [F.coalesce(ratio(F.col("best_hits"), F.col("best_all")), F.lit(0.0)).alias("google_bleu")]


def google_bleu(df: DataFrame, key: str, min_len: int = 1, max_len: int = 4,
                tokenizer: tx.Tokenizer = tx.tokenize_13a, by: Sequence[str] = ()) -> DataFrame:
    """Corpus GLEU: matched over the larger n-gram total, each row against its best reference."""
    return corpus_sums(df, key, max_len, tokenizer, by, min_len, best=True).select(*by, *google_bleu_columns())


def chrf(df: DataFrame, key: str, char_order: int = 6, word_order: int = 0, beta: int = 2, lowercase: bool = False,
         eps_smoothing: bool = False, whitespace: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Corpus chrF (chrF++ with word_order=2), each row against its best reference."""
    lower = F.lower if lowercase else (lambda c: c)

    def chars(c):
        return lower(c) if whitespace else F.regexp_replace(lower(c), tx.SPACES, "")

    def word_tokens(c):
        # a punctuation mark at a word's end, else at its start, is a token of its own
        mark = "[" + "".join("\\" + ch for ch in tx.PUNCTUATION) + "]"
        one = F.lit(1)

        def parts(w):
            last = F.array(F.substring(w, one, F.length(w) - 1), F.substring(w, F.length(w), one))
            first = F.array(F.substring(w, one, one), F.substring(w, F.lit(2), F.length(w) - 1))
            return (F.when(F.length(w) == 1, F.array(w)).when(w.rlike(mark + "$"), last)
                    .when(w.rlike("^" + mark), first).otherwise(F.array(w)))

        return F.flatten(F.transform(tx.words(lower(c)), parts))

    kinds = [("c", chars, char_order, F.length)] + ([("w", word_tokens, word_order, F.size)] if word_order else [])
    # a text without references has no best one
    texts = dealt(sided(df, by).filter("size(references) > 0")).select(*by, *[c for name, tokens, _, _ in kinds for c in (
        tokens(F.col("prediction")).alias(f"{name}_hyp"), F.transform("references", tokens).alias(f"{name}_refs"))])

    def count(size):
        return lambda c: F.greatest(F.coalesce(size(c), F.lit(0)), F.lit(0))

    texts = texts.select(*by, *[c for name, _, order, size in kinds for c in (
        count(size)(F.col(f"{name}_hyp")).alias(f"{name}_h"), F.transform(f"{name}_refs", count(size)).alias(f"{name}_r"),
        shared_grams(F.col(f"{name}_hyp"), F.col(f"{name}_refs"), order, name == "c").alias(f"{name}_shared"))])

    def entries(k):
        """Shared, predicted and reference n-grams against reference k, by order."""
        return F.array(*[F.struct(
            F.get(f"{name}_shared.each", k)[n - 1].cast("double").alias("m"),
            # without reference n-grams of this order the prediction's do not count either
            F.when(F.get(f"{name}_r", k) >= n, _possible(F.col(f"{name}_h"), n)).otherwise(0).cast("double").alias("h"),
            _possible(F.get(f"{name}_r", k), n).cast("double").alias("r")) for name, _, order, _ in kinds for n in range(1, order + 1)])

    orders = range(sum(order for _, _, order, _ in kinds))
    factor = beta ** 2

    def smoothed(entries):
        """Mean of the per-order F-scores, empty ones tiny instead of left out."""
        tiny = F.lit(1e-16)

        def one(e):
            p = F.when(e["h"] > 0, e["m"] / e["h"]).otherwise(tiny)
            r = F.when(e["r"] > 0, e["m"] / e["r"]).otherwise(tiny)
            return F.when(factor * p + r > 0, (1 + factor) * p * r / (factor * p + r)).otherwise(tiny)

        return 100 * F.aggregate(entries, F.lit(0.0), lambda a, e: a + one(e)) / len(orders)

    def effective(entries):
        """F-score of the mean precision and recall over the orders both sides have."""
        live = F.filter(entries, lambda e: (e["h"] > 0) & (e["r"] > 0))
        n = F.size(live)
        p = F.aggregate(live, F.lit(0.0), lambda a, e: a + e["m"] / e["h"]) / F.greatest(n, F.lit(1))
        r = F.aggregate(live, F.lit(0.0), lambda a, e: a + e["m"] / e["r"]) / F.greatest(n, F.lit(1))
        return F.when(p + r > 0, 100 * (1 + factor) * p * r / (factor * p + r)).otherwise(0.0)

    score = smoothed if eps_smoothing else effective
    per_ref = texts.select(*by, F.transform("c_r", lambda _, k: F.struct((-k).alias("k"), entries(k).alias("e"))).alias("refs"))
    best = per_ref.select(*by, F.array_max(F.transform("refs", lambda x: F.struct(
        score(x["e"]).alias("s"), x["k"].alias("k"), x["e"].alias("e"))))["e"].alias("e"))
    corpus = best.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("e")[i][c]).alias(f"{c}{i}") for i in orders for c in "mhr"])
    sums = F.array(*[F.struct(*[F.col(f"{c}{i}").alias(c) for c in "mhr"]) for i in orders])
    return corpus.withColumn("e", F.when(F.col("n") > 0, sums).otherwise(F.slice(sums, 1, 0))).select(
        *by, score(F.col("e")).alias("score"), F.lit(char_order).alias("char_order"),
        F.lit(word_order).alias("word_order"), F.lit(beta).alias("beta"))


# --- rouge -----------------------------------------------------------------------------------

def _f_measure(hits: Column, hyp: Column, ref: Column) -> Column:
    p, r = ratio(hits, hyp), ratio(hits, ref)
    return ratio(2 * p * r, p + r)


def rouge_rows(df: DataFrame, key: str, types: Sequence[str] = ("rouge1", "rouge2", "rougeL", "rougeLsum"),
               tokenizer: tx.Tokenizer = tx.rouge_tokens, by: Sequence[str] = ()) -> DataFrame:
    """Per row (by, key) the F-measure of each type, against the best reference."""
    keep = list(dict.fromkeys([*by, key]))
    df = spread_texts(as_references(df).select(*keep, "prediction", "references"))
    tokens = df.select(*keep, *TEXT, tokenizer(F.col("prediction")).alias("hyp"),
                       F.transform("references", tokenizer).alias("refs"))
    orders = sorted(int(t[5:]) for t in types if t[5:].isdigit())
    scores = None
    if orders:
        shared = shared_grams(F.col("hyp"), F.col("refs"), max(orders)).alias("shared")
        scores = tokens.select(*keep, *TEXT, size_of(F.col("hyp")).alias("h"), F.transform("refs", size_of).alias("sizes"), shared).select(
            *keep, *TEXT, "h", "sizes", F.posexplode("shared.each").alias("k", "m")).select(
            *keep, *TEXT, "k", "h", F.get("sizes", F.col("k")).alias("r"), *[F.col("m")[n - 1].alias(f"m{n}") for n in orders])
    if "rougeL" in types or not orders:
        flat = tokens.select(*keep, *TEXT, F.col("hyp"), F.posexplode("refs").alias("k", "ref"))
        lcs = flat.select(*keep, *TEXT, "k", F.size("hyp").alias("h"), F.size("ref").alias("r"),
                          *([tx.lcs_length("hyp", "ref").alias("lcs")] if "rougeL" in types else []))
        scores = lcs if scores is None else scores.join(lcs.drop(*keep, "h", "r"), [*TEXT, "k"])
    if "rougeLsum" in types:
        def sentences(c):
            return F.transform(F.filter(F.split(c, "\n"), lambda s: s != ""), tokenizer)

        summed = df.select(*TEXT, sentences(F.col("prediction")).alias("hs"),
                           F.posexplode("references").alias("k", "ref"))
        summed = summed.select(*TEXT, "k", tx.summary_lcs_hits(sentences(F.col("ref")), "hs").alias("lsum"))
        scores = scores.join(summed, [*TEXT, "k"])
    f = {}
    for t in types:
        if t[5:].isdigit():
            n = int(t[5:])
            f[t] = _f_measure(F.col(f"m{n}"), _possible(F.col("h"), n), _possible(F.col("r"), n))
        else:
            f[t] = _f_measure(F.col("lcs" if t == "rougeL" else "lsum"), F.col("h"), F.col("r"))
    return scores.withColumns(f).groupBy(*keep, *TEXT).agg(*[F.max(t).alias(t) for t in types]).drop(*TEXT)


def rouge(df: DataFrame, key: str, types: Sequence[str] = ("rouge1", "rouge2", "rougeL", "rougeLsum"),
          tokenizer: tx.Tokenizer = tx.rouge_tokens, by: Sequence[str] = ()) -> DataFrame:
    """Mean F-measure of each type (the plain mean, not a bootstrap's middle)."""
    return rouge_rows(df, key, types, tokenizer, by).groupBy(*by).agg(*[F.avg(t).alias(t) for t in types])


# --- error rates and exact match -------------------------------------------------------------

@register("exact_match")
def exact_match(regexes_to_ignore: list[str] | None = None, ignore_case: bool = False,
                ignore_punctuation: bool = False, ignore_numbers: bool = False) -> Metric:
    def strip(c):
        return tx.strip_text(c, regexes_to_ignore, ignore_case, ignore_punctuation, ignore_numbers)

    hit = (strip("prediction") == strip("reference")).cast("double")
    return Metric("exact_match", {"h": F.avg(hit)}, {"exact_match": lambda s: s["h"]})


@register("wer")
def wer() -> Metric:
    """Word edits over reference words, of the whole corpus; a pair with a null text does not count."""
    def compute(df, keys):
        pairs = df.select(*keys, tx.words("prediction").alias("h"), tx.words("reference").alias("r"))
        both = F.col("h").isNotNull() & F.col("r").isNotNull()
        empty = F.array().cast("array<string>")
        edits = tx.word_edit_distance(F.coalesce("h", empty), F.coalesce("r", empty))
        counted = pairs.select(*keys, F.when(both, edits).alias("e"), F.when(both, F.size("r")).alias("n"))
        return counted.groupBy(*keys).agg(ratio(F.sum("e"), F.sum("n"), None).alias("wer"))

    return Metric("wer", compute=compute)


@register("cer")
def cer() -> Metric:
    """Character edits over reference characters, after squeezing spaces; a pair with a null text does not count."""
    h, r = tx.squeeze("prediction"), tx.squeeze("reference")
    return Metric("cer", {"e": F.sum(F.levenshtein(h, r)), "n": F.sum(F.when(h.isNotNull(), F.length(r)))},
                  {"cer": lambda s: ratio(s["e"], s["n"], None)})


# --- simplification --------------------------------------------------------------------------

def simplification_tokens(lowercase: bool = True) -> tx.Tokenizer:
    """13a tokens of the lower-cased text; an empty text is one empty token."""
    def tokens(c):
        t = tx.tokenize_13a(F.lower(c) if lowercase else c)
        return F.when(F.size(t) == 0, F.array(F.lit(""))).otherwise(t)

    return tokens


def sari_rows(df: DataFrame, key: str, tokenizer: tx.Tokenizer | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Per row (by, key): keep (F1), delete (precision) and add (F1), averaged over n-gram orders 1 to 4, and sari."""
    tokenizer = tokenizer or simplification_tokens()
    keep = list(dict.fromkeys([*by, key]))
    df = spread_texts(as_references(df).select(*keep, "source", "prediction", "references"))
    # the source travels as reference 0, the true references follow; their number stays with the n-grams
    tokens = df.select(*keep, *TEXT, F.size("references").alias("n"), tokenizer(F.col("prediction")).alias("hyp"), F.transform(
        F.concat(F.array("source"), F.col("references")), tokenizer).alias("refs"))
    ids = [*keep, *TEXT]
    k, n = F.col("k"), F.col("n")
    counts = gram_counts(tokens, 4, by=[*keep, "n"]).filter("order > 0").groupBy(*ids, "n", "order", "gram").agg(
        _count_where(k == 0).alias("s"), _count_where(k == -1).alias("c"), _count_where(k > 0).alias("r")).select(
        *ids, "order", (F.col("s") * n).alias("s"), (F.col("c") * n).alias("c"), "r")
    s, c, r = F.col("s"), F.col("c"), F.col("r")
    kept, dele = F.least(s, c), F.greatest(s - c, F.lit(0))
    new = (c > 0) & (s == 0)
    sums = counts.groupBy(*ids, "order").agg(
        F.sum(F.when(kept > 0, F.least(kept, r) / kept)).alias("kp"), F.count_if(kept > 0).alias("kn"),
        F.sum(F.least(kept, r)).alias("kg"), F.sum(F.least(s, r)).alias("ka"),
        F.sum(F.when(dele > 0, F.greatest(dele - r, F.lit(0)) / dele)).alias("dp"), F.count_if(dele > 0).alias("dn"),
        F.count_if(new & (r > 0)).alias("ag"), F.count_if(new).alias("an"),
        F.count_if((r > 0) & (s == 0)).alias("aa"))

    def share(num, den):
        return ratio(F.coalesce(num, F.lit(0)).cast("double"), den, 1.0)  # 0/0 counts as perfect

    def f1(p, q):
        return ratio(2 * p * q, p + q)

    scored = sums.select(
        *ids, f1(share(F.col("kp"), F.col("kn")), share(F.col("kg"), F.col("ka"))).alias("keep"),
        share(F.col("dp"), F.col("dn")).alias("del"),
        f1(share(F.col("ag"), F.col("an")), share(F.col("ag"), F.col("aa"))).alias("add"))
    # an order no text is long enough for has only empty ratios: 1 each
    parts = [((F.sum(x) + (4 - F.count(x))) / 4).alias(x) for x in ("keep", "del", "add")]
    return scored.groupBy(*ids).agg(*parts).withColumn("sari", (F.col("keep") + F.col("del") + F.col("add")) / 3).drop(*TEXT)


def sari(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    return sari_rows(df, key, by=by).groupBy(*by).agg((100 * F.avg("sari")).alias("sari"))


def wiki_split(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """sari, sacrebleu and the share (percent) of predictions equal to some reference after normalising."""
    refs = as_references(df)
    hit = F.exists("references", lambda x: tx.normalize_answer(x) == tx.normalize_answer(F.col("prediction")))
    exact = refs.groupBy(*by).agg((100 * F.avg(hit.cast("double"))).alias("exact"))
    bleu_row = sacrebleu(refs, key, by=by).select(*by, F.col("score").alias("sacrebleu"))
    return join_groups(join_groups(sari(refs, key, by), bleu_row, by), exact, by)


# --- NIST ------------------------------------------------------------------------------------

def in_order(texts: DataFrame) -> DataFrame:
    """Dealt texts sorted by hash and row: a partition has them in the same order whenever it is read."""
    columns = [f.name for f in texts.schema.fields if not isinstance(f.dataType, T.MapType)]
    return texts.sortWithinPartitions("__h", *columns)


def nist(df: DataFrame, key: str, n: int = 5, tokenizer: tx.Tokenizer = tx.tokenize_13a, by: Sequence[str] = ()) -> DataFrame:
    """Information-weighted n-gram precision with the NIST length penalty.

    Information is log2(count of the n-gram's prefix / count of the n-gram) over all references (of a group). A text
    takes, by order, the reference that gains it most. Texts are dealt out once; n-grams travel as packed windows.
    """
    by = list(by)
    tokens = in_order(dealt(sided(df, by))).select(
        *by, tokenizer(F.col("prediction")).alias("hyp"), F.transform("references", tokenizer).alias("refs"))
    total = reference_gains(tokens, by, n)
    log_ratio = F.log(F.sum("h") / F.sum("r"))
    beta = F.log(F.lit(0.5)) / F.pow(F.log(F.lit(1.5)), F.lit(2))
    penalty = F.when(log_ratio < 0, F.exp(beta * log_ratio * log_ratio)).otherwise(1.0)
    return total.groupBy(*by).agg((F.sum(ratio(F.col("gain"), F.col("den"))) * penalty).alias("nist_mt"))
