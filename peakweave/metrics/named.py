"""Corpus metrics by name: `get("bleu")` and the like, evaluated over a whole DataFrame.

Each takes one frame with `prediction` and the references in the columns its function asks for, and an `id`. BLEU, sacreBLEU
and GLEU are finished from one pass over the n-grams when they are asked for together. Those of GROUPED give a row (or rows) per group of `group_by`; the others score the corpus as a whole and refuse it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from peakweave.metrics import benchmarks, classification, distances, distribution, qa, ranking, regression, reliability, tagging, textgen
from peakweave.metrics.core import Metric, register
from peakweave.session import store


GROUPED = ("bleu", "sacrebleu", "google_bleu", "chrf", "rouge", "sari", "nist_mt", "wiki_split", "squad", "record", "trec_eval",
           "seqeval", "mase")


def _whole(name: str, score: Callable[..., DataFrame]) -> None:
    def factory(**options) -> Metric:
        def compute(df: DataFrame, keys) -> DataFrame:
            if keys and name not in GROUPED:
                raise ValueError(f"{name} is a metric of the whole corpus and cannot be grouped")
            return score(df, **options, **({"by": keys} if keys else {}))

        return Metric(name, compute=compute)

    register(name)(factory)


def _keyed(score: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    return lambda df, id="id", **options: score(df, id, **options)


def _answers(score: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """One frame with id, prediction and answers as the two frames of the question-answering scores."""
    def both(df: DataFrame, id="id", by=(), **options) -> DataFrame:
        groups = {"by": by} if by else {}
        return score(df.drop("answers", *by), df.select(*by, id, "answers"), id, **options, **groups)

    return both


def _trec(df: DataFrame, by=(), **options) -> DataFrame:
    """One frame with query, docid, score (null: judged only) and rel (null: not judged); it is computed once."""
    df = store(df.select(*dict.fromkeys([*by, "query", "docid", "score", "rel"])), "trec-rows")
    return ranking.trec_eval(df.filter("score is not null").select(*by, "query", "docid", "score"),
                             df.filter("rel is not null").select("query", "docid", "rel"), by=by, **options)


def _from_sums(name: str, score: Callable[..., DataFrame], columns: Callable[..., list], **more) -> None:
    """A metric of the shared n-gram sums; other orders or tokens than usual need a pass of their own."""
    def factory(id: str = "id", **options) -> Metric:
        alone = {k: v for k, v in options.items() if k in ("tokenizer", "max_order", "min_len", "max_len", "lowercase")}
        return Metric(name, compute=lambda df, keys: score(df, id, by=keys, **options),
                      shared=None if alone else (textgen.corpus_sums, (("key", id),)),
                      columns=() if alone else tuple(columns(**options)), more=tuple(more.items()))

    register(name)(factory)


_from_sums("bleu", textgen.bleu, textgen.bleu_columns)
_from_sums("sacrebleu", textgen.sacrebleu, textgen.sacrebleu_columns)
_from_sums("google_bleu", textgen.google_bleu, textgen.google_bleu_columns, best=True)
for _name, _score in {
    "chrf": textgen.chrf, "rouge": textgen.rouge, "sari": textgen.sari, "nist_mt": textgen.nist,
    "wiki_split": textgen.wiki_split,
}.items():
    _whole(_name, _keyed(_score))
for _name, _score in {"squad": qa.squad, "record": qa.record, "squad_v2": qa.squad_v2, "cuad": qa.cuad}.items():
    _whole(_name, _answers(_score))
_whole("trec_eval", _trec)
_whole("seqeval", tagging.seqeval)
_whole("poseval", tagging.poseval)
_whole("mean_iou", classification.mean_iou)
_whole("pass_at_k", ranking.pass_at_k)
# those that compare with a second frame take it as an option
_whole("mase", lambda df, training, order_by, by=(), **options: regression.mase(df, training, order_by, by, **options))
_whole("mahalanobis", lambda df, reference, **options: distances.mahalanobis(df, reference, **options).select("mahalanobis"))
_whole("mauve", lambda df, reference, **options: distribution.mauve(df, reference, **options))
_whole("coval", lambda df, system, **options: distances.coreference(df, system, **options))
_whole("rl_reliability", lambda df, config="online", **options: {
    "online": reliability.online_reliability, "offline": reliability.offline_reliability}[config](df, **options))
for _name, _score in {
    "glue": benchmarks.glue, "super_glue": benchmarks.super_glue, "xnli": benchmarks.xnli,
    "indic_glue": benchmarks.indic_glue, "xtreme_s": benchmarks.xtreme_s,
}.items():
    _whole(_name, _score)
