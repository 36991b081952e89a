"""Empty tables, repeated rows, clashing columns and very long texts, operator by operator, and the pipeline over them."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from peakweave.llm import decontamination, pii, quality_classifier, simhash, token_counts, toxicity
from tests.llm.helpers import ODD, SCHEMA, clash, frame, prose, stored



@pytest.fixture(scope="module")
def case():
    """Good and bad, ordinary and toxic texts with labels; the last text has 150 000 words."""
    rng = random.Random(21)
    texts, labels = [], []
    for k in range(160):
        ws = prose(rng, rng.randrange(30, 90)).split()
        if k % 4 == 0:
            ws = [w + "***" for w in ws]
        if k % 5 == 0:
            ws += ["grubface", "vilehead"] * 3
        texts.append(" ".join(ws))
        labels.append((k, int(k % 4 != 0), int(k % 5 == 0)))
    return texts + [prose(rng, 150_000, 900)], labels


def tables(spark, case, tmp_path, more=()):
    texts, labels = case
    docs = stored(clash(frame(spark, texts + list(more))), tmp_path / "docs")
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("module", [toxicity, quality_classifier])
def test_classifiers(spark, case, tmp_path, module):
    docs, labels = tables(spark, case, tmp_path, ODD)
    scorer = module.fit(docs, labels, F.lit(True))
    rows = {r["doc_id"]: r for r in module.score(docs, scorer).collect()}
    assert len(rows) == 161 + len(ODD) and all(0 <= r["score"] <= 1 for r in rows.values())
    twice = docs.unionByName(docs)
    repeated = module.score(twice, scorer).groupBy("doc_id").agg(F.count("*").alias("n"), F.min("score").alias("a"), F.max("score").alias("b"))
    assert all((r["n"], r["a"], r["b"]) == (2, rows[r["doc_id"]]["score"], rows[r["doc_id"]]["score"]) for r in repeated.collect())
    assert module.score(stored(spark.createDataFrame([], SCHEMA), tmp_path / "none"), scorer).count() == 0


def test_classifier_scores_equal_a_plain_network(spark, case, tmp_path):
    """Each text alone gives what it gives in the table."""
    docs, labels = tables(spark, case, tmp_path)
    for module in (toxicity, quality_classifier):
        scorer = module.fit(docs, labels, F.lit(True))
        every = {r["doc_id"]: r["score"] for r in module.score(docs, scorer).collect()}
        for k in (0, 7, 160):
            alone = module.score(docs.filter(F.col("doc_id") == k), scorer).first()["score"]
            assert alone == pytest.approx(every[k], abs=1e-6)


def test_repeated_rows_of_searches(spark, case, tmp_path):
    texts, _ = case
    docs = stored(clash(frame(spark, texts[:20] + ODD)), tmp_path / "docs")
    twice = docs.unionByName(docs)
    bench = spark.createDataFrame([(1, " ".join(texts[3].split()[:15])), (2, None)], "item_id bigint, text string")
    for once, both in ((decontamination.digest(decontamination.find_matches(d, bench)) for d in (docs, twice)),
                       (token_counts.sections(d) for d in (docs, twice))):
        assert sorted(map(str, both.collect())) == sorted(2 * list(map(str, once.collect())))
    none = stored(spark.createDataFrame([], SCHEMA), tmp_path / "none")
    assert simhash.group(none).count() == 0 and token_counts.sections(none).count() == 0


def test_columns_named_like_the_row_number_are_kept(spark, tmp_path):
    docs = stored(frame(spark, ["a b c d", "a b c d", None]).withColumns({c: F.lit(c) for c in ("row", "row_", "__row")}), tmp_path / "docs")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["row"], r["row_"], r["__row"]) for r in kept.collect()) == [(0, "row", "row_", "__row"), (2, "row", "row_", "__row")]


def test_pipeline_with_labels_odd_texts_and_repeated_rows(spark, case, tmp_path):
    texts, labels = case
    root = tmp_path / "tables"
    docs = frame(spark, texts[:160] + ODD + texts[:10])
    docs.unionByName(docs.filter("doc_id < 5")).repartition(3).write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(root / "labels.parquet"))
    spark.createDataFrame([(1, " ".join(texts[3].split()[:15]))], "item_id bigint, text string").write.parquet(str(root / "benchmark.parquet"))
    read = spark.read.parquet(str(root / "documents.parquet"))
    scorer = quality_classifier.fit(read, spark.read.parquet(str(root / "labels.parquet")),
                                    F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    good = quality_classifier.keep(read, scorer)
    rejected = read.count() - good.count()
    assert 20 <= rejected <= 120
    groups = {}
    for r in simhash.digest(simhash.group(good)).collect():
        groups.setdefault(r["component_id"], set()).add(r["doc_id"])
    hit = {r["doc_id"] for r in decontamination.digest(decontamination.find_matches(read, spark.read.parquet(str(root / "benchmark.parquet")))).filter("contaminated").collect()}
    pieces = corpus_pipeline.run(spark, str(root)).collect()
    assert {r["doc_id"] for r in pieces} == set(groups) - hit
    assert 3 in hit and not pii.find(texts[1])
