"""SimHash groups against all pairs, and the pipeline end to end."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from peakweave.llm import decontamination, pii, simhash
from tests.llm.helpers import ODD, clash, frame, prose, spaced, stored


def plain_fingerprint(text):
    ws = spaced(text)
    shingles = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] or ([" ".join(ws)] if ws else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(k) for k in range(len(prints))]


def near_copies(seed=8):
    rng = random.Random(seed)
    base = [prose(rng, 150, 4000) for _ in range(12)]
    texts = ODD + base + base[:3] * 4
    for text in base:
        for _ in range(6):
            ws = text.split()
            ws[rng.randrange(len(ws))] = "changed"
            texts.append(" ".join(ws))
    return texts


def test_groups_equal_all_pairs(spark, tmp_path):
    texts = near_copies()
    docs = stored(clash(frame(spark, texts)), tmp_path / "docs")
    prints = [plain_fingerprint(t) for t in texts]
    rows = {r["doc_id"]: r for r in simhash.digest(simhash.group(docs)).collect()}
    assert [rows[k]["fingerprint"] for k in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [rows[k]["component_id"] for k in range(len(texts))] == plain_components(prints)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(plain_components(prints)))


@pytest.mark.parametrize("n", [20, 700])
def test_dense_neighbourhoods_keep_every_connection(spark, n):
    """Chains and clouds around few centres, small enough to pair and too dense to."""
    rng = random.Random(n)
    points = {0}
    centres = [rng.getrandbits(64) for _ in range(3)]
    while len(points) < n:
        p = rng.choice(centres)
        for _ in range(rng.randrange(1, 7)):
            p ^= 1 << rng.randrange(0, 64, 3)
        points.add(p)
    points = sorted(points)
    signed = [int(np.uint64(p).astype(np.int64)) for p in points]
    frame_ = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    links = simhash.links(frame_)
    assert links.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 2).count() == 0
    roots = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    expected = plain_components(points)
    mine = [roots.get(p, p) for p in signed]
    assert len(set(zip(mine, expected))) == len(set(mine)) == len(set(expected))


def test_repeated_rows_null_ids_and_no_rows(spark, tmp_path):
    rows = [(3, "x y z w", "en", "s", 1)] * 3 + [(None, "x y z w", "en", "s", 1), (1, None, None, None, None), (None, "q r s", "en", "s", 1)]
    docs = stored(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"), tmp_path / "a")
    grouped = simhash.digest(simhash.group(docs))
    assert grouped.count() == 6
    assert {r["component_id"] for r in grouped.filter("doc_id = 3").collect()} == {3}
    assert sorted(str(r["doc_id"]) for r in simhash.keep_one(docs).collect()) == ["1", "3", "None"]
    assert simhash.keep_one(stored(frame(spark, []), tmp_path / "b")).count() == 0


def test_another_split_between_two_reads_loses_nothing(spark, tmp_path, monkeypatch):
    """Half of the texts are copies; the number of splits changes once the fingerprints stand."""
    rng = random.Random(31)
    texts = [prose(rng, 30, 100_000) for _ in range(2000)] * 2
    docs = stored(frame(spark, texts), tmp_path / "docs")
    plain_group = simhash.group

    def group(*args, **kw):
        grouped = plain_group(*args, **kw)
        spark.conf.set("spark.sql.files.minPartitionNum", "2")
        return grouped

    monkeypatch.setattr(simhash, "group", group)
    spark.conf.set("spark.sql.files.minPartitionNum", "4")
    try:
        kept = [r["text"] for r in simhash.keep_one(docs).collect()]
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert len(kept) == 2000 and set(kept) == set(texts)


def test_pipeline_stages_in_turn(spark, tmp_path):
    rng = random.Random(12)
    item = prose(rng, 20, 5000)
    texts = [t for t in near_copies() if t] + [prose(rng, 60, 5000) + " " + item, prose(rng, 60) + " mail a@b.org"]
    root = tmp_path / "tables"
    frame(spark, texts).repartition(2).write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(root / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(root / "labels.parquet"))
    docs = spark.read.parquet(str(root / "documents.parquet"))
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "decontamination", "pii", "packing"]
    kept = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(root))
        out.write.parquet(str(tmp_path / f"stage{n}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{n}"))
        assert n == 4 or docs.columns == columns
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()} if n < 4 else {r["doc_id"] for r in docs.collect()})
    assert len(kept[0]) == len(texts)  # no labels, nothing is rejected
    prints = [plain_fingerprint(t) for t in texts]
    assert set(kept[1]) == set(plain_components(prints))
    assert len(texts) - 2 not in kept[2] and len(kept[2]) == len(kept[1]) - 1
    assert all(not pii.find(t) for t in kept[3].values()) and "<EMAIL>" in kept[3][len(texts) - 1]
    assert kept[4] == set(kept[3])
    whole = corpus_pipeline.run(spark, str(root))
    assert {r["doc_id"] for r in whole.collect()} == kept[4]
    assert decontamination.WINDOW == 10
