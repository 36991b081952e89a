import math
import random

import pytest
from pyspark.sql import functions as F

from peakweave.operators import ordering as o


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    # group "hot" holds most of the rows
    return [(("hot" if rng.random() < 0.6 else f"g{rng.randrange(9)}"), i, float(rng.randrange(20))) for i in range(700)]


def frame(spark, rows, parts=7):
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    return spark.createDataFrame(shuffled, "g string, t long, v double").repartition(parts)


def scan(rows):
    state = {}
    out = set()
    for g, t, v in sorted(rows):
        i, s, m = state.get(g, (0, 0.0, -math.inf))
        state[g] = (i + 1, s + v, max(m, v))
        out.add((g, t, i, s + v, max(m, v)))
    return out


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_grouped_scan(spark, rows, parts):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = o.ordered_scan(frame(spark, rows, parts), ["t"], ["g"], "i", {"s": "v"}, {"m": "v"})
        assert {(r.g, r.t, r.i, r.s, r.m) for r in got.collect()} == scan(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_global_index_and_sum(spark, rows):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = o.with_record_id(frame(spark, rows), ["t"], start=5).collect()
        assert sorted((r.t, r.record_id) for r in got) == [(i, i + 5) for i in range(700)]
        got = o.ordered_scan(frame(spark, rows), [F.col("t").desc()], index="i", sums={"s": "v"}).collect()
        run, want = 0.0, {}
        for i, (g, t, v) in enumerate(sorted(rows, key=lambda r: -r[1])):
            run += v
            want[t] = (i, run)
        assert {r.t: (r.i, r.s) for r in got} == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ids_continue_over_splits(spark):
    df = spark.createDataFrame([("test", 1), ("train", 2), ("train", 1), ("test", 0)], "split string, k int")
    got = {(r.split, r.k): r.record_id for r in o.with_record_id_by_split(df, ["k"]).collect()}
    assert got == {("train", 1): 0, ("train", 2): 1, ("test", 0): 2, ("test", 1): 3}


def test_average_ranks(spark):
    df = spark.createDataFrame([(x,) for x in [10.0, 20.0, 20.0, 30.0, 30.0, 30.0]], "v double")
    assert {r.v: r["rank"] for r in o.average_ranks(df, "v").collect()} == {10.0: 1.0, 20.0: 2.5, 30.0: 5.0}


@pytest.mark.parametrize("n,ratio", [(1000, 0.1), (1000, 0.0005), (7, 0.5), (3, 0.0), (5, 1.0), (1, 0.3)])
def test_exact_split(spark, n, ratio):
    df = spark.range(n).withColumnRenamed("id", "record_id")
    got = {r.split: r["count"] for r in o.exact_split(df, "record_id", ratio, 42).groupBy("split").count().collect()}
    assert got.get("validation", 0) == min(n, math.ceil(ratio * n))
    assert sum(got.values()) == n


def test_published_split_sizes():
    assert math.ceil(124167712 * 0.1) == 12416772
    assert math.ceil(121619444 * 0.0005) == 60810


@pytest.mark.parametrize("n,k", [(10, 3), (10, 10), (3, 5), (12, 4)])
def test_shards(spark, n, k):
    df = spark.range(n).withColumnRenamed("id", "record_id")
    strided = {r.record_id: (r.shard, r.row_index) for r in o.with_shard(df, k).collect()}
    assert strided == {i: (i % k, i // k) for i in range(n)}
    size, more = divmod(n, k)
    want, at = {}, 0
    for s in range(k):
        for j in range(size + (s < more)):
            want[at] = (s, j)
            at += 1
    assert {r.record_id: (r.shard, r.row_index) for r in o.with_shard(df, k, mode="contiguous").collect()} == want


def test_lag_and_zip(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 0.5), ("a", 3, 4.0), ("b", 1, 6.0)], "s string, t int, v double")
    got = o.lag_difference(df, "v", ["t"], 1, ["s"]).collect()
    assert sorted(r.difference for r in got) == [-4.5, 3.5]
    a = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, x string")
    b = spark.createDataFrame([(30, "z"), (10, "x"), (20, "y")], "m int, y string")
    assert {(r.x, r.y) for r in o.zip_by(a, b, ["k"], ["m"]).collect()} == {("a", "x"), ("b", "y"), ("c", "z")}
    with pytest.raises(Exception, match="different lengths"):
        o.zip_by(a, b.limit(2), ["k"], ["m"]).collect()


def test_copies_are_spread(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select(F.when(F.col("id") % 4 == 0, F.col("id")).otherwise(-1).alias("k"), F.lit("x").alias("v")).repartition(6)
        out = o.with_record_id(df, ["k"])
        assert sorted(r.record_id for r in out.collect()) == list(range(4000))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2000  # three quarters of the rows are copies of one
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_file_order_ids_over_splits(spark, tmp_path):
    for name, first in (("a", 0), ("b", 500)):
        (tmp_path / f"{name}.csv").write_text("".join(f"{i}\n" for i in range(first, first + 500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        scan = spark.read.schema("v int").csv(str(tmp_path))
        assert scan.rdd.getNumPartitions() > 4
        ids = o.with_file_order_id(scan, start=7).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(ids) == 1000 and all(r.record_id == r.v + 7 for r in ids)


def test_the_input_is_computed_once(spark):
    """A thousand rows are made a thousand times, and wide columns take no part in the sort."""
    calls = spark.sparkContext.accumulator(0)

    def made(frames):
        for frame in frames:
            calls.add(len(frame))
            yield frame.assign(text="x" * 50)

    df = spark.range(1000).repartition(5).mapInPandas(made, "id long, text string")
    ids = o.with_record_id(df, [F.col("id").desc()])
    assert sorted((r.id, r.record_id, r.text) for r in ids.collect()) == [(i, 999 - i, "x" * 50) for i in range(1000)]
    assert calls.value == 1000


def test_running_values_with_one_pass(spark, rows):
    got = o.ordered_scan(frame(spark, rows), ["t"], ["g"], "i", {"s": "v"}, {"m": "v"}, once=True)
    assert got.columns == ["g", "t", "v", "i", "s", "m"]
    assert {(r.g, r.t, r.i, r.s, r.m) for r in got.collect()} == scan(rows)
    named_again = o.ordered_scan(frame(spark, rows), ["t"], index="v", once=True)
    assert sorted(r.v for r in named_again.collect()) == list(range(700))


@pytest.mark.parametrize("odd", ["other", None])
def test_rows_of_no_split_fail(spark, odd):
    df = spark.createDataFrame([("train", 1), (odd, 2)], "split string, k int")
    with pytest.raises(Exception, match="none of the splits"):
        o.with_record_id_by_split(df, ["k"]).collect()


def test_rows_sorted_by_all_columns_are_not_looked_up(spark):
    """The sorted rows are kept: no join of rows with their numbers; copies and nulls get places of their own."""
    from peakweave.operators.ordering import with_record_id

    rows = [(i % 3 if i % 4 else None, f"s{i % 5}") for i in range(60)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(5)
    out = with_record_id(df, ["a", "b"])
    assert out.columns == ["a", "b", "record_id"]
    assert all("ordered-rows" not in f for f in out.inputFiles())
    got = [(r.a, r.b) for r in sorted(out.collect(), key=lambda r: r.record_id)]
    assert got == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted(r.record_id for r in out.collect()) == list(range(60))
