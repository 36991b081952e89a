"""Streaming queries: the given tables as file streams, run to completion and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from peakweave.operators import joins
from peakweave.operators.ordering import with_record_id
from peakweave.plans import sequence_dataset
from peakweave.plans.queries.metrics import rounded
from peakweave.plans.queries.registry import joined, query, r
from peakweave.plans.queries.sequences import FEATURES_SQL, KEYS, TOKENS_SQL
from peakweave.plans.queries.views import derive, table, view
from peakweave.session import scratch_path
from peakweave.sources.datasets import write_json_shards
from peakweave.streaming import jobs, ranks


def run(query) -> None:
    query.awaitTermination()


@query(FEATURES_SQL, ("raw_seq", "cell_embedding"))
def stream_model_features(spark, sf):
    """Tokenised JSON shards streamed through the join with pooled cells into a parquet sink."""
    shards, sink = scratch_path(spark, "stream-shards"), scratch_path(spark, "stream-sink")
    rows = with_record_id(view(spark, sf, "raw_seq"), KEYS).select("record_id", "sample", "peak_value", "seq")
    write_json_shards(rows, shards, 8, compression="gzip", finish=lambda df: sequence_dataset.tokenize(df).drop("seq", "attention_mask"))
    stream = jobs.read_json_stream(spark, shards, "record_id long, sample string, peak_value double, input_ids array<int>", 4)
    pooled = joins.pool_cells(view(spark, sf, "cell_embedding"), 4)
    run(jobs.write_parquet_stream(jobs.attach_pooled_cells(stream, pooled, seq_max_len=40), sink, sink + "-checkpoint"))
    out = spark.read.parquet(sink)
    total = F.aggregate(F.flatten("cell_embedding"), F.lit(0.0), lambda acc, x: acc + x)
    return out.select("sample_record_id", joined("seq_input_ids").alias("seq_input_ids"), "seq_len", "peak_value",
                      r(total, 4).alias("block_sum"), r(F.col("cell_embedding")[0][0]).alias("first_value"))


@query(f"""SELECT sample, pos, array_to_string({TOKENS_SQL.format('seq')}, ',') AS input_ids, l_orderkey, l_linenumber FROM raw_seq WHERE length(seq) >= 10""", ("raw_seq",))
def stream_tokenize(spark, sf):
    """A parquet file stream tokenised and materialised."""
    sink = scratch_path(spark, "stream-tokens")
    source = table(spark, sf, "lineitem")
    stream = jobs.read_parquet_stream(spark, sf, source.schema, "lineitem.parquet")
    tokens = sequence_dataset.tokenize(derive(stream, "raw_seq"), 10)
    run(jobs.write_parquet_stream(tokens, sink, sink + "-checkpoint"))
    return spark.read.parquet(sink).select("sample", "pos", joined("input_ids").alias("input_ids"), "l_orderkey", "l_linenumber")


@query("""SELECT l_returnflag AS grp, round(avg(pow(l_discount - l_tax, 2)), 6) + 0.0 AS mse, round(avg(abs(l_discount - l_tax)), 6) + 0.0 AS mae,
round(corr(l_discount, l_tax), 6) + 0.0 AS pearsonr FROM lineitem GROUP BY 1""")
def stream_metrics(spark, sf):
    """Metric statistics kept as streaming state, finished after the last batch."""
    from peakweave.metrics import get

    out = scratch_path(spark, "stream-metrics")
    stream = jobs.read_parquet_stream(spark, sf, table(spark, sf, "lineitem").schema, "lineitem.parquet")
    pairs = stream.select(F.col("l_discount").alias("prediction"), F.col("l_tax").alias("reference"), F.col("l_returnflag").alias("grp"))
    run(jobs.accumulate_metrics(pairs, ["mse", "mae", get("pearsonr", p_value=False)], out, out + "-checkpoint", ["grp"]))
    return rounded(jobs.newest_metrics(spark, out))


STREAM_RANKS_SQL = """WITH x AS (SELECT l_returnflag AS grp, l_discount AS p, l_quantity AS q, l_linestatus = 'F' AS hit FROM lineitem),
k AS (SELECT grp, rank() OVER (PARTITION BY grp ORDER BY p) + (count(*) OVER (PARTITION BY grp, p) - 1) / 2.0::DOUBLE AS rp,
rank() OVER (PARTITION BY grp ORDER BY q) + (count(*) OVER (PARTITION BY grp, q) - 1) / 2.0::DOUBLE AS rq FROM x)
SELECT grp, round(corr(rp, rq), 6) + 0.0 AS spearmanr, count(*) AS n FROM k GROUP BY grp"""


@query(STREAM_RANKS_SQL)
def stream_rank_correlation(spark, sf):
    """Spearman of a stream of eight files in three micro-batches, its pair counts kept as keyed state."""
    source, out = scratch_path(spark, "stream-pairs"), scratch_path(spark, "stream-ranks")
    rows = table(spark, sf, "lineitem").select(F.col("l_discount").alias("prediction"), F.col("l_quantity").alias("reference"),
                                               F.col("l_returnflag").alias("grp"))
    rows.repartition(8).write.parquet(source)
    stream = jobs.read_parquet_stream(spark, source, rows.schema, files_per_batch=3)
    run(ranks.accumulate_pairs(stream, out, out + "-checkpoint", ["grp"]))
    return rounded(ranks.rank_metrics(spark, out, ["spearmanr"], ["grp"]))


@query("""WITH s AS (SELECT l_extendedprice AS x, (l_linestatus = 'F')::INT AS y FROM lineitem),
k AS (SELECT *, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0::DOUBLE AS rx FROM s)
SELECT round((sum(rx) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)), 6) + 0.0 AS roc_auc FROM k""")
def stream_roc_auc(spark, sf):
    """AUC of a stream by line status; after the first files it starts again from its checkpoint, when more have come."""
    source, out = scratch_path(spark, "stream-pairs"), scratch_path(spark, "stream-auc")
    rows = table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("prediction"), (F.col("l_linestatus") == "F").cast("int").alias("reference"), "l_linenumber")
    for arriving in ("l_linenumber <= 2", "l_linenumber > 2"):
        rows.filter(arriving).drop("l_linenumber").repartition(3).write.mode("append").parquet(source)
        stream = jobs.read_parquet_stream(spark, source, "prediction double, reference int", files_per_batch=2)
        run(ranks.accumulate_pairs(stream, out, out + "-checkpoint", slots=4))
    return rounded(ranks.rank_metrics(spark, out, ["roc_auc"]))


@query("SELECT 250 AS n, 250 AS n_known")
def stream_take(spark, sf):
    """The first 250 rows of a stream; which ones is up to arrival, so they are counted and looked up."""
    sink = scratch_path(spark, "stream-take")
    schema = table(spark, sf, "events").schema
    stream = jobs.read_parquet_stream(spark, sf, schema, "events.parquet")
    run(jobs.write_parquet_stream(jobs.take_stream(stream, 250), sink, sink + "-checkpoint"))
    taken = spark.read.parquet(sink).select("event_id")
    known = taken.join(table(spark, sf, "events").select("event_id"), "event_id", "left_semi")
    return taken.agg(F.count(F.lit(1)).cast("int").alias("n")).join(
        F.broadcast(known.agg(F.count(F.lit(1)).cast("int").alias("n_known"))))


@query("SELECT event_id, cast(event_id % 4 AS INTEGER) AS worker FROM events")
def stream_worker_slices(spark, sf):
    """Four workers' slices of one stream, dealt in one reading, cover it without overlap."""
    sink = scratch_path(spark, "stream-workers")
    stream = jobs.read_parquet_stream(spark, sf, table(spark, sf, "events").schema, "events.parquet")
    run(jobs.deal_to_workers(stream.select("event_id"), 4, sink, sink + "-checkpoint", "event_id"))
    slices = [spark.read.parquet(f"{sink}/worker={w}").withColumn("worker", F.lit(w)) for w in range(4)]
    out = slices[0]
    for part in slices[1:]:
        out = out.unionByName(part)
    return out
