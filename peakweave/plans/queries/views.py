"""Stand-in views: the engine's input tables, derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Column lists and filters shared by Spark (selectExpr) and the SQL counterparts.
_RAW_SEQ = """cast(l_suppkey as string) as sample
concat('chr', cast(l_partkey % 22 + 1 as string), ':', cast(1000*l_partkey as string), '-', cast(1000*l_partkey + 501 as string)) as pos
translate(md5(concat(cast(l_partkey as string), '|', cast(l_suppkey as string))), '0123456789abcdef', 'ACGTNACGTNACGTNa') as seq
l_quantity as peak_value
l_orderkey
l_linenumber"""

_SNP = """p_partkey as file_pos
concat('chr', cast((p_partkey - p_partkey % 2) % 22 + 1 as string), ':', cast(1000*(p_partkey - p_partkey % 2) as string), '-', cast(1000*(p_partkey - p_partkey % 2) + 501 as string)) as phenotype_id
concat('chr', cast((p_partkey - p_partkey % 2) % 22 + 1 as string), '_', cast(1000*(p_partkey - p_partkey % 2) + p_size as string)) as variant_id
p_retailprice as slope
case when p_size % 7 = 0 then 'AT' else 'A' end as A1
'G' as A2"""

_VAR = """p_partkey as gene
concat('G', cast(p_partkey as string)) as gene_name
case when p_size <= 40 then concat('ENSG', cast(p_partkey as string)) end as ensembl_id
p_retailprice as gene_median"""

_OBS = """o_orderkey as cell_id
cast(o_custkey % 20 as string) as sample
o_orderpriority as cell_type"""

# name: (table, columns, filter)
_SIMPLE = {
    "raw_seq": ("lineitem", _RAW_SEQ, None),
    "snp": ("part", _SNP, None),
    "cell_type_samples": ("supplier", "cast(s_suppkey as string) as sample", "s_nationkey < 12"),
    "obs": ("orders", _OBS, None),
    "var_genes": ("part", _VAR, None),
    "cell_embedding": ("embeddings", "vec_id as cell_id\ncast(label as string) as sample\nembedding", None),
    "reg_pairs": ("lineitem", "l_discount as prediction\nl_tax as reference\nl_quantity as weight\nl_returnflag as grp", None),
    "pass_rows": ("events", "user_id as task_id\nevent_id as completion_id\nevent_type <> 'error' as passed", None),
    "series": ("events", "user_id as series_id\nts\nevent_id\nvalue", None),
}

VIEW_SQL = {
    name: f"SELECT {', '.join(cols.splitlines())} FROM {source}" + (f" WHERE {cond}" if cond else "")
    for name, (source, cols, cond) in _SIMPLE.items()
} | {
    "matrix": "SELECT cast(user_id as string) AS sample, event_type AS pos, max(value) AS value "
              "FROM events GROUP BY user_id, event_type",
    "counts": "SELECT l_orderkey AS cell_id, l_partkey AS gene, sum(l_quantity) AS value "
              "FROM lineitem GROUP BY l_orderkey, l_partkey",
    "cls_pairs": "SELECT l.doc_id, l.toxic AS prediction, l.quality AS reference, cast(d.n_chars AS double) AS score "
                 "FROM labels l JOIN documents d ON l.doc_id = d.doc_id",
    "text_pairs": "SELECT u.conv_id * 1000 + u.turn AS id, a.text AS prediction, u.text AS reference "
                  "FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 "
                  "WHERE u.role = 'user' AND a.role = 'assistant'",
    "trec_run": "SELECT l_suppkey AS query, l_partkey AS docid, max(l_extendedprice) AS score "
                "FROM lineitem GROUP BY l_suppkey, l_partkey",
    "trec_qrels": "SELECT l_suppkey AS query, l_partkey AS docid, max(case when l_returnflag = 'R' then 2 "
                  "when l_returnflag = 'A' then 1 else 0 end) AS rel FROM lineitem "
                  "GROUP BY l_suppkey, l_partkey",
}


def derive(df: DataFrame, name: str) -> DataFrame:
    """Apply a simple view's columns and filter to its source table, batch or stream."""
    _, cols, cond = _SIMPLE[name]
    return (df.filter(cond) if cond else df).selectExpr(*cols.splitlines())


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A stand-in view as a DataFrame."""
    if name in _SIMPLE:
        return derive(table(spark, sf, _SIMPLE[name][0]), name)
    return _COMPOSED[name](spark, sf)


def _matrix(spark, sf):
    return table(spark, sf, "events").groupBy(F.col("user_id").cast("string").alias("sample"),
                                              F.col("event_type").alias("pos")).agg(F.max("value").alias("value"))


def _counts(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene")).agg(
        F.sum("l_quantity").alias("value"))


def _cls_pairs(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    return table(spark, sf, "labels").join(docs, "doc_id").select(
        "doc_id", F.col("toxic").alias("prediction"), F.col("quality").alias("reference"), "score")


def _text_pairs(spark, sf):
    turns = table(spark, sf, "conversations")
    user = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("reference"))
    reply = turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"),
                                                      F.col("text").alias("prediction"))
    return user.join(reply, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "prediction", "reference")


def _trec_run(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("query"), F.col("l_partkey").alias("docid")).agg(
        F.max("l_extendedprice").alias("score"))


def _trec_qrels(spark, sf):
    rel = F.when(F.col("l_returnflag") == "R", 2).when(F.col("l_returnflag") == "A", 1).otherwise(0)
    return table(spark, sf, "lineitem").groupBy(
        F.col("l_suppkey").alias("query"), F.col("l_partkey").alias("docid")).agg(F.max(rel).alias("rel"))


_COMPOSED = {
    "matrix": _matrix, "counts": _counts, "cls_pairs": _cls_pairs, "text_pairs": _text_pairs,
    "trec_run": _trec_run, "trec_qrels": _trec_qrels,
}
