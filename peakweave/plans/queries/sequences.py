"""Sequence, ordering, join and pooling queries."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from peakweave.functions import arrays as ar
from peakweave.functions import sequences as sq
from peakweave.operators import joins
from peakweave.operators import ordering as od
from peakweave.operators.pooling import masked_mean_rows
from peakweave.plans import features, sequence_dataset, snp_effect as snp_plan, stored_features
from peakweave.plans.queries.registry import joined, query, r
from peakweave.plans.queries.views import table, view
from peakweave.session import scratch_path
from peakweave.sources import datasets, matrix as mx, text as src

KEYS = ["l_orderkey", "l_linenumber", "sample", "pos", "seq", "peak_value"]
KEY_SQL = ", ".join(KEYS)
TOKENS_SQL = ("list_transform(string_split({0}, ''), lambda c: CASE c WHEN 'A' THEN 7 WHEN 'C' THEN 8 WHEN 'G' THEN 9 "
              "WHEN 'T' THEN 10 WHEN 'N' THEN 11 ELSE 6 END)")


# --- sources and sinks -----------------------------------------------------------------------

@query("SELECT sample, pos, seq, peak_value FROM raw_seq", ("raw_seq",))
def regex_delimited_scan(spark, sf):
    """Text with mixed separators and a header in every file, read back as the typed table."""
    path = scratch_path(spark, "regex-delimited")
    rows = view(spark, sf, "raw_seq")
    line = F.concat("sample", F.lit("\t\t"), "pos", F.lit(" "), "seq", F.lit(","), F.col("peak_value").cast("string"))
    marks = spark.range(1).select(F.lit("sample\tpos,seq peak_value").alias("value"))
    rows.select(line.alias("value")).unionByName(marks).write.text(path)
    return src.read_regex_delimited(spark, path)


CLEAN_SQL = r"""
WITH dirty AS (
  SELECT doc_id, concat(chr(9), ' ', lang, ' ', chr(9), chr(9), source, '\', ' ', chr(9), '  ', chr(9), replace(text, chr(10), chr(9)), ' ') AS line
  FROM documents),
parts AS (
  SELECT doc_id, list_transform(regexp_split_to_array(regexp_replace(line, '^\t+|\t+$', '', 'g'), '\t+'),
         lambda x: replace(regexp_replace(x, '^\s+|\s+$', '', 'g'), '\', '')) AS f FROM dirty)
SELECT doc_id, list_reduce(f, lambda acc, x: CASE WHEN acc = '' THEN x ELSE acc || ',' || x END, '') AS cleaned FROM parts
"""


@query(CLEAN_SQL)
def clean_fields(spark, sf):
    """Whole texts as dirty tab-separated lines: trimmed, backslashes gone, joined by commas."""
    tab = F.lit("\t")
    line = F.concat(tab, F.lit(" "), "lang", F.lit(" "), tab, tab, "source", F.lit("\\"), F.lit(" "), tab, F.lit("  "), tab,
                    F.replace("text", F.lit("\n"), tab), F.lit(" "))
    return table(spark, sf, "documents").select("doc_id", src.clean_fields(line).alias("cleaned"))


@query("SELECT file_pos, phenotype_id, variant_id, slope, A1, A2 FROM snp", ("snp",))
def headered_csv_scan(spark, sf):
    """CRLF file with a header and an index column in front; the index is read as text and dropped."""
    path = scratch_path(spark, "snp-csv")
    rows = view(spark, sf, "snp")
    line = F.concat_ws(",", F.col("file_pos").cast("string"), *[F.col(c).cast("string") for c in rows.columns])
    header = spark.range(1).select(F.lit("," + ",".join(rows.columns)).alias("value"))
    lines = header.unionByName(rows.select(line.alias("value")))
    lines.select(F.concat("value", F.lit("\r"))).write.text(path)
    return src.read_headered_csv(spark, path, rows.schema)


@query("SELECT sample, pos, seq FROM raw_seq", ("raw_seq",))
def headerless_tsv_scan(spark, sf):
    path = scratch_path(spark, "seq-tsv")
    view(spark, sf, "raw_seq").select("sample", "pos", "seq").write.csv(path, sep="\t")
    return src.read_headerless_tsv(spark, path)


@query("SELECT sample, pos, value FROM matrix WHERE value IS NOT NULL", ("matrix",))
def wide_matrix_scan(spark, sf):
    """A wide CSV (one column per peak) exploded to long form."""
    path = scratch_path(spark, "wide-matrix")
    wide = view(spark, sf, "matrix").groupBy("sample").pivot("pos").agg(F.max("value"))
    wide.select("sample", *sorted(c for c in wide.columns if c != "sample")).write.csv(path, header=True)
    return mx.read_wide_matrix(spark, path).filter("value is not null")


@query("SELECT sample, pos, value FROM matrix", ("matrix",))
def wide_matrix_melt(spark, sf):
    return mx.melt(view(spark, sf, "matrix").groupBy("sample").pivot("pos").agg(F.max("value")))


@query("SELECT ln(1 + max(value)) AS log1p_max FROM matrix", ("matrix",))
def matrix_log1p_max(spark, sf):
    return view(spark, sf, "matrix").agg(F.log1p(F.max("value")).alias("log1p_max"))


@query("""WITH ids AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS record_id, o_orderpriority FROM orders)
SELECT record_id, o_orderpriority, cast(record_id % 7 AS INTEGER) AS shard, record_id // 7 AS row_index FROM ids""")
def json_shard_export(spark, sf):
    """JSON-lines shards written (gzip) and scanned back with a given schema."""
    path = scratch_path(spark, "json-shards")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    datasets.write_json_shards(od.with_record_id(rows, ["o_orderkey"]).drop("o_orderkey"), path, 7, compression="gzip")
    back = datasets.read_json_lines(spark, path, "record_id long, o_orderpriority string, row_index long, shard int")
    return back.select("record_id", "o_orderpriority", "shard", "row_index")


@query("""SELECT vec_id AS record_id, cast(vec_id % 5 AS INTEGER) AS shard, array_to_string([cast(floor(cast(c AS DOUBLE) * 1000000) AS BIGINT) FOR c IN embedding], ',') AS millionths FROM embeddings""")
def embedding_shards(spark, sf):
    """Embeddings written as parquet shards and read back, value by value."""
    path = scratch_path(spark, "embedding-shards")
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("record_id"), "embedding")
    datasets.write_parquet_shards(rows, path, 5)
    return spark.read.parquet(path).select("record_id", "shard", joined(
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000000))).alias("millionths"))


@query("""SELECT page_id, string_split(string_split(string_split(url, '://')[2], '/')[-1], '.')[1] AS base FROM pages""")
def base_names(spark, sf):
    """Last path part up to its first dot."""
    rest = F.substring_index("url", "://", -1)
    return table(spark, sf, "pages").select("page_id", sq.base_name(rest).alias("base"))


@query("""SELECT cell_type, sample, count(*) AS n FROM obs WHERE cell_type <> '1-URGENT' GROUP BY cell_type, sample""", ("obs",))
def dataset_directory_scan(spark, sf):
    """A dataset directory partitioned by cell type and split; the filter prunes directories."""
    path = scratch_path(spark, "dataset")
    rows = view(spark, sf, "obs").withColumn("split", F.lit("train"))
    datasets.write_dataset(rows, path, ("cell_type", "split"))
    return datasets.read_dataset(spark, path, "train").filter("cell_type <> '1-URGENT'").groupBy(
        "cell_type", "sample").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT gene_name AS key, ensembl_id AS value FROM var_genes WHERE ensembl_id IS NOT NULL", ("var_genes",))
def dictionary_scan(spark, sf):
    """JSON dictionaries, one object per line, to (key, value) rows."""
    path = scratch_path(spark, "dictionary") + ".json"
    genes = view(spark, sf, "var_genes").filter("ensembl_id is not null")
    genes.select(F.to_json(F.create_map("gene_name", "ensembl_id")).alias("value")).write.text(path)
    return datasets.read_dictionary(spark, path, whole_file=False)


@query("SELECT gene_name AS key, ensembl_id AS value FROM var_genes WHERE ensembl_id IS NOT NULL", ("var_genes",))
def dictionary_whole_file(spark, sf):
    """The same from files of one object each, a dictionary in pieces."""
    path = scratch_path(spark, "dictionary") + ".json"
    genes = view(spark, sf, "var_genes").filter("ensembl_id is not null")
    pieces = genes.groupBy(F.floor(F.col("gene") / 500).alias("piece")).agg(
        F.map_from_entries(F.collect_list(F.struct("gene_name", "ensembl_id"))).alias("m"))  # 500 entries
    pieces.select("piece", F.to_json("m").alias("value")).write.partitionBy("piece").text(path)
    return datasets.read_dictionary(spark, path)


@query("SELECT o_orderkey AS seed, i FROM orders, unnest(range(o_orderkey % 4)) u(i)")
def generated_rows(spark, sf):
    """Rows made by a generator from seed rows."""
    def generate(frame):
        made = frame.loc[frame.index.repeat(frame["seed"] % 4)]
        yield pd.DataFrame({"seed": made["seed"], "i": made.groupby("seed").cumcount()})

    seeds = table(spark, sf, "orders").select(F.col("o_orderkey").alias("seed"))
    return datasets.from_generator(seeds, generate, "seed long, i long")


# --- tokens ----------------------------------------------------------------------------------

@query(f"""SELECT l_orderkey, l_linenumber, array_to_string({TOKENS_SQL.format('seq')}, ',') AS from_right, array_to_string({TOKENS_SQL.format('seq')}, ',') AS from_left FROM raw_seq""", ("raw_seq",))
def trim_padded(spark, sf):
    """Padded rows cut back to their true length, whichever side was padded."""
    rows = view(spark, sf, "raw_seq").withColumn("ids", sq.encode("seq"))
    padded = rows.withColumns({"right": sq.pad_right("ids", 50), "left": sq.pad_left("ids", 50), "n": F.size("ids")})
    return padded.select("l_orderkey", "l_linenumber", joined(sq.trim_right_padded("right", "n")).alias("from_right"),
                         joined(sq.trim_left_padded("left", "n")).alias("from_left"))


@query("""SELECT e.event_id, e.sample, e.pos, cast(cast(m.value AS FLOAT) AS DOUBLE) AS norm_peak_value, round(cast(cast(ln(1 + cast(cast(m.value AS FLOAT) AS DOUBLE)) AS FLOAT) AS DOUBLE), 5) AS log1p_norm_peak_value,
length(e.seq) AS n_ids FROM (SELECT event_id, cast(user_id AS VARCHAR) AS sample, event_type AS pos, event_type AS seq FROM events) e JOIN matrix m ON m.sample = e.sample AND m.pos = e.pos""", ("matrix",))
def normalized_peaks(spark, sf):
    """Tokenised rows with their normalised values; the text and the mask are dropped, a missing pair would fail."""
    rows = table(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("sample"), F.col("event_type").alias("pos"),
                                             F.col("event_type").alias("seq"))
    out = sequence_dataset.add_norm_peak(sequence_dataset.tokenize(rows), view(spark, sf, "matrix"))
    return out.select("*", F.size("input_ids").cast("long").alias("n_ids")).drop("input_ids").withColumns(
        {"norm_peak_value": F.col("norm_peak_value").cast("double"), "log1p_norm_peak_value": r("log1p_norm_peak_value", 5)})


@query(f"""SELECT {KEY_SQL}, array_to_string({TOKENS_SQL.format('seq')}, ',') AS input_ids,
cast(length(seq) AS INTEGER) AS mask_sum FROM raw_seq""", ("raw_seq",))
def tokenize_sequences(spark, sf):
    tokens = sequence_dataset.tokenize(view(spark, sf, "raw_seq"))
    mask = F.aggregate("attention_mask", F.lit(0), lambda acc, x: acc + x)
    return tokens.select(*KEYS, joined("input_ids").alias("input_ids"), mask.alias("mask_sum"))


@query("SELECT doc_id, text AS seq, cast(length(text) AS INTEGER) AS n_tokens FROM documents WHERE length(text) >= 1000")
def filter_min_length(spark, sf):
    """Whole texts of varying length; short ones are dropped before tokenising."""
    rows = table(spark, sf, "documents").select("doc_id", F.col("text").alias("seq"))
    return sequence_dataset.tokenize(rows, 1000).select("doc_id", "seq", F.size("input_ids").alias("n_tokens"))


@query(f"""SELECT DISTINCT seq, replace(replace(seq, 'a', '[UNK]'), 'x', '[UNK]') AS decoded FROM raw_seq""", ("raw_seq",))
def detokenize_sequences(spark, sf):
    rows = view(spark, sf, "raw_seq").select("seq").distinct()
    return rows.select("seq", sq.decode(sq.encode("seq")).alias("decoded"))


@query(f"""WITH t AS (SELECT l_orderkey, l_linenumber, sample, pos, length(seq) AS n, {TOKENS_SQL.format("seq")} AS a, {TOKENS_SQL.format("reverse(seq)")} AS b FROM raw_seq)
SELECT l_orderkey, l_linenumber, sample, pos, '0,' || array_to_string(a, ',') || ',1,' || array_to_string(b, ',') || ',1' AS pair_ids,
'1,' || repeat('0,', n) || '1,' || repeat('0,', n) || '1' AS special_mask, repeat('0,', n + 2) || repeat('1,', n) || '1' AS type_ids FROM t""", ("raw_seq",))
def special_tokens(spark, sf):
    """A sequence and its reversal as a pair."""
    a, b = sq.encode("seq"), sq.encode(F.reverse("seq"))
    return view(spark, sf, "raw_seq").select(
        "l_orderkey", "l_linenumber", "sample", "pos", joined(sq.add_special_tokens(a, b)).alias("pair_ids"),
        joined(sq.special_tokens_mask(a, b)).alias("special_mask"), joined(sq.token_type_ids(a, b)).alias("type_ids"))


@query(f"""WITH t AS (SELECT doc_id, {TOKENS_SQL.format("text")} AS ids FROM documents)
SELECT doc_id, array_to_string(CASE WHEN len(ids) > 250 THEN ids[len(ids) - 249:] ELSE
  list_concat(list_transform(range(250 - len(ids)), lambda x: 4), ids) END, ',') AS padded, cast(least(len(ids), 250) AS INTEGER) AS seq_len FROM t""")
def pad_left_crop(spark, sf):
    """Whole documents, the shorter ones padded and the longer ones cropped on the left."""
    rows = table(spark, sf, "documents").withColumn("ids", sq.encode("text"))
    return rows.select("doc_id", joined(sq.pad_left("ids", 250)).alias("padded"), sq.cropped_length("ids", 250).alias("seq_len"))


@query("""WITH t AS (SELECT conv_id * 1000 + turn AS id, row_number() OVER (ORDER BY conv_id * 1000 + turn) - 1 AS i, list_transform(string_split(text, ''), lambda c: unicode(c)) AS s FROM conversations),
w AS (SELECT i // 16 AS batch, max(len(s)) AS width FROM t GROUP BY 1)
SELECT id, i // 16 AS batch, md5(array_to_string(list_concat(s, list_transform(range(width - len(s)), lambda x: 0)), ',')) AS padded, repeat('1', len(s)) || repeat('0', width - len(s)) AS mask
FROM t JOIN w ON t.i // 16 = w.batch""")
def pad_right_batch(spark, sf):
    """Right padding to the longest row of each batch, with the mask; tokens are code points."""
    rows = table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.transform(F.split("text", ""), F.ascii).alias("t"))
    tokens = od.with_record_id(rows, ["id"], "i").withColumn("batch", F.floor(F.col("i") / 16))
    widths = tokens.groupBy("batch").agg(F.max(F.size("t")).alias("width"))
    full = tokens.join(widths, "batch")
    return full.select("id", "batch", F.md5(joined(sq.pad_right("t", "width", 0))).alias("padded"),
                       F.array_join(sq.pad_mask("t", "width"), "").alias("mask"))


@query("""SELECT DISTINCT pos, string_split(pos, ':')[1] AS chrom, cast(string_split(string_split(pos, ':')[2], '-')[1] AS BIGINT) AS "start",
cast(string_split(pos, '-')[2] AS BIGINT) AS "end" FROM raw_seq""", ("raw_seq",))
def parse_intervals(spark, sf):
    return view(spark, sf, "raw_seq").select("pos").distinct().select("pos", sq.parse_interval("pos").alias("i")).select(
        "pos", "i.*")


# --- order, split, shard ---------------------------------------------------------------------

@query(f"""SELECT {KEY_SQL}, row_number() OVER (ORDER BY {KEY_SQL}) - 1 AS record_id FROM raw_seq""", ("raw_seq",))
def record_ids(spark, sf):
    return od.with_record_id(view(spark, sf, "raw_seq"), KEYS)


@query(f"""WITH s AS (SELECT *, CASE WHEN l_linenumber = 7 THEN 'test' ELSE 'train' END AS split FROM raw_seq)
SELECT {KEY_SQL}, split, row_number() OVER (ORDER BY split DESC, {KEY_SQL}) - 1 AS record_id FROM s""", ("raw_seq",))
def record_ids_over_splits(spark, sf):
    """Train ids first, test ids continue."""
    split = F.when(F.col("l_linenumber") == 7, "test").otherwise("train")
    return od.with_record_id_by_split(view(spark, sf, "raw_seq").withColumn("split", split), KEYS)


SPLIT_SQL = """WITH k AS (SELECT {key} AS record_id, row_number() OVER (ORDER BY md5(concat('{seed}|', cast({key} AS VARCHAR))), {key}) AS i,
count(*) OVER () AS n FROM {source})
SELECT record_id, CASE WHEN i <= ceil({ratio} * n) THEN 'validation' ELSE 'train' END AS split FROM k"""


@query(SPLIT_SQL.format(key="o_orderkey", seed=42, ratio=0.1, source="orders"))
def exact_split_tenth(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("record_id"))
    return od.exact_split(rows, "record_id", 0.1, 42)


@query(SPLIT_SQL.format(key="event_id", seed=3407, ratio=0.0005, source="events"))
def exact_split_small(spark, sf):
    rows = table(spark, sf, "events").select(F.col("event_id").alias("record_id"))
    return od.exact_split(rows, "record_id", 0.0005, 3407)


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY md5(concat('42|', cast(o_orderkey AS VARCHAR))), o_orderkey) - 1 AS place FROM orders""")
def seeded_shuffle(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey")
    return od.with_record_id(rows, [od.shuffle_key("o_orderkey", 42), "o_orderkey"], "place")


@query(f"""SELECT {KEY_SQL} FROM raw_seq ORDER BY {KEY_SQL} LIMIT 100""", ("raw_seq",))
def first_rows(spark, sf):
    return od.head(view(spark, sf, "raw_seq"), 100, KEYS)


@query("""WITH i AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS record_id FROM events)
SELECT event_id, record_id, cast(record_id % 500 AS INTEGER) AS shard, record_id // 500 AS row_index FROM i""")
def strided_shards(spark, sf):
    return od.with_shard(od.with_record_id(table(spark, sf, "events").select("event_id"), ["event_id"]), 500)


@query("""WITH i AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS record_id FROM events),
s AS (SELECT *, ntile(37) OVER (ORDER BY record_id) - 1 AS shard FROM i)
SELECT event_id, record_id, cast(shard AS INTEGER) AS shard, row_number() OVER (PARTITION BY shard ORDER BY record_id) - 1 AS row_index FROM s""")
def contiguous_shards(spark, sf):
    rows = od.with_record_id(table(spark, sf, "events").select("event_id"), ["event_id"])
    return od.with_shard(rows, 37, mode="contiguous")


@query("""WITH c AS (SELECT l_extendedprice AS v, count(*) AS n FROM lineitem GROUP BY 1)
SELECT v, n, sum(n) OVER (ORDER BY v) - n + (n + 1) / 2.0::DOUBLE AS rank FROM c""")
def average_ranks(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("v"))
    return od.average_ranks(rows, "v").select("v", "n", "rank")


@query("""WITH o AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ts, event_id) AS i FROM series)
SELECT a.series_id, a.event_id, round(a.value - b.value, 6) + 0.0 AS difference FROM o a JOIN o b ON a.series_id = b.series_id AND a.i = b.i + 7""", ("series",))
def seasonal_difference(spark, sf):
    out = od.lag_difference(view(spark, sf, "series"), "value", ["ts", "event_id"], 7, ["series_id"])
    return out.select("series_id", "event_id", r("difference").alias("difference"))


@query("""SELECT series_id, event_id, row_number() OVER w - 1 AS i, round(sum(value) OVER w, 4) AS running, max(value) OVER w AS best FROM series
WINDOW w AS (PARTITION BY series_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""", ("series",))
def running_totals(spark, sf):
    out = od.ordered_scan(view(spark, sf, "series"), ["ts", "event_id"], ["series_id"], "i",
                          {"running": "value"}, {"best": "value"})
    return out.select("series_id", "event_id", F.col("i").cast("long").alias("i"), r("running", 4).alias("running"), "best")


@query("""WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders),
b AS (SELECT o_orderkey AS other, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS i FROM orders)
SELECT o_orderkey, other FROM a JOIN b ON a.i = b.i""")
def positional_zip(spark, sf):
    orders = table(spark, sf, "orders")
    right = orders.select(F.col("o_orderkey").alias("other"), "o_totalprice")
    return od.zip_by(orders.select("o_orderkey"), right, ["o_orderkey"], ["o_totalprice", "other"]).select("o_orderkey", "other")


@query("SELECT l_orderkey, l_linenumber, row_number() OVER () - 1 AS record_id FROM lineitem")
def record_ids_file_order(spark, sf):
    """Ids as the rows stand in the file, without a shuffle of rows."""
    return od.with_file_order_id(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "_metadata")).select(
        "l_orderkey", "l_linenumber", "record_id")


# --- joins -----------------------------------------------------------------------------------

LOOKUP_SQL = """WITH probes AS (SELECT event_id, cast(user_id AS VARCHAR) AS sample, event_type AS pos FROM events
UNION ALL SELECT -1 - c_custkey, cast(c_custkey AS VARCHAR), c_mktsegment FROM customer)
SELECT e.event_id, cast(cast(m.value AS FLOAT) AS DOUBLE) AS norm_peak_value,
round(cast(cast(ln(1 + cast(cast(m.value AS FLOAT) AS DOUBLE)) AS FLOAT) AS DOUBLE), 5) AS log1p_norm_peak_value
FROM probes e LEFT JOIN matrix m ON m.sample = e.sample AND m.pos = e.pos"""


@query(LOOKUP_SQL, ("matrix",))
def matrix_lookup(spark, sf):
    """Peak values by (sample, pos); pairs the matrix does not have come out null."""
    probes = table(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("sample"),
                                               F.col("event_type").alias("pos"))
    unknown = table(spark, sf, "customer").select((-1 - F.col("c_custkey")).alias("event_id"),
                                                  F.col("c_custkey").cast("string").alias("sample"),
                                                  F.col("c_mktsegment").alias("pos"))
    found = joins.matrix_lookup(probes.unionByName(unknown), view(spark, sf, "matrix"), strict=False)
    return found.select("event_id", F.col("norm_peak_value").cast("double").alias("norm_peak_value"),
                        r("log1p_norm_peak_value", 5).alias("log1p_norm_peak_value"))


SNP_LAST = """last AS (SELECT phenotype_id, max_by(variant_id, file_pos) AS variant_id, max_by(slope, file_pos) AS slope,
max_by(A1, file_pos) AS A1, max_by(A2, file_pos) AS A2 FROM snp GROUP BY phenotype_id)"""


@query(f"""WITH {SNP_LAST} SELECT l.phenotype_id, variant_id, slope, A1, A2, sample AS sample_id, seq AS sequence
FROM last l JOIN raw_seq s ON s.pos = l.phenotype_id""", ("snp", "raw_seq"))
def variant_merge(spark, sf):
    """Variants joined to the sequences of their window; the last of several variants wins."""
    return joins.merge_variants(view(spark, sf, "snp"), view(spark, sf, "raw_seq"))


@query("""SELECT phenotype_id, variant_id, slope, A1, A2, sample AS sample_id, seq AS sequence
FROM snp l JOIN raw_seq s ON s.pos = l.phenotype_id""", ("snp", "raw_seq"))
def variant_merge_all(spark, sf):
    """All variants of a window, with the hot-key salting on."""
    return joins.merge_variants(view(spark, sf, "snp"), view(spark, sf, "raw_seq"), keep="all", salts=4)


EFFECT_SQL = f"""WITH {SNP_LAST} SELECT l.phenotype_id, variant_id, slope, A1, A2, sample AS sample_id, seq AS sequence,
cast(cast(string_split(variant_id, '_')[2] AS INTEGER) - cast(string_split(replace(l.phenotype_id, '-', ':'), ':')[2] AS INTEGER) AS INTEGER) AS snp_relative_pos
FROM last l JOIN raw_seq s ON s.pos = l.phenotype_id
WHERE length(A1) = 1 AND length(A2) = 1 AND sample IN (SELECT sample FROM cell_type_samples)"""


@query(EFFECT_SQL, ("snp", "raw_seq", "cell_type_samples"))
def snp_effect(spark, sf):
    """The whole variant-effect input: merge, sample list, single-base alleles, offset."""
    return snp_plan.snp_effect_input(view(spark, sf, "snp"), view(spark, sf, "raw_seq"), view(spark, sf, "cell_type_samples"))


@query("""SELECT sample, count(*) AS n_sequences FROM raw_seq WHERE sample NOT IN (SELECT sample FROM cell_embedding) GROUP BY sample""",
       ("raw_seq", "cell_embedding"))
def samples_without_cells(spark, sf):
    return joins.samples_without_cells(view(spark, sf, "raw_seq"), view(spark, sf, "cell_embedding"))


@query("""SELECT o_orderkey AS record_id, o_totalprice, o_totalprice * 2 AS pred FROM orders""")
def realign_predictions(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("record_id"), "o_totalprice")
    preds = orders.select("record_id", (F.col("o_totalprice") * 2).alias("pred"))
    return joins.realign(preds, orders)


@query("SELECT user_id, max_by(event_id, ts) AS event_id, max_by(value, ts) AS value FROM events GROUP BY user_id")
def last_row_per_key(spark, sf):
    return joins.last_per_key(table(spark, sf, "events").select("user_id", "event_id", "value", "ts"), "user_id", "ts").drop("ts")


# --- pooling ---------------------------------------------------------------------------------

POOLED_SQL = """cells AS (SELECT sample, embedding, row_number() OVER (PARTITION BY sample ORDER BY cell_id) - 1 AS p,
  count(*) OVER (PARTITION BY sample) AS n FROM cell_embedding),
rows_ AS (SELECT i FROM range({rows}) t(i)),
pooled AS (SELECT sample, i, d, avg(embedding[d]) AS value FROM cells, rows_, range(1, 65) t(d)
  WHERE p >= (i * n) // {rows} AND p <= ((i + 1) * n + {rows} - 1) // {rows} - 1 GROUP BY sample, i, d)"""


@query(f"WITH {POOLED_SQL.format(rows=20)} SELECT sample, cast(i AS INTEGER) AS i, cast(d - 1 AS INTEGER) AS d, round(value, 6) + 0.0 AS value FROM pooled",
       ("cell_embedding",))
def pool_sample_cells(spark, sf):
    """Each sample's cells averaged to 20 rows."""
    pooled = joins.pool_cells(view(spark, sf, "cell_embedding"), 20)
    return pooled.select("sample", F.posexplode("cell_embedding").alias("i", "row")).select(
        "sample", "i", F.posexplode("row").alias("d", "value")).select("sample", "i", "d", r("value").alias("value"))


@query(f"""WITH {POOLED_SQL.format(rows=60)} SELECT sample, cast(i AS INTEGER) AS i, cast(d - 1 AS INTEGER) AS d, round(value, 6) + 0.0 AS value FROM pooled""",
       ("cell_embedding",))
def pool_more_rows_than_cells(spark, sf):
    """Pooling to more rows than a sample has cells repeats them."""
    pooled = joins.pool_cells(view(spark, sf, "cell_embedding"), 60)
    return pooled.select("sample", F.posexplode("cell_embedding").alias("i", "row")).select(
        "sample", "i", F.posexplode("row").alias("d", "value")).select("sample", "i", "d", r("value").alias("value"))


FEATURES_SQL = f"""WITH {POOLED_SQL.format(rows=4)},
blocks AS (SELECT sample, sum(value) AS total, sum(CASE WHEN i = 0 AND d = 1 THEN value END) AS first_value FROM pooled GROUP BY sample),
ids AS (SELECT *, row_number() OVER (ORDER BY {KEY_SQL}) - 1 AS record_id FROM raw_seq)
SELECT i.record_id AS sample_record_id, '4,4,4,4,4,4,4,4,' || array_to_string({TOKENS_SQL.format('seq')}, ',') AS seq_input_ids,
cast(32 AS INTEGER) AS seq_len, peak_value, round(total, 4) + 0.0 AS block_sum, round(first_value, 6) + 0.0 AS first_value
FROM ids i JOIN blocks b ON i.sample = b.sample"""


@query(FEATURES_SQL, ("raw_seq", "cell_embedding"))
def model_features(spark, sf):
    """Model input assembled end to end: ids, padded tokens, label, pooled cells of the sample."""
    rows = sequence_dataset.tokenize(od.with_record_id(view(spark, sf, "raw_seq"), KEYS))
    out = features.model_input(rows, view(spark, sf, "cell_embedding"), "peak_value", 40, 4)
    total = F.aggregate(F.flatten("cell_embedding"), F.lit(0.0), lambda acc, x: acc + x)
    return out.select("sample_record_id", joined("seq_input_ids").alias("seq_input_ids"), "seq_len", "peak_value",
                      r(total, 4).alias("block_sum"), r(F.col("cell_embedding")[0][0]).alias("first_value"))


@query(FEATURES_SQL.replace("round(total, 4)", "round(total, 2)").replace("round(first_value, 6)", "round(first_value, 4)"), ("raw_seq", "cell_embedding"))
def stored_model_features(spark, sf):
    """The same from sequences and blocks stored apart in float32, joined by bucket when batches are read."""
    rows = sequence_dataset.tokenize(od.with_record_id(view(spark, sf, "raw_seq"), KEYS))
    name, place = f"features_{uuid.uuid4().hex}", scratch_path(spark, "features")
    stored_features.store_features(rows, view(spark, sf, "cell_embedding"), name, place, "peak_value", 40, 4, buckets=8)
    out = stored_features.single_rows(stored_features.read_batches(spark, name))
    total = F.aggregate(F.flatten("cell_embedding"), F.lit(0.0), lambda acc, x: acc + x)
    return out.select("sample_record_id", joined("seq_input_ids").alias("seq_input_ids"), "seq_len",
                      F.col("peak_value").cast("double").alias("peak_value"),
                      r(total, 2).alias("block_sum"), r(F.col("cell_embedding")[0][0], 4).alias("first_value"))


@query("""WITH i AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders)
SELECT i // 72 AS batch, count(*) AS n, string_agg(cast(o_orderkey AS VARCHAR), ',' ORDER BY i) AS keys, string_agg(cast(cast(floor(o_totalprice * 100 + 0.5) AS BIGINT) AS VARCHAR), ',' ORDER BY i) AS cents FROM i GROUP BY 1""")
def collate_batches(spark, sf):
    """Column-wise batches of 72 rows; text columns are left out."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    out = features.collate(rows, 72, "o_orderkey")
    return out.select("batch", F.size("o_orderkey").cast("long").alias("n"), joined("o_orderkey").alias("keys"),
                      joined(F.transform("o_totalprice", lambda x: F.floor(x * 100 + 0.5))).alias("cents"))


def _block():
    """An embedding as 8×8 values."""
    return F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, 8))


_MODES = {"first": 3, "last": 3, "mean": 3, "adaptive": 3, "max": 1, "sum": 1}
MODES_SQL = """WITH cells AS (SELECT vec_id, i, d, cast(embedding[i * 8 + d] AS DOUBLE) AS x FROM embeddings, range(8) a(i), range(1, 9) b(d)),
run AS (SELECT *, avg(x) OVER (PARTITION BY vec_id, d ORDER BY i ROWS UNBOUNDED PRECEDING) AS m FROM cells)
SELECT vec_id, mode, cast(i AS INTEGER) AS i, cast(d - 1 AS INTEGER) AS d, round(v, 6) + 0.0 AS value FROM (
SELECT vec_id, 'first' AS mode, i, d, x AS v FROM cells WHERE i < 3
UNION ALL SELECT vec_id, 'last', i - 5, d, x FROM cells WHERE i >= 5
UNION ALL SELECT vec_id, 'mean', i - 5, d, m FROM run WHERE i >= 5
UNION ALL SELECT vec_id, 'adaptive', o, d, avg(x) FROM cells, range(3) r(o) WHERE i >= (o * 8) // 3 AND i < ((o + 1) * 8 + 2) // 3 GROUP BY vec_id, o, d
UNION ALL SELECT vec_id, 'max', 0, d, max(x) FROM cells GROUP BY vec_id, d
UNION ALL SELECT vec_id, 'sum', 0, d, sum(x) FROM cells GROUP BY vec_id, d)"""


@query(MODES_SQL)
def pooling_modes(spark, sf):
    blocks = table(spark, sf, "embeddings").select("vec_id", _block().alias("block"))
    modes = F.array(*[F.struct(F.lit(m).alias("mode"), ar.pool("block", m, n).alias("rows")) for m, n in _MODES.items()])
    return blocks.select("vec_id", F.inline(modes)).select("vec_id", "mode", F.posexplode("rows").alias("i", "row")).select(
        "vec_id", "mode", "i", F.posexplode("row").alias("d", "value")).select("vec_id", "mode", "i", "d", r("value").alias("value"))


@query("""WITH cells AS (SELECT vec_id, i, d, cast(embedding[i * 8 + d] AS DOUBLE) AS x FROM embeddings, range(8) a(i), range(1, 9) b(d))
SELECT vec_id, cast(d - 1 AS INTEGER) AS d, round(avg(x), 6) + 0.0 AS value, round(sum(x), 6) + 0.0 AS total FROM cells WHERE i < 1 + vec_id % 8 GROUP BY vec_id, d""")
def masked_mean(spark, sf):
    """Mean over the non-padding rows, and the cumulative-sum pooling of the same rows."""
    n = (1 + F.col("vec_id") % 8).cast("int")
    blocks = table(spark, sf, "embeddings").select("vec_id", _block().alias("block"), n.alias("n"))
    rows = blocks.select("vec_id", F.posexplode(F.arrays_zip(
        ar.masked_mean("block", "n").alias("m"), ar.sequence_pool("block", "sum", 1, "n")[0].alias("s"))).alias("d", "z"))
    return rows.select("vec_id", "d", r("z.m").alias("value"), r("z.s").alias("total"))


@query("""SELECT cast(label AS VARCHAR) AS sample, cast(d - 1 AS INTEGER) AS d, round(avg(embedding[d]), 6) + 0.0 AS value
FROM embeddings, range(1, 65) t(d) WHERE embedding[1] > 0 GROUP BY label, d""")
def masked_mean_by_sample(spark, sf):
    means = masked_mean_rows(view(spark, sf, "cell_embedding"), "sample", "embedding", "embedding[0] > 0")
    return means.select("sample", F.posexplode("embedding").alias("d", "value")).select("sample", "d", r("value").alias("value"))


@query("""SELECT vec_id, cast(d - 1 AS INTEGER) AS d, round(cast(embedding[d] AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda x: cast(x AS DOUBLE) * x))), 6) + 0.0 AS value
FROM embeddings, range(1, 65) t(d)""")
def l2_normalize(spark, sf):
    unit = table(spark, sf, "embeddings").select("vec_id", F.posexplode(ar.l2_normalize("embedding")).alias("d", "value"))
    return unit.select("vec_id", "d", r("value").alias("value"))


# --- sets ------------------------------------------------------------------------------------

@query("""WITH t AS (SELECT cast(user_id AS VARCHAR) AS u, event_type FROM events)
SELECT u, count(*) AS n_types FROM (SELECT DISTINCT u, event_type FROM t UNION SELECT DISTINCT u, 'extra' FROM t) GROUP BY u""")
def split_union(spark, sf):
    """Two splits stacked by name, then distinct."""
    t = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("u"), "event_type")
    both = t.unionByName(t.select("u", F.lit("extra").alias("event_type")))
    return both.distinct().groupBy("u").agg(F.count(F.lit(1)).alias("n_types"))


SETS_SQL = """WITH a AS (SELECT l_suppkey AS k FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT l_suppkey AS k FROM lineitem WHERE l_linestatus = 'F')
SELECT 'both' AS op, k, count(*) AS n FROM (SELECT k FROM a INTERSECT ALL SELECT k FROM b) GROUP BY k
UNION ALL SELECT 'only', k, count(*) FROM (SELECT k FROM a EXCEPT ALL SELECT k FROM b) GROUP BY k"""


@query(SETS_SQL)
def multiset_operations(spark, sf):
    """Table-level multiset intersection and difference from counts: min(a, b) and max(a - b, 0).

    Counting first keeps a hot key to one row per task, where intersectAll would carry every copy.
    """
    items = table(spark, sf, "lineitem")
    per = items.groupBy(F.col("l_suppkey").alias("k")).agg(
        F.count_if(F.col("l_returnflag") == "R").alias("a"), F.count_if(F.col("l_linestatus") == "F").alias("b"))
    ops = F.array(F.struct(F.lit("both").alias("op"), F.least("a", "b").alias("n")),
                  F.struct(F.lit("only").alias("op"), F.greatest(F.col("a") - F.col("b"), F.lit(0)).alias("n")))
    return per.select("k", F.inline(ops)).filter("n > 0").select("op", "k", "n")
