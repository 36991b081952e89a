import gzip
import json

import pytest
from pyspark.sql import functions as F

from peakweave.plans import sequence_dataset as sd
from peakweave.session import materialize, shared_dir
from peakweave.sources import datasets, matrix, text


def test_regex_delimited(spark, tmp_path):
    (tmp_path / "a.csv").write_text("sample,pos,seq,peak_value\ns1\tchr1:1-2\t\tACGT 1.5\ns2,chr1:3-4,,2\n\n")
    (tmp_path / "b.csv").write_text("sample pos seq peak_value\ns3,chr2:5-6,GG,\n")
    rows = {r["sample"]: r for r in text.read_regex_delimited(spark, str(tmp_path)).collect()}
    assert set(rows) == {"s1", "s2", "s3"}
    assert (rows["s1"].seq, rows["s1"].peak_value) == ("ACGT", 1.5)
    assert rows["s2"].seq is None and rows["s2"].peak_value == 2.0
    assert rows["s3"].peak_value is None


@pytest.mark.parametrize("line,want", [
    (" a \t b\t\tc\\d ", "a,b,cd"), ("\t\tx\ty\t", "x,y"), ("a\t  \tb", "a,,b"), (" \tx", "x"), ("p\\\\q", "pq")])
def test_clean_fields(spark, line, want):
    df = spark.createDataFrame([(line,), ("  \t ",)], "value string")
    assert [r.value for r in text.clean_lines(df).collect()] == [want]


def test_read_cleaned(spark, tmp_path):
    path = tmp_path / "dirty.tsv"
    path.write_text("Sample\tPos\tSeq\tPeak\n s1 \tchr1:1-2\tAC\\GT\t 3.5\n\ns2\t\tchr1:3-4\tGG\t4\n")
    got = text.read_cleaned(spark, str(path), source_header="Sample\tPos\tSeq\tPeak").collect()
    assert {tuple(r) for r in got} == {("s1", "chr1:1-2", "ACGT", 3.5), ("s2", "chr1:3-4", "GG", 4.0)}


def test_headered_csv_with_crlf(spark, tmp_path):
    path = tmp_path / "snp.csv"
    path.write_bytes(b",phenotype_id,variant_id,slope,pval_nominal,A1,A2\r\n"
                     b"0,chr1:2050048-2050549,chr1_2050397,0.40420964,2.15e-12,T,C\r\n")
    row = text.read_headered_csv(spark, str(path)).first()
    assert (row.phenotype_id, row.slope, row.A1, row.A2) == ("chr1:2050048-2050549", 0.40420964, "T", "C")
    plain = tmp_path / "samples.csv"
    plain.write_text("sample\nE-1\nE-2\n")
    got = text.read_headered_csv(spark, str(plain), spark.createDataFrame([], "sample string").schema, index_column=False)
    assert {r["sample"] for r in got.collect()} == {"E-1", "E-2"}


def test_headerless_tsv(spark, tmp_path):
    (tmp_path / "seq.tsv").write_text("E-1\tchr1:1-2\tACGT\nE-2\tchr1:3-4\t\"GG\n")
    got = {r["sample"]: r.seq for r in text.read_headerless_tsv(spark, str(tmp_path / "seq.tsv")).collect()}
    assert got == {"E-1": "ACGT", "E-2": '"GG'}


def test_wide_matrix(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text("sample,chr1:1-2,chr1:3-4\ns1,0.5,\ns2,1.5,2\r\n")
    got = {(r["sample"], r.pos): r.value for r in matrix.read_wide_matrix(spark, str(path)).collect()}
    assert got == {("s1", "chr1:1-2"): 0.5, ("s1", "chr1:3-4"): None, ("s2", "chr1:1-2"): 1.5, ("s2", "chr1:3-4"): 2.0}
    with pytest.raises(ValueError):
        matrix.read_wide_matrix(spark, str(path), index="cell")


def test_dictionary(spark, tmp_path):
    path = tmp_path / "genes.json"
    path.write_text(json.dumps({"MT-TF": "ENSG00000210049", "MT-RNR1": "ENSG00000211459"}, indent=1))
    got = {r.key: r.value for r in datasets.read_dictionary(spark, str(path)).collect()}
    assert got["MT-TF"] == "ENSG00000210049" and len(got) == 2
    with pytest.raises(ValueError):
        datasets.read_dictionary(spark, str(tmp_path / "genes.pkl"))


def test_json_shards_and_gzip(spark, tmp_path):
    df = spark.range(23).withColumnRenamed("id", "record_id").withColumn("split", F.lit("train"))
    datasets.write_json_shards(df, str(tmp_path / "shards"), 5)
    assert len(list((tmp_path / "shards" / "split=train").glob("shard=*"))) == 5
    back = datasets.read_json_lines(spark, str(tmp_path / "shards"), "record_id long, split string, shard int")
    assert {(r.record_id, r.shard) for r in back.collect()} == {(i, i % 5) for i in range(23)}
    with gzip.open(tmp_path / "x.json.gz", "wt") as f:
        f.write('{"record_id": 7}\n')
    assert datasets.read_json_lines(spark, str(tmp_path / "x.json.gz"), "record_id long").first().record_id == 7
    datasets.write_parquet_shards(df, str(tmp_path / "emb"), 3)
    assert spark.read.parquet(str(tmp_path / "emb")).count() == 23


def test_build_tokenize_export(spark, tmp_path):
    (tmp_path / "train.csv").write_text("sample,pos,seq,peak_value\n" + "".join(f"s{i % 3},p{i % 4},{'ACGTN' * (1 + i % 2)},{i}\n" for i in range(12)))
    (tmp_path / "test.csv").write_text("sample,pos,seq,peak_value\ns0,p0,AC,9\n")
    out = str(tmp_path / "raw")
    sd.build_raw_dataset(spark, str(tmp_path / "train.csv"), str(tmp_path / "test.csv"), out)
    raw = datasets.read_dataset(spark, out)
    assert sorted(r.record_id for r in raw.filter("split = 'train'").collect()) == list(range(12))
    assert datasets.read_dataset(spark, out, "test").first().record_id == 12
    tokens = sd.tokenize(raw, 6)
    assert tokens.count() == 6
    matrix_rows = spark.createDataFrame([(f"s{i}", f"p{j}", float(i + j)) for i in range(3) for j in range(4)], "sample string, pos string, value double")
    normed = sd.add_norm_peak(tokens, matrix_rows)
    assert "seq" not in normed.columns and "attention_mask" not in normed.columns
    sd.export_json(normed.drop("split"), str(tmp_path / "json"), 4, 0.5)
    back = datasets.read_json_lines(spark, str(tmp_path / "json"), "record_id long, split string, norm_peak_value float")
    assert back.filter("split = 'validation'").count() == 3


def test_rows_generator_and_run_config(spark, tmp_path):
    seeds = datasets.from_rows(spark, [(3,), (2,)], "n int")
    made = datasets.from_generator(seeds, lambda pdf: iter([pdf.loc[pdf.index.repeat(pdf.n)]]), "n int")
    assert sorted(r.n for r in made.collect()) == [2, 2, 3, 3, 3]
    datasets.write_run_config(seeds.agg(F.sum("n").alias("total")), {"b": 1, "a": [1, 2]}, str(tmp_path / "cfg"))
    line = next((tmp_path / "cfg").glob("part-*")).read_text()
    assert list(json.loads(line)) == ["a", "b", "total"]
    for step in (1, 2):
        datasets.append_metrics(seeds.agg(F.avg("n").alias("mse")), str(tmp_path / "metrics"), step)
    assert spark.read.json(str(tmp_path / "metrics")).count() == 2


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = materialize(spark.range(5).repartition(2))
    assert df.count() == 5
    assert spark.sparkContext.getCheckpointDir().startswith("file:" + shared_dir(spark)) or shared_dir(spark) in spark.sparkContext.getCheckpointDir()
