"""Delimited text: regex-separated, cleaned, headered and headerless files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: tabs, or other white space before nothing but a comma, or a comma.
FIELD_SEPARATOR = r"\t+|\s+|,"

RAW_SEQ_SCHEMA = T.StructType([
    T.StructField("sample", T.StringType()),
    T.StructField("pos", T.StringType()),
    T.StructField("seq", T.StringType()),
    T.StructField("peak_value", T.DoubleType()),
])
SEQ_ALL_SCHEMA = T.StructType(RAW_SEQ_SCHEMA.fields[:3])
SNP_SCHEMA = T.StructType([
    T.StructField("phenotype_id", T.StringType()),
    T.StructField("variant_id", T.StringType()),
    T.StructField("slope", T.DoubleType()),
    T.StructField("pval_nominal", T.DoubleType()),
    T.StructField("A1", T.StringType()),
    T.StructField("A2", T.StringType()),
])


def split_fields(line: Column, schema: T.StructType, separator: str = FIELD_SEPARATOR) -> list[Column]:
    """Split one text column by a regex and cast the parts by position."""
    parts = F.split(line, separator)
    return [F.nullif(F.get(parts, F.lit(i)), F.lit("")).cast(f.dataType).alias(f.name)
            for i, f in enumerate(schema.fields)]


def read_regex_delimited(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = RAW_SEQ_SCHEMA,
                         separator: str = FIELD_SEPARATOR, header: bool = True) -> DataFrame:
    """Text with a regex separator; a header line is recognised by its column names, in every file."""
    lines = spark.read.text(paths).filter(F.trim("value") != "")
    fields = F.split("value", separator)
    if header:
        names = F.array(*[F.lit(f.name) for f in schema.fields])
        lines = lines.filter(F.slice(fields, 1, len(schema.fields)) != names)
    return lines.select(*split_fields(F.col("value"), schema, separator))


def clean_fields(line: Column) -> Column:
    """Fields between tabs, trimmed, without backslashes, joined by commas; empty fields vanish at the left.

    Runs of tabs count as one. As in the shell original an empty prefix is
    overwritten, so leading empty fields leave no comma while inner ones do.
    """
    # spaces at a field's ends only; a field of blanks stays as an empty one
    fields = F.split(F.regexp_replace(line, r"^\t+|\t+$", ""), r"\t+")
    cleaned = F.transform(fields, lambda x: F.translate(F.regexp_replace(x, r"^\s+|\s+$", ""), "\\", ""))
    return F.aggregate(cleaned, F.lit(""), lambda acc, x: F.when(acc == "", x).otherwise(F.concat(acc, F.lit(","), x)))


def clean_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Clean every non-blank line; see `clean_fields`."""
    return lines.filter(F.trim(F.translate(F.col(column), "\t\r", "  ")) != "").select(
        clean_fields(F.col(column)).alias(column))


def read_cleaned(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = RAW_SEQ_SCHEMA,
                 source_header: str | None = None) -> DataFrame:
    """Clean a dirty tab-separated file and read it as the given schema.

    `source_header` is the file's own first line (it is replaced by the schema);
    None when the file has no header.
    """
    lines = spark.read.text(paths)
    if source_header is not None:
        lines = lines.filter(F.col("value") != source_header)
    return clean_lines(lines).select(*split_fields(F.col("value"), schema, ","))


def read_headered_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType = SNP_SCHEMA,
                      index_column: bool = True) -> DataFrame:
    """CSV with a header, LF or CRLF line ends, and optionally an unnamed index column in front.

    Header lines are recognised by their names, so any number of files can be read at once.
    """
    names = [f.name for f in schema.fields]
    raw = T.StructType([T.StructField(c, T.StringType()) for c in (["__index"] if index_column else []) + names])
    rows = spark.read.csv(path, schema=raw).select(
        *[F.regexp_replace(c, r"\r$", "").alias(c) for c in names])
    header = F.lit(True)
    for c in names:
        header = header & F.col(c).eqNullSafe(c)
    return rows.filter(~header).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_headerless_tsv(spark: SparkSession, path: str | Sequence[str],
                        schema: T.StructType = SEQ_ALL_SCHEMA) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schema, header=False, quote="")
