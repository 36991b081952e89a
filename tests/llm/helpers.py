"""Small corpora and plain counterparts of the operators."""

from __future__ import annotations

import random
import re
import zlib

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
UPPER = {c: c + 32 for c in range(65, 91)}

ODD = [None, "", " \n\t ", "a", "é", "İK 日本 x", "same same same same same same", "\n\n\nline\nline\n", "|| ** $$ %%", "0" * 3000]


def lower(text: str | None) -> str:
    return (text or "").translate(UPPER)


def words(text: str | None) -> list[str]:
    return WORD.findall(lower(text))


def spaced(text: str | None) -> list[str]:
    return SPACED.findall(lower(text))


def prose(rng: random.Random, n: int, vocabulary: int = 60) -> str:
    return " ".join(f"w{int(rng.paretovariate(0.8)) % vocabulary}" + rng.choice(["", "", ".", ","]) for _ in range(n))


def frame(spark, texts, first: int = 0):
    rows = [(None if t == "no id" else first + k, t, "en", f"src{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def stored(df, path):
    """The frame as a table scan, as operators meet it."""
    df.repartition(3).write.mode("overwrite").parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def crc(doc_id: int, divisor: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % divisor


def clash(docs):
    """More columns, with names the operators use inside."""
    from pyspark.sql import functions as F

    names = ("row", "word", "words", "score", "label", "key", "ids", "fp", "n_words", "labels", "c")
    return docs.withColumns({n: F.lit("extra") for n in names})
