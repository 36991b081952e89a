"""License scans by diagonal voting.

All rolling hashes of K words of every text meet the hashes of the license templates in one join. Where text word `pos`
starts the same K words as template word `at`, the pair votes for the diagonal `pos - at`. Votes of a document and a
template are counted per diagonal, diagonals at most SLACK apart (a few words inserted or left out) become one span, and a
span is verified by the share of the template's words it covers: all of a short phrase, LEAST of a long notice. Every vote
compares the words themselves, so a hash collision counts for nothing.

The templates are a fixed list and are broadcast. Only votes and one row per document are shuffled.

Defined cases: a null or empty text has no words, no places and score 0; repeated rows give a row each; other columns are
ignored; a label found twice is listed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 3
SLACK = 2
LEAST = 0.8
#: Templates of fewer words must be covered whole.
LONG = 12

# The base phrases with their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Well-known notices and phrases of public licenses, as words.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl-3", "gnu general public license version 3"),
    ("gpl-2", "gnu general public license version 2"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl-3", "gnu affero general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2", "mozilla public license version 2"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by-sa", "cc by sa"),
    ("cc-by-nd", "cc by nd"),
    ("cc-by", "cc by 4 0"),
    ("cc-by", "creative commons attribution 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc0", "cc0 1 0 universal"),
)
TEMPLATES = tuple((label, tuple(text.split()), True) for label, text in PHRASES) + tuple(
    (label, tuple(text.split()), False) for label, text in NOTICES)


def words(text: str = "text"):
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` in lower case.

    `lower` also changes letters outside ASCII, which stay word characters; only the Kelvin sign would become an ASCII
    letter and is replaced before.
    """
    plain = F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("\u212a"), F.lit("\u212b"))
    return F.regexp_extract_all(F.lower(plain), F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))


def template_grams(spark: SparkSession) -> DataFrame:
    """`template`, `at` and the K words that stand there, with their hash."""
    rows = [(t, at, *text[at : at + K]) for t, (_, text, _) in enumerate(TEMPLATES) for at in range(len(text) - K + 1)]
    names = [f"t{i}" for i in range(K)]
    frame = spark.createDataFrame(rows, "template int, at int, " + ", ".join(f"{n} string" for n in names))
    return frame.withColumn("hash", F.xxhash64(*names))


def votes(docs: DataFrame) -> DataFrame:
    """One row per vote, and one without a vote for documents that would have none."""
    gram = [F.get("words", F.col("pos") + i) for i in range(K)]
    placed = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words().alias("words")).select(
        "row", "doc_id", "words", F.size("words").cast("bigint").alias("n_words"), F.posexplode_outer("words").alias("pos", "word"))
    joined = placed.withColumn("hash", F.xxhash64(*gram)).join(
        F.broadcast(template_grams(docs.sparkSession)), "hash", "left")
    same = F.coalesce(F.col("template").isNotNull(), F.lit(False))
    for i in range(K):
        same = same & F.coalesce(gram[i] == F.col(f"t{i}"), F.lit(False))
    return joined.withColumn("same", same).filter("same or pos is null or pos = 0").select(
        "row", "doc_id", "n_words", F.when(F.col("same"), F.col("template")).alias("template"),
        F.when(F.col("same"), F.col("at")).alias("at"), F.when(F.col("same"), F.col("pos") - F.col("at")).alias("diagonal"))


def spans(docs: DataFrame) -> DataFrame:
    """One row per verified span: `template`, `label`, `base`, `start` and `end` in words, `coverage`. Every
    document has a row; those of clusters that were not verified, or of no vote at all, hold nulls there."""
    frame = docs.sparkSession.createDataFrame(
        [(t, label, base, len(text)) for t, (label, text, base) in enumerate(TEMPLATES)],
        "template int, label string, base boolean, size int")
    document = ["row", "doc_id", "n_words"]
    # one exchange: all that follows groups inside a document
    diagonals = votes(docs).repartition("row").groupBy(*document, "template", "diagonal").agg(
        F.array_sort(F.collect_set("at")).alias("places"))
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(along) > SLACK).cast("int"), F.lit(0))
    # base phrases are exact: each diagonal stands alone
    marked = diagonals.join(F.broadcast(frame), "template", "left").withColumn("apart", apart).withColumn(
        "cluster", F.when(F.col("base"), F.col("diagonal")).otherwise(F.sum("apart").over(along)))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        F.flatten(F.collect_list("places")), lambda p: F.sequence(p, p + K - 1)))))
    return marked.groupBy(*document, "template", "label", "base", "size", "cluster").agg(
        (covered / F.col("size")).alias("coverage"),
        F.min(F.col("diagonal") + F.element_at("places", 1)).alias("start"),
        F.max(F.col("diagonal") + F.element_at("places", -1) + K).alias("end")).withColumn(
        "verified", F.coalesce(F.col("coverage") >= F.when(F.col("base") | (F.col("size") < LONG), 1.0).otherwise(LEAST),
                               F.lit(False))).select(
        *document, *[F.when(F.col("verified"), F.col(c)).alias(c) for c in ("template", "label", "base", "start", "end", "coverage")])


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: places and labels of the base phrases, all labels, and the best coverage as `score`."""
    place = lambda c: F.when(F.col("base"), F.col(c).cast("bigint"))
    labels = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return spans(docs).groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"), F.min(place("start")).alias("first_word"),
        F.max(place("start")).alias("last_word"), labels(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        labels("label").alias("labels"), F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score")).drop("row")
