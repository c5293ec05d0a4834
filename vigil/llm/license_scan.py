"""License scans by diagonal voting, in DataFrame functions only.

All rolling k-grams of a text's words are joined by hash to the places of the license
templates that have them. A match at word p of the text and word t of the template votes
for the diagonal p - t: an unchanged copy puts all its votes on one diagonal, and words put
in or left out move the rest of it to a neighbouring one. Votes are summed by diagonal,
neighbouring diagonals are merged to spans, and a span counts if it covers enough of its
template in not much more room than that takes.

Texts are never shuffled: only the votes are, and one row per text that carries its size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

K = 3
NEIGHBOUR = 4  # words by which a diagonal may move inside one copy
REACH = 40  # words between two merged stretches
COVERAGE = 0.6  # of a template's k-grams
STRETCH = 1.5  # times the template's length that a span may take
MOST_BROADCAST = 200_000  # k-grams of templates up to which every task gets them all

# Phrases and labels that are looked for word by word.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
# Wording of public licenses and notices.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files to deal in the software without restriction", "mit"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license as published by the free software foundation", "gpl"),
    ("licensed under the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided "
     "that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("this work is licensed under a creative commons attribution noncommercial", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution", "cc-by"),
    ("all rights reserved", "all-rights-reserved"),
]


@dataclass(frozen=True)
class Template:
    words: str
    label: str
    exact: bool  # only unchanged copies count, each with its place


TEMPLATES = [Template(w, label, True) for w, label in PHRASES] + [Template(w, label, False) for w, label in NOTICES]


def words_of(text: Column) -> Column:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lower-cased; null has none.

    Lower-casing more than A-Z does not change where words are. The one other character whose
    lower case is ASCII, the Kelvin sign, is put out of the way first.
    """
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u2020")))
    return F.array_remove(F.split(plain, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def gram_hashes(words: Column) -> Column:
    """Hashes of all K words in a row."""
    # The first K-1 words begin no window that ends in the text, so the last ones are cut.
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (K - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, K)]),
    )


def template_grams(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """(hash, template, label, exact, size, t): each k-gram place of each template."""
    rows = [(i, t.words, t.label, t.exact) for i, t in enumerate(templates)]
    own = spark.createDataFrame(rows, "template int, words string, label string, exact boolean")
    words = F.split("words", " ")
    return own.select(
        "template", "label", "exact", (F.size(words) - (K - 1)).alias("size"),
        F.posexplode(gram_hashes(words)).alias("t", "hash"),
    )


def license_scan(
    docs: DataFrame, templates: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """For each row of docs: doc_id, n_words, places (starts of exact phrases, ascending),
    base_labels (of exact phrases), labels (of all templates), spans and score.

    `spans` are struct(label, start, end, coverage) of the verified spans, in words. The score
    is the greatest coverage, 0 without any. Null and empty texts have no words. Rows that
    repeat, or share an id, or have none, are scanned one by one; other columns are not read.
    """
    spark = docs.sparkSession
    grams = template_grams(spark, TEMPLATES if templates is None else templates)
    if sum(len(t.words.split()) for t in templates or TEMPLATES) <= MOST_BROADCAST:
        grams = F.broadcast(grams)
    split = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words")
    )
    # Number 0 stands for the text itself, so that texts without any match stay.
    hashed = split.select(
        "_row", "doc_id", F.size("words").cast("bigint").alias("n_words"),
        F.concat(F.array(F.lit(None).cast("bigint")), gram_hashes(F.col("words"))).alias("h"),
    )
    at = hashed.select("_row", "doc_id", "n_words", F.posexplode("h").alias("n", "hash"))
    votes = at.join(grams, "hash", "left").filter("n = 0 or template is not null")
    diagonals = (
        votes.withColumn("p", F.col("n") - 1)
        .groupBy("_row", "doc_id", "n_words", "template", "label", "exact", "size", (F.col("p") - F.col("t")).alias("diagonal"))
        .agg(F.min("p").alias("first"), F.max("p").alias("last"), F.collect_set("t").alias("ts"))
    )
    in_order = Window.partitionBy("_row", "template").orderBy("first", "diagonal")
    apart = (
        F.col("exact")
        | F.lag("last").over(in_order).isNull()
        | (F.col("first") - F.lag("last").over(in_order) > REACH)
        | (F.abs(F.col("diagonal") - F.lag("diagonal").over(in_order)) > NEIGHBOUR)
    )
    merged = (
        diagonals.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("_span", F.sum("_new").over(in_order))
        .groupBy("_row", "doc_id", "n_words", "template", "label", "exact", "size", "_span")
        .agg(
            F.min("first").alias("start"), (F.max("last") + K).alias("end"),
            F.size(F.array_distinct(F.flatten(F.collect_list("ts")))).alias("covered"),
        )
        .withColumn("coverage", F.col("covered") / F.col("size"))
    )
    right = F.when(F.col("exact"), F.col("covered") == F.col("size")).otherwise(
        (F.col("coverage") >= COVERAGE) & (F.col("end") - F.col("start") <= STRETCH * (F.col("size") + K - 1))
    )
    span = F.when(right, F.struct(F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "label", "exact", "coverage"))
    whole = merged.groupBy("_row", "doc_id", "n_words").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    exact = F.filter("spans", lambda s: s["exact"])
    return whole.select(
        "doc_id", "n_words", F.transform(exact, lambda s: s["start"]).alias("places"),
        F.array_sort(F.array_distinct(F.transform(exact, lambda s: s["label"]))).alias("base_labels"),
        F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["label"]))).alias("labels"),
        F.transform(
            "spans", lambda s: F.struct(s["label"].alias("label"), s["start"].alias("start"), s["end"].alias("end"), s["coverage"].alias("coverage"))
        ).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"),
    )
