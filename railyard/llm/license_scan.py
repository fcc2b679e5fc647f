"""License texts by diagonal voting (operator 6, DataFrame functions only).

All rolling word k-gram hashes of a text are joined with the positions of the same hashes in the templates (a fixed
table, broadcast). A hit votes for the diagonal ``position in the text - position in the template``; votes are summed
by diagonal before the shuffle, as one bit for each template position. Neighbouring diagonals are merged, which bridges
words put in or left out, and a merged span is verified by the share of template words that its grams cover. Texts
without a hit send one row for their word count, nothing else.

Defined cases: a null text counts as empty; it has no words and no labels. A-Z are lower-cased, no other letters.
Rows of equal id and text get equal results, one row each. Nulls in doc_id are kept. Other columns take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from railyard.llm.common import documents, once

GRAM = 3
SHARE = 0.8  # of a long template's words that a span must cover; a short one is matched whole
SHORT = 6  # words
NEAR = 3  # diagonals this close are merged

# Phrases that are looked for literally, and their labels.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]

# Sentences of well-known license texts and notices, and their labels.
TEMPLATES = [
    ("agpl-3", "gnu affero general public license"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("cc0", "cc0 1 0 universal"),
    ("gpl-2", "gnu general public license version 2"),
    ("gpl-3", "gnu general public license version 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software "
            "to deal in the software without restriction"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("proprietary", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def license_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    # the one letter beyond A-Z whose lower case is ASCII must not turn into it
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138")))
    words = F.split(plain, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    return F.filter(words, lambda w: w != "")


def gram_hashes(h: str) -> Column:
    """Hashes of all k-grams of the column of word hashes; empty for fewer words."""
    last = F.size(h) - GRAM
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                                         lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(GRAM)]))).otherwise(F.array().cast("array<bigint>"))


def template_grams(spark: SparkSession) -> DataFrame:
    """(g, template, at, label, n_template_words, base): a row for each gram of each template."""
    rows = [(n, label, phrase.split(), n < len(BASE)) for n, (label, phrase) in enumerate(BASE + TEMPLATES)]
    assert all(GRAM <= len(words) <= 60 for _, _, words, _ in rows)
    table = spark.createDataFrame(rows, "template int, label string, words array<string>, base boolean")
    table = once(table.withColumn("h", F.transform("words", lambda w: F.xxhash64(w))), F.col("h"), "h", "template", "label", "base")
    return table.select("template", "label", "base", F.size("h").alias("n_template_words"), F.posexplode(gram_hashes("h")).alias("at", "g"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; one row per input row."""
    spark = docs.sparkSession
    t = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
                    license_words(F.col(text_col)).alias("w"))
    t = once(t, F.transform("w", lambda w: F.xxhash64(w)), "h", "doc_id", "text_hash")
    # position 0 of the exploded array stands for the text itself
    grams = t.select("doc_id", "text_hash", F.size("h").alias("n_words"),
                     F.posexplode(F.concat(F.array(F.lit(None).cast("long")), gram_hashes("h"))).alias("at_1", "g"))
    hits = grams.join(F.broadcast(template_grams(spark)), "g", "left").where("at_1 = 0 or template is not null")
    votes = hits.groupBy("doc_id", "text_hash", "template", "label", "base", "n_template_words", (F.col("at_1") - 1 - F.col("at")).alias("diagonal")).agg(
        F.count(F.lit(1)).alias("n"), F.max("n_words").alias("n_words"),
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at"))).alias("grams"))
    by_diagonal = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    new = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > NEAR).cast("int"), F.lit(0))
    merged = votes.withColumn("new", new).withColumn("span", F.sum("new").over(by_diagonal))
    whole = F.bit_count("grams") == F.col("n_template_words") - GRAM + 1
    spans = merged.groupBy("doc_id", "text_hash", "template", "label", "base", "n_template_words", "span").agg(
        F.sum(F.when(F.col("template").isNull(), F.col("n"))).alias("copies"), F.max("n_words").alias("n_words"), F.bit_or("grams").alias("grams"),
        F.count(F.when(F.col("base") & whole, 1)).alias("places"), F.min(F.when(F.col("base") & whole, F.col("diagonal"))).alias("first"),
        F.max(F.when(F.col("base") & whole, F.col("diagonal"))).alias("last"))
    covered = F.col("grams")
    for k in range(1, GRAM):
        covered = covered.bitwiseOR(F.call_function("shiftleft", F.col("grams"), F.lit(k)))
    share = F.coalesce(F.bit_count(covered) / F.col("n_template_words"), F.lit(0.0))
    needed = F.when(F.col("n_template_words") <= SHORT, 1.0).otherwise(SHARE)
    spans = spans.withColumn("share", share).withColumn("found", F.col("template").isNotNull() & ~F.col("base") & (F.col("share") >= needed))
    by_doc = spans.groupBy("doc_id", "text_hash").agg(
        F.max("copies").alias("copies"), F.max("n_words").cast("long").alias("n_words"), F.sum("places").alias("n_base"),
        F.min("first").cast("long").alias("first_word"), F.max("last").cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("places") > 0, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when((F.col("places") > 0) | F.col("found"), F.col("label")))), ",").alias("labels"),
        F.max(F.when((F.col("places") > 0), 1.0).when(F.col("base"), 0.0).otherwise(F.col("share"))).alias("score"))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return by_doc.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", each.alias("copy")).drop("copy")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
