"""License scans by diagonal voting.

Every pair of neighbouring words of every text is hashed and joined with the pairs of the templates;
a hit votes for the diagonal (word position in the text less position in the template) it lies on.
Votes are summed per row, template and diagonal.  A short phrase stands where all its pairs vote for
one diagonal.  A template stands where one diagonal covers enough of its pairs, however close it repeats.
For the long templates neighbouring diagonals (words put in or left out) are merged as well, and a
merged span is verified by the share of the template's pairs that it covers and by its length.

The templates are fixed (some hundred pairs, so the join is a broadcast of proven size); words are
compared as well as hashes.  All by Spark's own functions; the only rows that leave their task are a
row per document and its summed votes.

Cases: a null text is empty (no words, no label, score 0); null ids and repeated rows are scanned as
rows of their own; texts are scanned whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Phrases of the base scan and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening sentences of public licenses, and short forms with a label of their own.
TEMPLATES = {
    "apache": [
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "bsd license",
    ],
    "cc-by-nc": ["cc by nc"],
    "cc-by-sa": ["cc by sa"],
    "cc0": ["cc0 1 0 universal"],
    "gpl": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    ],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    ],
    "lgpl": ["gnu lesser general public license"],
    "mit": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    ],
    "mpl": [
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mozilla public license",
    ],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}

#: Diagonals at most so far apart belong to one span; pairs that must vote for one of them.
NEIGHBOUR, LEAST_VOTES = 3, 2
#: Share of a template's pairs that a span covers, and its length against the template's at most.
COVERED, STRETCH = 0.75, 1.5
WORD_CUT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case."""
    # of all other letters only the Kelvin sign has a lower case in a-z; no letter's is a cut
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u00e9")))
    return F.array_remove(F.split(low, WORD_CUT, -1), "")


def template_pairs(spark, phrases: dict[str, str], templates: dict[str, list[str]]) -> DataFrame:
    """One row per template and position: label, base, template, pairs, at, first, second."""
    rows = []
    for base, given in ((True, {label: [p] for p, label in phrases.items()} if len(set(phrases.values())) == len(phrases)
                         else _grouped(phrases)), (False, templates)):
        for label, texts in given.items():
            for text in texts:
                words = text.split()
                if not 2 <= len(words) <= 64:
                    raise ValueError(f"a template has 2 to 64 words: {text!r}")
                t = len({r[2] for r in rows})
                rows += [(label, base, t, len(words) - 1, i, words[i], words[i + 1]) for i in range(len(words) - 1)]
    return spark.createDataFrame(rows, "label string, base boolean, template int, pairs int, at int, first string, second string")


def _grouped(phrases: dict[str, str]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for p, label in phrases.items():
        out.setdefault(label, []).append(p)
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES,
         templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """One row per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    pairs = template_pairs(docs.sparkSession, phrases, templates).withColumn("h", F.xxhash64("first", "second"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("id"),
                       words_of(docs[text_col]).alias("w"))
    words = rows.select("row", "id", F.size("w").alias("n_words"), "w", F.posexplode_outer("w").alias("pos", "word"))
    words = words.withColumn("after", F.get("w", F.col("pos") + 1))
    hits = words.withColumn("wh", F.xxhash64("word", "after")).join(
        F.broadcast(pairs), (F.col("wh") == F.col("h")) & (F.col("word") == F.col("first")) & (F.col("after") == F.col("second")),
        "left").where(F.col("h").isNotNull() | (F.coalesce("pos", F.lit(0)) == 0))
    one = F.lit(1).cast("bigint")
    votes = (hits.groupBy("row", "id", "n_words", "template", "label", "base", "pairs", (F.col("pos") - F.col("at")).alias("diagonal"))
             .agg(F.count("h").alias("votes"), F.bit_or(F.expr("shiftleft(1L, at)")).alias("covers"),
                  F.min("pos").alias("low"), F.max("pos").alias("high")))

    # neighbouring diagonals of a template in a row make one span
    by_diagonal = Window.partitionBy("row", "template").orderBy("diagonal")
    strong = votes.withColumn("strong", (F.col("votes") >= F.least(F.col("pairs"), F.lit(LEAST_VOTES))) & ~F.col("base"))
    strong = strong.withColumn("last", F.max(F.when(F.col("strong"), F.col("diagonal"))).over(
        by_diagonal.rowsBetween(Window.unboundedPreceding, -1)))
    spans = strong.withColumn("span", F.when(F.col("strong"), F.sum(
        F.when(F.col("strong") & (F.col("last").isNull() | (F.col("diagonal") - F.col("last") > NEIGHBOUR)), 1).otherwise(0)).over(by_diagonal)))
    whole = F.col("base") & (F.col("votes") == F.col("pairs"))
    spans = spans.groupBy("row", "id", "n_words", "template", "label", "pairs", "span").agg(
        F.bit_or(F.when(F.col("strong"), F.col("covers"))).alias("covers"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.max(F.when(F.col("strong"), F.bit_count("covers"))).alias("alone"), F.count(F.when(whole, 1)).alias("places"), F.min(F.when(whole, F.col("diagonal"))).alias("from"),
        F.max(F.when(whole, F.col("diagonal"))).alias("to"))
    share = F.coalesce(F.bit_count("covers") / F.col("pairs"), F.lit(0.0))
    # a diagonal that covers enough by itself is never longer than its template
    found = F.col("span").isNotNull() & ((F.col("alone") / F.col("pairs") >= COVERED) | (
        (share >= COVERED) & (F.col("high") - F.col("low") + 1 <= F.ceil(F.col("pairs") * STRETCH))))
    based = F.col("places") > 0
    total = spans.groupBy("row", "id", "n_words").agg(
        F.sum("places").alias("n_base"), F.min("from").cast("bigint").alias("first_word"), F.max("to").cast("bigint").alias("last_word"),
        F.array_sort(F.collect_set(F.when(based, F.col("label")))).alias("base_set"),
        F.array_sort(F.collect_set(F.when(based | found, F.col("label")))).alias("label_set"),
        F.max(F.when(based, 1.0).when(F.col("span").isNotNull(), share).otherwise(0.0)).alias("score"))
    return total.select(F.col("id").alias(id_col), F.col("n_words").cast("bigint").alias("n_words"), "n_base", "first_word",
                        "last_word", F.array_join("base_set", ",").alias("base_labels"),
                        F.array_join("label_set", ",").alias("labels"), "score")
