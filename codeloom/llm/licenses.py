"""License scans by diagonal voting, with DataFrame functions only.

All word pairs of a text are joined to the places where the phrases and templates hold the same pair. A pair votes for the
diagonal (place in the text less place in the template): an exact quotation is one diagonal with a vote per pair, and an inserted
or left-out word moves the rest to a neighbouring one. Votes are counted per diagonal, neighbours are merged into spans, and a
span is verified by the share of the template's words that its diagonals cover in place.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codeloom.llm.tables import BROADCAST_ROWS, read_table

# Phrases that count wherever all their words stand one after the other.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Templates: opening sentences of common notices. A share of COVERED of the words is enough. Two wordings may have one label.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
            "following conditions are met"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
               "the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
            "license as published by the free software foundation"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
COVERED = 0.75
# Diagonals of one span differ by no more than this from one to the next: so many words were put in or left out there.
NEIGHBOURS = 3
_WORD_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> Column:
    """Words of the text with A-Z in lower case; null has none. ``lower`` changes other letters too, which never makes or breaks a
    word: all of them are word characters."""
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _WORD_BREAKS), "")


def template_pairs(spark: SparkSession, phrases: dict[str, str], templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """Columns pair, template, at, pairs, label, exact: one row per word pair of a phrase or template, read as texts are."""
    texts = [(text, label, True) for text, label in phrases.items()] + [(text, label, False) for label, text in templates]
    named = F.array(*(
        F.struct(F.lit(i).alias("template"), F.lit(t).alias("text"), F.lit(label).alias("label"), F.lit(exact).alias("exact"))
        for i, (t, label, exact) in enumerate(texts)
    ))
    rows = spark.range(1).select(F.inline(named)).withColumn("words", words_of("text"))
    return rows.select(
        "template", "label", "exact", (F.size("words") - 1).alias("pairs"), F.posexplode(word_pairs("words")).alias("at", "pair"),
    )


def word_pairs(words: str) -> Column:
    """A 64-bit hash of every two words that stand together; none for fewer than two words."""
    return F.expr(
        f"case when size({words}) >= 2 then transform(sequence(0, size({words}) - 2), i -> xxhash64({words}[i], {words}[i + 1]))"
        " else array() end"
    )


def scan(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: tuple[tuple[str, str], ...] = TEMPLATES,
) -> DataFrame:
    """Spans: columns doc_id, text_key, label, exact, first, last, covered. Words count from 0; ``last`` is the start of the last
    place of an exact phrase, else the span's last word.

    ``text_key`` tells texts of one doc_id apart; repeated rows give the same spans once. Phrases and templates may have capitals and
    punctuation, which count as little as in texts; one of fewer than two words has no pair and is refused.
    """
    pairs_known = 0
    for text in [*phrases, *(text for _, text in templates)]:
        n_words = sum(word != "" for word in re.split(_WORD_BREAKS, text))
        if n_words < 2:
            raise ValueError(f"a phrase or template needs two words or more: {text!r}")
        pairs_known += n_words - 1
    spark = docs.sparkSession
    worded = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), words_of("text").alias("_words"))
    pairs = worded.select("doc_id", "text_key", F.posexplode(word_pairs("_words")).alias("place", "pair"))
    known = template_pairs(spark, phrases, templates)
    # Beyond the bound, Spark's own size check or a shuffle.
    known = F.broadcast(known) if pairs_known <= BROADCAST_ROWS else known
    votes = (
        pairs.join(known, "pair")
        .select("doc_id", "text_key", "template", "label", "exact", "pairs", "at", (F.col("place") - F.col("at")).alias("diagonal"))
        .groupBy("doc_id", "text_key", "template", "label", "exact", "pairs", "diagonal").agg(F.collect_set("at").alias("held"))
    )
    exact = votes.filter("exact and size(held) = pairs").select(
        "doc_id", "text_key", "label", "exact", F.col("diagonal").alias("first"), F.col("diagonal").alias("last"), F.lit(1.0).alias("covered"),
    )
    order = Window.partitionBy("doc_id", "text_key", "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > NEIGHBOURS, F.lit(True)).cast("int")
    spans = (
        votes.filter("not exact").withColumn("fresh", fresh).withColumn("span", F.sum("fresh").over(order))
        .groupBy("doc_id", "text_key", "template", "label", "pairs", "span").agg(
            F.array_distinct(F.flatten(F.collect_list("held"))).alias("held"),
            F.min(F.col("diagonal") + F.array_min("held")).alias("first"),
            F.max(F.col("diagonal") + F.array_max("held") + 1).alias("last"),
        )
    )
    # A word is covered if a pair that holds it voted.
    words = F.size(F.array_union("held", F.transform("held", lambda p: p + 1)))
    verified = spans.withColumn("covered", words / (F.col("pairs") + 1)).filter(F.col("covered") >= COVERED).select(
        "doc_id", "text_key", "label", F.lit(False).alias("exact"), "first", "last", "covered",
    )
    return exact.unionByName(verified)


def label_documents(
    docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: tuple[tuple[str, str], ...] = TEMPLATES,
) -> DataFrame:
    """Columns doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score, one row per row of ``docs``.

    Base columns count the places of exact phrases: how many, and where the first and the last begin (null if none). ``labels``
    adds those of verified templates. ``score`` is 1 for a text with an exact phrase, else the best share covered of a
    template, 0 without any. A null or empty text has no words and no labels. Rows are judged by their own text; rows without a
    doc_id and repeated rows too. Columns other than doc_id and text are ignored.
    """
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    found = scan(docs, phrases, templates).groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.count_if("exact").alias("n_base"), F.min(F.when(F.col("exact"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("exact"), F.col("last"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("covered").alias("score"),
    )
    sized = docs.select("doc_id", key.alias("text_key"), F.size(words_of("text")).cast("long").alias("n_words"))
    here = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    return sized.join(found, here, "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.least(F.lit(1.0), F.coalesce("score", F.lit(0.0))).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_documents(read_table(spark, sf_dir, "documents"))
