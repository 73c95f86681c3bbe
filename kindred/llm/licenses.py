"""License scans by diagonal voting.

Every run of K words of a text is hashed and joined with the runs of the license templates.
A hit at word w of a text and word t of a template votes for the diagonal w - t: an
unchanged copy of the template puts all its votes on one diagonal.  Neighbouring diagonals
of one template are merged as long as they are at most DRIFT apart, so inserted or lost
words do not break a match.  A run that repeats beside a notice can chain diagonals without
end, so what is verified are stretches of merged diagonals, from each diagonal as far as
the template is long: the different template runs of one stretch must be at least COVERAGE
of the template's.  Stretches that overlap are one span, that of the best of them.

Words and hits never leave the JVM.  Runs are hashed where the text is split, inside
generated code, and only hits and one row per document are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 3
DRIFT = 4
COVERAGE = 0.6

#: The phrases of the base scan and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: The standard notices by which texts declare their license.
TEMPLATES = {
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0"],
    "cc-by-sa": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file",
    ],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
}

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z lower-cased; none for null."""
    trimmed = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), f"^{_BREAK}", "")
    return _without_ends(F.split(trimmed, _BREAK))


def _without_ends(parts: Column) -> Column:
    """Splitting leaves an empty string after a final break, and for an empty text."""
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def _run(array: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(array, at + i) for i in range(size)])


def template_runs(spark: SparkSession, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """(run, template, label, t, n_runs): the hash and place of every run of K words of the
    templates.  Their number is fixed by the list of notices, a few hundred."""
    rows = [(f"{label}/{i}", label, text) for label, texts in templates.items() for i, text in enumerate(texts)]
    table = spark.createDataFrame(rows, "template string, label string, text string")
    table = table.withColumn("w", words(F.col("text"))).withColumn("n_runs", F.size("w") - (K - 1))
    table = table.where("n_runs > 0").withColumn("t", F.explode(F.sequence(F.lit(0), F.col("n_runs") - 1)))
    return table.select(_run(F.col("w"), F.col("t"), K).alias("run"), "template", "label", "t", "n_runs")


def _phrase_at(array: Column, at: Column) -> Column:
    """The label of the base phrase that starts at a word, or null."""
    found = F.lit(None).cast("string")
    for phrase, label in PHRASES.items():
        here = None
        for i, word in enumerate(phrase.split()):
            same = F.get(array, at + i) == word
            here = same if here is None else here & same
        found = F.when(here, F.lit(label)).otherwise(found)
    return found


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text).

    doc_id, n_words; n_base, first_word, last_word, base_labels: the places of the base
    phrases; labels: base labels and those of verified template spans; score: 1 with a base
    phrase, else the largest covered share of a verified template, 0 without any; spans: an
    array of (label, first_word, last_word, coverage), by position.  Null and empty texts have
    no words.  Rows are kept apart by their place in the input, not by doc_id, which may
    be null or repeat.
    """
    split = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", words(F.col("text")).alias("w")
    )
    # Place -1 stands for the document itself; the others are its words.
    placed = split.select("row", "doc_id", "w", F.size("w").alias("n_words"), F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("p"))
    array, at = F.col("w"), F.col("p")
    marked = placed.select(
        "row", "p",
        F.when(at < 0, F.col("doc_id")).alias("doc_id"), F.when(at < 0, F.col("n_words")).alias("n_words"),
        F.when(at >= 0, _phrase_at(array, at)).alias("phrase"), F.when(at >= 0, _run(array, at, K)).alias("run"),
    )
    places = template_runs(docs.sparkSession, templates).groupBy("run").agg(
        F.collect_list(F.struct("template", "label", "n_runs", "t")).alias("places")
    )
    hits = marked.join(F.broadcast(places), "run", "left").where("p < 0 or phrase is not null or places is not null")
    # A document and its phrases are entries without a template, on a diagonal of their own.
    own = F.struct(
        F.lit(None).cast("string").alias("template"), F.lit(None).cast("string").alias("label"),
        F.lit(None).cast("int").alias("n_runs"), F.col("p").alias("t"),
    )
    nothing = F.array().cast("array<struct<template:string,label:string,n_runs:int,t:int>>")
    entries = F.concat(F.when((F.col("p") < 0) | F.col("phrase").isNotNull(), F.array(own)).otherwise(nothing), F.coalesce("places", nothing))
    hits = hits.select("row", "p", "doc_id", "n_words", "phrase", F.explode(entries).alias("e"))
    hits = hits.select("row", "p", "doc_id", "n_words", F.when(F.col("e.template").isNull(), F.col("phrase")).alias("phrase"), "e.*")
    votes = hits.groupBy("row", "template", "label", "n_runs", (F.col("p") - F.col("t")).alias("diagonal")).agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        *_phrase_summary(), F.min("p").alias("from_p"), F.max("p").alias("to_p"),
        F.collect_set(F.when(F.col("template").isNotNull(), F.col("t"))).alias("covered"),
    )
    in_order = Window.partitionBy("row", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(in_order)
    votes = votes.withColumn("breaks", F.when(gap <= DRIFT, 0).otherwise(1))
    votes = votes.withColumn("island", F.sum("breaks").over(in_order))
    votes = _verified(votes)
    overlaps = Window.partitionBy("row", "template").orderBy("span.first_word", "span.last_word")
    reached = F.max("span.last_word").over(overlaps.rowsBetween(Window.unboundedPreceding, -1))
    votes = votes.withColumn("apart", F.when(F.col("span.first_word") <= reached, 0).otherwise(1))
    votes = votes.withColumn("stretch", F.sum("apart").over(overlaps.rowsBetween(Window.unboundedPreceding, 0)))
    best = F.max(F.when(F.col("span").isNotNull(), F.struct("span.coverage", (F.col("span.first_word") - F.col("span.last_word")).alias("size"), "span")))
    spans = votes.groupBy("row", "template", F.when(F.col("span").isNotNull(), F.col("stretch"))).agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), *_phrase_summary(again=True), best["span"].alias("span")
    )
    found = spans.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), *_phrase_summary(again=True),
        F.sort_array(F.collect_list("span")).alias("spans"),
    )
    base = F.filter(F.array(*[F.when(F.col(f"has_{label}") > 0, F.lit(label)) for label in sorted(set(PHRASES.values()))]), lambda x: x.isNotNull())
    every = F.array_sort(F.array_distinct(F.concat(base, F.col("spans.label"))))
    best = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("spans.coverage"), F.lit(0.0)))
    return found.select(
        "doc_id", F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"), F.col("n_base").cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"), best.alias("score"), "spans",
    )


def _verified(votes: DataFrame) -> DataFrame:
    """Add ``span`` to the votes: (first_word, last_word, label, coverage) of the diagonal, or of the
    stretch of its island that begins with it where that covers more; null where neither covers enough.

    Runs on diagonals at most a template's length apart lie within about twice its length, so a
    stretch needs no test of its size and no more diagonals than that.
    """
    reach = F.col("diagonal") / (F.col("n_runs") + DRIFT)
    stretch = Window.partitionBy("row", "template", "island").orderBy(reach).rangeBetween(0, 1)
    votes = votes.withColumn("together", F.size(F.array_distinct(F.flatten(F.collect_list("covered").over(stretch)))))
    votes = votes.withColumn("last_p", F.max("to_p").over(stretch)).withColumn("first_p", F.min("from_p").over(stretch))
    alone = F.size("covered") >= F.col("together")
    covered = F.col("together") / F.col("n_runs")
    span = F.struct(
        F.when(alone, F.col("from_p")).otherwise(F.col("first_p")).alias("first_word"),
        (F.when(alone, F.col("to_p")).otherwise(F.col("last_p")) + K - 1).alias("last_word"), "label", covered.alias("coverage"),
    )
    return votes.withColumn("span", F.when(F.col("template").isNotNull() & (covered >= COVERAGE), span))


def _phrase_summary(again: bool = False) -> list[Column]:
    """Number and ends of the phrases, and how often each label occurs; ``again``: of summaries."""
    labels = sorted(set(PHRASES.values()))
    if again:
        return [
            F.sum("n_base").alias("n_base"), F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"),
            *[F.max(f"has_{label}").alias(f"has_{label}") for label in labels],
        ]
    at = F.when(F.col("phrase").isNotNull(), F.col("p"))
    return [
        F.count("phrase").alias("n_base"), F.min(at).alias("first_word"), F.max(at).alias("last_word"),
        *[F.max((F.col("phrase") == label).cast("int")).alias(f"has_{label}") for label in labels],
    ]
