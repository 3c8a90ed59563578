"""License phrases and notices in texts, by votes on the diagonals where word k-grams meet templates."""

from __future__ import annotations

import re
import string
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labtide.llm.staging import body, literal_rows, staged

K = 2
SLACK = 3
COVER = 0.6
DRIFT = 4
MASK = 62
LONG_WORD = 5
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

# Openings of well-known public license notices.
NOTICES = [
    (
        "mit-notice",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "apache-notice",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at",
    ),
    (
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation",
    ),
    (
        "bsd-notice",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    (
        "cc-by-notice",
        "This work is licensed under a Creative Commons Attribution International License",
    ),
]


def words_of(text: Column, plain: bool = False) -> Column:
    """Words of a text with A-Z lower-cased: runs of ASCII letters and digits and of all characters beyond ASCII.

    With ``plain`` only words of ASCII need be right. All letters may then be lower-cased, which is faster: of those beyond
    ASCII the Kelvin sign alone becomes an ASCII letter.
    """
    whole = F.coalesce(text, F.lit(""))
    same = ~F.contains(whole, F.lit("\u212a")) if plain else F.octet_length(whole) == F.length(whole)
    low = F.when(same, F.lower(whole)).otherwise(F.translate(whole, string.ascii_uppercase, string.ascii_lowercase))
    parts = F.split(low, SEPARATORS)
    first = (F.get(parts, F.lit(0)) == "").cast("int")
    last = ((F.element_at(parts, -1) == "") & (F.size(parts) > 1)).cast("int")
    return F.slice(parts, first + 1, F.greatest(F.size(parts) - first - last, F.lit(0)))


def _grams(rows: DataFrame, keep: Sequence[str], place: str, singles: bool, firsts: Sequence[str] | None = None) -> DataFrame:
    """A row for each word k-gram of ``words``: its hash, its words and where it begins.

    With ``singles`` there are rows for single words as well, whose second word is empty. With ``firsts`` only grams that
    begin with one of these words are made.
    """
    spread = rows.select(*keep, "words", F.posexplode("words").alias(place, "w1"))
    if firsts is not None:
        spread = spread.where(F.col("w1").isin([*firsts]))
    second = F.get("words", F.col(place) + 1)
    if singles:
        spread = spread.withColumn("w2", F.explode(F.array(second, F.lit(""))))
    else:
        spread = spread.withColumn("w2", second)
    return spread.where("w2 is not null").select(*keep, place, "w1", "w2", F.xxhash64("w1", "w2").alias("gram"))


def template_grams(spark: SparkSession, phrases: Sequence[tuple[str, str]], notices: Sequence[tuple[str, str]]) -> DataFrame:
    """Positions of the templates' k-grams. Every gram of a phrase votes; of a notice, those with a word that is not short.

    A template of one word has that word as its only gram. Templates without words are refused.
    """
    rows = [(i, label, text, i < len(phrases)) for i, (label, text) in enumerate([*phrases, *notices])]
    bare = [label for _, label, text, _ in rows if not re.sub(SEPARATORS, "", text)]
    if bare:
        raise ValueError(f"templates without words: {bare}")
    templates = literal_rows(spark, rows, ["template", "label", "text", "exact"]).withColumn("words", words_of(F.col("text")))
    templates = templates.withColumn("n", F.size("words"))
    grams = _grams(templates, ["template", "label", "exact", "n"], "place", True)
    grams = grams.where((F.col("w2") != "") == (F.col("n") >= K))
    long = F.greatest(F.length("w1"), F.length("w2")) >= LONG_WORD
    grams = grams.where(F.col("exact") | long)
    votes = Window.partitionBy("template")
    return grams.withColumn("grams", F.count("*").over(votes))


def _spans(docs: DataFrame, grams: DataFrame, slack: int, cover: float) -> DataFrame:
    """Accepted spans: label, exact, start, end (word numbers, end not included) and the share of grams found.

    The template places that a diagonal meets are kept as bits, so that merged diagonals count every place once.
    """
    shape = grams.agg(F.max("place").alias("last"), F.coalesce(F.min("n") < K, F.lit(False)).alias("singles")).first()
    masks = [f"mask{i}" for i in range((shape["last"] or 0) // MASK + 1)]
    firsts = sorted(r["w1"] for r in grams.select("w1").distinct().collect())
    plain = all(r["w2"].isascii() for r in grams.select("w2").distinct().collect()) and "".join(firsts).isascii()
    rows = docs.select("doc_id", body().alias("body"), words_of(F.col("text"), plain).alias("words"))
    # Words that begin no gram of a template are passed over before anything is hashed.
    met = _grams(rows, ["doc_id", "body"], "at", bool(shape["singles"]), firsts).join(
        grams.withColumnsRenamed({"w1": "t1", "w2": "t2"}), "gram"
    )
    met = met.where("w1 = t1 and w2 = t2").withColumn("diagonal", F.col("at") - F.col("place"))
    key = ["doc_id", "body", "template", "label", "exact", "n", "grams"]
    bit = F.expr(f"shiftleft(1L, place % {MASK})")
    places = [F.bit_or(F.when(F.floor(F.col("place") / MASK) == i, bit).otherwise(F.lit(0).cast("bigint"))).alias(m) for i, m in enumerate(masks)]
    votes = reduce(lambda a, b: a + b, [F.bit_count(m) for m in masks]).alias("votes")
    lines = met.groupBy(*key, "diagonal").agg(*places, F.min("at").alias("first"), F.max("at").alias("last")).select("*", votes)
    lines = lines.where("votes = grams or (not exact and votes > 1)")
    order = Window.partitionBy("doc_id", "body", "template").orderBy("diagonal")
    breaks = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > slack) | F.col("exact"), F.lit(True))
    lines = lines.withColumn("run", F.sum(breaks.cast("int")).over(order))
    # Of a run of neighbouring diagonals, those close to its strongest one are one span.
    strongest = Window.partitionBy("doc_id", "body", "template", "run").orderBy(F.desc("votes"), "diagonal")
    lines = lines.withColumn("peak", F.first("diagonal").over(strongest))
    lines = lines.where(F.abs(F.col("diagonal") - F.col("peak")) <= F.greatest(F.lit(slack), F.expr(f"n div {DRIFT}")))
    spans = lines.groupBy(*key, "run").agg(
        *[F.bit_or(m).alias(m) for m in masks], F.min("first").alias("start"), (F.max("last") + F.least(F.lit(K), F.first("n"))).alias("end")
    )
    spans = spans.withColumn("share", reduce(lambda a, b: a + b, [F.bit_count(m) for m in masks]) / F.col("grams"))
    return spans.where(F.col("exact") | ((F.col("share") >= cover) & (F.col("end") - F.col("start") <= 2 * F.col("n"))))


def license_spans(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    notices: Sequence[tuple[str, str]] = NOTICES,
    slack: int = SLACK,
    cover: float = COVER,
) -> DataFrame:
    """doc_id, body, label, exact, start, end and share of each license span in ``docs`` (doc_id, text).

    All word 2-grams of the documents are joined with the templates' positions by hash and words. Votes are counted per
    document, template and diagonal (place in the text less place in the template). A phrase is found where one diagonal
    has all its grams; a phrase of one word is found by that word. A notice may have gained or lost words: neighbouring
    diagonals within ``slack`` are merged around the strongest, and the merged span is verified: its words are
    those of the template at ``cover`` of the template's grams, each counted once however often the text repeats it, and it
    is at most twice as long as the notice. The templates are a small parameter.
    """
    grams = staged(template_grams(docs.sparkSession, phrases, notices).coalesce(1), "grams")
    return _spans(docs, grams, slack, cover).select("doc_id", "body", "label", "exact", "start", "end", "share")


def scan(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score.

    The score is the greatest share of a template's grams in an accepted span, 1 for a base phrase and 0 without a span.
    Null and empty texts have no words and no spans. Rows are told apart by doc_id and text, so repeated rows and null
    ids get their own results.
    """
    spans = license_spans(docs, **options)
    base = F.col("exact")

    def joined(condition: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")

    found = spans.groupBy("doc_id", "body").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("bigint").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.lit(True)).alias("labels"),
        F.max("share").alias("score"),
    )
    found = found.withColumnsRenamed({"doc_id": "__id", "body": "__body"})
    rows = docs.select("doc_id", body().alias("body"), F.size(words_of(F.col("text"), plain=True)).cast("bigint").alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("body").eqNullSafe(F.col("__body"))
    return rows.join(found, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
