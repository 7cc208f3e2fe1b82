"""Licence scan: base phrases plus an exact containment join of text blocks with licence templates
(DataFrame and SQL functions only).

A block is a line, a paragraph (lines up to one without words) or a window: `reach` words in a row wherever
lines break, where reach is SLACK times the template's running words. A block meets a template when it holds at
least THRESHOLD of the template's distinct words. The join is exact: words are ordered by their frequency over
the corpus, rarest first; a block that meets a template must hold one of the template's first n - needed + 1
words (prefix filter), must have at least `needed` distinct words (length filter), and the first
template word it holds must leave enough words behind it (positional filter). Only blocks that pass
are verified. Paragraphs and windows are made only where the whole document passes the same test; pieces of two
reaches, one reach apart, hold every window. The template side is a literal table of a few dozen words, so it is
broadcast.

Words are runs of ASCII digits, letters (A-Z lowered) and all characters above ASCII. Null text counts
as empty: no words, no labels, score 0. What a row gets depends on its text alone (labels are joined by the MD5 of the
text), so rows with a null id or a shared one keep their own labels. An empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import text_of

THRESHOLD = 0.9
SLACK = 1.5              # words of a window for each running word of the template

# Base phrases and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Well-known licence notices, one block each.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
]

NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NON_WORD_IN_LINE = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"


def template_words(text: str) -> list[str]:
    return sorted({w for w in re.split(NON_WORD, text.lower()) if w})


def window_words(text: str) -> int:
    return math.ceil(SLACK * sum(1 for w in re.split(NON_WORD, text.lower()) if w))


def lowered(text_col: str = "text") -> Column:
    """The text (null: empty) in lower case. The Kelvin sign is the one other character whose lower case is an ASCII
    letter; it is kept out, so that only A-Z give a-z."""
    return F.lower(F.replace(text_of(text_col), F.lit("\u212a"), F.lit("\ufffd")))


def _spaces(c: Column) -> Column:
    return F.octet_length(c) - F.octet_length(F.replace(c, F.lit(" "), F.lit("")))


def flat_words(text_col: str = "text") -> Column:
    """' w1 w2 ... ' with single spaces; '' without words."""
    t = F.trim(F.regexp_replace(lowered(text_col), NON_WORD, " "))
    return F.when(t == "", "").otherwise(F.concat(F.lit(" "), t, F.lit(" ")))


def word_frequencies(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> dict[str, int]:
    """Number of documents that hold each word of the (bounded) template vocabulary."""
    vocab = F.array(*[F.lit(w) for w in vocabulary])
    held = docs.select(flat_words(text_col).alias("flat")).select(
        F.explode(F.array_intersect(vocab, F.split("flat", " "))).alias("word"))
    return {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def _template_table(docs: DataFrame, templates: list[tuple[str, str]] | None, threshold: float, text_col: str) -> tuple[DataFrame, Column]:
    """One row per prefix word of a template, and all prefix words."""
    templates = TEMPLATES if templates is None else templates
    sets = [template_words(t) for _, t in templates]
    freq = word_frequencies(docs, sorted({w for s in sets for w in s}), text_col)
    rows = []
    for k, words in enumerate(sets):
        words = sorted(words, key=lambda w: (freq.get(w, 0), w))
        needed = max(1, math.ceil(threshold * len(words) - 1e-9))
        for pos in range(len(words) - needed + 1):
            rows.append((k, templates[k][0], words, needed, window_words(templates[k][1]), pos, words[pos]))
    table = docs.sparkSession.createDataFrame(
        rows, "template int, label string, words array<string>, needed int, reach int, pos int, word string")
    return table, F.array(*[F.lit(w) for w in sorted({r[6] for r in rows})])


def _met(blocks: DataFrame, table: DataFrame, prefix: Column) -> DataFrame:
    """Every (block, template) whose containment reaches the threshold; `block` holds the distinct words."""
    held = blocks.withColumn("hits", F.array_intersect(prefix, "block")).where(F.size("hits") > 0)
    pairs = held.withColumn("word", F.explode("hits")).drop("hits").join(F.broadcast(table), "word")
    pairs = pairs.where(F.size("block") >= F.col("needed"))                                     # length
    return pairs.withColumn("common", F.array_intersect("words", "block")).where(
        (F.element_at("common", 1) == F.col("word"))                                             # once per pair, and
        & (F.size("words") - F.col("pos") >= F.col("needed"))                                    # position
        & (F.size("common") >= F.col("needed")))                                                 # verified


def _by_line(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Lower-case text whose words are parted by spaces and line ends."""
    return docs.select(F.col(id_col).alias("doc_id"), F.regexp_replace(lowered(text_col), NON_WORD_IN_LINE, " ").alias("body"))


def _lines_met(docs: DataFrame, table: DataFrame, prefix: Column, id_col: str, text_col: str) -> DataFrame:
    lines = _by_line(docs, id_col, text_col).select("doc_id", F.posexplode(F.split("body", "\n")).alias("line", "block"))
    pairs = _met(lines.select("doc_id", "line", F.array_distinct(F.split(F.trim("block"), " ")).alias("block")), table, prefix)
    return pairs.select("doc_id", "line", "template", "label", (F.size("common") / F.size("words")).alias("containment"))


def _wrapped_met(docs: DataFrame, table: DataFrame, prefix: Column, id_col: str, text_col: str) -> DataFrame:
    """Per document and template the largest containment of a paragraph or a window, where it reaches the threshold."""
    split = lambda c: F.split(F.trim(c), "[ \n]+")
    whole = _by_line(docs, id_col, text_col).select("doc_id", "body", F.array_distinct(split(F.col("body"))).alias("block"))
    near = _met(whole, table, prefix).select("doc_id", "body", "template", "label", "words", "needed", "reach")
    shared = lambda c: F.size(F.array_intersect("words", c))
    reach = F.col("reach")
    paragraphs = near.select("doc_id", "template", "label", "words", "needed", F.explode(F.split("body", "\n *(?=\n)")).alias("block"))
    paragraphs = paragraphs.withColumn("most", shared(split(F.col("block"))))
    run = split(F.translate("body", "\n", " "))
    pieces = near.withColumn("run", run).withColumn("piece", F.explode(F.transform(
        F.sequence(F.lit(0), F.floor((F.size("run") - 1) / reach).cast("int")),
        lambda k: F.slice(F.col("run"), k * reach + 1, 2 * reach))))
    pieces = pieces.select("doc_id", "template", "label", "words", "needed", "reach", "piece").where(shared("piece") >= F.col("needed"))
    windows = pieces.withColumn("most", F.array_max(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("piece") - reach + 1, F.lit(1))),
        lambda i: shared(F.slice("piece", i, reach)))))
    columns = ["doc_id", "template", "label", "words", "needed", "most"]
    return paragraphs.select(columns).unionAll(windows.select(columns)).where(F.col("most") >= F.col("needed")).select(
        "doc_id", "template", "label", (F.col("most") / F.size("words")).alias("containment"))


def matching_blocks(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every (document, line, template) whose containment reaches the threshold."""
    table, prefix = _template_table(docs, templates, threshold, text_col)
    return _lines_met(docs, table, prefix, id_col, text_col)


def matching_documents(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every (document, template) that a paragraph or a window meets, so also every one that a line meets."""
    table, prefix = _template_table(docs, templates, threshold, text_col)
    met = _wrapped_met(docs, table, prefix, id_col, text_col)
    return met.groupBy("doc_id", "template", "label").agg(F.max("containment").alias("containment"))


def _base(flat: Column, n_words: Column) -> dict[str, Column]:
    found, firsts, lasts, counts, labels = [], [], [], [], []
    for phrase, label in PHRASES:
        pat, size = f" {phrase} ", len(phrase.split())
        at = F.instr(flat, pat)
        has = at > 0
        back = F.instr(F.reverse(flat), pat[::-1])
        firsts.append(F.when(has, _spaces(F.substring(flat, F.lit(1), at)) - 1))
        lasts.append(F.when(has, n_words - size - (_spaces(F.substring(F.reverse(flat), F.lit(1), back)) - 1)))
        counts.append(F.when(has, F.regexp_count(flat, F.lit(f" {phrase}(?= )"))).otherwise(0))
        labels.append(F.when(has, label))
        found.append(has)
    return {"n_base": sum(counts, F.lit(0)).cast("long"), "first_word": F.least(*firsts).cast("long"),
            "last_word": F.greatest(*lasts).cast("long"),
            "base": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels))))}


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: word count, places of base phrases, labels of both kinds, score (1 with a base
    phrase, else the largest containment of a template that is met, else 0)."""
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.md5(text_of(text_col).cast("binary")).alias("text_key"), F.col(text_col).alias("text"))
    flat = keyed.select("doc_id", "text_key", flat_words().alias("flat"))
    n_words = F.when(F.col("flat") == "", 0).otherwise(_spaces(F.col("flat")) - 1).cast("long")
    counted = flat.select("doc_id", "text_key", "flat", n_words.alias("n_words"))
    base = counted.select("doc_id", "text_key", "n_words", *[c.alias(n) for n, c in _base(F.col("flat"), F.col("n_words")).items()])
    met = matching_documents(keyed, templates, threshold, "text_key").groupBy(F.col("doc_id").alias("text_key")).agg(
        F.collect_set("label").alias("added"), F.max("containment").alias("most"))     # at most the template labels
    out = base.join(met, "text_key", "left")
    added = F.coalesce("added", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.concat_ws(",", "base").alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union("base", added))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"))
