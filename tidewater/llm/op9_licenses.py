"""License scans: an exact set-similarity join of text blocks and license templates (DataFrame functions only).

A block is a run of consecutive words, as long as the template and, for long ones, a quarter longer; line
ends and comment marks are no words, so a wrapped notice is a block like any other.  A block meets a
template if it holds at least ``CONTAINMENT`` of its distinct words (all, of a template of fewer than
``SHORT``), the ones that tell the license from others of like wording (``TELLING``) among them, and none
that makes it another license (``OTHERS``).

The join.  Texts are cut into overlapping windows twice as long as the longest block, at every such length,
so that each block lies in a window.  Words have a global order, by how often they stand in all texts,
rarest first.  A template of m words of which c are needed has a prefix, its m - c + 1 rarest: a window
with a block that meets it holds one of them at least, so windows are joined with prefix words only.  Of
the pairs found go those whose window holds too few of the templates' words (length), or whose first
common word stands too far back in the template or among the window's own ordered words for c common
ones (position).  What is left is verified block by block.

Beside the join stands the base scan: the places where the words of a known phrase stand consecutively.

Defined cases: null text is empty; an empty text has no words and meets nothing; rows alike in doc_id
and text have like results, each its own row; an empty table gives an empty result; further columns are
ignored.  The templates are a fixed list in the program, so what they become can be broadcast; nothing
of the documents is.  A window is part of one row, and nothing is shuffled before a template is met.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_of, lower_ascii

#: What stands between words, once A-Z are lower-cased; words before that.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RAW_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
CONTAINMENT = 0.8
#: (label, notice)
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Released under the BSD License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)
#: What a block must hold besides: the words that tell a license from others of like wording.
TELLING = {"apache": {"apache"}, "bsd": {"bsd", "redistribution"}, "cc-by": {"cc", "attribution"}, "cc-by-nc": {"nc"}, "cc-by-sa": {"sa"}, "gpl": {"general"}, "mit": {"mit", "hereby"}, "mpl": {"mozilla"}}
#: What makes it another license: cc-by isn't cc-by-nc written out.
OTHERS = {"cc-by": ("noncommercial", "sharealike", "noderivatives", "noderivs"), "gpl": ("lesser", "affero")}
#: Templates of fewer words must be held whole, in a block of their own length.
SHORT = 12


def words(text: str) -> list[str]:
    """As the operator takes them, of a template."""
    import re

    return [w for w in re.split(BETWEEN, "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]


def needed(m: int, containment: float) -> int:
    """How many of a template's m words a block must hold."""
    return m if m < SHORT else max(1, math.ceil(round(containment * m, 9)))


def span(said: list[str]) -> int:
    """How many words a block has for a template of the words ``said``."""
    return len(said) + (len(said) // 4 if len(set(said)) >= SHORT else 0)


def text_words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), BETWEEN), "")


def rarity(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each of the templates' words stands in all texts: a row for each word."""
    one = F.explode(F.filter(text_words(F.col("text")), lambda w: w.isin(vocabulary))).alias("word")
    found = columns_of(docs, "text").select(one).groupBy("word").count().collect()
    return dict.fromkeys(vocabulary, 0) | {r["word"]: r["count"] for r in found}


def windows(docs: DataFrame, rare: list[str], length: int) -> DataFrame:
    """(doc_id, text_hash, words) of the texts that hold one of the words ``rare``: runs of twice ``length``
    words, one from every ``length``-th word on."""
    d = columns_of(docs, "doc_id", "text").where(F.col("text").rlike("(?i)" + "|".join(rare)))
    # out of an explode, the words are made once for all that reads them
    d = d.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(F.array(text_words(F.col("text")))).alias("all"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - length - 1, F.lit(0)), F.lit(length))
    return d.select("doc_id", "text_hash", F.explode(F.transform(starts, lambda a: F.slice("all", a + 1, 2 * length))).alias("words"))


def most_held(words: Column, own: Column, telling: Column, others: Column, length: Column) -> Column:
    """Of all blocks of ``length`` words in a window, the most distinct words of ``own`` that one holds
    which has all ``telling`` words and none of the ``others``."""

    def held(i: Column) -> Column:
        block = lambda: F.slice(words, i + 1, length)
        fits = (F.size(F.array_except(telling, block())) == 0) & ~F.arrays_overlap(others, block())
        return F.when(F.array_contains(own, F.get(words, i)) & fits, F.size(F.array_intersect(block(), own))).otherwise(0)

    return F.array_max(F.transform(F.sequence(F.lit(0), F.size(words) - 1), held))


def matches(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, text_hash, label, containment): the templates that some block of a text meets."""
    spark = docs.sparkSession
    said = [words(t) for _, t in templates]
    vocabulary = sorted(set().union(*said))
    count = rarity(docs, vocabulary)
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (count[w], w)))}
    rows, prefixes = [], []
    for i, ((label, _), all_words) in enumerate(zip(templates, said, strict=True)):
        own = sorted(set(all_words), key=order.get)
        c = needed(len(own), containment)
        rows.append((i, label, own, sorted(TELLING.get(label, set()) & set(own)), list(OTHERS.get(label, ())), span(all_words), len(own), c))
        prefixes += [(i, w, at) for at, w in enumerate(own[: len(own) - c + 1])]
    given = F.broadcast(spark.createDataFrame(rows, "template int, label string, own array<string>, telling array<string>, others array<string>, length int, m int, c int"))
    prefix = F.broadcast(spark.createDataFrame(prefixes, "template int, word string, at int"))
    rare = sorted({w for _, w, _ in prefixes})
    cut = windows(docs, rare, max(map(span, said))).where(F.exists("words", lambda w: w.isin(rare)))
    # a window's words of the templates, in the global order
    ranks = F.create_map(*[x for w, i in order.items() for x in (F.lit(w), F.lit(i))])
    some = F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary)))
    known = F.array_sort(F.transform(some, lambda w: F.struct(F.element_at(ranks, w).alias("rank"), w.alias("word"))))
    cut = cut.select("doc_id", "text_hash", "words", F.explode(F.array(F.transform(known, lambda x: x["word"]))).alias("known"))
    here = F.filter(F.transform("known", lambda w, i: F.struct(i.alias("place"), w.alias("word"))), lambda x: x["word"].isin(rare))
    pairs = cut.select("doc_id", "text_hash", "words", "known", F.inline(here)).join(prefix, "word").join(given, "template")
    n = F.size("known")
    # of a template's prefix words in a window, the first stands for the pair: none before it is there
    first = ~F.arrays_overlap(F.slice("own", F.lit(1), F.col("at")), "known")
    left = pairs.where(first & (n >= F.col("c")) & (F.col("m") - F.col("at") >= F.col("c")) & (n - F.col("place") >= F.col("c")))
    best = most_held(F.col("words"), F.col("own"), F.col("telling"), F.col("others"), F.col("length"))
    met = left.select("doc_id", "text_hash", "label", "m", "c", F.explode(F.array(best)).alias("held")).where(F.col("held") >= F.col("c"))
    return met.select("doc_id", "text_hash", "label", (F.col("held") / F.col("m")).alias("containment"))


def places(ws: Column, phrase: str) -> Column:
    """Where the phrase's words stand consecutively among ``ws``."""
    parts = words(phrase)
    last = F.size(ws) - len(parts)
    at = lambda i, k: F.get(ws, i + k) == parts[k]

    def here(i: Column) -> Column:
        out = at(i, 0)
        for k in range(1, len(parts)):
            out &= at(i, k)
        return out

    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)).otherwise(F.array().cast("array<int>"))


def scanned(docs: DataFrame, phrases: tuple[tuple[str, str], ...] = PHRASES) -> DataFrame:
    """(doc_id, text_hash, n_words, n_base, first_word, last_word, base): the base scan of each row."""
    d = columns_of(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    any_phrase = "|".join(RAW_BETWEEN.join(words(p)) for p, _ in phrases)
    holds = F.col("text").rlike(f"(?i){any_phrase}")  # may hold one, which the words decide
    ws = text_words(F.col("text"))
    all_places = F.transform(F.array(ws), lambda w: F.array(*[places(w, p) for p, _ in phrases]))[0]  # as an element, the words are made once
    found = F.when(holds, all_places).otherwise(F.array().cast("array<array<int>>"))
    n_words = F.regexp_count("text", F.lit(RAW_WORD)).cast("long")
    d = d.select("doc_id", "text_hash", n_words.alias("n_words"), F.explode(F.array(found)).alias("found"))
    everywhere = F.flatten("found")
    hit = [F.when(F.size(F.coalesce(F.get("found", F.lit(i)), F.array().cast("array<int>"))) > 0, F.lit(label)) for i, (_, label) in enumerate(phrases)]
    return d.select(
        "doc_id",
        "text_hash",
        "n_words",
        F.size(everywhere).cast("long").alias("n_base"),
        F.array_min(everywhere).cast("long").alias("first_word"),
        F.array_max(everywhere).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*hit)))).alias("base"),
    )


def licenses(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, containment: float = CONTAINMENT) -> DataFrame:
    """A row for each document: the base scan, the labels of both, and a score: 1 where a base phrase
    stands, else the highest containment of a template that a block meets, else 0."""
    met = matches(docs, templates, containment)
    by_text = met.groupBy("doc_id", "text_hash").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    base, m = scanned(docs, phrases).alias("base"), by_text.alias("m")
    both = base.join(m, F.col("base.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("base.text_hash") == F.col("m.text_hash")), "left")
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union(F.col("base.base"), F.coalesce(F.col("m.more"), none)))
    return both.select(
        "base.doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base.base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.col("m.best"), F.lit(0.0))).alias("score"),
    )
