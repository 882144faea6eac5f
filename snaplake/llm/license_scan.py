"""License scans by diagonal voting.

Every rolling word k-gram of a document is joined by hash (and text) to the
places it has in license templates.  Hits of one copied passage share the
offset between document and template, their diagonal; an inserted or dropped
word moves to a neighbouring one.  Hits are ordered by diagonal, neighbouring
diagonals merged, and a merged span counts when it holds enough of the
template's words in a stretch about as long as the template.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import col, materialise
from snaplake.llm.quality_rules import _covered

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: (phrase, label): fixed values.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: (label, notice): fixed values, the usual notices and openings of public licenses.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
GRAM, COVERAGE, NEAR = 3, 0.8, 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(WORDS), F.lit(0))


def _grams(words: str, k: int) -> Column:
    """All rolling k-grams of a column of words, joined by a space."""
    at = F.sequence(F.lit(0), F.size(words) - k)
    return F.when(F.size(words) >= k, F.transform(
        at, lambda i: F.concat_ws(" ", *[F.get(F.col(words), i + j) for j in range(k)])))


def _places(words: str, phrase: str) -> Column:
    """Where the phrase's words stand one after the other."""
    wanted = phrase.split()
    def fits(x, i):
        found = x == wanted[0]
        for k, w in enumerate(wanted[1:], 1):
            found = found & (F.get(F.col(words), i + k) == w)
        return F.coalesce(found, F.lit(False))
    return F.filter(F.transform(words, lambda x, i: F.when(fits(x, i), i)), lambda i: i.isNotNull())


def spans(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, k: int = GRAM, coverage: float = COVERAGE,
          near: int = NEAR) -> DataFrame:
    """(doc_id, mark, template, label, first, last, share): verified spans of templates in ``docs`` (doc_id, mark, text)."""
    spark = docs.sparkSession
    texts = (spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)],
                                   "template int, label string, text string")
             .withColumn("words", words_of(F.col("text"))).select("template", "label", F.size("words").alias("size"), "words"))
    # as many rows as the templates have words; written once, so that the join knows that size and
    # broadcasts it below Catalyst's limit instead of shuffling every k-gram
    places = materialise(texts.select("template", "label", "size", F.posexplode(_grams("words", k)).alias("t_at", "t_gram"))
                         .withColumn("h", F.xxhash64("t_gram")), "license-places")
    grams = (docs.select("doc_id", "mark", words_of(F.col("text")).alias("words"))
             .select("doc_id", "mark", F.posexplode(_grams("words", k)).alias("at", "gram"))
             .withColumn("h", F.xxhash64("gram")))
    hits = (grams.join(places, "h").filter("gram = t_gram")
            .select("doc_id", "mark", "template", "label", "size", "at", "t_at", (F.col("at") - F.col("t_at")).alias("diagonal")))
    one = Window.partitionBy("doc_id", "mark", "template").orderBy("diagonal", "at")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(one) > near, F.lit(True))
    merged = (hits.withColumn("apart", apart.cast("int"))
              .withColumn("span", F.sum("apart").over(one.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy("doc_id", "mark", "template", "label", "size", "span")
              # the places of one template: bounded by its length
              .agg(F.min("at").alias("first"), (F.max("at") + k - 1).alias("last"), F.sort_array(F.collect_set("t_at")).alias("places")))
    held = _covered(F.col("places"), k)
    return (merged.withColumn("share", held / F.col("size"))
            .filter((F.col("share") >= coverage) & (F.col("last") - F.col("first") + 1 <= 2 * F.col("size")))
            .select("doc_id", "mark", "template", "label", "first", "last", "share"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: Sequence[tuple[str, str]] = PHRASES,
                 templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) for every row of ``docs``.

    ``spans`` are the verified template spans (label, first and last word,
    share of the template's words); ``score`` is the largest share, 0 without a
    span.  NULL and empty texts have no words, counts of 0, no labels.  NULL ids
    and repeated rows stay; a row's spans come from its own text.  Ties give one
    label once.  An empty table gives an empty result.
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"))
    found = (spans(rows, templates).groupBy("doc_id", "mark")
             # one entry per template and place; the spans of one text
             .agg(F.sort_array(F.collect_set(F.struct("label", "first", "last", "share"))).alias("spans")))
    found = materialise(found, "license-spans").withColumnsRenamed({"doc_id": "f_id", "mark": "f_mark"})
    base = rows.select("doc_id", "mark", words_of(F.col("text")).alias("words"))
    base = base.select("doc_id", "mark", F.size("words").cast("long").alias("n_words"),
                       *[_places("words", p).alias(f"p{i}") for i, (p, _) in enumerate(phrases)])
    every = F.concat(*[F.col(f"p{i}") for i in range(len(phrases))])
    named = F.filter(F.array(*[F.when(F.size(f"p{i}") > 0, label) for i, (_, label) in enumerate(phrases)]),
                     lambda x: x.isNotNull())
    base = base.select("doc_id", "mark", "n_words", F.size(every).cast("long").alias("n_base"),
                       F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
                       F.sort_array(F.array_distinct(named)).alias("base"))
    both = base.join(found, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("mark") == F.col("f_mark")), "left")
    own = F.coalesce(F.transform("spans", lambda s: s["label"]), F.array().cast("array<string>"))
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", own)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"), "spans")
