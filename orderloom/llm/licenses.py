"""License scan: exact containment join of license texts with blocks of the documents, in SQL functions.

A template is a license sentence. For a template of n words the blocks of a document are its runs of 2n
words that start at multiples of n (the last may be shorter), so that any n consecutive words lie in
one block. A template is in a block if the block has at least CONTAINMENT of its distinct words.

The words of all templates are ordered by their number of uses in all documents, rarest first. A block
that holds `need` of a template's words holds one of its `size - need + 1` rarest: the prefix filter joins
blocks and templates on those words alone. A block without `need` words of the order goes by its length;
a match whose places in both orders leave too few words after it goes by its position. What remains is
compared as sets. The order has one row for each template word, whatever the corpus.

Base places of a phrase are found apart from the join: where its words stand one after another.

Defined results: null and empty texts have no words, no labels and score 0; the score is 1 with a base
place, else the highest containment of a found block; a text that repeats with the same id has equal
rows; rows with a null id are told apart by their texts; with an empty table there are no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.columns import let
from orderloom.sources.staging import stage

CONTAINMENT = 0.8
# Long texts are compared in parts of so many words.
PART = 512
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


@dataclass(frozen=True)
class Template:
    label: str
    text: str

    @property
    def sequence(self) -> list[str]:
        return [w for w in re.split(SEPARATORS, self.text.lower()) if w]

    @property
    def words(self) -> set[str]:
        return set(self.sequence)

    @property
    def need(self) -> int:
        """How many of the distinct words a block must have."""
        return needed(len(self.words))


def needed(size: int, containment: float = CONTAINMENT) -> int:
    return math.ceil(round(size * containment, 9))


# Sentences of public licenses and their usual notices.
TEMPLATES = [
    Template("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of"
             " the GNU Affero General Public License as published by the Free Software Foundation"),
    Template("apache", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file'
             " except in compliance with the License"),
    Template("apache", "Unless required by applicable law or agreed to in writing, software distributed under the"
             ' License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either'
             " express or implied"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"
             " provided that the following conditions are met"),
    Template("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions"
             " and the following disclaimer"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-sa", "This work is licensed under the Creative Commons Attribution-ShareAlike License; additional"
             " terms may apply"),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or"
             " neighboring rights to this work"),
    Template("gpl", "This program is free software; you can redistribute it and/or modify it under the terms of the"
             " GNU General Public License as published by the Free Software Foundation; either version 2 of the"
             " License, or (at your option) any later version"),
    Template("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"
             " without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without"
             " fee is hereby granted, provided that the above copyright notice and this permission notice appear in"
             " all copies"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
             " and associated documentation files, to deal in the Software without restriction, including without"
             " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"
             " copies of the Software"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy"
             " of the MPL was not distributed with this file, You can obtain one"),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to"
             " copy, modify, publish, use, compile, sell, or distribute this software"),
]


def spaced(text: Column) -> Column:
    """Lower-case words, each with one space before and after it; one space if there are none."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), SEPARATORS, " ")


def words_of(text: Column) -> Column:
    """Words of a spaced text."""
    return F.filter(F.split(text, " "), lambda w: w != "")


def _phrase_starts(text: Column, phrase: str) -> Column:
    """Places (in words, from 0) where the phrase's words stand one after another in a spaced text."""
    parts = phrase.split(" ")
    no_places = F.array().cast("array<int>")

    def places(words: Column) -> Column:
        matches = lambda i: F.concat_ws(" ", F.slice(words, i + 1, len(parts))) == phrase
        firsts = F.filter(
            F.transform(words, lambda w, i: F.when(w == parts[0], i)), lambda i: i.isNotNull()
        )
        return F.filter(firsts, matches)

    return F.when(F.contains(text, F.lit(f" {phrase} ")), let(words_of(text), places)).otherwise(no_places)


def word_order(docs: DataFrame, templates: list[Template], text_column: str = "text") -> list[str]:
    """All words of the templates, those with the fewest uses in `docs` first; equal ones by themselves."""
    spark = docs.sparkSession
    vocabulary = sorted(set().union(*(t.words for t in templates)))
    listed = spark.range(1).select(F.explode(F.array(*map(F.lit, vocabulary))).alias("word"))
    uses = docs.select(F.explode(words_of(spaced(F.col(text_column)))).alias("word"))
    # One row for each word of the templates, on both sides.
    counted = uses.join(F.broadcast(listed), "word").groupBy("word").count().collect()
    many = {r["word"]: r["count"] for r in counted}
    return sorted(vocabulary, key=lambda w: (many.get(w, 0), w))


def license_blocks(docs: DataFrame, templates: list[Template], id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """Blocks that hold a template: doc_id, row (hash of the text), start, words, template, label, containment.

    start and words: the block's first word (from 0) and length in words; template: the place in `templates`.
    """
    spark = docs.sparkSession
    order = word_order(docs, templates, text_column)
    place = {w: k for k, w in enumerate(order)}
    lists = [sorted(place[w] for w in t.words) for t in templates]
    prefixes = spark.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(k).alias("template"),
                        F.lit(t.label).alias("label"),
                        F.lit(len(t.sequence)).alias("n"),
                        F.lit(t.need).alias("need"),
                        F.array(*map(F.lit, places)).alias("places"),
                    )
                    for k, (t, places) in enumerate(zip(templates, lists))
                ]
            )
        )
    )
    first = F.slice("places", F.lit(1), F.size("places") - F.col("need") + 1)
    prefixes = prefixes.select("*", F.posexplode(first).alias("at", "place"))
    rare = sorted({order[p] for t, places in zip(templates, lists) for p in places[: len(places) - t.need + 1]})
    text = spaced(F.col(text_column))
    # Words of the order with their places in the text, of texts that hold a prefix word at all.
    listed = F.create_map(*[F.lit(x) for w, k in place.items() for x in (w, k)])
    marked = lambda words: F.filter(
        F.transform(words, lambda w, i: F.struct(i.alias("at"), F.try_element_at(listed, w).alias("place"))),
        lambda m: m["place"].isNotNull(),
    )
    holds = docs.select(
        F.col(id_column).alias("doc_id"), F.xxhash64(F.col(text_column)).alias("row"), text.alias("text")
    ).where(F.rlike("text", F.lit(f" (?:{'|'.join(rare)}) ")))
    # Parts of a text by where a block starts, each with all words that such a block can reach.
    reach = PART + 2 * max(len(t.sequence) for t in templates)
    cut = holds.select("doc_id", "row", words_of(F.col("text")).alias("words")).select(
        "doc_id",
        "row",
        F.size("words").alias("n_words"),
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(PART)),
                lambda at: F.struct(at.alias("part"), F.slice("words", at + 1, reach).alias("words")),
            )
        ).alias("piece"),
    )
    parts = cut.select("doc_id", "row", "n_words", "piece.part", marked(F.col("piece.words")).alias("marks"))
    parts = stage(parts.where(F.size("marks") > 0), "license-marks")
    # Prefix filter: only a template's rarest words lead to its blocks, the two that a place lies in.
    matched = parts.withColumn("mark", F.explode("marks")).select(
        "*", (F.col("mark.at") + F.col("part")).alias("word_at"), "mark.place"
    )
    pairs = matched.drop("mark").join(F.broadcast(prefixes), "place")
    start = F.col("word_at") - F.col("word_at") % F.col("n")
    starts = F.when(start > 0, F.array(start - F.col("n"), start)).otherwise(F.array(start))
    found = pairs.withColumn("start", F.explode(starts)).where(
        (F.col("start") >= F.col("part")) & (F.col("start") < F.col("part") + PART)
    )
    from_, to = F.col("start") - F.col("part"), F.col("start") - F.col("part") + 2 * F.col("n")
    inside = F.filter("marks", lambda m: (m["at"] >= from_) & (m["at"] < to))
    found = found.withColumn("held", F.array_sort(F.array_distinct(F.transform(inside, lambda m: m["place"]))))
    size, many, here = F.size("places"), F.size("held"), F.array_position("held", F.col("place")).cast("int") - 1
    # Length filter, then positions: what may match before this word, itself, and what may match after it.
    within = F.least(F.col("at"), here) + 1 + F.least(size - F.col("at") - 1, many - here - 1)
    near = found.where((many >= F.col("need")) & (within >= F.col("need")))
    key = ["doc_id", "row", "template", "start"]
    once = near.dropDuplicates(key)
    shared = F.size(F.array_intersect("held", "places"))
    return once.where(shared >= F.col("need")).select(
        "doc_id",
        "row",
        "start",
        F.least(2 * F.col("n"), F.col("n_words") - F.col("start")).alias("words"),
        "template",
        "label",
        (shared / size).alias("containment"),
    )


def scan_documents(docs: DataFrame, templates: list[Template] | None = None) -> DataFrame:
    """Contract rows: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    found = license_blocks(docs, TEMPLATES if templates is None else templates)
    by_text = found.groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(
        F.collect_set("label").alias("_labels"), F.max("containment").alias("_most")
    )
    places = [_phrase_starts(F.col("text"), phrase) for phrase in PHRASES]
    names = [F.when(F.size(f"_p{k}") > 0, F.lit(label)) for k, label in enumerate(PHRASES.values())]
    rows = docs.select(
        "doc_id", F.xxhash64("text").alias("_hash"), spaced(F.col("text")).alias("text")
    ).select(
        "doc_id",
        "_hash",
        # Every word is followed by one space, and the text starts with one.
        (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) - 1).cast("long").alias("n_words"),
        *[p.alias(f"_p{k}") for k, p in enumerate(places)],
    )
    rows = rows.withColumn("_base", F.array_distinct(F.array_compact(F.array(*names)))).withColumn(
        "_at", F.concat(*[f"_p{k}" for k in range(len(PHRASES))])
    )
    joined = rows.join(
        by_text, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_row")), "left"
    )
    every = F.array_union("_base", F.coalesce("_labels", F.array().cast("array<string>")))
    return joined.select(
        "doc_id",
        "n_words",
        F.size("_at").cast("long").alias("n_base"),
        F.array_min("_at").cast("long").alias("first_word"),
        F.array_max("_at").cast("long").alias("last_word"),
        F.array_join(F.array_sort("_base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size("_at") > 0, F.lit(1.0)).otherwise(F.coalesce("_most", F.lit(0.0))).alias("score"),
    )
