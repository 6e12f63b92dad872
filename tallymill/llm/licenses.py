"""License scans by an exact set-similarity join.

A text is cut into blocks: sentences, or what stands between blank lines.  A block
and a template are sets of words; a block matches where it holds at least
``THRESHOLD`` of the template's words.  Words are ordered by how many blocks of
the whole table hold them, rarest first.  With an overlap of ``need`` words
demanded, one of the first ``|T| - need + 1`` words of the template must be among
the first ``|B| - need + 1`` words of the block (prefix filter), the block must
have ``need`` words (length filter), and the words behind the first common one
must still suffice on both sides (positional filter).  Pairs that pass are
verified by their exact overlap, so every matching block is found and no other.

Beside it, ``phrases`` are sought word by word.  Everything is DataFrame functions;
texts are read once and never shuffled.

A null text is an empty one: no words, no labels, score 0.  Repeated rows and equal
or null ids each give their own row.  A very long text is cut into blocks like any
other; a sentence without an end is one long block.  Templates that tie, or one
block under several templates, each give their label.  An empty table gives no
rows.  Further columns are not read; the columns of the result are fixed.
"""

import json
import re
from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from tallymill.session import materialise

THRESHOLD = 0.9
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SENTENCE_END = r"([.!?])[\x09-\x0D ]+"
_BLANK_LINE = r"\n[\x09-\x0D ]*\n"

# Phrases that count wherever they stand, and their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

# Sentences of public licenses and of the usual notices, and their labels.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is"
                   " distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
            " that the following conditions are met:"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights"
            " to this work."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
            " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
            " option) any later version."),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
            " associated documentation files, to deal in the Software without restriction"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def template_words(text):
    """Distinct words of a template, in plain Python."""
    lowered = text.translate(str.maketrans(_LETTERS, _LETTERS.lower()))
    return sorted(set(re.sub(BETWEEN_WORDS, " ", lowered).split()))


def needed(n_words, threshold):
    """Least overlap that reaches the threshold of a set of ``n_words``."""
    return next(k for k in range(n_words + 1) if k >= threshold * n_words)


def _spaced(lowered):
    """Words of a lower-cased text, one space between them."""
    return F.trim(F.regexp_replace(lowered, BETWEEN_WORDS, " "))


def _starts(words, phrase):
    """Word positions at which a phrase stands."""
    parts = phrase.split(" ")

    def stands(held):
        at = F.sequence(F.lit(0), F.greatest(F.size(held) - len(parts), F.lit(0)))
        return F.filter(at, lambda i: reduce(and_, [F.get(held, i + k) == part for k, part in enumerate(parts)]))

    # A one-element array names the words, which are thereby computed once.
    return F.get(F.transform(F.array(words), stands), 0)


def _documents(docs, templates, phrases, threshold, doc_id, text):
    """One written row per document: its numbers, and of each block with enough template
    words those words."""
    vocabulary = sorted({w for _, t in templates for w in template_words(t)})
    least = min((needed(len(template_words(t)), threshold) for _, t in templates), default=1)
    lowered = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.translate(F.coalesce(F.col(text), F.lit("")), _LETTERS, _LETTERS.lower()).alias("lowered"))
    blocks = F.split(F.regexp_replace("lowered", _SENTENCE_END, "$1\n\n"), _BLANK_LINE)
    cut = F.filter(F.transform(blocks, lambda b: F.split(_spaced(b), " ")), lambda words: words[0] != "")
    worded = lowered.withColumn("cut", cut)     # a cut never falls inside a word
    none = F.array().cast("array<int>")
    starts = [F.when(reduce(and_, [F.contains("lowered", F.lit(w)) for w in phrase.split(" ")]),
                     _starts(F.flatten("cut"), phrase)).otherwise(none) for phrase, _ in phrases]
    held = F.transform("cut", lambda words: F.array_distinct(F.filter(words, lambda w: w.isin(vocabulary))))
    found = worded.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.aggregate("cut", F.lit(0).cast("bigint"), lambda n, words: n + F.size(words)).alias("n_words"),
        F.array(*starts).cast("array<array<int>>").alias("starts"),
        F.filter(held, lambda words: F.size(words) >= least).alias("blocks"))
    places = F.flatten("starts")
    labels = F.array(*[F.when(F.size(F.get("starts", F.lit(i))) > 0, F.lit(label))
                       for i, (_, label) in enumerate(phrases)]).cast("array<string>")
    return materialise(found.select(
        "row", "doc_id", "n_words", F.size(places).cast("bigint").alias("n_base"),
        F.array_min(places).cast("bigint").alias("first_word"), F.array_max(places).cast("bigint").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(labels))).alias("base"), "blocks"), "license-blocks")


def _ranks(blocks, vocabulary):
    """Place of every template word, rarest first, by the number of blocks that hold it.

    One number per template word comes to the driver: as many as the templates have words.
    """
    counts = dict(blocks.select(F.explode("words").alias("word")).groupBy("word").count().collect())
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}


def _local(spark, rows, schema):
    """A small table that stands in the plan itself."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def matches(blocks, templates, threshold=THRESHOLD):
    """``row, block, template, label, overlap, share`` of all blocks that hold at least
    ``threshold`` of a template's words.

    ``blocks`` has ``row, block`` and ``words``, the distinct words of a block that some
    template has.  Templates and their prefixes are broadcast: their size is that of the
    ``templates`` given.
    """
    spark = blocks.sparkSession
    sets = [(label, template_words(text)) for label, text in templates]
    rank = _ranks(blocks, {w for _, words in sets for w in words})
    place = F.from_json(F.lit(json.dumps(rank)), "map<string,int>")
    ordered = blocks.select("row", "block", F.array_sort(F.transform("words", lambda w: place[w])).alias("b"))
    whole, prefixes = [], []
    for i, (label, words) in enumerate(sets):
        ranked, need = sorted(rank[w] for w in words), needed(len(words), threshold)
        whole.append({"template": i, "label": label, "t": ranked, "need": need})
        prefixes += [{"rank": r, "template": i, "i": at, "n_t": len(ranked), "need": need}
                     for at, r in enumerate(ranked[:len(ranked) - need + 1])]
    whole = _local(spark, whole, "template:int,label:string,t:array<int>,need:int")
    prefixes = _local(spark, prefixes, "rank:int,template:int,i:int,n_t:int,need:int")
    n_b = F.size("b")
    met = (ordered.select("row", "block", "b", F.posexplode("b").alias("j", "rank"))
           .join(F.broadcast(prefixes), "rank")
           .where((n_b >= F.col("need")) & (F.col("j") <= n_b - F.col("need"))
                  & (1 + F.least(F.col("n_t") - F.col("i") - 1, n_b - F.col("j") - 1) >= F.col("need")))
           .select("row", "block", "template", "b").distinct())
    overlap = F.size(F.array_intersect("b", "t"))
    return (met.join(F.broadcast(whole), "template").withColumn("overlap", overlap)
            .where(F.col("overlap") >= F.col("need"))
            .select("row", "block", "template", "label", "overlap", (F.col("overlap") / F.size("t")).alias("share")))


def scan(docs, templates=TEMPLATES, phrases=PHRASES, threshold=THRESHOLD, doc_id="doc_id", text="text"):
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score``.

    ``score`` is 1 where a phrase stands, else the largest share of a template that a block
    holds, if it reaches the threshold, else 0.
    """
    found = _documents(docs, templates, phrases, threshold, doc_id, text)
    blocks = found.select("row", F.posexplode("blocks").alias("block", "words"))
    per_row = matches(blocks, templates, threshold).groupBy("row").agg(
        F.collect_set("label").alias("more"), F.max("share").alias("share"))
    none = F.array().cast("array<string>")
    every = F.array_sort(F.array_union("base", F.coalesce("more", none)))
    return found.drop("blocks").join(per_row, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
