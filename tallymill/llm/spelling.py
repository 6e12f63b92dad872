"""Spelling variants by a trie-node pair dictionary.

All words stand in one forward trie, by their beginnings, and in one trie of the
reversed words, by their ends.  Every node has an integer, so a word without its
``i``-th code point is the pair (node of the first ``i`` code points, node of what
follows the ``i``-th).  Two words that differ by one replaced code point share such
a pair; a word that lacks one code point of another has, split at that place, the
same pair.  Equal pairs are therefore exactly the words at distance one: nothing is
verified afterwards, and no text is compared.

Nodes are numbered without building a trie: in sorted order a word shares with all
words before it just what it shares with its predecessor, and what stands across the
border of two sorted parts is numbered from the parts' first and last words.

A group of one pair holds the words that differ in one place: as many as there are
letters, whatever the number of words.  It gives one row per member, not per pair
of members.  Numbers of near words add up, the best near word is a maximum.

A null text has no words; a null id is written ``null``.  A very long run of letters
is one word, with work in proportion to its length.  Repeated rows count again.  Of
near words that tie in number the least in code-point order is taken.  An empty
table gives no words.  Further columns are not read; the result's columns are fixed.
"""

import math

import pandas as pd
from pyspark.sql import functions as F

from tallymill.session import materialise

MIN_LENGTH = 7
MIN_COUNT = 2
FORM_FACTOR = 10
MUTATE_EVERY = 31
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTERS = r"[a-zÀ-ÿ]"
_PART_NODES = 2 ** 40       # node numbers of one part; parts are below 2^22


def corpus_words(docs, doc_id="doc_id", text="text"):
    """``word, n``: runs of letters of all texts, lower-cased, one code point deleted from every
    run whose checksum ``MUTATE_EVERY`` divides; words of ``MIN_LENGTH`` code points that occur
    ``MIN_COUNT`` times.

    A run below the length cannot become a word, so only longer ones leave the text.  Counting
    reduces in the map task: a word of a third of all texts moves once per task.
    """
    runs = F.regexp_extract_all(F.translate(text, _UPPER, _UPPER.lower()),
                                F.lit(f"{_LETTERS}{{{MIN_LENGTH},}}"), F.lit(0))
    name = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit(":"))
    found = docs.select(name.alias("name"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("name", "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return (found.select(F.when(h % MUTATE_EVERY == 0, shorter).otherwise(F.col("run")).alias("word"))
            .where(F.length("word") >= MIN_LENGTH)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT))


def _shared(a, b):
    """Length of the common beginning of two words."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n            # a[:low] is shared, a[:high] is not
    while high - low > 1:
        middle = (low + high) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle
    return low


def _borders(ends):
    """Of each border between sorted parts, what its neighbours share and the numbers of those
    nodes.  ``ends`` has (part, first word, last word) in order."""
    found, count = [], 1        # 0 is the root
    for (_, _, left), (_, right, _) in zip(ends, ends[1:]):
        both = left[:_shared(left, right)]
        known = _shared(both, found[-1][0]) if found else 0
        nodes = [0] + (found[-1][1][1:known + 1] if found else [])
        nodes += range(count, count + len(both) - known)
        count += len(both) - known
        found.append((both, nodes))
    return found


def number_nodes(words, column):
    """``words`` with ``place``, the word's place in sorted order, and ``nodes``, the numbers of
    the trie nodes of its beginnings of 0, 1, 2 ... code points.

    The words of ``column`` must be distinct.  The driver sees two words per sorted part.
    """
    ranged = materialise(words.repartitionByRange(column).sortWithinPartitions(column)
                         .withColumn("part", F.spark_partition_id()), "sorted-words")
    ends = [tuple(r) for r in ranged.groupBy("part").agg(F.min(column), F.max(column)).orderBy("part").collect()]
    borders = _borders(ends)
    before = {part: borders[i - 1] for i, (part, _, _) in enumerate(ends) if i}
    after = {part: borders[i] for i, (part, _, _) in enumerate(ends) if i < len(borders)}

    kept = words.columns

    def number(batches):
        now, word, nodes, count, place = None, "", [0], 0, 0
        for batch in batches:
            places, all_nodes = [], []
            for part, this in zip(batch["part"], batch[column]):
                if part != now:
                    now, word, nodes, count, place = part, "", [0], 0, 0
                    fixed = [before.get(part, ("", [0])), after.get(part, ("", [0]))]
                depth = _shared(word, this)
                nodes = nodes[:depth + 1]
                for both, known in fixed:
                    depth = _shared(both, this)
                    nodes += known[len(nodes):depth + 1]
                fresh = len(this) + 1 - len(nodes)
                first = (part + 1) * _PART_NODES + count
                nodes = nodes + list(range(first, first + fresh))
                word, count = this, count + fresh
                places.append(part * _PART_NODES + place)
                place += 1
                all_nodes.append(nodes)
            yield pd.DataFrame({**{c: batch[c] for c in kept}, "place": places, "nodes": all_nodes})

    schema = ", ".join(f"{c} {t}" for c, t in words.dtypes) + ", place bigint, nodes array<bigint>"
    return (ranged.repartition("part").sortWithinPartitions("part", column)
            .mapInPandas(number, schema))


def pairs(words):
    """``head, tail, place, n, skips, starts_run``: the node pairs of every word, with one code point
    skipped and split between two.  ``words`` has ``word, n``.

    ``starts_run``: the skipped code point differs from the one before it.  To skip any of a run of
    equal ones gives the same word; this marks one of them.
    """
    forward = number_nodes(words.select("word", "n"), "word").withColumnRenamed("nodes", "heads")
    backward = (number_nodes(words.select(F.reverse("word").alias("drow")), "drow")
                .select(F.reverse("drow").alias("word"), F.reverse("nodes").alias("tails")))
    both = materialise(forward.join(backward, "word"), "trie-nodes")
    i = F.col("i")
    skipped = both.select("word", "place", "n", F.posexplode(F.slice("heads", F.lit(1), F.length("word"))).alias("i", "head"), "tails")
    skipped = skipped.select(
        "head", F.get("tails", i + 1).alias("tail"), "place", "n", F.lit(True).alias("skips"),
        ((i == 0) | (F.substring(F.col("word"), i + 1, F.lit(1)) != F.substring(F.col("word"), i, F.lit(1)))).alias("starts_run"))
    split = both.select(F.inline(F.arrays_zip(F.col("heads").alias("head"), F.col("tails").alias("tail"))), "place", "n",
                        F.lit(False).alias("skips"), F.lit(False).alias("starts_run"))
    return both, skipped.unionByName(split)


def near_words(words):
    """``place, n_near, best``: how many words are near each one, and the one that occurs most."""
    both, entries = pairs(words)
    rank = lambda x: F.struct(x["n"].alias("n"), (-x["place"]).alias("minus"))
    groups = (entries.groupBy("head", "tail")
              .agg(F.collect_list(F.struct("place", "n", "skips", "starts_run")).alias("members"))
              .where(F.size("members") > 1))
    groups = groups.select(
        "members",
        F.filter("members", lambda x: x["skips"]).alias("skipped"),
        F.filter("members", lambda x: x["starts_run"]).alias("longer"),
        F.filter("members", lambda x: ~x["skips"]).alias("split"))
    # A skipping word is near the others that skip there and, once, the word split there.
    near = groups.select(F.explode("members").alias("own"), F.when(
        F.col("own.skips"), F.concat(F.filter("skipped", lambda x: x["place"] != F.col("own.place")),
                                     F.when(F.col("own.starts_run"), F.col("split")).otherwise(F.slice("split", 1, 0)))
    ).otherwise(F.col("longer")).alias("others")).where(F.size("others") > 0)
    best = near.groupBy(F.col("own.place").alias("place")).agg(
        F.sum(F.size("others")).alias("n_near"), F.max(F.array_max(F.transform("others", rank))).alias("best"))
    return both, best


def _roots(forms, steps):
    """``place, root`` of the words that have a form; ``steps`` bounds the way, each round doubles what
    has been gone of it."""
    roots = forms.select("place", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        onward = roots.select(F.col("place").alias("root"), F.col("root").alias("further"))
        roots = materialise(roots.join(onward, "root", "left").select(
            "place", F.coalesce("further", "root").alias("root")), "roots")
    return roots


def variants(words, factor=FORM_FACTOR):
    """``word, form, root, n, n_near, form_n`` of words with their numbers of occurrence.

    ``form`` is the near word that occurs most, if at least ``factor`` times as often; ``root`` is
    where the forms lead."""
    if factor <= 1:
        raise ValueError("a form must occur more often than its word")
    words = materialise(words, "words")
    both, best = near_words(words)
    largest = words.agg(F.max("n")).first()[0]
    found = materialise(
        both.select("place", "word", "n").join(best, "place", "left").select(
            "place", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(F.col("best.n") >= factor * F.col("n"), -F.col("best.minus")).alias("form"),
            F.when(F.col("best.n") >= factor * F.col("n"), F.col("best.n")).alias("form_n")), "near-words")
    # Every step multiplies the number of occurrences by the factor.
    roots = _roots(found.where("form IS NOT NULL").select("place", "form"),
                   2 + math.log(largest or 1, factor))
    spelled = found.select("place", "word")
    formed = (found.where("form IS NOT NULL").select("place", "form").join(roots, "place")
              .join(spelled.select(F.col("place").alias("form"), F.col("word").alias("form_word")), "form")
              .join(spelled.select(F.col("place").alias("root"), F.col("word").alias("root_word")), "root")
              .select("place", "form_word", "root_word"))
    return found.join(formed, "place", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
