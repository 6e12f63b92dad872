"""Spelling variants against all pairs, node numbers against the set of beginnings."""

import random
import re
import zlib
from collections import Counter

import pytest
from cases import awkward_documents, empty

from tallymill.llm import spelling
from tallymill.llm.common import table


def _words(docs):
    """Counted words of (doc_id, text) pairs in plain Python."""
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def _is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _check(rows, counts, factor=spelling.FORM_FACTOR):
    assert Counter(r.word for r in rows) == Counter(dict.fromkeys(counts, 1))
    found = {r.word: r for r in rows}
    for word, n in counts.items():
        near = [x for x in counts if _is_near(word, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= factor * n else None
        r = found[word]
        assert (r.n, r.n_near, r.form, r.form_n) == (n, len(near), form, counts.get(form))
    for r in rows:
        root = r.word
        while found[root].form is not None:
            root = found[root].form
        assert r.root == root


def _frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long").repartition(8)


def _random_words(seed, alphabet, n):
    draw = random.Random(seed)
    words = {"".join(draw.choices(alphabet, k=draw.randrange(7, 11))) for _ in range(n)}
    for w in list(words):
        for _ in range(4):
            i = draw.randrange(len(w))
            words.add(draw.choice([w[:i] + w[i + 1:], w[:i] + draw.choice(alphabet) + w[i:],
                                   w[:i] + draw.choice(alphabet) + w[i + 1:]]))
    return {w: draw.choice([2, 2, 3, 20, 30, 200, 2000, 20000, 200000]) for w in words if len(w) >= 7}


@pytest.mark.parametrize("seed, alphabet, n", [(1, "ab", 150), (2, "abcé÷", 150), (3, "aÿz", 200)])
def test_all_near_words(spark, seed, alphabet, n):
    counts = _random_words(seed, alphabet, n)
    rows = spelling.variants(_frame(spark, counts)).collect()
    _check(rows, counts)
    assert max(r.n_near for r in rows) > 3 and any(r.form is None for r in rows)
    assert any(r.form != r.root for r in rows if r.form)


def test_runs_of_equal_letters_and_equal_numbers(spark):
    counts = {"aaaaaaa": 2, "aaaaaaaa": 2, "aaaaaaaaa": 20, "aaaaaaab": 20, "baaaaaaa": 20, "aaabaaaa": 2, "abababa": 2,
              "ababab" + "ab": 40, "bababab": 40}
    _check(spelling.variants(_frame(spark, counts)).collect(), counts)


def test_one_long_chain_of_forms(spark):
    counts = {"a" * 7 + "b" * i: 2 * 10 ** i for i in range(18)}
    rows = spelling.variants(_frame(spark, counts)).collect()
    assert {r.root for r in rows} == {"a" * 7 + "b" * 17}
    _check(rows, counts)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_nodes_are_numbered_alike_over_the_borders_of_parts(spark, parts):
    counts = _random_words(5, "ab", 60) | {"aaaaaaa": 2, "a" * 300: 2, "a" * 299 + "b": 2}
    with_conf = {"spark.sql.shuffle.partitions": str(parts), "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in with_conf}
    for k, v in with_conf.items():
        spark.conf.set(k, v)
    try:
        rows = spelling.number_nodes(_frame(spark, counts), "word").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    number = {}
    for r in rows:
        assert len(r.nodes) == len(r.word) + 1
        for i, node in enumerate(r.nodes):
            assert number.setdefault(r.word[:i], node) == node
    assert len(set(number.values())) == len(number)
    assert [r.word for r in sorted(rows, key=lambda r: r.place)] == sorted(counts)


def test_a_group_gives_one_row_per_member(spark):
    from pyspark.sql import functions as F

    counts = {"abcdef" + chr(c): 2 for c in [*range(0x61, 0x7B), *range(0xC0, 0x100)]}
    _, entries = spelling.pairs(_frame(spark, counts))
    sizes = entries.groupBy("head", "tail").count()
    assert sizes.agg(F.max("count")).first()[0] == len(counts) == 90
    assert entries.count() == 90 * 15
    _check(spelling.variants(_frame(spark, counts)).collect(), counts)


def test_words_of_the_stored_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = spelling.corpus_words(docs).collect()
    expected = _words([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.word: r.n for r in rows} == expected and len(rows) == len(expected) > 1000


def test_awkward_documents(spark):
    docs = awkward_documents(spark, "word", "n", "place", "nodes")
    long = "x" * 30000
    more = spark.createDataFrame([(9, f"{long} {long} {long}y Sentence SENTENCE sentence sentencé"), (None, "sentences sentences")],
                                 "doc_id long, text string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    counts = _words([(r.doc_id, r.text) for r in docs.collect()])
    assert long in counts and "another" in counts
    _check(spelling.variants(spelling.corpus_words(docs)).collect(), counts)
    assert spelling.variants(spelling.corpus_words(empty(docs))).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(_frame(spark, {"aaaaaaa": 2}), factor=1)
