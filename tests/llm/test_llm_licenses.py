"""License scan: every match of plain Python, and awkward inputs."""

import random
import re

import pytest
from cases import awkward_documents, empty

from tallymill.llm import licenses

_SEP = licenses.BETWEEN_WORDS


def _words(text):
    return [w for w in re.sub(_SEP, " ", text).split(" ") if w]


def _plain(text, templates=licenses.TEMPLATES, threshold=licenses.THRESHOLD):
    """(n_words, places, base labels, labels, score) of one text, all blocks against all templates."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = _words(low)
    places, base, more, score = [], set(), set(), 0.0
    for phrase, label in licenses.PHRASES:
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(parts)] == parts]
        places += at
        base |= {label} if at else set()
    for block in re.split(r"\n[\x09-\x0D ]*\n", re.sub(r"([.!?])[\x09-\x0D ]+", "\\1\n\n", low)):
        held = set(_words(block))
        for label, template in templates:
            t = licenses.template_words(template)
            share = len(held & set(t)) / len(t)
            if share >= threshold:
                more.add(label)
                score = max(score, share)
    return len(words), sorted(places), sorted(base), sorted(base | more), 1.0 if places else score


def _check(rows, texts, **options):
    assert len(rows) == len(texts)
    for r in rows:
        n, places, base, labels, score = _plain(texts[r.doc_id], **options)
        assert (r.n_words, r.n_base, r.base_labels, r.labels) == (n, len(places), ",".join(base), ",".join(labels))
        assert (r.first_word, r.last_word) == ((places[0], places[-1]) if places else (None, None))
        assert r.score == pytest.approx(score, abs=0)


def test_all_matches_of_damaged_notices(spark):
    draw, texts = random.Random(4), {}
    filler = "the of and to in a is free software license work under copyright notice and permission".split()
    for i in range(600):
        parts = []
        for _ in range(draw.randrange(1, 5)):
            words = list(draw.choice(licenses.TEMPLATES)[1].split())
            for _ in range(draw.randrange(4)):
                words[draw.randrange(len(words))] = draw.choice(filler)
            if draw.random() < 0.3:
                draw.shuffle(words)
            parts.append(" ".join(words) + draw.choice([". ", " ", "\n", "\n \n", "!", ": "]))
            parts.append(" ".join(draw.choices(filler, k=draw.randrange(12))) + draw.choice([". ", "\n"]))
        texts[i] = "".join(parts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8)
    rows = licenses.scan(df).collect()
    _check(rows, texts)
    assert len({r.labels for r in rows}) > 20
    _check(licenses.scan(df, threshold=0.6).collect(), texts, threshold=0.6)


def test_phrases_by_whole_words_wherever_they_stand(spark):
    texts = {1: "CC.BY cc by cc-by", 2: "accc by bye", 3: "all rights reserved. All\nRights-Reserved", 4: "éall rights reserved",
             5: "general public licenses", 6: "cc by", 7: "\u212Aall CC BY", 8: "cc"}
    rows = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    _check(rows.values(), texts)
    assert [rows[i].n_base for i in range(1, 9)] == [3, 0, 2, 0, 0, 1, 1, 0]


def test_notice_in_several_lines_and_near_copies(spark):
    notice = ("Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated"
              "\ndocumentation files (the \"Files\"), to deal in the Software\nwithout any restriction")
    other = "Licensed under the Apache License, Version 2.0; you may not use this file"
    rows = licenses.scan(spark.createDataFrame([(1, notice), (2, other), (3, "Released under the Apache License")],
                                               "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.labels for r in rows] == ["mit", "apache-2.0", ""]


def test_awkward_documents(spark):
    docs = awkward_documents(spark, "labels", "row", "block", "words", "score")
    rows = licenses.scan(docs).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in (None, 1)}
    _check([r for r in rows if r.doc_id not in (None, 1)], texts)
    assert sorted(r.n_words for r in rows if r.doc_id is None) == [0, 8]
    assert licenses.scan(empty(docs)).count() == 0
    assert licenses.scan(docs, templates=()).count() == docs.count()


def test_main_path_is_native(spark):
    docs = awkward_documents(spark)
    plan = licenses.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "ExistingRDD" not in plan and "CartesianProduct" not in plan
