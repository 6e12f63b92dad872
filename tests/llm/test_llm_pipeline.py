"""The corpus pipeline and the registered queries."""

import importlib
import os
from collections import Counter

import oracle
import pytest
from cases import awkward_documents, empty
from pyspark.sql import functions as F

import corpus_pipeline
from tallymill.llm import decontaminate, quality, simhash
from tallymill.llm.common import table
from tallymill.llm.queries import ORACLES, QUERIES
from tallymill.session import materialise


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input and output of every stage."""
    docs, out = table(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = materialise(stage(spark, docs, sf_dir), name)
        out.append((docs, after))
        docs = after
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_every_stage_does_its_work(spark, sf_dir, stages):
    documents = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(after.columns == documents for _, after in stages[:-1])
    (raw, good), (_, single), (_, clean), (_, mixed), (_, sharded) = stages
    field = quality.train(raw, table(spark, sf_dir, "labels"))
    assert ids(good) == sorted(r.doc_id for r in quality.score_documents(raw, field).where("predicted = 1").collect())
    groups = simhash.near_duplicates(good).collect()
    assert ids(single) == sorted({r.component_id for r in groups}) and len(groups) > single.count()
    found = {r.doc_id for r in decontaminate.contaminated(single, table(spark, sf_dir, "benchmark")).collect()}
    assert ids(clean) == sorted(set(ids(single)) - found) and found
    copies = Counter(ids(mixed))
    assert set(copies) <= set(ids(clean)) and max(copies.values()) > 1
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert all(r.text == texts[r.doc_id] for r in mixed.collect())
    assert ids(sharded) == ids(mixed)
    slots = {}
    for r in sharded.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_is_the_stages_in_a_row(spark, sf_dir, stages):
    last = stages[-1][1]
    got = corpus_pipeline.run(spark, sf_dir)
    columns = ["doc_id", "shard", "grown_shard", "law", "n_chars"]
    assert Counter(map(tuple, got.select(columns).collect())) == Counter(map(tuple, last.select(columns).collect()))


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_stand_awkward_rows(spark, sf_dir, name, stage):
    docs = awkward_documents(spark, "copy", "shard", "score", "fp", "slot", "hash")
    out = stage(spark, docs, sf_dir)
    if name == "sharding":
        assert set(docs.columns) <= set(out.columns)
    else:
        assert out.columns == docs.columns
    assert out.count() < 2000
    assert stage(spark, empty(docs), sf_dir).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, sf_dir, name):
    ours, theirs = oracle.compare(QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), ORACLES[name])
    assert ours == theirs and ours[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_give_rows(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").agg(F.count("*")).first()[0] >= 0


def test_ten_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 11))


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    package = importlib.import_module("tallymill")
    for folder, _, files in os.walk(os.path.dirname(package.__file__)):
        if os.path.basename(folder) != "llm":
            for name in files:
                if name.endswith(".py"):
                    assert "tallymill.llm" not in open(os.path.join(folder, name), encoding="utf-8").read()
    assert os.path.exists(os.path.join(root, "__spark_entry__.py"))
