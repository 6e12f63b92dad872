"""SimHash groups and vector links against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from cases import awkward_documents, empty
from pyspark.sql import functions as F

from tallymill.llm import common, simhash, vectors
from tallymill.llm.common import table


def plain_simhash(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_groups_match_all_pairs(spark, sf_dir):
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents")).collect()
    fps = {r.doc_id: int(r.fingerprint, 16) for r in rows}
    ids = sorted(fps)
    want = roots(ids, [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 4])
    assert {r.doc_id: r.component_id for r in rows} == want
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    assert all(fps[i] == plain_simhash(texts[i]) for i in ids[::7])


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 4, 5, 6])
def test_links_at_every_distance(spark, max_bits):
    rng = random.Random(max_bits)
    values = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        values.add(base)
        for k in range(8):
            flipped = base
            for bit in rng.sample(range(64), k):
                flipped ^= 1 << bit
            values.add(flipped)
    values |= {0, (1 << 64) - 1, 1 << 63, 3 << 62}
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    got = {frozenset((r.u, r.v)) for r in simhash.linked_fingerprints(fps, max_bits).collect()}
    ordered = sorted(values)
    want = {frozenset((signed(a), signed(b))) for i, a in enumerate(ordered) for b in ordered[:i]
            if (a ^ b).bit_count() <= max_bits}
    assert got == want


@pytest.mark.parametrize("max_bits, n_blocks", [(4, 0), (4, 5), (4, 6), (4, 8), (4, 9), (4, 11), (3, 7), (2, 4), (0, 1), (0, 3)])
def test_every_layout_finds_every_link_and_blocks_each_once(spark, max_bits, n_blocks):
    rng, values = random.Random(10 * max_bits + n_blocks), {0, (1 << 64) - 1, 1 << 63, 3 << 62}
    for _ in range(40):
        base = rng.getrandbits(64)
        values |= {base} | {base ^ sum(1 << b for b in rng.sample(range(64), k)) for k in range(1, 7)}
        values |= {base ^ (3 << 2 * b) for b in rng.sample(range(32), 3)}
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    got = [frozenset((r.u, r.v)) for r in simhash.linked_fingerprints(fps, max_bits, n_blocks).collect()]
    ordered = sorted(values)
    want = {frozenset((signed(a), signed(b))) for i, a in enumerate(ordered) for b in ordered[:i]
            if (a ^ b).bit_count() <= max_bits}
    assert set(got) == want and (not n_blocks or len(got) == len(want))


def test_meetings_grow_with_the_fingerprints(spark):
    """Random fingerprints that meet in a cell, at 1e5 and 4e5 of them: as many as expected, and no
    more work for each."""
    work = []
    for n in (100_000, 400_000):
        blocks = simhash.layout(n)
        coded = spark.range(n).select(F.xxhash64("id").alias("fp")).select("fp", simhash.unary_counts(F.col("fp")).alias("code"))
        met = simhash._by_blocks(coded.repartition(8), 4, blocks).count() / n
        assert 0.3 * simhash.meetings(n, blocks) < 2 * met < 1.2 * simhash.meetings(n, blocks)
        work.append(simhash.cost(n, blocks) - simhash.meetings(n, blocks) + 2 * met)
    assert 0.5 < work[1] / work[0] < 2
    assert simhash.cost(10 ** 9, simhash.layout(10 ** 9)) < 30 * work[0]
    assert simhash.layout(0) == simhash.layout(100) == 0


def test_unary_codes_bound_the_distance(spark):
    rng = random.Random(1)
    pairs = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a long, b long")
    codes = df.select("a", "b", F.bit_count(simhash.unary_counts(F.col("a")).bitwiseXOR(simhash.unary_counts(F.col("b")))).alias("d"))
    for r in codes.collect():
        manhattan = sum(abs((r.a >> k & 3).bit_count() - (r.b >> k & 3).bit_count()) for k in range(0, 64, 2))
        assert r.d == manhattan <= (r.a ^ r.b).bit_count()


def test_groups_of_awkward_rows(spark):
    docs = awkward_documents(spark, "fp", "component_id", "fingerprint")
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    wordless = [r for r in rows if r.fingerprint == "0" * 16]
    assert len(wordless) == 4 and {r.component_id for r in wordless} == {2}
    assert all(plain_simhash(t) == int(r.fingerprint, 16) for r, t in
               [(next(r for r in rows if r.doc_id == d.doc_id and int(r.fingerprint, 16) == plain_simhash(d.text)), d.text)
                for d in docs.collect()])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 1), (False, 1), (False, 2), (False, 5), (False, 6), (False, 7), (True, 0)]
    assert simhash.near_duplicates(empty(docs)).count() == 0 == simhash.keep_one(empty(docs)).count()


def test_one_of_each_group_stays(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    groups = simhash.near_duplicates(docs).collect()
    kept = [r.doc_id for r in simhash.keep_one(docs).collect()]
    assert sorted(kept) == sorted({r.component_id for r in groups})


def test_very_long_text_is_hashed_whole():
    words = [f"w{i % 977}" for i in range(200_000)]
    whole, parts = simhash.simhash(" ".join(words)), simhash._CHUNK
    simhash._CHUNK = 1 << 30
    try:
        assert simhash.simhash("\n".join(words)) == whole
    finally:
        simhash._CHUNK = parts


@pytest.mark.parametrize("shape", ["path", "star", "cliques", "random"])
def test_components(spark, shape):
    rng = random.Random(5)
    edges = {"path": [(i, i + 1) for i in range(200)], "star": [(150, i) for i in range(300)],
             "cliques": [(a + 50 * k, b + 50 * k) for k in range(4) for a in range(20) for b in range(a)],
             "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]}[shape]
    rng.shuffle(edges)
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    linked = [(a, b) for a, b in edges if a != b]
    assert got == roots({n for e in linked for n in e}, linked)


def _embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def _clustered(n_clusters=40, size=25, dimension=64, spread=0.04, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n_clusters, dimension))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    x = np.repeat(centres, size, axis=0) + spread * rng.normal(size=(n_clusters * size, dimension))
    return np.concatenate([x, rng.normal(size=(600, dimension)), x[:60], 7 * x[:30]]).astype(np.float32)


def _all_pairs(x, threshold=0.95):
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    close = unit @ unit.T >= threshold
    np.fill_diagonal(close, False)
    return close


@pytest.mark.parametrize("spread", [0.015, 0.027, 0.04])
def test_links_reach_the_recall_and_hold_the_threshold(spark, spread):
    x = _clustered(spread=spread)
    close = _all_pairs(x)
    got = {r.vec_id: r for r in vectors.near_duplicates(_embeddings(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])).collect()}
    links = np.array([got[i].n_links for i in range(len(x))])
    assert len(got) == len(x) and (links <= close.sum(axis=1)).all()
    assert links.sum() >= 0.95 * close.sum() > 0
    assert all(got[i].kept == (got[i].component_id == i) for i in got)
    assert all(got[i].component_id <= i for i in got)


@pytest.mark.parametrize("n_vectors", [10 ** 3, 10 ** 8, 10 ** 9])
def test_recall_is_held_for_any_number_of_vectors(n_vectors):
    rng = np.random.default_rng(9)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    index = vectors.build(unit(rng.normal(size=(512, 64))), n_vectors)
    a, away = unit(rng.normal(size=(4000, 64))), rng.normal(size=(4000, 64))
    away = unit(away - (away * a).sum(axis=1, keepdims=True) * a)
    b = 0.95 * a + np.sqrt(1 - 0.95 ** 2) * away
    hits = vectors.collisions(index, *index.place(a), *index.place(b)).sum(axis=1)
    assert index.count >= vectors.MIN_COUNT and (hits >= index.count).mean() >= vectors.RECALL - 0.01


def test_a_recall_out_of_reach_fails(monkeypatch):
    monkeypatch.setattr(vectors, "MAX_PROJECTIONS", vectors.PROJECTIONS)
    x = np.random.default_rng(9).normal(size=(512, 64))
    with pytest.raises(ValueError, match="recall 0.98 is out of reach"):
        vectors.build(x / np.linalg.norm(x, axis=1, keepdims=True), 10 ** 10)


def test_crowded_prefixes_are_split_without_loss(spark):
    x = _clustered(n_clusters=2, size=300, spread=0.02)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    distinct = spark.createDataFrame([(i, v.astype(float).tolist(), 1) for i, v in enumerate(x)],
                                     "vec_id long, vector array<double>, copies long")
    index = vectors.fit(distinct)
    total = lambda rows: sorted((r.vec_id, r["n"]) for r in rows.groupBy("vec_id").agg(F.sum("links").alias("n")).collect())
    whole = total(vectors.link_distinct(distinct, index, block_rows=10 ** 6))
    assert whole == total(vectors.link_distinct(distinct, index, block_rows=100))
    assert len(whole) > 500 and len(rows) == len(x)


def test_vectors_without_direction_and_other_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [0.0, 0.0], 0), (4, None, 0), (5, [1.0, None], 0), (6, [nan, 1.0], 0),
            (7, [inf, 1.0], 0), (8, [], 0), (None, [1.0, 0.0], 0), (9, [1.0, 0.0, 0.0], 0), (10, [1e-38, 0.0], 0),
            (11, [3e38, 1e37], 0), (12, [-1.0, 0.0], 0), (1, [1.0, 0.0], 0), (13, [0.0, 0.0, 5.0], 0), (14, [0.0, 0.1, 9.0], 0)]
    df = _embeddings(spark, rows).selectExpr("*", "'x' as links", "'y' as root")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df).collect()), key=str)
    line = {1: 4, 2: 4, 10: 4, 11: 4}
    want = [(i, n, 1, i == 1) for i, n in line.items()] + [(1, 4, 1, True)]
    want += [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 12)] + [(None, 0, None, False)]
    want += [(13, 1, 13, True), (14, 1, 13, False)]
    assert got == sorted(want, key=str)
    assert vectors.near_duplicates(empty(df)).count() == 0


def test_both_sides_of_the_block_join_read_one_shuffle(spark):
    fps = spark.range(2000).select(F.xxhash64("id").alias("fp"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = simhash.linked_fingerprints(fps, n_blocks=6)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("ReusedExchange") == 1
