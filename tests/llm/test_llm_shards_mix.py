"""Shard tree and Poisson mixing."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from cases import awkward_documents, empty
from pyspark.sql import functions as F

from tallymill.llm import mixing, sharding
from tallymill.llm.common import table


def _draw(doc_id, level, node, weight):
    """XXH64 of the id's eight bytes, chained into the level's and the node's four, as one draw."""
    h = xxhash.xxh64_intdigest((doc_id % 2 ** 64).to_bytes(8, "little"), 42)
    for number in (level, node):
        h = xxhash.xxh64_intdigest(number.to_bytes(4, "little"), h)
    return -math.log(((h >> 11) + 0.5) * 2.0 ** -53) / weight


def _plain_shard(doc_id, tree):
    """Descend by the least draw below each node, a node weighing what stands below it."""
    rows = [r for r in tree if r[3] > 0]
    for level in range(3):
        nodes = defaultdict(list)
        for r in rows:
            nodes[r[level]].append(r)
        rows = nodes[min(nodes, key=lambda node: _draw(doc_id, level, node, sum(r[3] for r in nodes[node])))]
    return rows[0][2]


def test_shards_sizes_and_slots_match_plain_python(spark, sf_dir):
    docs = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    rows = sharding.assign(sharding.size_and_crc(table(spark, sf_dir, "documents"))).collect()
    tree, grown = sharding.default_tree(40), sharding.grown_tree(sharding.default_tree(40))
    assert grown == sharding.default_tree(41)
    slots = defaultdict(list)
    for r in rows:
        data = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 16, zlib.crc32(data), "key")
        slots[r.shard].append(r.slot)
    for r in rows[:150]:
        assert (r.shard, r.grown_shard) == (_plain_shard(r.doc_id, tree), _plain_shard(r.doc_id, grown))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(rows) == len(docs)
    assert all(r.grown_shard in (r.shard, 40) for r in rows) and any(r.grown_shard == 40 for r in rows)


@pytest.mark.parametrize("n", [1, 7, 39, 62])
def test_growth_by_one_moves_rows_only_into_the_new_shard(spark, n):
    tree = sharding.default_tree(n)
    rows = sharding.with_shard(spark.range(4000).withColumnRenamed("id", "doc_id"), tree, sharding.grown_tree(tree)).collect()
    assert all(r.grown_shard in (r.shard, n) for r in rows)
    moved = sum(r.grown_shard == n for r in rows)
    assert abs(moved - 4000 / (n + 1)) < 6 * math.sqrt(4000 / (n + 1))


def _moves(spark, before, after, n=20000):
    ids = spark.range(n).withColumnRenamed("id", "doc_id")
    return sharding.with_shard(ids, before, after).collect()


def _region(shard):
    return shard // 20


def _rack(shard):
    return shard // 5


def test_a_heavier_shard_moves_rows_only_into_its_subtrees(spark):
    rows = _moves(spark, sharding.default_tree(40), sharding.default_tree(40, weights={7: 3.0}))
    for r in rows:
        if r.shard != r.grown_shard:
            # Into the region, or inside it into the rack, or inside that into the shard.
            assert _region(r.grown_shard) == 0
            if _region(r.shard) == 0:
                assert _rack(r.grown_shard) == 1
                assert _rack(r.shard) != 1 or r.grown_shard == 7
    counts = Counter(r.grown_shard for r in rows)
    assert abs(counts[7] - 20000 * 3 / 42) < 6 * math.sqrt(20000 * 3 / 42)
    assert all(abs(counts[s] - 20000 / 42) < 6 * math.sqrt(20000 / 42) for s in range(40) if s != 7)


def test_a_closed_shard_moves_rows_only_out_of_its_subtrees(spark):
    rows = _moves(spark, sharding.default_tree(40), sharding.default_tree(40, weights={9: 0.0}))
    for r in rows:
        if r.shard != r.grown_shard:
            assert _region(r.shard) == 0
            if _region(r.grown_shard) == 0:
                assert _rack(r.shard) == 1
                assert _rack(r.grown_shard) != 1 or r.shard == 9
    assert 9 not in {r.grown_shard for r in rows}


@pytest.mark.parametrize("level, weights", [("region", {s: 2.0 for s in range(20, 40)}), ("rack", {s: 2.0 for s in range(10, 15)})])
def test_weights_of_whole_regions_and_racks_confine_movement(spark, level, weights):
    rows = _moves(spark, sharding.default_tree(40), sharding.default_tree(40, weights=weights))
    moved = [r for r in rows if r.shard != r.grown_shard]
    if level == "region":
        assert moved and all(_region(r.shard) == 0 and _region(r.grown_shard) == 1 for r in moved)
    else:
        assert all(_region(r.grown_shard) == 0 and (_region(r.shard) == 1 or _rack(r.grown_shard) == 2) for r in moved)
        assert any(_rack(r.grown_shard) == 2 for r in moved)
    share = sum(weights.get(s, 1.0) for s in range(40))
    counts = Counter(r.grown_shard for r in rows)
    assert all(abs(counts[s] - 20000 * weights.get(s, 1.0) / share) < 6 * math.sqrt(20000 * weights.get(s, 1.0) / share)
               for s in range(40))


def test_the_shape_of_the_tree_decides_where_rows_go(spark):
    tree = sharding.default_tree(40)
    dealt = [(s % 2, s % 8, s, w) for _, _, s, w in tree]
    rows = _moves(spark, tree, dealt)
    assert sum(r.shard != r.grown_shard for r in rows) > 15000
    counts = Counter(r.grown_shard for r in rows)
    assert all(abs(counts[s] - 500) < 6 * math.sqrt(500) for s in range(40))


def test_added_shards_keep_their_regions(spark):
    forty = sharding.default_tree(40)
    one = sharding.grown_tree(forty)
    two = sharding.grown_tree(one)
    assert all(r.grown_shard in (r.shard, 41) for r in _moves(spark, one, two))
    assert all(r.grown_shard in (r.shard, 40, 41) for r in _moves(spark, forty, two))


def test_shards_of_awkward_rows(spark):
    docs = awkward_documents(spark, "shard", "slot", "law", "__tm_part_x")
    rows = sharding.assign(docs).collect()
    assert len(rows) == docs.count() and {r.law for r in rows} == {"key"}
    assert len({r.shard for r in rows if r.doc_id is None}) == 1 and len({r.shard for r in rows if r.doc_id == 1}) == 1
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    none = next(r for r in sharding.size_and_crc(docs).collect() if r.doc_id == 2)
    assert (none.size, none.text_crc32) == (16, None)
    assert sharding.assign(empty(docs)).count() == 0


def _poisson(u, rate):
    n, term = 0, math.exp(-rate)
    total = term
    while u >= total:
        n += 1
        term *= rate / n
        total += term
    return n


def test_mix_brings_sources_to_their_targets(spark):
    docs = spark.range(30000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 100).alias("text"),
                                     F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 30 == 1, "c").otherwise("b").alias("source"))
    rows = mixing.mix(docs, targets={"a": 1, "b": 1, "c": 2}, epochs=1.0)
    got = {r.source: r["count"] for r in rows.groupBy("source").count().collect()}
    for source, share in (("a", 0.25), ("b", 0.25), ("c", 0.5)):
        assert abs(got[source] - 30000 * share) < 0.05 * 30000 * share + 300
    rate = {r.source: r.rate for r in rows.select("source", "rate").distinct().collect()}
    assert rate["c"] == pytest.approx(15000 / 1000)


def test_mix_inverts_the_poisson_distribution(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    drawn = docs.select("doc_id", mixing.uniform(F.col("doc_id"), mixing.SEED).alias("u"))
    u = {r.doc_id: r.u for r in drawn.collect()}
    rates = {r.source: r.rate for r in mixing.source_rates(docs).collect()}
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    rows = mixing.mix(docs).select("doc_id", "copy", "shuffle_key").collect()
    counts = Counter(r.doc_id for r in rows)
    assert all(counts.get(i, 0) == _poisson(u[i], rates[source[i]]) for i in u)
    assert {(r.doc_id, r.copy) for r in rows} == {(i, k + 1) for i, n in counts.items() for k in range(n)}


def test_large_rates_do_not_underflow(spark):
    docs = spark.createDataFrame([(i, "x" * (1000 if i else 2), "big" if i else "tiny") for i in range(100)],
                                 "doc_id long, text string, source string")
    got = mixing.mix(docs, targets={"tiny": 1, "big": 1}).groupBy("source").count().collect()
    n = {r.source: r["count"] for r in got}["tiny"]
    assert abs(n - 24750) < 6 * math.sqrt(24750)


def test_mix_of_awkward_rows(spark):
    docs = awkward_documents(spark, "copy", "rate", "__tm_x")
    rows = mixing.mix(docs, epochs=20.0)
    assert set(rows.columns) == set(docs.columns) | {"shuffle_key"}
    kept = rows.collect()
    assert any(r.source is None for r in docs.collect()) and all(r.copy >= 1 for r in kept)
    names = ("__tm_a", "__tm_b", "__tm_c")
    assert mixing.mix(docs, names=names).drop(*names).columns == docs.columns
    assert mixing.mix(empty(docs)).count() == 0
    assert mixing.mix(docs, targets={"a": 0}).count() == 0


def test_rows_without_ids_are_spread_over_partitions(spark):
    rows = [(None, f"text {i % 3}", "en", "a", 6) for i in range(20000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert _parts(mixing.mix(docs)) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def _parts(df):
    """Non-empty partitions before adaptive execution joins small ones."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_large_rates_are_linear_work(spark):
    import time

    start = time.perf_counter()
    rates = spark.createDataFrame([("a", 200000.0), (None, 0.5), ("z", 0.0)], "source string, rate double")
    rows = {r.source: r.cdf for r in mixing.with_distribution(rates).collect()}
    assert time.perf_counter() - start < 60
    assert rows["z"] == [1.0] and rows[None][:2] == pytest.approx([math.exp(-0.5), 1.5 * math.exp(-0.5)])
    assert all(a <= b for a, b in zip(rows["a"], rows["a"][1:])) and rows["a"][-1] == pytest.approx(1, abs=1e-9)
    assert rows["a"][200000] == pytest.approx(0.5, abs=0.001)
