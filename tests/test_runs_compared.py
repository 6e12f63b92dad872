"""Replicates by gaps, digest trees and sketches of runs."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymill.operators import reconcile, sketches, validate


def test_gap_drawn_samples_are_bernoulli_samples(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("key"), F.lit("m").alias("salt"))
    drawn = validate.gap_replicates(df, "key", "salt", replicates=400, share=0.02)
    assert drawn.columns == ["key", "salt", "replicate"]
    rows = drawn.collect()
    assert len({(r.key, r.replicate) for r in rows}) == len(rows)
    assert abs(len(rows) - 24000) < 5 * math.sqrt(24000)
    for of in ("key", "replicate"):
        sizes = Counter(r[of] for r in rows)
        mean, n = (8, 3000) if of == "key" else (60, 400)
        spread = sum((sizes.get(k, 0) - mean) ** 2 for k in (map(str, range(n)) if of == "key" else range(n))) / n
        assert 0.8 * mean < spread < 1.25 * mean
    assert drawn.exceptAll(validate.gap_replicates(df.repartition(7), "key", "salt", 400, 0.02)).count() == 0
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "sequence" not in plan
    assert validate.gap_replicates(df.limit(0), "key", "salt", 400, 0.02).count() == 0
    with pytest.raises(ValueError):
        validate.gap_replicates(df, "key", "salt", 400, 1.0)


def _listing(spark, rows):
    return spark.createDataFrame(rows, "key string, size long").withColumn("modified", F.current_timestamp())


def test_digests_find_what_differs_and_nothing_else(spark):
    same = [(f"k{i}", i) for i in range(5000)]
    source = same + [("only-s", 1), ("resized", 1), ("unknown", None), ("twice", 3), ("twice", 3)]
    target = same + [("only-t", 1), ("resized", 2), ("unknown", 4), ("twice", 3)]
    found, levels = reconcile.compare_by_digest(_listing(spark, [(f"p/{k}", s) for k, s in source]), _listing(spark, target), "p/")
    assert sorted((r.key, r.status) for r in found.collect()) == [
        ("only-s", "missing"), ("only-t", "extra"), ("resized", "size_mismatch"), ("unknown", "unknown_size")]
    assert [d for d, _, _ in levels] == [1, 2, 3, 4] and all(differ <= 5 for _, _, differ in levels)
    assert all(seen <= 16 * before[2] for before, (_, seen, _) in zip([(0, 0, 1), *levels], levels))
    moved = reconcile.differing_leaves(reconcile.digests(_listing(spark, source)), reconcile.digests(_listing(spark, target)))[0]
    assert moved.count() == 5
    # Two copies of one key against two of another: sums tell them apart, an exclusive or does not.
    a, b = _listing(spark, [("a", 1), ("a", 1)]), _listing(spark, [("b", 1), ("b", 1)])
    leaf = F.lit("0000").alias("node")
    assert sorted(r.key for r in reconcile.compare_by_digest(a, b)[0].collect()) == ["a", "b"]
    one = lambda df: reconcile.digests(df).select(leaf, "n", "bytes", "unknown", "mixed", "summed")
    assert reconcile.differing_leaves(one(a), one(b))[0].count() == 1
    for left, right in ((a.limit(0), a), (a, a.limit(0)), (a, a), (a.limit(0), a.limit(0))):
        want = {"a"} if (left.count() == 0) != (right.count() == 0) else set()
        assert {r.key for r in reconcile.compare_by_digest(left, right)[0].collect()} == want


def test_sketches_of_runs_are_merged_without_their_rows(spark, tmp_path):
    path = str(tmp_path / "s")
    for run, (lo, hi) in {"1": (0, 30000), "2": (20000, 60000), "3": (0, 0)}.items():
        df = spark.range(lo, hi).select(F.col("id").alias("k"), (F.col("id") % 100).cast("float").alias("x"))
        df = df.unionByName(spark.sql("select cast(null as bigint) as k, cast(null as float) as x"))
        sketches.store(sketches.key_sketches(df, ["k", "x"]), path, run)
        sketches.store(sketches.quantile_sketches(df, ["k", "x"]), path + "q", run)
    kept = sketches.stored(spark, path)
    found = {(r.column, r.run_a, r.run_b): r for r in sketches.overlaps(kept).collect()}
    pair = found["k", "1", "2"]
    assert pair.n_both == pytest.approx(10000, rel=0.15) and pair.n_either == pytest.approx(60000, rel=0.05)
    assert pair.n_only_a == pytest.approx(20000, rel=0.1) and found["x", "1", "2"].n_both == 100
    assert (found["k", "1", "3"].n_both, found["k", "1", "3"].n_b) == (0, 0)
    united = {r.column: r for r in sketches.distinct_over_runs(kept).collect()}
    assert united["k"].n_distinct == pytest.approx(60000, rel=0.05) and (united["x"].n, united["x"].runs) == (70000, 3)
    spread = {(r.column, r.share): r for r in sketches.quantiles_over_runs(sketches.stored(spark, path + "q"), [0.1, 0.5]).collect()}
    assert abs(spread["x", 0.5].value - 50) <= 4 and abs(spread["x", 0.1].value - 10) <= 4
    assert (spread["k", 0.5].least, spread["k", 0.5].most, spread["k", 0.5].n) == (0, 59999, 70000)
    with pytest.raises(Exception, match="already exists"):
        sketches.store(sketches.key_sketches(spark.range(3).withColumnRenamed("id", "k"), ["k"]), path, "1")
