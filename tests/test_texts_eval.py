"""Evaluation of generated texts, pairs, lookups."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallymill.operators import evaluate, lookup
from tallymill.plans.views import generations


def cosine(a, b):
    na, nb = math.hypot(*a), math.hypot(*b)
    return sum(x * y for x, y in zip(a, b)) / (na * nb) if na and nb else 0.0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(5)
    rows = [(i, "big" if i % 3 else "small", [rng.gauss(0.3, 1) for _ in range(6)]) for i in range(60)]
    rows.append((60, "big", [0.0] * 6))
    return rows, spark.createDataFrame(rows, "id int, g string, embedding array<float>")


def test_centroid_equals_pairwise(vectors):
    rows, df = vectors
    pairs = [cosine(a[2], b[2]) for a in rows for b in rows]
    got = evaluate.diversity(df).first()
    assert got.n_texts == 61
    assert got.diversity == pytest.approx(1 - sum(pairs) / len(pairs), abs=1e-6)


def test_text_diversity_within_groups(vectors):
    rows, df = vectors
    got = {r.id: r.diver for r in evaluate.text_diversity(df, by=["g"]).collect()}
    for i, g, v in rows:
        mates = [w for _, h, w in rows if h == g]
        assert got[i] == pytest.approx(1 - sum(cosine(v, w) for w in mates) / len(mates), abs=1e-6)
    whole = evaluate.text_diversity(df).agg(F.avg("diver")).first()[0]
    assert whole == pytest.approx(evaluate.diversity(df).first().diversity)


def test_embeddings_known_value(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert evaluate.diversity(df).first().diversity == pytest.approx(0.9976034148108393, abs=1e-7)


def test_sweep_has_one_row_per_parameter_set(spark, sf_dir):
    rows = evaluate.sweep_report(generations(spark, sf_dir)).collect()
    assert sorted((r.top_p, r.temperature) for r in rows) == sorted(evaluate.SWEEP)
    assert all(0 <= r.gramm_corr <= 100 and 0 <= r.positiv <= 100 for r in rows)


def test_rates_count_nulls_as_not_positive(spark):
    df = spark.createDataFrame([(1, 1), (0, None), (1, 0), (None, 1)], "grm_label int, sentiment int")
    assert evaluate.label_rates(df).first()[:] == (4, 50.0, 50.0)


def test_train_pairs_keep_equal_pairs_on_one_side(spark):
    rows = [(f" Лев  {i % 50} ", f"текст {i % 50}  x") for i in range(500)]
    out = evaluate.train_pairs(spark.createDataFrame(rows, "zodiac string, horo string"))
    assert out.count() == 500
    assert out.groupBy("source_text", "target_text").agg(
        F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    row = out.filter("source_text = 'Лев 7'").first()
    assert (row.target_text, row.source_chars, row.target_chars, row.target_words) == ("текст 7  x", 5, 10, 3)


def test_sign_dimension(spark):
    dim = lookup.sign_elements(spark)
    assert dim.count() == 12 == len(evaluate.PROMPTS)
    got = lookup.with_element(spark.createDataFrame([("Лев",), ("Рак",), ("?",)], "sign string")).collect()
    assert {r.sign: r.element for r in got} == {"Лев": "fire", "Рак": "water", "?": None}


def test_lookup_matches_null_keys_and_identical_rows(spark):
    big = spark.createDataFrame([(1, 7)] * 500 + [(2, None)] * 3 + [(3, 99)], "id int, k int")
    small = spark.createDataFrame([(7, 49), (None, -1)], "k int, v int")
    rows = lookup.lookup_join(big, small, "k")
    assert rows.columns == ["id", "k", "v"]
    got = {(r.id, r.v): r["count"] for r in rows.groupBy("id", "v").count().collect()}
    assert got == {(1, 49): 500, (2, -1): 3, (3, None): 1}


def test_lookup_is_one_join_and_no_extra_job(spark):
    plan = lookup.lookup_join(spark.range(1000).withColumn("k", F.lit(1)),
                              spark.range(50).withColumnRenamed("id", "k"), "k")
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    assert plan.count() == 1000


def test_texts_of_a_null_group_have_a_diversity(spark):
    df = spark.createDataFrame([(1, None, [1.0, 0.0]), (2, None, [0.0, 1.0]), (3, "a", [1.0, 1.0])],
                               "id int, g string, embedding array<double>")
    got = {r.id: round(r.diver, 6) for r in evaluate.text_diversity(df, by=["g"]).collect()}
    assert got == {1: 0.5, 2: 0.5, 3: 0.0}
