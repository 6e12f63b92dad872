import random
from datetime import datetime

import pytest

from tallymill.operators import profile
from tallymill.schemas import CLICKS, TRANSACTIONS


def longs(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def gaps_by_hand(values):
    s = sorted(set(values))
    return [(a + 1, b - 1, b - a - 1) for a, b in zip(s, s[1:]) if b > a + 1]


@pytest.mark.parametrize("values", [
    [1, 2, 3], [5], [1, 1, 1, 4, 4, 9], [65535, 65536, 65538], [-3, -1, 0, 2],
    [0, 2 ** 16, 2 ** 32, 2 ** 48, 2 ** 62], [-2 ** 50, -1, 2 ** 33 + 7, 2 ** 33 + 9],
])
def test_id_gaps(spark, values):
    got = sorted(map(tuple, profile.id_gaps(longs(spark, values + [None]), "id").collect()))
    assert got == gaps_by_hand(values)


def test_id_gaps_with_a_hot_id(spark):
    rng = random.Random(3)
    values = [70000] * 3000 + [rng.randrange(300000) for _ in range(6000)]
    got = sorted(map(tuple, profile.id_gaps(longs(spark, values).repartition(9), "id").collect()))
    assert got == gaps_by_hand(values)


def test_key_profile_counts_a_null_as_one_value(spark):
    row = profile.key_profile(longs(spark, [1, 1, 4, None, None]), "id").first()
    assert (row.n_rows, row.n_null, row.n_distinct, row.n_duplicates) == (5, 2, 3, 2)
    assert (row.id_span, row.n_unused, row.n_missing_ids) == (3, 0, 2)


def test_span_is_one_short_of_the_id_count(spark):
    row = profile.key_profile(longs(spark, [1, 2, 3, 4]), "id").first()
    assert (row.id_span, row.n_unused, row.n_missing_ids) == (3, -1, 0)


def test_approximate_key_profile(spark):
    row = profile.key_profile(spark.range(20000), "id", approx_rsd=0.01).first()
    assert abs(row.n_distinct - 20000) < 800


def test_missing_counts_tell_null_zero_and_nan_apart(spark):
    t = datetime(2020, 1, 1)
    rows = [(1, t, 0, None, 0.0, 0, 1, 0, 0), (None, None, 1, 2, float("nan"), 1, None, 0, 0),
            (3, t, 1, 2, None, 1, 1, None, 0)]
    got = {r.column: tuple(r)[1:] for r in profile.missing_profile(
        spark.createDataFrame(rows, TRANSACTIONS)).collect()}
    assert got["tx_amount"] == (1, 1, 1, 2)          # the null is not in the last number
    assert got["tx_time_seconds"] == (0, 1, 0, 1)
    assert got["tx_time_days"] == (1, 0, 0, 0)
    assert got["customer_id"] == (0, 1, 0, 0)        # a zero id is not missing
    assert got["terminal_id"] == (1, 0, 0, 1)
    assert got["tx_datetime"] == (1, 0, 0, 1)
    assert "tx_fraud" not in got


def test_summary_agrees_with_describe(spark):
    df = spark.createDataFrame([(1, 2.5, "b"), (2, None, "a"), (4, 0.5, None)],
                               "i int, x double, s string")
    got = {r.column: r for r in profile.summary(df).collect()}
    want = {r["summary"]: r for r in df.describe().collect()}
    for c in ("i", "x"):
        assert got[c].n == int(want["count"][c])
        assert got[c]["mean"] == pytest.approx(float(want["mean"][c]), abs=1e-4)
        assert got[c]["stddev"] == pytest.approx(float(want["stddev"][c]), abs=1e-4)
        assert (got[c]["min"], got[c]["max"]) == (float(want["min"][c]), float(want["max"][c]))
    assert (got["s"].n, got["s"].min_text, got["s"].max_text, got["s"]["mean"]) == (2, "a", "b", None)


def test_percentiles(spark):
    got = {r.percentile: r.value for r in profile.percentiles(spark.range(101), ["id"]).collect()}
    assert got == {0.25: 25.0, 0.5: 50.0, 0.75: 75.0}


def test_domain_check_and_histogram(spark):
    df = spark.createDataFrame([(0, 0), (1, 5), (2, None)], "tx_fraud int, tx_fraud_scenario int")
    got = {r.column: (r.n_outside, r.n_null) for r in profile.domain_check(df).collect()}
    assert got == {"tx_fraud": (1, 0), "tx_fraud_scenario": (1, 1)}
    hist = {(r.column, r.value): r.n for r in
            profile.value_histogram(df, ["tx_fraud", "tx_fraud_scenario"]).collect()}
    assert hist[("tx_fraud_scenario", None)] == 1 and len(hist) == 6


def test_extremes_hold_null_at_the_low_end(spark):
    got = profile.extremes(longs(spark, [5, 5, 1, 9, None]), "id", k=2).collect()
    low = sorted((r.value for r in got if r.edge == "lowest"), key=lambda v: (v is not None, v))
    high = sorted(r.value for r in got if r.edge == "highest")
    assert low == [None, 1] and high == [5, 9]


def test_extremes_keep_the_type(spark):
    df = spark.createDataFrame([(901.5, "b"), (0.25, "a")], "x double, t string")
    edge = lambda c: sorted(r.value for r in profile.extremes(df, c, k=1).collect())
    assert edge("x") == [0.25, 901.5] and edge("t") == ["a", "b"]


def test_absence(spark):
    df = spark.createDataFrame([(None, 0), (0.0, 5), (float("nan"), None), (1.0, 2)], "x double, i int")
    got = {(r.column, r.why): r.n for r in profile.absence_counts(df, ["x", "i"]).collect()}
    assert got == {("x", "null"): 1, ("x", "zero"): 1, ("x", "nan"): 1, ("i", "zero"): 1, ("i", "null"): 1}


def test_schema_drift(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "ts int, geo string, extra double")
    drift = profile.schema_drift(df, CLICKS)
    assert ("extra", None, "double") in drift and ("user_id", "int", None) in drift
    assert profile.schema_drift(spark.createDataFrame([], CLICKS), CLICKS) == []


def test_violations_run_in_one_pass(spark):
    df = spark.createDataFrame([(-1, 5), (3, 1000), (None, None)], "customer_id int, terminal_id int")
    got = {r.rule: r.n_rows for r in profile.violations(df, profile.TRANSACTION_VIOLATIONS).collect()}
    assert got == {"negative_customer": 1, "terminal_over_999": 1}
