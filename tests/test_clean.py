from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallymill.functions.text import clean_corpus_text
from tallymill.operators import clean
from tallymill.operators.clean import Complete, Keep, Unique
from tallymill.plans.views import transactions
from tallymill.schemas import CORPUS, TRANSACTIONS

T0 = datetime(2019, 8, 22, 5, 10, 37)


def tx(spark, rows):
    """Rows of (id, datetime, customer, terminal, amount)."""
    return spark.createDataFrame(
        [(i, t, c, m, a, 1, 1, 0, 0) for i, t, c, m, a in rows], TRANSACTIONS)


def ids(df):
    return sorted(r[0] for r in df.select("tranaction_id").collect())


def test_copies_are_removed_before_the_id_rules(spark):
    # The surviving copy (lower customer) breaks the customer rule: the id is lost.
    df = tx(spark, [(1, T0, -1, 5, 1.0), (1, T0, 7, 5, 1.0), (2, T0, 7, 5, 1.0)])
    assert ids(clean.clean_transactions(df)) == [2]
    assert ids(clean.clean_transactions(df, dedup="last")) == [1, 2]


@pytest.mark.parametrize("dedup,expected", [("between", 38962), ("last", 39960)])
def test_rule_order_changes_the_row_count(spark, sf_dir, dedup, expected):
    assert clean.clean_transactions(transactions(spark, sf_dir), dedup).count() == expected


def test_survivor_does_not_depend_on_partitioning(spark):
    rows = [(i % 7, T0, i % 5, i % 3, float(i % 11 + 1)) for i in range(500)]
    a = clean.first_by_key(tx(spark, rows).repartition(1), ["tranaction_id"])
    b = clean.first_by_key(tx(spark, rows[::-1]).repartition(13), ["tranaction_id"])
    assert sorted(a.collect()) == sorted(b.collect())
    expected = {}
    for r in rows:
        expected[r[0]] = min(expected.get(r[0], r), r)
    got = {r.tranaction_id: (r.customer_id, r.terminal_id, r.tx_amount) for r in a.collect()}
    assert got == {k: v[2:] for k, v in expected.items()}


def test_latest_survivor_follows_the_ranking_column(spark):
    df = spark.createDataFrame([(1, 10, "old"), (1, 20, "a"), (1, 20, "b"), (2, 5, "x")],
                               "id int, run int, v string")
    got = clean.first_by_key(df, ["id"], order_by=["run"], latest=True).collect()
    assert sorted(map(tuple, got)) == [(1, 20, "b"), (2, 5, "x")]


def test_nan_and_null_rows_are_incomplete(spark):
    df = tx(spark, [(1, T0, 1, 5, float("nan")), (2, None, 1, 5, 1.0), (3, T0, 1, None, 1.0),
                    (4, T0, 1, 5, 1.0)])
    assert ids(df.filter(clean.complete_row(df))) == [4] == ids(df.na.drop("any"))


def test_amount_rule_alone_lets_nan_pass(spark):
    df = tx(spark, [(1, T0, 1, 5, float("nan")), (2, T0, 1, 5, 0.0)])
    assert ids(clean.apply_rules(df, [Keep("amount", "tx_amount > 0")])) == [1]


def test_cleaning_is_idempotent_and_a_subset(spark, sf_dir):
    raw = transactions(spark, sf_dir)
    once = clean.clean_transactions(raw)
    assert clean.clean_transactions(once).exceptAll(once).count() == 0
    assert once.exceptAll(raw).count() == 0


@pytest.mark.parametrize("dedup", ["between", "last"])
def test_report_adds_up_and_agrees_with_cleaning(spark, sf_dir, dedup):
    raw = transactions(spark, sf_dir)
    rules = clean.transaction_rules(dedup)
    report = {r.rule: r.n_rows for r in clean.reject_report(raw, rules).collect()}
    assert list(report)[:-1] == [r.name for r in rules]
    assert sum(report.values()) == raw.count()
    assert report["kept"] == clean.apply_rules(raw, rules).count()


def test_report_without_a_key_rule_and_on_no_rows(spark):
    df = tx(spark, [(1, T0, -1, 5, 1.0), (2, T0, 1, None, 1.0)])
    rules = [Complete(), Keep("customer", "customer_id >= 0")]
    got = {r.rule: r.n_rows for r in clean.reject_report(df, rules).collect()}
    assert got == {"complete": 1, "customer": 1, "kept": 0}
    empty = clean.reject_report(df.filter("false"), clean.transaction_rules())
    assert {r.n_rows for r in empty.collect()} == {0}


def test_report_refuses_two_key_rules(spark):
    with pytest.raises(ValueError):
        clean.reject_report(tx(spark, []), [Unique(("a",)), Unique(("b",))])


def test_corpus_cleaning(spark):
    d = datetime(2024, 3, 2)
    body = "Сегодня вам повезёт. " * 20          # 420 characters
    rows = [
        (d, "Лев", body + "\u00a0хвост", "a"),   # cut at the no-break space
        (d, "Лев", body, "b"),                   # same text, other source: kept
        (d, "Лев", body, "b"),                   # full copy: dropped
        (d, "Рак", "я" * 300, "a"), (d, "Рак", "я" * 500, "a"),
        (d, "Рак", "я" * 301, "a"), (d, "Рак", "я" * 499, "a"),
        (d, "Гороскоп на сегодня", body, "a"), (d, "Для всех знаков зодиака.", body, "a"),
        (d, "", "й" * 250 + "\n" + "abc" + "ё" * 100, "a"),
        (d, None, body, "a"), (None, "Лев", body, "a"),
    ]
    out = clean.clean_corpus(spark.createDataFrame(rows, CORPUS), clean_corpus_text).collect()
    assert sorted((r.zodiac, len(r.horo), r.source) for r in out) == [
        ("", 350, "a"), ("Лев", 420, "a"), ("Лев", 420, "b"), ("Рак", 301, "a"), ("Рак", 499, "a")]


def test_plain_documents_give_the_known_count(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.lit(datetime(2024, 3, 2)).alias("date"), F.col("lang").alias("zodiac"),
        F.col("text").alias("horo"), "source")
    from tallymill.plans.corpus import any_script

    out = clean.clean_corpus(docs, any_script)
    assert out.agg(F.count("*"), F.sum(F.length("horo"))).first()[:] == (75, 30876)
