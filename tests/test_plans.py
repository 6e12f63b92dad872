"""Plan shapes that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tallymill.operators import clean, profile, validate
from tallymill.plans import corpus as corpus_plans, transactions as transaction_plans
from tallymill.plans.views import predictions, transactions
from tallymill.sources import files
from tallymill.streaming.run import file_stream

LAZY = ["clean_transactions", "reject_report", "profile_missing", "profile_summary", "profile_keys",
        "id_gaps", "cross_run_dedup", "clean_text", "train_pairs", "extract_records", "class_weights",
        "weighted_transactions", "standardise", "weighted_auc", "auc_replicates", "threshold_metrics",
        "diversity", "diversity_by_group", "text_diversity", "sweep_report", "reconcile",
        "click_messages", "synthetic_clicks", "route_messages", "run_metrics_latest"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops_and_no_python(spark, sf_dir, name):
    text = plan(registry.queries()[name](spark, sf_dir))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize("name", ["profile_missing", "profile_summary", "profile_violations",
                                  "profile_domains", "value_histograms", "reject_report",
                                  "threshold_metrics", "diversity", "clean_transactions"])
def test_one_scan(spark, sf_dir, name):
    assert plan(registry.queries()[name](spark, sf_dir)).count("FileScan") == 1


def test_cleaning_rules_reach_the_scan_and_shuffle_once(spark, tmp_path):
    path = str(tmp_path / "tx")
    transactions(spark, "/root/testdata/sf0.001").write.parquet(path)
    text = plan(clean.clean_transactions(spark.read.parquet(path)))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "GreaterThan(tx_amount,0.0)" in pushed and "IsNotNull(terminal_id)" in pushed
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_min" in text                       # copies reduce before they move


def test_projection_is_pruned(spark, tmp_path):
    path = str(tmp_path / "tx")
    transactions(spark, "/root/testdata/sf0.001").write.parquet(path)
    text = plan(profile.key_profile(spark.read.parquet(path), "tranaction_id"))
    assert "ReadSchema: struct<tranaction_id:bigint>" in text


def test_text_is_cleaned_once_ahead_of_the_band_filter(spark, sf_dir):
    text = plan(registry.queries()["clean_text"](spark, sf_dir))
    conditions = [line for line in re.split(r"\n(?=\s*[:+*])", text) if " Filter " in line]
    assert conditions and sum(c.count("regexp_replace") for c in conditions) == 1


def test_auc_is_ranked_in_segments(spark, sf_dir):
    text = plan(validate.weighted_auc(predictions(spark, sf_dir), "label", "score_a", "weight"))
    assert "rangepartitioning" in text
    assert re.search(r"windowspecdefinition\(_seg#\d+, _s#\d+", text)


def test_gap_windows_are_blocked(spark, sf_dir):
    text = plan(profile.id_gaps(transactions(spark, sf_dir), "tranaction_id"))
    assert text.count("windowspecdefinition(block#") == 3


def test_corpus_ranges_are_written_by_all_tasks(spark, monkeypatch):
    text = F.repeat(F.lit('it said "so",\n'), 35)
    records = spark.range(0, 4, 1, 4).select(
        F.timestamp_seconds(F.lit(0)).alias("date"), F.col("id").cast("string").alias("zodiac"), text.alias("horo"), F.lit("s").alias("source"))
    written, append_records = [], files.append_records

    def append(df, path, fmt):
        append_records(df, path, fmt=fmt)
        written.append(len(spark.read.text(path).inputFiles()))

    monkeypatch.setattr(corpus_plans, "corpus", lambda spark, sf_dir: records)
    monkeypatch.setattr(corpus_plans.files, "append_records", append)
    assert corpus_plans.csv_corpus_ranges(spark, "").count() == clean.clean_corpus(records, corpus_plans.any_script).count() > 0
    assert written == [4]


@pytest.mark.parametrize("dedup", ["between", "last"])
def test_arrivals_stand_in_files_of_bounded_rows(spark, monkeypatch, dedup):
    tx = spark.range(4000).selectExpr(
        "id % 3000 AS tranaction_id", "timestamp'2024-01-01' AS tx_datetime", "id % 7 - 1 AS customer_id", "id % 1100 AS terminal_id",
        "CAST(id % 50 AS float) AS tx_amount", "CAST(id AS int) AS tx_time_seconds", "1 AS tx_time_days", "0 AS tx_fraud",
        "0 AS tx_fraud_scenario")
    staged = []

    def stream(spark, path, schema, max_files):
        staged.extend([spark.read.parquet(path).groupBy(F.input_file_name()).count().collect(), max_files])
        return file_stream(spark, path, schema, max_files=max_files)

    monkeypatch.setattr(transaction_plans, "transactions", lambda spark, sf_dir: tx)
    monkeypatch.setattr(transaction_plans, "_ROWS_PER_FILE", 250)
    monkeypatch.setattr(transaction_plans, "file_stream", stream)
    got = transaction_plans._arrivals(spark, "", dedup).collect()
    assert len(staged[0]) == 16 and staged[1] == 4 and max(r["count"] for r in staged[0]) < 500
    assert sorted(got) == sorted(transaction_plans._shown(clean.clean_transactions(tx, dedup)).collect())
