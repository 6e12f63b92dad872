"""Streams against their batch forms."""

import json
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallymill.operators import features, model
from tallymill.plans.views import clicks, transactions
from tallymill.schemas import TRANSACTIONS
from tallymill.sources.clicks import numbers, synthetic_clicks, to_messages
from tallymill.streaming import cleaning, run
from tallymill.streaming.clicks import (
    dedupe_redelivered, dedupe_written, filter_clicks, parse_clicks, read_deduped, rekey)
from tallymill.streaming.scoring import score_stream, score_with_latest


def messages(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


GOOD = {"ts": 1, "user_id": 7, "geo": "ru", "object_id": "link3", "domain": None,
        "url": "u", "url_from": "f"}


def test_edge_messages(spark):
    no_geo = {k: v for k, v in GOOD.items() if k != "geo"}
    df = messages(spark, [json.dumps(GOOD), "{broken", json.dumps(no_geo),
                          json.dumps({**GOOD, "geo": "ua"}), ""])
    kept = filter_clicks(df)
    assert kept.columns == ["ts", "user_id", "object_id", "domain", "url"]
    assert [tuple(r) for r in kept.collect()] == [(1, 7, "link3", None, "u")]
    out = rekey(kept).first()
    assert out.key == "7"
    assert json.loads(out.value) == {"ts": 1, "user_id": 7, "object_id": "link3", "url": "u"}
    full = rekey(kept, ignore_null_fields=False).first()
    assert json.loads(full.value)["domain"] is None


def test_bytes_parse_like_text(spark):
    df = messages(spark, [json.dumps(GOOD)])
    as_bytes = df.withColumn("value", F.col("value").cast("binary"))
    assert parse_clicks(as_bytes).collect() == parse_clicks(df).collect()


def test_country_filter_precedes_the_projection(spark):
    plan = filter_clicks(messages(spark, ["{}"]))._jdf.queryExecution().optimizedPlan().toString()
    assert "geo" in plan and "url_from" not in plan.split("\n")[0]


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    batch = to_messages(clicks(spark, "/root/testdata/sf0.001"))
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    batch.repartition(4).write.parquet(src)
    stream = lambda: rekey(filter_clicks(run.file_stream(spark, src, batch.schema, max_files=1)))
    run.drain(stream(), out, ck, timeout=120)
    want = rekey(filter_clicks(batch))
    got = spark.read.parquet(out)
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    run.drain(stream(), out, ck, timeout=120)
    assert spark.read.parquet(out).count() == want.count()
    batch.limit(50).write.mode("append").parquet(src)
    run.drain(stream(), out, ck, timeout=120)
    assert spark.read.parquet(out).count() == want.count() + rekey(filter_clicks(batch.limit(50))).count()


def test_continuous_trigger_returns_a_handle(spark, tmp_path):
    batch = to_messages(clicks(spark, "/root/testdata/sf0.001"))
    batch.write.parquet(str(tmp_path / "src"))
    stream = rekey(filter_clicks(run.file_stream(spark, str(tmp_path / "src"), batch.schema)))
    query = run.start(stream, str(tmp_path / "ck"), options={"path": str(tmp_path / "out")},
                      interval="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == filter_clicks(batch).count()


@pytest.mark.parametrize("spread_by", [None, "delivery"])
def test_redelivered_events_pass_once(spark, tmp_path, spread_by):
    rows = [(i % 40, datetime(2024, 1, 1, 0, 0, i % 40), i) for i in range(200)]
    rows += [(7, datetime(2024, 1, 1, 0, 0, 7), 1000 + i) for i in range(100)]     # a hot event
    df = spark.createDataFrame(rows, "event_id int, ts timestamp, delivery int")
    df.repartition(5).write.parquet(str(tmp_path / "src"))
    stream = run.file_stream(spark, str(tmp_path / "src"), df.schema, max_files=1)
    deduped = dedupe_redelivered(stream, "event_id", "ts", "10 minutes", spread_by=spread_by)
    run.drain(deduped, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(40))


def _out_of_order(spark, path):
    """Two deliveries of 300 events, days apart, without regard to time in four files."""
    day = lambda i: datetime(2024, 1, 1 + i * 7 % 25, i % 24)
    rows = [(i, day(i), d) for i in range(300) for d in (1, 2)]
    df = spark.createDataFrame(rows, "event_id int, ts timestamp, delivery int")
    df.repartition(4, F.xxhash64("event_id", "delivery")).write.parquet(path)
    return run.file_stream(spark, path, df.schema, max_files=1)


def test_late_rows_are_reported(spark, tmp_path):
    stream = _out_of_order(spark, str(tmp_path / "src"))
    deduped = dedupe_redelivered(stream, "event_id", "ts", "10 minutes")
    with pytest.raises(ValueError, match="too late"):
        run.drain(deduped, str(tmp_path / "out"), str(tmp_path / "ck"), late="fail")
    wide = dedupe_redelivered(stream, "event_id", "ts", "60 days")
    run.drain(wide, str(tmp_path / "all"), str(tmp_path / "ck2"), late="fail")
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "all")).collect()) == list(range(300))


def test_written_dedup_loses_no_late_event(spark, tmp_path):
    stream = _out_of_order(spark, str(tmp_path / "src"))
    sink = str(tmp_path / "out")
    for _ in range(2):                                     # a restart adds nothing
        dedupe_written(stream, "event_id", sink, str(tmp_path / "ck"), buckets=4)
        kept = read_deduped(spark, sink)
        assert sorted(r.event_id for r in kept.collect()) == list(range(300))
    assert spark.read.parquet(sink).select("_batch").distinct().count() > 1


@pytest.mark.parametrize("dedup", ["between", "last"])
def test_many_batches_clean_like_one(spark, tmp_path, dedup):
    from tallymill.operators.clean import clean_transactions

    tx = transactions(spark, "/root/testdata/sf0.001")
    tx.repartition(5, F.xxhash64(*tx.columns)).write.parquet(str(tmp_path / "src"))
    stream = run.file_stream(spark, str(tmp_path / "src"), tx.schema, max_files=1)
    cleaning.clean_arrivals(stream, str(tmp_path / "sink"), str(tmp_path / "ck"), dedup)
    got, want = cleaning.read_cleaned(spark, str(tmp_path / "sink"), dedup), clean_transactions(tx, dedup)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_arriving_files_are_cleaned_once(spark, tmp_path):
    t = datetime(2019, 8, 22)
    row = lambda i, c=1: (i, t, c, 5, 1.0, 1, 1, 0, 0)
    day1 = spark.createDataFrame([row(1), row(1), row(2, -1)], TRANSACTIONS)
    day2 = spark.createDataFrame([row(1), row(3)], TRANSACTIONS)
    src, sink, ck = (str(tmp_path / n) for n in ("src", "sink", "ck"))
    go = lambda: cleaning.clean_arrivals(run.file_stream(spark, src, TRANSACTIONS), sink, ck)
    day1.coalesce(1).write.parquet(src)
    go()
    day2.coalesce(1).write.mode("append").parquet(src)
    go()
    go()
    written = spark.read.parquet(sink)
    # Rows that only break an id rule wait for the reader.
    assert sorted((r.tranaction_id, r.batch) for r in written.collect()) == [(1, 0), (1, 1), (2, 0), (3, 1)]
    assert sorted(r.tranaction_id for r in cleaning.read_cleaned(spark, sink).collect()) == [1, 3]


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    from tallymill.operators.clean import clean_transactions

    tx = features.with_class_weight(
        clean_transactions(transactions(spark, "/root/testdata/sf0.001")), "tx_fraud")
    fitted = model.build_pipeline("tx_fraud").fit(tx)
    tx.write.parquet(str(tmp_path / "src"))
    stream = score_stream(fitted, run.file_stream(spark, str(tmp_path / "src"), tx.schema))
    run.drain(stream.select("tranaction_id", "score"), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = {r.tranaction_id: r.score for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r.tranaction_id: r.score for r in model.score(fitted, tx).collect()}
    assert got == pytest.approx(want)
    assert score_stream(fitted, tx, threshold=2.0).count() == 0


def test_click_job_runs_end_to_end(spark, tmp_path):
    from tallymill.plans.jobs import click_job

    batch = to_messages(clicks(spark, "/root/testdata/sf0.001"))
    batch.write.parquet(str(tmp_path / "src"))
    stream = run.file_stream(spark, str(tmp_path / "src"), batch.schema)
    query = click_job(stream, str(tmp_path / "ck"), {"path": str(tmp_path / "out")}, fmt="parquet",
                      available_now=True)
    assert query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).columns == ["key", "value"]
    assert spark.read.parquet(str(tmp_path / "out")).count() == filter_clicks(batch).count()


def test_messages_are_routed_on_a_stream(spark, tmp_path):
    from tallymill.operators.routing import route

    batch = spark.createDataFrame([("Назад",), ("hello",), ("?",)], "text string")
    batch.write.parquet(str(tmp_path / "src"))
    stream = route(run.file_stream(spark, str(tmp_path / "src"), batch.schema))
    run.drain(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = {r.text: r.intent for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"Назад": "back", "hello": "greeting", "?": "fallback"}


def test_late_rows_are_counted_beyond_what_a_query_remembers(spark, tmp_path):
    from tallymill.streaming.progress import watched

    day = lambda i: datetime(2024, 1, 1 + i)
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        # The late rows are in the first files, the last ones hold none.
        for i in range(9):
            rows = [(10 * i, day(i + 5))] + ([(10 * i + k, day(0)) for k in (1, 2)] if 2 <= i < 5 else [])
            spark.createDataFrame(rows, "event_id int, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "src"))
        stream = run.file_stream(spark, str(tmp_path / "src"), "event_id int, ts timestamp", max_files=1)
        deduped = dedupe_redelivered(stream, "event_id", "ts", "1 hour")
        with watched(spark) as progress:
            query = run.start(deduped, str(tmp_path / "ck"), options={"path": str(tmp_path / "out")}, available_now=True)
            query.awaitTermination()
            totals = progress.totals(query)
        assert run.late_rows(query) < totals["late_rows"] == 6
        assert totals["fed_batches"] == 9 and totals["input_rows"] == 15
        with pytest.raises(ValueError, match="6 rows"):
            run.drain(deduped, str(tmp_path / "out2"), str(tmp_path / "ck2"), late="fail", log=(str(tmp_path / "log"), "r"))
        log = {r.name: r.value for r in spark.read.parquet(str(tmp_path / "log")).collect()}
        assert log["late_rows"] == "6" and log["input_rows"] == "15"
    finally:
        spark.conf.set(key, before)


def test_a_new_champion_takes_over_between_micro_batches(spark, tmp_path):
    models, src, sink, ck = (str(tmp_path / n) for n in ("models", "src", "sink", "ck"))
    spark.range(90).select("id", (F.col("id") / 10).alias("x")).repartition(3).write.parquet(src)
    model.publish(spark, {None: 0.0, "x": 0.0}, models, 1)
    stream = lambda: run.file_stream(spark, src, "id long, x double", max_files=1)
    swap = lambda batch: batch == 0 and model.publish(spark, {None: 1.0, "x": -1.0}, models, 2)

    def stop(batch):
        swap(batch)
        if batch == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        score_with_latest(stream(), models, sink, ck, after=stop)
    score_with_latest(stream(), models, sink, ck)
    rows = spark.read.parquet(sink).collect()
    assert sorted(r.id for r in rows) == list(range(90))
    assert {(r["_batch"], r.model_version) for r in rows} == {(0, 1), (1, 2), (2, 2)}
    for r in rows:
        assert r.score == pytest.approx(0.5 if r.model_version == 1 else 1 / (1 + math.exp(r.x - 1)))


def test_scoring_needs_a_published_model(spark, tmp_path):
    spark.createDataFrame([], "model_version long, feature string, weight double").write.parquet(str(tmp_path / "none"))
    with pytest.raises(ValueError, match="no model"):
        model.latest_weights(spark, str(tmp_path / "none"))


def test_generated_numbers_go_on_after_a_restart(spark, tmp_path):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    for _ in range(3):
        run.drain(numbers(spark, 40, start=1000, step=60, partitions=3), out, ck, timeout=120)
    rows = sorted((r.value, r.ts) for r in spark.read.parquet(out).collect())
    assert rows == [(v, 1000 + 60 * (v // 40)) for v in range(120)]
    keys = spark.createDataFrame(rows, "value long, ts long")
    streamed = synthetic_clicks(spark.read.parquet(out), "value", "ts")
    assert streamed.exceptAll(synthetic_clicks(keys, "value", "ts")).count() == 0
