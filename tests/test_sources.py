"""Files, Kafka options, run log, jobs."""

import os
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallymill import __main__ as cli, schemas, session
from tallymill.operators import clean, validate
from tallymill.plans import jobs
from tallymill.plans.views import transactions
from tallymill.sources import clicks, files, kafka, runs

CSV = """# tranaction_id | tx_datetime | customer_id | terminal_id | tx_amount
1,2019-08-22 05:10:37,0,753,70.91,18637,0,0,0
2,2019-08-22 05:10:37,-999999,5,1.0,1,0,0,0
3,2019-08-22 24:00:00,1,5,1.0,1,0,0,0
4,2019-08-22 05:10:37,1,Err,1.0,1,0,0,0
5,2019-08-22,1,1000,1,1,0,0,0
6,2019-08-22 05:10:37,1
# a comment further down
7,2019-08-22 05:10:37,1,5,NaN,1,0,0,0
8,2019-08-22,1,999,1,1,0,1,2
"""


@pytest.fixture
def csv_dir(tmp_path):
    folder = tmp_path / "raw"
    (folder / "nested").mkdir(parents=True)
    (folder / "day.txt").write_text(CSV)
    (folder / "nested" / "x.txt").write_text("99,2019-08-22 05:10:37,0,753,70.91,1,0,0,0\n")
    return str(folder)


def test_transaction_csv_edge_rows(spark, csv_dir):
    df = files.read_transactions_csv(spark, csv_dir)
    rows = {r.tranaction_id: r for r in df.collect()}
    assert set(rows) == {1, 2, 3, 4, 5, 6, 7, 8}          # comments and sub-folders are not read
    assert rows[3].tx_datetime is None and rows[4].terminal_id is None
    assert rows[5].tx_datetime == datetime(2019, 8, 22)
    assert rows[6].tx_amount is None
    assert rows[1].tx_amount == pytest.approx(70.91, abs=1e-5)
    assert [r[0] for r in clean.clean_transactions(df).select("tranaction_id").orderBy("tranaction_id").collect()] == [1, 8]


def test_ids_beyond_32_bits_are_read(spark, tmp_path):
    (tmp_path / "big.csv").write_text("5000000000,2019-08-22 05:10:37,0,753,70.91,1,0,0,0\n")
    counts = jobs.clean_job(spark, str(tmp_path / "big.csv"), str(tmp_path / "out"), datetime(2024, 3, 1), audit=True)
    assert (counts["rows_kept"], counts["rules"]["complete"]) == (1, 0)


def test_corrupt_lines_can_be_kept(spark, csv_dir):
    df = files.read_transactions_csv(spark, csv_dir, corrupt_column="_corrupt").cache()
    bad = {r.tranaction_id for r in df.filter("_corrupt IS NOT NULL").collect()}
    df.unpersist()
    assert bad == {3, 4, 6}


def test_time_parser_policy_is_left_alone(spark):
    assert spark.conf.get("spark.sql.legacy.timeParserPolicy") != "LEGACY"


def test_corpus_csv_keeps_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "corpus.csv"
    path.write_text('2024-03-02,Лев,"первая\nвторая, ""цитата""",a\n2024-03-02,Рак,одна,b\n')
    rows = sorted((r.zodiac, r.horo) for r in files.read_corpus_csv(spark, str(path)).collect())
    assert rows == [("Лев", 'первая\nвторая, "цитата"'), ("Рак", "одна")]
    pieces = files.read_corpus_csv(spark, str(path), multi_line=False).na.drop("any")
    assert [r.zodiac for r in pieces.collect()] == ["Рак"]        # the broken record is lost
    headed = files.read_corpus_csv(spark, str(path), header=True)
    assert [r.zodiac for r in headed.collect()] == ["Рак"]        # a header eats the first record


def test_append_and_overwrite_sinks(spark, tmp_path):
    day = lambda d, n: spark.createDataFrame([(datetime(2024, 3, d), "Лев", f" t{n} ", "s")], schemas.CORPUS)
    raw = str(tmp_path / "raw")
    files.append_records(day(1, 1), raw)
    files.append_records(day(2, 2), raw)
    files.append_records(day(2, 3), raw)
    assert spark.read.parquet(raw).count() == 3
    assert spark.read.parquet(raw).filter("day = '2024-03-02'").count() == 2
    csv = str(tmp_path / "csv")
    files.append_records(day(1, 1), csv, fmt="csv")
    assert files.read_corpus_csv(spark, csv).first().horo == " t1 "
    out = str(tmp_path / "out")
    files.write_new(day(1, 1), out)
    with pytest.raises(AnalysisException):
        files.write_new(day(1, 1), out)
    files.write_overwrite(day(2, 2), out)
    assert spark.read.parquet(out).first().horo == " t2 "
    parts = str(tmp_path / "parts")
    files.write_overwrite(day(1, 1), parts, partition_by=["zodiac"])
    files.write_overwrite(day(1, 1).withColumn("zodiac", F.lit("Рак")), parts,
                          partition_by=["zodiac"], dynamic=True)
    assert spark.read.parquet(parts).count() == 2


def test_runs_are_separate_folders(spark, tmp_path):
    path = str(tmp_path / "runs")
    df = spark.range(5).withColumnRenamed("id", "tranaction_id").withColumn("v", F.lit(1))
    files.write_run(df, path, datetime(2024, 3, 1, 10, 0, 0))
    files.write_run(df.withColumn("v", F.lit(2)), path, datetime(2024, 3, 2, 10, 0, 0))
    both = files.read_runs(spark, f"{path}/run_ts=*")
    assert both.count() == 10 and "run_ts=20240302100000" in both.filter("v = 2").first().run_path
    newest = clean.first_by_key(both, ["tranaction_id"], order_by=["run_path"], latest=True)
    assert newest.count() == 5 and newest.filter("v = 1").count() == 0


def test_scores_sink(spark, tmp_path):
    scores = spark.createDataFrame([("initial", 0, 0.5)], "model string, replicate int, auc double")
    files.write_scores(scores, str(tmp_path / "s"), "r1")
    files.write_scores(scores, str(tmp_path / "s"), "r2")
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2
    files.write_scores(scores, str(tmp_path / "c"), "r1", fmt="csv")
    text = "".join(r.value for r in spark.read.text(str(tmp_path / "c")).collect())
    assert '"initial","0","0.5"' in text


def test_file_inventory(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"12345")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.txt").write_bytes(b"1")
    df = files.file_inventory(spark, str(tmp_path), "*.txt")
    assert sorted(r.size for r in df.collect()) == [1, 5]
    assert "content" not in df._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_listing_file(spark, tmp_path):
    (tmp_path / "l.txt").write_text("2022-12-05 12:23:48 5 p/a\n\nTotal Objects: 1\n   Total Size: 5\n")
    assert files.read_listing(spark, str(tmp_path / "l.txt")).count() == 1


def test_kafka_options(monkeypatch):
    monkeypatch.delenv("KAFKA_USERNAME", raising=False)
    options = kafka.source_options("b:9091", "clicks", username="u", password='p"w', ca_location="/ca")
    assert options["subscribe"] == "clicks" and options["startingOffsets"] == "earliest"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert options["kafka.sasl.mechanism"] == "SCRAM-SHA-512"
    assert 'username="u" password="p\\"w";' in options["kafka.sasl.jaas.config"]
    assert options["kafka.ssl.truststore.location"] == "/ca"
    assert options["kafka.ssl.truststore.type"] == "PEM"
    assert kafka.sink_options("b:9091", "out") == {"kafka.bootstrap.servers": "b:9091", "topic": "out"}
    monkeypatch.setenv("KAFKA_USERNAME", "env")
    with pytest.raises(ValueError):
        kafka.connection("b:9091")
    monkeypatch.setenv("KAFKA_PASSWORD", "secret")
    assert "env" in kafka.connection("b:9091")["kafka.sasl.jaas.config"]
    assert kafka.source_options("b", "t", max_per_trigger=5)["maxOffsetsPerTrigger"] == "5"


def test_synthetic_clicks_stay_in_their_domains(spark):
    df = clicks.synthetic_clicks(spark.range(2000).withColumn("ts", F.lit(1700000000)), "id", "ts")
    assert df.schema.simpleString() == schemas.CLICKS.simpleString()
    row = df.agg(F.min("user_id"), F.max("user_id"), F.count_distinct("user_id"),
                 F.count_distinct("geo"), F.count_distinct("object_id")).first()
    assert row[:] == (1, 30, 30, 3, 90)
    bad = df.filter("url <> concat('https://example.com/', regexp_extract(object_id, '[a-z]+', 0), '/',"
                    " regexp_extract(object_id, '[0-9]+', 0))")
    assert bad.count() == 0


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    runs.log_run(spark, path, "r1", datetime(2024, 1, 1), {"auc": 0.5}, {"reg": 0.1}, {"p": "x"})
    runs.log_run(spark, path, "r2", datetime(2024, 1, 2), {"auc": 0.7})
    got = {(r.kind, r.name): (r.run_id, r.value) for r in runs.latest(spark.read.parquet(path)).collect()}
    assert got == {("metric", "auc"): ("r2", "0.7"), ("param", "reg"): ("r1", "0.1"), ("tag", "p"): ("r1", "x")}


class FakeSession:
    """Just enough of a session to ask for its settings."""

    def __init__(self, settings, master):
        self.conf = settings
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_shared_folder_comes_from_the_session():
    named = FakeSession({"spark.checkpoint.dir": "/shared/folder/"}, "spark://host")
    assert session.scratch_path(named, "x").startswith("/shared/folder/x-")
    with pytest.raises(ValueError, match="shared by all executors"):
        session.shared_dir(FakeSession({}, "spark://host"))


@pytest.fixture(scope="module")
def cleaned_runs(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("jobs"))
    small = "/root/testdata/sf0.001"
    transactions(spark, small).write.parquet(f"{root}/raw")
    for day in (1, 2):
        counts = jobs.clean_job(spark, f"{root}/raw", f"{root}/runs", datetime(2024, 3, day), fmt="parquet")
        assert counts == {"rows_kept": 3930}
    audited = jobs.clean_job(spark, f"{root}/raw", f"{root}/other", datetime(2024, 3, 1),
                             fmt="parquet", audit=True)
    assert audited["rules"]["kept"] == 3930 and sum(audited["rules"].values()) == 6000
    return root


def test_training_reads_each_id_once(spark, cleaned_runs):
    assert jobs.training_table(spark, f"{cleaned_runs}/runs/run_ts=*").count() == 3930
    assert jobs.training_table(spark, f"{cleaned_runs}/runs/run_ts=*", across_runs=False).count() == 7860


def test_train_job(spark, cleaned_runs, tmp_path):
    from pyspark.ml import PipelineModel

    metrics = jobs.train_job(spark, f"{cleaned_runs}/runs/run_ts=*", str(tmp_path / "m"),
                             str(tmp_path / "log"), "r", datetime(2024, 3, 3))
    assert 0.3 < metrics["aUROC_test"] < 0.7
    assert metrics["aUROC_avg"] >= metrics["aUROC_first"]
    assert len(PipelineModel.load(str(tmp_path / "m")).stages) == 3
    log = runs.latest(spark.read.parquet(str(tmp_path / "log")))
    assert {"regParam", "elasticNetParam", "aUROC_test", "model_family"} <= {r.name for r in log.collect()}


def test_validate_job(spark, cleaned_runs, tmp_path):
    row = jobs.validate_job(spark, f"{cleaned_runs}/runs/run_ts=*", str(tmp_path / "m"),
                            str(tmp_path / "scores"), str(tmp_path / "log"), "r", datetime(2024, 3, 3))
    assert row["champion"] == ("tuned" if row["p_value"] < validate.ALPHA else "initial")
    assert {"p_shapiro_initial", "p_shapiro_tuned", "stat_shapiro_initial"} <= set(row)
    scores = spark.read.parquet(str(tmp_path / "scores"))
    assert scores.columns == ["run", "model", "replicate", "auc"]
    assert os.path.isdir(str(tmp_path / "m"))


def test_review_job(spark, sf_dir):
    reports = jobs.review_job(transactions(spark, "/root/testdata/sf0.001"))
    assert {n: r.count() > 0 for n, r in reports.items()} == dict.fromkeys(reports, True)


def test_corpus_pairs_and_evaluation_jobs(spark, tmp_path):
    from tallymill.plans.views import generations

    body = "Сегодня вам повезёт. " * 20
    (tmp_path / "raw.csv").write_text(f'2024-03-02,Лев,"{body}\n",a\n2024-03-02,Рак,коротко,a\n')
    corpus, pairs = str(tmp_path / "corpus"), str(tmp_path / "pairs")
    jobs.corpus_job(spark, str(tmp_path / "raw.csv"), corpus)
    assert spark.read.parquet(corpus).count() == 1
    jobs.pairs_job(spark, corpus, pairs)
    assert spark.read.parquet(pairs).first().source_text == "Лев"
    report = jobs.evaluate_job(spark, generations(spark, "/root/testdata/sf0.01"),
                               str(tmp_path / "log"), "e", datetime(2024, 3, 2))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.select("run_id").distinct().count() == report.count() == 3


def test_command_line():
    args = cli.parse(["clean", "in", "out", "--format", "parquet", "--dedup", "last"])
    assert (args.job, args.source, args.sink, args.format, args.dedup) == ("clean", "in", "out", "parquet", "last")
    with pytest.raises(SystemExit):
        cli.parse(["unknown"])


def test_new_commands():
    args = cli.parse(["clicks", "b:1", "in", "out", "ck", "--starting-offsets", "latest", "--interval", "5 seconds", "--available-now"])
    assert (args.starting_offsets, args.interval, args.available_now) == ("latest", "5 seconds", True)
    assert cli.parse(["arrivals", "a", "b", "c", "d", "--dedup", "last"]).dedup == "last"
    assert cli.parse(["score", "a", "b", "c", "d", "--threshold", "0.5"]).threshold == 0.5
    assert cli.parse(["collect", "a", "b", "c"]).rules == "b"
    assert cli.parse(["reconcile", "a", "b", "c", "--source-prefix", "p/"]).source_prefix == "p/"


def test_grid_is_logged_and_intermediate_tables_are_removed(spark, cleaned_runs, tmp_path):
    from tallymill.session import shared_dir

    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    jobs.train_job(spark, f"{cleaned_runs}/runs/run_ts=*", str(tmp_path / "m"), str(tmp_path / "log"), "r", datetime(2024, 3, 3))
    assert set(os.listdir(shared_dir(spark).removeprefix("file:"))) == before
    names = {r.name for r in spark.read.parquet(str(tmp_path / "log")).collect()}
    assert sum(n.startswith("aUROC_avg/regParam=") for n in names) == 4


def test_reconcile_job(spark, tmp_path):
    (tmp_path / "s.txt").write_text("2024-03-02 10:00:00 5 p/a\n2024-03-02 10:00:00 6 p/b\nTotal Objects: 2\n")
    (tmp_path / "t.txt").write_text("2024-03-02 10:00:00 5 a\n")
    counts = jobs.reconcile_job(spark, str(tmp_path / "s.txt"), str(tmp_path / "t.txt"), str(tmp_path / "out"), "p/")
    assert counts == {"ok": 1, "missing": 1}


def test_arrivals_and_scores_of_csv_files(spark, tmp_path):
    from tallymill.operators import features, model

    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    tx = transactions(spark, "/root/testdata/sf0.001")
    weighted = features.with_class_weight(clean.clean_transactions(tx), "tx_fraud")
    model.build_pipeline("tx_fraud").fit(weighted).write().save(str(tmp_path / "m"))
    for day in range(2):
        (tx.filter(F.col("tranaction_id") % 2 == day).select(F.to_csv(F.struct(*tx.columns)).alias("value"))
         .coalesce(1).write.mode("append").text(source))
        jobs.arrivals_job(spark, source, str(tmp_path / "staging"), str(tmp_path / "ck"), sink)
        jobs.score_job(spark, source, str(tmp_path / "m"), str(tmp_path / "scores"), str(tmp_path / "ck2"))
    assert spark.read.parquet(sink).count() == 3930
    assert spark.read.parquet(str(tmp_path / "scores")).count() == tx.na.drop("any").count()


def test_evaluation_job_writes_the_texts(spark, tmp_path):
    from tallymill.plans.views import generations

    df = generations(spark, "/root/testdata/sf0.01")
    jobs.evaluate_job(spark, df, str(tmp_path / "log"), "e", datetime(2024, 3, 2), str(tmp_path / "texts"))
    texts = spark.read.parquet(str(tmp_path / "texts"))
    assert texts.count() == df.count() and "diver" in texts.columns
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 3 * 7 and log.select("ts").distinct().count() == 1
