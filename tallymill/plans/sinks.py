"""Queries that write through a sink and read back."""

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallymill import schemas
from tallymill.operators import clean, profile
from tallymill.plans import jobs
from tallymill.plans.catalog import query
from tallymill.plans.views import CLEAN, CLICKS, CORPUS, GENERATIONS, PREDICTIONS, TX, clicks, corpus, generations, predictions, \
    table, transactions
from tallymill.session import scratch_path
from tallymill.sources import files, runs
from tallymill.sources.clicks import to_messages
from tallymill.streaming import run as streams
from tallymill.streaming.clicks import filter_clicks, rekey


@query("sink_new", f"with {CLEAN} select tranaction_id, tx_fraud, true as refused from clean")
def sink_new(spark, sf_dir):
    """A new dataset; writing to the same folder again is refused."""
    path = scratch_path(spark, "new")
    cleaned = clean.clean_transactions(transactions(spark, sf_dir)).select("tranaction_id", "tx_fraud")
    files.write_new(cleaned, path)
    try:
        files.write_new(cleaned, path)
        refused = False
    except AnalysisException:
        refused = True
    return spark.read.parquet(path).withColumn("refused", F.lit(refused))


def _overwrite_sql(kept, changed):
    return f"""with {TX} select tranaction_id, tx_fraud_scenario, customer_id from tx where {kept}
union all select tranaction_id, tx_fraud_scenario, -customer_id from tx where {changed}"""


def _overwritten(spark, sf_dir, dynamic):
    """All scenarios written, then the first one again with other customers."""
    path = scratch_path(spark, "overwrite")
    tx = transactions(spark, sf_dir).select("tranaction_id", "tx_fraud_scenario", "customer_id")
    files.write_overwrite(tx, path, partition_by=["tx_fraud_scenario"])
    again = tx.filter("tx_fraud_scenario = 1").withColumn("customer_id", -F.col("customer_id"))
    files.write_overwrite(again, path, partition_by=["tx_fraud_scenario"], dynamic=dynamic)
    return spark.read.parquet(path)


@query("sink_overwrite_static", _overwrite_sql("false", "tx_fraud_scenario = 1"))
def sink_overwrite_static(spark, sf_dir):
    return _overwritten(spark, sf_dir, dynamic=False)


@query("sink_overwrite_dynamic", _overwrite_sql("tx_fraud_scenario <> 1", "tx_fraud_scenario = 1"))
def sink_overwrite_dynamic(spark, sf_dir):
    return _overwritten(spark, sf_dir, dynamic=True)


@query("sink_append_by_day", f"""
with {CORPUS} select d.day as day, zodiac, count(*)::bigint as n, sum(length(horo))::bigint as n_chars
from corpus, (select unnest(['2024-03-02', '2024-03-03']) as day) d group by all""")
def sink_append_by_day(spark, sf_dir):
    """Two collections of raw records, one folder per day."""
    path, records = scratch_path(spark, "raw"), corpus(spark, sf_dir)
    for day in ("2024-03-02", "2024-03-03"):
        files.append_records(records.withColumn("date", F.lit(day).cast("timestamp")), path)
    return spark.read.parquet(path).groupBy(F.col("day").cast("string").alias("day"), "zodiac").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("horo")).alias("n_chars"))


@query("sink_scores", f"""
with {PREDICTIONS} select 'run-1' as run, case event_id % 2 when 0 then 'initial' else 'tuned' end as model,
  (event_id // 2)::int as replicate, score_a as auc from predictions""")
def sink_scores(spark, sf_dir):
    """Score samples as quoted CSV."""
    path = scratch_path(spark, "scores")
    scores = predictions(spark, sf_dir).select(
        F.when(F.col("event_id") % 2 == 0, "initial").otherwise("tuned").alias("model"),
        F.floor(F.col("event_id") / 2).cast("int").alias("replicate"), F.col("score_a").alias("auc"))
    files.write_scores(scores, path, "run-1", fmt="csv")
    return spark.read.csv(path, header=True, schema="run string, model string, replicate int, auc double")


@query("sink_generations", f"""
with {GENERATIONS}, normed as (
  select top_p, temperature, doc_id, generate_subscripts(embedding, 1) as pos,
    unnest(embedding)::double / sqrt(list_inner_product(embedding::double[], embedding::double[])) as e from generations),
centre as (select top_p, temperature, pos, avg(e) as c from normed group by all),
d as (select doc_id, round(1 - sum(e * c), 6) as diver from normed join centre using (top_p, temperature, pos) group by doc_id)
select doc_id, gen_text, grm_label, sentiment, gen_time, diver,
  (select count(*) from (select distinct top_p from generations))::bigint as n_runs from generations join d using (doc_id)""")
def sink_generations(spark, sf_dir):
    """The evaluation job's table of texts with their own diversity, and its run log."""
    texts, log = scratch_path(spark, "texts"), scratch_path(spark, "log")
    jobs.evaluate_job(spark, generations(spark, sf_dir), log, "e", datetime(2024, 3, 2), texts)
    logged = spark.read.parquet(log).agg(F.count_distinct("run_id")).scalar()
    return spark.read.parquet(texts).select("doc_id", "gen_text", "grm_label", "sentiment", "gen_time",
                                            F.round("diver", 6).alias("diver"), logged.alias("n_runs"))


@query("sink_run_log", """
select 'metric' as kind, 'auc' as name, 'r' || (select max(n_regionkey) from nation) as run_id,
  (select count(*) from nation where n_regionkey = (select max(n_regionkey) from nation))::varchar as value
union all select 'param', 'region', 'r' || max(n_regionkey), max(n_regionkey)::varchar from nation
union all select 'tag', 'kind', 'r0', 'first'""")
def sink_run_log(spark, sf_dir):
    """One logged run per region; the latest entry of each name."""
    path = scratch_path(spark, "log")
    counts = table(spark, sf_dir, "nation").groupBy("n_regionkey").count().collect()       # five regions
    for region, n in sorted(map(tuple, counts)):
        runs.log_run(spark, path, f"r{region}", datetime(2024, 3, 1 + region), {"auc": n}, {"region": region},
                     {"kind": "first"} if region == 0 else None)
    return runs.latest(spark.read.parquet(path)).select("kind", "name", "run_id", "value")


@query("file_inventory", """
select 4::bigint as n_objects, sum(strlen(props) + 1)::bigint as n_bytes from events""")
def file_inventory(spark, sf_dir):
    """Number and bytes of the files of a text dataset."""
    path = scratch_path(spark, "inventory")
    table(spark, sf_dir, "events").select("props").repartition(4).write.text(path)
    return files.file_inventory(spark, path, "*.txt").agg(
        F.count(F.lit(1)).alias("n_objects"), F.sum("size").alias("n_bytes"))


_FILTERED = f"with {CLICKS} select user_id::varchar as key, count(*)::bigint as n from clicks where geo = 'ru' group by 1"


def _staged_clicks(spark, sf_dir):
    staged, batch = scratch_path(spark, "messages"), to_messages(clicks(spark, sf_dir))
    batch.repartition(3).write.parquet(staged)
    return rekey(filter_clicks(streams.file_stream(spark, staged, batch.schema, max_files=1)))


def _per_key(spark, path):
    return spark.read.parquet(path).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@query("stream_restart", _FILTERED)
def stream_restart(spark, sf_dir):
    """A stream started again on its checkpoint adds nothing."""
    stream = _staged_clicks(spark, sf_dir)
    out, checkpoint = scratch_path(spark, "clicks"), scratch_path(spark, "checkpoint")
    for _ in range(2):
        streams.drain(stream, out, checkpoint)
    return _per_key(spark, out)


@query("stream_continuous", _FILTERED)
def stream_continuous(spark, sf_dir):
    """A stream on a processing-time trigger, stopped when it has caught up."""
    out = scratch_path(spark, "clicks")
    running = streams.start(_staged_clicks(spark, sf_dir), scratch_path(spark, "checkpoint"), options={"path": out},
                            interval="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return _per_key(spark, out)


@query("preview_rows", "select least(20, count(*))::bigint as n_shown, least(20, count(*))::bigint as n_found from customer")
def preview_rows(spark, sf_dir):
    """Rows shown, and how many of them the table holds."""
    customers = table(spark, sf_dir, "customer")
    shown = profile.preview(customers.select("c_custkey", "c_name"))
    found = shown.join(customers, ["c_custkey", "c_name"], "left_semi")
    count = lambda df: df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return spark.range(1).select(count(shown).alias("n_shown"), count(found).alias("n_found"))


@query("percentiles", " union all ".join(
    f"""select '{c}' as "column", {p}::double as percentile, quantile_disc({c}::double, {p}) as value from customer"""
    for c in ("c_acctbal", "c_custkey") for p in (0.25, 0.5, 0.75)))
def percentiles(spark, sf_dir):
    """Exact here: the sketch's rank error is below one row."""
    return profile.percentiles(table(spark, sf_dir, "customer"), ["c_acctbal", "c_custkey"], accuracy=1_000_000)


@query("schema_drift", """
select * from (values ('tx_amount', 'float', 'double'), ('tx_fraud', 'int', null), ('extra', null, 'string'))
  t("column", expected, actual)""")
def schema_drift(spark, sf_dir):
    """A changed, a lost and a new column."""
    tx = transactions(spark, sf_dir)
    changed = tx.withColumn("tx_amount", F.col("tx_amount").cast("double")).drop("tx_fraud").withColumn("extra", F.lit("x"))
    return spark.createDataFrame(profile.schema_drift(changed, schemas.TRANSACTIONS),
                                 'column string, expected string, actual string')


@query("approximate_keys", f"""
with {TX} select count(*)::bigint as n_rows, true as close from tx""")
def approximate_keys(spark, sf_dir):
    """The approximate distinct count lies within three of its standard errors."""
    tx = transactions(spark, sf_dir)
    exact = profile.key_profile(tx, "tranaction_id").select("n_distinct").scalar()
    near = F.abs(F.col("n_distinct") / exact - 1) < 0.03
    return profile.key_profile(tx, "tranaction_id", approx_rsd=0.01).select("n_rows", near.alias("close"))


@query("csv_rejects", f"""
with {TX}, lines as (
  select * replace (case when tranaction_id % 97 = 0 and tranaction_id % 5 in (0, 2) then null else tx_datetime end as tx_datetime,
    case when tranaction_id % 97 = 0 and tranaction_id % 5 in (1, 2) then null else terminal_id end as terminal_id) from tx),
a as (select * from lines where tx_datetime is not null and terminal_id is not null),
b as (select * from a where tx_amount > 0),
d as (select * from (select *, row_number() over (partition by tranaction_id order by tx_datetime, customer_id, terminal_id,
  tx_amount, tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario) as rn from b) where rn = 1),
e as (select * from d where customer_id >= 0), f as (select * from e where terminal_id <= 999)
select 1::int as step, 'complete' as rule, ((select count(*) from tx) - (select count(*) from a))::bigint as n_rows
union all select 2, 'positive_amount', (select count(*) from a) - (select count(*) from b)
union all select 3, 'unique', (select count(*) from b) - (select count(*) from d)
union all select 4, 'customer_id', (select count(*) from d) - (select count(*) from e)
union all select 5, 'terminal_id', (select count(*) from e) - (select count(*) from f)
union all select 6, 'kept', (select count(*) from f)""")
def csv_rejects(spark, sf_dir):
    """The reject report over CSV with malformed lines among the good ones: an hour that does not
    exist, a text for a number, and lines that end early."""
    tx, path = transactions(spark, sf_dir), scratch_path(spark, "csv")
    bad, kind = F.col("tranaction_id") % 97 == 0, F.col("tranaction_id") % 5
    text = tx.select(*[F.col(c).cast("string").alias(c) for c in tx.columns], bad.alias("_bad"), kind.alias("_kind"))
    hour = F.when(F.col("_bad") & (F.col("_kind") == 0), "2019-08-22 24:00:00").otherwise(F.col("tx_datetime"))
    number = F.when(F.col("_bad") & (F.col("_kind") == 1), "Err").otherwise(F.col("terminal_id"))
    line = F.to_csv(F.struct(*[hour.alias(c) if c == "tx_datetime" else number.alias(c) if c == "terminal_id" else F.col(c)
                               for c in tx.columns]))
    short = F.when(F.col("_bad") & (F.col("_kind") == 2), F.col("tranaction_id")).otherwise(line)
    text.select(F.explode(F.array(short)).alias("value")).write.text(path)
    return clean.reject_report(files.read_transactions_csv(spark, path), clean.transaction_rules())
