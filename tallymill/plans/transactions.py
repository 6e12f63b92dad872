"""Queries over transactions: scans, profiling, cleaning."""

import math
from datetime import datetime
from functools import reduce

from pyspark.sql import functions as F

from tallymill.operators import clean, profile, sketches
from tallymill.plans.catalog import query
from tallymill.plans.views import CLEAN, TX, TX_COMPLETE, TX_ORDER, transactions
from tallymill.session import scratch_path
from tallymill.sources import files
from tallymill.streaming import cleaning
from tallymill.streaming.run import file_stream

_OUT = ("tranaction_id, tx_datetime, customer_id, terminal_id, "
        "round(tx_amount::double, 2) as tx_amount, "
        "tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario")


def _shown(df):
    """32-bit amounts as rounded doubles, so any engine prints them alike."""
    return df.withColumn("tx_amount", F.round(F.col("tx_amount").cast("double"), 2))


@query("clean_transactions", f"with {CLEAN} select {_OUT} from clean")
def clean_query(spark, sf_dir):
    return _shown(clean.clean_transactions(transactions(spark, sf_dir)))


@query("clean_transactions_filters_first", f"""
with {TX}, ranked as (
  select *, row_number() over (partition by tranaction_id order by {TX_ORDER}) as rn
  from tx where {TX_COMPLETE} and tx_amount > 0 and customer_id >= 0 and terminal_id <= 999)
select {_OUT} from ranked where rn = 1""")
def clean_filters_first(spark, sf_dir):
    return _shown(clean.clean_transactions(transactions(spark, sf_dir), dedup="last"))


@query("drop_incomplete", f"with {TX} select {_OUT} from tx where {TX_COMPLETE}")
def drop_incomplete(spark, sf_dir):
    return _shown(clean.apply_rules(transactions(spark, sf_dir), [clean.Complete()]))


@query("dedup_transactions", f"""
with {TX}, ranked as (
  select *, row_number() over (partition by tranaction_id order by
    {', '.join(c + ' nulls first' for c in TX_ORDER.split(', '))}) as rn from tx)
select {_OUT} from ranked where rn = 1""")
def dedup_transactions(spark, sf_dir):
    return _shown(clean.first_by_key(transactions(spark, sf_dir), ["tranaction_id"]))


def _reject_sql(after_dedup):
    ids = "customer_id >= 0", "terminal_id <= 999"
    return f"""
with {TX},
a as (select * from tx where {TX_COMPLETE}),
b as (select * from a where tx_amount > 0),
c as (select *, row_number() over (partition by tranaction_id order by {TX_ORDER}) as rn from b),
d as (select * from c where rn = 1),
e as (select * from d where {ids[0]}),
f as (select * from e where {ids[1]})
select 1::int as step, 'complete' as rule,
       ((select count(*) from tx) - (select count(*) from a))::bigint as n_rows
union all select 2, 'positive_amount', (select count(*) from a) - (select count(*) from b)
union all select 3, 'unique', (select count(*) from b) - (select count(*) from d)
union all select 4, 'customer_id', (select count(*) from d) - (select count(*) from e)
union all select 5, 'terminal_id', (select count(*) from e) - (select count(*) from f)
union all select 6, 'kept', (select count(*) from f)"""


@query("reject_report", _reject_sql(True))
def reject_report(spark, sf_dir):
    return clean.reject_report(transactions(spark, sf_dir), clean.transaction_rules())


_NUMERIC = ["tranaction_id", "customer_id", "terminal_id", "tx_amount", "tx_time_seconds",
            "tx_time_days", "tx_fraud", "tx_fraud_scenario"]


def _summary_sql(source, stage=None):
    head = f"'{stage}' as stage, " if stage else ""
    return " union all ".join(f"""
select {head}'{c}' as "column", count({c})::bigint as n,
       round(avg({c}::double), 4) as mean, round(stddev_samp({c}::double), 4) as stddev,
       min({c})::double as min, max({c})::double as max,
       null::varchar as min_text, null::varchar as max_text from {source}""" for c in _NUMERIC)


@query("profile_summary", f"with {TX} {_summary_sql('tx')}")
def profile_summary(spark, sf_dir):
    return profile.summary(transactions(spark, sf_dir))


@query("before_after_summary",
       f"with {CLEAN} {_summary_sql('tx', 'raw')} union all {_summary_sql('clean', 'clean')}")
def before_after(spark, sf_dir):
    raw = transactions(spark, sf_dir)
    stages = {"raw": raw, "clean": clean.clean_transactions(raw)}
    return reduce(lambda a, b: a.unionByName(b), [
        profile.summary(df).select(F.lit(name).alias("stage"), "*")
        for name, df in stages.items()])


def _missing_sql(head=f"with {TX} "):
    out = []
    for c in ["tranaction_id", "tx_datetime", "customer_id", "terminal_id", "tx_amount",
              "tx_time_seconds", "tx_time_days"]:
        null = f"count(*) filter ({c} is null)"
        zero = "0" if c == "tx_datetime" else f"count(*) filter ({c} = 0)"
        missing = null if c in profile.ID_COLUMNS else zero
        out.append(f"""select '{c}' as "column", {null}::bigint as n_null, {zero}::bigint as n_zero,
                       0::bigint as n_nan, {missing}::bigint as n_missing from tx""")
    return head + " union all ".join(out)


@query("profile_missing", _missing_sql())
def profile_missing(spark, sf_dir):
    return profile.missing_profile(transactions(spark, sf_dir))


@query("null_or_zero_amounts", f"""
with {TX} select 'terminal_id' as "column", case when terminal_id is null then 'null' else 'zero' end as why,
  count(*)::bigint as n from tx where terminal_id is null or terminal_id = 0 group by all
union all select 'tx_amount', case when tx_amount is null then 'null' when isnan(tx_amount) then 'nan'
  else 'zero' end, count(*)::bigint from tx
where tx_amount is null or isnan(tx_amount) or tx_amount = 0 group by all""")
def null_or_zero(spark, sf_dir):
    return profile.absence_counts(transactions(spark, sf_dir), ["terminal_id", "tx_amount"])


_TYPES = {"tranaction_id": "bigint", "tx_datetime": "timestamp", "customer_id": "bigint",
          "terminal_id": "bigint", "tx_amount": "float", "tx_time_seconds": "int",
          "tx_time_days": "int", "tx_fraud": "int", "tx_fraud_scenario": "int"}


@query("profile_schema", f"with {TX} " + " union all ".join(
    f"""select {i}::int as position, '{c}' as "column", '{t}' as type, count({c})::bigint as n_present from tx"""
    for i, (c, t) in enumerate(_TYPES.items(), 1)))
def profile_schema(spark, sf_dir):
    return profile.schema_profile(transactions(spark, sf_dir))


def _review_sql():
    """The reports of the fused review as (report, item, metric) counts."""
    parts = [f"select 'missing' as report, \"column\" as item, n_missing as n from ({_missing_sql('')})",
             f"select 'summary', \"column\", n from ({_summary_sql('tx')})"]
    parts += [f"select 'schema', '{c}', count({c}) from tx" for c in _TYPES]
    parts += ["select 'violations', 'negative_customer', count(*) filter (customer_id < 0) from tx",
              "select 'violations', 'terminal_over_999', count(*) filter (terminal_id > 999) from tx",
              "select 'domains', 'tx_fraud', count(*) filter (tx_fraud not in (0, 1)) from tx",
              "select 'domains', 'tx_fraud_scenario',"
              " count(*) filter (tx_fraud_scenario not in (0, 1, 2, 3)) from tx"]
    return f"with {TX} select report, item, n::bigint as n from ({' union all '.join(parts)})"


@query("profile_review", _review_sql())
def profile_review(spark, sf_dir):
    """All one-row reports from a single aggregate."""
    reports = profile.review(transactions(spark, sf_dir))
    shown = {"missing": ("column", "n_missing"), "summary": ("column", "n"),
             "schema": ("column", "n_present"), "violations": ("rule", "n_rows"),
             "domains": ("column", "n_outside")}
    return reduce(lambda a, b: a.unionByName(b), [
        reports[name].select(F.lit(name).alias("report"), F.col(item).alias("item"),
                             F.col(n).alias("n")) for name, (item, n) in shown.items()])


@query("profile_keys", f"""
with {TX} select count(*)::bigint as n_rows, count(*) filter (tranaction_id is null)::bigint as n_null,
  count(distinct tranaction_id)::bigint as n_distinct,
  (count(*) - count(distinct tranaction_id))::bigint as n_duplicates,
  min(tranaction_id)::bigint as min_id, max(tranaction_id)::bigint as max_id,
  (max(tranaction_id) - min(tranaction_id))::bigint as id_span,
  (max(tranaction_id) - min(tranaction_id) - count(distinct tranaction_id))::bigint as n_unused,
  (max(tranaction_id) - min(tranaction_id) + 1 - count(distinct tranaction_id))::bigint as n_missing_ids
from tx""")
def profile_keys(spark, sf_dir):
    return profile.key_profile(transactions(spark, sf_dir), "tranaction_id")


@query("id_gaps", f"""
with {TX}, ids as (select distinct tranaction_id as id from tx),
n as (select id, lead(id) over (order by id) as next from ids)
select id + 1 as gap_start, next - 1 as gap_end, next - id - 1 as n_ids from n where next > id + 1""")
def id_gaps(spark, sf_dir):
    return profile.id_gaps(transactions(spark, sf_dir), "tranaction_id")


@query("profile_violations", f"""
with {TX} select 'negative_customer' as rule, count(*) filter (customer_id < 0)::bigint as n_rows from tx
union all select 'terminal_over_999', count(*) filter (terminal_id > 999)::bigint from tx""")
def profile_violations(spark, sf_dir):
    return profile.violations(transactions(spark, sf_dir), profile.TRANSACTION_VIOLATIONS)


@query("profile_domains", f"""
with {TX} select 'tx_fraud' as "column", count(*) filter (tx_fraud not in (0, 1))::bigint as n_outside,
  count(*) filter (tx_fraud is null)::bigint as n_null from tx
union all select 'tx_fraud_scenario', count(*) filter (tx_fraud_scenario not in (0, 1, 2, 3))::bigint,
  count(*) filter (tx_fraud_scenario is null)::bigint from tx""")
def profile_domains(spark, sf_dir):
    return profile.domain_check(transactions(spark, sf_dir))


@query("value_histograms", f"""
with {TX} select 'tx_fraud' as "column", tx_fraud::varchar as value, count(*)::bigint as n from tx group by all
union all select 'tx_fraud_scenario', tx_fraud_scenario::varchar, count(*)::bigint from tx group by all""")
def value_histograms(spark, sf_dir):
    return profile.value_histogram(transactions(spark, sf_dir), list(profile.TRANSACTION_DOMAINS))


_REVIEWED_IDS = ("customer_id", "terminal_id")


@query("extreme_ids", f"with {TX} " + " union all ".join(
    f"""select * from (select '{c}' as "column", '{edge}' as edge, {c} as value
        from (select distinct {c} from tx) order by {c} {order} limit 10)"""
    for c in _REVIEWED_IDS
    for edge, order in (("lowest", "asc nulls first"), ("highest", "desc nulls last"))))
def extreme_ids(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    return reduce(lambda a, b: a.unionByName(b), [profile.extremes(tx, c) for c in _REVIEWED_IDS])


@query("extreme_amounts", f"with {TX} " + " union all ".join(
    f"""select * from (select '{edge}' as edge, round(tx_amount::double, 2) as value
        from (select distinct tx_amount from tx) order by tx_amount {order} limit 10)"""
    for edge, order in (("lowest", "asc nulls first"), ("highest", "desc nulls last"))))
def extreme_amounts(spark, sf_dir):
    """Fractional values keep their fraction."""
    return profile.extremes(transactions(spark, sf_dir), "tx_amount").select(
        "edge", F.round(F.col("value").cast("double"), 2).alias("value"))


@query("wide_ids_csv", f"""
with {CLEAN} select tranaction_id + 5000000000 as tranaction_id, customer_id from clean""")
def wide_ids_csv(spark, sf_dir):
    """Transaction files whose ids lie beyond 32 bits."""
    tx = transactions(spark, sf_dir).withColumn("tranaction_id", F.col("tranaction_id") + 5_000_000_000)
    path = scratch_path(spark, "wide")
    tx.select(F.to_csv(F.struct(*tx.columns)).alias("value")).write.text(path)
    cleaned = clean.clean_transactions(files.read_transactions_csv(spark, path))
    return cleaned.select("tranaction_id", "customer_id")


# Two cleaning runs over one input; the second run saw corrected amounts.
_RUNS = {"20240301000000": 0.0, "20240302000000": 1.0}


def _two_runs(spark, sf_dir):
    cleaned = clean.clean_transactions(transactions(spark, sf_dir))
    runs = F.array(*[F.struct(F.lit(r).alias("run_ts"), F.lit(d).alias("_d"))
                     for r, d in _RUNS.items()])
    return (cleaned.select("*", F.inline(runs))
            .withColumn("tx_amount", (F.col("tx_amount") + F.col("_d")).cast("float")).drop("_d"))


_LATEST = f"""with {CLEAN} select tranaction_id, tx_datetime, customer_id, terminal_id,
  round((tx_amount::double + 1)::real::double, 2) as tx_amount, tx_time_seconds, tx_time_days,
  tx_fraud, tx_fraud_scenario, '20240302000000' as run_ts from clean"""


@query("cross_run_dedup", _LATEST)
def cross_run_dedup(spark, sf_dir):
    return _shown(clean.first_by_key(
        _two_runs(spark, sf_dir), ["tranaction_id"], order_by=["run_ts"], latest=True))


@query("run_outputs_scan", f"""
with {CLEAN}, runs as (select '20240301000000' as run_ts, 0 as d union all select '20240302000000', 1)
select run_ts, count(*)::bigint as n_rows, count(distinct tranaction_id)::bigint as n_ids,
  round(sum((tx_amount::double + d)::real::double), 1) as amount from clean, runs group by run_ts""")
def run_outputs_scan(spark, sf_dir):
    path, both = scratch_path(spark, "runs"), _two_runs(spark, sf_dir)
    for stamp in _RUNS:
        files.write_run(both.filter(F.col("run_ts") == stamp).drop("run_ts"), path,
                        datetime.strptime(stamp, "%Y%m%d%H%M%S"))
    runs = files.read_runs(spark, f"{path}/run_ts=*")
    run_ts = F.regexp_extract("run_path", r"run_ts=(\d+)", 1)
    return runs.groupBy(run_ts.alias("run_ts")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("tranaction_id").alias("n_ids"),
        F.round(F.sum(F.col("tx_amount").cast("double")), 1).alias("amount"))


@query("csv_scan_clean", f"with {CLEAN} select {_OUT} from clean")
def csv_scan_clean(spark, sf_dir):
    """Round trip through headerless CSV with comment lines."""
    tx = transactions(spark, sf_dir)
    path = scratch_path(spark, "csv")
    line = F.to_csv(F.struct(*tx.columns))
    comment = F.lit("# " + " | ".join(tx.columns))
    has_comment = F.col("customer_id") < 0
    (tx.select(F.explode(F.when(has_comment, F.array(comment, line)).otherwise(F.array(line)))
               .alias("value")).write.text(path))
    return _shown(clean.clean_transactions(
        files.read_transactions_csv(spark, path)))


_N_ARRIVALS, _ROWS_PER_FILE = 4, 1_000_000


def _arrivals(spark, sf_dir, dedup):
    """The cleaning job as a stream of four micro-batches, each of as many files as its rows need;
    the copies of an id stand in different files."""
    staged = scratch_path(spark, "arrivals")
    tx = transactions(spark, sf_dir)
    per_batch = math.ceil(max(1, tx.count()) / (_N_ARRIVALS * _ROWS_PER_FILE))
    tx.repartition(_N_ARRIVALS * per_batch, F.xxhash64(*tx.columns)).write.parquet(staged)
    sink = scratch_path(spark, "cleaned")
    stream = file_stream(spark, staged, tx.schema, max_files=per_batch)
    cleaning.clean_arrivals(stream, sink, scratch_path(spark, "checkpoint"), dedup)
    return _shown(cleaning.read_cleaned(spark, sink, dedup))


@query("clean_arrivals", f"with {CLEAN} select {_OUT} from clean")
def clean_arrivals(spark, sf_dir):
    return _arrivals(spark, sf_dir, "between")


@query("clean_arrivals_filters_first", f"""
with {TX}, ranked as (
  select *, row_number() over (partition by tranaction_id order by {TX_ORDER}) as rn
  from tx where {TX_COMPLETE} and tx_amount > 0 and customer_id >= 0 and terminal_id <= 999)
select {_OUT} from ranked where rn = 1""")
def clean_arrivals_filters_first(spark, sf_dir):
    return _arrivals(spark, sf_dir, "last")


# Three runs over the transactions that share two thirds of their ids with each other.
_SHARES = (0.01, 0.25, 0.5, 0.9)
_RUN_SQL = """
runs as (select r.run, tx.* from tx, (values ('1', 1), ('2', 2), ('3', 3)) r(run, k) where tranaction_id % 4 <> k)"""


def _stored_sketches(spark, sf_dir, name, sketch):
    path = scratch_path(spark, name)
    tx = transactions(spark, sf_dir)
    for run in (1, 2, 3):
        sketches.store(sketch(tx.filter(F.col("tranaction_id") % 4 != run)), path, run)
    return sketches.stored(spark, path)


# Sketches of 2^18 entries hold every id of the check's table, so that their numbers are exact there.
@query("run_overlaps", f"""
with {TX}, {_RUN_SQL}, d as (select distinct run, tranaction_id as v from runs)
select a.run as run_a, b.run as run_b, (select count(*) from d where run = a.run)::bigint as n_a,
  (select count(*) from d where run = b.run)::bigint as n_b,
  (select count(*) from (select v from d where run = a.run intersect select v from d where run = b.run))::bigint as n_both,
  (select count(*) from (select v from d where run = a.run union select v from d where run = b.run))::bigint as n_either,
  (select count(*) from (select v from d where run = a.run except select v from d where run = b.run))::bigint as n_only_a
from (select distinct run from d) a, (select distinct run from d) b where a.run < b.run""")
def run_overlaps(spark, sf_dir):
    """Ids that runs share, from their stored sketches."""
    kept = _stored_sketches(spark, sf_dir, "exact-sketches", lambda df: sketches.key_sketches(df, ["tranaction_id"], log_entries=18))
    return sketches.overlaps(kept, log_entries=18).drop("column")


@query("run_overlaps_rough", f"""
with {TX}, {_RUN_SQL}, d as (select distinct run, tranaction_id as id, customer_id from runs),
n as (select 'tranaction_id' as c, count(distinct id) as n_all, count(*) as n from d
  union all select 'customer_id', count(distinct customer_id), count(customer_id) from runs)
select c as column, 3::bigint as runs, (select count(customer_id) from runs)::bigint as n_customers, n_all::bigint as n_distinct,
  true as within from n""")
def run_overlaps_rough(spark, sf_dir):
    """Distinct values over the runs by sketches of the usual size, held against exact counts."""
    kept = _stored_sketches(spark, sf_dir, "sketches", lambda df: sketches.key_sketches(df, ["tranaction_id", "customer_id"]))
    united = sketches.distinct_over_runs(kept).withColumnRenamed("n_distinct", "estimate")
    tx = transactions(spark, sf_dir).filter("tranaction_id IS NOT NULL")
    exact = tx.agg(*[F.count_distinct(c).alias(c) for c in ("tranaction_id", "customer_id")]).unpivot(
        [], ["tranaction_id", "customer_id"], "column", "n_distinct")
    customers = kept.where("column = 'customer_id'").agg(F.sum("n").alias("n_customers"))
    within = F.abs(F.col("estimate") - F.col("n_distinct")) <= 0.05 * F.col("n_distinct")
    return united.join(exact, "column").select("column", "runs", F.lit(customers.first()[0]).alias("n_customers"), "n_distinct",
                                               within.alias("within"))


_QUANTILE_COLUMNS = ("tx_amount", "terminal_id")


@query("run_quantiles", f"with {TX}, {_RUN_SQL}, third as (select * from runs where tranaction_id % 3 = 0) " + " union all ".join(f"""
select '{c}' as column, count({c})::bigint as n, min({c})::double as least, max({c})::double as most, {s}::double as share,
  quantile_disc({c}::double, {s}) as value, true as rough_within from third""" for c in _QUANTILE_COLUMNS for s in _SHARES))
def run_quantiles(spark, sf_dir):
    """Quantiles of three runs from their merged sketches: exact where the sketches hold all values, and within
    three rank errors for sketches of the usual size."""
    tx = transactions(spark, sf_dir).filter(F.col("tranaction_id") % 3 == 0)
    paths = {name: scratch_path(spark, f"{name}-quantiles") for name in ("exact", "rough")}
    for run in (1, 2, 3):
        part = tx.filter(F.col("tranaction_id") % 4 != run)
        sketches.store(sketches.quantile_sketches(part, _QUANTILE_COLUMNS, k=65535), paths["exact"], run)
        sketches.store(sketches.quantile_sketches(part, _QUANTILE_COLUMNS), paths["rough"], run)
    exact, rough = (sketches.quantiles_over_runs(sketches.stored(spark, p), _SHARES) for p in paths.values())
    near = sketches.quantiles_over_runs(sketches.stored(spark, paths["exact"]), sorted(
        {min(1.0, max(0.0, round(s + d, 6))) for s in _SHARES for d in (-0.05, 0.05)}))
    low, high = (near.select("column", F.col("share").alias("near"), F.col("value").alias(n)) for n in ("low", "high"))
    is_near = lambda d: F.abs(F.col("near") - F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("share") + d))) < 1e-6
    judged = (rough.select("column", "share", F.col("value").alias("rough"))
              .join(low, "column").where(is_near(-0.05)).drop("near")
              .join(high, "column").where(is_near(0.05))
              .select("column", "share", F.col("rough").between(F.col("low"), F.col("high")).alias("rough_within")))
    return exact.join(judged, ["column", "share"])
