"""Queries over click messages, inventories and the run log."""

from pyspark.sql import functions as F

from tallymill.operators import reconcile
from tallymill.plans.catalog import query
from tallymill.plans.views import CLICKS, LISTINGS, clicks, listings, one_by_one, table
from tallymill.session import scratch_path
from tallymill.sources import runs
from tallymill.sources.clicks import numbers, synthetic_clicks, to_messages
from tallymill.streaming import levels
from tallymill.streaming.clicks import dedupe_redelivered, dedupe_written, filter_clicks, read_deduped, rekey
from tallymill.streaming.run import drain, file_stream

_FILTERED = f"with {CLICKS} select ts, user_id, object_id, domain, url from clicks where geo = 'ru'"
_REKEYED = f"""with {CLICKS} select user_id::varchar as key,
  to_json({{'ts': ts, 'user_id': user_id, 'object_id': object_id, 'domain': domain, 'url': url}})::varchar as value
from clicks where geo = 'ru'"""


def _messages(spark, sf_dir):
    """Click messages as a broker would hold them, with unreadable ones among them."""
    good = to_messages(clicks(spark, sf_dir))
    broken = good.filter(F.col("key") == "7").withColumn("value", F.concat(F.lit("{oops "), "value"))
    return good.unionByName(broken)


@query("click_filter", _FILTERED)
def click_filter(spark, sf_dir):
    return filter_clicks(_messages(spark, sf_dir))


@query("click_messages", _REKEYED)
def click_messages(spark, sf_dir):
    return rekey(filter_clicks(_messages(spark, sf_dir)))


@query("click_filter_stream", _REKEYED)
def click_filter_stream(spark, sf_dir):
    """The same transform as a stream: staged messages in, keyed messages out."""
    staged = scratch_path(spark, "messages")
    messages = _messages(spark, sf_dir)
    messages.write.parquet(staged)
    stream = file_stream(spark, staged, messages.schema)
    out = drain(rekey(filter_clicks(stream)), scratch_path(spark, "clicks"),
                scratch_path(spark, "checkpoint"))
    return spark.read.parquet(out)


@query("redelivery_dedup_stream", """
select event_id, user_id, event_type from events""")
def redelivery_dedup_stream(spark, sf_dir):
    """Every event delivered twice, in four files without regard to time, one file per
    micro-batch; one of each is kept."""
    staged = scratch_path(spark, "deliveries")
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"))
    events.repartition(4, F.xxhash64("event_id", "delivery")).write.parquet(staged)
    stream = file_stream(spark, staged, events.schema, max_files=1)
    sink = scratch_path(spark, "deduped")
    dedupe_written(stream, "event_id", sink, scratch_path(spark, "checkpoint"), buckets=4)
    return read_deduped(spark, sink).select("event_id", "user_id", "event_type")


_N_BATCHES, _PER_CELL = 64, 500


@query("redelivery_dedup_levels", f"""
with n as (select max(event_id) + 1 as n from events),
first as (select event_id, event_id // {_PER_CELL} as cell, (event_id * {_N_BATCHES} // n)::int as batch from events, n),
deliveries as (
  select event_id, cell, batch from first
  union select event_id, cell, least({_N_BATCHES - 1}, batch + event_id % 3)::int from first
  union select event_id, cell, {_N_BATCHES - 1} from first where event_id % 997 = 0),
touched as (select distinct batch, cell from deliveries),
reads as (select t.batch, count(*)::bigint as rows_read from touched t join first f on f.cell = t.cell and f.batch < t.batch group by 1),
kept as (select batch, count(*)::bigint as n_kept, sum(event_id)::bigint as id_sum from first group by 1)
select k.batch, n_kept, id_sum, coalesce(rows_read, 0)::bigint as rows_read,
  (k.batch % 4 + k.batch // 4 % 4 + k.batch // 16 % 4)::bigint as n_runs
from kept k left join reads r on r.batch = k.batch""")
def redelivery_dedup_levels(spark, sf_dir):
    """Events delivered again in later batches, over 64 micro-batches: what each batch kept, how many
    written rows it read, and from how many runs."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    n = events.agg(F.max("event_id")).first()[0] + 1
    first = events.withColumn("at", F.floor(F.col("event_id") * _N_BATCHES / n).cast("int"))
    last = F.lit(_N_BATCHES - 1)
    again = F.array_distinct(F.array_compact(F.array(
        "at", F.least(last, (F.col("at") + F.col("event_id") % 3).cast("int")), F.when(F.col("event_id") % 997 == 0, last))))
    stream = one_by_one(spark, first.select("event_id", "user_id", "event_type", F.explode(again).alias("batch")), "deliveries")
    sink, reads = scratch_path(spark, "deduped"), []
    dedupe_written(stream, "event_id", sink, scratch_path(spark, "checkpoint"), fan=4,
                   cell=F.floor(F.col("event_id") / _PER_CELL),
                   report=lambda batch, done: reads.append((batch, done["rows_read"], done["runs"])))
    kept = levels.read(spark, sink).groupBy(F.col("_batch").alias("batch")).agg(
        F.count("*").alias("n_kept"), F.sum("event_id").alias("id_sum"))
    return kept.join(spark.createDataFrame(reads, "batch int, rows_read long, n_runs long"), "batch")


_LATE_BATCHES = 104


@query("stream_progress", f"""
with e as (select event_id, (event_id % {_LATE_BATCHES})::int as batch from events),
late as (select * from e where batch > 2 and event_id % 7 = 0)
select 'input_rows' as name, (select count(*) from e)::varchar as value
union all select 'late_rows', (select count(*) from late)::varchar
union all select 'fed_batches', (select count(distinct batch) from e)::varchar
union all select 'kept_rows', ((select count(*) from e) - (select count(*) from late))::varchar""")
def stream_progress(spark, sf_dir):
    """More micro-batches than a query remembers, with rows that come days too late in most of them:
    the run log counts every one."""
    events = table(spark, sf_dir, "events").select("event_id")
    batch = (F.col("event_id") % _LATE_BATCHES).cast("int")
    days = F.when((batch > 2) & (F.col("event_id") % 7 == 0), -30).otherwise(0)
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + 3600 * batch + 86400 * days)
    stream = one_by_one(spark, events.select("event_id", ts.alias("ts"), batch.alias("batch")), "late-deliveries")
    log, out = scratch_path(spark, "run-log"), scratch_path(spark, "kept")
    # Little state here: one state partition keeps the many small batches short.
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        drain(dedupe_redelivered(stream, "event_id", "ts", "2 hours"), out, scratch_path(spark, "checkpoint"), log=(log, "late"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    logged = runs.latest(spark.read.parquet(log)).where("name <> 'batches'").select("name", "value")
    kept = spark.read.parquet(out).agg(F.count("*").cast("string").alias("value"))
    return logged.unionByName(kept.select(F.lit("kept_rows").alias("name"), "value"))


@query("synthetic_clicks", """
with h as (select floor(epoch(ts))::int as ts, md5(concat_ws('|', event_id::varchar, 'clicks')) as h from events),
p as (select ts, ['banner', 'article', 'link'][('0x' || substr(h, 1, 8))::bigint % 3 + 1] as kind,
  (('0x' || substr(h, 9, 8))::bigint % 30 + 1)::varchar as number,
  (('0x' || substr(h, 17, 8))::bigint % 30 + 1)::int as user_id,
  ['ru', 'ua', 'kz'][('0x' || substr(h, 25, 8))::bigint % 3 + 1] as geo from h)
select ts, user_id, geo, kind || number as object_id, 'example.com' as domain,
  'https://example.com/' || kind || '/' || number as url, 'https://example.com/' as url_from from p""")
def synthetic(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("ts"))
    return synthetic_clicks(events, "event_id", "ts")


_GENERATED_BATCHES = 4


@query("generated_click_stream", f"""
with n as (select (max(event_id) + {_GENERATED_BATCHES}) // {_GENERATED_BATCHES} as per_batch from events),
h as (select event_id, 1700000000 + 60 * (event_id // per_batch) as ts, md5(concat_ws('|', event_id::varchar, 'clicks')) as h from events, n),
p as (select ts, ['banner', 'article', 'link'][('0x' || substr(h, 1, 8))::bigint % 3 + 1] as kind,
  (('0x' || substr(h, 9, 8))::bigint % 30 + 1)::varchar as number, (('0x' || substr(h, 17, 8))::bigint % 30 + 1)::int as user_id,
  ['ru', 'ua', 'kz'][('0x' || substr(h, 25, 8))::bigint % 3 + 1] as geo from h)
select user_id::varchar as key, to_json({{'ts': ts::int, 'user_id': user_id, 'object_id': kind || number, 'domain': 'example.com',
  'url': 'https://example.com/' || kind || '/' || number}})::varchar as value from p where geo = 'ru'""")
def generated_click_stream(spark, sf_dir):
    """Clicks generated as a stream for the keys of the events and filtered on it: every run takes
    one micro-batch of numbers and goes on where the one before ended."""
    keys = table(spark, sf_dir, "events").select(F.col("event_id").alias("value"))
    n = keys.agg(F.max("value")).first()[0] + 1
    out, checkpoint = scratch_path(spark, "generated"), scratch_path(spark, "checkpoint")
    for _ in range(_GENERATED_BATCHES):
        stream = numbers(spark, -(-n // _GENERATED_BATCHES), start=1_700_000_000, step=60).join(keys, "value")
        messages = to_messages(synthetic_clicks(stream, "value", "ts"))
        drain(rekey(filter_clicks(messages)), out, checkpoint)
    return spark.read.parquet(out)


@query("reconcile", f"""
with {LISTINGS} select coalesce(s.key, t.key) as key, s.size as source_size, t.size as target_size,
  case when t.key is null then 'missing' when s.key is null then 'extra'
    when s.size <> t.size then 'size_mismatch' else 'ok' end as status
from source_listing s full join target_listing t on s.key = t.key""")
def reconcile_listings(spark, sf_dir):
    source, target = listings(spark, sf_dir)
    return reconcile.compare(source, target, source_prefix="p/")


_IRREGULAR = LISTINGS + """,
s as (select key, case when k % 23 = 0 then null else size end as size
  from (select *, key::bigint as k from source_listing)
  union all select key, size + 7 from source_listing where key::bigint % 29 = 0
  union all select key, size from source_listing where key::bigint % 31 = 0),
sg as (select key, count(*) as n, min(size) as lo, max(size) as hi, count(*) - count(size) as unknown from s group by key),
tg as (select key, count(*) as n, min(size) as lo, max(size) as hi, count(*) - count(size) as unknown
  from target_listing group by key)"""


@query("reconcile_irregular", f"""
with {_IRREGULAR} select coalesce(sg.key, tg.key) as key, sg.hi as source_size, tg.hi as target_size,
  case when tg.key is null then 'missing' when sg.key is null then 'extra'
    when coalesce(sg.lo <> sg.hi, false) or coalesce(tg.lo <> tg.hi, false) then 'duplicate_key'
    when sg.unknown + tg.unknown > 0 then 'unknown_size'
    when sg.hi <> tg.hi then 'size_mismatch' else 'ok' end as status
from sg full join tg on sg.key = tg.key""")
def reconcile_irregular(spark, sf_dir):
    """Listings with unknown sizes and with keys listed twice, alike and unlike."""
    source, target = listings(spark, sf_dir)
    k = F.substring("key", 3, 30).cast("bigint")
    unknown = source.withColumn("size", F.when(k % 23 != 0, F.col("size")))
    again = source.filter(k % 29 == 0).withColumn("size", F.col("size") + 7)
    listed = unknown.unionByName(again).unionByName(source.filter(k % 31 == 0))
    return reconcile.compare(listed, target, source_prefix="p/")


def _nearly_equal(spark, sf_dir):
    """A listing and a copy of it in which a few keys are missing, extra, resized or listed again."""
    source, _ = listings(spark, sf_dir)
    source = reconcile.strip_prefix(source, "p/")
    k = F.col("key").cast("bigint")
    size = F.when(k % 1500 == 11, F.col("size") + 1).otherwise(F.col("size"))
    target = source.filter(k % 1500 != 7).withColumn("size", size)
    again = source.filter(k % 1500 == 13)
    extra = source.filter(k % 1500 == 17).withColumn("key", F.concat("key", F.lit("x")))
    return source, target.unionByName(again).unionByName(extra)


_NEARLY = LISTINGS + """,
s as (select key, size from source_listing),
t as (
  select key, case when key::bigint % 1500 = 11 then size + 1 else size end as size from s where key::bigint % 1500 <> 7
  union all select key, size from s where key::bigint % 1500 = 13
  union all select key || 'x', size from s where key::bigint % 1500 = 17),
tg as (select key, count(*) as n, max(size) as size from t group by key),
both_sides as (
  select coalesce(s.key, tg.key) as key, s.size as source_size, tg.size as target_size, coalesce(tg.n, 0) as n,
    case when tg.key is null then 'missing' when s.key is null then 'extra' when s.size <> tg.size then 'size_mismatch'
      else 'ok' end as status from s full join tg on s.key = tg.key),
changed as (select *, md5(key) as h from both_sides where status <> 'ok' or n > 1),
keys as (select key, md5(key) as h from s union select key, md5(key) from t)"""


@query("reconcile_digests", f"with {_NEARLY} select key, source_size, target_size, status from both_sides where status <> 'ok'")
def reconcile_digests(spark, sf_dir):
    """Differences of two listings from digests: equal leaves are never compared key by key."""
    return reconcile.compare_by_digest(*_nearly_equal(spark, sf_dir))[0]


@query("reconcile_digest_levels", f"""
with {_NEARLY}
""" + " union all ".join(f"""
select {d} as digits, (select count(distinct left(h, {d})) from keys where {"true" if d == 1 else
  f"left(h, {d - 1}) in (select left(h, {d - 1}) from changed)"})::bigint as n_compared,
  (select count(distinct left(h, {d})) from changed)::bigint as n_differing""" for d in (1, 2, 3, 4)) + """
union all select 32, (select count(*) from (select key from s union all select key from t)
  where left(md5(key), 4) in (select left(h, 4) from changed))::bigint, (select count(*) from both_sides where status <> 'ok')::bigint""")
def reconcile_digest_levels(spark, sf_dir):
    """Nodes compared and found different on each level of the digests, and entries at last."""
    source, target = _nearly_equal(spark, sf_dir)
    found, levels = reconcile.compare_by_digest(source, target)
    leaves, _ = reconcile.differing_leaves(reconcile.digests(source), reconcile.digests(target))
    moved = source.select("key").unionByName(target.select("key")).join(
        leaves, F.left(F.md5(F.col("key").cast("binary")), F.lit(4)) == F.col("node"), "left_semi").count()
    return spark.createDataFrame([*levels, (32, moved, found.count())], "digits int, n_compared long, n_differing long")


@query("reconcile_counts", f"""
with {LISTINGS} select case when t.key is null then 'missing' when s.key is null then 'extra'
    when s.size <> t.size then 'size_mismatch' else 'ok' end as status, count(*)::bigint as n
from source_listing s full join target_listing t on s.key = t.key group by all""")
def reconcile_counts(spark, sf_dir):
    source, target = listings(spark, sf_dir)
    return (reconcile.compare(source, target, source_prefix="p/")
            .groupBy("status").agg(F.count(F.lit(1)).alias("n")))


@query("missing_objects", f"""
with {LISTINGS} select key, modified, size from source_listing s
where not exists (select 1 from target_listing t where t.key = s.key)""")
def missing_objects(spark, sf_dir):
    source, target = listings(spark, sf_dir)
    return reconcile.missing_only(source, target, source_prefix="p/")


@query("inventory_totals", f"""
with {LISTINGS} select 'source' as listing, count(*)::bigint as n_objects, sum(size)::bigint as n_bytes from source_listing
union all select 'target', count(*)::bigint, sum(size)::bigint from target_listing""")
def inventory_totals(spark, sf_dir):
    source, target = listings(spark, sf_dir)
    named = lambda df, name: reconcile.totals(df).select(F.lit(name).alias("listing"), "*")
    return named(source, "source").unionByName(named(target, "target"))


@query("listing_scan", f"with {LISTINGS} select modified, size, 'p/' || key as key from source_listing")
def listing_scan(spark, sf_dir):
    """Listing text with its trailer lines, written out and parsed back."""
    source, _ = listings(spark, sf_dir)
    line = F.concat_ws(" ", F.date_format("modified", "yyyy-MM-dd HH:mm:ss"),
                       F.lpad(F.col("size").cast("string"), 12, " "), "key")
    path = scratch_path(spark, "listing")
    trailer = reconcile.totals(source).select(F.explode(F.array(
        F.lit(""), F.concat(F.lit("Total Objects: "), F.col("n_objects").cast("string")),
        F.concat(F.lit("   Total Size: "), F.col("n_bytes").cast("string")))).alias("value"))
    source.select(line.alias("value")).unionByName(trailer).write.text(path)
    return reconcile.parse_listing(spark.read.text(path))


@query("run_metrics_latest", """
with m as (select strftime(ts, '%Y-%m-%d') as run_id, max(ts) as ts, event_type as name, count(*) as value
  from events group by 1, 3),
r as (select *, row_number() over (partition by name order by ts desc, run_id desc) as rn from m)
select 'metric' as kind, name, run_id, value::varchar as value from r where rn = 1""")
def run_metrics_latest(spark, sf_dir):
    """Daily event counts as a run log; the latest entry of each metric."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    log = (events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
                          F.col("event_type").alias("name"))
           .agg(F.max("ts").alias("ts"), F.count(F.lit(1)).cast("string").alias("value"))
           .withColumn("kind", F.lit("metric")))
    return runs.latest(log).select("kind", "name", "run_id", "value")
