"""Click stream: parse, filter by country, project, re-key.

Plain DataFrame functions, so the batch form and the stream share one plan.
"""

from pyspark.sql import functions as F

from tallymill.operators.clean import first_by_key
from tallymill.schemas import CLICKS
from tallymill.streaming import levels
from tallymill.streaming.run import drain_batches

# The country kept and the fields passed on.
GEO = "ru"
FIELDS = ("ts", "user_id", "object_id", "domain", "url")


def parse_clicks(messages, value="value"):
    """JSON text (or bytes) to typed fields; unreadable JSON gives nulls."""
    return (messages.select(F.from_json(F.col(value).cast("string"), CLICKS).alias("t"))
            .select("t.*"))


def filter_clicks(messages, geo=GEO, value="value"):
    """Clicks of one country. A message without a country is dropped, unreadable
    ones included."""
    return parse_clicks(messages, value).filter(F.col("geo") == geo).select(*FIELDS)


def rekey(clicks, key="user_id", ignore_null_fields=True):
    """Text key and JSON value; null fields vanish from the JSON unless kept."""
    options = {"ignoreNullFields": str(ignore_null_fields).lower()}
    return clicks.select(F.col(key).cast("string").alias("key"),
                         F.to_json(F.struct(*clicks.columns), options).alias("value"))


def dedupe_redelivered(events, key, event_time, delay, spread_by=None, salts=32):
    """Drop repeated deliveries of an event within ``delay`` of event time.

    State is held for ``delay`` past the watermark, which bounds it. Copies farther
    apart pass. An event that arrives more than ``delay`` behind the latest event
    time seen is dropped, even a first delivery: choose ``delay`` by the longest
    outage to expect, drain with ``late="fail"`` (or watch ``run.late_rows``), or
    use :func:`dedupe_written`, which loses nothing.

    A stream has no map-side reduction, so an event delivered very often would
    meet one task. ``spread_by`` names a column that differs between copies (an
    offset, a delivery id): copies are first thinned per key and salt.
    """
    keys = [key] if isinstance(key, str) else list(key)
    events = events.withWatermark(event_time, delay)
    if spread_by:
        salt = F.pmod(F.xxhash64(spread_by), F.lit(salts))
        events = (events.withColumn("_salt", salt)
                  .dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt"))
    return events.dropDuplicatesWithinWatermark(keys)


def dedupe_written(events, key, sink, checkpoint, buckets=64, cell=None, fan=levels.FAN, report=None):
    """Append each event once to a levelled folder, however late its copies are.

    A micro-batch reduces to one row per key (the least in column order) and is
    anti-joined with the keys already written in the cells it touches; see
    :mod:`tallymill.streaming.levels`. ``cell`` is a column expression that copies of
    an event share, such as its day; without it keys are dealt to ``buckets`` by hash.
    ``report`` is called with (batch id, what the batch read). Rows carry ``_batch``.
    Read with ``read_deduped``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if cell is None:
        cell = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    store = levels.Levels(sink, tuple(keys), cell, fan)

    def write(batch, batch_id):
        fresh = first_by_key(batch, keys).withColumn("_batch", F.lit(batch_id))
        done = levels.append(store, fresh, fresh_only=True)
        if report:
            report(batch_id, done)

    drain_batches(events, write, checkpoint)


def read_deduped(spark, sink):
    """The events kept by :func:`dedupe_written`."""
    return levels.read(spark, sink).drop(levels.CELL, "_batch")
