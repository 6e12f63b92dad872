"""Incremental cleaning of newly arrived transaction files."""

from pyspark.sql import functions as F

from tallymill.operators.clean import Unique, apply_rules, first_by_key, transaction_rules
from tallymill.streaming import levels
from tallymill.streaming.run import drain_batches


def _split(dedup):
    """The rules up to and with the key rule, the keys, and the rules after it."""
    rules = transaction_rules(dedup)
    at = next(i for i, rule in enumerate(rules) if isinstance(rule, Unique))
    return rules[:at + 1], list(rules[at].keys), rules[at + 1:]


def _store(sink, keys, fan=levels.FAN):
    return levels.Levels(sink, tuple(keys), fan=fan, reduce=lambda rows: first_by_key(rows, list(keys)))


def clean_arrivals(arrivals, sink, checkpoint, dedup="between", fan=levels.FAN):
    """Add the survivors of each micro-batch of new files to a levelled folder.

    A batch sees its own copies of an id only, so the rules behind the key rule
    wait for :func:`read_cleaned`. The checkpoint remembers finished files, and a
    batch that is replayed after a failure adds copies that the next merge removes.
    Merging keeps the least row of an id, so a row is reduced once per level.
    """
    before, keys, _ = _split(dedup)
    store = _store(sink, keys, fan)

    def write(batch, batch_id):
        levels.append(store, apply_rules(batch, before).withColumn("batch", F.lit(batch_id)))

    drain_batches(arrivals, write, checkpoint)


def read_cleaned(spark, sink, dedup="between"):
    """The cleaned rows of all batches, as one batch over all files would give them:
    the least of the runs' least rows survives, then the later rules apply. A folder that
    is merged into one run (:func:`compact_cleaned`) is scanned without a shuffle."""
    _, keys, after = _split(dedup)
    rows = levels.read(spark, sink).drop("batch", levels.CELL)
    if len(levels.runs(spark, sink)) > 1:
        rows = first_by_key(rows, keys)
    return apply_rules(rows, after)


def compact_cleaned(spark, sink, dedup="between"):
    """Merge all that has arrived into one run."""
    levels.compact(_store(sink, _split(dedup)[1]), spark)
