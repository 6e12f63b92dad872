"""Declared schemas of the tables the jobs read and write."""

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Column names (including the misspelt transaction id) and types
# of the incoming transaction files. Ids are 64-bit, so that no range is unreadable.
TRANSACTIONS = _struct(
    ("tranaction_id", T.LongType()),
    ("tx_datetime", T.TimestampType()),
    ("customer_id", T.LongType()),
    ("terminal_id", T.LongType()),
    ("tx_amount", T.FloatType()),
    ("tx_time_seconds", T.IntegerType()),
    ("tx_time_days", T.IntegerType()),
    ("tx_fraud", T.IntegerType()),
    ("tx_fraud_scenario", T.IntegerType()),
)

# Click message fields.
CLICKS = _struct(
    ("ts", T.IntegerType()),
    ("user_id", T.IntegerType()),
    ("geo", T.StringType()),
    ("object_id", T.StringType()),
    ("domain", T.StringType()),
    ("url", T.StringType()),
    ("url_from", T.StringType()),
)

# Corpus record fields.
CORPUS = _struct(
    ("date", T.TimestampType()),
    ("zodiac", T.StringType()),
    ("horo", T.StringType()),
    ("source", T.StringType()),
)

RUN_METRICS = _struct(
    ("run_id", T.StringType()),
    ("ts", T.TimestampType()),
    ("kind", T.StringType()),
    ("name", T.StringType()),
    ("value", T.StringType()),
)

LISTING = _struct(
    ("modified", T.TimestampType()),
    ("size", T.LongType()),
    ("key", T.StringType()),
)

