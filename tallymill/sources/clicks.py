"""Synthetic click messages, derived from the keys of a table."""

from pyspark.sql import functions as F

from tallymill.functions.hashing import digest, lane_int

# Domains of the generated fields.
OBJECT_TYPES = ["banner", "article", "link"]
GEOS = ["ru", "ua", "kz"]
MAX_OBJECT, MAX_USER = 30, 30
DOMAIN = "example.com"
URL_FROM = "https://example.com/"


def _pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def synthetic_clicks(keys, key, ts, salt="clicks"):
    """One click per row of ``keys``: fields are seeded hashes of the key, so the
    same keys give the same clicks on any cluster."""
    h = F.col("_h")
    kind = _pick(OBJECT_TYPES, lane_int(h, 0, len(OBJECT_TYPES)))
    number = (lane_int(h, 1, MAX_OBJECT) + 1).cast("string")
    return (
        keys.select(F.col(ts).cast("int").alias("ts"), digest(key, salt).alias("_h"))
        .withColumn("_kind", kind).withColumn("_number", number)
        .select("ts",
                (lane_int(h, 2, MAX_USER) + 1).cast("int").alias("user_id"),
                _pick(GEOS, lane_int(h, 3, len(GEOS))).alias("geo"),
                F.concat("_kind", "_number").alias("object_id"),
                F.lit(DOMAIN).alias("domain"),
                F.concat(F.lit(f"https://{DOMAIN}/"), "_kind", F.lit("/"), "_number").alias("url"),
                F.lit(URL_FROM).alias("url_from"))
    )


def numbers(spark, rows_per_batch, start=0, step=1, partitions=None):
    """Stream of consecutive numbers ``value`` from 0, ``rows_per_batch`` in each micro-batch, with
    ``ts``: ``start`` in the first micro-batch and ``step`` seconds more in each further one.

    The numbers are keys for :func:`synthetic_clicks`. A restart from the checkpoint goes on with
    the next number, and a repeated micro-batch holds the same ones.
    """
    reader = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch)
              .option("startTimestamp", 1000 * start).option("advanceMillisPerBatch", 1000 * step))
    if partitions:
        reader = reader.option("numPartitions", partitions)
    return reader.load().select("value", F.unix_timestamp("timestamp").alias("ts"))


def to_messages(clicks):
    """Keyed JSON messages."""
    return clicks.select(F.col("user_id").cast("string").alias("key"),
                         F.to_json(F.struct(*clicks.columns)).alias("value"))
