"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate: its share of the target bytes over the
bytes it has.  A document's uniform draw, a hash of its id, is inverted through
the Poisson distribution of its source's rate; the document is repeated so many
times and all copies are dealt out and ordered by a hash.
"""

from pyspark.sql import functions as F
from pyspark.sql import Window

SEED = "mix-1"
SHUFFLE_SEED = "shuffle-1"
TEMPERATURE = 0.5
EPOCHS = 1.0
BROADCAST_CELLS = 1_000_000
_HEX = 13


def hashed_long(text, digits):
    """The first hex digits of the MD5 of a string column as a bigint."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("bigint")


def uniform(key, seed):
    value = hashed_long(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))), _HEX)
    return (value + F.lit(0.5)) / F.lit(float(16 ** _HEX))


def source_rates(docs, targets=None, temperature=TEMPERATURE, epochs=EPOCHS):
    """``source, rate``: mean repetitions that bring each source to its share.

    ``targets`` maps sources to weights; a source it leaves out gets rate 0.
    Without it, weights are the sources' bytes to the power ``temperature``.  The
    target size is ``epochs`` times all bytes of the table.  A source without
    bytes has rate 0.
    """
    sizes = docs.groupBy("source").agg(
        F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")).alias("bytes"))
    if targets is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("bytes").cast("double"), F.lit(float(temperature))))
    else:
        pairs = [F.struct(F.lit(s).cast("string").alias("s"), F.lit(float(w)).alias("w")) for s, w in targets.items()]
        weight = F.aggregate(F.array(*pairs), F.lit(0.0),
                             lambda acc, p: F.when(p["s"].eqNullSafe(F.col("source")), p["w"]).otherwise(acc))
        weighed = sizes.withColumn("weight", weight)
    totals = weighed.agg(F.sum("bytes").alias("all_bytes"),
                         F.sort_array(F.collect_list("weight")).alias("weights"))
    all_bytes = F.lit(0).cast("bigint")
    row = totals.select("all_bytes", F.aggregate("weights", F.lit(0.0), lambda a, x: a + x).alias("all_weights")).first()
    all_bytes, all_weights = row["all_bytes"] or 0, row["all_weights"] or 0.0
    rate = F.lit(float(epochs) * all_bytes) * F.col("weight") / F.lit(all_weights) / F.col("bytes")
    usable = (F.col("bytes") > 0) & (F.lit(all_weights) > 0)
    return weighed.select("source", F.when(usable, rate).otherwise(F.lit(0.0)).alias("rate"))


def with_distribution(rates):
    """Adds ``cdf``, the Poisson distribution function at 0, 1, 2 ... until it is one in double
    precision.  Terms are kept as logarithms, so that a large rate does not underflow.

    A row per source and count is summed up in order, so the work grows with the rate."""
    rate = F.col("rate")
    top = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    counts = rates.where("rate > 0").select("source", "rate", F.explode(F.sequence(F.lit(0), top)).alias("k"))
    upto = Window.partitionBy("source").orderBy("k")
    term = F.sum(F.when(F.col("k") == 0, -rate).otherwise(F.log(rate) - F.log(F.col("k").cast("double")))).over(upto)
    summed = counts.withColumn("term", term).withColumn("c", F.sum(F.exp("term")).over(upto))
    tables = summed.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("k", "c"))).alias("t")).select(
        F.col("source").alias("named"), F.col("t.c").alias("table"))
    return rates.join(tables, rates["source"].eqNullSafe(tables["named"]), "left").select(
        *rates.columns, F.coalesce("table", F.array(F.lit(1.0))).alias("cdf"))


NAMES = ("copy", "rate", "shuffle_key")


def mix(docs, targets=None, temperature=TEMPERATURE, epochs=EPOCHS, seed=SEED, names=NAMES):
    """All columns of ``docs`` with ``copy`` (1, 2 ...), ``rate`` and ``shuffle_key`` (or other
    ``names``), one row per copy, in a random order that the seed fixes.

    Copies are dealt to partitions by a hash of ``shuffle_key`` and of the row, so that
    rows without an id do not meet in one, and are sorted by the key there.  Input columns of the three names are replaced.  A null source is a
    source; null and empty texts count no bytes but are drawn like the others of
    their source.  Rows that share an id share their draw; null ids share one.  An
    empty table gives no rows.
    """
    copy, rate, key = names
    columns = [c for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    rates = with_distribution(source_rates(docs, targets, temperature, epochs))
    small = rates.select("source", "rate", F.size("cdf").alias("n")).agg(F.sum("n")).first()[0] or 0
    rates = rates.select(F.col("source").alias("__tm_source"), F.col("rate").alias("__tm_rate"), F.col("cdf").alias("__tm_cdf"))
    if small <= BROADCAST_CELLS:
        rates = F.broadcast(rates)
    drawn = (docs.select(*[F.col(f"`{c}`") for c in columns], uniform(F.col("doc_id"), seed).alias("__tm_u"))
             .join(rates, F.col("source").eqNullSafe(F.col("__tm_source"))))
    n = F.size(F.filter("__tm_cdf", lambda c: F.col("__tm_u") >= c))
    copies = (drawn.withColumn("__tm_n", n).where("__tm_n > 0")
              .select(*[F.col(f"`{c}`") for c in columns], F.col("__tm_rate").alias(rate),
                      F.explode(F.sequence(F.lit(1), F.col("__tm_n"))).alias(copy)))
    named = F.concat(F.lit(SHUFFLE_SEED + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                     F.lit(":"), F.col(copy).cast("string"))
    keyed = copies.withColumn(key, hashed_long(named, 15))
    # Rows that share an id share their keys; their places in the input spread them.
    dealt = keyed.withColumn("__tm_row", F.monotonically_increasing_id())
    return dealt.repartition(key, "__tm_row").sortWithinPartitions(key).drop("__tm_row")
