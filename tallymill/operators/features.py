"""Class weights, splits and scaling."""

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from tallymill.functions.hashing import in_fraction

# Scaled transaction columns, split share and seed.
FEATURES = ("customer_id", "terminal_id", "tx_amount", "tx_time_seconds", "tx_time_days")
TRAIN_SHARE = 0.7
SPLIT_SALT = "42"


def class_weights(df, label):
    """``(label, n, weight)`` with weight = rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # The aggregates of a few counts enter as scalars: no join, no window.
    rows = counts.agg(F.sum("n")).scalar()
    classes = counts.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", rows / (classes * F.col("n")))


def with_class_weight(df, label, name="weight"):
    """Balanced weight of a 0/1 label on every row, by a map-side projection.

    The two class counts come from one scalar subquery over the label column. A
    table holding a single class fails: its weights are undefined.
    """
    counts = df.agg(F.struct(F.count_if(F.col(label) == 1).alias("ones"),
                             F.count_if(F.col(label) == 0).alias("zeros"))).scalar()
    ones, zeros = counts["ones"], counts["zeros"]
    both = F.when((ones > 0) & (zeros > 0), ones + zeros).otherwise(
        F.raise_error(F.lit(f"{label} needs both classes 0 and 1")).cast("long"))
    weight = F.when(F.col(label) == 1, both / (2 * ones)).otherwise(both / (2 * zeros))
    return df.withColumn(name, weight)


def hash_split(df, key, share=TRAIN_SHARE, salt=SPLIT_SALT, name="split"):
    """``train``/``test`` by a salted hash of the key: the same row falls on the
    same side in every run, on any number of partitions."""
    return df.withColumn(
        name, F.when(in_fraction(key, share, salt), "train").otherwise("test"))


def scaling_stages(columns=FEATURES, output="features"):
    """Assemble once, then centre and scale the vector (fitted on train only)."""
    return [
        VectorAssembler(inputCols=list(columns), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol=output, withMean=True, withStd=True),
    ]


def standardise(train, df, columns=FEATURES):
    """``df`` with ``<column>_scaled`` columns, moments taken from ``train``; a
    constant column scales to 0.

    All moments come from one scalar subquery, so scaling is a plain projection.
    """
    x = {c: F.col(c).cast("double") for c in columns}
    moments = train.agg(F.struct(*[
        f(x[c]).alias(f"{c}_{name}") for c in columns
        for name, f in (("mean", F.avg), ("std", F.stddev_samp))])).scalar()
    return df.withColumn("_m", moments).select(*df.columns, *[
        F.when(F.col(f"_m.{c}_std") == 0, 0.0)
        .otherwise((x[c] - F.col(f"_m.{c}_mean")) / F.col(f"_m.{c}_std")).alias(f"{c}_scaled")
        for c in columns])
