"""Label columns."""

from pyspark.sql import functions as F

# Labels returned by the acceptability and sentiment models.
ACCEPTABLE_LABEL = "LABEL_1"
NEGATIVE_LABEL = "negative"


def acceptable(c):
    """1 for the acceptable label, 0 for anything else (null included)."""
    return F.when(F.col(c) == ACCEPTABLE_LABEL, 1).otherwise(0)


def non_negative(c):
    """0 for the negative label, 1 for anything else (null included)."""
    return F.when(F.col(c) == NEGATIVE_LABEL, 0).otherwise(1)


def positive_rate(c, digits=2):
    """Percentage of rows whose 0/1 label is 1; null labels count as not 1."""
    return F.round(F.count_if(F.col(c) == 1) / F.count(F.lit(1)) * 100, digits)
