"""Declarative cleaning: an ordered rule list, applied or audited in one pass."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


@dataclass(frozen=True)
class Complete:
    """Every column is present (NaN counts as absent)."""
    name: str = "complete"


@dataclass(frozen=True)
class Keep:
    """Rows for which a SQL predicate is true."""
    name: str
    predicate: str


@dataclass(frozen=True)
class Unique:
    """One row per key: the first in the order of the remaining columns."""
    keys: tuple
    name: str = "unique"


def complete_row(df):
    """Predicate form of ``na.drop('any')``; plain null tests reach the scan."""
    test = F.lit(True)
    for field in df.schema.fields:
        c = F.col(field.name)
        test = test & c.isNotNull()
        if isinstance(field.dataType, (FloatType, DoubleType)):
            test = test & ~F.isnan(c)
    return test


def first_by_key(df, keys, order_by=(), latest=False):
    """One row per key, chosen by a total order, so reruns agree.

    ``order_by`` columns rank first, then every other column in table order.
    An aggregate rather than a window: each map task reduces a repeated key to
    one row before the shuffle, however many copies that key has.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates()
    ranked = list(order_by) + [c for c in rest if c not in order_by]
    pick = F.max if latest else F.min
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*ranked)).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])
    )


def _predicate(df, rule):
    return complete_row(df) if isinstance(rule, Complete) else F.expr(rule.predicate)


def apply_rules(df, rules):
    """Apply the rules in the order given; the order is part of the meaning."""
    for rule in rules:
        if isinstance(rule, Unique):
            df = first_by_key(df, list(rule.keys))
        else:
            df = df.filter(_predicate(df, rule))
    return df


def _first_failure(df, rules):
    """Name of the first rule a row breaks, null if it breaks none."""
    failed = F.lit(None).cast("string")
    for rule in reversed(rules):
        ok = F.coalesce(_predicate(df, rule), F.lit(False))
        failed = F.when(~ok, F.lit(rule.name)).otherwise(failed)
    return failed


def reject_report(df, rules):
    """Rows lost to each rule, in rule order, from one scan and one key shuffle.

    Rows rejected ahead of the key rule collapse to one partial row per reason;
    the others reduce to one row per key with a copy count.
    """
    at = [i for i, r in enumerate(rules) if isinstance(r, Unique)]
    if len(at) > 1:
        raise ValueError("at most one Unique rule can be audited in one pass")
    split = at[0] if at else len(rules)
    tagged = df.withColumn("_before", _first_failure(df, rules[:split]))

    if at:
        keys = list(rules[split].keys)
        rest = [c for c in df.columns if c not in keys]
        ok = F.col("_before").isNull()
        per_key = (
            tagged.groupBy("_before", *[F.when(ok, F.col(k)).alias(k) for k in keys])
            .agg(F.min(F.when(ok, F.struct(*rest))).alias("_row"),
                 F.count(F.lit(1)).alias("_n"))
            .select("_before", "_n", *keys, "_row.*")
        )
        ok = F.col("_before").isNull()
        outcome = per_key.select(
            "_before",
            F.when(ok, F.lit(1)).otherwise(F.col("_n")).alias("_n"),
            F.when(ok, F.col("_n") - 1).otherwise(F.lit(0)).alias("_copies"),
            _first_failure(per_key, rules[split + 1:]).alias("_after"),
        )
    else:
        outcome = tagged.select(
            "_before", F.lit(1).cast("long").alias("_n"), F.lit(0).cast("long").alias("_copies"),
            F.lit(None).cast("string").alias("_after"))

    def lost(i, rule):
        if i == split:
            return F.sum("_copies")
        reason = F.col("_before") if i < split else F.when(F.col("_before").isNull(), F.col("_after"))
        return F.sum(F.when(reason == rule.name, F.col("_n")).otherwise(0))

    kept = F.col("_before").isNull() & F.col("_after").isNull()
    totals = outcome.agg(
        *[F.coalesce(lost(i, r), F.lit(0)).alias(f"_r{i}") for i, r in enumerate(rules)],
        F.coalesce(F.sum(F.when(kept, F.col("_n")).otherwise(0)), F.lit(0)).alias("_kept"),
    )
    rows = [F.struct(F.lit(i + 1).alias("step"), F.lit(r.name).alias("rule"),
                     F.col(f"_r{i}").cast("long").alias("n_rows"))
            for i, r in enumerate(rules)]
    rows.append(F.struct(F.lit(len(rules) + 1).alias("step"), F.lit("kept").alias("rule"),
                         F.col("_kept").cast("long").alias("n_rows")))
    return totals.select(F.inline(F.array(*rows)))


# The transaction rules and their bounds.
_AMOUNT = Keep("positive_amount", "tx_amount > 0")
_CUSTOMER = Keep("customer_id", "customer_id >= 0")
_TERMINAL = Keep("terminal_id", "terminal_id <= 999")


def transaction_rules(dedup="between"):
    """Rules for transaction files.

    ``between`` removes copies before the id rules: where the surviving copy
    breaks an id rule the whole id is lost.  ``last`` filters first.
    """
    unique = Unique(("tranaction_id",))
    if dedup == "between":
        return [Complete(), _AMOUNT, unique, _CUSTOMER, _TERMINAL]
    if dedup == "last":
        return [Complete(), _AMOUNT, _CUSTOMER, _TERMINAL, unique]
    raise ValueError("dedup must be 'between' or 'last'")


def clean_transactions(df: DataFrame, dedup="between") -> DataFrame:
    return apply_rules(df, transaction_rules(dedup))


# Labels of summary records that are not real entries, and the
# open interval of accepted text lengths.
STOP_LABELS = ["Гороскоп на сегодня", "Для всех знаков зодиака."]
MIN_CHARS, MAX_CHARS = 300, 500


def clean_corpus(df, text_cleaner, stop_labels=STOP_LABELS, lo=MIN_CHARS, hi=MAX_CHARS):
    """Drop incomplete rows and stop labels, clean the text, drop copies, keep
    texts strictly between ``lo`` and ``hi`` characters."""
    df = df.filter(complete_row(df)).filter(~F.col("zodiac").isin(stop_labels))
    df = df.withColumn("horo", text_cleaner("horo"))
    # lo < n < hi as one comparison: the filter moves below the cleaning, which
    # two comparisons would then evaluate twice per row.
    in_band = F.abs(2 * F.length("horo") - (lo + hi)) < hi - lo
    return df.filter(in_band).dropDuplicates()
