"""Table profiling: each report is one aggregate over one pruned scan, and
:func:`review` fuses the reports of a table into a single aggregate."""

from pyspark.sql import functions as F, types as T, Window

from tallymill.session import materialise


def _rows(one_row, structs):
    """Turn the columns of a one-row aggregate into report rows."""
    return one_row.select(F.inline(F.array(*structs)))


def _report(df, parts):
    aggregates, structs = parts
    return _rows(df.agg(*aggregates), structs)


def _is_number(field):
    return isinstance(field.dataType, T.NumericType)


def _is_float(field):
    return isinstance(field.dataType, (T.FloatType, T.DoubleType))


# Columns judged by absence rather than by zero, and label columns
# that the missing-value review leaves out.
ID_COLUMNS = ("tranaction_id", "customer_id", "terminal_id", "tx_datetime")
LABEL_COLUMNS = ("tx_fraud", "tx_fraud_scenario")


def _missing_parts(df, id_columns, skip):
    fields = [f for f in df.schema.fields if f.name not in skip]
    aggs, structs = [], []
    for i, f in enumerate(fields):
        c = F.col(f.name)
        zero = F.count_if(c == 0) if _is_number(f) else F.lit(0)
        nan = F.count_if(F.isnan(c)) if _is_float(f) else F.lit(0)
        aggs += [F.count_if(c.isNull()).alias(f"nu{i}"),
                 zero.cast("long").alias(f"ze{i}"), nan.cast("long").alias(f"na{i}")]
        missing = F.col(f"nu{i}") if f.name in id_columns else F.col(f"ze{i}") + F.col(f"na{i}")
        structs.append(F.struct(
            F.lit(f.name).alias("column"), F.col(f"nu{i}").alias("n_null"),
            F.col(f"ze{i}").alias("n_zero"), F.col(f"na{i}").alias("n_nan"),
            missing.alias("n_missing")))
    return aggs, structs


def missing_profile(df, id_columns=ID_COLUMNS, skip=LABEL_COLUMNS):
    """``(column, n_null, n_zero, n_nan, n_missing)`` for every reviewed column.

    ``n_missing`` is the null count of id columns and the zero-or-NaN count of
    the others; nulls of the latter show only in ``n_null``.
    """
    return _report(df, _missing_parts(df, id_columns, skip))


def key_profile(df, key, approx_rsd=None):
    """Row, distinct, duplicate and id-span counts of an integer key.

    A null key counts as one more distinct value, as a distinct projection
    would. ``n_unused`` compares the span ``max - min`` with the distinct count;
    ``n_missing_ids`` uses the true number of ids in the range.
    """
    distinct = (F.approx_count_distinct(key, approx_rsd) if approx_rsd
                else F.count_distinct(key))
    one = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(key).isNull()).alias("n_null"),
        distinct.alias("d"),
        F.min(key).cast("long").alias("min_id"),
        F.max(key).cast("long").alias("max_id"),
    )
    n_distinct = F.col("d") + (F.col("n_null") > 0).cast("long")
    span = F.col("max_id") - F.col("min_id")
    return one.select(
        "n_rows", "n_null", n_distinct.alias("n_distinct"),
        (F.col("n_rows") - n_distinct).alias("n_duplicates"),
        "min_id", "max_id", span.alias("id_span"),
        (span - n_distinct).alias("n_unused"),
        (span + 1 - F.col("d")).alias("n_missing_ids"),
    )


_LEVEL_BITS = (16, 32, 48)


def id_gaps(df, key):
    """Every run of unused ids between the smallest and the largest id, as
    ``(gap_start, gap_end, n_ids)``.

    No task ever orders the whole id list: ids are compared with their successor
    inside blocks of 2**16, the blocks' ends inside blocks of 2**32, and so on,
    so a window group holds at most 65536 rows at every level.
    """
    spans = (df.filter(F.col(key).isNotNull())
             .select(F.col(key).cast("long").alias("lo")).distinct()
             .withColumn("hi", F.col("lo")))
    gaps = None
    for bits in (*_LEVEL_BITS, None):
        block = F.shiftright("lo", bits) if bits else F.lit(0)
        blocked = spans.withColumn("block", block)
        following = F.lead("lo").over(Window.partitionBy("block").orderBy("lo"))
        found = (blocked.withColumn("next", following)
                 .filter(F.col("next") > F.col("hi") + 1)
                 .select((F.col("hi") + 1).alias("gap_start"),
                         (F.col("next") - 1).alias("gap_end")))
        gaps = found if gaps is None else gaps.unionByName(found)
        if bits:
            spans = (blocked.groupBy("block")
                     .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
                     .select("lo", "hi"))
    return gaps.withColumn("n_ids", F.col("gap_end") - F.col("gap_start") + 1)


def _summary_parts(df, digits):
    fields = [f for f in df.schema.fields
              if _is_number(f) or isinstance(f.dataType, T.StringType)]
    aggs, structs = [], []
    for i, f in enumerate(fields):
        c = F.col(f.name)
        number = _is_number(f)
        x = c.cast("double")
        aggs.append(F.count(c).alias(f"n{i}"))
        if number:
            aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
        aggs += [F.min(x if number else c).alias(f"lo{i}"),
                 F.max(x if number else c).alias(f"hi{i}")]
        none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
        structs.append(F.struct(
            F.lit(f.name).alias("column"), F.col(f"n{i}").alias("n"),
            (F.round(f"m{i}", digits) if number else none).alias("mean"),
            (F.round(f"s{i}", digits) if number else none).alias("stddev"),
            (F.col(f"lo{i}") if number else none).alias("min"),
            (F.col(f"hi{i}") if number else none).alias("max"),
            (text if number else F.col(f"lo{i}")).alias("min_text"),
            (text if number else F.col(f"hi{i}")).alias("max_text")))
    return aggs, structs


def summary(df, digits=4):
    """count, mean, sample deviation, min and max of numeric and text columns
    (other types are left out, as ``describe`` does), one row per column."""
    return _report(df, _summary_parts(df, digits))


def percentiles(df, columns, at=(0.25, 0.5, 0.75), accuracy=10000):
    """Approximate percentiles, ``(column, percentile, value)``."""
    one = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(at), accuracy).alias(c)
                   for c in columns])
    return _rows(one, [
        F.struct(F.lit(c).alias("column"), F.lit(p).alias("percentile"),
                 F.col(c)[i].alias("value"))
        for c in columns for i, p in enumerate(at)])


def value_histogram(df, columns):
    """``(column, value, n)`` for several columns from one scan and one shuffle."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"),
                               F.col(c).cast("string").alias("value")) for c in columns])
    return (df.select(F.inline(cells))
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def _violation_parts(predicates):
    aggs = [F.count_if(F.expr(p)).alias(f"v{i}") for i, p in enumerate(predicates.values())]
    return aggs, [F.struct(F.lit(n).alias("rule"), F.col(f"v{i}").alias("n_rows"))
                  for i, n in enumerate(predicates)]


def violations(df, predicates):
    """``(rule, n_rows)`` breaking each named SQL predicate, in one pass."""
    return _report(df, _violation_parts(predicates))


# Stated label domains and id bounds of transactions.
TRANSACTION_DOMAINS = {"tx_fraud": [0, 1], "tx_fraud_scenario": [0, 1, 2, 3]}
TRANSACTION_VIOLATIONS = {
    "negative_customer": "customer_id < 0",
    "terminal_over_999": "terminal_id > 999",
}


def _domain_parts(domains):
    aggs = []
    for i, (n, values) in enumerate(domains.items()):
        aggs += [F.count_if(~F.col(n).isin(values)).alias(f"o{i}"),
                 F.count_if(F.col(n).isNull()).alias(f"u{i}")]
    return aggs, [F.struct(F.lit(n).alias("column"), F.col(f"o{i}").alias("n_outside"),
                           F.col(f"u{i}").alias("n_null")) for i, n in enumerate(domains)]


def domain_check(df, domains=None):
    """Values outside a column's domain and nulls, one row per column."""
    return _report(df, _domain_parts(domains or TRANSACTION_DOMAINS))


def extremes(df, column, k=10):
    """The ``k`` lowest and ``k`` highest distinct values, as two top-k's rather
    than the ends of a full sort. Values keep their type. A null ranks lowest."""
    values = df.select(F.col(column).alias("value")).distinct()

    def edge(name, order):
        return (values.orderBy(order).limit(k)
                .select(F.lit(column).alias("column"), F.lit(name).alias("edge"), "value"))

    return edge("lowest", F.asc("value")).unionByName(edge("highest", F.desc("value")))


def _schema_parts(df):
    aggs = [F.count(F.col(n)).alias(f"c{i}") for i, n in enumerate(df.columns)]
    return aggs, [
        F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("type"),
                 F.col(f"c{i}").alias("n_present"))
        for i, f in enumerate(df.schema.fields)]


def schema_profile(df):
    """``(position, column, type, n_present)`` of every column."""
    return _report(df, _schema_parts(df))


def review(df, id_columns=ID_COLUMNS, skip=LABEL_COLUMNS, predicates=None, domains=None, digits=4):
    """Schema, summary, missing, violation and domain reports, by name, from one
    pass: their aggregates run together and the one resulting row is kept."""
    parts = {
        "schema": _schema_parts(df),
        "summary": _summary_parts(df, digits),
        "missing": _missing_parts(df, id_columns, skip),
        "violations": _violation_parts(predicates or TRANSACTION_VIOLATIONS),
        "domains": _domain_parts(domains or TRANSACTION_DOMAINS),
    }
    row = materialise(df.agg(*[a for aggs, _ in parts.values() for a in aggs]), "review")
    return {name: _rows(row, structs) for name, (_, structs) in parts.items()}


def schema_drift(df, expected):
    """Differences between a table and its declared schema, as
    ``[(column, expected_type, actual_type)]`` (None where absent)."""
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [(n, want.get(n), have.get(n)) for n in {**want, **have}
            if want.get(n) != have.get(n)]


def absence(df, column):
    """``null``, ``nan`` or ``zero`` for a value that counts as absent, else null."""
    c = F.col(column)
    why = F.when(c.isNull(), "null")
    if _is_float(df.schema[column]):
        why = why.when(F.isnan(c), "nan")
    return why.when(c == 0, "zero")


def absence_counts(df, columns):
    """``(column, why, n)`` of absent values of numeric columns, in one pass."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), absence(df, c).alias("why"))
                      for c in columns])
    return (df.select(F.inline(cells)).filter(F.col("why").isNotNull())
            .groupBy("column", "why").agg(F.count(F.lit(1)).alias("n")))


def preview(df, n=20):
    """The first rows found, for display."""
    return df.limit(n)
