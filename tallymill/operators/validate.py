"""Ranking metrics, metric resampling, hypothesis tests, champion selection."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, Window
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from tallymill.functions.hashing import PRIME, coefficients, digest, polynomial
from tallymill.functions.stats import SHAPIRO_MAX, shapiro_wilk, t_two_sided
from tallymill.session import materialise

# Resampling and test parameters, names of the test's results.
REPLICATES = 100
SAMPLE_SHARE = 0.01
ALPHA = 0.01
# A task holds the hash table of its sampled rows.
MEMBERS_PER_TASK = 1_000_000
DIFFERENT, IDENTICAL = "dist_DIFFERENT", "dist_IDENTICAL"


def weighted_auc(df, label, score, weight=None, by=(), partitions=None):
    """Exact weighted area under the ROC curve, optionally per group.

    Rows first reduce to one per distinct score. Those are range-partitioned, so
    neither a hot group nor a long score list meets one task: every segment
    ranks its own scores, and segments combine through their totals (a segment's
    positives beat all negatives of the segments below). Ties count one half.
    ``auc`` is null where a class is absent. Rows without a score take no part;
    ``n_null_score`` counts them.

    ``partitions`` sets the tasks of each step in place of the session's number, for many groups
    that no one score fills: rows meet by group and score without being reduced before.
    """
    by = list(by)
    tasks = [partitions] if partitions else []
    if partitions:
        df = df.repartition(partitions, *by, score)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    scored = F.col(score).isNotNull()
    per_score = (
        df.groupBy(*by, F.col(score).alias("_s"))
        .agg(F.sum(F.when(scored & (F.col(label) == 1), w).otherwise(0.0)).alias("_p"),
             F.sum(F.when(scored & (F.col(label) == 0), w).otherwise(0.0)).alias("_n"),
             F.count_if(scored).alias("_rows"), F.count_if(~scored).alias("_null"))
    )
    ranged = (per_score.repartitionByRange(*tasks, *by, "_s")
              .withColumn("_seg", F.spark_partition_id()))
    if partitions:
        ranged = ranged.repartition(partitions, *by, "_seg")
    earlier = (Window.partitionBy(*by, "_seg").orderBy("_s")
               .rowsBetween(Window.unboundedPreceding, -1))
    below = F.coalesce(F.sum("_n").over(earlier), F.lit(0.0))
    segments = (
        ranged.withColumn("_u", F.col("_p") * (below + F.col("_n") / 2))
        .groupBy(*by, "_seg")
        .agg(*[F.sum(c).alias(c) for c in ("_p", "_n", "_u", "_rows", "_null")])
    )
    # One row per group and partition from here on.
    lower = (Window.partitionBy(*by).orderBy("_seg")
             .rowsBetween(Window.unboundedPreceding, -1))
    joined = segments.withColumn(
        "_u", F.col("_u") + F.col("_p") * F.coalesce(F.sum("_n").over(lower), F.lit(0.0)))
    pairs = F.sum("_p") * F.sum("_n")
    return joined.groupBy(*by).agg(
        F.sum("_rows").alias("n_rows"), F.sum("_null").alias("n_null_score"), F.sum("_p").alias("w_pos"), F.sum("_n").alias("w_neg"),
        F.when(pairs > 0, F.sum("_u") / pairs).alias("auc"))


def sample_replicates(df, key, salt, replicates=REPLICATES, share=SAMPLE_SHARE):
    """One row per (row, replicate it belongs to): Bernoulli samples without
    replacement, all drawn in one pass. ``salt`` is a string column.

    A row's digest seeds a polynomial whose value at each replicate number
    decides membership, so drawing stays inside generated code and only members
    leave it.
    """
    return (
        df.withColumn("_c", coefficients(digest(key, F.col(salt))))
        .withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
        .filter(polynomial(F.col("_c"), F.col("replicate")) < round(share * PRIME))
        .drop("_c")
    )


def gap_replicates(df, key, salt, replicates=REPLICATES, share=SAMPLE_SHARE):
    """The same kind of samples as :func:`sample_replicates`, drawn by gaps: a row hops from one
    replicate it belongs to to the next, so its work is its memberships, not the replicates.

    The gaps between successes of independent trials are geometric; hop ``k`` inverts that
    distribution at the value of the row's polynomial at ``k``.
    """
    if not 0 < share < 1:
        raise ValueError("share must be between 0 and 1")
    columns, rate = df.columns, np.log(1 - share)

    def hop(batches):
        for batch in batches:
            seeds = np.array(batch["_c"].tolist(), dtype=np.int64).reshape(-1, 4)
            rows, at, k = np.arange(len(batch)), np.full(len(batch), -1, dtype=np.int64), 0
            while len(rows):
                value = seeds[rows, 3]
                for i in (2, 1, 0):
                    value = (value * k + seeds[rows, i]) % PRIME
                at = at + 1 + np.floor(np.log((value + 0.5) / PRIME) / rate).astype(np.int64)
                inside = at < replicates
                rows, at, k = rows[inside], at[inside], k + 1
                # One batch at most per hop, however many replicates a row belongs to.
                yield batch[columns].iloc[rows].assign(replicate=at.astype(np.int32))

    schema = StructType([*df.schema.fields, StructField("replicate", IntegerType())])
    return df.withColumn("_c", coefficients(digest(key, F.col(salt)))).mapInPandas(hop, schema)


def auc_replicates(df, key, label, scores, weight=None, replicates=REPLICATES,
                   share=SAMPLE_SHARE, degenerate="exclude", by_gaps=False):
    """AUC of ``replicates`` samples for each model, as ``(model, replicate,
    n_rows, auc)``, in one job.

    ``scores`` maps model name to score column; every model draws its own
    samples. One-class samples have no AUC: ``exclude`` drops them, ``keep``
    leaves null, ``mllib`` gives Spark ML's constants (0 without positives, 1
    without negatives, 0.5 for an empty sample). ``by_gaps`` draws other samples of the
    same kind, with work in proportion to their rows: for thousands of replicates. Their number
    is expected from a count of ``df``, and the tasks follow it.
    """
    weight_column = F.col(weight).cast("double") if weight else F.lit(1.0)
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("_score"))
                       for m, c in scores.items()])
    long = (df.select(key, F.col(label).alias("_y"), weight_column.alias("_w"),
                      F.explode(models).alias("_m"))
            .select(key, "_y", "_w", "_m.*"))
    partitions = None
    if by_gaps:
        members = df.count() * len(scores) * replicates * share
        if members > MEMBERS_PER_TASK:
            partitions = max(math.ceil(members / MEMBERS_PER_TASK), df.sparkSession.sparkContext.defaultParallelism)
            long = long.repartition(partitions)
    drawn = (gap_replicates if by_gaps else sample_replicates)(long, key, "model", replicates, share)
    out = weighted_auc(drawn, "_y", "_score", "_w", by=("model", "replicate"), partitions=partitions)
    if degenerate == "keep":
        return out.select("model", "replicate", "n_rows", "auc")
    if degenerate == "exclude":
        return out.filter(F.col("auc").isNotNull()).select("model", "replicate", "n_rows", "auc")
    if degenerate != "mllib":
        raise ValueError("degenerate must be 'exclude', 'keep' or 'mllib'")
    every = (df.sparkSession.range(replicates)
             .select(F.col("id").cast("int").alias("replicate"),
                     F.explode(F.array(*[F.lit(m) for m in scores])).alias("model")))
    constant = (F.when(F.col("n_rows").isNull(), 0.5)
                .when(F.col("w_pos") <= 0, 0.0).otherwise(1.0))
    return (every.join(out, ["model", "replicate"], "left")
            .select("model", "replicate",
                    F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                    F.coalesce("auc", constant).alias("auc")))


def normality(scores, by="model", value="auc"):
    """Shapiro-Wilk statistic and p-value per group of scores; ``by`` is a column or a list.

    A group is one model's replicates, never raw rows. Null scores are left out.
    Below three values there is no statistic; above 5000 the p-value lies outside
    the range its approximation was made for, and ``extrapolated`` says so."""
    by = [by] if isinstance(by, str) else list(by)
    fields = [scores.schema[c] for c in by]
    out = StructType([*fields, StructField("n", LongType()), StructField("statistic", DoubleType()),
                      StructField("p_value", DoubleType()), StructField("extrapolated", BooleanType())])

    def test(key, pdf):
        values = pdf[value].dropna().to_numpy()
        stat, p = shapiro_wilk(values) if len(values) >= 3 else (None, None)
        return pd.DataFrame([[*key, len(values), stat, p, len(values) > SHAPIRO_MAX]],
                            columns=out.names)

    return scores.select(*by, value).groupBy(*by).applyInPandas(test, out)


def jarque_bera(scores, by="model", value="auc"):
    """A different normality test, from skewness and kurtosis alone."""
    s, k, n = F.skewness(value), F.kurtosis(value), F.count(value)
    return (scores.groupBy(by)
            .agg(n.alias("n"), (n / 6 * (s * s + k * k / 4)).alias("statistic"))
            .withColumn("p_value", F.exp(-F.col("statistic") / 2)))


@F.pandas_udf(DoubleType())
def _t_p_value(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided(a, b) for a, b in zip(t, dof)], dtype="float64")


def t_test(scores, first, second, model="model", value="auc", alpha=ALPHA):
    """Two-sample equal-variance t-test between two models' scores: one row."""
    def of(name, f):
        return f(F.when(F.col(model) == name, F.col(value)))

    n1, n2 = F.col("n_first"), F.col("n_second")
    pooled = ((n1 - 1) * F.col("_v1") + (n2 - 1) * F.col("_v2")) / F.col("dof")
    return (
        scores.agg(of(first, F.count).alias("n_first"), of(second, F.count).alias("n_second"),
                   of(first, F.avg).alias("mean_first"), of(second, F.avg).alias("mean_second"),
                   of(first, F.var_samp).alias("_v1"), of(second, F.var_samp).alias("_v2"))
        .withColumn("dof", n1 + n2 - 2)
        .withColumn("t", (F.col("mean_first") - F.col("mean_second"))
                    / F.sqrt(pooled * (1 / n1 + 1 / n2)))
        .withColumn("p_value", _t_p_value("t", F.col("dof").cast("double")))
        .withColumn("result", F.when(F.col("p_value") < alpha, DIFFERENT).otherwise(IDENTICAL))
        .select("n_first", "n_second", "mean_first", "mean_second", "dof", "t", "p_value", "result")
    )


def champion(test, baseline, tuned, require_improvement=False):
    """The tuned model wins when the distributions differ, in either direction
    unless an improvement is required."""
    wins = F.col("result") == DIFFERENT
    if require_improvement:
        wins = wins & (F.col("mean_second") > F.col("mean_first"))
    return test.withColumn("champion", F.when(wins, tuned).otherwise(baseline))


# Planned quality floors.
FLOORS = {"precision": 0.98, "recall": 0.95, "f1": 0.96}


def _rates(rows):
    """Precision, recall and F1 of rows with ``tp``, ``fp`` and ``fn``."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    ratio = lambda a, b: F.when(b > 0, a / b)
    return (
        rows.withColumn("precision", ratio(tp, tp + fp))
        .withColumn("recall", ratio(tp, tp + fn))
        .withColumn("f1", ratio(2 * tp, 2 * tp + fp + fn))
    )


def _meets(floors):
    return F.coalesce((F.col("precision") >= floors["precision"]) & (F.col("recall") >= floors["recall"])
                      & (F.col("f1") >= floors["f1"]), F.lit(False))


def threshold_metrics(df, label, score, thresholds, floors=None):
    """Precision, recall, F1 and false positives at each threshold (predicted 1
    when score >= threshold). Rows without a score take no part; ``n_null_score``
    counts them.

    Rows reduce to counts per threshold interval in one pass; thresholds never
    multiply the rows.
    """
    cuts = sorted(float(t) for t in thresholds)
    passed = sum([F.when(F.col(score) >= t, 1).otherwise(0) for t in cuts], F.lit(0))
    scored = F.col(score).isNotNull()
    counts = (df.groupBy(passed.cast("long").alias("_passed"))
              .agg(F.count_if(scored & (F.col(label) == 1)).alias("_pos"),
                   F.count_if(scored & (F.col(label) == 0)).alias("_neg"),
                   F.count_if(~scored).alias("_null")))
    # From here on there is one row per threshold, whatever the table's size.
    zero = F.lit(0).cast("long")
    levels = df.sparkSession.range(len(cuts) + 1).select(
        F.col("id").alias("_passed"), zero.alias("_pos"), zero.alias("_neg"), zero.alias("_null"))
    upward = Window.orderBy(F.desc("_passed")).rowsBetween(Window.unboundedPreceding, 0)
    level = (counts.unionByName(levels).groupBy("_passed")
             .agg(*[F.sum(c).alias(c) for c in ("_pos", "_neg", "_null")]))
    rows = (
        level.select("_passed", F.sum("_pos").over(upward).alias("tp"),
                     F.sum("_neg").over(upward).alias("fp"),
                     F.sum("_pos").over(Window.partitionBy()).alias("_all"),
                     F.sum("_null").over(Window.partitionBy()).alias("n_null_score"))
        .filter("_passed > 0")
        .select(F.element_at(F.array(*[F.lit(t) for t in cuts]), F.col("_passed").cast("int"))
                .alias("threshold"), "tp", "fp", (F.col("_all") - F.col("tp")).alias("fn"), "n_null_score")
    )
    return _rates(rows).withColumn("meets_floors", _meets(floors or FLOORS))


def score_curve(df, label, score):
    """``threshold, tp, fp, fn`` and the rates of :func:`threshold_metrics` at every distinct score.
    Rows without a score take no part.

    Rows first reduce to one per distinct score. Those are written in ranges of the score; each
    range sums its own scores from the top, and the totals of the ranges above are added. There
    are as many totals as shuffle partitions, so they are broadcast.
    """
    per_score = (
        df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("threshold"))
        .agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n")))
    # Written once: ranges drawn anew for the second reading could differ.
    ranged = materialise(per_score.repartitionByRange("threshold").withColumn("_seg", F.spark_partition_id()), "scores")
    higher = Window.orderBy(F.desc("_seg")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_seg").agg(F.sum("_p").alias("_p"), F.sum("_n").alias("_n")).select(
        "_seg", F.coalesce(F.sum("_p").over(higher), F.lit(0)).alias("_tp"),
        F.coalesce(F.sum("_n").over(higher), F.lit(0)).alias("_fp"), F.sum("_p").over(Window.partitionBy()).alias("_all"))
    downward = Window.partitionBy("_seg").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    within = ranged.select("_seg", "threshold", F.sum("_p").over(downward).alias("_in_p"), F.sum("_n").over(downward).alias("_in_n"))
    tp = F.col("_tp") + F.col("_in_p")
    return _rates(within.join(F.broadcast(offsets), "_seg").select(
        "threshold", tp.alias("tp"), (F.col("_fp") + F.col("_in_n")).alias("fp"), (F.col("_all") - tp).alias("fn")))


def operating_points(df, label, score, floor_sets=None):
    """For each named set of floors the least distinct score that meets them all as a threshold:
    ``floors``, ``threshold``, its counts and rates, ``n_scores`` tried and ``n_meeting``. The
    threshold is null where no score meets the floors. All sets share one pass over the scores."""
    sets = floor_sets or {"planned": FLOORS}
    fields = ("threshold", "tp", "fp", "fn", "precision", "recall", "f1")
    least = [F.min(F.when(_meets(floors), F.struct(*fields))).alias(f"_least{i}") for i, floors in enumerate(sets.values())]
    meeting = [F.count_if(_meets(floors)).alias(f"_n{i}") for i, floors in enumerate(sets.values())]
    points = F.array(*[
        F.struct(F.lit(name).alias("floors"), *[F.col(f"_least{i}.{c}").alias(c) for c in fields],
                 F.col("_scores").alias("n_scores"), F.col(f"_n{i}").alias("n_meeting")) for i, name in enumerate(sets)])
    return score_curve(df, label, score).agg(F.count("*").alias("_scores"), *least, *meeting).select(F.inline(points))


def decision(score, amount, block_at, review_at, large_amount, large_review_at):
    """``block`` / ``review`` / ``pass`` by confidence; amounts from
    ``large_amount`` up go to review at a lower confidence."""
    s = F.col(score)
    return (F.when(s >= block_at, "block")
            .when(s >= review_at, "review")
            .when((F.col(amount) >= large_amount) & (s >= large_review_at), "review")
            .otherwise("pass"))
