"""Queries over labels and scores: weights, splits, metrics, tests, models."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallymill.operators import clean, features, model, validate
from tallymill.plans.catalog import query
from tallymill.plans.views import CLEAN, PREDICTIONS, TX, one_by_one, predictions, table, transactions
from tallymill.streaming.run import drain, file_stream
from tallymill.streaming.scoring import score_stream, score_with_latest
from tallymill.session import materialise, scratch_path

_MODELS = {"initial": "score_a", "tuned": "score_b"}


@query("class_weights", f"""
with {TX},
c as (
  select 'tx_fraud' as label, tx_fraud::int as class, count(*)::bigint as n from tx group by all
  union all select 'quality', quality::int, count(*)::bigint from labels group by all)
select label, class, n, round(sum(n) over (partition by label)
  / (count(*) over (partition by label) * n::double), 6) as weight from c""")
def class_weights(spark, sf_dir):
    def weights(df, label):
        return features.class_weights(df, label).select(
            F.lit(label).alias("label"), F.col(label).cast("int").alias("class"), "n",
            F.round("weight", 6).alias("weight"))

    return weights(transactions(spark, sf_dir), "tx_fraud").unionByName(
        weights(table(spark, sf_dir, "labels"), "quality"))


@query("weighted_transactions", f"""
with {TX}, n as (select count(*) filter (tx_fraud = 1) as ones, count(*) filter (tx_fraud = 0) as zeros from tx)
select tranaction_id, tx_fraud, round(case when tx_fraud = 1 then (ones + zeros) / (2.0 * ones)
  else (ones + zeros) / (2.0 * zeros) end::double, 6) as weight from tx, n""")
def weighted_transactions(spark, sf_dir):
    return features.with_class_weight(transactions(spark, sf_dir), "tx_fraud").select(
        "tranaction_id", "tx_fraud", F.round("weight", 6).alias("weight"))


_SPLIT = "substr(md5(concat_ws('|', {}::varchar, '42')), 1, 8) < 'b3333333'"


@query("hash_split", f"""
with {CLEAN} select tranaction_id, tx_fraud,
  case when {_SPLIT.format('tranaction_id')} then 'train' else 'test' end as split from clean""")
def hash_split(spark, sf_dir):
    cleaned = clean.clean_transactions(transactions(spark, sf_dir))
    return features.hash_split(cleaned, "tranaction_id").select("tranaction_id", "tx_fraud", "split")


@query("standardise", f"""
with {CLEAN}, train as (select * from clean where {_SPLIT.format('tranaction_id')}),
m as (select {', '.join(f'avg({c}::double) as a{i}, stddev_samp({c}::double) as s{i}'
                        for i, c in enumerate(features.FEATURES))} from train)
select tranaction_id, {', '.join(f'round(({c}::double - a{i}) / s{i}, 6) as {c}_scaled'
                                 for i, c in enumerate(features.FEATURES))} from clean, m""")
def standardise(spark, sf_dir):
    cleaned = _cleaned(spark, sf_dir).select("tranaction_id", *features.FEATURES)
    train = features.hash_split(cleaned, "tranaction_id").filter("split = 'train'")
    return features.standardise(train, cleaned).select(
        "tranaction_id",
        *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in features.FEATURES])


def _auc_ctes(source, by=""):
    """AUC by sorted distinct scores, grouped by ``by`` (a trailing-comma list)."""
    part = f"partition by {by.rstrip(', ')}" if by else ""
    group = f"group by {by.rstrip(', ')}" if by else ""
    return f"""
per_score as (
  select {by} s, sum(case when y = 1 then w else 0 end)::double as p,
    sum(case when y = 0 then w else 0 end)::double as n, count(*) as k from {source} group by {by} s),
ranked as (
  select *, coalesce(sum(n) over ({part} order by s rows between unbounded preceding and 1 preceding), 0) as nb
  from per_score),
auc as (
  select {by} sum(k)::bigint as n_rows, sum(p) as w_pos, sum(n) as w_neg,
    case when sum(p) * sum(n) > 0 then sum(p * (nb + n / 2)) / (sum(p) * sum(n)) end as auc
  from ranked {group})"""


@query("weighted_auc", f"""
with {PREDICTIONS}, x as (select score_a as s, label as y, weight as w from predictions),
{_auc_ctes('x')} select n_rows, round(w_pos, 3) as w_pos, round(w_neg, 3) as w_neg, round(auc, 6) as auc from auc""")
def weighted_auc(spark, sf_dir):
    out = validate.weighted_auc(predictions(spark, sf_dir), "label", "score_a", "weight")
    return out.select("n_rows", F.round("w_pos", 3).alias("w_pos"),
                      F.round("w_neg", 3).alias("w_neg"), F.round("auc", 6).alias("auc"))


@query("weighted_auc_by_bucket", f"""
with {PREDICTIONS}, x as (select event_id % 4 as bucket, score_b as s, label as y, weight as w from predictions),
{_auc_ctes('x', 'bucket, ')} select bucket, n_rows, round(auc, 6) as auc from auc""")
def weighted_auc_by_bucket(spark, sf_dir):
    df = predictions(spark, sf_dir).withColumn("bucket", F.col("event_id") % 4)
    out = validate.weighted_auc(df, "label", "score_b", "weight", by=["bucket"])
    return out.select("bucket", "n_rows", F.round("auc", 6).alias("auc"))


_NULL_SCORES = PREDICTIONS + """,
gaps as (select *, case when event_id % 11 = 0 then null else score_a end as s from predictions)"""


def _with_null_scores(spark, sf_dir):
    return predictions(spark, sf_dir).withColumn(
        "score", F.when(F.col("event_id") % 11 != 0, F.col("score_a")))


@query("weighted_auc_null_scores", f"""
with {_NULL_SCORES}, x as (select event_id % 3 as bucket, s, label as y, weight as w from gaps where s is not null),
{_auc_ctes('x', 'bucket, ')}, missing as (
  select event_id % 3 as bucket, count(*) filter (s is null)::bigint as n_null_score from gaps group by 1)
select bucket, n_rows, n_null_score, round(auc, 6) as auc from auc join missing using (bucket)""")
def weighted_auc_null_scores(spark, sf_dir):
    df = _with_null_scores(spark, sf_dir).withColumn("bucket", F.col("event_id") % 3)
    out = validate.weighted_auc(df, "label", "score", "weight", by=["bucket"])
    return out.select("bucket", "n_rows", "n_null_score", F.round("auc", 6).alias("auc"))


# A row belongs to a replicate where its polynomial, seeded by one digest, is in
# the lowest 1 % of the field.
_REPLICATES = PREDICTIONS + f""",
models as (
  select event_id, label as y, weight as w, 'initial' as model, score_a as s from predictions
  union all select event_id, label, weight, 'tuned', score_b from predictions),
digests as (
  select *, md5(concat_ws('|', event_id::varchar, model)) as d from models),
seeds as (
  select model, y, w, s, ('0x' || substr(d, 1, 8))::bigint % 2147483647 as c0,
    ('0x' || substr(d, 9, 8))::bigint % 2147483647 as c1,
    ('0x' || substr(d, 17, 8))::bigint % 2147483647 as c2,
    ('0x' || substr(d, 25, 8))::bigint % 2147483647 as c3 from digests),
drawn as (
  select model, replicate, y, w, s
  from seeds, (select unnest(range(100))::int as replicate)
  where (c0 + c1 * replicate + c2 * replicate * replicate + c3 * replicate * replicate * replicate)
    % 2147483647 < 21474836),
{_auc_ctes('drawn', 'model, replicate, ')}"""


def _replicates(spark, sf_dir):
    return validate.auc_replicates(predictions(spark, sf_dir), "event_id", "label", _MODELS, "weight")


@query("auc_replicates", f"""
with {_REPLICATES} select model, replicate, n_rows, round(auc, 6) as auc from auc where auc is not null""")
def auc_replicates(spark, sf_dir):
    return _replicates(spark, sf_dir).withColumn("auc", F.round("auc", 6))


_TTEST = _REPLICATES + """,
m as (
  select count(auc) filter (model = 'initial') as n1, count(auc) filter (model = 'tuned') as n2,
    avg(auc) filter (model = 'initial') as m1, avg(auc) filter (model = 'tuned') as m2,
    var_samp(auc) filter (model = 'initial') as v1, var_samp(auc) filter (model = 'tuned') as v2 from auc),
t as (
  select *, n1 + n2 - 2 as dof,
    (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)) as t from m),
th as (select *, atan(abs(t) / sqrt(dof)) as th, dof / (dof + t * t) as c2 from t),
j as (
  select j, exp(sum(case when j = 0 then 0 else ln((2 * j - 1) / (2.0 * j)) end) over (order by j)) as even,
    exp(sum(case when j = 0 then 0 else ln(2 * j / (2.0 * j + 1)) end) over (order by j)) as odd
  from (select unnest(range(2000))::double as j)),
series as (
  select sum(case when j < dof / 2 then even * power(c2, j) else 0 end) as even,
    sum(case when j < (dof - 1) / 2 then odd * power(c2, j) else 0 end) as odd from j, th),
p as (
  select th.*, 1 - case when dof % 2 = 0 then sin(th) * series.even
    else 2 / pi() * (th + sin(th) * cos(th) * series.odd) end as p from th, series)"""


_MANY = 1500


@query("auc_many_replicates", f"""
with {_REPLICATES.split("drawn as (")[0]}
drawn as (
  select model, replicate, y, w, s
  from seeds, (select unnest(range({_MANY}))::hugeint as replicate) where model = 'initial' and
    (c0 + c1 * replicate + c2 * replicate * replicate + c3 * replicate * replicate * replicate)
    % 2147483647 < 4294967),
{_auc_ctes('drawn', 'replicate, ')}
select count(*)::bigint as n_samples, sum(n_rows)::bigint as n_rows, round(avg(auc), 6) as mean_auc,
  round(min(auc), 6) as min_auc, round(max(auc), 6) as max_auc from auc where auc is not null""")
def auc_many_replicates(spark, sf_dir):
    """More replicates than one polynomial of plain 64-bit products could serve."""
    out = validate.auc_replicates(predictions(spark, sf_dir), "event_id", "label",
                                  {"initial": "score_a"}, "weight", replicates=_MANY, share=0.002)
    return out.agg(F.count(F.lit(1)).alias("n_samples"), F.sum("n_rows").alias("n_rows"),
                   *[F.round(f("auc"), 6).alias(f"{n}_auc")
                     for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max))])


_GAPS, _GAP_SHARE = 10_000, 0.001


@query("auc_gap_replicates", f"""
with recursive {_REPLICATES.split("drawn as (")[0].strip()}
hops as (
  select model, y, w, s, c0, c1, c2, c3, 1::bigint as k,
    floor(ln((c0 + 0.5::double) / 2147483647) / ln(1 - {_GAP_SHARE}::double))::bigint as replicate from seeds
  union all
  select model, y, w, s, c0, c1, c2, c3, k + 1, replicate + 1 + floor(ln(
    ((((c3 * k + c2) % 2147483647 * k + c1) % 2147483647 * k + c0) % 2147483647 + 0.5::double) / 2147483647)
    / ln(1 - {_GAP_SHARE}::double))::bigint
  from hops where replicate < {_GAPS}),
drawn as (select model, replicate::int as replicate, y, w, s from hops where replicate < {_GAPS}),
{_auc_ctes('drawn', 'model, replicate, ')}
select model, replicate, n_rows, round(auc, 6) as auc from auc where auc is not null""")
def auc_gap_replicates(spark, sf_dir):
    """Ten thousand samples per model, with a row of work for each member."""
    return validate.auc_replicates(predictions(spark, sf_dir), "event_id", "label", _MODELS, "weight", replicates=_GAPS,
                                   share=_GAP_SHARE, by_gaps=True).withColumn("auc", F.round("auc", 6))


# The p-value in the check is the finite series of Student's t for whole degrees of freedom.
@query("score_ttest", f"""
with {_TTEST} select n1::bigint as n_first, n2::bigint as n_second, round(m1, 6) as mean_first,
  round(m2, 6) as mean_second, dof::bigint as dof, round(t, 5) as t, round(p, 6) as p_value,
  case when p < 0.01 then 'dist_DIFFERENT' else 'dist_IDENTICAL' end as result from p""")
def score_ttest(spark, sf_dir):
    out = validate.t_test(_replicates(spark, sf_dir), "initial", "tuned")
    return out.select("n_first", "n_second", F.round("mean_first", 6).alias("mean_first"),
                      F.round("mean_second", 6).alias("mean_second"), "dof",
                      F.round("t", 5).alias("t"), F.round("p_value", 6).alias("p_value"), "result")


@query("champion", f"""
with {_TTEST} select case when p < 0.01 then 'dist_DIFFERENT' else 'dist_IDENTICAL' end as result,
  case when p < 0.01 then 'tuned' else 'initial' end as champion from p""")
def champion(spark, sf_dir):
    test = validate.t_test(_replicates(spark, sf_dir), "initial", "tuned")
    return validate.champion(test, "initial", "tuned").select("result", "champion")


def _horner(x, *coefficients):
    """Polynomial in SQL, highest power first."""
    out = str(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out} * {x} + {c})"
    return out


# Acklam's rational approximation of the normal quantile, and a
# Chebyshev fit of the complementary error function.
_TAIL = (_horner("q", -7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
                 -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
         + " / " + _horner("q", 7.784695709041462e-03, 3.224671290700398e-01,
                           2.445134137142996e+00, 3.754408661907416e+00, 1.0))
_MIDDLE = (_horner("r", -3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
                   1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
           + " * (u - 0.5) / " + _horner("r", -5.447609879822406e+01, 1.615858368580409e+02,
                                         -1.556989798598866e+02, 6.680131188771972e+01,
                                         -1.328068155288572e+01, 1.0))
_ERFC = _horner("k", 0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806,
                0.09678418, 0.37409196, 1.00002368, -1.26551223)


@query("normality", f"""
with {_REPLICATES},
x as (
  select model, auc as v, row_number() over (partition by model order by auc) as i,
    count(*) over (partition by model) as n, auc - avg(auc) over (partition by model) as dev
  from auc where auc is not null),
u as (select *, (i - 0.375) / (n + 0.25)::double as u from x),
q as (select *, sqrt(-2 * ln(least(u, 1 - u))) as q, (u - 0.5) * (u - 0.5) as r from u),
m as (
  select model, v, i, n, dev, case when u < 0.02425 then {_TAIL}
    when u > 0.97575 then -({_TAIL}) else {_MIDDLE} end as m from q),
s as (
  select model, n, sum(m * m) as mm, max(case when i = n then m end) as last,
    max(case when i = n - 1 then m end) as prev, sum(dev * dev) as spread, 1 / sqrt(n) as w
  from m group by model, n),
e as (
  select *, last / sqrt(mm) + {_horner('w', -2.706056, 4.434685, -2.071190, -0.147981, 0.221157, 0.0)} as a1,
    prev / sqrt(mm) + {_horner('w', -3.582633, 5.682633, -1.752461, -0.293762, 0.042981, 0.0)} as a2 from s),
f as (select *, (mm - 2 * last * last - 2 * prev * prev) / (1 - 2 * a1 * a1 - 2 * a2 * a2) as phi from e),
g as (
  select model, any_value(f.n) as n, power(sum(v * case when i = f.n then a1 when i = f.n - 1 then a2
      when i = 1 then -a1 when i = 2 then -a2 else m / sqrt(phi) end), 2) / any_value(spread) as stat
  from m join f using (model) group by model),
z as (
  select *, (ln(1 - stat) - {_horner('ln(n)', 0.0038915, -0.083751, -0.31082, -1.5861)})
    / exp({_horner('ln(n)', 0.0030302, -0.082676, -0.4803)}) / sqrt(2) as z from g),
k as (select *, 1 / (1 + 0.5 * abs(z)) as k from z)
select model, n::bigint as n, round(stat, 5) as statistic,
  round(case when z >= 0 then k * exp(-z * z + {_ERFC}) / 2
    else 1 - k * exp(-z * z + {_ERFC}) / 2 end, 4) as p_value from k""")
def normality(spark, sf_dir):
    return validate.normality(_replicates(spark, sf_dir)).select(
        "model", "n", F.round("statistic", 5).alias("statistic"),
        F.round("p_value", 4).alias("p_value"))


@query("jarque_bera", f"""
with {_REPLICATES}, c as (
  select model, auc - avg(auc) over (partition by model) as d from auc where auc is not null),
k as (select model, count(*)::bigint as n, avg(d * d) as m2, avg(d * d * d) as m3, avg(d * d * d * d) as m4
  from c group by model)
select model, n, round(n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4), 4) as statistic
from k""")
def jarque_bera(spark, sf_dir):
    return validate.jarque_bera(_replicates(spark, sf_dir)).select(
        "model", "n", F.round("statistic", 4).alias("statistic"))


_THRESHOLDS = [5.0 * i for i in range(1, 41)]


@query("threshold_metrics", f"""
with {PREDICTIONS}, t as (select unnest({_THRESHOLDS})::double as threshold),
c as (
  select threshold, count(*) filter (label = 1 and score_a >= threshold)::bigint as tp,
    count(*) filter (label = 0 and score_a >= threshold)::bigint as fp,
    count(*) filter (label = 1 and score_a < threshold)::bigint as fn
  from predictions, t group by threshold)
select threshold, tp, fp, fn, round(case when tp + fp > 0 then tp / (tp + fp)::double end, 6) as precision,
  round(case when tp + fn > 0 then tp / (tp + fn)::double end, 6) as recall,
  round(case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn)::double end, 6) as f1,
  coalesce(tp >= 0.98 * (tp + fp) and tp >= 0.95 * (tp + fn)
    and 2 * tp >= 0.96 * (2 * tp + fp + fn) and tp + fp > 0, false) as meets_floors from c""")
def threshold_metrics(spark, sf_dir):
    out = validate.threshold_metrics(predictions(spark, sf_dir), "label", "score_a", _THRESHOLDS)
    return out.select("threshold", "tp", "fp", "fn", "meets_floors",
                      *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query("threshold_metrics_null_scores", f"""
with {_NULL_SCORES}, t as (select unnest({_THRESHOLDS})::double as threshold)
select threshold, count(*) filter (label = 1 and s >= threshold)::bigint as tp,
  count(*) filter (label = 0 and s >= threshold)::bigint as fp,
  count(*) filter (label = 1 and s < threshold)::bigint as fn,
  count(*) filter (s is null)::bigint as n_null_score from gaps, t group by threshold""")
def threshold_metrics_null_scores(spark, sf_dir):
    out = validate.threshold_metrics(_with_null_scores(spark, sf_dir), "label", "score", _THRESHOLDS)
    return out.select("threshold", "tp", "fp", "fn", "n_null_score")


# Floors that no score, some scores and most scores meet.
_FLOOR_SETS = {"planned": (0.98, 0.95, 0.96), "balanced": (0.6, 0.6, 0.7), "recall": (0.5, 0.9, 0.6), "low": (0.1, 0.05, 0.1)}
# Scores that lean towards the label, with many ties at the top.
_LEANING = "least(value + label * 4 * (event_id % 97), 300)"


@query("operating_points", f"""
with {PREDICTIONS},
s as (select {_LEANING.replace("value", "score_a")} as s, label from predictions where event_id % 50 <> 3),
per as (select s, count(*) filter (label = 1) as p, count(*) filter (label = 0) as n from s where s is not null group by s),
c as (select s, sum(p) over (order by s desc) as tp, sum(n) over (order by s desc) as fp, sum(p) over () as all_p from per),
f as (select * from (values {", ".join(f"('{k}', {a}, {b}, {c})" for k, (a, b, c) in _FLOOR_SETS.items())}) f(floors, fp_, fr, ff)),
m as (select floors, s, tp, fp, all_p - tp as fn,
    tp + fp > 0 and all_p > 0 and tp / (tp + fp)::double >= fp_ and tp / all_p::double >= fr and 2 * tp / (tp + fp + all_p)::double >= ff as ok
  from c, f),
best as (select floors, count(*)::bigint as n_scores, (count(*) filter (ok))::bigint as n_meeting, min(s) filter (ok) as threshold
  from m group by floors)
select b.floors, b.threshold, m.tp::bigint as tp, m.fp::bigint as fp, m.fn::bigint as fn,
  round(tp / (tp + fp)::double, 6) as precision, round(tp / (tp + fn)::double, 6) as recall,
  round(2 * tp / (2 * tp + fp + fn)::double, 6) as f1, n_scores, n_meeting
from best b left join m on m.floors = b.floors and m.s = b.threshold""")
def operating_points(spark, sf_dir):
    """The least of all scores that meets each set of floors; every 50th row has no score."""
    scored = predictions(spark, sf_dir).select("label", F.expr(
        f"if(event_id % 50 <> 3, {_LEANING.replace('value', 'score_a')}, null)").alias("s"))
    sets = {name: dict(zip(("precision", "recall", "f1"), floors)) for name, floors in _FLOOR_SETS.items()}
    return validate.operating_points(scored, "label", "s", sets).select(
        "floors", "threshold", "tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
        "n_scores", "n_meeting")


@query("decision_bands", f"""
with {PREDICTIONS} select label, case when score_a >= 150 then 'block' when score_a >= 100 then 'review'
  when score_b >= 60 and score_a >= 40 then 'review' else 'pass' end as decision, count(*)::bigint as n
from predictions group by all""")
def decision_bands(spark, sf_dir):
    band = validate.decision("score_a", "score_b", block_at=150, review_at=100,
                             large_amount=60, large_review_at=40)
    return (predictions(spark, sf_dir).groupBy("label", band.alias("decision"))
            .agg(F.count(F.lit(1)).alias("n")))


def _cleaned(spark, sf_dir):
    """Cleaned transactions as a written table: training reads them many times."""
    return materialise(clean.clean_transactions(transactions(spark, sf_dir)), "cleaned")


def _train_test(spark, sf_dir):
    cleaned = _cleaned(spark, sf_dir)
    weighted = features.with_class_weight(cleaned, "tx_fraud")
    split = features.hash_split(weighted, "tranaction_id")
    return split.filter("split = 'train'"), split.filter("split = 'test'")


_TRAIN_TEST = f"""{CLEAN}, sides as (
  select *, {_SPLIT.format('tranaction_id')} as is_train from clean)"""


@query("lr_grid")
def lr_grid(spark, sf_dir):
    """Every grid point of the regression search with its average AUC."""
    train, _ = _train_test(spark, sf_dir)
    return model.cross_validate(materialise(train, "train"), "tx_fraud", "tranaction_id").report(spark)


@query("lr_grid_checks", f"""
with {_TRAIN_TEST}, folds as (
  select ('0x' || substr(md5(concat_ws('|', tranaction_id::varchar, 'folds')), 1, 8))::bigint % 2 as fold
  from sides where is_train),
points as (select * from (values (0.1::double), (0.001)) r(reg_param), (values (0.6::double), (0.8)) e(elastic_net))
select reg_param, elastic_net, (select count(*) from folds where fold = 0)::bigint as n_first_fold,
  (select count(*) from folds where fold = 1)::bigint as n_second_fold, true as auc_agrees, 1::bigint as n_best from points""")
def lr_grid_checks(spark, sf_dir):
    """Grid points, fold sizes, one best point, and each fold's metric against the exact weighted AUC."""
    train = materialise(_train_test(spark, sf_dir)[0], "train")
    pairs = []

    def judge(scored):
        theirs = model.evaluator("tx_fraud").evaluate(scored)
        own = validate.weighted_auc(scored.withColumn("s", vector_to_array("rawPrediction")[1]),
                                    "tx_fraud", "s", "weight").first()["auc"]
        pairs.append(abs(theirs - own))
        return theirs

    search = model.cross_validate(train, "tx_fraud", "tranaction_id", judge=judge)
    sizes = model.with_fold(train, "tranaction_id").agg(
        *[F.count_if(F.col("_fold") == i).alias(n) for i, n in enumerate(("n_first_fold", "n_second_fold"))]).first()
    report = search.report(spark)
    n_best = report.agg(F.count_if("is_best")).scalar()
    return report.select("reg_param", "elastic_net", F.lit(sizes[0]).alias("n_first_fold"), F.lit(sizes[1]).alias("n_second_fold"),
                         F.lit(len(pairs) == 8 and max(pairs) < 0.005).alias("auc_agrees"), n_best.alias("n_best"))


# Two features: one optimum, which twelve Newton steps reach from zero.
_PAIR = ("tx_amount", "terminal_id")
_CURVE = "1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2)))"
_NEWTON = f"""{_TRAIN_TEST},
m as (select avg({_PAIR[0]}::double) as m1, stddev_samp({_PAIR[0]}::double) as s1, avg({_PAIR[1]}::double) as m2,
  stddev_samp({_PAIR[1]}::double) as s2 from sides where is_train),
scaled as (select tranaction_id, is_train, tx_fraud as y, ({_PAIR[0]}::double - m1) / s1 as x1, ({_PAIR[1]}::double - m2) / s2 as x2
  from sides, m),
steps as (
  select 0 as k, 0.0::double as b0, 0.0::double as b1, 0.0::double as b2
  union all
  select k + 1,
    b0 + (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det,
    b1 + (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det,
    b2 + (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / det
  from (select *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) as det
    from (select k, any_value(b0) as b0, any_value(b1) as b1, any_value(b2) as b2,
        sum(y - p) as g0, sum((y - p) * x1) as g1, sum((y - p) * x2) as g2,
        sum(w) as h00, sum(w * x1) as h01, sum(w * x2) as h02, sum(w * x1 * x1) as h11, sum(w * x1 * x2) as h12,
        sum(w * x2 * x2) as h22
      from (select *, p * (1 - p) as w from (select *, {_CURVE} as p from steps, scaled where is_train and k < 12))
      group by k))),
best as (select b0, b1, b2 from steps where k = 12)"""


def _converged(train):
    return model.build_pipeline("tx_fraud", _PAIR, max_iter=200, tol=1e-14).fit(train)


@query("lr_optimum", f"""
with recursive {_NEWTON} select round(b0, 4) as intercept, round(b1, 4) as amount, round(b2, 4) as terminal from best""")
def lr_optimum(spark, sf_dir):
    """Coefficients of an unpenalised fit run to convergence."""
    fitted = _converged(_train_test(spark, sf_dir)[0]).stages[-1]
    row = (float(fitted.intercept), *map(float, fitted.coefficients))
    return spark.createDataFrame([row], "intercept double, amount double, terminal double").select(
        *[F.round(c, 4).alias(c) for c in ("intercept", "amount", "terminal")])


@query("lr_optimum_auc", f"""
with recursive {_NEWTON}, scored as (select y, 1.0::double as w, {_CURVE} as s from scaled, best where not is_train),
{_auc_ctes("scored")} select n_rows, round(auc, 5) as auc from auc""")
def lr_optimum_auc(spark, sf_dir):
    """Test AUC of the converged fit; weights by class leave it as it is."""
    train, test = _train_test(spark, sf_dir)
    scored = model.score(_converged(train), test)
    return validate.weighted_auc(scored, "tx_fraud", "score", "weight").select("n_rows", F.round("auc", 5).alias("auc"))


# Ridge penalties of the grid whose metrics SQL computes: one optimum per fold and penalty.
_RIDGES = (1.0, 0.1, 0.001)
_RIDGE_GRID = f"""{_TRAIN_TEST},
folded as (select tx_fraud as y, {_PAIR[0]}::double as a, {_PAIR[1]}::double as b,
  ('0x' || substr(md5(concat_ws('|', tranaction_id::varchar, 'folds')), 1, 8))::bigint % 2 as fold from sides where is_train),
moments as (select 1 - fold as fold, avg(a) as m1, stddev_samp(a) as s1, avg(b) as m2, stddev_samp(b) as s2 from folded group by fold),
ridge_rows as (select m.fold, f.fold <> m.fold as learn, y, (a - m1) / s1 as x1, (b - m2) / s2 as x2 from folded f, moments m),
steps as (
  select 0 as k, fold, reg, 0.0::double as b0, 0.0::double as b1, 0.0::double as b2
  from moments, (select unnest({list(_RIDGES)})::double as reg)
  union all
  select k + 1, fold, reg,
    b0 + (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det,
    b1 + (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det,
    b2 + (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / det
  from (select *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) as det
    from (select k, fold, reg, any_value(b0) as b0, any_value(b1) as b1, any_value(b2) as b2, sum(y - p) as g0,
        sum((y - p) * x1) - count(*) * reg * any_value(b1) as g1, sum((y - p) * x2) - count(*) * reg * any_value(b2) as g2,
        sum(w) as h00, sum(w * x1) as h01, sum(w * x2) as h02, sum(w * x1 * x1) + count(*) * reg as h11,
        sum(w * x1 * x2) as h12, sum(w * x2 * x2) + count(*) * reg as h22
      from (select *, p * (1 - p) as w from (
        select k, s.fold, reg, b0, b1, b2, y, x1, x2, {_CURVE} as p
        from steps s join ridge_rows r on r.fold = s.fold and r.learn where k < 12))
      group by k, fold, reg))),
judged as (select s.fold, reg, y, 1.0::double as w, b0 + b1 * x1 + b2 * x2 as s
  from steps s join ridge_rows r on r.fold = s.fold and not r.learn where k = 12),
{_auc_ctes("judged", "fold, reg, ")},
averages as (select reg as reg_param, avg(auc) as avg_auc from auc group by reg)"""


@query("lr_ridge_grid", f"""
with recursive {_RIDGE_GRID} select reg_param, 0.0::double as elastic_net, round(avg_auc, 5) as avg_auc,
  avg_auc = (select max(avg_auc) from averages) as is_best from averages""")
def lr_ridge_grid(spark, sf_dir):
    """Average AUC over the folds of every ridge penalty, run to convergence, and the best one."""
    train = materialise(_train_test(spark, sf_dir)[0], "train")

    def judge(scored):
        return validate.weighted_auc(scored.withColumn("s", vector_to_array("rawPrediction")[1]),
                                     "tx_fraud", "s", "weight").first()["auc"]

    search = model.cross_validate(train, "tx_fraud", "tranaction_id", columns=_PAIR, judge=judge, reg_params=_RIDGES,
                                  elastic_nets=(0.0,), max_iter=200, tol=1e-14)
    return search.report(spark).select("reg_param", "elastic_net", F.round("avg_auc", 5).alias("avg_auc"), "is_best")


@query("lr_optimum_scores", f"""
with recursive {_NEWTON}, scored as (select y, {_CURVE} as p from scaled, best where not is_train)
select floor(p * 50)::int as band, y::int as tx_fraud, count(*)::bigint as n from scored group by all""")
def lr_optimum_scores(spark, sf_dir):
    """Test rows by band of the converged fit's score."""
    train, test = _train_test(spark, sf_dir)
    scored = model.score(_converged(train), test)
    return scored.groupBy(F.floor(F.col("score") * 50).cast("int").alias("band"), F.col("tx_fraud").cast("int").alias("tx_fraud")).agg(
        F.count(F.lit(1)).alias("n"))


@query("lr_test_scores", f"""
with {_TRAIN_TEST}, n as (select count(*) filter (tx_fraud = 1) as ones, count(*) filter (tx_fraud = 0) as zeros from clean)
select tranaction_id, tx_fraud, round(case when tx_fraud = 1 then (ones + zeros) / (2.0 * ones)
  else (ones + zeros) / (2.0 * zeros) end::double, 6) as weight, true as in_range from sides, n where not is_train""")
def lr_test_scores(spark, sf_dir):
    """Test side under a regression of all features fitted on the train side; the values of
    scores are checked by ``lr_optimum_scores``."""
    train, test = _train_test(spark, sf_dir)
    fitted = model.build_pipeline("tx_fraud").fit(train)
    return model.score(fitted, test).select("tranaction_id", "tx_fraud", F.round("weight", 6).alias("weight"),
                                            ((F.col("score") > 0) & (F.col("score") < 1)).alias("in_range"))


@query("lr_champion", f"""
with {_TRAIN_TEST}, models as (
  select tx_fraud as y, model, md5(concat_ws('|', tranaction_id::varchar, model)) as d
  from sides, (select unnest(['initial', 'tuned']) as model) where not is_train),
seeds as (
  select model, y, ('0x' || substr(d, 1, 8))::bigint % 2147483647 as c0, ('0x' || substr(d, 9, 8))::bigint % 2147483647 as c1,
    ('0x' || substr(d, 17, 8))::bigint % 2147483647 as c2, ('0x' || substr(d, 25, 8))::bigint % 2147483647 as c3 from models),
drawn as (
  select model, replicate, count(*) filter (y = 1) as ones, count(*) filter (y = 0) as zeros
  from seeds, (select unnest(range(100))::int as replicate)
  where (c0 + c1 * replicate + c2 * replicate * replicate + c3 * replicate * replicate * replicate) % 2147483647 < 21474836
  group by all)
select count(*) filter (model = 'initial')::bigint as n_first, count(*) filter (model = 'tuned')::bigint as n_second,
  (count(*) - 2)::bigint as dof, true as consistent from drawn where ones > 0 and zeros > 0""")
def lr_champion(spark, sf_dir):
    """Baseline against tuned model on resampled test AUCs: sizes of the samples, and whether the
    test, the champion and both normality tests fit together."""
    from tallymill.plans.jobs import compare_models

    train, test = _train_test(spark, sf_dir)
    decision = compare_models(train, test, "tx_fraud", "tranaction_id").decision
    differs = F.col("p_value") < validate.ALPHA
    consistent = ((F.col("result") == F.when(differs, validate.DIFFERENT).otherwise(validate.IDENTICAL))
                  & (F.col("champion") == F.when(differs, "tuned").otherwise("initial"))
                  & F.col("p_value").between(0, 1) & F.col("mean_first").between(0, 1) & F.col("mean_second").between(0, 1))
    for m in ("initial", "tuned"):
        consistent &= F.col(f"stat_shapiro_{m}").between(0, 1) & F.col(f"p_shapiro_{m}").between(0, 1)
    return decision.select("n_first", "n_second", "dof", consistent.alias("consistent"))


@query("score_stream", f"with {_TRAIN_TEST} select tranaction_id, true as agrees from sides where not is_train")
def score_transactions_stream(spark, sf_dir):
    """The fitted regression over a stream of transaction files, against its batch scores."""
    train, test = _train_test(spark, sf_dir)
    fitted = model.build_pipeline("tx_fraud").fit(train)
    staged = scratch_path(spark, "to-score")
    test.repartition(3).write.parquet(staged)
    stream = file_stream(spark, staged, test.schema, max_files=1)
    scored = score_stream(fitted, stream).select("tranaction_id", "score")
    out = drain(scored, scratch_path(spark, "scored"), scratch_path(spark, "checkpoint"))
    batch = model.score(fitted, spark.read.parquet(staged)).select("tranaction_id", F.col("score").alias("batch"))
    return spark.read.parquet(out).join(batch, "tranaction_id", "left").select(
        "tranaction_id", F.coalesce(F.abs(F.col("score") - F.col("batch")) < 1e-12, F.lit(False)).alias("agrees"))


_SCORED_BATCHES, _LAST_BEFORE_SWAP = 5, 1


@query("champion_swap_stream", f"""
with recursive {_NEWTON}, scored as (
  select tranaction_id % {_SCORED_BATCHES} as batch, y,
    case when tranaction_id % {_SCORED_BATCHES} <= {_LAST_BEFORE_SWAP} then 1 / (1 + exp(-x1)) else {_CURVE} end as p
  from scaled, best where not is_train)
select batch::bigint as batch, case when batch <= {_LAST_BEFORE_SWAP} then 1 else 2 end::bigint as version, floor(p * 50)::int as band,
  y::int as tx_fraud, count(*)::bigint as n from scored group by all""")
def champion_swap_stream(spark, sf_dir):
    """Scores of a stream of five micro-batches; after the second one a new champion is published,
    and the running query takes it up with the third."""
    train, test = _train_test(spark, sf_dir)
    coefficients = scratch_path(spark, "coefficients")
    amount = F.col(_PAIR[0]).cast("double")
    moments = train.agg(F.avg(amount).alias("mean"), F.stddev_samp(amount).alias("std")).first()
    model.publish(spark, {None: -moments["mean"] / moments["std"], _PAIR[0]: 1 / moments["std"]}, coefficients, 1)
    champion = model.coefficients(_converged(train), _PAIR)

    def swap(batch):
        if batch == _LAST_BEFORE_SWAP:
            model.publish(spark, champion, coefficients, 2)

    batch = F.col("tranaction_id") % _SCORED_BATCHES
    stream = one_by_one(spark, test.select("tranaction_id", "tx_fraud", *_PAIR, batch.alias("batch")), "to-score")
    sink = scratch_path(spark, "scored")
    score_with_latest(stream, coefficients, sink, scratch_path(spark, "checkpoint"), after=swap)
    return spark.read.parquet(sink).groupBy(
        F.col("_batch").cast("long").alias("batch"), F.col("model_version").alias("version"),
        F.floor(F.col("score") * 50).cast("int").alias("band"), F.col("tx_fraud").cast("int").alias("tx_fraud")).agg(
        F.count("*").alias("n"))
