"""Thin jobs: sources, operators and sinks strung together."""

from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from tallymill import schemas
from tallymill.functions import text
from tallymill.operators import clean, evaluate, extract, features, model, profile, reconcile, validate
from tallymill.session import job_folder, materialise
from tallymill.sources import files, runs
from tallymill.streaming import cleaning, run as streams, scoring
from tallymill.streaming.clicks import filter_clicks, rekey

_KEY, _LABEL = "tranaction_id", "tx_fraud"


def clean_job(spark, source, sink, run_ts, fmt="csv", dedup="between", audit=False):
    """Clean transaction files into one run folder; returns the rows kept, and
    with ``audit`` the rows lost to each rule (one more pass over the source)."""
    raw = (files.read_transactions_csv(spark, source) if fmt == "csv"
           else spark.read.parquet(source))
    folder = files.write_run(clean.clean_transactions(raw, dedup), sink, run_ts)
    counts = {"rows_kept": spark.read.parquet(folder).count()}
    if audit:
        report = clean.reject_report(raw, clean.transaction_rules(dedup))
        counts["rules"] = {r.rule: r.n_rows for r in report.collect()}   # one row per rule
    return counts


def review_job(df):
    """All review reports of a transactions table, by name."""
    return {
        **profile.review(df),
        "keys": profile.key_profile(df, _KEY),
        "gaps": profile.id_gaps(df, _KEY),
        "histograms": profile.value_histogram(df, list(profile.TRANSACTION_DOMAINS)),
        "lowest_highest": profile.extremes(df, "customer_id").unionByName(
            profile.extremes(df, "terminal_id")),
        "rejects": clean.reject_report(df, clean.transaction_rules()),
    }


def training_table(spark, glob, across_runs=True):
    """Cleaned runs as one weighted, split table. Runs over the same input repeat
    its ids, so one row per id is kept unless ``across_runs`` is off."""
    df = files.read_runs(spark, glob)
    if across_runs:
        df = materialise(clean.first_by_key(df, [_KEY], order_by=["run_path"], latest=True),
                         "training")
    return features.hash_split(
        features.with_class_weight(df.drop("run_path"), _LABEL), _KEY)


# Metric and tag names of the run log.
AUC_TEST, AUC_AVERAGE, AUC_FIRST = "aUROC_test", "aUROC_avg", "aUROC_first"
TRAIN_TAGS = {"optimizer_engine": "grid_search", "model_family": "logistic regression"}


def grid_metrics(search):
    """The average of every grid point, named by its parameters."""
    return {f"{AUC_AVERAGE}/regParam={reg}/elasticNetParam={net}": metric
            for reg, net, metric, _ in search.points()}


def train_job(spark, glob, model_path, log_path, run_id, run_ts):
    """Grid search on the train side, AUC on the test side, model and run log (with the
    whole grid) out."""
    with job_folder(spark, "train"):
        table = training_table(spark, glob)
        train, test = table.filter("split = 'train'"), table.filter("split = 'test'")
        search = model.cross_validate(materialise(train, "train"), _LABEL, _KEY)
        scored = model.score(search.best, test)
        auc = validate.weighted_auc(scored, _LABEL, "score", "weight").first()["auc"]
        search.best.write().overwrite().save(model_path)
    metrics = {AUC_TEST: auc, AUC_AVERAGE: max(search.averages), AUC_FIRST: search.averages[0]}
    runs.log_run(spark, log_path, run_id, run_ts, {**metrics, **grid_metrics(search)},
                 search.best_params(), TRAIN_TAGS)
    return metrics


@dataclass
class Comparison:
    baseline: object
    tuned: object
    params: dict
    scores: DataFrame
    decision: DataFrame

    def winner(self):
        return self.tuned if self.decision.first()["champion"] == "tuned" else self.baseline


def compare_models(train, test, label, key, weight="weight", require_improvement=False,
                   replicates=validate.REPLICATES, share=validate.SAMPLE_SHARE):
    """Out-of-the-box against tuned regression on resampled test AUCs.

    Both models' scores are written once to the shared folder; the resampling
    reads them in one job for both models.
    """
    columns = [key, label, weight, *features.FEATURES]
    train = materialise(train.select(*columns), "train")
    baseline = model.build_pipeline(label).fit(train)
    search = model.cross_validate(train, label, key, weight)
    tuned = search.best
    scored = model.score(tuned, model.score(baseline, test.select(*columns), "score_initial"),
                         "score_tuned")
    scored = materialise(scored.select(key, label, weight, "score_initial", "score_tuned"), "scored")
    scores = materialise(validate.auc_replicates(
        scored, key, label, {"initial": "score_initial", "tuned": "score_tuned"}, weight,
        replicates, share), "replicates")
    shapiro = validate.normality(scores).agg(
        *[F.max(F.when(F.col("model") == m, F.col(v))).alias(f"{s}_shapiro_{m}")
          for m in ("initial", "tuned") for v, s in (("statistic", "stat"), ("p_value", "p"))])
    test_row = validate.champion(validate.t_test(scores, "initial", "tuned"),
                                 "initial", "tuned", require_improvement)
    # Both sides are global aggregates, one row each.
    extra = [shapiro.select(c).scalar().alias(c) for c in shapiro.columns]
    return Comparison(baseline, tuned, search.best_params(), scores, test_row.select("*", *extra))


def validate_job(spark, glob, model_path, scores_path, log_path, run_id, run_ts,
                 require_improvement=False, coefficients_path=None):
    """A/B validation: score samples, both normality tests, t-test, champion.

    With ``coefficients_path`` the champion is also published there, under its time in seconds
    as the version, for streams that score with the model in use."""
    with job_folder(spark, "validate"):
        table = training_table(spark, glob)
        result = compare_models(table.filter("split = 'train'"), table.filter("split = 'test'"),
                                _LABEL, _KEY, require_improvement=require_improvement)
        files.write_scores(result.scores, scores_path, run_id)
        row = result.decision.first().asDict()
        chosen = result.tuned if row["champion"] == "tuned" else result.baseline
        chosen.write().overwrite().save(model_path)
        if coefficients_path:
            model.publish(spark, model.coefficients(chosen), coefficients_path, run_ts.timestamp())
    metrics = {k: row[k] for k in row if k.startswith(("p_", "stat_"))}
    runs.log_run(spark, log_path, run_id, run_ts, metrics, result.params,
                 {"champion": row["champion"], "result": row["result"]})
    return row


def collect_job(pages, rules, run_date, sink, fmt="parquet"):
    """Records of all page layouts, appended to the raw collection."""
    files.append_records(extract.extract_records(pages, rules, run_date), sink, fmt)


def corpus_job(spark, source, sink, header=False, disallowed=text.CORPUS_ALLOW):
    """Raw text records to the cleaned corpus (replaced as a whole)."""
    raw = files.read_corpus_csv(spark, source, header=header)
    cleaned = clean.clean_corpus(raw, lambda c: text.clean_corpus_text(c, disallowed))
    files.write_overwrite(cleaned, sink)


def pairs_job(spark, corpus_path, sink):
    """Cleaned corpus to train and validation pairs, one folder per side."""
    pairs = evaluate.train_pairs(spark.read.parquet(corpus_path).select("zodiac", "horo"))
    files.write_overwrite(pairs, sink, partition_by=["split"])


_SWEEP = ("model_name", "top_p", "temperature")


def sweep_log(report, run_id, run_ts):
    """Run log rows of a sweep report: one run per parameter set."""
    entry = lambda kind, name, value: F.struct(
        F.lit(kind).alias("kind"), F.lit(name).alias("name"), F.col(value).cast("string").alias("value"))
    entries = [entry("metric", c, c) for c in ("gramm_corr", "diversity", "positiv", "avg_gen_time")]
    entries += [entry("param", c, c) for c in _SWEEP[1:]] + [entry("tag", "model_family", "model_name")]
    name = F.concat(F.lit(f"{run_id}-top_p="), F.col("top_p").cast("string"),
                    F.lit("-temp="), F.col("temperature").cast("string"))
    return report.select(name.alias("run_id"), F.lit(run_ts).cast("timestamp").alias("ts"),
                         F.inline(F.array(*entries)))


def evaluate_job(spark, generations, log_path, run_id, run_ts=None, texts_path=None):
    """Sweep report of generated texts, one logged run per parameter set in one append;
    with ``texts_path`` also the texts with their own diversity."""
    report = materialise(evaluate.sweep_report(generations), "sweep")
    sweep_log(report, run_id, run_ts or datetime.now()).coalesce(1).write.mode("append").parquet(log_path)
    if texts_path:
        files.write_overwrite(evaluate.text_diversity(generations, by=_SWEEP).drop("embedding"), texts_path)
    return report


def reconcile_job(spark, source, target, sink, source_prefix=""):
    """Status of every key of two listing files; returns the count of each status."""
    files.write_overwrite(reconcile.compare(files.read_listing(spark, source), files.read_listing(spark, target),
                                            source_prefix), sink)
    return {r["status"]: r["count"] for r in spark.read.parquet(sink).groupBy("status").count().collect()}


def arrivals_job(spark, source, staging, checkpoint, sink, dedup="between"):
    """Clean the transaction files that arrived since the last run; ``sink`` then holds the
    cleaned rows of all files seen so far."""
    cleaning.clean_arrivals(streams.file_stream(spark, source, schemas.TRANSACTIONS, fmt="csv", comment="#"),
                            staging, checkpoint, dedup)
    files.write_overwrite(cleaning.read_cleaned(spark, staging, dedup), sink)


def score_job(spark, source, model_path, sink, checkpoint, threshold=None):
    """Scores of the transaction files that arrived since the last run, appended to ``sink``."""
    stream = streams.file_stream(spark, source, schemas.TRANSACTIONS, fmt="csv", comment="#").na.drop("any")
    scored = scoring.score_stream(PipelineModel.load(model_path), stream, threshold)
    streams.drain(scored.select(_KEY, "score"), sink, checkpoint)


def score_champion_job(spark, source, coefficients_path, sink, checkpoint, threshold=None):
    """As :func:`score_job`, with the champion published last when each micro-batch begins."""
    stream = streams.file_stream(spark, source, schemas.TRANSACTIONS, fmt="csv", comment="#").na.drop("any")
    scoring.score_with_latest(stream, coefficients_path, sink, checkpoint, threshold)


def click_job(messages, checkpoint, options, fmt="kafka", interval=streams.INTERVAL,
              available_now=False):
    """Start the click stream: filter by country, project, re-key, write on.

    Returns the running query; the caller waits on it (``awaitTermination``).
    """
    return streams.start(rekey(filter_clicks(messages)), checkpoint, fmt, options, interval,
                         available_now)
