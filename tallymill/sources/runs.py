"""Append-only log of run metrics, parameters and tags."""

from pyspark.sql import functions as F

from tallymill.schemas import RUN_METRICS


def run_rows(spark, run_id, ts, metrics=None, params=None, tags=None):
    rows = [(run_id, ts, kind, name, str(value))
            for kind, values in (("metric", metrics), ("param", params), ("tag", tags))
            for name, value in (values or {}).items()]
    return spark.createDataFrame(rows, RUN_METRICS)


def log_run(spark, path, run_id, ts, metrics=None, params=None, tags=None):
    """Append one run's entries (a few rows) to the log."""
    (run_rows(spark, run_id, ts, metrics, params, tags)
     .coalesce(1).write.mode("append").parquet(path))


def latest(log):
    """Most recent entry of every (kind, name); the run id breaks ties."""
    row = F.max(F.struct("ts", "run_id", "value")).alias("_r")
    return log.groupBy("kind", "name").agg(row).select(
        "kind", "name", "_r.run_id", "_r.ts", "_r.value")
