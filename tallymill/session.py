"""Session helpers.

Executor counts, memory and parallelism belong to ``spark-submit``; nothing is
hard-coded here except the semantics every operator relies on (UTC, AQE).
"""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DIR_KEY = "spark.checkpoint.dir"
_JOBS = []          # folders of the running jobs, innermost last


def build_session(app_name, master=None, **conf):
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark):
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; a
    cluster session must name its own.
    """
    context = spark.sparkContext
    named = spark.conf.get(_DIR_KEY, None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {_DIR_KEY} to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallymill-"))
    return context.getCheckpointDir()


def scratch_path(spark, name):
    """A fresh path under the shared folder, or under the running job's folder there."""
    root = _JOBS[-1] if _JOBS else shared_dir(spark)
    return f"{root}/{name}-{uuid.uuid4().hex}"


@contextmanager
def job_folder(spark, name):
    """Intermediate tables written inside stand in one folder, which is deleted at the end;
    nothing that reads them may be used later."""
    folder = scratch_path(spark, f"job-{name}")
    _JOBS.append(folder)
    try:
        yield folder
    finally:
        _JOBS.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df, name):
    """Write a table under the shared folder and read it back: cuts a lineage that
    many later jobs would repeat, and survives the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
