"""File sources and sinks."""

from pyspark.sql import functions as F

from tallymill import schemas


def read_transactions_csv(spark, path, schema=schemas.TRANSACTIONS, corrupt_column=None):
    """Headerless typed CSV; ``#`` lines are comments. A field that does not parse
    is null (the cleaning rules drop and count such rows); with
    ``corrupt_column`` the raw line of such a row is kept."""
    reader = spark.read.option("comment", "#").option("mode", "PERMISSIVE")
    if corrupt_column:
        schema = type(schema)(list(schema.fields)).add(corrupt_column, "string")
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


def read_corpus_csv(spark, path, schema=schemas.CORPUS, header=False, multi_line=True):
    """Text records with quoted line breaks.

    A multi-line file cannot be split, so one file is one task: keep raw files
    small, or collect with :func:`append_records` (parquet) instead.
    ``multi_line=False`` breaks quoted records at line ends.
    """
    return (spark.read.schema(schema).option("header", header)
            .option("multiLine", multi_line).option("escape", '"').csv(path))


def read_runs(spark, glob, run_column="run_path"):
    """All run outputs under a glob, each row with the file it came from."""
    return spark.read.parquet(glob).withColumn(run_column, F.col("_metadata.file_path"))


def write_new(df, path):
    df.write.mode("errorifexists").parquet(path)


def write_run(df, path, run_ts):
    """Write one run under ``run_ts=<yyyyMMddHHmmss>`` (colons are unsafe in paths)
    and return its folder. A run is written once: an existing folder is an error."""
    folder = f"{path.rstrip('/')}/run_ts={run_ts:%Y%m%d%H%M%S}"
    write_new(df, folder)
    return folder


def write_overwrite(df, path, partition_by=(), dynamic=False):
    """Replace a dataset, or with ``dynamic`` only the partitions written."""
    writer = df.write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_records(df, path, fmt="parquet"):
    """Append raw records, one folder per collection date."""
    if fmt == "csv":
        (df.write.mode("append").option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(path))
    else:
        (df.withColumn("day", F.to_date("date"))
         .write.mode("append").partitionBy("day").parquet(path))


def write_scores(scores, path, run_id, fmt="parquet"):
    """Score samples as ``(run, model, replicate, auc)``; CSV with every field quoted."""
    table = scores.select(F.lit(run_id).alias("run"), "model", "replicate", "auc")
    if fmt == "csv":
        table.write.mode("append").option("quoteAll", True).csv(path, header=True)
    else:
        table.write.mode("append").parquet(path)


def file_inventory(spark, path, pattern=None):
    """``(modified, size, key)`` of the files under a path; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        F.col("modificationTime").alias("modified"), F.col("length").alias("size"),
        F.col("path").alias("key"))


def read_listing(spark, path):
    from tallymill.operators.reconcile import parse_listing

    return parse_listing(spark.read.text(path))
