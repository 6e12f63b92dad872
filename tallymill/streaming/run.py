"""Starting and draining streaming queries."""

from tallymill.streaming.progress import log_progress, watched

# Fixed value: trigger interval of the continuous job.
INTERVAL = "10 seconds"


def start(df, checkpoint, fmt="parquet", options=None, interval=INTERVAL, available_now=False):
    """Start an append query and return its handle; the caller waits on it."""
    writer = (df.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint).options(**(options or {})))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=interval))
    return writer.start()


def late_rows(query):
    """Rows dropped behind the watermark, over the progress a query still remembers
    (``spark.sql.streaming.numRecentProgressUpdates`` micro-batches); the sums of a whole run
    are those of :mod:`tallymill.streaming.progress`."""
    return sum(operator["numRowsDroppedByWatermark"] for progress in query.recentProgress
               for operator in progress["stateOperators"])


def drain(df, path, checkpoint, timeout=None, late="allow", log=None):
    """Process everything now available into a parquet folder, then stop.

    ``late="fail"`` raises if any row of the whole run was dropped behind the watermark.
    ``log`` is a run log and a run's name: the sums of the run are appended there."""
    spark = df.sparkSession
    with watched(spark) as progress:
        query = start(df, checkpoint, options={"path": path}, available_now=True)
        if timeout and not query.awaitTermination(timeout):
            query.stop()
            raise TimeoutError(f"stream not drained within {timeout} s")
        if not timeout:
            query.awaitTermination()
        totals = progress.totals(query) if log or late == "fail" else None
    if log:
        log_progress(spark, *log, totals)
    if late == "fail" and totals["late_rows"]:
        raise ValueError(f"{totals['late_rows']} rows came too late for the watermark")
    return path


def drain_batches(df, handle, checkpoint):
    """Run ``handle(batch, batch_id)`` on all data now available, then stop."""
    query = (df.writeStream.option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(handle).start())
    query.awaitTermination()


def file_stream(spark, path, schema, fmt="parquet", max_files=None, glob=None, **options):
    """File source with the same shape as any other stream source."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)
