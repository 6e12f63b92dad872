"""What a streaming query did over its whole run.

A query remembers the progress of its last micro-batches only.  A listener is told of
every one, so its sums miss none, however long the query runs.
"""

import threading
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql.streaming import StreamingQueryListener

from tallymill.sources import runs

_WAIT = 60          # seconds for the last events of an ended query to arrive


class Progress(StreamingQueryListener):
    """Sums per run of a query: micro-batches, those with input, input rows, rows dropped as too late."""

    def __init__(self):
        self._sums, self._ended, self._news = {}, set(), threading.Condition()

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        done = event.progress
        with self._news:
            sums = self._sums.setdefault(str(done.runId), dict.fromkeys(("batches", "fed_batches", "input_rows", "late_rows"), 0))
            sums["batches"] += 1
            sums["fed_batches"] += done.numInputRows > 0
            sums["input_rows"] += done.numInputRows
            sums["late_rows"] += sum(state.numRowsDroppedByWatermark for state in done.stateOperators)

    def onQueryTerminated(self, event):
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def totals(self, query):
        """Sums of a query; of an ended one when all of its events have come."""
        run = str(query.runId)
        with self._news:
            if not query.isActive and not self._news.wait_for(lambda: run in self._ended, _WAIT):
                raise TimeoutError("the query's last progress has not arrived")
            return dict(self._sums.get(run, dict.fromkeys(("batches", "fed_batches", "input_rows", "late_rows"), 0)))


@contextmanager
def watched(spark):
    """A listener on the session's queries for as long as the block runs."""
    listener = Progress()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def log_progress(spark, path, run_id, totals, ts=None, params=None):
    """Append a query's sums to the run log."""
    runs.log_run(spark, path, run_id, ts or datetime.now(), metrics=totals, params=params)
