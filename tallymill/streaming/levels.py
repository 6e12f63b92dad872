"""A folder of rows by key that grows by micro-batches and is merged in levels.

Every batch adds a run: its rows, sorted by cell of keys in each file.  When ``fan`` runs
of one width stand at the end they are merged into one run of their whole width, so after n
batches a cell stands in O(log n) runs, and each row is rewritten O(log n) times.  A
batch is compared with those cells only that its own keys fall in; the minima and maxima in
the files spare it most pages of the others.  Files follow the number of rows, not of cells.

A run is there once its write has left its success marker, and then for good: a batch
that is replayed finds its own keys written, and a write that was cut off is not seen
and written anew.  A merged run replaces the runs inside its span from its marker on;
they are deleted by the next batch, so that a reader who has planned on them can finish.
"""

import re
from dataclasses import dataclass
from itertools import takewhile
from typing import Callable, Optional

from pyspark.sql import functions as F

FAN = 8
CELLS = 64
CELL = "_cell"
NAMED_CELLS = 10_000        # the cells of a batch of more are not named in the read but joined
_RUN = re.compile(r"run=(\d+)-(\d+)$")


@dataclass(frozen=True)
class Levels:
    """Where the rows of ``keys`` stand.

    ``cell`` is a column expression over the rows that copies of a key share: by default a
    hash of the key.  Where copies arrive near each other, a coarse form of the time or of
    the key itself lets a batch read far fewer cells.  ``reduce`` gives the rows of merged
    runs, if a key may stand in several.
    """
    path: str
    keys: tuple
    cell: Optional[object] = None
    fan: int = FAN
    reduce: Optional[Callable] = None

    def cells(self, rows):
        cell = self.cell if self.cell is not None else F.pmod(F.xxhash64(*self.keys), F.lit(CELLS))
        return rows.withColumn(CELL, F.concat(F.lit("c"), F.coalesce(cell.cast("string"), F.lit(""))))


@dataclass(frozen=True)
class Run:
    first: int
    last: int
    path: str

    @property
    def width(self):
        return self.last - self.first + 1


def _files(spark, path):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _committed(spark, path):
    fs, root = _files(spark, path)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        named = _RUN.search(status.getPath().getName())
        if named and fs.exists(status.getPath().suffix("/_SUCCESS")):
            found.append(Run(int(named[1]), int(named[2]), status.getPath().toString()))
    return found


def runs(spark, path):
    """The runs that count, in order: those inside no wider one."""
    every = _committed(spark, path)
    return sorted((r for r in every if not any(o != r and o.first <= r.first and r.last <= o.last for o in every)),
                  key=lambda r: r.first)


def read(spark, path, only=None):
    """Rows of the live runs, or of ``only``; none if nothing is written yet."""
    _, root = _files(spark, path)
    live = runs(spark, path) if only is None else only
    if not live:
        return None
    # A run without rows has a file with the columns.
    return spark.read.option("basePath", root.toString()).parquet(*[r.path for r in live]).drop("run")


def _write(rows, path):
    # Files of even size; a cell stands together in one, in more only where it is large.
    rows.hint("rebalance", CELL).sortWithinPartitions(CELL).write.mode("overwrite").parquet(path)


def _sweep(spark, path, live):
    fs, _ = _files(spark, path)
    for run in _committed(spark, path):
        if run not in live:
            fs.delete(_files(spark, run.path)[1], True)


def _merge(levels, spark):
    live = runs(spark, levels.path)
    while live:
        tail = [*takewhile(lambda r: r.width == live[-1].width, reversed(live))][::-1]
        if len(tail) < levels.fan:
            return
        _join(levels, spark, tail)
        live = runs(spark, levels.path)


def _join(levels, spark, some):
    """One run in place of consecutive ones."""
    rows = read(spark, levels.path, some)
    if levels.reduce:
        rows = levels.reduce(rows)
    _write(rows, f"{levels.path}/run={some[0].first}-{some[-1].last}")


def append(levels, rows, fresh_only=False):
    """Add a batch's rows as a run, then merge; returns what the batch read.

    With ``fresh_only`` rows whose key is already written are left out: ``rows_read`` counts the
    written rows of the cells that the batch's rows fall in, which these are compared with.
    Equal keys within the batch must be reduced before.
    """
    spark = rows.sparkSession
    live = runs(spark, levels.path)
    _sweep(spark, levels.path, live)
    rows = levels.cells(rows)
    n_read = 0
    written = read(spark, levels.path, live) if fresh_only else None
    if written is not None:
        touched = [r[0] for r in rows.select(CELL).distinct().limit(NAMED_CELLS + 1).collect()]
        if len(touched) > NAMED_CELLS:
            seen = written.join(rows.select(CELL).distinct(), CELL, "left_semi")
        else:
            seen = written.where(F.col(CELL).isin(touched))
        seen = seen.select(CELL, *levels.keys)
        n_read = seen.count()
        old = seen.select(*[F.col(c).alias(f"_seen_{c}") for c in seen.columns]).distinct()
        same = F.lit(True)
        for c in (CELL, *levels.keys):
            same = same & F.col(c).eqNullSafe(F.col(f"_seen_{c}"))
        rows = rows.join(old, same, "left_anti")
    at = live[-1].last + 1 if live else 0
    _write(rows, f"{levels.path}/run={at}-{at}")
    _merge(levels, spark)
    return {"runs": len(live), "rows_read": n_read}


def compact(levels, spark):
    """All live runs merged into one."""
    live = runs(spark, levels.path)
    if len(live) > 1:
        _join(levels, spark, live)
