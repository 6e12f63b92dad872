"""Repeated runs of lines, found by winnowing and removed where they come later.

A text is the sequence of hashes of its non-blank lines.  A window is a shortest
run of lines with at least ``min_words`` words, once from each line forwards and
once backwards; the least line hash of each window is selected as fingerprint.
Two texts that share a run of that many words share all its windows, and so the
selected fingerprints.

Only the selected positions are joined, by fingerprint.  A position that matches
none is done.  The others go back to their text's line hashes and are extended
both ways to the windows that selected them, which are matched by the hash of their
lines.  A window is later where an equal one begins at a lower document or
position; overlapping later windows make up the repeated run, which is deleted.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tallymill.session import materialise

MIN_WORDS = 50
_BLANK = " \t\r\x0b\x0c"


def _lines(text):
    """(positions, hashes, words) of the non-blank lines of a text's bytes."""
    kept, hashes, words = [], [], []
    for at, line in enumerate(text.split(b"\n")):
        n = len(line.split())
        if n:
            kept.append(at)
            hashes.append(xxhash.xxh64_intdigest(line.strip()))
            words.append(n)
    return np.array(kept, np.int32), np.array(hashes, np.uint64).view(np.int64), np.array(words, np.int32)


def line_windows(words, min_words):
    """(first, last) of the shortest runs with ``min_words`` words, from each line forwards and
    from each line backwards, without repeats."""
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    n = len(words)
    last = np.searchsorted(total, total[:-1] + min_words) - 1
    ahead = np.arange(n)[last < n] * n + last[last < n]
    first = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    back = first[first >= 0] * n + np.arange(n)[first >= 0]
    return np.stack(np.divmod(np.unique(np.concatenate([ahead, back])), max(n, 1)), axis=1)


def selected(hashes, windows):
    """The line of each window with the least hash, the first of equal ones."""
    order = np.argsort(hashes, kind="stable")
    rank = np.full(len(order) + 1, len(order))
    rank[order] = np.arange(len(order))
    bounds = (windows + [0, 1]).ravel()
    return order[np.minimum.reduceat(rank, bounds)[::2]] if len(windows) else np.zeros(0, np.int64)


def _with_lists(batch, rows, columns):
    """The keys of some rows of a batch beside one list per row and column."""
    arrays = [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("doc_id", "text_hash")]
    for lists, kind in columns.values():
        ends = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)]).astype(np.int32)
        arrays.append(pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, kind), *lists]).astype(kind)))
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_hash", *columns])


def hashed_lines(docs, min_words=MIN_WORDS):
    """``doc_id, text_hash, lines, hashes, words, selected`` of each text with enough words: number, hash
    and words of its non-blank lines, and which of these are the least of a window."""
    def cut(batches):
        for batch in batches:
            texts, rows, parts, held = batch.column("text"), [], [], 0
            for row in range(batch.num_rows + 1):
                if held > 8_000_000 or row == batch.num_rows:
                    lines, hashes, words, least = zip(*parts) if parts else ((), (), (), ())
                    yield _with_lists(batch, rows, {"lines": (lines, np.int32), "hashes": (hashes, np.int64),
                                                    "words": (words, np.int32), "selected": (least, np.int32)})
                    rows, parts, held = [], [], 0
                if row < batch.num_rows:
                    text = texts[row].as_py()
                    held += len(text)
                    lines, hashes, words = _lines(text)
                    if words.sum(dtype=np.int64) >= min_words:
                        least = np.unique(selected(hashes.view(np.uint64), line_windows(words, min_words)))
                        rows.append(row)
                        parts.append((lines, hashes, words, least))

    return (docs.where("text is not null")
            .select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
                    F.col("text").cast("binary").alias("text"))
            .mapInArrow(cut, "doc_id long, text_hash long, lines array<int>, hashes array<long>, words array<int>, "
                             "selected array<int>"))


def extended(matched, min_words=MIN_WORDS):
    """``doc_id, text_hash, window, first, last``: the windows that selected a matched line (``matched``, of
    all ``lines, hashes, words`` of its text), by the hash and the line numbers of all their lines."""
    def extend(batches):
        for batch in batches:
            rows, parts, held = [], [], 0
            for row in range(batch.num_rows + 1):
                if parts and (held > 500_000 or row == batch.num_rows):
                    again = pa.array(np.repeat(rows, [len(p[0]) for p in parts]))
                    found = [pa.array(np.concatenate(p)) for p in zip(*parts)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(again), batch.column("text_hash").take(again), *found],
                        names=["doc_id", "text_hash", "window", "first", "last"])
                    rows, parts, held = [], [], 0
                if row < batch.num_rows:
                    lines, hashes, words, at = (batch.column(c)[row].values.to_numpy()
                                                for c in ("lines", "hashes", "words", "matched"))
                    windows = line_windows(words, min_words)
                    windows = windows[np.isin(selected(hashes.view(np.uint64), windows), at)]
                    raw = hashes.tobytes()
                    digests = [xxhash.xxh64_intdigest(raw[8 * a:8 * b + 8], 1) for a, b in windows.tolist()]
                    rows.append(row)
                    parts.append((np.array(digests, np.uint64).view(np.int64), lines[windows[:, 0]], lines[windows[:, 1]]))
                    held += len(windows)

    return matched.mapInArrow(extend, "doc_id long, text_hash long, window long, first int, last int")


def repeated_runs(docs, min_words=MIN_WORDS):
    """``doc_id, text_hash, spans``: the (first, last) line numbers of the later windows of each text
    that has any; overlapping spans make up a run."""
    # The tables are written before they are joined: a join of two plain shuffles is one
    # that adaptive execution can split at a fingerprint or window that very many texts share.
    texts = materialise(hashed_lines(docs, min_words), "lines")
    at = F.explode("selected").alias("line")
    positions = (texts.select("doc_id", "text_hash", "hashes", at)
                 .select("doc_id", "text_hash", "line", F.col("hashes")[F.col("line")].alias("fingerprint")))
    point = F.struct("doc_id", "text_hash", "line")
    fingerprints = materialise(positions.groupBy("fingerprint").agg(F.min(point).alias("a"), F.max(point).alias("b"))
                               .where("a <> b").select("fingerprint"), "fingerprints")
    matched = materialise(positions.join(fingerprints, "fingerprint", "left_semi").groupBy("doc_id", "text_hash")
                          .agg(F.collect_set("line").alias("matched"))
                          .select(F.col("doc_id").alias("at_id"), F.col("text_hash").alias("at_hash"), "matched"), "matched")
    same = (F.col("text_hash") == F.col("at_hash")) & F.col("doc_id").eqNullSafe(F.col("at_id"))
    windows = materialise(extended(texts.join(matched, same).select(
        "doc_id", "text_hash", "lines", "hashes", "words", "matched"), min_words), "windows")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "first")
    first_places = materialise(windows.groupBy("window").agg(F.min(place).alias("a"), F.max(place).alias("b"))
                               .where("a <> b").select("window", "a"), "first-places")
    later = windows.join(first_places, "window").where(place != F.col("a"))
    spans = F.sort_array(F.collect_set(F.struct("first", "last")))
    return later.groupBy("doc_id", "text_hash").agg(spans.alias("spans"))


def _without(text, first, last):
    """Column of a text without the lines of its spans, and their number."""
    @F.pandas_udf("text string, n_removed int")
    def cut(texts: pd.Series, firsts: pd.Series, lasts: pd.Series) -> pd.DataFrame:
        kept_texts, removed = [], []
        for text, first, last in zip(texts, firsts, lasts):
            if text is None:
                kept_texts.append(None)
                removed.append(0)
                continue
            lines = text.split("\n")
            n = len(lines) + 1
            change = np.bincount(first, minlength=n) - np.bincount(np.asarray(last) + 1, minlength=n)
            inside = np.cumsum(change)[:-1] > 0
            full = np.flatnonzero([bool(line.strip(_BLANK)) for line in lines])
            if len(full) < len(lines):
                at = np.searchsorted(full, np.arange(len(lines)))
                before, after = inside[full[np.maximum(at - 1, 0)]], inside[full[np.minimum(at, len(full) - 1)]]
                between = before & after & (at > 0) & (at < len(full))
                between[full] = inside[full]
                inside = between
            kept_texts.append("\n".join([line for line, gone in zip(lines, inside.tolist()) if not gone]))
            removed.append(int(inside.sum()))
        return pd.DataFrame({"text": kept_texts, "n_removed": np.array(removed, np.int32)})

    return cut(text, first, last)


def remove_repeated(docs, min_words=MIN_WORDS):
    """``doc_id, text, n_lines, n_removed`` for every row: the text without repeated runs of lines.

    Deleted are the non-blank lines of every run of at least ``min_words`` words that
    also stands at a lower place (document id, then hash of the text, then line
    number; null ids come last).  Lines compare without white space at their ends.
    Each line keeps at least its first occurrence.  A blank line goes where the lines
    before and after it go.  A null text stays null, an empty one empty, with
    ``n_lines`` 0.  Rows that share id and text are one document and come out alike.
    Other columns are not read.  An empty table gives no rows.
    """
    runs = repeated_runs(docs, min_words).select(
        F.col("doc_id").alias("run_id"), F.col("text_hash").alias("run_hash"), "spans")
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    same = (F.col("text_hash") == F.col("run_hash")) & F.col("doc_id").cast("bigint").eqNullSafe(F.col("run_id"))
    n_lines = F.when(F.length("text") > 0, F.size(F.split("text", "\n"))).otherwise(0)
    marked = F.when(F.col("spans").isNotNull(), F.col("text"))
    cut = _without(marked, F.col("spans.first"), F.col("spans.last"))
    return (named.join(runs, same, "left").withColumn("cut", cut)
            .select("doc_id", F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.col("cut.text")).alias("text"),
                    n_lines.alias("n_lines"), F.col("cut.n_removed").alias("n_removed")))
