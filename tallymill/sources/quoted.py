"""CSV with quoted line breaks, read in parallel.

A line break ends a record only where the quotes before it are even in number, which
depends on everything before it in the file.  It is found in two passes over byte
ranges.  The first counts the quotes of every range; summed over the earlier ranges of
the file they tell with which parity a range begins.  The second walks each range from
there: records inside it are complete, and what a range holds of the record that
began before it and of the one that goes on behind it are pieces, two per range at
most, which are joined afterwards.  Records themselves are parsed by ``from_csv``, in
the tasks that read them; only pieces are shuffled.
"""

import pandas as pd
from pyspark.sql import functions as F, Window

_RECORD = "file string, block bigint, at bigint, opens boolean, closes boolean, record string"


def _lines(spark, path):
    meta = F.col("_metadata")
    return spark.read.text(path).select(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), "value")


def range_parity(lines, quote='"'):
    """``file, block, inside``: whether a byte range begins inside quotes."""
    n_quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    counts = lines.groupBy("file", "block").agg(F.sum(n_quotes).alias("quotes"))
    # One row per range of a file.
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("file", "block", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1).alias("inside"))


def _cut(quote):
    def cut(batches):
        now, inside, held, at, opens = None, False, [], 0, True

        def row(closes):
            return (*now, at, opens, closes, "\n".join(held))

        for batch in batches:
            out = []
            for file, block, starts_inside, value in zip(batch["file"], batch["block"], batch["inside"], batch["value"]):
                if (file, block) != now:
                    if held:
                        out.append(row(False))
                    now, inside, held, at, opens = (file, block), bool(starts_inside), [], 0, not starts_inside
                held.append(value)
                inside ^= value.count(quote) % 2 == 1
                if not inside:
                    out.append(row(True))
                    held, at, opens = [], at + 1, True
            yield pd.DataFrame(out, columns=["file", "block", "at", "opens", "closes", "record"])
        if held:
            yield pd.DataFrame([row(False)], columns=["file", "block", "at", "opens", "closes", "record"])

    return cut


def quoted_records(spark, path, quote='"'):
    """``file, block, at, record``: the records of all files under a path as they stand there.

    ``block`` is the byte range in which a record begins and ``at`` its number there.  A quote that
    is never closed makes the rest of its file one record, as for any reader of such files.
    """
    lines = _lines(spark, path)
    # One row per 128 MB (or ``spark.sql.files.maxPartitionBytes``) of input, and only those ranges that
    # begin inside quotes: about 50 bytes each, 20 MB for 100 TB.  A broadcast keeps the lines' order.
    odd = range_parity(lines, quote).where("inside")
    cut = (lines.join(F.broadcast(odd), ["file", "block"], "left")
           .select("file", "block", "inside", "value").na.fill(False, ["inside"])
           .mapInPandas(_cut(quote), _RECORD))
    whole = cut.where("opens AND closes").select("file", "block", "at", "record")
    # A record's first piece opens it; the pieces of the following ranges belong to it.
    in_file = Window.partitionBy("file").orderBy("block", "at")
    pieces = cut.where("NOT (opens AND closes)").withColumn("number", F.sum(F.col("opens").cast("int")).over(in_file))
    piece = F.struct("block", "at", "record")
    joined = pieces.groupBy("file", "number").agg(F.sort_array(F.collect_list(piece)).alias("pieces")).select(
        "file", F.col("pieces")[0]["block"].alias("block"), F.col("pieces")[0]["at"].alias("at"),
        F.array_join(F.col("pieces.record"), "\n").alias("record"))
    return whole.unionByName(joined)


def read_quoted_csv(spark, path, schema, header=False, quote='"'):
    """Rows of CSV files whose quoted fields may hold line breaks, every file split into tasks.

    Quotes inside a field are doubled.  Rows that do not parse are null fields; empty lines between
    records are no rows.
    """
    records = quoted_records(spark, path, quote).where(F.trim("record") != "")
    if header:
        records = records.where("block > 0 OR at > 0")
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"quote": quote, "escape": quote, "multiLine": "true"}
    return records.select(F.from_csv("record", ddl, options).alias("r")).select("r.*")
