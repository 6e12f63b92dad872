"""Helpers shared by the training-data operators."""

from pyspark.sql import functions as F

from tallymill.session import materialise

HELD_OUT_FOLD = 2
N_FOLDS = 4


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id):
    """True where crc32 of the id's text falls in the fold kept for testing; a null id is
    never held out."""
    fold = F.crc32(F.col(doc_id).cast("string").cast("binary")) % N_FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


def text_blocks(texts, max_bytes=2_000_000):
    """Consecutive (first, last) slices of a list of byte strings, each of about
    ``max_bytes`` at most; a longer text is a block of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > max_bytes:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def _signature(edges):
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(edges):
    """Connected components of an undirected edge list.

    ``edges`` has two bigint columns ``u`` and ``v``; loops and repeats are fine.
    Returns ``node, root`` with the least reachable node as root, for every node
    that has an edge to another node.

    Alternating large-star and small-star steps: a hub's edges are joined with
    its one least neighbour, so no neighbourhood is ever gathered.  Each round is
    written to the shared folder; the driver sees two numbers per round.
    """
    stars = materialise(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(), "edges")
    seen = _signature(stars)
    while seen[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = materialise(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        stars = materialise(small, "small-star")
        now = _signature(stars)
        if now == seen:
            break
        seen = now
    roots = stars.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
