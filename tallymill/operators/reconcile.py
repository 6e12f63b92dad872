"""Object inventories and their reconciliation."""

from pyspark.sql import functions as F

from tallymill.session import materialise

# Fixed value: layout of one listing line (time, size, key); other lines, such
# as the trailing totals, do not match it.
LISTING_LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\s+(\d+)\s+(.+)$"


def parse_listing(lines, column="value"):
    """Listing lines -> ``(modified, size, key)``; anything else is skipped."""
    part = lambda i: F.regexp_extract(column, LISTING_LINE, i)
    return (lines.filter(F.col(column).rlike(LISTING_LINE))
            .select(part(1).cast("timestamp").alias("modified"),
                    part(2).cast("long").alias("size"), part(3).alias("key")))


def totals(listing):
    return listing.agg(F.count(F.lit(1)).alias("n_objects"),
                       F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("n_bytes"))


def strip_prefix(listing, prefix):
    key = F.when(F.startswith("key", F.lit(prefix)),
                 F.substring("key", len(prefix) + 1, 1 << 30)).otherwise(F.col("key"))
    return listing.withColumn("key", key)


def compare(source, target, source_prefix=""):
    """Status of every key: ``missing`` (source only), ``extra`` (target only),
    ``duplicate_key`` (one side lists it with several sizes), ``unknown_size`` (a size is
    null), ``size_mismatch`` or ``ok``.

    A full outer join in substance, written as one aggregate over both listings:
    one shuffle with map-side reduction instead of two sorted sides, and a key
    listed many times is reduced before it moves.
    """
    if source_prefix:
        source = strip_prefix(source, source_prefix)
    both = (source.select("key", "size", F.lit(True).alias("is_source"))
            .unionByName(target.select("key", "size", F.lit(False).alias("is_source"))))
    of = {"s": F.col("is_source"), "t": ~F.col("is_source")}
    listed = both.groupBy("key").agg(
        *[f(F.when(side, F.col("size"))).alias(f"{s}_{name}") for s, side in of.items()
          for name, f in (("min", F.min), ("max", F.max))],
        *[F.count_if(side).alias(f"{s}_n") for s, side in of.items()],
        F.count_if(F.col("size").isNull()).alias("n_unknown"))
    c = F.col
    status = (F.when(c("t_n") == 0, "missing").when(c("s_n") == 0, "extra")
              .when((c("s_min") != c("s_max")) | (c("t_min") != c("t_max")), "duplicate_key")
              .when(c("n_unknown") > 0, "unknown_size")
              .when(c("s_max") != c("t_max"), "size_mismatch").otherwise("ok"))
    return listed.select("key", c("s_max").alias("source_size"), c("t_max").alias("target_size"),
                         status.alias("status"))


def differences(source, target, source_prefix=""):
    return compare(source, target, source_prefix).filter(F.col("status") != "ok")


LEAF_DIGITS = 4         # 65,536 leaves; one more for each 16-fold growth of the listings


def _node(key, digits):
    return F.left(F.md5(F.col(key).cast("binary")), F.lit(digits))


def digests(listing, digits=LEAF_DIGITS):
    """What a listing holds below each leaf of a tree over the keys' hashes: its entries' number,
    bytes, unknown sizes, and two checksums of keys and sizes.

    One row per leaf, reduced in the map task. A table of it is all that a side needs to send
    or keep in order to be compared.
    """
    entry = F.xxhash64("key", "size")
    return (listing.groupBy(_node("key", digits).alias("node"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.count_if(F.col("size").isNull()).alias("unknown"),
                 F.bit_xor(entry).alias("mixed"), F.sum(F.pmod(entry, F.lit(2 ** 31))).alias("summed")))


def differing_leaves(source, target):
    """Leaves whose digests differ, found from the root down, and what each level compared.

    Returns the leaves and a list of (digits, nodes compared, nodes that differ). A level looks
    only below the nodes that differed on the one above it.
    """
    parts = ("n", "bytes", "unknown", "mixed", "summed")
    digits = max([0, *[r[0] or 0 for side in (source, target) for r in side.agg(F.max(F.length("node"))).collect()]])
    side = lambda df, name: df.select("node", F.lit(name).alias("is_source"), *parts)
    leaves = materialise(side(source, True).unionByName(side(target, False)), "leaf-digests")
    levels = []
    for level in range(1, digits + 1):
        sums = [F.bit_xor(F.when(own, F.col("mixed"))) if c == "mixed" else F.sum(F.when(own, F.col(c)))
                for own in (F.col("is_source"), ~F.col("is_source")) for c in parts]
        sides = [F.array(*sums[i:i + len(parts)]) for i in (0, len(parts))]
        nodes = (leaves.groupBy(F.left("node", F.lit(level)).alias("prefix")).agg(sides[0].alias("s"), sides[1].alias("t"))
                 .select("prefix", (~F.col("s").eqNullSafe(F.col("t"))).alias("differs")))
        nodes = materialise(nodes, "nodes")
        row = nodes.agg(F.count("*"), F.count_if("differs")).first()
        levels.append((level, row[0], row[1]))
        below = nodes.where("differs").select("prefix")
        leaves = leaves.join(below, F.left("node", F.lit(level)) == F.col("prefix"), "left_semi")
    return leaves.select("node").distinct(), levels


def compare_by_digest(source, target, source_prefix="", digits=LEAF_DIGITS):
    """Entries that differ, as :func:`differences` gives them, and the levels' numbers.

    Digests of both sides are compared; only entries below a differing leaf are shuffled
    and compared themselves.
    """
    if source_prefix:
        source = strip_prefix(source, source_prefix)
    leaves, levels = differing_leaves(digests(source, digits), digests(target, digits))
    leaves = materialise(leaves, "differing-leaves")
    below = lambda df: df.join(leaves, _node("key", digits) == leaves["node"], "left_semi")
    return differences(below(source), below(target)), levels


def missing_only(source, target, source_prefix=""):
    """Source entries without a target, as an anti join."""
    if source_prefix:
        source = strip_prefix(source, source_prefix)
    return source.join(target.select("key").distinct(), "key", "left_anti")
