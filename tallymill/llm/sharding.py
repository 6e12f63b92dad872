"""Shards by a hierarchical weighted hash tree of regions, racks and shards.

A document descends from the root.  At each level every child of the node it stands on
draws an exponential waiting time from a hash of the document id, the level and the
child's number, with the summed weight of the child's subtree as the rate; the least
draw is the way down.  A changed weight alters the rates on its own path only, so
documents move into or out of the subtrees whose weight changed and nowhere else.
An added shard opens a region of its own: it alters no other rate and takes rows only
into itself.
"""

from collections import defaultdict

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymill.session import materialise

N_SHARDS = 40
RACKS_PER_REGION = 4
SHARDS_PER_RACK = 5
ROW_OVERHEAD = 16
_LEVELS = 3


def default_tree(n_shards, shards_per_rack=SHARDS_PER_RACK, racks_per_region=RACKS_PER_REGION, weights=None):
    """Rows (region, rack, shard, weight) for shards 0 to n - 1, filled rack by rack."""
    weights = weights or {}
    return [(s // (shards_per_rack * racks_per_region), s // shards_per_rack, s, float(weights.get(s, 1.0)))
            for s in range(n_shards)]


def grown_tree(tree, weight=1.0):
    """``tree`` with one more shard in a rack and a region of its own, each numbered next."""
    return [*tree, (*[max(row[level] for row in tree) + 1 for level in range(_LEVELS)], float(weight))]


def _draw(doc_id, level, node, weight):
    uniform = (F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(level), node), 11) + F.lit(0.5)) * F.lit(2.0 ** -53)
    return -F.log(uniform) / weight


def _draws(doc_id, level, children):
    return F.transform(children, lambda child: F.struct(
        _draw(doc_id, level, child["node"], child["weight"]).alias("draw"), child["at"].alias("at")))


def descend(doc_id, tree):
    """Shard number of a document id under a tree of (region, rack, shard, weight) rows; shards
    of weight zero get nothing.

    A row draws once for each child of the nodes on its way: 2 + 4 + 5 hashes among 40 shards.
    """
    weights = defaultdict(float)
    for row in tree:
        if row[-1] > 0:
            for level in range(_LEVELS):
                weights[row[:level + 1]] += row[-1]
    if not weights:
        raise ValueError("no shard has a weight above zero")
    parents, at = [()], F.lit(0)
    for level in range(_LEVELS):
        nodes = sorted(path for path in weights if len(path) == level + 1)
        families = defaultdict(list)
        for place, path in enumerate(nodes):
            families[path[:-1]].append(F.struct(F.lit(place).alias("at"), F.lit(path[-1]).alias("node"),
                                                F.lit(weights[path]).alias("weight")))
        children = F.get(F.array(*[F.array(*families[parent]) for parent in parents]), at)
        parents, at = nodes, F.array_min(_draws(doc_id, level, children))["at"]
    return F.get(F.array(*[F.lit(path[-1]) for path in parents]), at)


def with_shard(docs, tree, grown_tree=None):
    """Adds ``shard`` and, with a second tree, ``grown_shard``.  Columns of those names are
    replaced.  Every null id goes to one and the same shard."""
    doc_id = F.col("doc_id").cast("bigint")
    out = docs.withColumn("shard", descend(doc_id, tree))
    return out if grown_tree is None else out.withColumn("grown_shard", descend(doc_id, grown_tree))


def with_slot(sharded):
    """Adds ``slot``, gapless from 0 within each ``shard``.

    Rows are written with an id of their writing task; a row's slot is its rank in
    its task's share of the shard plus the sizes of the earlier tasks' shares, so no
    shard is ever ordered in one task.
    """
    stored = materialise(sharded.withColumn("__tm_seq", F.monotonically_increasing_id()), "sharded")
    stored = stored.withColumn("__tm_part", F.shiftright("__tm_seq", 33))
    sizes = stored.groupBy("shard", "__tm_part").agg(F.count("*").alias("__tm_n"))
    before = Window.partitionBy("shard").orderBy("__tm_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "__tm_part", F.coalesce(F.sum("__tm_n").over(before), F.lit(0)).alias("__tm_first"))
    inside = Window.partitionBy("shard", "__tm_part").orderBy("__tm_seq")
    ranked = stored.withColumn("__tm_rank", F.row_number().over(inside) - 1)
    return (ranked.join(offsets, ["shard", "__tm_part"])
            .withColumn("slot", F.col("__tm_first") + F.col("__tm_rank"))
            .drop("__tm_seq", "__tm_part", "__tm_first", "__tm_rank"))


def assign(docs, n_shards=N_SHARDS, weights=None):
    """All rows and columns of ``docs`` with ``law``, ``shard``, ``slot`` and ``grown_shard``
    (the shard among one more; that one takes rows only into itself).

    Input columns of those four names are replaced; names that begin with ``__tm_`` are
    reserved.  A repeated row keeps its own slot; repeated ids share a shard.  Null ids share
    one shard.  Equal draws go to the lower number.  Texts, of any length, are not read.  An
    empty table gives no rows.
    """
    tree = default_tree(n_shards, weights=weights)
    out = with_shard(docs, tree, grown_tree(tree, (weights or {}).get(n_shards, 1.0)))
    return with_slot(out.withColumn("law", F.lit("key")))


def size_and_crc(docs):
    """``doc_id, size, text_crc32``: UTF-8 bytes (null: none) plus the row overhead, and the
    unsigned CRC-32 of the UTF-8 bytes (null for a null text)."""
    text = F.col("text")
    return docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_OVERHEAD)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
