"""Near-duplicate documents by SimHash, joined on a grid of segment bit counts.

A 64-bit fingerprint is cut into 32 segments of two bits and mapped to the
vector of their bit counts (0, 1 or 2).  The Manhattan distance of two such
vectors never exceeds the Hamming distance of the fingerprints.  The segments
are dealt to blocks so that two vectors within ``max_bits`` differ by at most
one in some block; each block's counts name a grid cell, a fingerprint stands
in its own cell of every block and probes that cell and the adjoining ones.
Pairs that meet are held to the Manhattan bound, then to the exact distance.

Counts are written in unary (0 = 00, 1 = 01, 2 = 11), so that a cell is a masked
long, a step to an adjoining cell is one flipped bit, and the Manhattan distance
is the number of differing bits of two codes.
"""

import itertools
import math
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from tallymill.llm.common import components
from tallymill.session import materialise

SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
_LOW = 0x5555555555555555
_CHUNK = 1 << 16
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def simhash(text, shingle_words=SHINGLE_WORDS):
    """Signed 64-bit fingerprint of one text; 0 for null or no word."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    ends = starts + lengths
    n = max(1, len(words) - shingle_words + 1)
    starts, ends = starts[:n].tolist(), ends[len(words) - n:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in
                           zip(starts[at:at + _CHUNK], ends[at:at + _CHUNK])], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprint(text, shingle_words=SHINGLE_WORDS):
    """Column form of ``simhash``."""
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle_words) for t in texts], dtype="int64")

    return of(text)


def _long(value):
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("bigint")


def unary_counts(x):
    """Bit counts of the 32 two-bit segments of a bigint column, in unary code."""
    shifted = F.shiftrightunsigned(x, 1)
    low = x.bitwiseOR(shifted).bitwiseAND(_long(_LOW))
    high = x.bitwiseAND(shifted).bitwiseAND(_long(_LOW))
    return low.bitwiseOR(F.shiftleft(high, 1))


def _cut(n):
    """The 32 segments in ``n`` blocks, each as a mask of unary codes."""
    edges = [64 * i // (2 * n) * 2 for i in range(n + 1)]
    return [list(range(a, b)) for a, b in zip(edges, edges[1:])]


def _mask(bits):
    return sum(1 << b for b in bits)


# Two random segments of two bits have the same count with this probability.
_SAME = 3 / 8
FEW_MEETINGS = 2.0
MAX_BLOCKS = 16


def meetings(n, n_blocks, max_bits=MAX_BITS):
    """How many others a random one of ``n`` fingerprints is expected to meet under a layout."""
    if not n_blocks:
        return n * sum((1 + len(b)) * _SAME ** (len(b) // 2) for b in _cut(max_bits // 2 + 1))
    sizes = [len(b) // 2 for b in _cut(n_blocks)]
    return n * sum(_SAME ** sum(kept) for kept in itertools.combinations(sizes, n_blocks - max_bits))


def cost(n, n_blocks, max_bits=MAX_BITS):
    """Cells written for a fingerprint, on both sides of the join, and the others that it meets there."""
    return 2 * math.comb(n_blocks, max_bits) + meetings(n, n_blocks, max_bits)


def layout(n, max_bits=MAX_BITS):
    """Number of blocks for ``n`` distinct fingerprints: 0 for the grid with adjoining cells, while few
    meet there, else the number of least cost, of which all but ``max_bits`` blocks must be equal.

    So the work for a fingerprint hardly grows with their number; every layout finds every link.
    """
    if meetings(n, 0, max_bits) <= FEW_MEETINGS:
        return 0
    return min(range(max_bits + 1, max(MAX_BLOCKS, max_bits + 1) + 1), key=lambda m: cost(n, m, max_bits))


def _by_grid(coded, max_bits):
    """Pairs of fingerprints that share a cell or stand in adjoining ones, in some block."""
    blocks = _cut(max_bits // 2 + 1)
    radius = max_bits // len(blocks)
    masks = [_mask(bits) for bits in blocks]
    home = coded.select(
        F.col("fp").alias("v"), F.col("code").alias("v_code"),
        F.explode(F.array(*[F.struct(F.lit(i).alias("block"), F.col("code").bitwiseAND(_long(m)).alias("cell"))
                            for i, m in enumerate(masks)])).alias("at"))
    steps = [(i, m, step) for i, (m, bits) in enumerate(zip(masks, blocks))
             for step in [0] + [1 << b for b in bits if radius]]
    probes = coded.select(
        F.col("fp").alias("u"), F.col("code").alias("u_code"),
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("block"),
                     F.col("code").bitwiseAND(_long(m)).bitwiseXOR(_long(step)).alias("cell"))
            for i, m, step in steps])).alias("at"))
    cell = F.col("at.cell")
    valid = (F.shiftrightunsigned(cell, 1).bitwiseAND(F.bitwise_not(cell)).bitwiseAND(_long(_LOW))) == 0
    probes = probes.where(valid).select("u", "u_code", "at.block", "at.cell")
    home = home.select("v", "v_code", "at.block", "at.cell")
    return (probes.alias("p").join(home.alias("h"), (F.col("p.block") == F.col("h.block"))
                                   & (F.col("p.cell") == F.col("h.cell")) & (F.col("u") < F.col("v"))))


def _by_blocks(coded, max_bits, n_blocks):
    """Pairs of fingerprints that agree on all but ``max_bits`` of the blocks, met once each: on
    the first blocks on which they agree."""
    masks = [_mask(bits) for bits in _cut(n_blocks)]
    kept = list(itertools.combinations(range(n_blocks), n_blocks - max_bits))
    cells = coded.select("fp", F.explode(F.array(*[
        F.struct(F.lit(sum(1 << b for b in blocks)).alias("blocks"),
                 F.col("code").bitwiseAND(_long(sum(masks[b] for b in blocks))).alias("cell")) for blocks in kept])).alias("at"))
    # Both sides of the join read one shuffle.
    cells = cells.select("at.blocks", "at.cell", "fp").repartition("blocks", "cell")
    other = cells.select("blocks", "cell", F.col("fp").alias("other"))
    met = (cells.join(other, ["blocks", "cell"]).where(F.col("fp") < F.col("other"))
           .select("blocks", F.col("fp").alias("u"), F.col("other").alias("v"),
                   unary_counts(F.col("fp")).alias("u_code"), unary_counts(F.col("other")).alias("v_code")))
    apart = F.col("u_code").bitwiseXOR(F.col("v_code"))
    equal = reduce(add, [F.when(apart.bitwiseAND(_long(m)) == 0, 1 << b).otherwise(0) for b, m in enumerate(masks)])
    # No equal block is left out below the highest one that the key has: the lowest is above it.
    left_out = equal.bitwiseAND(F.bitwise_not(F.col("blocks")))
    lowest = left_out.bitwiseAND(-left_out)
    return met.where((left_out == 0) | (lowest > F.col("blocks")))


def linked_fingerprints(fps, max_bits=MAX_BITS, n_blocks=None):
    """Pairs ``u < v`` of the distinct bigint column ``fp`` that differ in at most ``max_bits``
    bits.  A pair may come up more than once.  ``n_blocks`` is a :func:`layout`, by default that
    of the number of fingerprints."""
    if n_blocks is None:
        n_blocks = layout(fps.count(), max_bits)
    coded = fps.select("fp", unary_counts(F.col("fp")).alias("code"))
    met = _by_blocks(coded, max_bits, n_blocks) if n_blocks else _by_grid(coded, max_bits)
    return met.where((F.bit_count(F.col("u_code").bitwiseXOR(F.col("v_code"))) <= max_bits)
                     & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)).select("u", "v")


def group_fingerprints(hashed, max_bits=MAX_BITS):
    """``fp, component_id`` for each distinct fingerprint of ``doc_id, fp`` rows; the id is the
    least ``doc_id`` reachable over links, null only if every id in the group is."""
    fps = materialise(hashed.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fingerprints")
    roots = components(linked_fingerprints(fps, max_bits)).withColumnRenamed("node", "fp")
    grouped = fps.join(roots, "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = grouped.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return grouped.join(least, "root").select("fp", "component_id")


def near_duplicates(docs, shingle_words=SHINGLE_WORDS, max_bits=MAX_BITS):
    """One row per document: ``doc_id, fingerprint, component_id``.

    Only ``doc_id`` and ``text`` are read, so further columns of any name do no
    harm.  Null, empty and wordless texts have fingerprint zero and link like any
    other.  A repeated row gives a repeated result.  A null id keeps its row and
    is never a component id while the group has another.  An empty table gives
    no rows.  Copies meet once as a fingerprint, however many there are.
    """
    hashed = materialise(docs.select("doc_id", fingerprint("text", shingle_words).alias("fp")), "simhash")
    return (hashed.join(group_fingerprints(hashed, max_bits), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs, shingle_words=SHINGLE_WORDS, max_bits=MAX_BITS):
    """The input without near duplicates: of each group the row with the least
    ``doc_id`` stays, once; null ids come last, and rows that share an id are
    ordered by a hash of the row.  All columns are kept."""
    columns = docs.columns
    keyed = docs.select(
        *[F.col(f"`{c}`") for c in columns],
        F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(1)).alias("__tm_key_a"),
        F.xxhash64(F.col("text"), F.col("doc_id"), F.lit(2)).alias("__tm_key_b"))
    hashed = materialise(keyed.select("doc_id", "__tm_key_a", "__tm_key_b",
                                      fingerprint("text", shingle_words).alias("fp")), "simhash")
    fps = materialise(hashed.groupBy("fp").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "__tm_key_a", "__tm_key_b")).alias("first")),
        "fingerprints")
    roots = components(linked_fingerprints(fps, max_bits)).withColumnRenamed("node", "fp")
    first = (fps.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
             .agg(F.min("first").alias("first")).select("first.__tm_key_a", "first.__tm_key_b"))
    kept = keyed.join(first, ["__tm_key_a", "__tm_key_b"], "left_semi")
    return (kept.dropDuplicates(["__tm_key_a", "__tm_key_b"])
            .select(*[F.col(f"`{c}`") for c in columns]))
