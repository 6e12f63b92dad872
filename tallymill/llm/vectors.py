"""Vectors linked by cosine, found by counting collisions of one-dimensional projections.

Every projection is one sortable number: the signs of some random directions give
its whole part (a cell), another direction its fraction.  All vectors are sorted
along each projection, and around each one, as query, lies a window of its cell;
two vectors collide on a projection if one lies in the other's window.  A pair
with enough collisions over all projections is verified by its exact cosine.

The number of sign directions follows the number of vectors, so that windows hold
about as many vectors at every size.  The collision count to demand is calibrated:
partners at exactly the threshold are made for a bounded sample of the vectors,
and the count is the largest that all but a small share of those pairs reach.
Longer cells are shared by fewer partners, so projections are added until that
count is at least ``MIN_COUNT`` (about 80 projections for 1e8 vectors, 120 for 1e9);
a build that cannot reach it fails.

Work is dealt by projection and cell prefix; a prefix with too many vectors is
cut into blocks, and each pair of blocks is a task of its own.  A pair is verified
only in the first projection on which it collides, so tasks can return sums and
local groups instead of pairs.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tallymill.llm.common import components
from tallymill.session import materialise

THRESHOLD = 0.95
PROJECTIONS = 40
MAX_PROJECTIONS = 1024
MIN_COUNT = 3
CELL_ROWS = 48
TASK_ROWS = 2048
BLOCK_ROWS = 4096
WINDOW_SPREAD = 2.0
SAMPLE = 512
PARTNERS = 8
RECALL = 0.98
SEED = 11
_PAIRS = 200_000


@dataclass
class Index:
    """Random directions of all projections and the windows and count that go with them."""
    signs: np.ndarray       # (dimension, projections * bits)
    lines: np.ndarray       # (dimension, projections)
    bits: int
    width: float
    count: int = 1

    def place(self, unit):
        """(cells, positions) of unit vectors on every projection."""
        n, m = len(unit), self.lines.shape[1]
        if self.bits == 0:
            cells = np.zeros((n, m), np.int64)
        else:
            above = (unit @ self.signs > 0).reshape(n, m, self.bits)
            cells = above @ (1 << np.arange(self.bits, dtype=np.int64))
        return cells, unit @ self.lines


def collisions(index, cells_a, at_a, cells_b, at_b):
    """Which projections each pair of rows collides on."""
    return (cells_a == cells_b) & (np.abs(at_a - at_b) <= index.width)


def build(sample, n_vectors, threshold=THRESHOLD, projections=PROJECTIONS, cell_rows=CELL_ROWS, recall=RECALL, seed=SEED):
    """An index for about ``n_vectors`` unit vectors, calibrated on a sample of them: with at least
    ``projections``, and as many as it takes for the sample to reach ``recall`` by ``MIN_COUNT`` collisions."""
    while True:
        index, reached = _calibrated(sample, n_vectors, threshold, projections, cell_rows, recall, seed)
        if index.count >= MIN_COUNT:
            return index
        if projections >= MAX_PROJECTIONS:
            raise ValueError(f"recall {recall} is out of reach for {n_vectors} vectors: "
                             f"{projections} projections meet {reached:.3f} of the sample's pairs at the threshold at all")
        projections = min(projections + max(1, projections // 4), MAX_PROJECTIONS)


def _calibrated(sample, n_vectors, threshold, projections, cell_rows, recall, seed):
    """(index, share of the sample's pairs that collide at all); a count of zero tells that ``recall``
    is not reached."""
    rng = np.random.default_rng(seed)
    dimension = sample.shape[1]
    bits = max(0, int(np.ceil(np.log2(max(1, n_vectors) / cell_rows))))
    signs = rng.normal(size=(dimension, projections * bits))
    lines = rng.normal(size=(dimension, projections)) / np.sqrt(dimension)
    reach = np.sqrt(2 - 2 * threshold)
    index = Index(signs, lines, bits, WINDOW_SPREAD * reach / np.sqrt(dimension))
    base = np.repeat(sample, PARTNERS, axis=0)
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(axis=1, keepdims=True) * base
    size = np.linalg.norm(away, axis=1, keepdims=True)
    partner = threshold * base + np.sqrt(1 - threshold ** 2) * away / np.where(size > 0, size, 1)
    counts = collisions(index, *index.place(base), *index.place(partner)).sum(axis=1)
    if len(counts):
        index.count = int(np.quantile(counts, 1 - recall, method="lower"))
    return index, float((counts > 0).mean()) if len(counts) else 1.0


def _near_pairs(cells, at, width):
    """Pairs of rows (earlier, later in order) of one cell with positions at most ``width`` apart, in
    chunks; rows must be sorted by cell and position."""
    n = len(cells)
    edges = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
    ends = np.append(edges[1:], n)
    stop = np.empty(n, np.int64)
    for a, b in zip(edges, ends):
        stop[a:b] = a + np.searchsorted(at[a:b], at[a:b] + width, side="right")
    sizes = stop - np.arange(n) - 1
    total = np.concatenate([[0], np.cumsum(sizes)])
    start = 0
    while start < n:
        end = max(start + 1, int(np.searchsorted(total, total[start] + _PAIRS, side="right")) - 1)
        end = min(end, n)
        first = np.repeat(np.arange(start, end), sizes[start:end])
        offset = np.arange(len(first)) - np.repeat(total[start:end] - total[start], sizes[start:end])
        if len(first):
            yield first, first + 1 + offset
        start = end


def _local_roots(n, pairs):
    """Least row reachable over pairs, for each of n rows."""
    root = np.arange(n)
    if not pairs:
        return root
    a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _link_group(index, threshold, projection, cross, ids, copies, side, unit):
    """Verified links of one task: ``vec_id, links, root`` of the rows that have any.

    ``cross`` restricts pairs to one row of each side."""
    order = np.argsort(ids, kind="stable")
    ids, copies, side, unit = ids[order], copies[order], side[order], unit[order]
    cells, at = index.place(unit)
    order = np.lexsort((at[:, projection], cells[:, projection]))
    found, links = [], np.zeros(len(ids), np.int64)
    for first, second in _near_pairs(cells[order, projection], at[order, projection], index.width):
        a, b = order[first], order[second]
        if cross:
            keep = side[a] != side[b]
            a, b = a[keep], b[keep]
        hit = collisions(index, cells[a], at[a], cells[b], at[b])
        keep = (hit.sum(axis=1) >= index.count) & (hit.argmax(axis=1) == projection)
        a, b = a[keep], b[keep]
        keep = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
        a, b = a[keep], b[keep]
        if len(a):
            links += np.bincount(a, copies[b], len(ids)).astype(np.int64) + np.bincount(b, copies[a], len(ids)).astype(np.int64)
            found.append((a, b))
    root = _local_roots(len(ids), found)
    some = np.flatnonzero(links)
    return pd.DataFrame({"vec_id": ids[some], "links": links[some], "root": ids[root[some]]})


def _units(values):
    """Unit vectors in double precision; scaled first, so that no square over- or underflows."""
    x = np.array([np.asarray(v, np.float64) for v in values])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(embedding):
    """Whether a vector has a direction: no null or non-finite component, and one that is not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(embedding, finite) & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _prefixes(index, task_rows):
    """Column function: the cell prefix of a vector on every projection."""
    shift = min(index.bits, int(np.log2(max(1, task_rows // CELL_ROWS))))

    @F.pandas_udf("array<long>")
    def prefixes(values: pd.Series) -> pd.Series:
        cells, _ = index.place(_units(values))
        return pd.Series(list(cells >> shift))

    return prefixes


def link_distinct(vectors, index, threshold=THRESHOLD, task_rows=TASK_ROWS, block_rows=BLOCK_ROWS):
    """``vec_id, links, root`` per task for distinct usable vectors ``vec_id, vector, copies``."""
    dealt = vectors.select("vec_id", "vector", "copies", F.posexplode(
        _prefixes(index, task_rows)("vector")).alias("projection", "prefix"))
    keys = ["projection", "prefix"]
    sizes = dealt.groupBy(*keys).agg(F.count("*").alias("n"))
    crowded = materialise(sizes.where(F.col("n") > block_rows)
                          .select(*keys, F.ceil(F.col("n") / (block_rows // 2)).cast("int").alias("blocks")), "crowded")
    placed = (dealt.join(crowded, keys, "left")
              .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
              .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")))

    def link(key, group):
        projection, _, low, high = key
        return _link_group(index, threshold, int(projection), low != high, group["vec_id"].to_numpy(),
                           group["copies"].to_numpy(), group["block"].to_numpy(), _units(group["vector"]))

    return (placed.select(*keys, "low", "high", "block", "vec_id", "vector", "copies")
            .groupBy("projection", "prefix", "low", "high")
            .applyInPandas(link, "vec_id long, links long, root long"))


def fit(vectors, threshold=THRESHOLD, sample=SAMPLE):
    """An index for ``vec_id, vector`` rows; only the sample comes to the driver.  None without rows."""
    n = vectors.count()
    rows = vectors.select("vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    return build(_units([r["vector"] for r in rows]), n, threshold) if rows else None


def near_duplicates(embeddings, threshold=THRESHOLD):
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    ``n_links`` counts the other vectors with cosine at least ``threshold`` (in double
    precision); vectors that are null or empty, are zero, or hold a null or
    non-finite component link with nothing.  Vectors of other lengths than the
    commonest link among their own length.  Equal vectors are worked on once.
    Rows are told apart by ``vec_id``; a row with a null id links with nothing and
    has no component.  Rows that share an id and vector count as copies of each other.
    Other columns are not read.  An empty table gives no rows.
    """
    known = dict(embeddings.dtypes)["embedding"] in ("array<float>", "array<double>")
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        (F.col("embedding") if known else F.transform("embedding", lambda x: x.cast("double"))).alias("embedding"))
    able = rows.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    able = able.select("vec_id", F.col("embedding").alias("vector"))
    classes = materialise(able.groupBy("vector").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies")), "vectors")
    lengths = [r["d"] for r in classes.select(F.size("vector").alias("d")).distinct().collect()]
    parts = []
    for d in sorted(lengths):
        own = classes.where(F.size("vector") == d).select(F.col("first_id").alias("vec_id"), "vector", "copies")
        parts.append(link_distinct(own, fit(own, threshold), threshold))
    schema = "vec_id long, links long, root long"
    linked = rows.sparkSession.createDataFrame([], schema)
    for part in parts:
        linked = linked.unionByName(part)
    linked = materialise(linked, "vector-links")
    roots = components(linked.select(F.col("vec_id").alias("u"), F.col("root").alias("v")))
    sums = linked.groupBy("vec_id").agg(F.sum("links").alias("links"))
    labelled = (classes.select("vector", F.col("first_id").alias("node"), "copies")
                .join(sums.withColumnRenamed("vec_id", "node"), "node", "left").join(roots, "node", "left")
                .select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                        F.coalesce("root", "node").alias("component_id")))
    found = able.join(labelled, "vector").select("vec_id", "n_links", "component_id")
    rest = rows.where(~usable(F.col("embedding")) | F.col("vec_id").isNull()).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (found.unionByName(rest)
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
