"""Document quality by a linear-chain conditional random field over lines.

Every line of a text is good or bad.  Its score is linear in features of the line
and of its neighbours, and a 2 x 2 table scores each step from line to line.
Forward-backward marginals, weighted by line length, give the good share of a
text, which a one-dimensional logistic curve turns into a probability.

The field is fitted in numpy by gradient ascent of its likelihood.  Labels are
per document: lines begin with their document's label; between rounds the lines
of bad documents that the field finds good are relabelled, except the worst.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tallymill.llm.common import held_out, text_blocks

SAMPLE_PER_CLASS = 1200
MAX_SAMPLE_LINES = 120
SAMPLE_BLOCKS = 2400
THRESHOLD = 0.7
ROUNDS = 2
STEPS = 80
PRIOR_STEPS = 30
RIDGE = 1e-3

_SPACE, _UPPER, _LETTER, _DIGIT, _MARK, _STOP, _WIDE = range(7)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[ord("A"):ord("Z") + 1] = _UPPER
_CLASS[ord("a"):ord("z") + 1] = _LETTER
_CLASS[ord("0"):ord("9") + 1] = _DIGIT
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = _STOP
_CLASS[128:] = _WIDE

_OWN = 8
N_FEATURES = 3 * _OWN + 2


def _own_features(data, starts, lengths):
    """Features of each line of a byte array whose lines begin at ``starts``."""
    classes = _CLASS[data]
    counts = np.stack([np.add.reduceat((classes == c).astype(np.int32), starts) for c in range(7)], axis=1)
    space = classes == _SPACE
    heads = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    words = np.fromiter(map(hash, data.tobytes().split()), np.int64, len(heads))
    again = np.zeros(len(words), bool)
    again[1:] |= words[1:] == words[:-1]
    again[2:] |= words[2:] == words[:-2]
    line = np.searchsorted(starts, heads, side="right") - 1
    n_words = np.bincount(line, minlength=len(starts))
    repeated = np.bincount(line, weights=again, minlength=len(starts))
    size = np.maximum(lengths, 1)
    letters = np.maximum(counts[:, _UPPER] + counts[:, _LETTER] + counts[:, _WIDE], 1)
    some = np.maximum(n_words, 1)
    return np.stack([
        np.sqrt(counts[:, _UPPER] / letters), np.sqrt(counts[:, _MARK] / size), np.sqrt(counts[:, _DIGIT] / size),
        counts[:, _STOP] / size, np.sqrt(repeated / some), counts[:, _WIDE] / size,
        np.minimum(size / some, 40) / 10, np.log1p(lengths) / 5], axis=1)


def line_features(texts):
    """(features, lengths, first line of each text) for the lines of encoded texts.

    A text has at least one line; the neighbours of a text's first and last line
    are empty."""
    data = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    lengths = ends - starts
    text_starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])[:-1]])
    first = np.searchsorted(starts, text_starts)
    own = _own_features(data, starts, lengths)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    last = np.concatenate([first[1:] - 1, [len(starts) - 1]])
    before[first], after[last] = 0, 0
    edge = np.zeros((len(starts), 2))
    edge[first, 0] = edge[last, 1] = 1
    return np.concatenate([own, before, after, edge], axis=1), lengths, first


def _chains(first, n_lines):
    """Texts by falling number of lines, so that at step t the first ``active[t]`` go on."""
    sizes = np.diff(np.append(first, n_lines))
    order = np.argsort(-sizes, kind="stable")
    active = np.searchsorted(-sizes[order], -np.arange(1, sizes.max() + 1), side="right")
    return first[order], sizes[order], active


def forward_backward(scores, first, start, steps):
    """Marginals of the good state and the summed pair marginals.

    ``scores`` are a line's log odds of good; ``start`` and ``steps`` positive
    factors of the first state and of each step (from bad/good to bad/good)."""
    good = 0.5 * (1 + np.tanh(0.5 * np.clip(scores, -30, 30)))
    emit = np.stack([1 - good, good], axis=1) + 1e-12
    at, sizes, active = _chains(first, len(scores))
    forward, pairs = np.empty_like(emit), np.zeros((2, 2))
    forward[at] = emit[at] * start
    forward[at] /= forward[at].sum(axis=1, keepdims=True)
    for t in range(1, len(active)):
        here = at[:active[t]] + t
        step = (forward[here - 1] @ steps) * emit[here]
        forward[here] = step / step.sum(axis=1, keepdims=True)
    backward = np.ones_like(emit)
    for t in range(len(active) - 1, 0, -1):
        here = at[:active[t]] + t
        carried = emit[here] * backward[here]
        step = carried @ steps.T
        joint = forward[here - 1][:, :, None] * steps * carried[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        backward[here - 1] = step / step.sum(axis=1, keepdims=True)
    both = forward * backward
    return both[:, 1] / both.sum(axis=1), pairs


@dataclass
class Field:
    """Fitted weights; ``score`` maps texts to probabilities."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    start: np.ndarray
    steps: np.ndarray
    slope: float
    offset: float

    @property
    def fitted(self):
        return bool(np.any(self.weights))

    def marginals(self, texts):
        features, lengths, first = line_features(texts)
        scores = ((features - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]
        good, _ = forward_backward(scores, first, np.exp(self.start), np.exp(self.steps))
        return good, lengths, first

    def quality(self, texts):
        good, lengths, first = self.marginals(texts)
        share = good_share(good, lengths, first)
        return 1 / (1 + np.exp(-np.clip(self.slope * share + self.offset, -30, 30)))


def good_share(good, lengths, first):
    """Length-weighted mean of the good marginals of each text."""
    size = np.maximum(lengths, 1)
    return np.add.reduceat(good * size, first) / np.add.reduceat(size, first)


def _adam(start, gradient, steps, rate):
    at, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, steps + 1):
        g = gradient(at)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        at = at + rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return at


def constant(probability):
    """A field that gives every text one probability."""
    p = min(max(probability, 1e-6), 1 - 1e-6)
    return Field(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES + 1), np.zeros(2), np.zeros((2, 2)),
                 0.0, float(np.log(p / (1 - p))))


def _logistic(x, labels, weight):
    """Slope and offset of a weighted one-dimensional logistic regression, by Newton's method."""
    columns, p = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(PRIOR_STEPS):
        chance = 1 / (1 + np.exp(-np.clip(columns @ p, -30, 30)))
        gradient = columns.T @ (weight * (labels - chance)) - RIDGE * p
        curvature = (columns * (weight * chance * (1 - chance))[:, None]).T @ columns + RIDGE * np.eye(2)
        p = p + np.linalg.solve(curvature, gradient)
    return p


def fit(features, lengths, first, labels, good_rate=None):
    """Fit a field to the lines of texts with 0/1 labels; see the module text.  Without both
    labels the result is constant: 0.5 without any.  ``good_rate`` is the share of label 1
    outside the sample, to which the final curve is calibrated."""
    labels = np.asarray(labels, float)
    if len(labels) == 0 or labels.min() == labels.max():
        return constant(labels.mean() if len(labels) else 0.5)
    sizes = np.diff(np.append(first, len(features)))
    text_of = np.repeat(np.arange(len(first)), sizes)
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-6
    x = np.concatenate([(features - mean) / scale, np.ones((len(features), 1))], axis=1)
    share = np.bincount(labels.astype(int), minlength=2) / len(labels)
    weight = (0.5 / share)[labels.astype(int)]
    target = labels[text_of]
    n = x.shape[1]
    params = np.zeros(n + 6)
    follows = np.ones(len(x), bool)
    follows[first] = False
    follows = np.flatnonzero(follows)
    heads, by_class = first, [np.flatnonzero(labels == c) for c in (0, 1)]
    for _ in range(ROUNDS):
        wanted = np.zeros((2, 2))
        for i in (0, 1):
            for j in (0, 1):
                wanted[i, j] = (weight[text_of[follows]] * (target[follows - 1] == i) * (target[follows] == j)).sum()
        of_class = [np.concatenate([np.arange(first[d], first[d] + sizes[d]) for d in docs]) for docs in by_class]

        def gradient(p):
            scores = x @ p[:n]
            start, steps = np.exp(p[n:n + 2]), np.exp(p[n + 2:].reshape(2, 2))
            good, pairs = np.empty(len(x)), np.zeros((2, 2))
            for docs, lines, factor in zip(by_class, of_class, 0.5 / share):
                own_first = np.concatenate([[0], np.cumsum(sizes[docs])[:-1]])
                good[lines], own = forward_backward(scores[lines], own_first, start, steps)
                pairs += factor * own
            off = weight[text_of] * (target - good)
            begin = (weight * (target - good)[heads]).sum()
            g = np.concatenate([x.T @ off, [-begin, begin], (wanted - pairs).ravel()])
            return g / len(x) - RIDGE * p

        params = _adam(params, gradient, STEPS, 0.08)
        field = Field(mean, scale, params[:n], params[n:n + 2], params[n + 2:].reshape(2, 2), 1.0, 0.0)
        good, _ = forward_backward(x @ field.weights, first, np.exp(field.start), np.exp(field.steps))
        worst = np.minimum.reduceat(good, first)
        target = np.where(labels[text_of] == 1, 1.0, (good > 0.5) & (good > worst[text_of]))
    part = good_share(good, lengths, first)
    rates = share if good_rate is None else np.array([1 - good_rate, good_rate])
    slope, offset = _logistic(part, labels, (rates / share)[labels.astype(int)])
    field.slope, field.offset = float(slope), float(offset)
    return field


def _encoded(texts):
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]


def _sample(docs, labels, per_class, max_lines, max_blocks=None):
    """Features of at most ``per_class`` labelled texts of each class outside the held-out fold.

    A repeated id teaches once, by its text of least hash.  A text is cut into
    consecutive blocks of ``max_lines`` lines, in an order drawn from its length; the
    first block of every text is taken, then the second, up to ``max_blocks`` a class
    (None: one block of each text).  All lines of all texts teach unless that bound is
    met.  Only feature arrays of this bounded sample come to the driver."""
    known = (labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("label"))
             .where(F.col("doc_id").isNotNull() & ~held_out("doc_id")))
    order = F.xxhash64("doc_id")
    chosen = [known.where(F.col("label") == c).orderBy(order, "doc_id").limit(per_class) for c in (0, 1)]
    picked = F.broadcast(chosen[0].unionByName(chosen[1]))
    most = max_blocks or 1

    @F.pandas_udf("array<array<double>>")
    def features(texts: pd.Series) -> pd.Series:
        out = []
        for text in _encoded(texts):
            x, lengths, _ = line_features([text])
            rows = np.concatenate([lengths[:, None], x], axis=1)
            starts = np.arange(0, len(rows), max_lines)
            drawn = np.random.default_rng(len(text)).permutation(starts)[:most]
            out.append([rows[a:a + max_lines].ravel() for a in drawn])
        return pd.Series(out)

    blocks = (docs.select("doc_id", "text").join(picked, "doc_id")
              .groupBy("doc_id", "label").agg(F.min(F.struct(F.col("text").isNull().alias("no_text"), F.xxhash64("text").alias("hash"), "text"))
                                              .alias("least"))
              .select("doc_id", "label", F.posexplode(features("least.text")).alias("block", "f")))
    if max_blocks:
        taken = [blocks.where(F.col("label") == c).orderBy("block", order, "doc_id").limit(max_blocks) for c in (0, 1)]
        blocks = taken[0].unionByName(taken[1])
    rows = blocks.orderBy("doc_id", "block").collect()
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    texts = [(int(r["label"]), np.asarray(r["f"]).reshape(-1, N_FEATURES + 1)) for r in rows]
    return texts, counts.get(1, 0) / max(1, sum(counts.values()))


def train(docs, labels, per_class=SAMPLE_PER_CLASS, max_lines=MAX_SAMPLE_LINES, max_blocks=SAMPLE_BLOCKS):
    """A field fitted to a bounded sample of labelled rows; see ``_sample``."""
    rows, good_rate = _sample(docs, labels, per_class, max_lines, max_blocks)
    if not rows:
        return constant(0.5)
    lines = np.concatenate([f for _, f in rows])
    first = np.concatenate([[0], np.cumsum([len(f) for _, f in rows])[:-1]])
    return fit(lines[:, 1:], lines[:, 0], first, [label for label, _ in rows],
               good_rate)


def _score_column(field):
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        encoded = _encoded(texts)
        parts = [field.quality(encoded[a:b]) for a, b in text_blocks(encoded)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return score


def score_documents(docs, field, threshold=THRESHOLD):
    """``doc_id, held_out, score, predicted`` for every row, from the whole text alone.

    Null and empty texts are scored as one empty line.  Repeated rows repeat; a
    null id is not held out.  Other columns are not read.  An empty table gives
    no rows.
    """
    return (docs.select("doc_id", held_out("doc_id").alias("held_out"), _score_column(field)("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def label_lines(docs, field):
    """``doc_id, line, good``: the good marginal of every line of every text."""
    @F.pandas_udf("array<double>")
    def lines(texts: pd.Series) -> pd.Series:
        out, encoded = [], _encoded(texts)
        for a, b in text_blocks(encoded):
            good, _, first = field.marginals(encoded[a:b])
            out.extend(np.split(good, first[1:]))
        return pd.Series(out)

    return docs.select("doc_id", lines("text").alias("good")).select("doc_id", F.posexplode("good").alias("line", "good"))


def keep_good(docs, field, threshold=THRESHOLD):
    """The rows of ``docs`` whose score reaches the threshold, with their columns.

    A field that could not be fitted, for want of labels of both kinds, rejects nothing."""
    if not field.fitted:
        return docs
    columns = docs.columns
    scored = docs.select(*[F.col(f"`{c}`") for c in columns], _score_column(field)("text").alias("__tm_score"))
    return scored.where(F.col("__tm_score") >= threshold).select(*[F.col(f"`{c}`") for c in columns])
