"""Language of a text from a bidirectional gated recurrent network over its bytes.

A text is cut into consecutive windows of bytes; in each, one recurrent network
reads forwards and one backwards, and their states label every position with
language probabilities.  The probabilities of all letter positions of all
windows are averaged.  Trained in numpy by backpropagation through time on a
bounded sample of windows.
"""

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tallymill.llm.common import held_out, text_blocks

SAMPLE_PER_LANGUAGE = 600
MAX_LANGUAGES = 2000
WINDOWS_PER_TEXT = 2
TRAIN_WINDOW = 48
WINDOW = 128
LANES = 1024
HIDDEN = 4
STEPS = 400
# A network of more languages than this gets more units and steps.
FEW_LANGUAGES = 16
BATCH = 256
RATE = 0.02
SEED = 7
UNKNOWN = "und"

# Bytes as the network sees them: letters in lower case, everything else a space; zero pads.
_SEEN = np.full(256, 32, np.uint8)
_SEEN[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_SEEN[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_SEEN[128:] = np.arange(128, 256)
_LETTER = re.compile(r"[^\W\d_]")


def windows(texts, size):
    """(bytes, text number) of the windows of encoded texts, padded with zeros."""
    counts = np.array([-(-len(t) // size) for t in texts])
    padded = b"".join(t + b"\0" * (-len(t) % size) for t in texts)
    raw = np.frombuffer(padded, np.uint8)
    seen = np.where(raw == 0, np.uint8(0), _SEEN[raw])
    return seen.reshape(-1, size), np.repeat(np.arange(len(texts)), counts)


@dataclass
class Network:
    """Weights of both directions, stacked: input table (2, 256, 3H), recurrent (2, H, 3H) and output
    (2H, L) with its bias.  Gate order: update, reset, candidate."""
    languages: list
    table: np.ndarray
    recurrent: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def states(self, seen):
        """States at every position, (T, 2H, n): H forward, H backward."""
        n, size = seen.shape
        hidden = self.recurrent.shape[1]
        half = np.ones(3 * hidden, np.float32)
        half[:2 * hidden] = 0.5  # the logistic function as a hyperbolic tangent
        table = np.ascontiguousarray((self.table * half).transpose(0, 2, 1))
        recurrent = np.ascontiguousarray((self.recurrent * half).transpose(0, 2, 1))
        out = np.empty((size, 2 * hidden, n), np.float32)
        h = np.zeros((2, hidden, n), np.float32)
        fed, carried = (np.empty((2, 3 * hidden, n), np.float32) for _ in range(2))
        gates, candidate = fed[:, :2 * hidden], np.empty((2, hidden, n), np.float32)
        forward, backward = np.ascontiguousarray(seen.T), np.ascontiguousarray(seen.T[::-1])
        for t in range(size):
            np.take(table[0], forward[t], axis=1, out=fed[0], mode="clip")
            np.take(table[1], backward[t], axis=1, out=fed[1], mode="clip")
            np.matmul(recurrent, h, out=carried)
            gates += carried[:, :2 * hidden]
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            np.multiply(gates[:, hidden:], carried[:, 2 * hidden:], out=candidate)
            candidate += fed[:, 2 * hidden:]
            np.tanh(candidate, out=candidate)
            h -= candidate
            h *= gates[:, :hidden]
            h += candidate
            out[t, :hidden], out[size - 1 - t, hidden:] = h[0], h[1]
        return out

    def labels(self, seen):
        """Language probabilities of every position, (T, L, n)."""
        logits = np.matmul(np.ascontiguousarray(self.output.T), self.states(seen))
        logits += self.bias[:, None]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def pooled(self, texts):
        """Mean probabilities over the letter positions of each encoded text, (n, L)."""
        seen, owner = windows(texts, WINDOW)
        total, letters = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for at in range(0, len(seen), LANES):
            part = seen[at:at + LANES]
            mask = (part > 32).T.astype(np.float32)
            chance = self.labels(part)
            chance *= mask[:, None]
            np.add.at(total, owner[at:at + LANES], chance.sum(axis=0).T)
            np.add.at(letters, owner[at:at + LANES], mask.sum(axis=0))
        return total / np.maximum(letters, 1)[:, None]


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _loss_gradients(params, seen, wanted):
    """Gradients of the mean cross-entropy over letter positions."""
    table, recurrent, output, bias = params
    n, size = seen.shape
    hidden = recurrent.shape[1]
    order = np.stack([seen.T, seen.T[::-1]])
    h = np.zeros((2, n, hidden), np.float32)
    tape, states = [], np.empty((size, 2, n, hidden), np.float32)
    for t in range(size):
        fed = np.stack([table[0][order[0, t]], table[1][order[1, t]]])
        carried = h @ recurrent
        gates = _sigmoid(fed[:, :, :2 * hidden] + carried[:, :, :2 * hidden])
        update, reset = gates[:, :, :hidden], gates[:, :, hidden:]
        candidate = np.tanh(fed[:, :, 2 * hidden:] + reset * carried[:, :, 2 * hidden:])
        tape.append((h, update, reset, candidate, carried[:, :, 2 * hidden:]))
        h = candidate + update * (h - candidate)
        states[t, 0], states[size - 1 - t, 1] = h[0], h[1]
    logits = states[:, 0] @ output[:hidden] + states[:, 1] @ output[hidden:] + bias
    logits -= logits.max(axis=2, keepdims=True)
    chance = np.exp(logits)
    chance /= chance.sum(axis=2, keepdims=True)
    mask = (seen > 32).T.astype(np.float32)
    off = chance - np.eye(len(bias), dtype=np.float32)[wanted][None]
    off *= mask[:, :, None] / max(1.0, mask.sum())
    g_output = np.concatenate([np.einsum("tnh,tnl->hl", states[:, d], off) for d in (0, 1)])
    g_bias = off.sum(axis=(0, 1))
    g_states = np.stack([off @ output[:hidden].T, (off @ output[hidden:].T)[::-1]], axis=1)
    g_table, g_recurrent = np.zeros_like(table), np.zeros_like(recurrent)
    g_h = np.zeros((2, n, hidden), np.float32)
    for t in range(size - 1, -1, -1):
        before, update, reset, candidate, inner = tape[t]
        g_h = g_h + g_states[t]
        g_candidate = g_h * (1 - update) * (1 - candidate * candidate)
        g_update = g_h * (before - candidate) * update * (1 - update)
        g_reset = g_candidate * inner * reset * (1 - reset)
        g_fed = np.concatenate([g_update, g_reset, g_candidate], axis=2)
        g_carried = np.concatenate([g_update, g_reset, g_candidate * reset], axis=2)
        for d in (0, 1):
            np.add.at(g_table[d], order[d, t], g_fed[d])
        g_recurrent += before.transpose(0, 2, 1) @ g_carried
        g_h = g_h * update + g_carried @ recurrent.transpose(0, 2, 1)
    return [g_table, g_recurrent, g_output, g_bias]


def capacity(n):
    """Units per direction and training steps for ``n`` languages: steps in proportion beyond
    ``FEW_LANGUAGES``, units with their square root."""
    share = max(1.0, n / FEW_LANGUAGES)
    return round(HIDDEN * share ** 0.5), round(STEPS * share)


def fit(seen, wanted, languages, hidden=None, steps=None, seed=SEED):
    """A network trained on windows and their language numbers."""
    units, rounds = capacity(len(languages))
    hidden, steps = hidden or units, steps or rounds
    rng = np.random.default_rng(seed)
    n = len(languages)
    params = [rng.normal(0, 0.3, (2, 256, 3 * hidden)), rng.normal(0, 0.4, (2, hidden, 3 * hidden)),
              rng.normal(0, 0.3, (2 * hidden, n)), np.zeros(n)]
    params = [p.astype(np.float32) for p in params]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    if n > 1:
        by_language = [np.flatnonzero(wanted == k) for k in range(n)]
        for t in range(1, steps + 1):
            pick = np.concatenate([rng.choice(rows, max(1, BATCH // n)) for rows in by_language])
            rate = RATE * (1 - 0.95 * t / steps)
            for p, m, v, g in zip(params, first, second, _loss_gradients(params, seen[pick], wanted[pick])):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return Network(list(languages), *params)


def train(docs, per_language=SAMPLE_PER_LANGUAGE, seed=SEED):
    """A network trained on rows outside the held-out fold with a language and a letter.

    Each language gives about ``per_language`` distinct texts, chosen by a hash of the text, and
    of each a few windows at hashed places; only those windows come to the driver.  A text counts
    once for a language however often it is repeated.  More than ``MAX_LANGUAGES`` languages are
    an error: such a column holds something else.  None without any row to learn from.
    """
    known = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & F.col("text").rlike(r"\p{L}") & ~held_out("doc_id"))
    order = F.xxhash64("text")
    # A sketch counts the texts: no shuffle of the rows.
    counts = (known.groupBy("lang").agg(F.approx_count_distinct(order).alias("n"))
              .orderBy("lang").limit(MAX_LANGUAGES + 1).collect())
    if not counts:
        return None
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    sizes = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(r["n"]))])
    draw = F.pmod(order, F.lit(1 << 30)) / F.lit(float(1 << 30))

    @F.pandas_udf("array<binary>")
    def cut(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            data = text.encode("utf-8", "surrogatepass")
            room = max(1, len(data) - TRAIN_WINDOW + 1)
            rng = np.random.default_rng([seed, len(data)])
            out.append([data[a:a + TRAIN_WINDOW] for a in rng.integers(0, room, WINDOWS_PER_TEXT)])
        return pd.Series(out)

    rows = (known.where(draw * F.element_at(sizes, F.col("lang")) < per_language)
            .select("lang", order.alias("order"), cut("text").alias("windows"))
            .dropDuplicates(["lang", "order"])
            .orderBy("order", "lang").limit(2 * per_language * len(counts)).collect())
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    number = {name: k for k, name in enumerate(languages)}
    cuts = [(bytes(w), number[r["lang"]]) for r in rows for w in r["windows"]]
    seen, _ = windows([w.ljust(TRAIN_WINDOW, b"\0") for w, _ in cuts], TRAIN_WINDOW)
    return fit(seen, np.array([k for _, k in cuts]), languages, seed=seed)


def _predict(network):
    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        plain = [t or "" for t in texts]
        encoded = [t.encode("utf-8", "surrogatepass") for t in plain]
        names, scores = [], []
        for a, b in text_blocks(encoded):
            chance = network.pooled(encoded[a:b])
            best = chance.argmax(axis=1)
            for i in range(b - a):
                known = bool(_LETTER.search(plain[a + i]))
                names.append(network.languages[best[i]] if known else UNKNOWN)
                scores.append(min(1.0, float(chance[i, best[i]])) if known else 0.0)
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return predict


def identify(docs, network):
    """``doc_id, held_out, lang_pred, score`` for every row, from the whole text alone.

    ``und`` with score 0 where the text is null, empty or has no letter, or where
    nothing could be learnt (network None).  Equal chances go to the first
    language in order.  Repeated rows repeat; a null id is not held out.  Other
    columns are not read.  An empty table gives no rows.
    """
    base = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    if network is None:
        return base.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return (base.withColumn("p", _predict(network)("text"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))
