"""Line field and byte network: gradients, exact inference, held-out accuracy, awkward rows."""

import itertools

import numpy as np
import pytest
from cases import LONG, awkward_documents, empty
from pyspark.sql import functions as F

from tallymill.llm import langid, quality
from tallymill.llm.common import held_out, table

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def field(spark):
    return quality.train(table(spark, SF, "documents"), table(spark, SF, "labels"))


@pytest.fixture(scope="module")
def network(spark):
    return langid.train(table(spark, SF, "documents"))


def test_marginals_match_all_labellings():
    rng = np.random.default_rng(2)
    sizes = [1, 4, 6, 2]
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    scores, start, steps = rng.normal(size=sum(sizes)) * 2, np.exp(rng.normal(size=2)), np.exp(rng.normal(size=(2, 2)))
    good, pairs = quality.forward_backward(scores, first, start, steps)
    want_pairs = np.zeros((2, 2))
    for a, n in zip(first, sizes):
        total, marginal, joint = 0.0, np.zeros(n), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=n):
            weight = start[labels[0]] * np.exp(sum(scores[a + t] for t in range(n) if labels[t]))
            for p, q in zip(labels, labels[1:]):
                weight *= steps[p, q]
            total += weight
            marginal += weight * np.array(labels)
            for p, q in zip(labels, labels[1:]):
                joint[p, q] += weight
        assert good[a:a + n] == pytest.approx(marginal / total, abs=1e-6)
        want_pairs += joint / total
    assert pairs == pytest.approx(want_pairs, abs=1e-5)


def test_neighbours_and_edges_are_features():
    x, lengths, first = quality.line_features([b"AB cd\n*** x\nplain", b"", b"one"])
    own = quality._OWN
    assert list(first) == [0, 3, 4] and list(lengths) == [5, 5, 5, 0, 3]
    assert (x[1, own:2 * own] == x[0, :own]).all() and (x[1, 2 * own:3 * own] == x[2, :own]).all()
    assert (x[0, own:2 * own] == 0).all() and (x[2, 2 * own:3 * own] == 0).all()
    assert x[:, -2].tolist() == [1, 0, 0, 1, 1] and x[:, -1].tolist() == [0, 0, 1, 1, 1]
    joined, _, _ = quality.line_features([b"AB cd\n*** x\nplain"])
    assert (x[:3] == joined).all()


def test_held_out_quality(spark, field):
    labels = table(spark, SF, "labels").dropDuplicates(["doc_id"])
    rows = (quality.score_documents(table(spark, SF, "documents"), field).where("held_out")
            .join(labels, "doc_id").select("score", "predicted", "quality").collect())
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    wins = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert len(bad) > 100 and wins > 0.995
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.985
    assert sum(r.predicted for r in rows if r.quality == 1) / len(good) > 0.985


def test_held_out_labels_are_not_learnt_from(spark, field):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    flipped = labels.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.train(docs, flipped)
    assert (again.weights == field.weights).all() and again.slope == field.slope


def test_lines_of_a_mixed_text(spark, field):
    good, bad = "The quiet house stood at the end of the lane and nobody came.", "THIS!! IS!! ALL!! LOUD!! NOISE!! AGAIN!!"
    text = "\n".join([good] * 4 + [bad] * 4 + [good] * 4)
    rows = quality.label_lines(spark.createDataFrame([(1, text)], "doc_id long, text string"), field).collect()
    labels = [r.good > 0.5 for r in sorted(rows, key=lambda r: r.line)]
    # Lines next to a change may lean to their neighbour.
    assert labels[:3] == labels[9:] == [True] * 3 and labels[4:8] == [False] * 4


def test_quality_of_awkward_rows(spark, field):
    docs = awkward_documents(spark, "score", "predicted", "held_out")
    rows = quality.score_documents(docs, field).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    assert all(r.held_out is False for r in rows if r.doc_id is None)
    kept = quality.keep_good(docs, field)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows)
    assert quality.score_documents(empty(docs), field).count() == 0
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    untrained = quality.train(docs, labels)
    assert {r.score for r in quality.score_documents(docs, untrained).collect()} == {0.5}
    assert quality.keep_good(docs, untrained).count() == docs.count()
    one_kind = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.train(docs, one_kind).fitted is False


def test_repeated_ids_and_long_texts_leave_both_labels(spark):
    good = lambda k: f"The quiet river runs along the old town and number {k} of the boats is here.\n" * 3
    bad = lambda k: f"%% $$ {k} ## @@ !! ^^\n" * 3
    ids = [r["id"] for r in spark.range(400).where(~quality.held_out("id")).orderBy("id").limit(20).collect()]
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, quality int")
    rows = [(i, (good if k % 2 else bad)(i)) for k, i in enumerate(ids)]
    repeated = spark.createDataFrame(rows + rows[:1] * 60, "doc_id long, text string")
    long = spark.createDataFrame([(i, t * 60) for i, t in rows], "doc_id long, text string")
    for docs in (repeated, long):
        texts, rate = quality._sample(docs, labels, 12, quality.MAX_SAMPLE_LINES)
        assert sorted(label for label, _ in texts) == [0] * 10 + [1] * 10 and rate == 0.5
        assert all(len(f) <= quality.MAX_SAMPLE_LINES for _, f in texts)
        assert quality.train(docs, labels, 12).fitted


def test_all_lines_of_long_texts_teach(spark):
    ids = [r["id"] for r in spark.range(400).where(~quality.held_out("id")).orderBy("id").limit(12).collect()]
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, quality int")
    docs = spark.createDataFrame([(i, "\n".join(f"line {j} of text {i}" for j in range(10 + 50 * k))) for k, i in enumerate(ids)],
                                 "doc_id long, text string")
    texts, _ = quality._sample(docs, labels, 12, 40, 100)
    assert max(len(f) for _, f in texts) <= 40
    assert sum(len(f) for _, f in texts) == sum(10 + 50 * k for k in range(12))
    whole, _, _ = quality.line_features(["\n".join(f"line {j} of text {ids[11]}" for j in range(560)).encode()])
    taught = {tuple(row[1:]) for _, f in texts for row in f}
    assert all(tuple(row) in taught for row in whole)
    bounded, _ = quality._sample(docs, labels, 12, 40, 8)
    assert sorted(label for label, _ in bounded) == [0] * 8 + [1] * 8


def test_block_size_does_not_change_a_score(field):
    texts = [b"plain words here\nand there " * 5, b"", LONG.encode(), b"LOUD!! NOISE!!\nquiet line"] * 3
    whole = field.quality(texts)
    assert whole == pytest.approx([field.quality([t])[0] for t in texts], abs=1e-12)


def test_network_gradients():
    rng = np.random.default_rng(4)
    hidden, n = 3, 3
    params = [rng.normal(0, 0.5, s).astype(np.float64) for s in ((2, 256, 3 * hidden), (2, hidden, 3 * hidden), (2 * hidden, n), (n,))]
    seen = rng.integers(97, 110, (5, 7)).astype(np.uint8)
    seen[0, 5:] = 0
    wanted = rng.integers(0, n, 5)

    def loss(p):
        chance = langid.Network(list("abc"), *[x.astype(np.float64) for x in p])
        states = _plain_states(seen, p[0], p[1])
        logits = states @ p[2] + p[3]
        logs = logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))
        mask = seen > 32
        assert chance is not None
        return -(logs[np.arange(5), :, wanted] * mask).sum() / mask.sum()

    gradients = langid._loss_gradients(params, seen, wanted)
    for which, spots in ((0, [(0, 97, 2), (1, 100, 7), (1, 101, 4)]), (1, [(0, 1, 5), (1, 2, 8)]), (2, [(4, 1)]), (3, [(2,)])):
        for spot in spots:
            step = 1e-5
            up, down = [p.copy() for p in params], [p.copy() for p in params]
            up[which][spot] += step
            down[which][spot] -= step
            assert gradients[which][spot] == pytest.approx((loss(up) - loss(down)) / (2 * step), abs=1e-5)


def _plain_states(seen, table_, recurrent):
    """Both directions one window and position at a time, (n, T, 2H)."""
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    hidden, out = recurrent.shape[1], []
    for window in seen:
        both = []
        for d, order in ((0, range(len(window))), (1, range(len(window) - 1, -1, -1))):
            h, states = np.zeros(hidden), {}
            for t in order:
                fed, carried = table_[d][window[t]], h @ recurrent[d]
                z, r = sigmoid(fed[:hidden] + carried[:hidden]), sigmoid((fed + carried)[hidden:2 * hidden])
                candidate = np.tanh(fed[2 * hidden:] + r * carried[2 * hidden:])
                h = (1 - z) * candidate + z * h
                states[t] = h
            both.append([states[t] for t in range(len(window))])
        out.append(np.concatenate(both, axis=1))
    return np.array(out)


def test_inference_matches_the_plain_recurrence(network):
    seen, _ = langid.windows(["Der Mann und die Frau gehen".encode(), "été 12 à Paris".encode()], 32)
    states = _plain_states(seen, network.table.astype(float), network.recurrent.astype(float))
    logits = states @ network.output + network.bias
    want = np.exp(logits) / np.exp(logits).sum(axis=2, keepdims=True)
    assert network.labels(seen).transpose(2, 0, 1) == pytest.approx(want, abs=1e-4)


def test_held_out_languages(spark, network):
    docs = table(spark, SF, "documents")
    rows = langid.identify(docs, network).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 2000 and sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_awkward_rows(spark, network):
    docs = awkward_documents(spark, "lang_pred", "p", "score")
    rows = langid.identify(docs, network).collect()
    assert len(rows) == docs.count()
    got = {r.doc_id: r.lang_pred for r in rows}
    assert all(got[i] == "und" for i in (2, 3, 4, 6)) and got[5] in network.languages and got[7] in network.languages
    assert langid.identify(empty(docs), network).count() == 0
    assert langid.train(empty(docs)) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    odd = spark.createDataFrame([(1, "words only of one tongue", "en")], "doc_id long, text string, lang string")
    assert langid.train(odd).languages == ["en"]


def test_repeats_of_a_text_teach_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "fit", lambda windows, wanted, languages, seed: seen.append((windows, wanted, languages)))
    one = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the very same words again and again").alias("text"), F.lit("en").alias("lang"))
    other = spark.range(3000, 3300).select(F.col("id").alias("doc_id"), F.concat(F.lit("autre texte numero "), F.col("id").cast("string")).alias("text"),
                                           F.when(F.col("id") % 3 == 0, "en").otherwise("fr").alias("lang"))
    langid.train(one.unionByName(other))
    windows, wanted, languages = seen[0]
    kept = [r.lang for r in other.where(~held_out("doc_id")).collect()]
    assert languages == ["en", "fr"]
    assert [int((wanted == k).sum()) for k in (0, 1)] == [langid.WINDOWS_PER_TEXT * n for n in (kept.count("en") + 1, kept.count("fr"))]


def test_many_languages_are_all_learnt_or_an_error(spark, monkeypatch):
    monkeypatch.setattr(langid, "fit", lambda windows, wanted, languages, seed: languages)
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("words "), F.col("id").cast("string")).alias("text"),
                                    F.concat(F.lit("l"), (F.col("id") % 400).cast("string")).alias("lang"))
    assert len(langid.train(docs)) == 400
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 399)
    with pytest.raises(ValueError, match="languages"):
        langid.train(docs)
    assert langid.capacity(4) == (langid.HIDDEN, langid.STEPS) and langid.capacity(400) == (20, 10000)


def test_a_held_out_language_is_not_learnt(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("some words of text here").alias("text"),
                                   F.when(held_out("id"), "xx").otherwise("en").alias("lang"))
    assert langid.train(docs).languages == ["en"]
