import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallymill.functions.hashing import in_fraction
from tallymill.functions.stats import shapiro_wilk, t_two_sided
from tallymill.operators import features, model, validate
from tallymill.plans.views import predictions


def auc_by_hand(rows):
    """rows of (label, score, weight)"""
    pos = [(s, w) for y, s, w in rows if y == 1]
    neg = [(s, w) for y, s, w in rows if y == 0]
    total = sum(w for _, w in pos) * sum(w for _, w in neg)
    if not total:
        return None
    return sum(a * b * (1.0 if s > t else 0.5 if s == t else 0.0)
               for s, a in pos for t, b in neg) / total


@pytest.fixture(scope="module")
def scored(spark):
    """Three groups; one holds most rows and one score holds a third of them."""
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        g = "hot" if i % 10 else ("a" if i % 20 else "b")
        s = 0.5 if rng.random() < 0.33 else round(rng.gauss(0, 1), 2)
        rows.append((i, g, int(rng.random() < 0.3), s, rng.choice([0.5, 2.0, 3.0])))
    return rows


SCHEMA = "id long, g string, y int, s double, w double"


def test_weighted_auc_by_brute_force(spark, scored):
    df = spark.createDataFrame(scored, SCHEMA).repartition(7)
    got = {r.g: r.auc for r in validate.weighted_auc(df, "y", "s", "w", by=["g"]).collect()}
    for g in ("hot", "a", "b"):
        assert got[g] == pytest.approx(auc_by_hand([r[2:] for r in scored if r[1] == g]), abs=1e-12)
    whole = validate.weighted_auc(df, "y", "s", "w").first()
    assert whole.auc == pytest.approx(auc_by_hand([r[2:] for r in scored]), abs=1e-12)
    assert whole.n_rows == len(scored)


def test_auc_of_reversed_scores(spark, scored):
    df = spark.createDataFrame(scored, SCHEMA)
    a = validate.weighted_auc(df, "y", "s", "w").first().auc
    b = validate.weighted_auc(df.withColumn("s", -F.col("s")), "y", "s", "w").first().auc
    assert a + b == pytest.approx(1.0)


def test_auc_segments_do_not_change_the_result(spark, scored):
    df = spark.createDataFrame(scored, SCHEMA)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    got = []
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for n in (1, 3, 40):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(validate.weighted_auc(df, "y", "s", "w").first().auc)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert got == pytest.approx([auc_by_hand([r[2:] for r in scored])] * 3, abs=1e-12)


def test_auc_equals_the_library_in_exact_mode(spark, sf_dir):
    df = predictions(spark, sf_dir)
    library = BinaryClassificationEvaluator(rawPredictionCol="score_a", labelCol="label",
                                            weightCol="weight", numBins=0).evaluate(df)
    ours = validate.weighted_auc(df, "label", "score_a", "weight").first().auc
    assert ours == pytest.approx(library, abs=1e-12)
    assert ours == pytest.approx(0.4917745833201925, abs=1e-12)


def test_tied_one_class_and_empty_inputs(spark):
    make = lambda rows: spark.createDataFrame(rows, "y int, s double")
    assert validate.weighted_auc(make([(0, 1.0), (1, 1.0)]), "y", "s").first().auc == 0.5
    assert validate.weighted_auc(make([(1, 1.0), (1, 2.0)]), "y", "s").first().auc is None
    assert validate.weighted_auc(make([]), "y", "s").first().auc is None


def test_replicates_are_samples_of_the_right_size(spark):
    df = spark.range(20000).select("id", F.lit("m").alias("m"))
    drawn = validate.sample_replicates(df, "id", "m", replicates=50, share=0.02)
    sizes = [r["n"] for r in drawn.groupBy("replicate").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 50
    assert all(abs(n - 400) < 5 * math.sqrt(400 * 0.98) for n in sizes)
    assert abs(sum(sizes) / 50 - 400) < 20
    assert drawn.groupBy("replicate", "id").count().filter("count > 1").count() == 0
    # Overlap of two replicates is that of independent draws.
    pairs = drawn.alias("a").join(drawn.alias("b"), "id").filter("a.replicate < b.replicate").count()
    expected = 20000 * 0.02 ** 2 * 50 * 49 / 2
    assert abs(pairs - expected) < 5 * math.sqrt(expected)


def test_replicates_repeat_and_differ_between_models(spark):
    df = spark.range(5000).select("id", F.lit("m").alias("m"), F.lit("k").alias("k"))
    rows = lambda d, salt: set(map(tuple, validate.sample_replicates(d, "id", salt).select(
        "id", "replicate").collect()))
    assert rows(df, "m") == rows(df.repartition(5), "m")
    assert rows(df, "m") != rows(df, "k")


def test_any_number_of_replicates(spark):
    df = spark.range(3).select("id", F.lit("m").alias("m"))
    drawn = validate.sample_replicates(df, "id", "m", replicates=200_000, share=0.01)
    late = drawn.filter("replicate >= 100000").count()
    assert abs(late - 3000) < 5 * math.sqrt(3000)


def test_rows_without_a_score_are_counted_and_left_out(spark):
    rows = [(1, 0.9), (0, 0.8), (1, None), (0, None), (0, 0.1)]
    df = spark.createDataFrame(rows, "y int, s double")
    auc = validate.weighted_auc(df, "y", "s").first()
    assert (auc.n_rows, auc.n_null_score, auc.auc) == (3, 2, 1.0)
    cut = validate.threshold_metrics(df, "y", "s", [0.5]).first()
    assert (cut.tp, cut.fp, cut.fn, cut.n_null_score) == (1, 1, 0, 2)


def test_normality_of_small_large_and_mixed_groups(spark):
    rows = [("m", 1, float(v)) for v in range(2)] + [("m", 2, float(v * v % 97)) for v in range(6000)]
    df = spark.createDataFrame(rows, "model string, segment int, auc double")
    got = {r.segment: r for r in validate.normality(df, ["model", "segment"]).collect()}
    assert (got[1].n, got[1].statistic, got[1].p_value, got[1].extrapolated) == (2, None, None, False)
    assert got[2].n == 6000 and 0 < got[2].statistic < 1 and got[2].extrapolated


def test_one_pass_replicates_match_single_samples(spark, sf_dir):
    df = predictions(spark, sf_dir)
    fused = {(r.model, r.replicate): r for r in validate.auc_replicates(
        df, "event_id", "label", {"a": "score_a"}, "weight", replicates=3, share=0.05).collect()}
    one = validate.sample_replicates(df.withColumn("m", F.lit("a")), "event_id", "m", 3, 0.05)
    for r in range(3):
        rows = one.filter(F.col("replicate") == r).select("label", "score_a", "weight").collect()
        assert fused["a", r].n_rows == len(rows)
        assert fused["a", r].auc == pytest.approx(auc_by_hand([tuple(x) for x in rows]), abs=1e-12)


def test_degenerate_samples(spark):
    rows = [(i, 0, float(i), 1.0) for i in range(40)] + [(100, 1, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id long, y int, s double, w double")
    of = lambda how: {r.replicate: r.auc for r in validate.auc_replicates(
        df, "id", "y", {"m": "s"}, "w", replicates=60, share=0.03, degenerate=how).collect()}
    kept, dropped, filled = of("keep"), of("exclude"), of("mllib")
    assert any(v is None for v in kept.values())
    assert dropped == {k: v for k, v in kept.items() if v is not None}
    assert len(filled) == 60 and None not in filled.values()
    assert all(filled[k] in (0.0, 1.0) for k, v in kept.items() if v is None)
    assert all(filled[k] == 0.5 for k in set(filled) - set(kept))
    with pytest.raises(ValueError):
        of("other")


def test_shapiro_wilk_against_published_values():
    # The weights of eleven men, Shapiro and Wilk (1965).
    w, p = shapiro_wilk([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236])
    assert w == pytest.approx(0.78881, abs=1e-4) and p == pytest.approx(0.006704, abs=1e-5)
    w, p = shapiro_wilk([1.0, 2.0, 4.0])
    assert w == pytest.approx(0.964286, abs=1e-5) and p == pytest.approx(0.636886, abs=1e-4)
    assert all(map(math.isnan, shapiro_wilk([1.0, 2.0])))


def test_t_distribution_against_tables():
    for t, dof, p in ((12.706205, 1, 0.05), (2.228139, 10, 0.05), (2.600887, 198, 0.01),
                      (3.390, 100, 0.001)):
        assert t_two_sided(t, dof) == pytest.approx(p, rel=2e-3)
    assert t_two_sided(0.0, 5) == pytest.approx(1.0)


def scores(spark, a, b):
    rows = [("initial", i, float(v)) for i, v in enumerate(a)]
    rows += [("tuned", i, float(v)) for i, v in enumerate(b)]
    return spark.createDataFrame(rows, "model string, replicate int, auc double")


def test_t_test_and_champion(spark):
    a = [0.50, 0.52, 0.48, 0.51, 0.49]
    same = validate.t_test(scores(spark, a, a[::-1]), "initial", "tuned")
    assert same.first().p_value == pytest.approx(1.0)
    assert validate.champion(same, "initial", "tuned").first().champion == "initial"
    better = validate.t_test(scores(spark, a, [x + 0.2 for x in a]), "initial", "tuned")
    row = validate.champion(better, "initial", "tuned").first()
    assert (row.result, row.champion, row.dof) == ("dist_DIFFERENT", "tuned", 8)
    assert row.t == pytest.approx(-0.2 / math.sqrt(0.00025 * 2 / 5))


def test_a_worse_tuned_model_wins_unless_improvement_is_required(spark):
    a = [0.50, 0.52, 0.48, 0.51, 0.49]
    worse = validate.t_test(scores(spark, a, [x - 0.2 for x in a]), "initial", "tuned")
    assert validate.champion(worse, "initial", "tuned").first().champion == "tuned"
    strict = validate.champion(worse, "initial", "tuned", require_improvement=True)
    assert strict.first().champion == "initial"


def test_normality_per_model(spark):
    rng = random.Random(1)
    df = scores(spark, [rng.gauss(0.5, 0.1) for _ in range(100)],
                [rng.expovariate(1) for _ in range(100)])
    got = {r.model: r for r in validate.normality(df).collect()}
    assert got["initial"].p_value > 0.05 > got["tuned"].p_value
    jb = {r.model: r for r in validate.jarque_bera(df).collect()}
    assert jb["initial"].p_value > 0.05 > jb["tuned"].p_value


def test_threshold_metrics_by_brute_force(spark, scored):
    df = spark.createDataFrame(scored, SCHEMA)
    cuts = [-1.0, 0.0, 0.5, 1.0, 9.0]
    for r in validate.threshold_metrics(df, "y", "s", cuts).collect():
        tp = sum(1 for x in scored if x[2] == 1 and x[3] >= r.threshold)
        fp = sum(1 for x in scored if x[2] == 0 and x[3] >= r.threshold)
        fn = sum(1 for x in scored if x[2] == 1 and x[3] < r.threshold)
        assert (r.tp, r.fp, r.fn) == (tp, fp, fn)
        assert r.precision == (pytest.approx(tp / (tp + fp)) if tp + fp else None)
        assert not r.meets_floors
    perfect = spark.createDataFrame([(1, 1.0), (0, 0.0)], "y int, s double")
    assert validate.threshold_metrics(perfect, "y", "s", [0.5]).first().meets_floors


def test_decision_bands(spark):
    df = spark.createDataFrame([(0.99, 1.0), (0.8, 1.0), (0.5, 1.0), (0.5, 900.0), (0.1, 900.0)],
                               "s double, a double")
    got = [r.d for r in df.select(validate.decision("s", "a", 0.95, 0.7, 500.0, 0.4).alias("d")).collect()]
    assert got == ["block", "review", "pass", "review", "pass"]


def test_class_weights_sum_to_the_row_count(spark):
    df = spark.createDataFrame([(0,)] * 90 + [(1,)] * 10, "y int")
    rows = features.class_weights(df, "y").collect()
    assert sum(r.n * r.weight for r in rows) == pytest.approx(100)
    total = features.with_class_weight(df, "y").agg(F.sum("weight")).first()[0]
    assert total == pytest.approx(100)


def test_one_class_has_no_weights(spark):
    with pytest.raises(Exception, match="both classes"):
        features.with_class_weight(spark.createDataFrame([(0,)], "y int"), "y").collect()


def test_split_is_stable_and_near_its_share(spark):
    df = spark.range(10000)
    a = features.hash_split(df, "id").filter("split = 'train'")
    assert abs(a.count() - 7000) < 200
    assert a.exceptAll(features.hash_split(df.repartition(3), "id").filter("split = 'train'")).count() == 0
    assert df.filter(in_fraction("id", 0.0, "x")).count() == 0


def test_scaling_equals_the_library(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.gauss(5, 2), float(i), 7.0) for i in range(200)],
                               "a double, b double, k double")
    train = df.filter("b < 150")
    cols = ["a", "b", "k"]
    ours = features.standardise(train, df, cols).orderBy("b").collect()
    asm = VectorAssembler(inputCols=cols, outputCol="v")
    lib = StandardScaler(inputCol="v", outputCol="z", withMean=True, withStd=True).fit(
        asm.transform(train)).transform(asm.transform(df)).orderBy("b").select(
        vector_to_array("z").alias("z")).collect()
    for o, z in zip(ours, lib):
        assert [o.a_scaled, o.b_scaled, o.k_scaled] == pytest.approx(z.z, abs=1e-9)


def test_grid_report_marks_one_best(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        y = int(rng.random() < 0.4)
        rows.append((i, y, rng.gauss(y * 2, 1), rng.random()))
    df = features.with_class_weight(
        spark.createDataFrame(rows, "id long, y int, a double, b double"), "y")
    search = model.cross_validate(df, "y", "id", columns=("a", "b"))
    report = search.report(spark).collect()
    assert len(report) == 4 and sum(r.is_best for r in report) == 1
    best = max(report, key=lambda r: r.avg_auc)
    assert best.is_best and best.avg_auc > 0.85
    assert search.best_params() == {"regParam": best.reg_param, "elasticNetParam": best.elastic_net}
    scored = model.score(search.best, df)
    assert validate.weighted_auc(scored, "y", "score", "weight").first().auc > 0.85
    weighted = model.build_pipeline("y", ("a", "b"), weight="weight").fit(df)
    assert weighted.stages[-1].getWeightCol() == "weight"


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_operating_points_by_brute_force(spark, scored, partitions):
    sets = {"low": {"precision": 0.2, "recall": 0.5, "f1": 0.3}, "none": validate.FLOORS,
            "tail": {"precision": 0.0, "recall": 0.001, "f1": 0.0}}
    rows = [(y, s if i % 9 else None) for i, _, y, s, _ in scored] + [(None, 0.25), (None, 99.0)]
    kept = [(y, s) for y, s in rows if s is not None]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.floors: r for r in validate.operating_points(
            spark.createDataFrame(rows, "y int, s double"), "y", "s", sets).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for name, floors in sets.items():
        meeting = []
        for t in sorted({s for _, s in kept}):
            tp, fp = (sum(1 for y, s in kept if y == c and s >= t) for c in (1, 0))
            fn = sum(1 for y, s in kept if y == 1 and s < t)
            if tp + fp and tp / (tp + fp) >= floors["precision"] and tp / (tp + fn) >= floors["recall"] \
                    and 2 * tp / (2 * tp + fp + fn) >= floors["f1"]:
                meeting.append((t, tp, fp, fn))
        r = got[name]
        assert (r.n_scores, r.n_meeting) == (len({s for _, s in kept}), len(meeting))
        assert (r.threshold, r.tp, r.fp, r.fn) == (meeting[0] if meeting else (None,) * 4)
    assert got["none"].threshold is None and got["low"].n_meeting > 1


def test_operating_points_of_empty_and_one_class_tables(spark):
    none = validate.operating_points(spark.createDataFrame([], "y int, s double"), "y", "s").first()
    assert (none.threshold, none.n_scores, none.n_meeting) == (None, 0, 0)
    ones = validate.operating_points(spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, s double"), "y", "s").first()
    assert (ones.threshold, ones.tp, ones.fp, ones.fn) == (0.5, 2, 0, 0)
    zeros = validate.operating_points(spark.createDataFrame([(0, 0.5)], "y int, s double"), "y", "s").first()
    assert (zeros.threshold, zeros.n_scores) == (None, 1)


def test_folded_coefficients_score_like_the_pipeline(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, rng.gauss(40, 9), rng.gauss(-3, 2), 5.0, int(rng.random() < 0.4)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y int")
    fitted = model.build_pipeline("y", ("a", "b", "c")).fit(df)
    weights = model.coefficients(fitted, ("a", "b", "c"))
    assert weights["c"] == 0.0
    model.publish(spark, {None: 9.0, "a": 1.0}, str(tmp_path / "m"), 3)
    model.publish(spark, weights, str(tmp_path / "m"), 12)
    version, read = model.latest_weights(spark, str(tmp_path / "m"))
    assert version == 12 and read == weights
    got = {r.id: r.score for r in model.linear_score(df, read).collect()}
    assert got == pytest.approx({r.id: r.score for r in model.score(fitted, df).collect()})


def test_gap_replicates_are_spread_by_their_number(spark, monkeypatch):
    df = spark.range(400).selectExpr("id", "CAST(id % 3 = 0 AS int) AS y", "CAST(id % 37 AS double) AS a", "1.5D AS w")
    scores = lambda: validate.auc_replicates(df, "id", "y", {"m": "a"}, "w", replicates=200, share=0.1, by_gaps=True)
    rows = lambda out: {(r.model, r.replicate): (r.n_rows, round(r.auc, 9)) for r in out.collect()}
    plain = rows(scores())
    monkeypatch.setattr(validate, "MEMBERS_PER_TASK", 400)
    spread = scores()
    assert rows(spread) == plain and len(plain) == 200
    assert spread._jdf.queryExecution().optimizedPlan().toString().count(", 20") >= 3
