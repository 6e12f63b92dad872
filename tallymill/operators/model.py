"""Logistic regression with a grid search, on Spark ML."""

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from tallymill.functions.hashing import digest, lane_int
from tallymill.operators.features import FEATURES, scaling_stages
from tallymill.session import materialise

# Iterations, grid and folds of the search.
MAX_ITER = 10
REG_PARAMS = (0.1, 0.001)
ELASTIC_NETS = (0.6, 0.8)
FOLDS = 2


def build_pipeline(label, columns=FEATURES, weight=None, max_iter=MAX_ITER, tol=1e-6):
    """Scaling and regression. Class weights enter the fit only on request; by
    default they serve the evaluator alone."""
    lr = LogisticRegression(labelCol=label, featuresCol="features", maxIter=max_iter, tol=tol)
    if weight:
        lr = lr.setWeightCol(weight)
    return Pipeline(stages=[*scaling_stages(columns), lr])


def evaluator(label, weight="weight"):
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC",
                                         weightCol=weight)


def build_grid(lr, reg_params=REG_PARAMS, elastic_nets=ELASTIC_NETS):
    return (ParamGridBuilder().addGrid(lr.regParam, list(reg_params))
            .addGrid(lr.elasticNetParam, list(elastic_nets)).build())


@dataclass
class Search:
    """Result of a grid search: the best point's pipeline fitted on all rows, and the
    metric of every grid point in every fold."""
    best: PipelineModel
    grid: list
    folds: list                      # one list of metrics per fold, in grid order

    @property
    def averages(self):
        return [sum(of_point) / len(self.folds) for of_point in zip(*self.folds)]

    def best_params(self):
        lr = self.best.stages[-1]
        return {"regParam": lr.getRegParam(), "elasticNetParam": lr.getElasticNetParam()}

    def points(self):
        """``(reg_param, elastic_net, average, is_best)`` of every grid point; the first best is marked."""
        averages = self.averages
        top = averages.index(max(averages))
        for i, (point, metric) in enumerate(zip(self.grid, averages)):
            values = {p.name: v for p, v in point.items()}
            yield values["regParam"], values["elasticNetParam"], float(metric), i == top

    def report(self, spark):
        return spark.createDataFrame(
            list(self.points()), "reg_param double, elastic_net double, avg_auc double, is_best boolean")


def with_fold(df, key, folds=FOLDS, salt="folds"):
    """Hash-assigned fold number of every row, as ``_fold``."""
    return df.withColumn("_fold", lane_int(digest(key, salt), 0, folds).cast("int"))


def cross_validate(train, label, key, weight="weight", columns=FEATURES, folds=FOLDS,
                   parallelism=4, salt="folds", judge=None, reg_params=REG_PARAMS, elastic_nets=ELASTIC_NETS,
                   max_iter=MAX_ITER, tol=1e-6):
    """Grid search over hash-assigned folds, so a rerun sees the same folds.

    Scaling does not depend on the grid: it is fitted once per fold, on that fold's
    training side, and the fold's scaled vectors are written once for all points.
    ``judge`` maps scored validation rows to the metric (default: weighted AUC by
    Spark ML). The best point is fitted again on all rows. Give it a stored table (see
    ``session.materialise``), not a long lineage.
    """
    pipeline = build_pipeline(label, columns, max_iter=max_iter, tol=tol)
    scaling, lr = Pipeline(stages=pipeline.getStages()[:-1]), pipeline.getStages()[-1]
    grid, judge = build_grid(lr, reg_params, elastic_nets), judge or evaluator(label, weight).evaluate
    folded = with_fold(train.select(*columns, label, weight, key), key, folds, salt)

    def metric(job):
        point, learn, check = job
        return judge(lr.copy(point).fit(learn).transform(check))

    metrics = []
    with ThreadPool(min(parallelism, len(grid))) as pool:
        for fold in range(folds):
            scaler = scaling.fit(folded.filter(F.col("_fold") != fold))
            scaled = materialise(scaler.transform(folded).select("features", label, weight, "_fold"), "fold")
            learn, check = scaled.filter(F.col("_fold") != fold), scaled.filter(F.col("_fold") == fold)
            run = inheritable_thread_target(train.sparkSession)(metric)
            metrics.append(pool.map(run, [(point, learn, check) for point in grid]))
    search = Search(None, grid, metrics)
    top = next(point for point, row in zip(grid, search.points()) if row[3])
    search.best = Pipeline(stages=[*scaling.getStages(), lr.copy(top)]).fit(train)
    return search


def score(model, df, name="score"):
    """Probability of class 1 as a plain column."""
    out = model.transform(df)
    return out.withColumn(name, vector_to_array("probability")[1]).select(*df.columns, name)


def coefficients(fitted, columns=FEATURES):
    """A fitted pipeline as weights of its unscaled columns; the intercept stands under None.

    The scaler's moments are folded into the weights; a constant column weighs nothing."""
    scaler, lr = fitted.stages[-2], fitted.stages[-1]
    weights, intercept = {}, float(lr.intercept)
    for column, b, mean, std in zip(columns, lr.coefficients, scaler.mean, scaler.std):
        weights[column] = float(b / std) if std else 0.0
        intercept -= weights[column] * float(mean)
    return {None: intercept, **weights}


def publish(spark, weights, path, version):
    """Append a model's weights to a table of models as one file, so that a reader sees all of
    them or none; the highest version is the one in use."""
    rows = [(int(version), feature, float(weight)) for feature, weight in weights.items()]
    spark.createDataFrame(rows, "model_version long, feature string, weight double").coalesce(1).write.mode("append").parquet(path)


def latest_weights(spark, path):
    """``(version, weights)`` of the model in use: a row per column reaches the driver."""
    models = spark.read.schema("model_version long, feature string, weight double").parquet(path)
    version = models.agg(F.max("model_version")).first()[0]
    if version is None:
        raise ValueError(f"no model published at {path}")
    return version, {r["feature"]: r["weight"] for r in models.where(F.col("model_version") == version).collect()}


def linear_score(df, weights, name="score"):
    """Probability of class 1 under :func:`coefficients`, as a plain column expression; null
    where a weighed column is null."""
    margin = F.lit(weights[None])
    for column, weight in weights.items():
        if column is not None:
            margin = margin + F.lit(weight) * F.col(column).cast("double")
    return df.withColumn(name, 1 / (1 + F.exp(-margin)))
