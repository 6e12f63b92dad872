"""Scoring a stream with a fitted pipeline, or with the model in use."""

from pyspark.sql import functions as F

from tallymill.operators.model import latest_weights, linear_score, score
from tallymill.streaming.run import drain_batches


def score_stream(model, stream, threshold=None):
    """``stream`` with the model's probability; rows under ``threshold`` dropped."""
    scored = score(model, stream)
    return scored if threshold is None else scored.filter(scored["score"] >= threshold)


def score_with_latest(stream, coefficients, sink, checkpoint, threshold=None, after=None):
    """Score all data now available, each micro-batch with the model that the table of models
    at ``coefficients`` (see ``model.publish``) then names: a new champion takes over without a
    restart. Rows get ``score`` and ``model_version``.

    A micro-batch replaces its own folder ``_batch=<id>`` of ``sink``, so one that is repeated
    after a failure leaves its rows once, all of one version. ``after`` is called with the id of
    each finished micro-batch.
    """
    def handle(batch, batch_id):
        version, weights = latest_weights(batch.sparkSession, coefficients)
        scored = linear_score(batch, weights).withColumn("model_version", F.lit(version).cast("long"))
        if threshold is not None:
            scored = scored.filter(F.col("score") >= threshold)
        scored.write.mode("overwrite").parquet(f"{sink}/_batch={batch_id}")
        if after:
            after(batch_id)

    drain_batches(stream, handle, checkpoint)
