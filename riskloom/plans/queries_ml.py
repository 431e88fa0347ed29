"""Registered queries: training and scoring on pyspark.ml (ML2, ML3, ML5, ML6) and the evaluate
stage (EV10); the candidate sweep (ML4) is an operator without a query.  Rows-only checks: boosted-tree scores are not expected to equal another
library's (SURVEY H5); unit tests check the properties instead."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from riskloom.operators import metrics, ml, preprocess, splits
from riskloom.plans import sinks
from riskloom.plans.evaluate import evaluate_stage
from riskloom.plans.registry import register
from riskloom.sources import derived as D
from riskloom.sources import scans

NUM = D.FEATURE_NUMERIC
CAT = D.FEATURE_CATEGORICAL


def _split(snap):
    return D.stored(splits.stratified_split(snap, assigned_at="2024-02-15 04:00:00"))


def _train(spark, sf_dir):
    return scans.read_split(_split(D.stored(D.snapshot(spark, sf_dir))), D.AS_OF, "train")


@register("ml2_ml6_feature_importance")
def ml2_importance(spark, sf_dir):
    """Fit the classifier on the training split; its importances per feature."""
    model = ml.fit(_train(spark, sf_dir), NUM, CAT)
    return ml.importance_frame(spark, ml.feature_importance(model, NUM, CAT))


@register("ml3_oof_threshold")
def ml3_threshold(spark, sf_dir):
    """Decision threshold from out-of-fold scores of the training split."""
    folded = D.stored(splits.stratified_folds(_train(spark, sf_dir), k=ml.FOLDS))
    return ml.cv_threshold(folded, NUM, CAT, ml.FOLDS)


def _threshold(model, train) -> float:
    """The stored decision threshold (EV5): chosen on scores of training rows, never of those to be judged."""
    scored = ml.score(model, train, NUM, keep=["customer_id"]).join(train.select("customer_id", F.col("churned").cast("int").alias("y")), "customer_id")
    curve = metrics.pr_curve(metrics.cumulative(scored.select(F.lit("m").alias("model"), "y", F.col("churn_probability").alias("score"))))
    return metrics.select_threshold(curve).first().threshold


def _model_scorer(model, features, threshold):
    def run(instances, out):
        # JSON exports stringify numbers and omit NULL keys (T11): re-align first (PRJ6).
        aligned = preprocess.align_to_features(instances, features, categorical=CAT, keep=["customer_id"])
        s = ml.score(model, aligned, NUM)
        rows = s.select(
            F.col("customer_id").cast("string").alias("customer_id"),
            F.struct(F.col("churn_probability"), (F.col("churn_probability") >= threshold).alias("churn_prediction")).alias("prediction"),
        )
        sinks.prediction_shards(rows, out)

    return run


@register("ev10_evaluate_stage")
def ev10_evaluate(spark, sf_dir):
    """Challenger vs champion on the held-out split, through the JSONL exchange."""
    split = _split(D.stored(D.snapshot(spark, sf_dir)))
    train = scans.read_split(split, D.AS_OF, "train")
    test = scans.read_split(split, D.AS_OF, "test")
    feats = NUM + CAT

    def trained(params):
        model = ml.fit(train, NUM, CAT, params)
        return model, _threshold(model, train)

    with ThreadPoolExecutor(max_workers=2) as pool:  # boosting is many short jobs: both models' at once
        (challenger, mine), (champion, theirs) = pool.map(trained, [None, {"maxDepth": 3}])
    return evaluate_stage(test, _model_scorer(challenger, feats, mine), mine, _model_scorer(champion, feats, theirs), theirs)


@register("ml5_prj8_batch_scoring")
def ml5_batch_scoring(spark, sf_dir):
    """Score the newest snapshot with the stored threshold and upsert into the log."""
    snap = D.stored(D.snapshot(spark, sf_dir))
    train = scans.read_split(_split(snap), D.AS_OF, "train")
    model = ml.fit(train, NUM, CAT)
    threshold = _threshold(model, train)
    if not preprocess.has_any_feature(snap, NUM + CAT):  # PRJ8
        raise ValueError("input shares no column with the feature set")
    current = preprocess.align_to_features(snap, NUM + CAT, categorical=CAT, keep=["customer_id", "snapshot_date"])
    scored = ml.score(model, current, NUM, keep=["customer_id", "snapshot_date"])
    new = D.stored(sinks.stamp_scores(scored.withColumn("churn_prediction", F.col("churn_probability") >= threshold), "churn-v3", "2024-02-15 03:00:00"))
    sinks.require_rows(new)
    log = D.predictions(spark, sf_dir)
    return sinks.merge_by_key(log, new.select(*log.columns), ["customer_id", "snapshot_date"])
