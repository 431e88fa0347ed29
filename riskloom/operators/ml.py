"""Training and scoring on ``pyspark.ml`` (ML1–ML6), re-aimed from a single-process
boosted-tree library to Spark's distributed GBT.

* Missing values: Spark trees have no missing-value branch, so each numeric feature gets a
  0/1 "was missing" indicator and is median-imputed (the indicator keeps the MNAR signal).
* Categoricals: ``StringIndexer(handleInvalid="keep")`` — unseen levels at scoring time go
  to one extra bucket, like an unknown category.
* Class imbalance: per-row weight negatives/positives on positives (ML1), computed on the
  rows each model is fit on.
* Folds come from the stratified seeded assignment (WN11); candidate sweeps fit their
  fold models in parallel threads (concurrent Spark jobs), not sequentially.
"""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators import metrics
from riskloom.session import materialize

LABEL = "y"
WEIGHT = "w"
# The declared search space (low, high, log scale) and its defaults.
SEARCH_SPACE = {
    "maxDepth": (3, 10, False, int),
    "stepSize": (0.01, 0.3, True, float),
    "subsamplingRate": (0.5, 1.0, False, float),
    "featureSubsetStrategy": (0.5, 1.0, False, float),
    "maxIter": (50, 500, False, int),
}
TRIALS, FOLDS = 100, 5
ROWS_PER_TASK = 1 << 15  # of training vectors: boosting runs a job for every level of every tree, so a task has to be worth its start
DEFAULT_PARAMS = {"maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 1.0, "featureSubsetStrategy": 1.0, "maxIter": 100}


def with_class_weight(df: DataFrame, label: str = LABEL) -> DataFrame:
    """ML1: weight = negatives/positives on positive rows, 1 on negatives (one aggregate as a
    scalar subquery; no join)."""
    neg, pos = F.count_if(F.col(label) == 0).cast("double"), F.count_if(F.col(label) == 1).cast("double")
    ratio = df.agg(F.try_divide(neg, pos).alias("ratio")).scalar()
    return df.withColumn(WEIGHT, F.when(F.col(label) == 1, F.coalesce(ratio, F.lit(1.0))).otherwise(F.lit(1.0)))


def feature_stages(numeric: list[str], categorical: list[str]) -> list:
    """ML2: indicator + median imputation for numerics, indexing for categoricals, one vector."""
    imputed = [f"{c}__imp" for c in numeric]
    indexed = [f"{c}__idx" for c in categorical]
    return [
        Imputer(inputCols=numeric, outputCols=imputed, strategy="median"),
        StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"),
        VectorAssembler(inputCols=[*imputed, *[f"{c}__na" for c in numeric], *indexed], outputCol="features", handleInvalid="keep"),
    ]


def booster(params: dict | None = None, seed: int = 42, levels: int = 0) -> GBTClassifier:
    """``levels``: the most levels any categorical has; a split must have a bin for each."""
    p = dict(DEFAULT_PARAMS, **(params or {}))
    p["featureSubsetStrategy"] = str(p["featureSubsetStrategy"])
    return GBTClassifier(labelCol=LABEL, weightCol=WEIGHT, featuresCol="features", seed=seed, maxBins=max(32, levels + 2), **p)


def prepare(df: DataFrame, numeric: list[str], label_col: str | None = "churned") -> DataFrame:
    """Missing-indicator columns and the 0/1 label."""
    cols = [F.col(c).cast("double").alias(c) for c in numeric] + [F.col(c).isNull().cast("double").alias(f"{c}__na") for c in numeric]
    other = [c for c in df.columns if c not in numeric]
    out = df.select(*other, *cols)
    if label_col and label_col in df.columns:
        out = out.withColumn(LABEL, F.col(label_col).cast("int"))
    return out


def ready_for_training(train: DataFrame, numeric: list[str], categorical: list[str]) -> tuple[DataFrame, int, int]:
    """(weighted training rows, the most levels of a categorical, number of rows).  A numeric column without a
    single value is filled with 0 before imputing: its indicator says all there is to know."""
    ready = prepare(train, numeric)
    seen = ready.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.when(~F.isnan(c), F.col(c))).alias(f"n_{c}") for c in numeric],
        *[F.approx_count_distinct(c, 0.02).alias(f"k_{c}") for c in categorical],
    ).first()
    empty = [c for c in numeric if not seen[f"n_{c}"]]
    ready = ready.withColumns({c: F.lit(0.0) for c in empty}) if empty else ready
    return with_class_weight(ready), max([int(1.1 * seen[f"k_{c}"]) + 2 for c in categorical], default=0), seen.rows


def training_vectors(ready: DataFrame, prepared: PipelineModel, rows: int) -> DataFrame:
    """Labels, weights and vectors, persisted in no more partitions than the rows are worth: the number
    of the table behind them says how it was written, and each of boosting's jobs has a task for every one."""
    parts = max(1, math.ceil(rows / ROWS_PER_TASK))
    return prepared.transform(ready).select(LABEL, WEIGHT, "features").coalesce(parts).persist()


def fit(train: DataFrame, numeric: list[str], categorical: list[str], params: dict | None = None, seed: int = 42) -> PipelineModel:
    ready, levels, rows = ready_for_training(train, numeric, categorical)
    prepared = Pipeline(stages=feature_stages(numeric, categorical)).fit(ready)
    vectors = training_vectors(ready, prepared, rows)
    try:
        return PipelineModel([*prepared.stages, booster(params, seed, levels).fit(vectors)])
    finally:
        vectors.unpersist()


def score(model: PipelineModel, df: DataFrame, numeric: list[str], keep: list[str] = ("customer_id",)) -> DataFrame:
    """ML5 core: P(class 1) as a plain double column."""
    out = model.transform(prepare(df, numeric, label_col=None))
    return out.select(*[c for c in keep if c in out.columns], vector_to_array("probability")[1].alias("churn_probability"))


def fold_vectors(folded: DataFrame, numeric: list[str], categorical: list[str], j: int) -> tuple[DataFrame, DataFrame, int]:
    """Fold ``j`` prepared once for all candidates: (training vectors, vectors to score, levels).
    Both are persisted, as boosting passes over them for every level of every tree."""
    ready, levels, rows = ready_for_training(folded.where(F.col("fold") != j), numeric, categorical)
    model = Pipeline(stages=feature_stages(numeric, categorical)).fit(ready)
    rest = prepare(folded.where(F.col("fold") == j), numeric)
    return training_vectors(ready, model, rows), model.transform(rest).select(LABEL, "features").persist(), levels


def fold_scores(folded: DataFrame, numeric: list[str], categorical: list[str], k: int, candidates: list[dict | None], seed: int = 42, parallelism: int = 4) -> DataFrame:
    """(model, y, score) of every candidate on every fold, scored by a model fit on the other
    folds; ``model`` is "candidate:fold".  Folds are prepared, and candidates fit, concurrently."""
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        data = list(pool.map(lambda j: fold_vectors(folded, numeric, categorical, j), range(k)))

        def run(ij: tuple[int, int]) -> DataFrame:
            i, j = ij
            train, rest, levels = data[j]
            out = booster(candidates[i], seed, levels).fit(train).transform(rest)
            return out.select(F.lit(f"{i}:{j}").alias("model"), F.col(LABEL).alias("y"), vector_to_array("probability")[1].alias("score"))

        parts = list(pool.map(run, [(i, j) for i in range(len(candidates)) for j in range(k)]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = materialize(out)
    for train, rest, _ in data:
        train.unpersist()
        rest.unpersist()
    return out


def oof_scores(folded: DataFrame, numeric: list[str], categorical: list[str], k: int = FOLDS, params: dict | None = None, seed: int = 42) -> DataFrame:
    """ML3: out-of-fold scores — fold j is scored by a model fit on the other folds."""
    return fold_scores(folded, numeric, categorical, k, [params], seed, parallelism=k).withColumn("model", F.lit("oof"))


def cv_threshold(folded: DataFrame, numeric: list[str], categorical: list[str], k: int, target_recall: float = metrics.TARGET_RECALL, params: dict | None = None) -> DataFrame:
    """ML3 → EV5: decision threshold chosen on out-of-fold scores, never on the test rows."""
    s = oof_scores(folded, numeric, categorical, k, params)
    return metrics.select_threshold(metrics.pr_curve(metrics.cumulative(s)), target_recall)


def draw_candidates(n: int = TRIALS, seed: int = 42, space: dict = SEARCH_SPACE) -> list[dict]:
    """ML4: seeded candidates drawn up front from the declared bounds (log scale where
    flagged); replaces the adaptive sampler of the reference."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        c = {}
        for name, (lo, hi, log, typ) in space.items():
            v = math.exp(rng.uniform(math.log(lo), math.log(hi))) if log else rng.uniform(lo, hi)
            c[name] = int(round(v)) if typ is int else float(v)
        out.append(c)
    return out


def sweep(folded: DataFrame, numeric: list[str], categorical: list[str], k: int, candidates: list[dict], parallelism: int = 4) -> DataFrame:
    """ML4: mean and std of fold PR-AUC per candidate; best = highest mean.  PR-AUC of all
    (candidate, fold) scores is one grouped job."""
    spark = folded.sparkSession
    allp = fold_scores(folded, numeric, categorical, k, candidates, parallelism=parallelism)
    ap = metrics.average_precision(metrics.cumulative(allp))
    ap = ap.select(F.split("model", ":")[0].cast("int").alias("candidate"), "pr_auc")
    res = ap.groupBy("candidate").agg(F.avg("pr_auc").alias("mean_pr_auc"), F.stddev_pop("pr_auc").alias("std_pr_auc"))
    params = spark.createDataFrame([(i, str(sorted(c.items()))) for i, c in enumerate(candidates)], "candidate int, params string")
    # one row per candidate: the un-partitioned window is over a tiny table
    return res.join(params, "candidate").withColumn("is_best", F.col("mean_pr_auc") == F.max("mean_pr_auc").over(Window.partitionBy()))


def feature_importance(model: PipelineModel, numeric: list[str], categorical: list[str]) -> dict[str, float]:
    """ML6: the fitted model's importances as (feature, importance), the missing-indicator
    share folded into its base feature.  A different measure from mean |SHAP|, used the
    same way downstream (ranking, Spearman, selection)."""
    gbt = model.stages[-1]
    names = [*numeric, *numeric, *categorical]
    vals = gbt.featureImportances.toArray().tolist()
    agg: dict[str, float] = {}
    for n, v in zip(names, vals, strict=False):
        agg[n] = agg.get(n, 0.0) + float(v)
    return agg


def importance_frame(spark, agg: dict[str, float]) -> DataFrame:
    return spark.createDataFrame(sorted(agg.items()), "feature string, importance double")
