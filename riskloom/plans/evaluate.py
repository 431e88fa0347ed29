"""The evaluate stage (EV10): test split → JSONL batch source → scored shards → re-join
by id → metrics for challenger and champion → promotion gate (SNK6, SRC6, JN4, EV4, EV7,
EV8).  Files live under the shared checkpoint folder, never a machine-local path."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import metrics
from riskloom.plans import sinks
from riskloom.session import ensure_checkpoint_dir
from riskloom.sources import scans


def scratch_dir(spark, name: str) -> str:
    """A fresh folder for exchange files under the cluster's shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "exchange", f"{name}-{uuid.uuid4().hex[:12]}")


def rejoin_scores(requested: DataFrame, scores: DataFrame, key: str = "customer_id") -> DataFrame:
    """JN4: the requested ids with their scores.  Of several scores the last record counts: files in
    name order, lines in their order (``_place``).  Ids without a score are an error: all of them
    are written as a table, and the error names their number and its place."""
    value = [c for c in scores.columns if c not in (key, "_place")]
    dedup = scores.groupBy(key).agg(F.max_by(F.struct(*value), "_place").alias("_v")).select(key, *[F.col(f"_v.{c}").alias(c) for c in value])
    spark = requested.sparkSession
    path = scratch_dir(spark, "missing-scores")
    requested.select(key).join(dedup.select(key), key, "left_anti").write.parquet(path)
    if n := spark.read.schema(requested.select(key).schema).parquet(path).count():
        raise LookupError(f"{n} requested ids have no score; they are listed in {path}")
    return requested.join(dedup, key, "left")


def evaluate_stage(
    test_rows: DataFrame,
    challenger_scorer,
    challenger_threshold: float,
    champion_scorer=None,
    champion_threshold: float | None = None,
    glob: str = "prediction.results-*",
) -> DataFrame:
    """EV10: one-row promotion decision.  Scorers take the exported instances (a DataFrame
    read back from JSONL) and write prediction shards into a directory they are given."""
    spark = test_rows.sparkSession
    src = scratch_dir(spark, "batch-source")
    sinks.batch_source_export(test_rows, src)  # SNK6
    kinds = [f for f in test_rows.schema.fields if f.name not in sinks.NOT_EXPORTED]
    instances = spark.read.schema(T.StructType(kinds)).json(src)
    labels = test_rows.select(F.col("customer_id").cast("string").alias("customer_id"), F.col("churned").cast("int").alias("y"))
    parts, th = [], []
    for role, scorer, t in (("challenger", challenger_scorer, challenger_threshold), ("champion", champion_scorer, champion_threshold)):
        if scorer is None:
            continue
        out = scratch_dir(spark, f"scores-{role}")
        scorer(instances, out)
        scored = scans.read_prediction_shards(spark, out, glob)  # SRC6
        joined = rejoin_scores(labels, scored)  # JN4
        parts.append(joined.select(F.lit(role).alias("model"), "y", F.col("churn_probability").alias("score")))
        th.append((role, float(t)))
    scores = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    thresholds = spark.createDataFrame(th, "model string, threshold double")
    bundle = metrics.metric_bundle(scores, thresholds)
    return metrics.promotion_gate(bundle, "challenger", "champion" if champion_scorer is not None else None)
