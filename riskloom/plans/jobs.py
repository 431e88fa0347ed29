"""Composed jobs: the nightly drift decision, baseline rebuilds (DR13–DR16, DQ12, SNK4,
SNK9, SNK12, DR15).

Row-level work is always a Spark plan; what reaches the driver is only the per-feature
verdict table (one row per monitored feature) and a handful of scalars, from which the
decision document is assembled.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.scalar import arrays_close
from riskloom.operators import drift, history, quality
from riskloom.operators.preprocess import align_to_features
from riskloom.plans import sinks
from riskloom.plans.evaluate import scratch_dir
from riskloom.session import materialize
from riskloom.sources import scans

log = logging.getLogger(__name__)

_PSI = T.MapType(T.StringType(), T.DoubleType())
_NULL_RATES = T.MapType(T.StringType(), T.StructType([T.StructField("baseline", T.DoubleType()), T.StructField("current", T.DoubleType())]))
_FAILURE = T.StructType([T.StructField("check", T.StringType()), T.StructField("feature", T.StringType()), T.StructField("detail", T.StringType())])
_QUALITY = T.StructType([T.StructField("data_quality_failed", T.BooleanType()), T.StructField("failures", T.ArrayType(_FAILURE)), T.StructField("row_count", T.LongType())])
# The fields of the decision document that the orchestrator and the reports read.
DECISION_SCHEMA = T.StructType(
    [
        T.StructField("champion_model", T.StringType()),
        T.StructField("snapshot_date", T.DateType()),
        T.StructField("drift_detected", T.BooleanType()),
        T.StructField("reason", T.StringType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("feature_psi", _PSI),
        T.StructField("feature_thresholds", _PSI),
        T.StructField("feature_null_rates", _NULL_RATES),
        T.StructField("breached_features", _PSI),
        T.StructField("unmonitored_features", T.ArrayType(T.StringType())),
        T.StructField("current_sample_size", T.LongType()),
        T.StructField("score_psi", T.DoubleType()),
        T.StructField("score_threshold", T.DoubleType()),
        T.StructField("score_drift_detected", T.BooleanType()),
        T.StructField("run_drift_detected", T.BooleanType()),
        T.StructField("persistence_window", T.IntegerType()),
        T.StructField("persistence_min_breaches", T.IntegerType()),
        T.StructField("breach_counts", T.MapType(T.StringType(), T.IntegerType())),
        T.StructField("persistent_breaches", _PSI),
        T.StructField("data_quality", _QUALITY),
        T.StructField("retrain_suppressed_by_data_quality", T.BooleanType()),
    ]
)


NO_HISTORY = "run_ts timestamp_ntz, champion_model string, feature string, breached boolean"


def feature_report(
    baseline: DataFrame,
    current: DataFrame,
    champion: str,
    numeric_cols: list[str],
    categorical_cols: list[str],
    past: DataFrame | None,
    psi_threshold: float,
    window: int,
    min_breaches: int,
) -> DataFrame:
    """Verdict of each feature and its place under the persistence rule, one row per feature."""
    verdict = materialize(drift.drift_verdict(baseline, current, numeric_cols, categorical_cols, psi_threshold))
    past = current.sparkSession.createDataFrame([], NO_HISTORY) if past is None else past
    rule = history.apply_persistence(verdict, past, champion, window, min_breaches).drop("psi")
    return verdict.join(rule, "feature", "left").withColumn("persistent", F.coalesce("persistent", F.lit(False)))


def quality_report(features: DataFrame, snapshot_date, snap: DataFrame, aligned: DataFrame, seen: quality.Observed, baseline: DataFrame, numeric_cols: list[str], categorical_cols: list[str]) -> dict:
    """DQ12: the gate judges the frame the model would see, with the columns the source had.
    It fails closed: a check that can't run is a failed check."""
    try:
        recent = quality.recent_partition_sizes(features, snapshot_date)
        found = quality.quality_failures(aligned, baseline, numeric_cols, categorical_cols, recent, source_columns=snap.columns, observed=seen).collect()  # some per feature
        failures = [{"check": r.check, "feature": r.feature, "detail": f"observed {r.observed}, bound {r.bound}"} for r in found]
        return {"data_quality_failed": bool(failures), "failures": failures, "row_count": seen.rows}
    except Exception as error:  # noqa: BLE001
        log.exception("the quality gate did not run")
        return {"data_quality_failed": True, "failures": [{"check": "check_failed", "feature": None, "detail": str(error)[:200]}], "row_count": 0}


def score_report(baseline: DataFrame, scores: DataFrame | None) -> dict:
    """DR13, for monitoring only: empty when there is no score baseline, no score or any error."""
    if scores is None:
        return {}
    try:
        found = drift.score_drift(baseline.where(F.col("feature") == drift.SCORE_FEATURE), scores).collect()  # one row at most
        return {"score_psi": found[0].psi, "score_threshold": found[0].threshold, "score_drift_detected": bool(found[0].psi > found[0].threshold)} if found and found[0].current_rows else {}
    except Exception:  # noqa: BLE001
        log.exception("no score signal in this run")
        return {}


def run_drift_check(
    features: DataFrame,
    baseline: DataFrame,
    champion: str | None,
    numeric_cols: list[str],
    categorical_cols: list[str],
    drift_history: DataFrame | None = None,
    scores: DataFrame | None = None,
    levels: DataFrame | None = None,
    history_path: str | None = None,
    run_ts: dt.datetime | None = None,
    psi_threshold: float = drift.PSI_THRESHOLD,
    persistence_window: int = history.PERSISTENCE_WINDOW,
    persistence_min_breaches: int = history.PERSISTENCE_MIN_BREACHES,
) -> DataFrame:
    """DR16: the decision, one row.  ``levels`` (PRJ7) freezes the categories of training."""
    spark = features.sparkSession
    empty = dict.fromkeys(DECISION_SCHEMA.names)
    if champion is None:
        return spark.createDataFrame([empty | {"drift_detected": False, "reason": "no_champion_registered"}], DECISION_SCHEMA)
    if persistence_min_breaches > persistence_window:
        raise ValueError("persistence_min_breaches cannot exceed persistence_window")
    snapshot_date, snap = scans.latest_partition(features)  # SRC2: one scalar, then pruning
    aligned = align_to_features(snap, numeric_cols + categorical_cols, levels, categorical=categorical_cols, keep=["customer_id"])  # PRJ6
    aligned, seen = quality.write_observed(aligned, scratch_dir(spark, "aligned"), numeric_cols, categorical_cols)
    own = baseline.where(F.col("feature") != drift.SCORE_FEATURE)
    judge = (own, aligned, champion, numeric_cols, categorical_cols)
    rule = (psi_threshold, persistence_window, persistence_min_breaches)
    try:
        rows = feature_report(*judge, drift_history, *rule).collect()  # one per feature
    except Exception:  # noqa: BLE001
        if drift_history is None:
            raise
        log.exception("drift history can't be read; every breach counts as the first")
        rows = feature_report(*judge, None, *rule).collect()
    breached, persistent = [r for r in rows if r.breached], [r for r in rows if r.persistent]
    gate = quality_report(features, snapshot_date, snap, aligned, seen, own, numeric_cols, categorical_cols)
    failed = gate["data_quality_failed"]
    decision = empty | score_report(baseline, scores) | {
        "champion_model": champion,
        "snapshot_date": snapshot_date,
        "drift_detected": bool(persistent) and not failed,
        "threshold": psi_threshold,
        "feature_psi": {r.feature: r.psi for r in rows},
        "feature_thresholds": {r.feature: r.threshold for r in rows},
        "feature_null_rates": {r.feature: {"baseline": r.baseline_null_rate, "current": r.current_null_rate} for r in rows if r.baseline_null_rate is not None},
        "breached_features": {r.feature: r.psi for r in breached},
        "unmonitored_features": sorted(r.feature for r in rows if not r.monitored),
        "current_sample_size": seen.rows,
        "run_drift_detected": bool(breached),
        "persistence_window": persistence_window,
        "persistence_min_breaches": persistence_min_breaches,
        "breach_counts": {r.feature: r.breach_count for r in breached},
        "persistent_breaches": {r.feature: r.psi for r in persistent},
        "data_quality": gate,
        "retrain_suppressed_by_data_quality": failed and bool(persistent),
    }
    if history_path:
        record_history(spark, rows, decision, run_ts or dt.datetime.now(dt.UTC).replace(tzinfo=None), history_path)
    return spark.createDataFrame([decision], DECISION_SCHEMA)


def record_history(spark, verdict, decision: dict, run_ts: dt.datetime, path: str) -> None:
    """SNK4: append one row per evaluated feature (+ the score row); a failure is logged,
    never allowed to discard the decision already computed."""
    rows = [(run_ts, decision["snapshot_date"], decision["champion_model"], r.feature, r.psi, r.threshold, bool(r.breached), bool(r.monitored)) for r in verdict]
    if decision.get("score_psi") is not None:
        rows.append((run_ts, decision["snapshot_date"], decision["champion_model"], drift.SCORE_FEATURE, decision["score_psi"],
                     decision["score_threshold"], bool(decision["score_drift_detected"]), True))
    schema = "run_ts timestamp_ntz, snapshot_date date, champion_model string, feature string, psi double, threshold double, breached boolean, monitored boolean"
    try:
        sinks.append(spark.createDataFrame(rows, schema), path)
    except Exception:  # noqa: BLE001
        log.exception("could not record drift metrics for this run")


def decision_document(decision: DataFrame) -> str:
    """SNK9: the decision as JSON text (absent sections omitted, ±inf kept as text)."""
    row = decision.first().asDict(recursive=True)
    row = {k: (v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v) for k, v in row.items()}
    return sinks.decision_json(row)


def rebuild_score_baseline(old: DataFrame, train_scores: DataFrame, score_col: str = drift.SCORE_FEATURE) -> tuple[DataFrame, bool]:
    """DR15: recompute the score baseline from the training scores and keep it only if its
    edges agree with the frozen ones (rtol 1e-3, atol 1e-4); otherwise keep the old one."""
    new = drift.freeze(drift.build_baseline(train_scores.select(score_col), [score_col], []))
    old_s = old.where(F.col("feature") == score_col)
    e_new = drift.baseline_edges(new).select("feature", F.col("edges").alias("n"))
    e_old = drift.baseline_edges(old_s).select("feature", F.col("edges").alias("o"))
    # one row per side (a single feature), joined on the feature name
    same = e_new.join(e_old, "feature").select(arrays_close(F.col("n"), F.col("o")).alias("ok")).first()
    ok = bool(same and same.ok)
    return (new if ok else old_s), ok


def rebuild_baseline(
    split_table: DataFrame,
    snapshot_date,
    numeric_cols: list[str],
    categorical_cols: list[str],
    old_baseline: DataFrame | None = None,
    train_scores: DataFrame | None = None,
    path: str | None = None,
    dry_run: bool = True,
) -> DataFrame:
    """SNK12: rebuild a frozen baseline from its own training split (SRC4 → PRJ6 → DR1),
    carry the verified score baseline over (DR15, SO6), and publish unless ``dry_run``."""
    train = scans.read_split(split_table, snapshot_date, "train")
    aligned = align_to_features(train, numeric_cols + categorical_cols, categorical=categorical_cols)
    new = drift.build_baseline(aligned, numeric_cols, categorical_cols)
    if old_baseline is not None and train_scores is not None:
        score_b, _ = rebuild_score_baseline(old_baseline, train_scores)
        new = new.unionByName(score_b)
    new = drift.freeze(new)
    if not dry_run and path:
        sinks.overwrite(new, path)
    return new
