"""Run-history operators: persistence of drift breaches, champion registry, rejection
streaks (DR12, SL2, JN5, AG13, SRC8, SRC9, SL5, DQ18, WN10, EV11).

These tables hold one row per run (or per run × feature, or per model version), so they
are small by construction; windows over a model's runs are therefore safe.  Row-level
prediction data is only ever joined, never windowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.scalar import ntz_literal

# Fixed values of the persistence rule and the rejection alert.
PERSISTENCE_WINDOW = 3
PERSISTENCE_MIN_BREACHES = 2
MAX_CONSECUTIVE_REJECTIONS = 3


def recent_runs(history: DataFrame, n: int, model_col: str = "champion_model", run_col: str = "run_ts") -> DataFrame:
    """SL2 per model: the ``n`` newest distinct runs of every model (dense rank on a
    one-row-per-run table)."""
    runs = history.select(model_col, run_col).distinct()
    w = Window.partitionBy(model_col).orderBy(F.col(run_col).desc())
    return runs.withColumn("_r", F.dense_rank().over(w)).where(F.col("_r") <= n).drop("_r")


def last_runs_of(history: DataFrame, model: str, n: int, before=None) -> DataFrame:
    """SL2 for one model: ``SELECT DISTINCT run_ts … ORDER BY run_ts DESC LIMIT n``."""
    h = history.where(F.col("champion_model") == model)
    if before is not None:
        h = h.where(F.col("run_ts") < ntz_literal(before))
    return h.select("run_ts").distinct().orderBy(F.col("run_ts").desc()).limit(n)


def prior_breach_counts(history: DataFrame, model: str, prior_runs: int, before=None) -> DataFrame:
    """AG13 over JN5: per feature, breaches in the last ``prior_runs`` previous runs.

    The run list is at most ``prior_runs`` rows, so it is broadcast for the semi join.
    """
    if prior_runs <= 0:
        return history.sparkSession.createDataFrame([], "feature string, breach_count long")
    runs = last_runs_of(history, model, prior_runs, before)
    h = history.where(F.col("champion_model") == model).join(F.broadcast(runs), "run_ts", "left_semi")
    return h.groupBy("feature").agg(F.count_if("breached").alias("breach_count"))


def apply_persistence(
    current: DataFrame,
    history: DataFrame,
    model: str,
    window: int = PERSISTENCE_WINDOW,
    min_breaches: int = PERSISTENCE_MIN_BREACHES,
    before=None,
) -> DataFrame:
    """DR12: for each feature breaching now, prior breaches + 1 ≥ min_breaches → persistent.

    Raises when the rule cannot be satisfied inside its window (an argument error).
    """
    if min_breaches > window:
        raise ValueError("persistence_min_breaches cannot exceed persistence_window")
    prior = prior_breach_counts(history, model, window - 1, before)
    now = current.where(F.col("breached")).select("feature", "psi")
    out = now.join(prior, "feature", "left").select(
        "feature", "psi", (F.coalesce("breach_count", F.lit(0)) + 1).alias("breach_count")
    )
    return out.withColumn("persistent", F.col("breach_count") >= min_breaches)


def newest_champion(registry: DataFrame) -> DataFrame:
    """SRC9: per model name, the newest version labelled role=champion (max_by, no sort)."""
    champs = registry.where(F.col("labels")["role"] == "champion")
    return champs.groupBy("display_name").agg(
        F.max_by(F.struct("model_version", "create_time"), F.col("create_time")).alias("_m")
    ).select("display_name", "_m.model_version", "_m.create_time")


def demote_previous_champions(registry: DataFrame) -> DataFrame:
    """DQ18: keep exactly one champion per name (the newest); the rest become 'retired'.

    Output has the new role and the invariant flag ``single_champion`` per name.
    """
    is_champ = F.coalesce(F.col("labels")["role"] == "champion", F.lit(False))
    # Small table (one row per model version): champions first, newest first.
    w = Window.partitionBy("display_name").orderBy(is_champ.desc(), F.col("create_time").desc(), F.col("model_version").desc())
    role = F.when(is_champ & (F.row_number().over(w) == 1), "champion").when(is_champ, "retired").otherwise(F.col("labels")["role"])
    out = registry.withColumn("role", role)
    check = F.count_if(F.col("role") == "champion").over(Window.partitionBy("display_name")) == 1
    return out.withColumn("single_champion", check)


def newest_successful_output(jobs: DataFrame, outputs: DataFrame, model: str, display_name: str) -> DataFrame:
    """SRC8 + SL5 + FN6: rows of the newest SUCCEEDED job for a model and display name (equal, so that evaluation runs are left out), with the
    score pulled out of its JSON payload.  The job list is one row per run (small)."""
    cand = jobs.where(
        (F.col("state") == "SUCCEEDED") & (F.col("display_name") == display_name) & (F.col("model") == model)
    )
    newest = cand.agg(F.max_by("job_id", F.struct("create_time", "job_id")).alias("job_id"))
    picked = outputs.join(F.broadcast(newest), "job_id", "left_semi")
    return picked.select(
        "customer_id",
        "snapshot_date",
        F.get_json_object("prediction", "$.churn_probability").cast("double").alias("churn_probability"),
        F.get_json_object("prediction", "$.churn_prediction").cast("boolean").alias("churn_prediction"),
        "job_id",
    )


def rejection_streaks(runs: DataFrame, model_col: str = "model", run_col: str = "run_ts", alert_at: int = MAX_CONSECUTIVE_REJECTIONS) -> DataFrame:
    """WN10 + EV11: consecutive rejections since the last promotion (0 on a promotion).

    Gaps-and-islands: the island id is the running count of promotions, so each island is
    one promotion followed by the rejections after it.
    """
    w = Window.partitionBy(model_col).orderBy(run_col)
    island = F.sum(F.col("promoted").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    x = runs.withColumn("_island", island)
    rn = F.row_number().over(Window.partitionBy(model_col, "_island").orderBy(run_col))
    streak = F.when(F.col("promoted"), F.lit(0)).otherwise(rn - F.when(F.col("_island") > 0, 1).otherwise(0))
    return x.withColumn("consecutive_rejections", streak.cast("int")).withColumn(
        "feature_review_alert", F.col("consecutive_rejections") >= alert_at
    ).drop("_island")
