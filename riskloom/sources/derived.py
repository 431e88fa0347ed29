"""Inputs the jobs need that the driver's tables do not hold directly.

Each is a pure Spark derivation of the driver tables, so its size follows theirs:

* the activity log and its staged form (see :mod:`riskloom.sources.event_log`);
* a feature table with several daily partitions, rebuilt from the log as of each day;
* a prediction log scoring every row of that feature table (a deterministic score per
  (customer, day), two model versions with their own decision thresholds).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scalar import as_date, safe_corr
from riskloom.operators import features as feat
from riskloom.session import materialize
from riskloom.sources.event_log import activity_log

AS_OF = "2024-02-15"
HISTORY_DATES = ["2024-01-10", "2024-01-20", "2024-01-30"]
# The model that scored each day and its registered decision threshold.
MODEL_SWITCH_DATE = "2024-01-25"
MODEL_THRESHOLDS = {"churn-v1": 0.5, "churn-v2": 0.45}


def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.staging(activity_log(spark, sf_dir))


def snapshot(spark: SparkSession, sf_dir: str, as_of: str = AS_OF, fused: bool = True) -> DataFrame:
    return feat.feature_snapshot(staged_events(spark, sf_dir), as_of, fused=fused)


def history(spark: SparkSession, sf_dir: str, dates: list[str] | None = None) -> DataFrame:
    return feat.feature_history(staged_events(spark, sf_dir), dates or HISTORY_DATES)


def score_features(features: DataFrame) -> DataFrame:
    """A prediction log for every (customer, snapshot_date) row of a feature table."""
    p = ((F.col("customer_id") * 7919 + F.dayofyear("snapshot_date") * 104729) % 1000) / F.lit(1000.0)
    version = F.when(F.col("snapshot_date") >= as_date(MODEL_SWITCH_DATE), "churn-v2").otherwise("churn-v1")
    threshold = F.when(version == "churn-v2", MODEL_THRESHOLDS["churn-v2"]).otherwise(MODEL_THRESHOLDS["churn-v1"])
    return features.select(
        "customer_id",
        p.alias("churn_probability"),
        (p >= threshold).alias("churn_prediction"),
        version.alias("model_version"),
        "snapshot_date",
        (F.col("snapshot_date").cast("timestamp_ntz") + F.expr("INTERVAL 3 HOURS")).alias("predicted_at"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_features(history(spark, sf_dir))


def stored(df: DataFrame) -> DataFrame:
    """Stand-in for reading a table the nightly job has already written.

    Jobs downstream of the feature table (drift, quality, splits) read a stored partition in
    production; here the partition is derived, so it is written once to the shared
    checkpoint folder and read back, instead of being re-derived for every reference.
    """
    return materialize(df)


def replay_snapshot(spark: SparkSession, sf_dir: str, as_of: str, materialize: bool = True) -> DataFrame:
    """customer_features rebuilt from the log as it stood on ``as_of``."""
    df = feat.feature_snapshot(staged_events(spark, sf_dir), as_of, replay=True)
    return stored(df) if materialize else df


# Drift inputs at size: lineitem before/after a ship date.  Nulls are injected the way a
# broken upstream join would (a CASE on the order key), at 2 % before and 25 % after, so the
# null bucket has something to detect.
DRIFT_SPLIT = "1998-07-01"
LINEITEM_NUMERIC = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]
LINEITEM_CATEGORICAL = ["l_returnflag", "l_linestatus"]
FEATURE_NUMERIC = [
    "member_since_days",
    "contact_requests_last_30d",
    "avg_transaction_30d",
    "avg_transaction_90d",
    "payment_failure_rate_30d",
    "payment_failure_rate_90d",
    "total_payment_attempts",
    "days_since_last_successful_payment",
    "avg_engagement_30d",
    "avg_engagement_90d",
    "campaign_participation_rate",
    "total_events",
    "events_last_30d",
    "events_last_90d",
    "renewal_count",
]
FEATURE_CATEGORICAL = ["membership_tier", "region", "preferred_channel"]
BASELINE_DATE = "2024-01-20"
CURRENT_DATE = "2024-01-30"


def lineitem_period(spark: SparkSession, sf_dir: str, period: str) -> DataFrame:
    from riskloom.sources.tables import read_table

    li = read_table(
        spark,
        sf_dir,
        "lineitem",
        ["l_orderkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    )
    split = F.lit(DRIFT_SPLIT + " 00:00:00").cast("timestamp_ntz")
    if period == "baseline":
        rows, every = li.where(F.col("l_shipdate") < split), 50
    else:
        rows, every = li.where(F.col("l_shipdate") >= split), 4
    return rows.select(
        F.when(F.col("l_orderkey") % every == 0, F.lit(None).cast("double")).otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        "l_quantity",
        "l_discount",
        "l_tax",
        F.when(F.col("l_orderkey") % 40 == 1, F.lit(None).cast("string")).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus",
    )


# Run histories: one run per day of the events table.
def drift_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ml.drift_metrics-shaped history: run = day, feature = event type, PSI from the day's
    mean value; the champion changes mid-month."""
    from riskloom.sources.tables import read_table

    ev = read_table(spark, sf_dir, "events", ["ts", "event_type", "value"])
    day = F.to_date("ts")
    agg = ev.groupBy(day.alias("snapshot_date"), F.col("event_type").alias("feature")).agg((F.avg("value") / 200.0).alias("psi"))
    return agg.select(
        (F.col("snapshot_date").cast("timestamp_ntz") + F.expr("INTERVAL 6 HOURS")).alias("run_ts"),
        "snapshot_date",
        F.when(F.col("snapshot_date") < as_date("2024-01-15"), "churn-v1").otherwise("churn-v2").alias("champion_model"),
        "feature",
        "psi",
        F.lit(0.25).alias("threshold"),
        (F.col("psi") > 0.25).alias("breached"),
        F.lit(True).alias("monitored"),
    )


def promotion_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation runs: one per day; promoted when that day's mean purchase value > 50."""
    from riskloom.sources.tables import read_table

    ev = read_table(spark, sf_dir, "events", ["ts", "event_type", "value"])
    return ev.where(F.col("event_type") == "purchase").groupBy(F.to_date("ts").alias("d")).agg(
        (F.avg("value") > 50).alias("promoted")
    ).select(
        F.lit("churn-predictor").alias("model"),
        (F.col("d").cast("timestamp_ntz") + F.expr("INTERVAL 5 HOURS")).alias("run_ts"),
        "promoted",
    )


def model_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows per model version seen in the prediction log; every version still
    carries role=champion (the state the demotion step repairs)."""
    p = predictions(spark, sf_dir)
    return p.groupBy("model_version").agg(F.min("predicted_at").alias("create_time")).select(
        F.lit("churn-predictor").alias("display_name"),
        "model_version",
        "create_time",
        F.create_map(F.lit("role"), F.lit("champion")).alias("labels"),
    )


def batch_jobs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(jobs, outputs): one scoring job per scored day; the newest day's job failed, so the
    newest *successful* run is the one before it.  Outputs carry the score as JSON text."""
    p = predictions(spark, sf_dir)
    jobs = p.groupBy("snapshot_date", "model_version").agg(F.max("predicted_at").alias("create_time"))
    newest = jobs.agg(F.max("snapshot_date")).scalar()
    jobs = jobs.select(
        F.concat(F.lit("job-"), F.date_format("snapshot_date", "yyyyMMdd")).alias("job_id"),
        F.lit("churn-batch-predict").alias("display_name"),
        F.lit("churn-predictor").alias("model"),
        F.when(F.col("snapshot_date") == newest, "FAILED").otherwise("SUCCEEDED").alias("state"),
        "create_time",
    )
    outputs = p.select(
        F.concat(F.lit("job-"), F.date_format("snapshot_date", "yyyyMMdd")).alias("job_id"),
        "customer_id",
        "snapshot_date",
        F.to_json(F.struct("churn_probability", "churn_prediction")).alias("prediction"),
    )
    return jobs, outputs


def defective_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current snapshot with the defects the gate exists for: a broken join nulls most
    engagement values, an upstream default collapses the channel, a retried load duplicates
    one region's customers, and one column disappears."""
    cur = replay_snapshot(spark, sf_dir, CURRENT_DATE)
    broken = cur.select(
        *[
            F.when(F.col("customer_id") % 3 != 2, F.lit(None).cast("double")).otherwise(F.col(c)).alias(c)
            if c == "avg_engagement_30d"
            else (F.lit("email").alias(c) if c == "preferred_channel" else F.col(c))
            for c in cur.columns
        ]
    )
    dup = broken.where(F.col("region") == "ASIA")  # one region's load was retried
    return broken.unionByName(dup).drop("renewal_count")


# Scores for metric jobs: label "returned" on lineitem; the champion scores with the
# discount (heavy ties), the challenger with the scaled extended price (few ties).
IMPORTANCE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def lineitem_scores(spark: SparkSession, sf_dir: str, period: str | None = None) -> DataFrame:
    from riskloom.sources.tables import read_table

    li = read_table(spark, sf_dir, "lineitem", ["l_returnflag", "l_discount", "l_extendedprice", "l_shipdate"])
    split = F.lit(DRIFT_SPLIT + " 00:00:00").cast("timestamp_ntz")
    if period == "train":
        li = li.where(F.col("l_shipdate") < split)
    elif period == "test":
        li = li.where(F.col("l_shipdate") >= split)
    # One scan for both models: each row emits one (model, score) pair per model.
    pairs = F.array(
        F.struct(F.lit("champion").alias("model"), F.col("l_discount").alias("score")),
        F.struct(F.lit("challenger").alias("model"), (F.col("l_extendedprice") / F.lit(120000.0)).alias("score")),
    )
    y = (F.col("l_returnflag") == "R").cast("int").alias("y")
    return li.select(y, F.explode(pairs).alias("p")).select(F.col("p.model").alias("model"), "y", F.col("p.score").alias("score"))


def lineitem_importances(spark: SparkSession, sf_dir: str, period: str) -> DataFrame:
    """(feature, importance) = |corr(feature, returned)| over one period: one global agg."""
    from riskloom.sources.tables import read_table

    li = read_table(spark, sf_dir, "lineitem", [*IMPORTANCE_FEATURES, "l_returnflag", "l_shipdate"])
    split = F.lit(DRIFT_SPLIT + " 00:00:00").cast("timestamp_ntz")
    li = li.where(F.col("l_shipdate") < split) if period == "train" else li.where(F.col("l_shipdate") >= split)
    y = (F.col("l_returnflag") == "R").cast("double")
    row = li.agg(*[F.abs(safe_corr(F.col(c).cast("double"), y)).alias(c) for c in IMPORTANCE_FEATURES])
    return row.unpivot([], IMPORTANCE_FEATURES, "feature", "importance")
