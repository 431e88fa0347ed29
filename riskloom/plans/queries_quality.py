"""Registered queries: data-quality tests and the snapshot gate (DQ1–DQ13, AG12, SL3,
AG19), run history (DR12, SL2, JN5, AG13, WN10, EV11, SRC8, SRC9, DQ18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import drift, history, quality
from riskloom.operators.features import TIER_VALUES
from riskloom.plans import oracle as O
from riskloom.plans.evaluate import scratch_dir
from riskloom.plans.registry import register
from riskloom.sources import derived as D

_TIERS_SQL = ", ".join(f"'{t}'" for t in TIER_VALUES)


@register(
    "dq1_dq4_feature_schema_tests",
    O.with_ctes(
        O.ADAPTER,
        O.STAGING,
        O.history_cte(),
        body=f"""
SELECT 'not_null' AS test, 'customer_id' AS column_name, COUNT(*) FILTER (WHERE customer_id IS NULL) AS failures FROM feature_history
UNION ALL SELECT 'not_null', 'churned', COUNT(*) FILTER (WHERE churned IS NULL) FROM feature_history
UNION ALL SELECT 'not_null', 'feature_computed_at', COUNT(*) FILTER (WHERE feature_computed_at IS NULL) FROM feature_history
UNION ALL SELECT 'not_null', 'snapshot_date', COUNT(*) FILTER (WHERE snapshot_date IS NULL) FROM feature_history
UNION ALL SELECT 'accepted_range', 'days_since_last_successful_payment', COUNT(*) FILTER (WHERE days_since_last_successful_payment IS NOT NULL
  AND (days_since_last_successful_payment < 0 OR days_since_last_successful_payment > 30)) FROM feature_history
UNION ALL SELECT 'accepted_values', 'membership_tier', COUNT(*) FILTER (WHERE membership_tier IS NOT NULL AND membership_tier NOT IN ({_TIERS_SQL})) FROM feature_history
UNION ALL SELECT 'unique', 'customer_id|snapshot_date', COUNT(*) FROM (SELECT customer_id, snapshot_date FROM feature_history GROUP BY ALL HAVING COUNT(*) > 1)
""",
    ),
)
def dq_schema_tests(spark, sf_dir):
    fh = D.history(spark, sf_dir)
    return quality.schema_tests(
        fh,
        not_null_cols=["customer_id", "churned", "feature_computed_at", "snapshot_date"],
        ranges={"days_since_last_successful_payment": (0, 30)},
        domains={"membership_tier": TIER_VALUES},
        unique=[["customer_id", "snapshot_date"]],
    )


@register(
    "dq2_ag12_duplicate_keys",
    O.with_ctes(*O.drift_feature_ctes(), O.DEFECTIVE, body="SELECT customer_id, COUNT(*) AS n FROM defective GROUP BY customer_id HAVING COUNT(*) > 1"),
)
def dq2_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(D.defective_snapshot(spark, sf_dir), ["customer_id"])


_RECENT_SQL = """SELECT snapshot_date, COUNT(*) AS n FROM feature_history WHERE snapshot_date < DATE '2024-01-30'
  GROUP BY snapshot_date ORDER BY snapshot_date DESC LIMIT 7"""


@register("sl3_recent_partition_sizes", O.with_ctes(O.ADAPTER, O.STAGING, O.history_cte(), body=_RECENT_SQL))
def sl3_recent_sizes(spark, sf_dir):
    return quality.recent_partition_sizes(D.history(spark, sf_dir), D.CURRENT_DATE)


@register(
    "dq13_quality_context",
    O.with_ctes(
        O.ADAPTER,
        O.STAGING,
        O.history_cte(),
        features_cte := O.features_cte("fc", "2024-01-30", replay=True),
        O.DEFECTIVE,
        body=f"""SELECT (SELECT MEDIAN(n) FROM ({_RECENT_SQL})) AS median_recent,
  (SELECT COUNT(*) FROM ({_RECENT_SQL})) AS n_partitions,
  (SELECT COUNT(*) FROM (SELECT customer_id FROM defective GROUP BY 1 HAVING COUNT(*) > 1)) AS duplicate_keys,
  (SELECT COUNT(*) FROM defective) AS row_count""",
    ),
    doubles=("median_recent",),
)
def dq13_quality_context(spark, sf_dir):
    recent = quality.recent_partition_sizes(D.history(spark, sf_dir), D.CURRENT_DATE)
    cur = D.defective_snapshot(spark, sf_dir)
    dups = quality.duplicate_keys(cur, ["customer_id"])
    return recent.agg(
        F.median(F.col("n").cast("double")).alias("median_recent"), F.count(F.lit(1)).alias("n_partitions")
    ).select(
        "median_recent",
        "n_partitions",
        dups.agg(F.count(F.lit(1))).scalar().alias("duplicate_keys"),
        cur.agg(F.count(F.lit(1))).scalar().alias("row_count"),
    )


_GATE_SQL = f"""
SELECT 'duplicate_keys' AS "check", NULL AS feature, CAST(d AS DOUBLE) AS observed, 0.0::DOUBLE AS bound
  FROM (SELECT COUNT(*) AS d FROM (SELECT customer_id FROM defective GROUP BY 1 HAVING COUNT(*) > 1)) WHERE d > 0
UNION ALL
SELECT 'row_volume', NULL, r, 0.5 FROM (SELECT (SELECT COUNT(*) FROM defective) / m AS r, m FROM (SELECT MEDIAN(n) AS m FROM ({_RECENT_SQL})))
  WHERE m IS NOT NULL AND m > 0 AND r < 0.5
UNION ALL
SELECT 'missing_columns', feature, NULL, NULL FROM (SELECT DISTINCT feature FROM fbb)
  WHERE feature <> 'churn_probability' AND feature NOT IN (SELECT column_name FROM (DESCRIBE defective))
UNION ALL
SELECT 'null_rate', s.feature, s.cur_null, b.b_null_rate FROM gate_stats s JOIN gate_base b USING (feature)
  WHERE b.tracks_nulls AND s.cur_null - b.b_null_rate > 0.25
UNION ALL
SELECT 'collapsed_column', s.feature, CAST(s.nd AS DOUBLE), CAST(b.value_cardinality AS DOUBLE) FROM gate_stats s JOIN gate_base b USING (feature)
  WHERE s.n > 0 AND b.value_cardinality > 1 AND s.nd <= 1"""


def _gate_stats_cte() -> str:
    present = [c for c in O.FEATURE_NUMERIC + O.FEATURE_CATEGORICAL if c != "renewal_count"]
    melt = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value FROM defective" for c in present)
    return (
        f"gate_stats AS (SELECT feature, COUNT(*) AS n, CASE WHEN COUNT(*) > 0 THEN COUNT(*) FILTER (WHERE value IS NULL) / CAST(COUNT(*) AS DOUBLE) ELSE 0.0 END AS cur_null, "
        f"COUNT(DISTINCT value) AS nd FROM ({melt}) GROUP BY feature),\n"
        "gate_base AS (SELECT feature, MAX(null_rate) AS b_null_rate, BOOL_OR(null_rate IS NOT NULL) AS tracks_nulls, MAX(value_cardinality) AS value_cardinality FROM fbb GROUP BY feature)"
    )


@register(
    "dq6_dq11_snapshot_quality_gate",
    O.with_ctes(
        O.ADAPTER,
        O.STAGING,
        O.history_cte(),
        O.features_cte("fb", "2024-01-20", replay=True),
        O.features_cte("fc", "2024-01-30", replay=True),
        O.DEFECTIVE,
        O.baseline_ctes("fbb", "fb", O.FEATURE_NUMERIC, O.FEATURE_CATEGORICAL),
        _gate_stats_cte(),
        body=_GATE_SQL,
    ),
    doubles=("observed", "bound"),
)
def dq6_quality_gate(spark, sf_dir):
    base = drift.freeze(drift.build_baseline(D.replay_snapshot(spark, sf_dir, D.BASELINE_DATE), D.FEATURE_NUMERIC, D.FEATURE_CATEGORICAL))
    cur, seen = quality.write_observed(D.defective_snapshot(spark, sf_dir), scratch_dir(spark, "gated"), D.FEATURE_NUMERIC, D.FEATURE_CATEGORICAL)
    recent = quality.recent_partition_sizes(D.history(spark, sf_dir), D.CURRENT_DATE)
    return quality.quality_failures(cur, base, D.FEATURE_NUMERIC, D.FEATURE_CATEGORICAL, recent, observed=seen)


# ------------------------------------------------------------------------------ history


@register(
    "sl2_recent_runs_per_model",
    O.with_ctes(
        O.DRIFT_HISTORY,
        body="SELECT champion_model, run_ts FROM (SELECT champion_model, run_ts, DENSE_RANK() OVER (PARTITION BY champion_model ORDER BY run_ts DESC) AS r "
        "FROM (SELECT DISTINCT champion_model, run_ts FROM dh)) WHERE r <= 3",
    ),
)
def sl2_recent_runs(spark, sf_dir):
    return history.recent_runs(D.drift_history(spark, sf_dir), 3)


@register(
    "jn5_ag13_breach_counts",
    O.with_ctes(
        O.DRIFT_HISTORY,
        "recent AS (SELECT DISTINCT run_ts FROM dh WHERE champion_model = 'churn-v2' ORDER BY run_ts DESC LIMIT 5)",
        body="SELECT feature, COUNT(*) FILTER (WHERE breached) AS breach_count FROM dh WHERE champion_model = 'churn-v2' "
        "AND run_ts IN (SELECT run_ts FROM recent) GROUP BY feature",
    ),
)
def jn5_breach_counts(spark, sf_dir):
    return history.prior_breach_counts(D.drift_history(spark, sf_dir), "churn-v2", 5)


@register(
    "dr12_persistence_rule",
    O.with_ctes(
        O.DRIFT_HISTORY,
        """cur AS (SELECT feature, psi FROM dh WHERE run_ts = (SELECT MAX(run_ts) FROM dh WHERE champion_model = 'churn-v2') AND breached),
recent AS (SELECT DISTINCT run_ts FROM dh WHERE champion_model = 'churn-v2' AND run_ts < TIMESTAMP '2024-01-30 06:00:00' ORDER BY run_ts DESC LIMIT 2),
prior AS (SELECT feature, COUNT(*) FILTER (WHERE breached) AS breach_count FROM dh WHERE champion_model = 'churn-v2' AND run_ts IN (SELECT run_ts FROM recent) GROUP BY feature)""",
        body="""SELECT c.feature, c.psi, COALESCE(p.breach_count, 0) + 1 AS breach_count, COALESCE(p.breach_count, 0) + 1 >= 2 AS persistent
FROM cur c LEFT JOIN prior p USING (feature)""",
    ),
    doubles=("psi",),
)
def dr12_persistence(spark, sf_dir):
    h = D.drift_history(spark, sf_dir)
    now = h.where(F.col("run_ts") == F.lit("2024-01-30 06:00:00").cast("timestamp_ntz"))
    return history.apply_persistence(now, h, "churn-v2", before="2024-01-30 06:00:00")


@register(
    "wn10_ev11_rejection_streaks",
    O.with_ctes(
        O.PROMOTIONS,
        body="""SELECT model, run_ts, promoted,
  CAST(CASE WHEN promoted THEN 0 ELSE ROW_NUMBER() OVER (PARTITION BY model, island ORDER BY run_ts) - CASE WHEN island > 0 THEN 1 ELSE 0 END END AS INTEGER) AS consecutive_rejections,
  CASE WHEN promoted THEN 0 ELSE ROW_NUMBER() OVER (PARTITION BY model, island ORDER BY run_ts) - CASE WHEN island > 0 THEN 1 ELSE 0 END END >= 3 AS feature_review_alert
FROM (SELECT *, SUM(CAST(promoted AS INTEGER)) OVER (PARTITION BY model ORDER BY run_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM pr)""",
    ),
)
def wn10_rejection_streaks(spark, sf_dir):
    return history.rejection_streaks(D.promotion_runs(spark, sf_dir))


_REG_SQL = "reg AS (SELECT 'churn-predictor' AS display_name, model_version, MIN(predicted_at) AS create_time, 'champion' AS role_label FROM scored GROUP BY model_version)"


@register(
    "src9_newest_champion",
    O.with_ctes(O.ADAPTER, O.STAGING, O.history_cte(), O.PREDICTIONS, _REG_SQL,
                body="SELECT display_name, arg_max(model_version, create_time) AS model_version, MAX(create_time) AS create_time FROM reg WHERE role_label = 'champion' GROUP BY display_name"),
)
def src9_newest_champion(spark, sf_dir):
    return history.newest_champion(D.model_registry(spark, sf_dir))


@register(
    "dq18_single_champion",
    O.with_ctes(O.ADAPTER, O.STAGING, O.history_cte(), O.PREDICTIONS, _REG_SQL,
                body="SELECT display_name, model_version, create_time, CASE WHEN ROW_NUMBER() OVER (PARTITION BY display_name ORDER BY create_time DESC, model_version DESC) = 1 "
                "THEN 'champion' ELSE 'retired' END AS role, TRUE AS single_champion FROM reg"),
)
def dq18_single_champion(spark, sf_dir):
    return history.demote_previous_champions(D.model_registry(spark, sf_dir)).drop("labels")


@register(
    "src8_fn6_newest_successful_scores",
    O.with_ctes(
        O.ADAPTER, O.STAGING, O.history_cte(), O.PREDICTIONS,
        body="""SELECT customer_id, snapshot_date, churn_probability, churn_prediction, 'job-' || strftime(snapshot_date, '%Y%m%d') AS job_id
FROM scored WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM scored WHERE snapshot_date < (SELECT MAX(snapshot_date) FROM scored))""",
    ),
    doubles=("churn_probability",),
)
def src8_newest_successful(spark, sf_dir):
    jobs, outputs = D.batch_jobs(spark, sf_dir)
    return history.newest_successful_output(jobs, outputs, "churn-predictor", "churn-batch-predict")
