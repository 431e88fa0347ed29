"""Boundary rules of the quality gate, risk mart, features and history operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift, features, history, quality, risk
from riskloom.plans import jobs


def _events(spark, rows):
    schema = ("event_id long, event_timestamp timestamp_ntz, customer_id long, event_type string, region string, "
              "membership_tier string, monthly_transaction double, payment_status string, payment_attempts_last_30d long, "
              "engagement_score double, member_since_days long, contact_requests_last_30d long, churned boolean, channel string, "
              "anomaly_injected boolean")
    return spark.createDataFrame(rows, schema)


def _ev(eid, day, cust, status="failed", amount=10.0, anomaly=False, et="transaction", channel="web"):
    ts = dt.datetime(2024, 1, day, 12)
    return (eid, ts, cust, et, "r", "friend", amount, status, 1, 0.5, 100, 0, False, channel, anomaly)


def test_staging_keeps_newest_duplicate_and_drops_anomalies(spark):
    rows = [_ev(1, 5, 1, amount=1.0), _ev(1, 6, 1, amount=2.0), _ev(2, 6, 1, anomaly=True), _ev(3, 7, 1, anomaly=None)]
    stg = features.staging(_events(spark, rows)).orderBy("event_id").collect()
    assert [(r.event_id, r.monthly_transaction) for r in stg] == [(1, 2.0), (3, 10.0)]


def test_never_paid_recency_is_null_and_windows_are_inclusive(spark):
    rows = [_ev(1, 1, 1, "failed"), _ev(2, 16, 1, "failed"), _ev(3, 10, 2, "success"), _ev(4, 15, 2, "failed")]
    snap = {r.customer_id: r for r in features.feature_snapshot(features.staging(_events(spark, rows)), "2024-02-15").collect()}
    assert snap[1].days_since_last_successful_payment is None
    assert snap[2].days_since_last_successful_payment == 30  # 36 days, capped
    assert snap[1].events_last_30d == 1  # 2024-01-16 is exactly 30 days before
    assert snap[1].payment_failure_rate_30d == 1.0
    assert snap[2].events_last_30d == 0 and snap[2].payment_failure_rate_30d is None


def test_missing_channels_count_as_a_value(spark):
    rows = [_ev(1, 1, 1, channel=None), _ev(2, 2, 1, channel=None), _ev(3, 3, 1), _ev(4, 1, 2, channel=None), _ev(5, 2, 2)]
    snap = features.feature_snapshot(features.staging(_events(spark, rows)), "2024-02-15").collect()
    assert {r.customer_id: r.preferred_channel for r in snap} == {1: None, 2: "web"}


def test_decision_gates_the_aligned_frame(spark):
    """A column that is gone and a category that is no longer known show up as missing values."""
    day = dt.date(2024, 1, 2)
    train = spark.range(200).select((F.col("id") % 40).cast("double").alias("a"), (F.col("id") % 50 / 10).alias("b"), F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("c"))
    levels = spark.createDataFrame([("c", "x", 0), ("c", "y", 1)], "column_name string, level string, code int")
    base = drift.freeze(drift.build_baseline(train, ["a", "b"], ["c"]))
    live = spark.range(200).select(F.col("id").alias("customer_id"), F.lit(day).alias("snapshot_date"), (F.col("id") % 40).cast("double").alias("a"), F.when(F.col("id") % 10 == 0, "x").otherwise("new").alias("c"))
    row = jobs.run_drift_check(live, base, "m1", ["a", "b"], ["c"], levels=levels, persistence_min_breaches=1).first()
    found = {(f["check"], f["feature"]) for f in row.data_quality.failures}
    assert {("missing_columns", "b"), ("null_rate", "b"), ("null_rate", "c"), ("collapsed_column", "c")} <= found
    assert row.run_drift_detected and not row.drift_detected and row.retrain_suppressed_by_data_quality
    assert set(row.feature_psi) == {"a", "b", "c"} and row.feature_psi["a"] < 1e-9 and row.current_sample_size == 200
    assert set(row.persistent_breaches) == set(row.breached_features) == set(row.breach_counts) and row.breach_counts["c"] == 1
    assert row.feature_null_rates["b"].current == 1.0 and row.threshold == drift.PSI_THRESHOLD
    nothing = jobs.run_drift_check(live, base, None, ["a"], []).first()
    assert nothing.drift_detected is False and nothing.reason == "no_champion_registered"


def test_score_baseline_is_kept_unless_its_edges_agree(spark):
    scores = spark.range(500).select((F.col("id") / 500).alias(drift.SCORE_FEATURE))
    old = drift.freeze(drift.build_baseline(scores, [drift.SCORE_FEATURE], []))
    again, same = jobs.rebuild_score_baseline(old, scores)
    kept, moved = jobs.rebuild_score_baseline(old, scores.select((F.col(drift.SCORE_FEATURE) / 2).alias(drift.SCORE_FEATURE)))
    assert same and not moved
    assert sorted(map(str, again.collect())) == sorted(map(str, kept.collect()))


def test_fused_and_joined_snapshots_agree(spark):
    rows = [_ev(i, 1 + i % 28, i % 4, "success" if i % 3 else "failed", channel=["web", "email"][i % 2]) for i in range(40)]
    stg = features.staging(_events(spark, rows))
    a = features.feature_snapshot(stg, "2024-02-15").orderBy("customer_id").collect()
    b = features.feature_snapshot(stg, "2024-02-15", fused=False).orderBy("customer_id").collect()
    assert a == b


def test_schema_tests_report_every_failure(spark):
    df = spark.createDataFrame([(1, "friend", 5), (1, "gold", 40), (None, None, None)], "customer_id long, tier string, d int")
    rep = {(r.test, r.column_name): r.failures for r in quality.schema_tests(
        df, not_null_cols=["customer_id"], ranges={"d": (0, 30)}, domains={"tier": ["friend"]}, unique=[["customer_id"]]).collect()}
    assert rep == {("not_null", "customer_id"): 1, ("accepted_range", "d"): 1, ("accepted_values", "tier"): 1, ("unique", "customer_id"): 1}


def test_quality_gate_failures(spark):
    base_df = spark.createDataFrame([(i, float(i % 5), ["a", "b"][i % 2]) for i in range(100)], "customer_id long, x double, c string")
    b = drift.freeze(drift.build_baseline(base_df, ["x"], ["c"]))
    cur = spark.createDataFrame([(i % 10, None, "a") for i in range(20)], "customer_id long, x double, c string")
    recent = spark.createDataFrame([(dt.date(2024, 1, 1), 100), (dt.date(2024, 1, 2), 100)], "snapshot_date date, n long")
    f = {(r.check, r.feature) for r in quality.quality_failures(cur, b, ["x"], ["c"], recent, source_columns=["customer_id", "c"]).collect()}
    assert ("row_volume", None) in f
    assert ("duplicate_keys", None) in f
    assert ("missing_columns", "x") in f
    assert ("null_rate", "x") in f
    assert ("collapsed_column", "c") in f


def test_row_volume_passes_without_history(spark):
    empty = spark.createDataFrame([], "snapshot_date date, n long")
    assert quality.row_volume_check(F.lit(1), empty).count() == 0


def test_portfolio_summary_empty_is_zeros(spark):
    empty = spark.createDataFrame([], "customer_id long, churn_probability double, monthly_value double")
    r = risk.portfolio_summary(empty).first()
    assert (r.customers_scored, r.high_risk_customers, r.high_risk_share, r.monthly_value_at_risk, r.mean_probability) == (0, 0, 0.0, 0.0, 0.0)


def test_never_paid_indicator_ranks_first(spark):
    mart = spark.createDataFrame(
        [(1, None, 0.9, 0.0), (2, 3.0, 0.0, 0.5), (3, 4.0, 0.0, 0.5)],
        "customer_id long, days_since_last_successful_payment double, payment_failure_rate_30d double, avg_engagement_30d double",
    )
    ref = risk.cohort_reference(mart)
    ind = risk.customer_indicators(mart, ref).where("customer_id = 1").orderBy("indicator_rank").collect()
    assert ind[0].feature == "days_since_last_successful_payment" and ind[0].severity == float("inf")
    assert ind[0].value is None


def test_high_risk_floor_matches_daily_rollup_constant():
    # The daily rollup and the bands share one constant.
    assert risk.HIGH_RISK_THRESHOLD == 0.7


def test_persistence_refuses_impossible_rule(spark):
    h = spark.createDataFrame([], "run_ts timestamp_ntz, champion_model string, feature string, breached boolean, psi double")
    with pytest.raises(ValueError):
        history.apply_persistence(h, h, "m", window=2, min_breaches=3)


def test_rejection_streaks(spark):
    runs = spark.createDataFrame(
        [("m", dt.datetime(2024, 1, d), p) for d, p in [(1, False), (2, False), (3, True), (4, False), (5, False), (6, False)]],
        "model string, run_ts timestamp_ntz, promoted boolean",
    )
    out = [(r.consecutive_rejections, r.feature_review_alert) for r in history.rejection_streaks(runs).orderBy("run_ts").collect()]
    assert out == [(1, False), (2, False), (0, False), (1, False), (2, False), (3, True)]
