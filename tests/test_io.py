"""Sinks and file sources: partition overwrite, schema policy, decision documents,
metadata reading, schema-gap report, trend bounds."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift, explore, quality, risk
from riskloom.plans import sinks
from riskloom.plans.evaluate import scratch_dir
from riskloom.sources import scans


def test_dynamic_partition_overwrite_keeps_other_days(spark):
    path = scratch_dir(spark, "snk1")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    a = spark.createDataFrame([(1, 1.0, d1), (2, 2.0, d2)], "customer_id long, x double, snapshot_date date")
    sinks.overwrite_partitions(a, path)
    b = spark.createDataFrame([(1, 9.0, d2)], "customer_id long, x double, snapshot_date date")
    sinks.overwrite_partitions(b, path, existing=spark.read.parquet(path).select("customer_id", "x", "snapshot_date"))
    out = sorted((r.customer_id, r.x, r.snapshot_date) for r in spark.read.parquet(path).collect())
    assert out == [(1, 1.0, d1), (1, 9.0, d2)]


def test_schema_change_is_refused(spark):
    a = spark.createDataFrame([(1, 1.0)], "id long, x double")
    b = spark.createDataFrame([(1, "1")], "id long, x string")
    with pytest.raises(ValueError):
        sinks.assert_same_schema(b, a)


def test_merge_is_source_wins_and_idempotent(spark):
    t = spark.createDataFrame([(1, 0.1), (2, 0.2)], "customer_id long, p double")
    s = spark.createDataFrame([(2, 0.9), (3, 0.3)], "customer_id long, p double")
    once = sinks.merge_by_key(t, s, ["customer_id"])
    twice = sinks.merge_by_key(once, s, ["customer_id"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, 0.1), (2, 0.9), (3, 0.3)]


def test_merge_refuses_duplicate_source_keys(spark):
    t = spark.createDataFrame([(1, 0.1)], "customer_id long, p double")
    s = spark.createDataFrame([(2, 0.9), (2, 0.3)], "customer_id long, p double")
    with pytest.raises(Exception, match="duplicate key"):
        sinks.merge_by_key(t, s, ["customer_id"]).collect()


def test_decision_document_omits_absent_and_keeps_infinity():
    doc = json.loads(sinks.decision_json({"a": None, "edges": [float("-inf"), 1.0, float("inf")], "nested": {"x": None, "y": 1}}))
    assert doc == {"edges": ["-Infinity", 1.0, "Infinity"], "nested": {"y": 1}}


def test_metadata_reader_is_tolerant(spark):
    d = scratch_dir(spark, "meta")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "metadata.json"), "w") as f:
        json.dump({"model_version": "v1", "feature_names": ["a", "b"], "threshold": 0.4, "future_field": 1}, f, indent=2)
    r = scans.read_model_metadata(spark, d).first()
    assert r.model_version == "v1" and r.feature_names == ["a", "b"] and r.categorical_categories is None


def test_a_drift_run_can_start_from_the_side_car(spark):
    """Baseline to document and back: the same table, the same PSI, also of specs that lack what older ones lack."""
    rng = random.Random(2)
    made = [(rng.gauss(0, 1) if rng.random() > 0.1 else None, float(rng.randint(0, 4)), rng.choice(["a", "b", None])) for _ in range(300)]
    train = spark.createDataFrame(made, "x double, d double, c string")
    live = train.select((F.col("x") * 1.5).alias("x"), "d", F.coalesce("c", F.lit("new")).alias("c"))
    frozen = drift.freeze(drift.build_baseline(train, ["x", "d"], ["c"]))
    stats = sinks.baseline_stats(frozen)

    def read(stats):
        d = scratch_dir(spark, "meta")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, "metadata.json"), "w") as f:
            f.write(sinks.decision_json({"model_version": "v1", "row_count": 300, "baseline_stats": stats}, sort_keys=False))
        return scans.baseline_of(scans.read_model_metadata(spark, d))

    again = read(stats)
    key = lambda df: sorted(map(str, df.collect()))
    assert again.dtypes == frozen.dtypes and key(again) == key(frozen)
    assert key(drift.psi_table(again, live, ["x", "d"], ["c"])) == key(drift.psi_table(frozen, live, ["x", "d"], ["c"]))
    legacy = drift.freeze(drift.build_baseline(train, ["x", "d"], ["c"], track_nulls=False))
    assert key(drift.psi_table(read(sinks.baseline_stats(legacy)), live, ["x", "d"], ["c"])) == key(drift.psi_table(legacy, live, ["x", "d"], ["c"]))
    del stats["x"]["expected_pct"], stats["x"]["monitored"]
    bare = {r.feature: r for r in drift.psi_table(read(stats), live, ["x", "d"], ["c"]).collect()}
    assert not bare["x"].monitored and bare["c"].monitored


def test_prediction_shards_only_matching_files_and_range_checked(spark):
    d = scratch_dir(spark, "shards")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "prediction.results-00000"), "w") as f:
        f.write('{"customer_id": "1", "prediction": {"churn_probability": 0.3, "churn_prediction": false}}\n\n')
    with open(os.path.join(d, "other.txt"), "w") as f:
        f.write('{"customer_id": "2", "prediction": {"churn_probability": 7.0}}\n')
    rows = scans.read_prediction_shards(spark, d).collect()
    assert [(r.customer_id, r.churn_probability) for r in rows] == [("1", 0.3)]


def test_raw_vs_engineered_gap_report(spark):
    raw = spark.createDataFrame([], "event_id long, channel string, region string")
    eng = spark.createDataFrame([], "region string, preferred_channel string")
    out = {r.raw_field: r.captured_as for r in explore.raw_vs_engineered(spark, raw, eng, {"channel": "preferred_channel, the most frequent"}).collect()}
    assert set(out) == {"event_id", "channel"} and out["channel"].startswith("preferred_channel")


def test_trend_bounds(spark):
    t = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 10, 2, 1, 0.3, 0.2, 1), (dt.date(2024, 1, 2), 10, 2, 1, 1.3, None, 0), (dt.date(2024, 1, 3), None, 2, 1, 0.2, 1.5, 1)],
        "snapshot_date date, customers_scored long, predicted_churners long, high_risk_customers long, "
        "mean_churn_probability double, predicted_churn_rate double, model_versions_used long",
    )
    bad = {(r.snapshot_date.day, r.column_name) for r in quality.trend_violations(t).collect()}
    assert bad == {(3, "predicted_churn_rate"), (3, "customers_scored")}
    with pytest.raises(quality.MartContractError):
        quality.validated_trend(t)
    good = t.where(F.dayofmonth("snapshot_date") < 3).orderBy(F.desc("snapshot_date"))
    assert [r.snapshot_date.day for r in quality.validated_trend(good).collect()] == [1, 2]
    with pytest.raises(quality.MartContractError):
        quality.require_columns(t)


def test_indicator_text(spark):
    ind = spark.createDataFrame(
        [("payment_failure_rate_30d", 0.5, 0.2), ("avg_engagement_30d", 0.1, 0.4), ("days_since_last_successful_payment", None, 5.0)],
        "feature string, value double, cohort double",
    )
    t = {r.feature: r.detail for r in risk.indicator_text(ind).collect()}
    assert t["payment_failure_rate_30d"] == "2.5× the cohort median of 20%"
    assert t["avg_engagement_30d"] == "4.0× below the cohort median of 0.4"
    assert t["days_since_last_successful_payment"] == "never recorded a successful payment"
