"""Registered queries: event log staging and the feature snapshot (SRC1, WN1, PRJ1,
AG1–AG8, WN2, JN1, JN2, SRC2, SRC3, PRJ2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.scalar import as_date
from riskloom.operators import features as feat
from riskloom.plans import oracle as O
from riskloom.plans.evaluate import scratch_dir
from riskloom.plans.incremental import FeatureStates
from riskloom.plans.registry import register
from riskloom.plans.versions import VersionedTable
from riskloom.sources import derived, scans
from riskloom.sources.event_log import activity_log

FEATURE_DOUBLES = (
    "avg_transaction_30d",
    "avg_transaction_90d",
    "payment_failure_rate_30d",
    "payment_failure_rate_90d",
    "avg_engagement_30d",
    "avg_engagement_90d",
    "campaign_participation_rate",
)
STG_DOUBLES = ("monthly_transaction", "engagement_score")


@register(
    "src1_clean_activity_log",
    O.with_ctes(
        O.ADAPTER,
        body="SELECT * EXCLUDE (anomaly_injected) FROM cdc WHERE NOT COALESCE(anomaly_injected, FALSE)",
    ),
    doubles=STG_DOUBLES,
)
def src1(spark, sf_dir):
    return feat.without_anomalies(activity_log(spark, sf_dir)).drop("anomaly_injected")


@register("wn1_prj1_staging", O.with_ctes(O.ADAPTER, O.STAGING, body="SELECT * FROM stg"), doubles=STG_DOUBLES)
def wn1_staging(spark, sf_dir):
    return derived.staged_events(spark, sf_dir)


_AGG_COLS = ", ".join(["customer_id", *[c for c in feat.AGGREGATE_COLUMNS]])


@register(
    "ag1_ag8_customer_aggregates",
    O.with_ctes(*O.base_ctes(), body=f"SELECT {_AGG_COLS} FROM features"),
    doubles=FEATURE_DOUBLES,
)
def ag_customer_aggregates(spark, sf_dir):
    return feat.customer_aggregates(derived.staged_events(spark, sf_dir), derived.AS_OF)


@register(
    "wn2_latest_state",
    O.with_ctes(
        *O.base_ctes(),
        body="SELECT customer_id, membership_tier, region, member_since_days, contact_requests_last_30d, "
        "churned, latest_event_ts FROM features",
    ),
)
def wn2_latest_state(spark, sf_dir):
    return feat.latest_state(derived.staged_events(spark, sf_dir))


@register("jn1_feature_snapshot_joined", O.with_ctes(*O.base_ctes(), body="SELECT * FROM features"), doubles=FEATURE_DOUBLES)
def jn1_feature_snapshot_joined(spark, sf_dir):
    return derived.snapshot(spark, sf_dir, fused=False)


@register("customer_features", O.with_ctes(*O.base_ctes(), body="SELECT * FROM features"), doubles=FEATURE_DOUBLES)
def customer_features(spark, sf_dir):
    """Flagship: the daily feature snapshot, one aggregate per customer (fused form)."""
    return derived.snapshot(spark, sf_dir)


@register(
    "ag4_never_paid_customers",
    O.with_ctes(
        *O.base_ctes(),
        body="SELECT customer_id, days_since_last_successful_payment, total_events FROM features "
        "WHERE days_since_last_successful_payment IS NULL",
    ),
)
def ag4_never_paid(spark, sf_dir):
    """T1 guard: customers without a successful payment keep a NULL recency."""
    return derived.snapshot(spark, sf_dir).where(F.col("days_since_last_successful_payment").isNull()).select(
        "customer_id", "days_since_last_successful_payment", "total_events"
    )


@register(
    "feature_history",
    O.with_ctes(O.ADAPTER, O.STAGING, O.history_cte(), body="SELECT * FROM feature_history"),
    doubles=FEATURE_DOUBLES,
)
def feature_history(spark, sf_dir):
    return derived.history(spark, sf_dir)


@register(
    "feature_history_incremental",
    O.with_ctes(O.ADAPTER, O.STAGING, O.history_cte(), body="SELECT * FROM feature_history"),
    doubles=FEATURE_DOUBLES,
)
def feature_history_incremental(spark, sf_dir):
    """The same days from mergeable states: the log arrives in three batches whose rows lie on any day."""
    states = FeatureStates(spark, scratch_dir(spark, "feature-states"))
    log = activity_log(spark, sf_dir)
    for arrival in range(3):
        states.add(log.where(F.pmod(F.xxhash64("event_id", "event_timestamp"), F.lit(3)) == arrival))
    parts = [states.snapshot(d, replay=True) for d in derived.HISTORY_DATES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register(
    "src2_snk1_published_newest",
    O.with_ctes(O.ADAPTER, O.STAGING, O.history_cte(), body="SELECT * FROM feature_history WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM feature_history)"),
    doubles=FEATURE_DOUBLES,
)
def src2_published_newest(spark, sf_dir):
    """Daily partitions are published one after the other, the first again with a correction; the newest is found in the
    manifest and read by its literal date."""
    table = VersionedTable(spark, scratch_dir(spark, "published"))
    history = derived.stored(derived.history(spark, sf_dir))
    for day in [*derived.HISTORY_DATES, derived.HISTORY_DATES[0]]:
        table.replace(history.where(F.col("snapshot_date") == as_date(day)))
    return scans.latest_partition(table)[1]


@register(
    "src3_prj2_current_features",
    O.with_ctes(
        O.ADAPTER,
        O.STAGING,
        O.history_cte(),
        body="SELECT * EXCLUDE (churned, latest_event_ts, feature_computed_at) FROM feature_history "
        "WHERE snapshot_date = (SELECT MAX(snapshot_date) FROM feature_history)",
    ),
    doubles=FEATURE_DOUBLES,
)
def src3_current(spark, sf_dir):
    return feat.current_snapshot(derived.history(spark, sf_dir))


@register(
    "jn6_ag11_active_customer_pool",
    O.with_ctes(
        O.ADAPTER, O.STAGING,
        body="SELECT c_custkey AS customer_id, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT DISTINCT customer_id FROM stg WHERE churned)",
    ),
)
def jn6_active_pool(spark, sf_dir):
    """Customers still eligible to act: the pool minus those already churned."""
    from riskloom.sources.event_log import active_pool
    from riskloom.sources.tables import read_table

    pool = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"]).withColumnRenamed("c_custkey", "customer_id")
    return active_pool(pool, derived.staged_events(spark, sf_dir))


@register("prj13_raw_payload")
def prj13_raw_payload(spark, sf_dir):
    """Each staged event with its JSON payload (engine-specific number formatting, so
    rows-only)."""
    from riskloom.sources.event_log import with_raw_payload

    return with_raw_payload(derived.staged_events(spark, sf_dir)).select("event_id", "raw_payload")
