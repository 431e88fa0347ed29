"""Feature snapshot: staging, per-customer aggregates, latest state, one row per customer.

Shuffle plan of :func:`feature_snapshot` (``fused=True``, the production form):

1. staging de-duplicates on ``event_id`` with a partial (map-side) ``max(struct)``
   aggregate: one exchange on ``event_id``;
2. every feature column — windowed averages, conditional counts, capped recency, the
   channel mode *and* the latest-state columns — is one aggregate grouped by
   ``customer_id``: one exchange on ``customer_id``.

The reference computes latest state and aggregates as two queries over the same staged
rows and left-joins them on ``customer_id``.  Both sides group the same input by the same
key, so their key sets are identical and the join is a 1:1 zip; fusing them removes a
second aggregation and a join.  The two-sided form is kept (``fused=False``) as JN1 and is
checked to give the same rows.  All aggregates are partial-aggregation capable, so a
customer holding a third of all events is reduced map-side before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalar import as_date, capped_min, days_since, safe_divide

# Fixed values of the feature definitions.
PAYMENT_RECENCY_CAP_DAYS = 30
ACTIVITY_WINDOW_DAYS = 90
SHORT_WINDOW_DAYS = 30
LONG_WINDOW_DAYS = 90
TIER_VALUES = ["supporter", "friend", "champion", "guardian"]
CATEGORICAL_COLS = ["membership_tier", "region", "preferred_channel"]
ID_COLS = ["customer_id", "snapshot_date"]
TARGET_COL = "churned"

STAGED_COLUMNS = [
    "event_id",
    "event_timestamp",
    "customer_id",
    "event_type",
    "region",
    "membership_tier",
    "monthly_transaction",
    "payment_status",
    "payment_attempts_last_30d",
    "engagement_score",
    "member_since_days",
    "contact_requests_last_30d",
    "churned",
    "channel",
]

FEATURE_COLUMNS = [
    "customer_id",
    "membership_tier",
    "region",
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
    "preferred_channel",
    "total_events",
    "events_last_30d",
    "events_last_90d",
    "renewal_count",
    "latest_event_ts",
    "feature_computed_at",
    "churned",
    "snapshot_date",
]

AGGREGATE_COLUMNS = FEATURE_COLUMNS[5:19]
NO_CHANNEL = "\uffff"  # stands for NULL inside the mode and sorts after every channel
LATEST_STATE_COLUMNS = ["membership_tier", "region", "member_since_days", "contact_requests_last_30d", "churned"]


def without_anomalies(log: DataFrame) -> DataFrame:
    """SRC1: drop rows flagged as injected anomalies (NULL flag counts as clean)."""
    return log.where(~F.coalesce(F.col("anomaly_injected"), F.lit(False)))


def dedupe_newest(log: DataFrame, key: str = "event_id", ts: str = "event_timestamp") -> DataFrame:
    """WN1: one row per ``key``, the newest by ``ts``.

    Written as ``max(struct(ts, *rest))`` per key instead of ``row_number`` so Spark runs a
    partial aggregate before the exchange (a hot key does not land whole in one task).  The
    remaining columns break timestamp ties deterministically.
    """
    rest = [c for c in log.columns if c not in (key, ts)]
    newest = F.max(F.struct(F.col(ts), *[F.col(c) for c in rest])).alias("_n")
    return log.groupBy(key).agg(newest).select(key, *[F.col(f"_n.{c}").alias(c) for c in [ts, *rest]])


def staging(log: DataFrame) -> DataFrame:
    """SRC1 + WN1 + PRJ1: clean, de-duplicated events with the selective null fill.

    Four columns are coalesced (amount 0.0, attempts 0, contacts 0, churned FALSE);
    ``engagement_score`` and ``member_since_days`` stay NULL on purpose.
    """
    return fill_selected(dedupe_newest(without_anomalies(log).drop("anomaly_injected")))


def fill_selected(deduped: DataFrame) -> DataFrame:
    """PRJ1: the staged columns, four of them filled."""
    return deduped.select(
        "event_id",
        "event_timestamp",
        "customer_id",
        "event_type",
        "region",
        "membership_tier",
        F.coalesce("monthly_transaction", F.lit(0.0)).alias("monthly_transaction"),
        "payment_status",
        F.coalesce("payment_attempts_last_30d", F.lit(0).cast("long")).alias("payment_attempts_last_30d"),
        "engagement_score",
        "member_since_days",
        F.coalesce("contact_requests_last_30d", F.lit(0).cast("long")).alias("contact_requests_last_30d"),
        F.coalesce("churned", F.lit(False)).alias("churned"),
        "channel",
    )


def _aggregate_exprs(as_of) -> list[Column]:
    """AG1–AG8 over staged events, windows anchored to ``as_of`` (inclusive, T5)."""
    d = days_since(as_of, F.col("event_timestamp"))
    in30, in90 = d <= SHORT_WINDOW_DAYS, d <= LONG_WINDOW_DAYS
    in_act = d <= ACTIVITY_WINDOW_DAYS
    failed = F.col("payment_status") == "failed"
    success = F.col("payment_status") == "success"
    return [
        F.avg(F.when(in30, F.col("monthly_transaction"))).alias("avg_transaction_30d"),
        F.avg(F.when(in90, F.col("monthly_transaction"))).alias("avg_transaction_90d"),
        safe_divide(F.count_if(in30 & failed), F.count_if(in30)).alias("payment_failure_rate_30d"),
        safe_divide(F.count_if(in90 & failed), F.count_if(in90)).alias("payment_failure_rate_90d"),
        F.sum(F.when(in_act, F.col("payment_attempts_last_30d"))).alias("total_payment_attempts"),
        # AG4 + JN2 in one pass: min over success rows only, NULL (never paid) kept.
        capped_min(F.min(F.when(success, d)), PAYMENT_RECENCY_CAP_DAYS).alias("days_since_last_successful_payment"),
        F.avg(F.when(in30, F.col("engagement_score"))).alias("avg_engagement_30d"),
        F.avg(F.when(in90, F.col("engagement_score"))).alias("avg_engagement_90d"),
        safe_divide(F.count_if(F.col("event_type") == "campaign_action"), F.count(F.lit(1))).alias(
            "campaign_participation_rate"
        ),
        # AG6: most frequent channel (bounded map buffer).  A missing channel counts as a value, as in the
        # dialect the feature comes from; ties go to the smallest present value.
        F.nullif(F.mode(F.coalesce("channel", F.lit(NO_CHANNEL)), True), F.lit(NO_CHANNEL)).alias("preferred_channel"),
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(in30).alias("events_last_30d"),
        F.count_if(in90).alias("events_last_90d"),
        F.count_if((F.col("event_type") == "membership_renewal") & in_act).alias("renewal_count"),
    ]


def _latest_state_expr() -> Column:
    """WN2: newest event per customer, ties broken by the larger event_id."""
    return F.max_by(
        F.struct(*[F.col(c) for c in LATEST_STATE_COLUMNS], F.col("event_timestamp").alias("latest_event_ts")),
        F.struct("event_timestamp", "event_id"),
    ).alias("_ls")


def customer_aggregates(stg: DataFrame, as_of) -> DataFrame:
    """int_customer_aggregates: one row per customer with AG1–AG8."""
    return stg.groupBy("customer_id").agg(*_aggregate_exprs(as_of))


def latest_state(stg: DataFrame) -> DataFrame:
    """WN2 as its own grouped aggregate (used by the unfused JN1 form)."""
    return stg.groupBy("customer_id").agg(_latest_state_expr()).select(
        "customer_id", *[F.col(f"_ls.{c}").alias(c) for c in [*LATEST_STATE_COLUMNS, "latest_event_ts"]]
    )


def default_computed_at(as_of) -> dt.datetime:
    d = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
    return dt.datetime(d.year, d.month, d.day, 2, 0, 0)


def stamp(df: DataFrame, as_of, computed_at) -> DataFrame:
    computed_at = computed_at or default_computed_at(as_of)
    # Text literal: a wall-clock UTC stamp that does not depend on the session time zone.
    built = F.lit(computed_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return df.withColumn("feature_computed_at", built).withColumn(
        "snapshot_date", as_date(as_of)
    )


def feature_snapshot(
    stg: DataFrame, as_of, computed_at: dt.datetime | None = None, fused: bool = True, replay: bool = False
) -> DataFrame:
    """customer_features for one snapshot date (JN1 over WN2 and AG1–AG8).

    ``as_of`` and ``computed_at`` are run parameters (PRJ12) so a rerun reproduces the
    partition.  ``replay=True`` restricts the log to events dated on or before ``as_of``
    (rebuilding a past day); by default every staged event counts, as in the reference.
    """
    if replay:
        stg = stg.where(F.to_date("event_timestamp") <= as_date(as_of))
    if fused:
        out = stg.groupBy("customer_id").agg(_latest_state_expr(), *_aggregate_exprs(as_of))
        out = out.select(
            "customer_id",
            *[F.col(f"_ls.{c}").alias(c) for c in [*LATEST_STATE_COLUMNS, "latest_event_ts"]],
            *AGGREGATE_COLUMNS,
        )
    else:
        out = latest_state(stg).join(customer_aggregates(stg, as_of), "customer_id", "left")
    return stamp(out, as_of, computed_at).select(*FEATURE_COLUMNS)


def feature_history(stg: DataFrame, snapshot_dates: list) -> DataFrame:
    """Feature table with one partition per date in ``snapshot_dates``, each rebuilt from
    the log as it stood on that day — in a single pass (a backfill).

    Every staged event is fanned out to the snapshot dates on or after its own date (at
    most ``len(snapshot_dates)`` copies; a bounded fan-out, not a pairing), then one
    aggregate grouped by (customer_id, snapshot_date) computes every partition.  One
    de-duplication exchange and one aggregation exchange in total, however many days.
    """
    dates = F.array(*[as_date(d) for d in snapshot_dates])
    ev_day = F.to_date("event_timestamp")
    x = stg.withColumn("snapshot_date", F.explode(F.filter(dates, lambda d: d >= ev_day)))
    out = x.groupBy("customer_id", "snapshot_date").agg(_latest_state_expr(), *_aggregate_exprs(F.col("snapshot_date")))
    out = out.select(
        "customer_id",
        "snapshot_date",
        *[F.col(f"_ls.{c}").alias(c) for c in [*LATEST_STATE_COLUMNS, "latest_event_ts"]],
        *AGGREGATE_COLUMNS,
    ).withColumn("feature_computed_at", F.col("snapshot_date").cast("timestamp_ntz") + F.expr("INTERVAL 2 HOURS"))
    return out.select(*FEATURE_COLUMNS)


def current_snapshot(features: DataFrame) -> DataFrame:
    """SRC3 + PRJ2: newest partition, minus label and build metadata (scoring input)."""
    newest = features.agg(F.max("snapshot_date").alias("_d"))
    return (
        features.join(F.broadcast(newest), F.col("snapshot_date") == F.col("_d"), "left_semi")
        .drop("churned", "latest_event_ts", "feature_computed_at")
    )
