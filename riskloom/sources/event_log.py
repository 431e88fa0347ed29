"""The customer activity log (CDC) derived from the driver's tables.

The driver ships TPC-H-style tables plus a generic ``events`` stream, not churn events, so
this adapter re-expresses them as the activity log the jobs consume: one row per event with
the row contract of the landing table (event id, UTC timestamp, customer, event type,
region, tier, money, payment outcome, engagement, tenure, contact count, churn flag,
channel, anomaly flag).  Older duplicates of some events are replayed so de-duplication
has work to do, and nulls are introduced the way an upstream source would produce them.

Everything is a column expression over a join of ``events`` with the customer dimension,
so the log grows linearly with the input and is never materialised unless a caller asks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sources.tables import read_table

# The mapping from the driver's generic event types to the activity-log
# vocabulary, and the channel list in the order it is assigned from (user_id + k) % 6.
EVENT_TYPE_MAP = {
    "purchase": "transaction",
    "signup": "membership_renewal",
    "click": "campaign_action",
    "view": "email_engagement",
}
DEFAULT_EVENT_TYPE = "contact_request"
CHANNELS = ["email", "web", "mobile", "direct_mail", "in_person", "phone"]

# One in this many event ids is replayed one hour earlier with a changed amount, like a
# retried ingestion; the newest copy must win in staging.
REPLAY_EVERY = 20

CDC_COLUMNS = [
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
    "anomaly_injected",
]


def customer_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer ⋈ nation ⋈ region → (c_custkey, r_name, c_mktsegment).

    nation (25 rows) and region (5 rows) are fixed-size TPC-H dimensions, so they are
    broadcast; customer scales with the data and is never broadcast by us.
    """
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return (
        customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
        .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
        .select("c_custkey", "r_name", "c_mktsegment")
    )


def _event_type(et: Column) -> Column:
    out = F.lit(DEFAULT_EVENT_TYPE)
    expr = None
    for src, dst in EVENT_TYPE_MAP.items():
        expr = F.when(et == src, dst) if expr is None else expr.when(et == src, dst)
    return expr.otherwise(out)


def _channel(idx: Column) -> Column:
    expr = None
    for i, name in enumerate(CHANNELS):
        expr = F.when(idx == i, name) if expr is None else expr.when(idx == i, name)
    return expr


def activity_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw CDC log (before staging), replays and anomaly rows included."""
    events = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    base = events.join(customer_dimension(spark, sf_dir), events.user_id == F.col("c_custkey")).select(
        "event_id",
        "ts",
        "user_id",
        F.col("event_type").alias("et"),
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        "r_name",
        "c_mktsegment",
    )
    # One scan: every event emits itself, and a replayed event also emits its older copy
    # (a fan-out of at most 2 rows per event, no second read of the table).
    copies = F.when(F.col("event_id") % REPLAY_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    x = base.withColumn("_rp", F.explode(copies))
    older = F.col("_rp") == 1
    log = x.select(
        "event_id",
        F.when(older, F.col("ts") - F.expr("INTERVAL 1 HOUR")).otherwise(F.col("ts")).alias("ts"),
        "user_id",
        "et",
        F.when(older, F.col("value") + 1000).otherwise(F.col("value")).alias("value"),
        "k",
        "r_name",
        "c_mktsegment",
    )
    k, uid = F.col("k"), F.col("user_id")
    return log.select(
        F.col("event_id"),
        F.col("ts").alias("event_timestamp"),
        uid.alias("customer_id"),
        _event_type(F.col("et")).alias("event_type"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("membership_tier"),
        F.when(k % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("monthly_transaction"),
        F.when(uid % 12 == 5, F.when(k % 2 == 0, "failed").otherwise("pending"))
        .when(k % 3 == 0, "success")
        .when(k % 3 == 1, "failed")
        .otherwise("pending")
        .alias("payment_status"),
        F.when(k % 13 == 0, F.lit(None).cast("long")).otherwise((k % 7).cast("long")).alias("payment_attempts_last_30d"),
        F.when(uid % 3 == 0, F.lit(None).cast("double")).otherwise(k / F.lit(100.0)).alias("engagement_score"),
        F.when(uid % 33 == 0, F.lit(None).cast("long")).otherwise(F.lit(100) + uid).alias("member_since_days"),
        F.when(k % 11 == 0, F.lit(None).cast("long")).otherwise((k % 5).cast("long")).alias("contact_requests_last_30d"),
        ((uid + k) % 4 == 0).alias("churned"),
        _channel((uid + k) % 6).alias("channel"),
        F.when(k == 9, F.lit(True)).when(k == 10, F.lit(None).cast("boolean")).otherwise(F.lit(False)).alias(
            "anomaly_injected"
        ),
    )


def with_raw_payload(log: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """PRJ13: the row serialised as its raw JSON payload (NULL fields omitted)."""
    cols = cols or [c for c in log.columns if c != "raw_payload"]
    return log.withColumn("raw_payload", F.to_json(F.struct(*[F.col(c) for c in cols])))


def churned_customers(log: DataFrame) -> DataFrame:
    """AG11: distinct customers whose events carry the churn flag."""
    return log.where(F.col("churned")).select("customer_id").distinct()


def active_pool(pool: DataFrame, log: DataFrame, key: str = "customer_id") -> DataFrame:
    """JN6: the customer pool minus customers already in the absorbing (churned) state."""
    return pool.join(churned_customers(log).withColumnRenamed("customer_id", key), key, "left_anti")
