"""Registered queries: streaming landing, de-duplication and score upserts (ST1–ST3).
Each drives a stream to completion (availableNow) over files derived from the driver tables;
the final table doesn't depend on how the files were cut into batches."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from riskloom.plans import oracle as O
from riskloom.plans.evaluate import scratch_dir
from riskloom.plans.registry import register
from riskloom.plans.versions import VersionedTable
from riskloom.sources import derived as D
from riskloom.sources.event_log import activity_log
from riskloom.streaming import landing


FILES_PER_TRIGGER = 3


@register(
    "st1_st2_stream_landing",
    O.with_ctes(O.ADAPTER, body="SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY event_timestamp DESC) AS rn FROM cdc) WHERE rn = 1"),
    doubles=("monthly_transaction", "engagement_score"),
)
def st1_landing(spark, sf_dir):
    """The activity log lands as files, appended to a date-partitioned table; its newest rows per event."""
    base = scratch_dir(spark, "landing")
    src, sink, ckpt = (os.path.join(base, p) for p in ("incoming", "table", "checkpoint"))
    activity_log(spark, sf_dir).repartition("event_id").write.parquet(src)
    landing.land_events(landing.event_stream(spark, src, FILES_PER_TRIGGER), sink, ckpt)
    return landing.landed_events(spark, sink)


@register(
    "st2_stream_newest",
    O.with_ctes(O.ADAPTER, body="SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY event_timestamp DESC) AS rn FROM cdc) WHERE rn = 1"),
    doubles=("monthly_transaction", "engagement_score"),
)
def st2_newest(spark, sf_dir):
    """The same log as a stream into a table of one copy, the newest, per event."""
    base = scratch_dir(spark, "newest")
    src, table, ckpt = (os.path.join(base, p) for p in ("incoming", "table", "checkpoint"))
    activity_log(spark, sf_dir).repartition("event_timestamp").write.parquet(src)
    landing.land_newest(landing.event_stream(spark, src, FILES_PER_TRIGGER), table, ckpt)
    return VersionedTable(spark, table).read().drop("event_date")


@register(
    "st3_stream_score_upsert",
    O.with_ctes(O.ADAPTER, O.STAGING, O.history_cte(), O.PREDICTIONS,
                body="SELECT * REPLACE (CASE WHEN customer_id % 2 = 0 THEN churn_probability / 2 ELSE churn_probability END AS churn_probability) FROM scored"),
    doubles=("churn_probability",),
)
def st3_upsert(spark, sf_dir):
    """Score files arrive per day; then customers with an even number are scored again, and each micro-batch is
    merged into the prediction table."""
    base = scratch_dir(spark, "scores")
    src, target, ckpt = (os.path.join(base, p) for p in ("incoming", "table", "checkpoint"))
    p = D.stored(D.predictions(spark, sf_dir))
    again = p.where("customer_id % 2 = 0").withColumns({"churn_probability": F.col("churn_probability") / 2, "predicted_at": F.col("predicted_at") + F.expr("INTERVAL 1 HOUR")})
    for rows in (p, again):
        rows.hint("rebalance", "snapshot_date").write.mode("append").partitionBy("snapshot_date").parquet(src)  # not a file of every task for every day
        stream = spark.readStream.schema(p.schema).option("maxFilesPerTrigger", FILES_PER_TRIGGER).parquet(src)
        landing.upsert_scores(stream, target, ckpt)
    out = VersionedTable(spark, target).read()
    return out.withColumn("predicted_at", F.when(F.col("customer_id") % 2 == 0, F.col("predicted_at") - F.expr("INTERVAL 1 HOUR")).otherwise(F.col("predicted_at")))
