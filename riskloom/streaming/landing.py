"""Streaming re-aims of the ingestion path (ST1–ST3).

The reference has no streaming engine: it appends events and recomputes in batch.  These
jobs are the streaming form of the same steps: land every file's rows as they arrive (exactly
once via the checkpoint), and upsert scores per micro-batch.  Landing drops nothing: files hold
weeks of events, so a watermark short enough to bound state would lose late ones.  Copies of
an event go in staging, in batch or as a stream into a table that keeps the newest.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskloom.operators.features import dedupe_newest
from riskloom.plans import sinks
from riskloom.plans.incremental import merge_newest
from riskloom.plans.versions import VersionedTable

CDC_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType(), False),
        T.StructField("event_timestamp", T.TimestampNTZType(), False),
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("event_type", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("membership_tier", T.StringType()),
        T.StructField("monthly_transaction", T.DoubleType()),
        T.StructField("payment_status", T.StringType()),
        T.StructField("payment_attempts_last_30d", T.LongType()),
        T.StructField("engagement_score", T.DoubleType()),
        T.StructField("member_since_days", T.LongType()),
        T.StructField("contact_requests_last_30d", T.LongType()),
        T.StructField("churned", T.BooleanType()),
        T.StructField("channel", T.StringType()),
        T.StructField("anomaly_injected", T.BooleanType()),
    ]
)
def event_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream over parquet files landing in ``source_dir`` (explicit schema, no inference)."""
    r = spark.readStream.schema(CDC_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(source_dir)


STATE_TTL = dt.timedelta(days=7)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# Fixed value: event ids are dealt by their hash over so many keys of state, so that a batch calls the state store a few times
# a key and not a few times an event.  A checkpoint holds to the number that it began with.
STATE_KEYS = 2048
STATE_KEY = "_state_key"
EPOCH, MICROSECOND = dt.datetime(1970, 1, 1), dt.timedelta(microseconds=1)
NO_TIME = -(1 << 63)
HELD = [("id", "<i8"), ("at", "<i8"), ("seen", "<i8")]  # event id, time of its newest copy, when that copy came


def state_key() -> Column:
    """Of an event; those without an id have a key of their own."""
    return F.when(F.col("event_id").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("event_id"), F.lit(STATE_KEYS))).cast("int")


def _micros(at: dt.datetime | None) -> int:
    """A row without a time is older than any other."""
    return NO_TIME if at is None else (at - EPOCH) // MICROSECOND


class NewestCopy(StatefulProcessor):
    """Per event id the time of the newest copy so far, kept for a while after its last copy; rows that are no older
    than it pass (which of equally new ones counts is for the table to say).  The ids of a state key are held as one
    sorted array, read and written once a batch."""

    def __init__(self, ttl: dt.timedelta):
        self.ttl = int(ttl.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "held binary", self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        held = np.frombuffer(self.newest.get()[0], HELD) if self.newest.exists() else np.empty(0, HELD)
        held = held[held["seen"] + self.ttl > now]
        best: dict[int | None, tuple[int, list[Row]]] = {}
        for row in rows:
            at = _micros(row.event_timestamp)
            found = best.get(row.event_id)
            if found is None or at > found[0]:
                best[row.event_id] = (at, [row])
            elif at == found[0]:
                found[1].append(row)
        new = np.array([(i or 0, at, now) for i, (at, _) in best.items()], HELD)
        if len(held):
            place = np.minimum(np.searchsorted(held["id"], new["id"]), len(held) - 1)
            passes = (held["id"][place] != new["id"]) | (new["at"] >= held["at"][place])
        else:
            passes = np.ones(len(new), bool)
        if passes.any():
            new = new[passes]
            rest = held[~np.isin(held["id"], new["id"])]
            both = np.concatenate([rest, new])
            self.newest.update((both[np.argsort(both["id"])].tobytes(),))
            for (_, found), passed in zip(best.values(), passes.tolist(), strict=True):
                if passed:
                    yield from found

    def close(self) -> None:
        pass


def newest_copies(events: DataFrame, ttl: dt.timedelta = STATE_TTL) -> DataFrame:
    """ST2: the stream without copies that are older than one already seen.  Nothing is late here: state is bounded by
    its time to live, not by a watermark, and a copy that comes after that passes again.  So the result is for a table that
    keeps the newest itself; the state only spares it the bulk of the replays."""
    keyed = events.withColumn(STATE_KEY, state_key())
    return keyed.groupBy(STATE_KEY).transformWithState(NewestCopy(ttl), keyed.schema, "Update", "ProcessingTime").drop(STATE_KEY)


def land_newest(events: DataFrame, table_dir: str, checkpoint_dir: str, ttl: dt.timedelta = STATE_TTL):
    """ST2: one row, the newest, per event id in a published table partitioned by event day; each batch
    rewrites only the days it touches, and counts once."""
    spark = events.sparkSession
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        table = VersionedTable(batch.sparkSession, table_dir)
        writer = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint_dir
        if table.done(writer) < batch_id:
            fresh = dedupe_newest(batch).persist()  # read several times; the state is gone through once
            try:
                merge_newest(table, fresh, batch=(writer, batch_id))
            finally:
                fresh.unpersist()

    spark.conf.set(setting, ROCKSDB)  # the state of transformWithState lives there
    try:
        q = newest_copies(events, ttl).writeStream.foreachBatch(merge_batch).outputMode("update").option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()
    finally:
        spark.conf.set(setting, before) if before else spark.conf.unset(setting)
    while q.isActive:  # state with a time to live asks for batches without end: the first without rows is the last
        if q.lastProgress is not None and not q.lastProgress["numInputRows"]:
            q.stop()
        else:
            q.awaitTermination(0.1)
    if q.exception():
        raise q.exception()
    return q


def landed_events(spark: SparkSession, sink_dir: str) -> DataFrame:
    """ST2 in batch: the landed table with one row, the newest, per event id."""
    return dedupe_newest(spark.read.parquet(sink_dir).drop("event_date"))


def land_events(events: DataFrame, sink_dir: str, checkpoint_dir: str):
    """ST1: append to a date-partitioned parquet table; the checkpoint makes a restarted
    job continue where it stopped (exactly-once file sink).  Runs what is available now."""
    q = (
        events.withColumn("event_date", F.to_date("event_timestamp"))
        .writeStream.format("parquet")
        .option("path", sink_dir)
        .option("checkpointLocation", checkpoint_dir)
        .partitionBy("event_date")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q


def merge_scores(table: VersionedTable, keys: list[str], batch: DataFrame, batch_id: int, writer: str) -> int | None:
    """One micro-batch, source wins, published with its number as one version: a batch that ``writer`` has published
    before is skipped, one that died before has left nothing, so each counts exactly once.
    Only the touched partitions are read and written, none of them in place."""
    if table.done(writer) >= batch_id:
        return None
    rest = [c for c in batch.columns if c not in keys and c != "predicted_at"]
    newest = F.max(F.struct("predicted_at", *rest)).alias("_n")  # a key's newest score counts
    batch = batch.groupBy(*keys).agg(newest).select(*keys, "_n.*").select(batch.columns).persist()  # read several times
    try:
        if not table.exists():
            return table.replace(batch, batch=(writer, batch_id))
        dates = [str(r[0]) for r in batch.select("snapshot_date").distinct().collect()]  # touched partitions (few)
        merged = sinks.merge_by_key(table.read(values=dates).select(*batch.columns), batch, keys)
        return table.replace(merged, batch=(writer, batch_id))
    finally:
        batch.unpersist()


def upsert_scores(scores: DataFrame, target_dir: str, checkpoint_dir: str, keys: list[str] = ("customer_id", "snapshot_date")):
    """ST3: per micro-batch, source-wins merge into the date-partitioned prediction table (SNK3).  The
    table's manifest holds the last batch of each query (by the id its checkpoint keeps across restarts)."""

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        writer = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint_dir
        merge_scores(VersionedTable(spark, target_dir), list(keys), batch, batch_id, writer)

    q = scores.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
