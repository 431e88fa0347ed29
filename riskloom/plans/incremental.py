"""Incremental customer features: mergeable partial states per customer and day, rolled up per month.

Three published tables stand behind a snapshot:

* ``events``: the cleaned log with one copy of each event, the newest, partitioned by event day;
* ``days``: per customer and day the sums, counts, channel counts, last payment and newest event;
* ``months``: the same states merged per month.

A batch rewrites only the days of its own events and of older copies that they replace; which days
and months are to be recomputed is read off the manifests, so a run that died between two of the tables
goes on where it stopped.  A snapshot merges the months that lie before its longest window with the days since then: one aggregate
on the customer over states, not events.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scalar import as_date, capped_min, safe_divide
from riskloom.operators import features as feat
from riskloom.plans.versions import VersionedTable

DAY, MONTH = "event_date", "event_month"
SUMS = ["n", "n_failed", "n_campaign", "n_renewal", "sum_transaction", "sum_engagement", "n_engagement", "sum_attempts"]


def day_states(events: DataFrame) -> DataFrame:
    """One row per customer and event day, from de-duplicated raw events."""
    stg = feat.fill_selected(events)
    channel = F.coalesce("channel", F.lit(feat.NO_CHANNEL))
    # a customer's channels of one day: few, counted first so that a busy customer is summed up before the shuffle
    part = stg.groupBy("customer_id", F.to_date("event_timestamp").alias(DAY), channel.alias("channel")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("payment_status") == "failed").alias("n_failed"),
        F.count_if(F.col("event_type") == "campaign_action").alias("n_campaign"),
        F.count_if(F.col("event_type") == "membership_renewal").alias("n_renewal"),
        F.sum("monthly_transaction").alias("sum_transaction"),
        F.sum("engagement_score").alias("sum_engagement"),
        F.count("engagement_score").alias("n_engagement"),
        F.sum("payment_attempts_last_30d").alias("sum_attempts"),
        F.max(F.when(F.col("payment_status") == "success", F.to_date("event_timestamp"))).alias("last_paid"),
        F.max(F.struct("event_timestamp", "event_id", *feat.LATEST_STATE_COLUMNS)).alias("newest"),
    )
    part = part.withColumn("channels", F.array(F.struct("channel", "n")))
    return merge(part, "customer_id", DAY)


def _channel_counts() -> Column:
    """Counts by channel of many such lists (of one customer: channels are few)."""
    pairs = F.flatten(F.collect_list("channels"))
    kinds = F.array_sort(F.array_distinct(F.transform(pairs, lambda p: p["channel"])))
    return F.transform(kinds, lambda c: F.struct(c.alias("channel"), F.aggregate(F.filter(pairs, lambda p: p["channel"] == c), F.lit(0).cast("long"), lambda a, p: a + p["n"]).alias("n")))


def _merged() -> list[Column]:
    return [*[F.sum(c).alias(c) for c in SUMS], F.max("last_paid").alias("last_paid"), _channel_counts().alias("channels"), F.max("newest").alias("newest")]


def merge(states: DataFrame, *keys: str) -> DataFrame:
    return states.groupBy(*keys).agg(*_merged())


def month_states(days: DataFrame) -> DataFrame:
    return merge(days.withColumn(MONTH, F.trunc(DAY, "month")), "customer_id", MONTH)


def roll_up(states: DataFrame, as_of, computed_at: dt.datetime | None = None) -> DataFrame:
    """customer_features from states (with a null ``event_date`` where a state lies before every window)."""
    age = F.datediff(as_date(as_of), F.col(DAY))
    in30, in90, in_act = (F.coalesce(age <= w, F.lit(False)) for w in (feat.SHORT_WINDOW_DAYS, feat.LONG_WINDOW_DAYS, feat.ACTIVITY_WINDOW_DAYS))
    part = lambda w, c: F.sum(F.when(w, F.col(c)))
    count = lambda w, c="n": F.coalesce(part(w, c), F.lit(0))
    most = F.array_min(F.transform(_channel_counts(), lambda p: F.struct((-p["n"]).alias("less"), p["channel"].alias("channel"))))
    out = states.groupBy("customer_id").agg(
        F.max("newest").alias("_ls"),
        safe_divide(part(in30, "sum_transaction"), part(in30, "n")).alias("avg_transaction_30d"),
        safe_divide(part(in90, "sum_transaction"), part(in90, "n")).alias("avg_transaction_90d"),
        safe_divide(part(in30, "n_failed"), part(in30, "n")).alias("payment_failure_rate_30d"),
        safe_divide(part(in90, "n_failed"), part(in90, "n")).alias("payment_failure_rate_90d"),
        part(in_act, "sum_attempts").alias("total_payment_attempts"),
        capped_min(F.datediff(as_date(as_of), F.max("last_paid")), feat.PAYMENT_RECENCY_CAP_DAYS).alias("days_since_last_successful_payment"),
        safe_divide(part(in30, "sum_engagement"), part(in30, "n_engagement")).alias("avg_engagement_30d"),
        safe_divide(part(in90, "sum_engagement"), part(in90, "n_engagement")).alias("avg_engagement_90d"),
        safe_divide(F.sum("n_campaign"), F.sum("n")).alias("campaign_participation_rate"),
        F.nullif(most["channel"], F.lit(feat.NO_CHANNEL)).alias("preferred_channel"),
        F.sum("n").alias("total_events"),
        count(in30).alias("events_last_30d"),
        count(in90).alias("events_last_90d"),
        count(in_act, "n_renewal").alias("renewal_count"),
    )
    latest = [F.col(f"_ls.{c}").alias(c) for c in feat.LATEST_STATE_COLUMNS]
    out = out.select("customer_id", *latest, F.col("_ls.event_timestamp").alias("latest_event_ts"), *feat.AGGREGATE_COLUMNS)
    return feat.stamp(out, as_of, computed_at).select(*feat.FEATURE_COLUMNS)


def merge_newest(events: VersionedTable, fresh: DataFrame, copy_days: int | None = None, batch: tuple[str, int] | None = None) -> None:
    """Merge rows into a table of one copy, the newest, per event, partitioned by event day.

    Only the days of the rows and of copies that the table holds of their events are read whole and written; with
    ``copy_days`` copies are looked for no further away than that.  ``fresh`` holds an event once at most.
    """
    fresh = fresh.withColumn(DAY, F.to_date("event_timestamp"))
    if not events.exists():
        events.replace(fresh, DAY, batch=batch)
        return
    own = {str(r[0]) for r in fresh.select(DAY).distinct().collect()}  # days: few
    if not own:
        return
    there = events.partitions()
    if copy_days is not None:
        pad = dt.timedelta(days=copy_days)
        low, high = (dt.date.fromisoformat(f(own)) for f in (min, max))
        there = [d for d in there if low - pad <= dt.date.fromisoformat(d) <= high + pad]
    ids = events.read(values=there).select("event_id", DAY)
    copies = {str(r[0]) for r in ids.join(fresh.select("event_id"), "event_id", "left_semi").select(DAY).distinct().collect()}
    touched = sorted(own | copies)
    held = events.read(values=touched)
    both = feat.dedupe_newest(held.unionByName(fresh.select(held.columns)).drop(DAY))
    events.replace(both.withColumn(DAY, F.to_date("event_timestamp")), DAY, batch=batch, empty=touched)


class FeatureStates:
    """The three tables below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.events, self.days, self.months = (VersionedTable(spark, f"{path}/{t}") for t in ("events", "days", "months"))

    def add(self, log: DataFrame, copy_days: int | None = None) -> list[str]:
        """Add raw log rows, in any order of time; returns the event days that were recomputed.

        A copy of an event may come in any batch and lie on any day; with ``copy_days`` the source promises that copies are
        at most so many days apart, and only those days are searched for them.
        """
        fresh = feat.dedupe_newest(feat.without_anomalies(log).drop("anomaly_injected"))
        merge_newest(self.events, fresh, copy_days)
        return self.refresh()

    def refresh(self) -> list[str]:
        """Bring days and months up to the events: only where folders differ from those last read."""
        changed = self._follow(self.events, self.days, DAY, lambda days: (day_states(self.events.read(values=days)), days))

        def months(days: list[str]) -> tuple[DataFrame, list[str]]:
            whole = sorted({d[:7] + "-01" for d in days})
            inside = [d for d in self.days.partitions() if d[:7] + "-01" in whole]
            return month_states(self.days.read(values=inside)), whole

        self._follow(self.days, self.months, MONTH, months)
        return changed

    @staticmethod
    def _follow(source: VersionedTable, target: VersionedTable, column: str, make) -> list[str]:
        now, seen = source.manifest(), target.done("source")
        if now is None or seen == now.version:
            return []
        before = source.manifest(seen).parts if seen > 0 else {}
        changed = sorted(v for v in {*before, *now.parts} if before.get(v) != now.parts.get(v))
        states, values = make(changed)
        target.replace(states, column, batch=("source", now.version), empty=values)
        return changed

    def snapshot(self, as_of, computed_at: dt.datetime | None = None, replay: bool = False) -> DataFrame:
        """customer_features as of a date; ``replay`` leaves out later events."""
        day = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
        longest = max(feat.LONG_WINDOW_DAYS, feat.ACTIVITY_WINDOW_DAYS)
        first = str((day - dt.timedelta(days=longest)).replace(day=1))
        days = [d for d in self.days.partitions() if d >= first and (not replay or d <= str(day))]
        months = [m for m in self.months.partitions() if m < first]
        recent = self.days.read(values=days)
        old = self.months.read(values=months).drop(MONTH).withColumn(DAY, F.lit(None).cast("date"))
        return roll_up(recent.unionByName(old.select(recent.columns)), as_of, computed_at)
