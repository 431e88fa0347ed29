"""Incremental feature states against the full rebuild, with rows that come late."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.operators import features as feat
from riskloom.plans import incremental
from riskloom.plans.evaluate import scratch_dir
from riskloom.plans.incremental import FeatureStates
from riskloom.sources.event_log import activity_log

from .conftest import SF_SMALL

DATES = ["2024-01-10", "2024-01-30", "2024-06-20"]


def same(a, b):
    key = lambda rows: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)
    return key(a.collect()) == key(b.collect())


@pytest.fixture(scope="module")
def log(spark):
    raw = activity_log(spark, SF_SMALL)
    # some events lie months back, so that whole months are rolled up
    shift = F.when(F.col("customer_id") % 4 == 0, F.expr("INTERVAL 200 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    rows = raw.withColumn("event_timestamp", F.col("event_timestamp") - shift).collect()
    return spark.createDataFrame(rows, raw.schema)


def test_equal_to_the_full_rebuild_after_every_batch(spark, log):
    states = FeatureStates(spark, scratch_dir(spark, "states"))
    seen = None
    for arrival in range(3):  # any batch holds rows of any day, and copies of events of other batches
        batch = log.where(F.pmod(F.xxhash64("event_id", "event_timestamp"), F.lit(3)) == arrival)
        states.add(batch)
        seen = batch if seen is None else seen.unionByName(batch)
        for d in DATES if arrival == 2 else DATES[:1]:
            assert same(states.snapshot(d), feat.feature_snapshot(feat.staging(seen), d))
    for d in DATES[:2]:
        assert same(states.snapshot(d, replay=True), feat.feature_snapshot(feat.staging(seen), d, replay=True))


def event(i, day, customer=1, hour=5, **more):
    row = {"event_id": i, "event_timestamp": dt.datetime.fromisoformat(f"{day} {hour:02d}:00:00"), "customer_id": customer, "event_type": "page_view", "region": "EU", "membership_tier": "friend"}
    row |= {"monthly_transaction": 1.0, "payment_status": "pending", "payment_attempts_last_30d": 1, "engagement_score": None, "member_since_days": 5, "contact_requests_last_30d": 0}
    return row | {"churned": False, "channel": "web", "anomaly_injected": False} | more


def test_late_events_touch_only_their_days(spark, log):
    make = lambda *rows: spark.createDataFrame([tuple(r[c] for c in log.columns) for r in rows], log.schema)
    states = FeatureStates(spark, scratch_dir(spark, "states"))
    states.add(make(event(1, "2024-01-05"), event(2, "2024-01-06"), event(3, "2024-02-07", customer=2), event(4, "2023-06-07", customer=2)))
    before = (states.days.manifest().parts, states.months.manifest().parts)
    assert states.add(make(event(5, "2024-01-06", channel=None), event(6, "2024-01-08"))) == ["2024-01-06", "2024-01-08"]
    days, months = states.days.manifest().parts, states.months.manifest().parts
    assert {d for d in days if before[0].get(d) != days[d]} == {"2024-01-06", "2024-01-08"}
    assert {m for m in months if before[1].get(m) != months[m]} == {"2024-01-01"}
    # a newer copy moves event 1 to the next day: both days change, the older one goes
    assert states.add(make(event(1, "2024-01-06", hour=9, monthly_transaction=7.0))) == ["2024-01-05", "2024-01-06"]
    assert "2024-01-05" not in states.days.manifest().parts
    # an older copy changes nothing that is seen
    rows = states.snapshot("2024-02-10").collect()
    states.add(make(event(1, "2024-01-02")))
    assert sorted(states.snapshot("2024-02-10").collect()) == sorted(rows)
    one = next(r for r in rows if r.customer_id == 1)
    assert (one.total_events, one.preferred_channel, one.avg_transaction_90d, one.days_since_last_successful_payment) == (4, "web", 2.5, None)
    assert states.add(make()) == []


def test_copies_are_looked_for_within_the_promised_days(spark, log, monkeypatch):
    make = lambda *rows: spark.createDataFrame([tuple(r[c] for c in log.columns) for r in rows], log.schema)
    states = FeatureStates(spark, scratch_dir(spark, "states"))
    states.add(make(event(1, "2024-01-05"), event(2, "2024-03-06")))
    read = []
    whole = states.events.read
    monkeypatch.setattr(states.events, "read", lambda version=None, values=None: read.append(values) or whole(version, values))
    assert states.add(make(event(1, "2024-01-06")), copy_days=3) == ["2024-01-05", "2024-01-06"]
    assert all("2024-03-06" not in v for v in read)


def test_a_run_that_died_between_the_tables_goes_on(spark, log, monkeypatch):
    make = lambda *rows: spark.createDataFrame([tuple(r[c] for c in log.columns) for r in rows], log.schema)
    states = FeatureStates(spark, scratch_dir(spark, "states"))
    states.add(make(event(1, "2024-01-05")))

    def dies(_):
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental, "month_states", dies)
    with pytest.raises(RuntimeError):
        states.add(make(event(2, "2024-01-06"), event(3, "2023-01-06")))
    monkeypatch.undo()
    assert states.refresh() == [] and states.months.partitions() == ["2023-01-01", "2024-01-01"]
    assert states.snapshot("2024-02-10").first().total_events == 3
