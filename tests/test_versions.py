"""Published tables: atomic versions, pinned readers, conflicts, batches done once, retention."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from riskloom.plans.evaluate import scratch_dir
from riskloom.plans.versions import VersionedTable, WriteConflict

D = [dt.date(2024, 1, d) for d in range(1, 6)]
KIND = "customer_id long, x double, snapshot_date date"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def table(spark):
    t = VersionedTable(spark, scratch_dir(spark, "versioned"))
    t.replace(spark.createDataFrame([(1, 1.0, D[0]), (2, 2.0, D[1])], KIND))
    return t


def test_only_the_written_partitions_change(spark, table):
    table.replace(spark.createDataFrame([(1, 9.0, D[1]), (3, 3.0, D[2])], KIND))
    assert rows(table.read()) == [(1, 1.0, D[0]), (1, 9.0, D[1]), (3, 3.0, D[2])]
    assert rows(table.read(1)) == [(1, 1.0, D[0]), (2, 2.0, D[1])]
    assert table.partitions() == ["2024-01-01", "2024-01-02", "2024-01-03"] and table.newest() == "2024-01-03" and table.newest(upto="2024-01-02") == "2024-01-02"


def test_a_write_killed_in_the_middle_leaves_the_old_version(spark, table):
    dies = spark.range(0, 100, 1, 10).select("id", F.when(F.col("id") == 95, F.raise_error(F.lit("killed")).cast("double")).otherwise(1.0).alias("x"), F.lit(D[1]).alias("snapshot_date"))
    with pytest.raises(Exception, match="killed"):
        table.replace(dies.withColumnRenamed("id", "customer_id"))
    assert rows(table.read()) == [(1, 1.0, D[0]), (2, 2.0, D[1])] and table.versions() == [1]


def test_a_write_that_dies_before_it_is_published_is_not_seen(spark, table, monkeypatch):
    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(VersionedTable, "_publish", dies)
    with pytest.raises(KeyboardInterrupt):
        table.replace(spark.createDataFrame([(7, 7.0, D[0])], KIND))
    monkeypatch.undo()
    assert rows(table.read()) == [(1, 1.0, D[0]), (2, 2.0, D[1])]
    left = table.vacuum(dry_run=True)
    assert len(left) == 1 and os.path.exists(f"{table.path}/data/{left[0]}")
    assert table.vacuum() == left and not os.path.exists(f"{table.path}/data/{left[0]}")
    assert rows(table.read()) == [(1, 1.0, D[0]), (2, 2.0, D[1])]


def test_readers_stay_with_their_version(spark, table):
    before = table.read()
    table.refresh(spark.createDataFrame([(8, 8.0, D[4])], KIND), "snapshot_date")
    table.drop([D[4]])
    assert rows(before) == [(1, 1.0, D[0]), (2, 2.0, D[1])]
    assert rows(table.read()) == [] and table.newest() is None


def test_another_schema_is_refused(spark, table):
    with pytest.raises(ValueError, match="schema change refused"):
        table.replace(spark.createDataFrame([(1, "1", D[0])], "customer_id long, x string, snapshot_date date"))
    with pytest.raises(ValueError, match="schema change refused"):
        table.append(spark.createDataFrame([(1, 1.0, D[0])], KIND))


def test_of_two_writers_one_is_refused(spark, table):
    m = table.manifest()
    df = spark.createDataFrame([(5, 5.0, D[3])], KIND)
    got, gate = [], threading.Barrier(2)

    def publish():
        parts = m.parts | table._write(df, "snapshot_date")
        gate.wait()
        try:
            got.append(table._publish(m, m.struct(), m.column, parts, None))
        except WriteConflict:
            got.append(None)

    two = [threading.Thread(target=publish) for _ in range(2)]
    [t.start() for t in two]
    [t.join() for t in two]
    assert sorted(got, key=str) == [2, None] and rows(table.read()) == [(1, 1.0, D[0]), (2, 2.0, D[1]), (5, 5.0, D[3])]


def test_appends_odd_values_and_tables_without_partitions(spark):
    t = VersionedTable(spark, scratch_dir(spark, "versioned"))
    assert not t.exists() and t.done("w") == -1
    a = spark.createDataFrame([(1, "a b/c=d%"), (2, None), (3, "é")], "id long, kind string")
    t.append(a, "kind")
    t.append(a, "kind", batch=("w", 4))
    assert sorted(map(str, t.read().collect())) == sorted(map(str, [*a.collect(), *a.collect()])) and t.done("w") == 4
    assert [r.id for r in t.read(values=["a b/c=d%"]).collect()] == [1, 1]
    flat = VersionedTable(spark, scratch_dir(spark, "versioned"))
    flat.refresh(a)
    flat.refresh(a.where("id = 1"))
    assert rows(flat.read()) == [(1, "a b/c=d%")] and rows(flat.read(1).where("kind is not null")) == [(1, "a b/c=d%"), (3, "é")]


def test_newest_partition_is_a_literal_and_no_scan(spark, table, capsys):
    newest = table.newest()
    table.read().where(F.col("snapshot_date") == F.lit(newest).cast("date")).explain()
    plan = capsys.readouterr().out
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "2024-01-02" in filters and "Aggregate" not in plan and "Exchange" not in plan
