"""Writers and table maintenance (SNK1–SNK11).

Tables that have readers are published as versions (:mod:`riskloom.plans.versions`): a write is seen whole or not
at all.  The plain writers here serve files that one job hands to the next.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scalar import as_date, ntz_literal
from riskloom.operators.drift import NULL_BUCKET
from riskloom.plans.versions import DEFAULT_PARTITION, VersionedTable


def assert_same_schema(df: DataFrame, existing: DataFrame | None) -> None:
    """SNK1's ``on_schema_change='fail'``: refuse to write a different column set/types."""
    if existing is None:
        return
    a = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    b = [(f.name, f.dataType.simpleString()) for f in existing.schema.fields]
    if a != b:
        raise ValueError(f"schema change refused: {a} != {b}")


def overwrite_partitions(df: DataFrame, path: str, partition_col: str = "snapshot_date", existing: DataFrame | None = None) -> None:
    """SNK1/SNK2: replace only the partitions present in ``df`` (dynamic overwrite)."""
    assert_same_schema(df, existing)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


CLUSTER_SAMPLE = 10_000  # rows drawn to cut each key's values into ranges: layout only
CLUSTER_BITS = 6  # of each key in the interleaved number


def _ordinal(key: str, cuts: list) -> Column:
    """In which of the ranges that ``cuts`` part a value lies, spread over all ``CLUSTER_BITS``; nulls first."""
    if not cuts:
        return F.lit(0)
    bounds = F.array(*[F.lit(c) for c in cuts])
    place = F.when(F.col(key).isNull(), 0).otherwise(F.size(F.filter(bounds, lambda b: b <= F.col(key))))
    return F.floor(place * (1 << CLUSTER_BITS) / (len(cuts) + 1)).cast("int")


def clustered(df: DataFrame, keys: list[str], partitions: int | None = None, interleave: bool = False) -> DataFrame:
    """SNK11: range-partition by the keys and sort inside files, so that each file spans a narrow range of them and
    parquet's minima and maxima skip the others.

    In order of the keys a lookup by the first one reads few row groups and one by a later key all of them;
    with ``interleave`` the order is by the interleaved bits of all keys' ranges, which serves each alone.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not interleave:
        return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    rows = df.select(*keys).where(F.rand(7) < F.least(F.lit(1.0), F.lit(float(CLUSTER_SAMPLE)) / F.greatest(df.agg(F.count(F.lit(1))).scalar(), F.lit(1))))
    drawn = rows.limit(2 * CLUSTER_SAMPLE).collect()
    z = F.lit(0).cast("long")
    for at, key in enumerate(keys):
        values = sorted(r[key] for r in drawn if r[key] is not None)
        steps = (1 << CLUSTER_BITS) - 1
        cuts = sorted({values[len(values) * k // (steps + 1)] for k in range(1, steps + 1)}) if values else []
        place = _ordinal(key, cuts)
        for bit in range(CLUSTER_BITS):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("long"), bit * len(keys) + len(keys) - 1 - at))
    name = "_z"
    return df.withColumn(name, z).repartitionByRange(n, name, *keys).sortWithinPartitions(name, *keys).drop(name)


def save_bucketed(df: DataFrame, path: str, key: str, buckets: int, partition_col: str | None = None) -> str:
    """A table bucketed and sorted by ``key`` at ``path``, one file a bucket (and partition): tables with the same buckets
    join on the key without an exchange.  Returns the table's name."""
    name = f"bucketed_{uuid.uuid4().hex}"
    w = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path)
    (w.partitionBy(partition_col) if partition_col else w).saveAsTable(name)
    return name


def append(df: DataFrame, path: str, partition_col: str | None = None) -> None:
    """SNK4/SNK5: append; any write error raises and fails the job."""
    w = df.write.mode("append")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """SNK7: full refresh."""
    df.write.mode("overwrite").parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """SNK8: a read model that stays lazy (joins run at read time)."""
    df.createOrReplaceTempView(name)
    return df


def merge_by_key(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """SNK3: source-wins keyed upsert.  Matched keys take the source row (all columns),
    unmatched source rows are inserted, other target rows are kept.

    ``target ⟕anti source`` ∪ ``source``: one shuffle on the keys, no update in place; the
    caller publishes the result as a new version (or overwrites the touched partitions).
    A key that the source holds twice is an error, raised when the result is computed.
    """
    twice = F.raise_error(F.concat(F.lit("duplicate key in the source: "), F.concat_ws("|", *[F.col(k).cast("string") for k in keys])))
    rest = [c for c in source.columns if c not in keys]
    held = F.count(F.lit(1)).alias("_n")
    once = source.groupBy(*keys).agg(held, F.any_value(F.struct(*rest) if rest else F.lit(1)).alias("_v"))
    once = once.withColumn("_n", F.when(F.col("_n") > 1, twice.cast("long")).otherwise(F.col("_n"))).where("_n = 1")
    source = once.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in rest])
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def stamp_scores(scored: DataFrame, model_version: str, predicted_at) -> DataFrame:
    """SNK3's stamping: the model that produced the rows and when they were written."""
    return scored.withColumn("model_version", F.lit(model_version)).withColumn(
        "predicted_at", ntz_literal(predicted_at)
    )


def require_rows(df: DataFrame, what: str = "scored rows") -> None:
    """DQ17: a run that reports success with nothing written is a failure."""
    if not df.limit(1).collect():
        raise RuntimeError(f"run succeeded with no {what}")


NOT_EXPORTED = ("churned", "split", "assigned_at")


def batch_source_export(split_rows: DataFrame, path: str, drop: list[str] = NOT_EXPORTED) -> None:
    """SNK6: the rows to score as newline-delimited JSON, label and bookkeeping removed.
    NULL fields are omitted from each record (as the exporter does)."""
    split_rows.drop(*drop).write.mode("overwrite").json(path)


def prediction_shards(rows: DataFrame, path: str, prefix: str = "prediction.results-") -> None:
    """Scored records as the batch predictor leaves them: JSON lines in ``<prefix><i>-of-<n>`` files.  The
    files get their names when all are written."""
    staged = f"{path.rstrip('/')}/_staged"
    rows.write.mode("overwrite").json(staged)
    spark = rows.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted(s.getPath().getName() for s in fs.listStatus(at(staged)) if s.getPath().getName().startswith("part-"))
    for i, name in enumerate(files):
        if not fs.rename(at(f"{staged}/{name}"), at(f"{path.rstrip('/')}/{prefix}{i:05d}-of-{len(files):05d}")):
            raise OSError(f"could not name {staged}/{name}")
    fs.delete(at(staged), True)


def retention(table: DataFrame, as_of, days: int, date_col: str = "snapshot_date") -> DataFrame:
    """SNK10: rows of partitions still inside the retention window (date ≥ as_of − days)."""
    return table.where(F.col(date_col) >= F.date_sub(as_date(as_of), days))


def expired(values: list[str], as_of, days: int) -> list[str]:
    """The dates (as text) before the retention window."""
    first = dt.date.fromisoformat(str(as_of)) - dt.timedelta(days=days)
    return sorted(v for v in values if dt.date.fromisoformat(v) < first)


def expire_partitions(spark: SparkSession, table: VersionedTable | str, as_of, days: int, date_col: str = "snapshot_date", dry_run: bool = False) -> list[str]:
    """SNK10: drop whole partitions outside the window; returns their dates (``dry_run``: only that).

    No row is read or written: a published table gets a version without them (``vacuum`` deletes the files when no
    kept version names them), of a plain folder the subfolders go, each by one rename out of sight first, so that a
    reader never lists half a partition."""
    if isinstance(table, VersionedTable):
        gone = expired(table.partitions(), as_of, days)
        if gone and not dry_run:
            table.drop(gone)
        return gone
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(table).getFileSystem(spark._jsc.hadoopConfiguration())
    folders = {unquote(n.removeprefix(f"{date_col}=")): n for n in (s.getPath().getName() for s in fs.listStatus(at(table))) if n.startswith(f"{date_col}=")}
    gone = expired([v for v in folders if v != DEFAULT_PARTITION], as_of, days)
    if not dry_run:
        for v in gone:
            hidden = at(f"{table.rstrip('/')}/_expired-{folders[v]}")
            if not fs.rename(at(f"{table.rstrip('/')}/{folders[v]}"), hidden):
                raise OSError(f"could not expire {folders[v]}")
            fs.delete(hidden, True)
    return gone


def baseline_stats(baseline: DataFrame) -> dict[str, dict]:
    """The side-car document's form of a baseline: one spec per feature (the document is one file, so its
    buckets pass through the driver)."""
    out: dict[str, dict] = {}
    for r in sorted(baseline.collect(), key=lambda r: (r.feature, r.bucket)):
        spec = out.setdefault(r.feature, {"type": r.kind, "null_rate": r.null_rate, "monitored": r.monitored})
        if r.bucket == NULL_BUCKET:
            continue
        if r.kind == "numeric":
            spec.setdefault("bin_edges", [r.lo]).append(r.hi)
            if r.expected is not None:
                spec.setdefault("expected_pct", []).append(r.expected)
        else:
            spec.setdefault("frequencies", {})[r.bucket_key if r.kind == "categorical" else str(float(r.bucket_value))] = r.expected
    return out


def decision_json(decision: dict, sort_keys: bool = True) -> str:
    """SNK9: decision document; absent (None) sections omitted, ±inf kept as text."""

    def clean(v):
        if isinstance(v, float) and math.isinf(v):
            return "Infinity" if v > 0 else "-Infinity"
        if isinstance(v, dict):
            return {k: clean(x) for k, x in v.items() if x is not None}
        if isinstance(v, list):
            return [clean(x) for x in v]
        return v

    return json.dumps(clean(decision), sort_keys=sort_keys)
