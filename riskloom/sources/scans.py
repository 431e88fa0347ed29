"""Snapshot and file scans (SRC2, SRC4–SRC7, SRC10, SRC11)."""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.scalar import as_date
from riskloom.operators.drift import BASELINE_COLUMNS, NULL_BUCKET, NULL_KEY
from riskloom.plans.versions import DEFAULT_PARTITION, VersionedTable


def partition_values(spark: SparkSession, path: str, column: str = "snapshot_date") -> list[str]:
    """Values of a partitioned folder, from its list of subfolders: no file is read."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = (s.getPath().getName() for s in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p))
    values = [unquote(n.removeprefix(f"{column}=")) for n in names if n.startswith(f"{column}=")]
    return sorted(v for v in values if v != DEFAULT_PARTITION)


def latest_partition(table: DataFrame | VersionedTable | str, date_col: str = "snapshot_date", spark: SparkSession | None = None) -> tuple[dt.date | None, DataFrame]:
    """SRC2 / AG10: (newest date, rows of that date), the filter being a literal, so that a partitioned table is pruned
    statically.  The date comes from the table's partition list (a published table's manifest, or the
    subfolders of a path), without a scan; only a bare DataFrame has to be asked for its maximum."""
    if isinstance(table, VersionedTable):
        m = table.manifest()
        newest, rows = (table.newest(m.version), table.read(m.version)) if m else (None, None)
        if rows is None:
            raise FileNotFoundError(f"no published version: {table.path}")
    elif isinstance(table, str):
        spark = spark or SparkSession.getActiveSession()
        values = partition_values(spark, table, date_col)
        newest, rows = max(values, default=None), spark.read.parquet(table)
    else:
        newest, rows = table.agg(F.max(date_col)).first()[0], table
    if newest is None:
        return None, rows.limit(0)
    newest = dt.date.fromisoformat(newest) if isinstance(newest, str) else newest
    return newest, rows.where(F.col(date_col) == F.lit(newest))


def read_split(split_table: DataFrame, snapshot_date, split: str) -> DataFrame:
    """SRC4: one frozen split of one snapshot, without the split bookkeeping columns."""
    return split_table.where((F.col("snapshot_date") == as_date(snapshot_date)) & (F.col("split") == split)).drop(
        "split", "assigned_at"
    )


def resolve_snapshot_dates(models: DataFrame, table: DataFrame, ts_col: str = "create_time", date_col: str = "snapshot_date") -> DataFrame:
    """SRC5, multi-model form: for each model, the newest partition dated on or before the
    model's timestamp; an explicit ``override_date`` column wins when present.

    The partition list is one row per day and the model list one row per model, so the
    inequality join runs on two small tables (broadcast of the partition list).
    """
    parts = table.select(date_col).distinct()
    cand = models.join(F.broadcast(parts), F.col(date_col) <= F.to_date(ts_col), "left")
    keys = [c for c in models.columns]
    out = cand.groupBy(*keys).agg(F.max(date_col).alias("resolved_date"))
    if "override_date" in models.columns:
        out = out.withColumn("resolved_date", F.coalesce(F.col("override_date"), F.col("resolved_date")))
    return out


def require_resolved(resolved: DataFrame) -> DataFrame:
    """SRC5's error when no partition precedes a model (checked on a per-model table)."""
    missing = resolved.where(F.col("resolved_date").isNull()).limit(1).collect()
    if missing:
        raise LookupError(f"no feature partition at or before the model timestamp: {missing[0].asDict()}")
    return resolved


PREDICTION_RECORD = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), True),
        T.StructField(
            "prediction",
            T.StructType([T.StructField("churn_probability", T.DoubleType()), T.StructField("churn_prediction", T.BooleanType())]),
        ),
    ]
)


def read_prediction_shards(spark: SparkSession, directory: str, glob: str = "prediction.results-*") -> DataFrame:
    """SRC6: only files named ``prediction.results-*``; blank lines are skipped by the JSON
    reader; malformed records fail the job; scores must lie in [0, 1]."""
    df = (
        spark.read.schema(PREDICTION_RECORD)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", glob)
        .json(directory)
    )
    p = F.col("prediction.churn_probability")
    # where a record stands: file, block, and order inside the block
    df = df.select("*", "_metadata.file_name", "_metadata.file_block_start").withColumn("_at", F.monotonically_increasing_id())
    return df.select(
        "customer_id",
        F.struct("file_name", "file_block_start", "_at").alias("_place"),
        F.when(p.isNull() | (p < 0) | (p > 1), F.raise_error(F.lit("churn_probability outside [0, 1] or missing"))).otherwise(p).alias("churn_probability"),
        F.col("prediction.churn_prediction").alias("churn_prediction"),
    )


# The fields of a frozen distribution in the side-car document.  ``type`` is categorical, discrete (keys
# are the numbers' text) or numeric; an absent null_rate, monitored or expected_pct marks an older document.
BASELINE_SPEC = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("frequencies", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("bin_edges", T.ArrayType(T.DoubleType())),
        T.StructField("expected_pct", T.ArrayType(T.DoubleType())),
        T.StructField("null_rate", T.DoubleType()),
        T.StructField("monitored", T.BooleanType()),
    ]
)
METADATA_SCHEMA = T.StructType(
    [
        T.StructField("model_version", T.StringType()),
        T.StructField("feature_names", T.ArrayType(T.StringType())),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("categorical_categories", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
        T.StructField("importances", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("shap_importance", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("baseline_stats", T.MapType(T.StringType(), BASELINE_SPEC)),
        T.StructField("training_snapshot_date", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("trained_at", T.StringType()),
    ]
)


def read_model_metadata(spark: SparkSession, path: str) -> DataFrame:
    """SRC7: the model side-car document; unknown fields are ignored (tolerant), absent
    optional fields read as NULL."""
    return spark.read.schema(METADATA_SCHEMA).option("multiLine", True).option("allowNonNumericNumbers", True).json(path)


def baseline_of(metadata: DataFrame) -> DataFrame:
    """SRC7: the bucket table (BASELINE_COLUMNS) of a side-car document, as a drift run takes it.

    An older numeric spec without proportions gets buckets with a NULL share, one without null_rate no null bucket.
    """
    spec = metadata.select("row_count", F.explode("baseline_stats").alias("feature", "s")).select("feature", "s.*", F.col("row_count").alias("n_rows"))
    slot = lambda pos, key, value, lo, hi, expected: F.struct(
        pos.cast("int").alias("bucket"), key.cast("string").alias("bucket_key"), value.cast("double").alias("bucket_value"), lo.cast("double").alias("lo"), hi.cast("double").alias("hi"), expected.cast("double").alias("expected")
    )
    none = F.lit(None)
    pairs = F.map_entries(F.coalesce("frequencies", F.create_map().cast("map<string,double>")))
    counted = F.transform(
        pairs,
        lambda p, i: slot(i + 1, F.when(F.col("type") == "categorical", p["key"]), F.when(F.col("type") == "discrete", p["key"]), none, none, p["value"]),
    )
    edges = F.coalesce("bin_edges", F.array().cast("array<double>"))
    lower = F.slice(edges, 1, F.greatest(F.size(edges) - 1, F.lit(0)))
    binned = F.transform(lower, lambda lo, i: slot(i, none, none, lo, F.get(edges, i + 1), F.get(F.col("expected_pct"), i)))
    values = F.when(F.col("type") == "numeric", binned).otherwise(counted)
    missing = F.when(F.col("null_rate").isNotNull(), F.array(slot(F.lit(NULL_BUCKET), F.lit(NULL_KEY), none, none, none, F.col("null_rate")))).otherwise(F.slice(values, 1, 0))
    rows = spec.select("feature", F.col("type").alias("kind"), "null_rate", "monitored", F.size(values).alias("value_cardinality"), "n_rows", F.explode(F.concat(values, missing)).alias("b"))
    return rows.select("feature", "kind", "b.*", "null_rate", "monitored", "value_cardinality", "n_rows").select(*BASELINE_COLUMNS)


def schema_catalog(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """SRC10: (table_name, column_name, data_type, ordinal) from DataFrame schemas (metadata)."""
    rows = [
        (name, f.name, f.dataType.simpleString(), i + 1)
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, ordinal int")


def preview(df: DataFrame, n: int, order_by: list[str] | None = None) -> DataFrame:
    """SRC11: bounded preview; ordered first when it has to be reproducible."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
