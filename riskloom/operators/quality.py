"""Data-quality checks (DQ1–DQ16): schema tests on tables and the snapshot quality gate.

Row-level tests (range, not-null, accepted values) are ``count_if`` columns of a single
aggregate, so any number of them costs one scan and no shuffle; uniqueness is one
``groupBy(keys).count()`` with map-side partial counts.  The snapshot gate compares the
live snapshot against the frozen baseline table (one row per feature) and the feature
table's own partition sizes; its result is a long failures table (empty = pass).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.drift import NULL_BUCKET, SCORE_FEATURE, melt_categorical, melt_numeric

# Tolerances of the gate.
MIN_ROW_RATIO = 0.5
MAX_NULL_RATE_INCREASE = 0.25
RECENT_PARTITIONS = 7


# --------------------------------------------------------------------------------------
# DQ1–DQ4: schema tests
# --------------------------------------------------------------------------------------


def range_violation(c: Column, lo: float, hi: float) -> Column:
    """DQ1 predicate: NULL passes (absence is the not_null test's concern)."""
    return c.isNotNull() & ((c < F.lit(lo)) | (c > F.lit(hi)))


def accepted_range(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    return df.where(range_violation(F.col(col), lo, hi))


def accepted_values(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """DQ4: non-null values outside the domain."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(values))


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """DQ2 / AG12: keys appearing more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def schema_tests(
    df: DataFrame,
    not_null_cols: list[str] = (),
    ranges: dict[str, tuple[float, float]] | None = None,
    domains: dict[str, list[str]] | None = None,
    unique: list[list[str]] = (),
) -> DataFrame:
    """Run every test and report (test, column_name, failures) — one row per test."""
    ranges, domains = ranges or {}, domains or {}
    exprs, labels = [], []
    for c in not_null_cols:
        exprs.append(F.count_if(F.col(c).isNull()))
        labels.append(("not_null", c))
    for c, (lo, hi) in ranges.items():
        exprs.append(F.count_if(range_violation(F.col(c), lo, hi)))
        labels.append(("accepted_range", c))
    for c, vals in domains.items():
        exprs.append(F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(vals)))
        labels.append(("accepted_values", c))
    parts = []
    if exprs:
        row = df.agg(*[e.alias(f"_t{i}") for i, e in enumerate(exprs)])
        stack = row.select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(t).alias("test"), F.lit(c).alias("column_name"), F.col(f"_t{i}").cast("long").alias("failures"))
                        for i, (t, c) in enumerate(labels)
                    ]
                )
            ).alias("r")
        ).select("r.*")
        parts.append(stack)
    for keys in unique:
        dup = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("failures"))
        parts.append(dup.select(F.lit("unique").alias("test"), F.lit("|".join(keys)).alias("column_name"), F.col("failures")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_gate(tests: DataFrame) -> None:
    """DQ5: stop before publishing when any schema test failed (an action on a tiny table)."""
    failed = tests.where(F.col("failures") > 0).collect()
    if failed:
        raise ValueError("data tests failed: " + ", ".join(f"{r.test}({r.column_name})={r.failures}" for r in failed))


# --------------------------------------------------------------------------------------
# DQ6–DQ13: snapshot quality gate against the frozen baseline
# --------------------------------------------------------------------------------------


def recent_partition_sizes(table: DataFrame, before, n: int = RECENT_PARTITIONS, date_col: str = "snapshot_date") -> DataFrame:
    """SL3: row counts of the ``n`` newest partitions strictly before ``before``."""
    from riskloom.functions.scalar import as_date

    return (
        table.where(F.col(date_col) < as_date(before))
        .groupBy(date_col)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col(date_col).desc())
        .limit(n)
    )


def row_volume_check(current_rows: Column, recent: DataFrame, min_row_ratio: float = MIN_ROW_RATIO) -> DataFrame:
    """DQ7 (+AG19): fail when rows / median(recent) < ratio; no history or median ≤ 0 passes."""
    med = recent.agg(F.median(F.col("n").cast("double")).alias("median_recent"))
    ratio = current_rows / F.col("median_recent")
    return med.select(
        F.lit("row_volume").alias("check"),
        F.lit(None).cast("string").alias("feature"),
        ratio.alias("observed"),
        F.lit(min_row_ratio).alias("bound"),
    ).where(F.col("median_recent").isNotNull() & (F.col("median_recent") > 0) & (F.col("observed") < F.lit(min_row_ratio)))


@dataclass(frozen=True)
class Observed:
    """What was seen of a frame while it was written: rows, and per column (nulls, whether it has any value, whether
    it has two different ones)."""

    rows: int
    columns: dict[str, tuple[int, bool, bool]]

    def stats(self, spark: SparkSession) -> DataFrame:
        rows = [(c, self.rows, nulls, 2 if several else int(some)) for c, (nulls, some, several) in self.columns.items()]
        return spark.createDataFrame(rows, "feature string, n long, nulls long, nd int")


def write_observed(df: DataFrame, path: str, numeric_cols: list[str], categorical_cols: list[str]) -> tuple[DataFrame, Observed]:
    """Write ``df`` and observe, in the same pass, what DQ7, DQ10 and DQ11 ask for: the row count and each
    column's nulls, minimum and maximum.  Returns the written table and what was seen."""
    num = [c for c in numeric_cols if c in df.columns]
    cat = [c for c in categorical_cols if c in df.columns]
    # NaN is a missing value, as in melt_numeric
    value = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in num} | {c: F.col(f"`{c}`").cast("string") for c in cat}
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    for k, v in enumerate(value.values()):
        metrics += [F.count_if(v.isNull()).alias(f"null{k}"), F.min(v).alias(f"min{k}"), F.max(v).alias(f"max{k}")]
    df.observe(seen, *metrics).write.mode("overwrite").parquet(path)
    got = seen.get
    columns = {c: (got[f"null{k}"], got[f"min{k}"] is not None, got[f"min{k}"] is not None and got[f"min{k}"] != got[f"max{k}"]) for k, c in enumerate(value)}
    return df.sparkSession.read.schema(df.schema).parquet(path), Observed(got["rows"], columns)


def quality_failures(
    current: DataFrame,
    baseline: DataFrame,
    numeric_cols: list[str],
    categorical_cols: list[str],
    recent_sizes: DataFrame,
    key: str = "customer_id",
    source_columns: list[str] | None = None,
    min_row_ratio: float = MIN_ROW_RATIO,
    max_null_rate_increase: float = MAX_NULL_RATE_INCREASE,
    observed: Observed | None = None,
) -> DataFrame:
    """DQ6: all five assertions, every failure reported: (check, feature, observed, bound).

    ``source_columns`` is what the source returned before any re-alignment (DQ9).  With what
    ``write_observed`` saw of the frame, only the duplicate keys (DQ8) ask for another pass over it.
    """
    source_columns = list(source_columns if source_columns is not None else current.columns)
    n_rows = F.lit(observed.rows) if observed else current.agg(F.count(F.lit(1))).scalar()
    spark = current.sparkSession
    feats = baseline.groupBy("feature").agg(
        F.first("null_rate", ignorenulls=True).alias("b_null_rate"),
        F.max(F.col("null_rate").isNotNull()).alias("tracks_nulls"),
        F.max("value_cardinality").alias("value_cardinality"),
    )
    fails = []
    # DQ7 row volume.
    fails.append(row_volume_check(n_rows, recent_sizes, min_row_ratio))
    # DQ8 duplicate keys (AG12): one grouped count.
    dups = duplicate_keys(current, [key]).agg(F.count(F.lit(1)).alias("d"))
    fails.append(
        dups.where(F.col("d") > 0).select(
            F.lit("duplicate_keys").alias("check"), F.lit(None).cast("string").alias("feature"),
            F.col("d").cast("double").alias("observed"), F.lit(0.0).alias("bound"),
        )
    )
    # DQ9 missing columns, on the source columns (metadata only); score pseudo-feature excluded.
    present = spark.createDataFrame([(c,) for c in source_columns] or [("",)], "feature string")
    missing = feats.where(F.col("feature") != SCORE_FEATURE).join(present, "feature", "left_anti")
    fails.append(missing.select(F.lit("missing_columns").alias("check"), "feature", F.lit(None).cast("double").alias("observed"), F.lit(None).cast("double").alias("bound")))
    # DQ10/DQ11 per feature: null rate and distinct count of the live columns, one job.
    num = [c for c in numeric_cols if c in current.columns]
    cat = [c for c in categorical_cols if c in current.columns]
    stats = None
    if observed:
        stats = observed.stats(spark).where(F.col("feature").isin(num + cat))
    elif num or cat:
        melted = [melt_numeric(current, num).select("feature", F.col("value").cast("string").alias("value"))] if num else []
        melted += [melt_categorical(current, cat)] if cat else []
        stats = reduce(DataFrame.unionByName, melted).groupBy("feature").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("value").isNull()).alias("nulls"),
            F.when(F.min("value") < F.max("value"), 2).otherwise(F.count_if(F.col("value").isNotNull()).cast("boolean").cast("int")).alias("nd"),
        )
    if stats is not None:
        j = stats.join(F.broadcast(feats), "feature")
        cur_null = F.when(F.col("n") > 0, F.col("nulls") / F.col("n")).otherwise(F.lit(0.0))
        fails.append(
            j.where(F.col("tracks_nulls") & ((cur_null - F.col("b_null_rate")) > F.lit(max_null_rate_increase))).select(
                F.lit("null_rate").alias("check"), "feature", cur_null.alias("observed"), F.col("b_null_rate").alias("bound")
            )
        )
        fails.append(
            j.where((F.col("n") > 0) & (F.col("value_cardinality") > 1) & (F.col("nd") <= 1)).select(
                F.lit("collapsed_column").alias("check"), "feature", F.col("nd").cast("double").alias("observed"),
                F.col("value_cardinality").cast("double").alias("bound"),
            )
        )
    out = fails[0]
    for f in fails[1:]:
        out = out.unionByName(f)
    return out


def probability_in_range(scores: DataFrame, col: str = "churn_probability") -> DataFrame:
    """DQ16: scores outside [0, 1]."""
    return accepted_range(scores, col, 0.0, 1.0)


# The columns the read model's two marts must have (type, nullable, bounds).
RISK_MART_COLUMNS = (
    "customer_id", "churn_probability", "model_version", "snapshot_date",
    "membership_tier", "region", "preferred_channel", "member_since_days",
    "monthly_value",
    "payment_failure_rate_30d", "days_since_last_successful_payment", "contact_requests_last_30d",
    "avg_engagement_30d", "events_last_30d", "campaign_participation_rate",
)
TREND_BOUNDS = {
    "snapshot_date": (False, None, None),
    "customers_scored": (False, 0, None),
    "high_risk_customers": (False, 0, None),
    "predicted_churn_rate": (True, 0.0, 1.0),
    "model_versions_used": (False, 0, None),
}


class MartContractError(ValueError):
    """A mart and its reader have diverged."""


def trend_violations(trend: DataFrame) -> DataFrame:
    """DQ15: (snapshot_date, column_name, value) of each cell of the daily trend that breaks
    the contract: NULL in a required column, or a value outside its bounds."""
    cells = []
    for c, (nullable, lo, hi) in TREND_BOUNDS.items():
        v = F.col(c).cast("double") if lo is not None else F.lit(None).cast("double")
        bad = F.lit(False) if nullable else F.col(c).isNull()
        if lo is not None:
            bad = bad | F.coalesce((v < lo) | F.isnan(v) | ((v > hi) if hi is not None else F.lit(False)), F.lit(False))
        cells.append(F.when(bad, F.struct(F.lit(c).alias("column_name"), v.alias("value"))))
    broken = F.filter(F.array(*cells), lambda x: x.isNotNull())
    return trend.select("snapshot_date", F.explode(broken).alias("b")).select("snapshot_date", "b.*")


def require_columns(df: DataFrame, required: tuple[str, ...] = RISK_MART_COLUMNS, source: str = "mart") -> DataFrame:
    """DQ14: raise unless every column the reader needs is there (metadata only; no job runs).
    A frame without any columns means that nothing is scored yet, and passes."""
    missing = sorted(set(required) - set(df.columns)) if df.columns else []
    if missing:
        raise MartContractError(f"{source} lacks column(s): {', '.join(missing)}")
    return df


def validated_trend(trend: DataFrame, source: str = "trend") -> DataFrame:
    """SL6: the trend in date order, after DQ14 and DQ15 (one row per scored day)."""
    require_columns(trend, tuple(TREND_BOUNDS), source)
    if trend.columns and not (bad := trend_violations(trend)).isEmpty():
        raise MartContractError(f"{source} has rows outside its contract, such as {bad.first().asDict()}")
    return trend.orderBy("snapshot_date")
