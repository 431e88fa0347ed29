"""Feature-matrix preparation (PRJ5–PRJ8): label split, frozen levels, inference alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.features import CATEGORICAL_COLS, ID_COLS, TARGET_COL
from riskloom.operators.ordered import BUCKET_COL, range_bucketed, ranked


def feature_names(df: DataFrame) -> list[str]:
    """PRJ5: ordered feature columns (ids and label removed) — schema only."""
    return [c for c in df.columns if c not in (*ID_COLS, TARGET_COL)]


def prepare_features(df: DataFrame, label_col: str = "y") -> DataFrame:
    """PRJ5: feature columns plus the label as 0/1 integer."""
    return df.select(*feature_names(df), F.col(TARGET_COL).cast("int").alias(label_col))


def category_levels(df: DataFrame, cols: list[str] = CATEGORICAL_COLS) -> DataFrame:
    """PRJ7: (column_name, level, code) — sorted distinct non-null levels per column, code
    0-based in sort order.  Levels are ranked in ranges, so a column of many takes many tasks."""
    present = [c for c in cols if c in df.columns]
    m = df.select(*[F.col(c).cast("string").alias(c) for c in present]).unpivot([], present, "column_name", "level")
    lv = range_bucketed(m.where(F.col("level").isNotNull()).distinct(), ["column_name"], "level")
    placed = ranked(lv, ["column_name"], ["level"], F.col(BUCKET_COL))
    return placed.select("column_name", "level", (F.col("_row_number") - 1).cast("int").alias("code"))


def has_any_feature(df: DataFrame, features: list[str]) -> bool:
    """PRJ8: the input must share at least one column name with the feature set (a
    column-name test, not a null test; an empty frame with the right columns passes)."""
    return bool(set(df.columns) & set(features))


def align_to_features(
    df: DataFrame,
    features: list[str],
    levels: DataFrame | None = None,
    numeric_type: T.DataType = T.DoubleType(),
    categorical: list[str] = CATEGORICAL_COLS,
    keep: list[str] = (),
) -> DataFrame:
    """PRJ6: exactly ``features`` in order; missing → NULL; extras dropped; numerics cast
    (ANSI cast raises on bad text); categoricals outside the frozen levels → NULL.

    ``levels`` is the PRJ7 table; each categorical is joined to its own levels, which the planner broadcasts
    when they are few.
    """
    cols = []
    for f in features:
        if f in categorical:
            c = F.col(f).cast("string") if f in df.columns else F.lit(None).cast("string")
        else:
            c = F.col(f).cast(numeric_type) if f in df.columns else F.lit(None).cast(numeric_type)
        cols.append(c.alias(f))
    kept = [k for k in keep if k in df.columns and k not in features]
    out = df.select(*kept, *cols)
    if levels is None:
        return out
    for i, c in enumerate(f for f in features if f in categorical):
        known = levels.where(F.col("column_name") == c).select(F.col("level").alias(f"_level{i}")).distinct()
        out = out.join(known, F.col(c) == F.col(f"_level{i}"), "left").withColumn(c, F.col(f"_level{i}")).drop(f"_level{i}")
    return out.select(*kept, *features)
