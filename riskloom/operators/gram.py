"""Pairwise sums of many columns by matrix products.

With the values ``X`` (zero where missing) and the masks ``M`` of an Arrow batch, the products ``M'M``, ``X'M``,
``(X*X)'M`` and ``X'X`` hold, for every pair of columns, the count, sums, squares and products over the rows
in which both are present.  A task adds the products of its batches and sends one row a pair; rows are
summed by addition.  Columns are shifted by their means first, so that large values don't cancel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONSTANT = 1e-28  # a variance this small beside the squared mean is a rounding error


def pair_sums(df: DataFrame, columns: list[str], shift: np.ndarray) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy) for the pairs i < j of columns, summed over all rows."""
    names = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), *[(c, pa.float64()) for c in names]])
    i, j = np.triu_indices(len(columns), 1)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - shift
            there = ~np.isnan(x)
            x, m = np.where(there, x, 0.0), there.astype(np.float64)
            sums, squares = x.T @ m, (x * x).T @ m
            parts = [m.T @ m, sums, sums.T, squares, squares.T, x.T @ x]
            total = parts if total is None else [a + b for a, b in zip(total, parts, strict=True)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(t[i, j]) for t in total]], schema=schema)

    sums = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(columns)]).mapInArrow(go, "i int, j int, " + ", ".join(f"{c} double" for c in names))
    return sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in names])


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature_a, feature_b, r): Pearson r of every pair of columns over the rows where neither is null or NaN; NULL
    where there are none or one side is constant.  Two passes, whatever the number of columns."""
    if len(columns) < 2:
        return df.sparkSession.createDataFrame([], "feature_a string, feature_b string, r double")
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    held = "Exchange" in rows._jdf.queryExecution().executedPlan().toString()
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK) if held else rows  # else both passes scan
    means = rows.agg(*[F.avg(F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`"))).alias(f"m{k}") for k, c in enumerate(columns)]).first()
    shift = np.array([0.0 if m is None or not np.isfinite(m) else m for m in means])
    sums = pair_sums(rows, columns, shift)
    if held:
        sums = df.sparkSession.createDataFrame(sums.collect(), sums.schema)  # a row a pair of columns
        rows.unpersist()
    name = F.array(*[F.lit(c) for c in columns])
    mean = F.array(*[F.lit(float(s)) for s in shift])

    def spread(s, ss, k):
        v = F.col(ss) - F.col(s) * F.col(s) / F.col("n")
        return F.when(v > CONSTANT * F.col("n") * F.pow(F.element_at(mean, F.col(k) + 1), 2), v).otherwise(0.0)

    r = F.try_divide(F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n"), F.sqrt(spread("sx", "sxx", "i")) * F.sqrt(spread("sy", "syy", "j")))
    return sums.where("n > 0").select(F.element_at(name, F.col("i") + 1).alias("feature_a"), F.element_at(name, F.col("j") + 1).alias("feature_b"), r.alias("r"))
