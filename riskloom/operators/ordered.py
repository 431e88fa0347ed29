"""Order-dependent aggregates without a single-task global window.

``Window.orderBy`` with no (or a very coarse) partition key moves every row into one task.
The reference needs several such computations — cumulative TP/FP along a score for PR/ROC
curves, PERCENT_RANK inside two label strata, row numbers for folds, exact quantiles — so
they all go through the two helpers here:

1. every row gets a *monotone bucket*: rows are range-partitioned on (group, value) with
   boundaries sampled from the data, and the bucket is the number of the partition, so a
   narrow range of values spreads over as many tasks as a wide one; the bucketed table is
   written once, as the boundaries must not be drawn anew for each use;
2. per-(group, bucket) totals are aggregated (one row per partition a group reaches) and
   turned into exclusive offsets with a window over that small table;
3. within each (group, bucket) the ordinary window runs, and the offset is added.

NaN sorts after every number and infinities at the ends, as everywhere in Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize

BUCKET_COL = "_ob"


def range_bucketed(df: DataFrame, groups: list[str], order_col: str) -> DataFrame:
    """``df`` with a monotone bucket of ``order_col`` inside ``groups``, equal values together."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *groups, order_col).withColumn(BUCKET_COL, F.spark_partition_id().cast("long"))
    return materialize(dealt)


def hex_bucket(hex_key: Column, bits: int = 20) -> Column:
    """Monotone bucket of a lower-case hex string (md5): its leading ``bits/4`` digits.

    Hash keys are uniform, so equal-width buckets are balanced.
    """
    digits = max(1, bits // 4)
    return F.conv(F.substring(hex_key, 1, digits), 16, 10).cast("long")


def _offsets(df: DataFrame, groups: list[str], descending: bool, value_cols: list[str]) -> DataFrame:
    totals = df.groupBy(*groups, BUCKET_COL).agg(
        F.count(F.lit(1)).alias("_tn"), *[F.sum(c).alias(f"_t_{c}") for c in value_cols]
    )
    order = F.col(BUCKET_COL).desc() if descending else F.col(BUCKET_COL).asc()
    before = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    return totals.select(
        *groups,
        BUCKET_COL,
        F.coalesce(F.sum("_tn").over(before), F.lit(0)).alias("_on"),
        F.sum("_tn").over(whole).alias("_group_n"),
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in value_cols],
        *[F.sum(f"_t_{c}").over(whole).alias(f"_g_{c}") for c in value_cols],
    )


def running_sums(
    df: DataFrame,
    groups: list[str],
    order_col: str,
    value_cols: list[str],
    descending: bool = False,
    bucket: Column | None = None,
) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum in order) and ``total_<c>`` for each value column.

    Rows must be unique on ``groups + [order_col]`` (aggregate first), which is how every
    caller uses it: counts per distinct score, never raw rows.
    """
    x = df.withColumn(BUCKET_COL, bucket) if bucket is not None else range_bucketed(df, groups, order_col)
    offs = _offsets(x, groups, descending, value_cols)
    o = F.col(order_col).desc() if descending else F.col(order_col).asc()
    inside = Window.partitionBy(*groups, BUCKET_COL).orderBy(o).rowsBetween(Window.unboundedPreceding, 0)
    joined = x.join(offs, [*groups, BUCKET_COL])
    out = joined.select(
        *df.columns,
        *[(F.col(f"_o_{c}") + F.sum(c).over(inside)).alias(f"cum_{c}") for c in value_cols],
        *[F.col(f"_g_{c}").alias(f"total_{c}") for c in value_cols],
    )
    return out


def ranked(
    df: DataFrame,
    groups: list[str],
    order_cols: list[str],
    bucket: Column,
    descending: bool = False,
) -> DataFrame:
    """Add ``_rank`` (RANK semantics), ``_row_number`` and ``_group_n`` within ``groups``.

    ``bucket`` must be monotone in the first order column; later order columns only break
    ties inside a bucket.  Equivalent to ``rank()/row_number() over (partition by groups
    order by order_cols)`` without putting a whole group into one task.
    """
    x = df.withColumn(BUCKET_COL, bucket)
    offs = _offsets(x, groups, descending, [])
    orders = [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]
    inside = Window.partitionBy(*groups, BUCKET_COL).orderBy(*orders)
    rank_inside = Window.partitionBy(*groups, BUCKET_COL).orderBy(orders[0])
    joined = x.join(offs, [*groups, BUCKET_COL])
    return joined.select(
        *df.columns,
        (F.col("_on") + F.rank().over(rank_inside)).alias("_rank"),
        (F.col("_on") + F.row_number().over(inside)).alias("_row_number"),
        F.col("_group_n"),
    )
