"""Exact interpolated quantiles per group, computed without buffering a group in one task.

``percentile`` keeps a value→count map per group inside one task, so a group holding a
third of all rows (here: one feature column of a melted table) would need that whole map
in one executor.  Instead, a *bucket select*:

1. count rows per distinct (group, value) — a partial aggregate (``value_counts``);
2. give every distinct value a monotone bucket (``range_bucketed``, boundaries drawn from the
   data) and total the counts per (group, bucket): one row per partition a group reaches;
3. exclusive running totals over that small bucket table locate, for each of the
   2·len(probs) target ranks of a group, the one bucket that holds it;
4. only the distinct values inside those few buckets are ranked exactly (a window over a
   handful of small partitions), and the values at floor/ceil of p·(n−1) are picked;
5. linear interpolation between them — the definition numpy's default ``quantile`` and
   DuckDB's ``quantile_cont`` use.

Cost: two passes over the value-count table that stay in codegen, plus work on tables the
size of the bucket list; no window ever sees a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.ordered import BUCKET_COL, range_bucketed


def value_counts(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """(groups…, value, cnt) over present values: neither NULL nor NaN."""
    return df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("cnt"))


def _targets(sizes: DataFrame, groups: list[str], probs: list[float]) -> DataFrame:
    probs_arr = F.array(*[F.lit(float(p)) for p in probs])
    t = sizes.select(*groups, F.posexplode(probs_arr).alias("q_index", "prob"), "_n")
    t = t.where(F.col("_n") > 0).withColumn("_pos", F.col("prob") * (F.col("_n") - 1))
    return t.withColumn("_lo_rank", F.floor("_pos")).withColumn("_hi_rank", F.ceil("_pos"))


def _rank_array(targets: DataFrame, groups: list[str]) -> DataFrame:
    """One row per group with its target ranks as an array (2·len(probs) entries)."""
    ranks = targets.select(
        *groups,
        F.explode(
            F.array(
                F.struct(F.col("q_index"), F.lit("lo").alias("side"), F.col("_lo_rank").alias("rank")),
                F.struct(F.col("q_index"), F.lit("hi").alias("side"), F.col("_hi_rank").alias("rank")),
            )
        ).alias("t"),
    )
    return ranks.groupBy(*groups).agg(F.collect_list("t").alias("_targets"))


def _covered(first, last):
    return lambda t: (t["rank"] >= first) & (t["rank"] <= last)


def exact_quantiles(
    vc: DataFrame, groups: list[str], value: str, probs: list[float], sizes: DataFrame | None = None
) -> DataFrame:
    """Quantiles from a value-count table: (groups…, q_index, prob, quantile).

    ``sizes`` (groups…, _n) may be passed when the number of present values per group is
    already known; otherwise it is summed from the bucket totals.
    """
    x = range_bucketed(vc, groups, value)
    totals = x.groupBy(*groups, BUCKET_COL).agg(F.sum("cnt").alias("_bc"))
    before = Window.partitionBy(*groups).orderBy(BUCKET_COL).rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.withColumn("_before", F.coalesce(F.sum("_bc").over(before), F.lit(0)))
    n = sizes if sizes is not None else totals.groupBy(*groups).agg(F.sum("_bc").alias("_n"))
    targets = _targets(n, groups, probs)
    # ≤ 2·len(probs) ranks per group: bounded by the schema, so broadcast.
    wanted = F.broadcast(_rank_array(targets, groups))
    hit_buckets = (
        offs.join(wanted, groups)
        .where(F.exists("_targets", _covered(F.col("_before"), F.col("_before") + F.col("_bc") - 1)))
        .select(*groups, BUCKET_COL, "_before")
    )
    # At most 2·len(probs) buckets per group survive: broadcast for the semi join.
    inside = x.join(F.broadcast(hit_buckets), [*groups, BUCKET_COL])
    w = Window.partitionBy(*groups, BUCKET_COL).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    cum = inside.withColumn("_cum", F.col("_before") + F.sum("cnt").over(w))
    first, last = F.col("_cum") - F.col("cnt"), F.col("_cum") - 1
    hits = cum.join(wanted, groups).select(
        *groups, value, F.explode(F.filter("_targets", _covered(first, last))).alias("t")
    ).select(*groups, F.col("t.q_index").alias("q_index"), F.col("t.side").alias("side"), F.col(value).alias("_v"))
    picked = hits.groupBy(*groups, "q_index").agg(
        F.max(F.when(F.col("side") == "lo", F.col("_v"))).alias("_v_lo"),
        F.max(F.when(F.col("side") == "hi", F.col("_v"))).alias("_v_hi"),
    )
    both = targets.join(picked, [*groups, "q_index"])
    frac = F.col("_pos") - F.col("_lo_rank")
    q = F.when((frac == 0) | (F.col("_v_lo") == F.col("_v_hi")), F.col("_v_lo")).otherwise(F.col("_v_lo") + (F.col("_v_hi") - F.col("_v_lo")) * frac)
    return both.select(*groups, "q_index", "prob", q.alias("quantile"))
