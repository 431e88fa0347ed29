"""Ranking metrics and the promotion gate (EV1–EV9, WN7–WN9).

Input is a long scores table ``(model, y, score)`` — any number of models in one pass.
Rows are first reduced to one row per (model, distinct score) with positive/negative
counts (partial aggregation, so ties and hot scores cost nothing), then cumulative counts
along descending score come from the bucketed running sum (SURVEY H2: no global window).
All curve metrics are sums over that reduced table:

* AP  = Σ pos_i/P · precision_i                       (step-wise PR-AUC, ties grouped)
* AUC = Σ neg_i · (pos strictly above + pos_i/2) / (P·N)   (Mann–Whitney with ties)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.scalar import safe_corr

from riskloom.operators.ordered import running_sums

# Fixed values of the gate.
PR_AUC_MIN_DELTA = 0.02
F1_MIN_DELTA = 0.01
TARGET_RECALL = 0.80


def score_counts(scores: DataFrame, group: str = "model") -> DataFrame:
    """(model, score, pos, neg) — one row per distinct score."""
    y = F.col("y").cast("int")
    return scores.groupBy(group, "score").agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def cumulative(scores: DataFrame, group: str = "model") -> DataFrame:
    """WN9: counts at or above each distinct score (descending), plus class totals."""
    c = score_counts(scores, group)
    return running_sums(c, [group], "score", ["pos", "neg"], descending=True)


def average_precision(curve: DataFrame, group: str = "model") -> DataFrame:
    """EV1: step-wise PR-AUC (sklearn's average precision)."""
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return curve.groupBy(group).agg(F.try_divide(F.sum(F.col("pos") * precision), F.first("total_pos").cast("double")).alias("pr_auc"))


def roc_auc(curve: DataFrame, group: str = "model") -> DataFrame:
    """EV2: ROC-AUC with ties counted half."""
    above = F.col("cum_pos") - F.col("pos")
    num = F.sum(F.col("neg") * (above + F.col("pos") / 2.0))
    den = F.first("total_pos").cast("double") * F.first("total_neg").cast("double")
    return curve.groupBy(group).agg(F.try_divide(num, den).alias("roc_auc"))


def curve_metrics(curve: DataFrame, group: str = "model") -> DataFrame:
    """EV1 + EV2 in one aggregate over the cumulative table (read once)."""
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    above = F.col("cum_pos") - F.col("pos")
    p, n = F.first("total_pos").cast("double"), F.first("total_neg").cast("double")
    return curve.groupBy(group).agg(
        F.try_divide(F.sum(F.col("pos") * precision), p).alias("pr_auc"),
        F.try_divide(F.sum(F.col("neg") * (above + F.col("pos") / 2.0)), p * n).alias("roc_auc"),
    )


def pr_curve(curve: DataFrame, group: str = "model") -> DataFrame:
    """EV6: (model, threshold, precision, recall) for thresholds down to the first one that
    reaches full recall (lower thresholds add nothing and are dropped)."""
    keep = (F.col("cum_pos") - F.col("pos")) < F.col("total_pos")
    return curve.where(keep).select(
        group,
        F.col("score").alias("threshold"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        (F.col("cum_pos") / F.col("total_pos")).alias("recall"),
    )


def select_threshold(curve_points: DataFrame, target_recall: float = TARGET_RECALL, group: str = "model") -> DataFrame:
    """EV5: among thresholds with recall ≥ target, the highest precision (ties → smallest
    threshold, T7); if none qualifies, the threshold of maximum recall (smallest first)."""
    ok = F.col("recall") >= target_recall
    best_ok = F.min_by(F.col("threshold"), F.struct(-F.col("precision"), F.col("threshold")))
    best_any = F.min_by(F.col("threshold"), F.struct(-F.col("recall"), F.col("threshold")))
    qualified = curve_points.where(ok).groupBy(group).agg(best_ok.alias("_t_ok"))
    fallback = curve_points.groupBy(group).agg(best_any.alias("_t_any"))
    return fallback.join(qualified, group, "left").select(group, F.coalesce("_t_ok", "_t_any").alias("threshold"))


def f1_at(scores: DataFrame, thresholds: DataFrame, group: str = "model") -> DataFrame:
    """EV3: F1 of ``score >= threshold`` (0 when undefined).  ``thresholds`` has one row per
    model, so it is broadcast."""
    x = scores.join(F.broadcast(thresholds), group)
    pred, y = F.col("score") >= F.col("threshold"), F.col("y").cast("boolean")
    agg = x.groupBy(group, "threshold").agg(
        F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"), F.count_if(~pred & y).alias("fn")
    )
    den = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return agg.select(group, "threshold", F.when(den > 0, 2 * F.col("tp") / den).otherwise(F.lit(0.0)).alias("f1"))


def metric_bundle(scores: DataFrame, thresholds: DataFrame, group: str = "model") -> DataFrame:
    """EV4: (model, pr_auc, roc_auc, f1, threshold) — thresholds chosen elsewhere, never on
    these scores."""
    return curve_metrics(cumulative(scores, group), group).join(f1_at(scores, thresholds, group), group)


def promotion_gate(bundle: DataFrame, challenger: str, champion: str | None, pr_auc_min_delta: float = PR_AUC_MIN_DELTA, f1_min_delta: float = F1_MIN_DELTA) -> DataFrame:
    """EV7 + EV8: one row comparing challenger and (optional) champion; promote when both
    deltas clear their floors (``>=``); no champion → promote with NULL deltas."""
    if champion is None:
        ch = bundle.where(F.col("model") == challenger).select(*[F.col(c).alias(f"challenger_{c}") for c in ("pr_auc", "roc_auc", "f1", "threshold")])
        return ch.select("*", F.lit(None).cast("double").alias("pr_auc_delta"), F.lit(None).cast("double").alias("f1_delta"), F.lit(True).alias("promote"))
    # One row per model: pivoting the two rows side by side needs no join.
    both = bundle.groupBy().pivot("model", [challenger, champion]).agg(
        F.first("pr_auc").alias("pr_auc"), F.first("roc_auc").alias("roc_auc"), F.first("f1").alias("f1"), F.first("threshold").alias("threshold")
    )
    renamed = both.select(
        *[F.col(f"{challenger}_{c}").alias(f"challenger_{c}") for c in ("pr_auc", "roc_auc", "f1", "threshold")],
        *[F.col(f"{champion}_{c}").alias(f"champion_{c}") for c in ("pr_auc", "roc_auc", "f1", "threshold")],
    )
    d_pr = F.col("challenger_pr_auc") - F.col("champion_pr_auc")
    d_f1 = F.col("challenger_f1") - F.col("champion_f1")
    return renamed.select("*", d_pr.alias("pr_auc_delta"), d_f1.alias("f1_delta"), ((d_pr >= pr_auc_min_delta) & (d_f1 >= f1_min_delta)).alias("promote"))


# --------------------------------------------------------------------------------------
# WN7, WN8, EV9 on importance vectors (one row per feature and model: small tables)
# --------------------------------------------------------------------------------------


def average_ranks(df: DataFrame, value: str, group: list[str] = (), descending: bool = False, out: str = "avg_rank") -> DataFrame:
    """WN7: ascending rank from 1, tied values share the mean of their ordinal ranks."""
    o = F.col(value).desc() if descending else F.col(value).asc()
    w = Window.partitionBy(*group).orderBy(o)
    peers = Window.partitionBy(*group, value)
    return df.withColumn(out, F.rank().over(w) + (F.count(F.lit(1)).over(peers) - 1) / 2.0)


def spearman(current: DataFrame, baseline: DataFrame, key: str = "feature", value: str = "importance") -> DataFrame:
    """EV9: Spearman on the shared features with average ranks; NULL when < 2 shared
    features or either side is constant."""
    j = current.select(key, F.col(value).alias("a")).join(baseline.select(key, F.col(value).alias("b")), key)
    r = average_ranks(average_ranks(j, "a", out="ra"), "b", out="rb")
    agg = r.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("ra").alias("sa"), F.stddev_pop("rb").alias("sb"), safe_corr("ra", "rb").alias("c"))
    return agg.select(F.when((F.col("n") >= 2) & (F.col("sa") > 0) & (F.col("sb") > 0), F.col("c")).alias("rank_correlation"), F.col("n").alias("shared_features"))


def rank_change(current: DataFrame, baseline: DataFrame, key: str = "feature", value: str = "importance") -> DataFrame:
    """WN8: descending average rank in each vector and the change (baseline − current)."""
    a = average_ranks(current.select(key, value), value, descending=True, out="current_rank")
    b = average_ranks(baseline.select(key, value), value, descending=True, out="baseline_rank")
    j = a.select(key, "current_rank").join(b.select(key, "baseline_rank"), key)
    return j.withColumn("rank_change", F.col("baseline_rank") - F.col("current_rank"))
