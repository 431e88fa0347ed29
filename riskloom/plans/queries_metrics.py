"""Registered queries: ranking metrics, threshold choice and the promotion gate
(EV1–EV9, WN7–WN9)."""

from __future__ import annotations

from riskloom.operators import metrics
from riskloom.plans import oracle as O
from riskloom.plans.registry import register
from riskloom.sources import derived as D


def _thresholds(spark, sf_dir):
    """Operating points chosen on the earlier period (never on the evaluated rows)."""
    cur = metrics.cumulative(D.lineitem_scores(spark, sf_dir, "train"))
    return metrics.select_threshold(metrics.pr_curve(cur))


@register(
    "ev6_wn9_pr_curve",
    O.with_ctes(O.scores_cte(), O.curve_cte(), O.pr_points_cte(), body="SELECT * FROM pr"),
    doubles=("threshold", "precision", "recall"),
)
def ev6_pr_curve(spark, sf_dir):
    return metrics.pr_curve(metrics.cumulative(D.lineitem_scores(spark, sf_dir)))


@register(
    "ev1_ev2_ranking_auc",
    O.with_ctes(
        O.scores_cte(),
        O.curve_cte(),
        body="SELECT model, SUM(pos * (cum_pos / CAST(cum_pos + cum_neg AS DOUBLE))) / CAST(ANY_VALUE(total_pos) AS DOUBLE) AS pr_auc, "
        "SUM(neg * (cum_pos - pos + pos / 2.0)) / (CAST(ANY_VALUE(total_pos) AS DOUBLE) * ANY_VALUE(total_neg)) AS roc_auc FROM curve GROUP BY model",
    ),
    doubles=("pr_auc", "roc_auc"),
)
def ev1_ev2_auc(spark, sf_dir):
    return metrics.curve_metrics(metrics.cumulative(D.lineitem_scores(spark, sf_dir)))


@register(
    "ev5_select_threshold",
    O.with_ctes(O.scores_cte("train", "s_train"), O.curve_cte("s_train", "c_train"), O.pr_points_cte("c_train", "pr"), O.threshold_cte(), body="SELECT * FROM thr"),
    doubles=("threshold",),
)
def ev5_threshold(spark, sf_dir):
    return _thresholds(spark, sf_dir)


_BUNDLE = [
    O.scores_cte("train", "s_train"), O.curve_cte("s_train", "c_train"), O.pr_points_cte("c_train", "pr"), O.threshold_cte(),
    O.scores_cte("test", "s_test"), O.curve_cte("s_test", "c_test"), O.bundle_cte("s_test", "c_test", "thr"),
]


@register("ev3_ev4_metric_bundle", O.with_ctes(*_BUNDLE, body="SELECT * FROM bundle"), doubles=("pr_auc", "roc_auc", "f1", "threshold"))
def ev4_bundle(spark, sf_dir):
    return metrics.metric_bundle(D.lineitem_scores(spark, sf_dir, "test"), _thresholds(spark, sf_dir))


_GATE_COLS = ("pr_auc", "roc_auc", "f1", "threshold")


@register(
    "ev7_ev8_promotion_gate",
    O.with_ctes(
        *_BUNDLE,
        body="SELECT "
        + ", ".join(f"ch.{c} AS challenger_{c}" for c in _GATE_COLS)
        + ", "
        + ", ".join(f"cp.{c} AS champion_{c}" for c in _GATE_COLS)
        + ", ch.pr_auc - cp.pr_auc AS pr_auc_delta, ch.f1 - cp.f1 AS f1_delta, (ch.pr_auc - cp.pr_auc >= 0.02 AND ch.f1 - cp.f1 >= 0.01) AS promote "
        "FROM (SELECT * FROM bundle WHERE model = 'challenger') ch, (SELECT * FROM bundle WHERE model = 'champion') cp",
    ),
    doubles=tuple(f"{s}_{c}" for s in ("challenger", "champion") for c in _GATE_COLS) + ("pr_auc_delta", "f1_delta"),
)
def ev8_gate(spark, sf_dir):
    bundle = metrics.metric_bundle(D.lineitem_scores(spark, sf_dir, "test"), _thresholds(spark, sf_dir))
    return metrics.promotion_gate(bundle, "challenger", "champion")


_IMP = [O.importance_cte("train", "imp_b"), O.importance_cte("test", "imp_c")]


@register(
    "ev9_wn7_importance_spearman",
    O.with_ctes(
        *_IMP,
        "j AS (SELECT c.feature, c.importance AS a, b.importance AS b FROM imp_c c JOIN imp_b b USING (feature))",
        "r AS (SELECT *, RANK() OVER (ORDER BY a) + (COUNT(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra, "
        "RANK() OVER (ORDER BY b) + (COUNT(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb FROM j)",
        body="SELECT CASE WHEN COUNT(*) >= 2 AND stddev_pop(ra) > 0 AND stddev_pop(rb) > 0 THEN corr(ra, rb) END AS rank_correlation, "
        "COUNT(*) AS shared_features FROM r",
    ),
    doubles=("rank_correlation",),
)
def ev9_spearman(spark, sf_dir):
    return metrics.spearman(D.lineitem_importances(spark, sf_dir, "test"), D.lineitem_importances(spark, sf_dir, "train"))


@register(
    "wn8_importance_rank_change",
    O.with_ctes(
        *_IMP,
        "rc AS (SELECT feature, RANK() OVER (ORDER BY importance DESC) + (COUNT(*) OVER (PARTITION BY importance) - 1) / 2.0 AS current_rank FROM imp_c)",
        "rb AS (SELECT feature, RANK() OVER (ORDER BY importance DESC) + (COUNT(*) OVER (PARTITION BY importance) - 1) / 2.0 AS baseline_rank FROM imp_b)",
        body="SELECT feature, current_rank, baseline_rank, baseline_rank - current_rank AS rank_change FROM rc JOIN rb USING (feature)",
    ),
    doubles=("current_rank", "baseline_rank", "rank_change"),
)
def wn8_rank_change(spark, sf_dir):
    return metrics.rank_change(D.lineitem_importances(spark, sf_dir, "test"), D.lineitem_importances(spark, sf_dir, "train"))
