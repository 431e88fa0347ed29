"""Registered queries: exploration reports (EX1, EX3–EX8, EX10–EX12, ML7/SO5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import explore
from riskloom.operators.features import without_anomalies
from riskloom.plans import oracle as O
from riskloom.plans.registry import register
from riskloom.sources import derived as D
from riskloom.sources.event_log import CHANNELS, activity_log

NUM = O.EXPLORE_NUMERIC
CAT = O.EXPLORE_CATEGORICAL
SNAP_NUMERIC = D.FEATURE_NUMERIC


def _clean(spark, sf_dir):
    return without_anomalies(activity_log(spark, sf_dir))


@register(
    "ex1_ag23_wn4_event_type_distribution",
    O.with_ctes(
        O.ADAPTER, O.CLEAN_LOG,
        body="SELECT event_type, n_events, n_events / CAST(SUM(n_events) OVER () AS DOUBLE) AS share_of_events, ch / CAST(n_events AS DOUBLE) AS churn_rate, "
        "n_events / CAST(SUM(n_events) OVER () AS DOUBLE) < 0.05 AS rare FROM (SELECT event_type, COUNT(*) AS n_events, COUNT(*) FILTER (WHERE churned) AS ch FROM clean GROUP BY 1)",
    ),
    doubles=("share_of_events", "churn_rate"),
)
def ex1_event_types(spark, sf_dir):
    return explore.event_type_distribution(_clean(spark, sf_dir))


@register(
    "ex3_point_biserial",
    O.with_ctes(
        O.ADAPTER, O.STAGING,
        body=" UNION ALL ".join(
            f"SELECT '{c}' AS field, corr(CAST({c} AS DOUBLE), CAST(churned AS DOUBLE)) AS point_biserial_r, COUNT({c}) FILTER (WHERE churned IS NOT NULL) AS n FROM stg" for c in NUM
        ),
    ),
    doubles=("point_biserial_r",),
)
def ex3_point_biserial(spark, sf_dir):
    return explore.point_biserial(D.staged_events(spark, sf_dir), NUM)


@register(
    "ex4_mutual_information",
    O.with_ctes(
        O.ADAPTER, O.STAGING,
        "mlong AS (" + " UNION ALL ".join(f"SELECT '{c}' AS field, COALESCE(CAST({c} AS VARCHAR), 'nan') AS value, CAST(churned AS INTEGER) AS y FROM stg" for c in CAT) + ")",
        "joint AS (SELECT field, value, y, COUNT(*) AS nxy FROM mlong GROUP BY ALL)",
        body="SELECT field, SUM(nxy / n * ln(nxy * n / (nx * ny))) AS mutual_info FROM (SELECT *, CAST(SUM(nxy) OVER (PARTITION BY field) AS DOUBLE) AS n, "
        "CAST(SUM(nxy) OVER (PARTITION BY field, value) AS DOUBLE) AS nx, CAST(SUM(nxy) OVER (PARTITION BY field, y) AS DOUBLE) AS ny FROM joint) GROUP BY field",
    ),
    doubles=("mutual_info",),
)
def ex4_mutual_information(spark, sf_dir):
    return explore.mutual_information(D.staged_events(spark, sf_dir), CAT)


@register(
    "ex6_ag25_churn_rate_by_cohort",
    O.with_ctes(
        O.ADAPTER, O.STAGING,
        body=" UNION ALL ".join(
            f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, AVG(CAST(churned AS DOUBLE)) AS churn_rate, COUNT(*) AS n FROM stg GROUP BY {d}"
            for d in ("membership_tier", "region", "channel")
        ),
    ),
    doubles=("churn_rate",),
)
def ex6_cohorts(spark, sf_dir):
    return explore.churn_rate_by(D.staged_events(spark, sf_dir), ["membership_tier", "region", "channel"])


@register(
    "ex7_ag26_tier_channel_pivot",
    O.with_ctes(
        O.ADAPTER, O.STAGING,
        body="SELECT membership_tier, " + ", ".join(f"AVG(CASE WHEN channel = '{c}' THEN CAST(churned AS DOUBLE) END) AS {c}" for c in CHANNELS) + " FROM stg GROUP BY membership_tier",
    ),
    doubles=tuple(CHANNELS),
)
def ex7_pivot(spark, sf_dir):
    return explore.pivot_mean(D.staged_events(spark, sf_dir), "membership_tier", "channel", CHANNELS)


@register(
    "ex8_ag24_wn5_daily_series",
    O.with_ctes(
        O.ADAPTER, O.CLEAN_LOG,
        body="SELECT *, AVG(churn_rate) OVER (ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS churn_rate_7d FROM "
        "(SELECT CAST(event_timestamp AS DATE) AS event_date, COUNT(*) AS n_events, COUNT(*) FILTER (WHERE churned) / CAST(COUNT(*) AS DOUBLE) AS churn_rate FROM clean GROUP BY 1)",
    ),
    doubles=("churn_rate", "churn_rate_7d"),
)
def ex8_daily(spark, sf_dir):
    return explore.daily_series(_clean(spark, sf_dir))


# What this data's missing values mean; the report takes any such table from its caller.
MECHANISMS = {
    "avg_engagement_30d": "no online contact in the window",
    "avg_engagement_90d": "no online contact in the window",
    "days_since_last_successful_payment": "nothing was ever paid",
    "member_since_days": "left out by the source now and then",
}
_MECH = ", ".join(f"('{k}', '{v}')" for k, v in MECHANISMS.items())


@register(
    "ex10_ag15_jn11_missingness",
    O.with_ctes(
        *O.base_ctes(),
        "rates AS (" + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_rate FROM features"
            for c in ["customer_id", "membership_tier", "region", *SNAP_NUMERIC, "preferred_channel", "latest_event_ts", "feature_computed_at", "churned", "snapshot_date"]
        ) + ")",
        f"mech AS (SELECT * FROM (VALUES {_MECH}) t(column_name, mechanism))",
        body="SELECT r.column_name, r.missing_rate, COALESCE(m.mechanism, 'unknown') AS mechanism FROM rates r LEFT JOIN mech m USING (column_name) WHERE r.missing_rate > 0",
    ),
    doubles=("missing_rate",),
)
def ex10_missingness(spark, sf_dir):
    return explore.missingness_report(D.snapshot(spark, sf_dir), MECHANISMS)


@register(
    "ex11_ag28_numeric_profile",
    O.with_ctes(
        *O.base_ctes(),
        body=" UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(COUNT({c}) AS DOUBLE) AS count, AVG(CAST({c} AS DOUBLE)) AS mean, stddev_samp(CAST({c} AS DOUBLE)) AS std, "
            f"CAST(MIN({c}) AS DOUBLE) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50, "
            f"quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75, CAST(MAX({c}) AS DOUBLE) AS max FROM features"
            for c in SNAP_NUMERIC
        ),
    ),
    doubles=("count", "mean", "std", "min", "p25", "p50", "p75", "max"),
)
def ex11_profile(spark, sf_dir):
    return explore.numeric_profile(D.stored(D.snapshot(spark, sf_dir)), SNAP_NUMERIC)


@register(
    "ex11_ag14_category_shares",
    O.with_ctes(
        *O.base_ctes(),
        body="SELECT column_name, level, n / CAST(SUM(n) OVER (PARTITION BY column_name) AS DOUBLE) AS share FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS level, COUNT(*) AS n FROM features WHERE {c} IS NOT NULL GROUP BY {c}" for c in ["membership_tier", "region", "preferred_channel"])
        + ")",
    ),
    doubles=("share",),
)
def ex11_shares(spark, sf_dir):
    return explore.category_shares(D.snapshot(spark, sf_dir), ["membership_tier", "region", "preferred_channel"])


@register(
    "ex11_ag29_class_balance",
    O.with_ctes(*O.base_ctes(), body="SELECT AVG(CAST(churned AS INTEGER)) AS churn_rate, SUM(CAST(churned AS INTEGER)) AS positives, COUNT(*) AS n FROM features"),
    doubles=("churn_rate",),
)
def ex11_balance(spark, sf_dir):
    return explore.class_balance(D.snapshot(spark, sf_dir))


@register(
    "ex12_ag27_class_medians",
    O.with_ctes(
        *O.base_ctes(),
        body=" UNION ALL ".join(
            f"SELECT churned AS label, '{c}' AS column_name, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median FROM features WHERE {c} IS NOT NULL GROUP BY churned"
            for c in SNAP_NUMERIC
        ),
    ),
    doubles=("median",),
)
def ex12_medians(spark, sf_dir):
    return explore.class_conditional_medians(D.stored(D.snapshot(spark, sf_dir)), SNAP_NUMERIC)


_PAIRS = [(a, b) for i, a in enumerate(O.LI_CORR) for b in O.LI_CORR[i + 1:]]


_FPAIRS = [(a, b) for i, a in enumerate(SNAP_NUMERIC) for b in SNAP_NUMERIC[i + 1:]]


@register(
    "ex5_correlated_feature_pairs",
    O.with_ctes(
        *O.base_ctes(),
        body="SELECT * FROM ("
        + " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM features" for a, b in _FPAIRS)
        + ") WHERE abs(r) > 0.7",
    ),
    doubles=("r",),
)
def ex5_pairs(spark, sf_dir):
    """Pearson r over every pair of numeric snapshot features, |r| > 0.7 kept."""
    return explore.correlated_pairs(D.snapshot(spark, sf_dir), SNAP_NUMERIC)


@register(
    "ml7_so5_feature_selection",
    O.with_ctes(
        O.importance_cte("train", "imp"),
        "pairs AS (SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM lineitem" for a, b in _PAIRS
        ) + ") WHERE abs(r) > 0.7)",
        "low AS (SELECT feature FROM imp WHERE importance < (SELECT MAX(importance) FROM imp) * 0.05)",
        "red AS (SELECT DISTINCT CASE WHEN a.importance < b.importance THEN p.feature_a ELSE p.feature_b END AS feature FROM pairs p "
        "JOIN imp a ON a.feature = p.feature_a JOIN imp b ON b.feature = p.feature_b "
        "WHERE p.feature_a NOT IN (SELECT feature FROM low) AND p.feature_b NOT IN (SELECT feature FROM low))",
        "drops AS (SELECT feature, 'low_importance' AS reason FROM low UNION ALL SELECT feature, 'redundant' FROM red WHERE feature NOT IN (SELECT feature FROM low))",
        body="SELECT i.feature, i.importance, CASE WHEN d.reason IS NULL THEN 'keep' ELSE 'drop' END AS decision, d.reason FROM imp i LEFT JOIN drops d USING (feature)",
    ),
    doubles=("importance",),
)
def ml7_feature_selection(spark, sf_dir):
    from riskloom.sources.tables import read_table

    imp = D.lineitem_importances(spark, sf_dir, "train")
    pairs = explore.correlated_pairs(read_table(spark, sf_dir, "lineitem", O.LI_CORR), O.LI_CORR)
    return explore.feature_selection(imp, pairs)
