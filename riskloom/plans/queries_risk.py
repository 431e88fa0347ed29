"""Registered queries: the risk read-model (RK1–RK11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import risk
from riskloom.plans import oracle as O
from riskloom.plans import sinks
from riskloom.plans.evaluate import scratch_dir
from riskloom.plans.registry import register
from riskloom.sources import derived as D

MART_DOUBLES = (
    "churn_probability", "monthly_value", "monthly_value_90d", "payment_failure_rate_30d", "payment_failure_rate_90d",
    "avg_engagement_30d", "avg_engagement_90d", "campaign_participation_rate",
)


def _mart(spark, sf_dir):
    return risk.risk_current(D.predictions(spark, sf_dir), D.history(spark, sf_dir))


def _stored_mart(spark, sf_dir):
    return D.stored(_mart(spark, sf_dir))


@register("rk1_jn3_risk_current", O.with_ctes(*O.risk_base(), body="SELECT * FROM mart"), doubles=MART_DOUBLES)
def rk1_risk_current(spark, sf_dir):
    return _mart(spark, sf_dir)


MART_BUCKETS = 16


@register("rk1_jn3_bucketed_mart", O.with_ctes(*O.risk_base(), body="SELECT * FROM mart"), doubles=MART_DOUBLES)
def rk1_bucketed_mart(spark, sf_dir):
    """The same mart from stored tables with the same buckets: the newest date from the partition list, a literal
    on both sides, and a join without an exchange."""
    features = D.stored(D.history(spark, sf_dir))
    names = [sinks.save_bucketed(t, scratch_dir(spark, "bucketed"), "customer_id", MART_BUCKETS, "snapshot_date") for t in (D.score_features(features), features)]
    days = [r.partition.split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {names[0]}").collect()]
    scored, stored = (spark.table(n) for n in names)
    return risk.risk_current(scored, stored.hint("merge"), max(days))


@register(
    "rk2_ag9_risk_daily",
    O.with_ctes(O.ADAPTER, O.STAGING, O.history_cte(), O.PREDICTIONS, O.DAILY, body="SELECT * FROM daily"),
    doubles=("mean_churn_probability", "predicted_churn_rate"),
)
def rk2_risk_daily(spark, sf_dir):
    return risk.risk_daily(D.predictions(spark, sf_dir))


@register(
    "rk9_wn6_day_over_day",
    O.with_ctes(
        O.ADAPTER, O.STAGING, O.history_cte(), O.PREDICTIONS, O.DAILY,
        body="SELECT snapshot_date, high_risk_customers, high_risk_customers - LAG(high_risk_customers) OVER (ORDER BY snapshot_date) AS high_risk_change FROM daily",
    ),
)
def rk9_day_over_day(spark, sf_dir):
    return risk.day_over_day(risk.risk_daily(D.predictions(spark, sf_dir)))


@register(
    "rk3_fn10_risk_bands",
    O.with_ctes(*O.risk_base(), O.BANDED, body="SELECT customer_id, churn_probability, risk_band FROM banded"),
    doubles=("churn_probability",),
)
def rk3_bands(spark, sf_dir):
    return risk.with_risk_bands(_mart(spark, sf_dir)).select("customer_id", "churn_probability", "risk_band")


@register("rk4_ag18_cohort_reference", O.with_ctes(*O.risk_base(), O.COHORT, body="SELECT * FROM ref"), doubles=("cohort",))
def rk4_cohort(spark, sf_dir):
    return risk.cohort_reference(_stored_mart(spark, sf_dir))


@register(
    "rk5_sl7_customer_indicators",
    O.with_ctes(
        *O.risk_base(), O.COHORT, O.INDICATORS,
        body="SELECT customer_id, feature, label, value, cohort, severity, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY severity DESC, driver_order) AS indicator_rank FROM fired",
    ),
    doubles=("value", "cohort", "severity"),
)
def rk5_indicators(spark, sf_dir):
    mart = _stored_mart(spark, sf_dir)
    return risk.customer_indicators(mart, risk.cohort_reference(mart))


@register(
    "rk6_ag20_portfolio_summary",
    O.with_ctes(
        *O.risk_base(),
        body="SELECT COUNT(*) AS customers_scored, COUNT(*) FILTER (WHERE churn_probability >= 0.7) AS high_risk_customers, "
        "COALESCE(COUNT(*) FILTER (WHERE churn_probability >= 0.7) / CAST(NULLIF(COUNT(*), 0) AS DOUBLE), 0.0) AS high_risk_share, "
        "COALESCE(SUM(CASE WHEN churn_probability >= 0.7 THEN COALESCE(monthly_value, 0.0) END), 0.0) AS monthly_value_at_risk, "
        "COALESCE(AVG(churn_probability), 0.0) AS mean_probability FROM mart",
    ),
    doubles=("high_risk_share", "monthly_value_at_risk", "mean_probability"),
)
def rk6_summary(spark, sf_dir):
    return risk.portfolio_summary(_mart(spark, sf_dir))


@register(
    "rk7_jn10_band_composition",
    O.with_ctes(
        *O.risk_base(), O.BANDED,
        "bands AS (SELECT * FROM (VALUES ('High', 0), ('Medium', 1), ('Low', 2)) t(risk_band, band_order))",
        body="SELECT b.risk_band, b.band_order, COALESCE(c.customers, 0) AS customers, COALESCE(c.customers, 0) / CAST(GREATEST(SUM(COALESCE(c.customers, 0)) OVER (), 1) AS DOUBLE) AS share "
        "FROM bands b LEFT JOIN (SELECT risk_band, COUNT(*) AS customers FROM banded GROUP BY risk_band) c USING (risk_band)",
    ),
    doubles=("share",),
)
def rk7_band_composition(spark, sf_dir):
    return risk.band_composition(risk.with_risk_bands(_mart(spark, sf_dir)))


@register(
    "rk8_ag22_high_risk_by_segment",
    O.with_ctes(
        *O.risk_base(),
        body=" UNION ALL ".join(
            f"SELECT '{d}' AS dimension, {d} AS segment, COUNT(*) AS customers, SUM(CAST(churn_probability >= 0.7 AS INTEGER)) AS high_risk, "
            f"SUM(CAST(churn_probability >= 0.7 AS INTEGER)) / CAST(COUNT(*) AS DOUBLE) AS share FROM mart WHERE {d} IS NOT NULL GROUP BY {d}"
            for d in ("membership_tier", "region", "preferred_channel")
        ),
    ),
    doubles=("share",),
)
def rk8_by_segment(spark, sf_dir):
    return risk.high_risk_by_segment(_mart(spark, sf_dir))


@register(
    "rk10_prj9_worklist",
    O.with_ctes(
        *O.risk_base(), O.BANDED,
        body="SELECT * FROM banded WHERE risk_band IN ('High', 'Medium') AND region IN ('ASIA', 'EUROPE', 'AMERICA') "
        "AND COALESCE(regexp_matches(CAST(customer_id AS VARCHAR), '(?i)1'), FALSE) ORDER BY churn_probability DESC, customer_id",
    ),
    doubles=MART_DOUBLES,
)
def rk10_worklist(spark, sf_dir):
    banded = risk.with_risk_bands(_mart(spark, sf_dir))
    return risk.worklist(banded, bands=["High", "Medium"], regions=["ASIA", "EUROPE", "AMERICA"], search="1")


@register(
    "rk11_fn14_freshness",
    O.with_ctes(
        *O.risk_base(),
        body="SELECT MAX(snapshot_date) AS snapshot_date, date_diff('day', MAX(snapshot_date), DATE '2024-02-01') AS age_days, "
        "date_diff('day', MAX(snapshot_date), DATE '2024-02-01') > 1 AS stale, "
        "string_split(MAX(model_version), '/')[-1] AS model_display_name FROM mart",
    ),
)
def rk11_freshness(spark, sf_dir):
    return risk.freshness(_mart(spark, sf_dir), "2024-02-01")
