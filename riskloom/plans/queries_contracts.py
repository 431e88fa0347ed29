"""Registered queries: read-model contracts, previews, re-joins, texts and small rules (SRC11, SNK8, JN4,
SO1/EX9, FN8, FN17, FN18, DQ15, DQ16, DR10, SL6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.scalar import arrays_close, as_date, composite_key
from riskloom.operators import drift, explore, quality, risk
from riskloom.plans import oracle as O
from riskloom.plans import sinks
from riskloom.plans.evaluate import rejoin_scores, scratch_dir
from riskloom.plans.registry import register
from riskloom.sources import derived as D
from riskloom.sources import scans
from riskloom.sources.event_log import activity_log

SCORED = [O.ADAPTER, O.STAGING, O.history_cte(), O.PREDICTIONS]
NEWEST = D.HISTORY_DATES[-1]


@register("src11_ordered_preview", O.with_ctes(*SCORED, body="SELECT * FROM scored ORDER BY churn_probability DESC, customer_id, snapshot_date LIMIT 25"), doubles=("churn_probability",))
def src11_preview(spark, sf_dir):
    """The first rows of an ordered scan (the limit is the feature)."""
    return scans.preview(D.predictions(spark, sf_dir), 25, [F.desc("churn_probability"), "customer_id", "snapshot_date"])


@register(
    "snk8_view_read_model",
    O.with_ctes(*O.risk_base(), body="SELECT region, COUNT(*) AS customers, MAX(churn_probability) AS highest FROM mart GROUP BY region"),
    doubles=("highest",),
)
def snk8_view(spark, sf_dir):
    """The current-risk mart as a view; its join runs when the view is read."""
    mart = risk.risk_current(D.predictions(spark, sf_dir), D.history(spark, sf_dir), NEWEST)
    sinks.as_view(mart, "risk_current_view")
    return spark.sql("SELECT region, COUNT(*) AS customers, MAX(churn_probability) AS highest FROM risk_current_view GROUP BY region")


@register(
    "jn4_src6_rejoined_scores",
    O.with_ctes(*SCORED, body=f"SELECT CAST(customer_id AS VARCHAR) AS customer_id, churn_probability, churn_prediction FROM scored WHERE snapshot_date = DATE '{NEWEST}'"),
    doubles=("churn_probability",),
)
def jn4_rejoin(spark, sf_dir):
    """Scores leave as JSON lines in numbered shards and come back to the ids that asked for them."""
    p = D.stored(D.predictions(spark, sf_dir).where(F.col("snapshot_date") == as_date(NEWEST)))
    path = scratch_dir(spark, "shards")
    sinks.prediction_shards(p.select(F.col("customer_id").cast("string").alias("customer_id"), F.struct("churn_probability", "churn_prediction").alias("prediction")), path)
    return rejoin_scores(p.select(F.col("customer_id").cast("string").alias("customer_id")), scans.read_prediction_shards(spark, path))


CAPTURED = {"channel": "preferred_channel", "event_timestamp": "latest_event_ts"}


@register(
    "ex9_so1_raw_gaps",
    O.with_ctes(
        *O.base_ctes(),
        "gaps AS (SELECT column_name AS raw_field FROM (DESCRIBE cdc) EXCEPT SELECT column_name FROM (DESCRIBE features))",
        body="SELECT raw_field, CASE raw_field " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in CAPTURED.items()) + " ELSE 'no engineered counterpart' END AS captured_as FROM gaps",
    ),
)
def ex9_gaps(spark, sf_dir):
    """Raw fields without a feature of the same name."""
    return explore.raw_vs_engineered(spark, activity_log(spark, sf_dir), D.snapshot(spark, sf_dir), CAPTURED)


@register(
    "fn8_composite_keys",
    O.with_ctes(*SCORED, body="SELECT concat_ws('|', CAST(customer_id AS VARCHAR), CAST(snapshot_date AS VARCHAR)) AS score_key, model_version FROM scored"),
)
def fn8_keys(spark, sf_dir):
    return D.predictions(spark, sf_dir).select(composite_key("customer_id", "snapshot_date").alias("score_key"), "model_version")


def _cohort_text() -> str:
    how = {"percent": "printf('%.0f', cohort * 100) || '%'", "int": "printf('%.0f', cohort)", "float": "printf('%.1f', cohort)"}
    return "CASE feature " + " ".join(f"WHEN '{c}' THEN {how[f]}" for c, _, _, f in risk.DRIVERS) + " END"


_HIGHER = ", ".join(f"'{c}'" for c, _, h, _ in risk.DRIVERS if h)


@register(
    "fn17_indicator_texts",
    O.with_ctes(
        *O.risk_base(), O.COHORT, O.INDICATORS,
        body=f"""SELECT customer_id, feature, CASE
  WHEN value IS NULL THEN 'never recorded a successful payment'
  WHEN feature IN ({_HIGHER}) AND cohort <= 0 THEN 'above a cohort where the typical customer has none'
  WHEN feature IN ({_HIGHER}) THEN printf('%.1f', value / cohort) || '× the cohort median of ' || {_cohort_text()}
  WHEN value <= 0 THEN 'none at all, against a cohort median of ' || {_cohort_text()}
  ELSE printf('%.1f', cohort / value) || '× below the cohort median of ' || {_cohort_text()} END AS detail FROM fired""",
    ),
)
def fn17_texts(spark, sf_dir):
    """RK5's indicators as the phrases of the worklist."""
    mart = D.stored(risk.risk_current(D.predictions(spark, sf_dir), D.history(spark, sf_dir), NEWEST))
    return risk.indicator_text(risk.customer_indicators(mart, risk.cohort_reference(mart))).select("customer_id", "feature", "detail")


def _edges_cte(name: str, source: str) -> str:
    return f"{name} AS (SELECT feature, list(lo ORDER BY bucket) || [arg_max(hi, bucket)] AS e FROM {source} WHERE kind = 'numeric' AND bucket <> {drift.NULL_BUCKET} GROUP BY feature)"


@register(
    "fn18_edges_close",
    O.with_ctes(
        O.lineitem_period_cte("li_base", "baseline"), O.lineitem_period_cte("li_cur", "current"),
        O.baseline_ctes("lb", "li_base", O.LINEITEM_NUMERIC, O.LINEITEM_CATEGORICAL),
        O.baseline_ctes("lc", "li_cur", O.LINEITEM_NUMERIC, O.LINEITEM_CATEGORICAL),
        _edges_cte("ea", "lb"), _edges_cte("eb", "lc"),
        body="""SELECT feature, len(ea.e) = len(eb.e) AND len(list_filter(range(1, len(ea.e) + 1),
  lambda i: NOT (ea.e[i] = eb.e[i] OR abs(ea.e[i] - eb.e[i]) <= 1e-4 + 1e-3 * abs(eb.e[i])))) = 0 AS close,
  len(list_filter(range(1, len(ea.e) + 1), lambda i: NOT (ea.e[i] = eb.e[i] OR abs(ea.e[i] - eb.e[i]) <= 1e-4 + 0.5 * abs(eb.e[i])))) = 0 AND len(ea.e) = len(eb.e) AS roughly
FROM ea JOIN eb USING (feature)""",
    ),
)
def fn18_close(spark, sf_dir):
    """Decile edges of two periods, element by element within a tolerance; equal infinities are equal."""
    edges = [drift.baseline_edges(drift.build_baseline(D.lineitem_period(spark, sf_dir, p), D.LINEITEM_NUMERIC, [])) for p in ("baseline", "current")]
    both = edges[0].join(edges[1].select("feature", F.col("edges").alias("other")), "feature")
    return both.select("feature", arrays_close(F.col("edges"), F.col("other")).alias("close"), arrays_close(F.col("edges"), F.col("other"), rtol=0.5).alias("roughly"))


@register(
    "dq15_trend_violations",
    O.with_ctes(
        *SCORED, O.DAILY,
        "t AS (SELECT snapshot_date, CASE WHEN day(snapshot_date) = 30 THEN NULL ELSE customers_scored END AS c, CASE WHEN day(snapshot_date) = 20 THEN predicted_churn_rate + 1 ELSE predicted_churn_rate END AS r FROM daily)",
        body="SELECT snapshot_date, 'customers_scored' AS column_name, CAST(NULL AS DOUBLE) AS value FROM t WHERE c IS NULL "
        "UNION ALL SELECT snapshot_date, 'predicted_churn_rate', r FROM t WHERE r < 0 OR r > 1",
    ),
    doubles=("value",),
)
def dq15_trend(spark, sf_dir):
    """Cells of a damaged trend that break the reader's contract."""
    day = F.dayofmonth("snapshot_date")
    t = risk.risk_daily(D.predictions(spark, sf_dir))
    t = t.withColumn("customers_scored", F.when(day != 30, F.col("customers_scored"))).withColumn("predicted_churn_rate", F.col("predicted_churn_rate") + F.when(day == 20, 1).otherwise(0))
    return quality.trend_violations(t)


@register(
    "dq16_scores_in_range",
    O.with_ctes(*SCORED, body="SELECT customer_id, snapshot_date, churn_probability * 1.25 - 0.1 AS churn_probability FROM scored WHERE churn_probability * 1.25 - 0.1 < 0 OR churn_probability * 1.25 - 0.1 > 1"),
    doubles=("churn_probability",),
)
def dq16_range(spark, sf_dir):
    """Scores that a wrong rescaling took out of [0, 1]."""
    p = D.predictions(spark, sf_dir).select("customer_id", "snapshot_date", (F.col("churn_probability") * 1.25 - 0.1).alias("churn_probability"))
    return quality.probability_in_range(p)


@register(
    "dr10_verdict_rule",
    O.with_ctes(
        O.lineitem_period_cte("li_base", "baseline"), O.lineitem_period_cte("li_cur", "current"),
        O.baseline_ctes("lb", "li_base", O.LINEITEM_NUMERIC, O.LINEITEM_CATEGORICAL),
        O.psi_ctes("lp", "lb", "li_cur", O.LINEITEM_NUMERIC, O.LINEITEM_CATEGORICAL),
        body=f"SELECT feature, psi, monitored, {drift.PSI_THRESHOLD} AS threshold, monitored AND psi > {drift.PSI_THRESHOLD} AS breached FROM lp",
    ),
    doubles=("psi", "threshold"),
)
def dr10_rule(spark, sf_dir):
    """The verdict where the samples are large enough that the fixed threshold lies above the noise floor."""
    base = drift.freeze(drift.build_baseline(D.lineitem_period(spark, sf_dir, "baseline"), D.LINEITEM_NUMERIC, D.LINEITEM_CATEGORICAL))
    v = drift.drift_verdict(base, D.lineitem_period(spark, sf_dir, "current"), D.LINEITEM_NUMERIC, D.LINEITEM_CATEGORICAL)
    return v.select("feature", "psi", "monitored", "threshold", "breached")


@register("sl6_validated_trend", O.with_ctes(*SCORED, O.DAILY, body="SELECT * FROM daily ORDER BY snapshot_date"), doubles=("mean_churn_probability", "predicted_churn_rate"))
def sl6_trend(spark, sf_dir):
    """The daily trend in order, after its contract was checked."""
    return quality.validated_trend(D.stored(risk.risk_daily(D.predictions(spark, sf_dir))))
