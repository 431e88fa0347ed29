"""Registered queries: splits, folds, samples, scans, upserts, retention, alignment
(WN3, PRJ11, WN11, ML1, SRC4, SRC5, SL4, EX2, SNK3, SNK10, PRJ5–PRJ7, PRJ12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import preprocess, splits
from riskloom.operators.features import FEATURE_COLUMNS
from riskloom.plans import oracle as O
from riskloom.plans import sinks
from riskloom.plans.evaluate import scratch_dir
from riskloom.plans.registry import register
from riskloom.plans.versions import VersionedTable
from riskloom.sources import derived as D
from riskloom.sources import scans

ASSIGNED_AT = "2024-02-15 04:00:00"
FEATURE_DOUBLES = (
    "avg_transaction_30d", "avg_transaction_90d", "payment_failure_rate_30d", "payment_failure_rate_90d",
    "avg_engagement_30d", "avg_engagement_90d", "campaign_participation_rate",
)


def _split(spark, sf_dir):
    return splits.stratified_split(D.stored(D.snapshot(spark, sf_dir)), assigned_at=ASSIGNED_AT)


@register("wn3_prj11_stratified_split", O.with_ctes(*O.base_ctes(), O.split_cte(), body="SELECT * FROM split_rows"), doubles=FEATURE_DOUBLES)
def wn3_split(spark, sf_dir):
    """Frozen stratified 80/20 split of the snapshot (PERCENT_RANK within each label)."""
    return _split(spark, sf_dir)


@register(
    "src4_read_train_split",
    O.with_ctes(*O.base_ctes(), O.split_cte(), body="SELECT * EXCLUDE (split, assigned_at) FROM split_rows WHERE snapshot_date = DATE '2024-02-15' AND split = 'train'"),
    doubles=FEATURE_DOUBLES,
)
def src4_read_split(spark, sf_dir):
    return scans.read_split(_split(spark, sf_dir), D.AS_OF, "train")


@register(
    "wn11_stratified_folds",
    O.with_ctes(*O.base_ctes(), O.split_cte(), "train AS (SELECT * FROM split_rows WHERE split = 'train')", O.folds_cte("train"),
                body="SELECT customer_id, churned, fold FROM folds"),
)
def wn11_folds(spark, sf_dir):
    train = scans.read_split(_split(spark, sf_dir), D.AS_OF, "train")
    return splits.stratified_folds(train.select("customer_id", "churned"))


@register(
    "ml1_fold_class_weights",
    O.with_ctes(
        *O.base_ctes(), O.split_cte(), "train AS (SELECT * FROM split_rows WHERE split = 'train')", O.folds_cte("train"),
        "fold_ids AS (SELECT DISTINCT fold FROM folds)",
        body="SELECT f.fold, COUNT(*) FILTER (WHERE NOT t.churned) AS negatives, COUNT(*) FILTER (WHERE t.churned) AS positives, "
        "COUNT(*) FILTER (WHERE NOT t.churned) / CAST(NULLIF(COUNT(*) FILTER (WHERE t.churned), 0) AS DOUBLE) AS scale_pos_weight "
        "FROM fold_ids f JOIN folds t ON t.fold <> f.fold GROUP BY f.fold",
    ),
    doubles=("scale_pos_weight",),
)
def ml1_class_weights(spark, sf_dir):
    """ML1: negatives/positives of each fold's training rows (all other folds)."""
    train = scans.read_split(_split(spark, sf_dir), D.AS_OF, "train")
    f = splits.stratified_folds(train.select("customer_id", "churned"))
    per_fold = f.groupBy("fold").agg(F.count_if(~F.col("churned")).alias("neg"), F.count_if("churned").alias("pos"))
    tot = per_fold.agg(F.sum("neg").alias("tn"), F.sum("pos").alias("tp"))
    # Totals enter as scalar subqueries over the k-row per-fold table.
    out = per_fold.select(
        "fold", (tot.select("tn").scalar() - F.col("neg")).alias("negatives"), (tot.select("tp").scalar() - F.col("pos")).alias("positives")
    )
    return out.select("fold", "negatives", "positives", F.try_divide(F.col("negatives").cast("double"), F.col("positives").cast("double")).alias("scale_pos_weight"))


@register(
    "src5_asof_partition_per_model",
    O.with_ctes(
        O.ADAPTER, O.STAGING, O.history_cte(), O.PREDICTIONS,
        "models AS (SELECT model_version, MIN(predicted_at) AS create_time FROM scored GROUP BY model_version)",
        body="SELECT m.model_version, m.create_time, MAX(p.snapshot_date) AS resolved_date FROM models m LEFT JOIN "
        "(SELECT DISTINCT snapshot_date FROM feature_history) p ON p.snapshot_date <= CAST(m.create_time AS DATE) GROUP BY ALL",
    ),
)
def src5_asof(spark, sf_dir):
    p = D.predictions(spark, sf_dir)
    models = p.groupBy("model_version").agg(F.min("predicted_at").alias("create_time"))
    return scans.resolve_snapshot_dates(models, D.history(spark, sf_dir))


@register(
    "sl4_ex2_seeded_event_sample",
    O.with_ctes(O.ADAPTER, O.STAGING, body="SELECT * FROM stg WHERE event_type = 'transaction' ORDER BY md5('7' || CAST(event_id AS VARCHAR)), event_id LIMIT 50"),
    doubles=("monthly_transaction", "engagement_score"),
)
def sl4_sample(spark, sf_dir):
    """EX2: de-duplicated, filtered, reproducible random sample of 50 events (the limit is
    the sampling operator itself)."""
    stg = D.staged_events(spark, sf_dir)
    return splits.seeded_sample(stg.where(F.col("event_type") == "transaction"), 50, seed=7)


_NEW_SCORES_SQL = """src AS (SELECT customer_id, ((customer_id * 104729 + 7919) % 997) / 997.0::DOUBLE AS churn_probability,
    ((customer_id * 104729 + 7919) % 997) / 997.0::DOUBLE >= 0.45 AS churn_prediction, 'churn-v3' AS model_version, snapshot_date,
    TIMESTAMP '2024-02-01 03:00:00' AS predicted_at FROM scored WHERE snapshot_date = DATE '2024-01-30' AND churn_probability >= 0.5)"""


def _new_scores(spark, sf_dir):
    p = D.stored(D.predictions(spark, sf_dir))  # the log is merged with scores drawn from it, which are read twice
    s = ((F.col("customer_id") * 104729 + 7919) % 997) / F.lit(997.0)
    src = p.where((F.col("snapshot_date") == F.lit("2024-01-30").cast("date")) & (F.col("churn_probability") >= 0.5)).select(
        "customer_id", s.alias("churn_probability"), (s >= 0.45).alias("churn_prediction"), "snapshot_date"
    )
    return p, sinks.stamp_scores(src, "churn-v3", "2024-02-01 03:00:00").select(*p.columns)


@register(
    "snk3_merge_predictions",
    O.with_ctes(
        O.ADAPTER, O.STAGING, O.history_cte(), O.PREDICTIONS, _NEW_SCORES_SQL,
        body="SELECT t.* FROM scored t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.customer_id = t.customer_id AND s.snapshot_date = t.snapshot_date) "
        "UNION ALL SELECT * FROM src",
    ),
    doubles=("churn_probability",),
)
def snk3_merge(spark, sf_dir):
    """Keyed upsert into the prediction log (source wins): the newest day's high-risk
    customers were re-scored by a new model version."""
    target, source = _new_scores(spark, sf_dir)
    return sinks.merge_by_key(target, source, ["customer_id", "snapshot_date"])


@register(
    "snk10_retention_window",
    O.with_ctes(O.ADAPTER, O.STAGING, O.history_cte(), O.PREDICTIONS,
                body="SELECT snapshot_date, COUNT(*) AS n FROM scored WHERE snapshot_date >= DATE '2024-02-05' - INTERVAL 20 DAY GROUP BY snapshot_date"),
)
def snk10_retention(spark, sf_dir):
    kept = sinks.retention(D.predictions(spark, sf_dir), "2024-02-05", 20)
    return kept.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))


@register(
    "snk10_expired_partitions",
    O.with_ctes(O.ADAPTER, O.STAGING, O.history_cte(), O.PREDICTIONS, body="SELECT * FROM scored WHERE snapshot_date >= DATE '2024-02-05' - INTERVAL 20 DAY"),
    doubles=("churn_probability",),
)
def snk10_expired(spark, sf_dir):
    """Whole days leave the published prediction log; what remains is read from the next version."""
    table = VersionedTable(spark, scratch_dir(spark, "retention"))
    table.replace(D.predictions(spark, sf_dir))
    sinks.expire_partitions(spark, table, "2024-02-05", 20)
    return table.read()


_X_COLS = [c for c in FEATURE_COLUMNS if c not in ("customer_id", "snapshot_date", "churned")]


@register("prj5_feature_matrix", O.with_ctes(*O.base_ctes(), body=f"SELECT {', '.join(_X_COLS)}, CAST(churned AS INTEGER) AS y FROM features"), doubles=FEATURE_DOUBLES)
def prj5_feature_matrix(spark, sf_dir):
    return preprocess.prepare_features(D.snapshot(spark, sf_dir))


@register(
    "prj7_category_levels",
    O.with_ctes(
        *O.base_ctes(),
        body="SELECT column_name, level, CAST(ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY level) - 1 AS INTEGER) AS code FROM ("
        + " UNION ".join(f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS level FROM features WHERE {c} IS NOT NULL" for c in ["membership_tier", "region", "preferred_channel"])
        + ")",
    ),
)
def prj7_levels(spark, sf_dir):
    return preprocess.category_levels(D.snapshot(spark, sf_dir))


_ALIGN_FEATURES = [c for c in _X_COLS if c not in ("latest_event_ts", "feature_computed_at")]


@register(
    "prj6_align_inference_features",
    O.with_ctes(
        O.ADAPTER, O.STAGING, O.history_cte(), O.features_cte("fb", "2024-01-20", replay=True), O.features_cte("fc", "2024-01-30", replay=True), O.DEFECTIVE,
        "lv AS (SELECT DISTINCT region AS level FROM fb WHERE region IS NOT NULL)",
        "lv_tier AS (SELECT DISTINCT membership_tier AS level FROM fb WHERE membership_tier IS NOT NULL)",
        "lv_chan AS (SELECT DISTINCT preferred_channel AS level FROM fb WHERE preferred_channel IS NOT NULL)",
        body="SELECT "
        + ", ".join(
            (
                f"CASE WHEN membership_tier IN (SELECT level FROM lv_tier) THEN membership_tier END AS membership_tier" if c == "membership_tier"
                else f"CASE WHEN region IN (SELECT level FROM lv) THEN region END AS region" if c == "region"
                else f"CASE WHEN preferred_channel IN (SELECT level FROM lv_chan) THEN preferred_channel END AS preferred_channel" if c == "preferred_channel"
                else f"CAST(NULL AS DOUBLE) AS {c}" if c == "renewal_count"
                else f"CAST({c} AS DOUBLE) AS {c}"
            )
            for c in _ALIGN_FEATURES
        )
        + " FROM defective",
    ),
    doubles=tuple(c for c in _ALIGN_FEATURES if c not in ("membership_tier", "region", "preferred_channel")),
)
def prj6_align(spark, sf_dir):
    """Align the (defective) live snapshot to the frozen feature list and levels."""
    levels = preprocess.category_levels(D.replay_snapshot(spark, sf_dir, D.BASELINE_DATE))
    return preprocess.align_to_features(D.defective_snapshot(spark, sf_dir), _ALIGN_FEATURES, levels)
