"""Registered queries: distribution monitoring (DR1–DR14, AG14–AG17, JN7, JN8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import drift
from riskloom.plans import oracle as O
from riskloom.plans.registry import register
from riskloom.sources import derived as D

BASELINE_DOUBLES = ("bucket_value", "lo", "hi", "expected", "null_rate")
PSI_DOUBLES = ("psi", "baseline_null_rate", "current_null_rate")


def _li_baseline(spark, sf_dir, track_nulls=True):
    base = D.lineitem_period(spark, sf_dir, "baseline")
    return drift.build_baseline(base, D.LINEITEM_NUMERIC, D.LINEITEM_CATEGORICAL, track_nulls=track_nulls)


def _frozen_li(spark, sf_dir, track_nulls=True):
    return drift.freeze(_li_baseline(spark, sf_dir, track_nulls))


def _feature_baseline(spark, sf_dir):
    base = D.replay_snapshot(spark, sf_dir, D.BASELINE_DATE)
    return drift.build_baseline(base, D.FEATURE_NUMERIC, D.FEATURE_CATEGORICAL)


def _frozen_features(spark, sf_dir):
    return drift.freeze(_feature_baseline(spark, sf_dir))


_LI_B = O.baseline_ctes("lb", "li_base", O.LINEITEM_NUMERIC, O.LINEITEM_CATEGORICAL)
_LI_SRC = [O.lineitem_period_cte("li_base", "baseline"), O.lineitem_period_cte("li_cur", "current")]


@register("dr1_dr6_lineitem_baseline", O.with_ctes(*_LI_SRC, _LI_B, body="SELECT * FROM lb"), doubles=BASELINE_DOUBLES)
def dr1_lineitem_baseline(spark, sf_dir):
    """Frozen baseline of lineitem before the split date: categorical, discrete, numeric."""
    return _li_baseline(spark, sf_dir)


@register(
    "dr1_feature_baseline",
    O.with_ctes(*O.drift_feature_ctes(), O.baseline_ctes("fbb", "fb", O.FEATURE_NUMERIC, O.FEATURE_CATEGORICAL), body="SELECT * FROM fbb"),
    doubles=BASELINE_DOUBLES,
)
def dr1_feature_baseline(spark, sf_dir):
    return _feature_baseline(spark, sf_dir)


@register(
    "ag17_decile_edges",
    O.with_ctes(
        *_LI_SRC,
        _LI_B,
        body="SELECT feature, bucket, lo, hi FROM lb WHERE kind = 'numeric' AND bucket <> 1000000",
    ),
    doubles=("lo", "hi"),
)
def ag17_decile_edges(spark, sf_dir):
    return _li_baseline(spark, sf_dir).where((F.col("kind") == "numeric") & (F.col("bucket") != drift.NULL_BUCKET)).select(
        "feature", "bucket", "lo", "hi"
    )


@register(
    "dr7_lineitem_psi",
    O.with_ctes(*_LI_SRC, _LI_B, O.psi_ctes("lp", "lb", "li_cur", O.LINEITEM_NUMERIC, O.LINEITEM_CATEGORICAL), body="SELECT * FROM lp"),
    doubles=PSI_DOUBLES,
)
def dr7_lineitem_psi(spark, sf_dir):
    cur = D.lineitem_period(spark, sf_dir, "current")
    return drift.psi_table(_frozen_li(spark, sf_dir), cur, D.LINEITEM_NUMERIC, D.LINEITEM_CATEGORICAL)


@register(
    "dr8_legacy_baseline_psi",
    O.with_ctes(
        *_LI_SRC,
        O.baseline_ctes("lg", "li_base", O.LINEITEM_NUMERIC, O.LINEITEM_CATEGORICAL, track_nulls=False),
        O.psi_ctes("lgp", "lg", "li_cur", O.LINEITEM_NUMERIC, O.LINEITEM_CATEGORICAL),
        body="SELECT * FROM lgp",
    ),
    doubles=PSI_DOUBLES,
)
def dr8_legacy_psi(spark, sf_dir):
    """PSI against a baseline frozen without null tracking (nulls → 'nan' category)."""
    cur = D.lineitem_period(spark, sf_dir, "current")
    return drift.psi_table(_frozen_li(spark, sf_dir, track_nulls=False), cur, D.LINEITEM_NUMERIC, D.LINEITEM_CATEGORICAL)


@register(
    "dr7_feature_psi",
    O.with_ctes(
        *O.drift_feature_ctes(),
        O.baseline_ctes("fbb", "fb", O.FEATURE_NUMERIC, O.FEATURE_CATEGORICAL),
        O.psi_ctes("fp", "fbb", "fc", O.FEATURE_NUMERIC, O.FEATURE_CATEGORICAL),
        body="SELECT * FROM fp",
    ),
    doubles=PSI_DOUBLES,
)
def dr7_feature_psi(spark, sf_dir):
    cur = D.replay_snapshot(spark, sf_dir, D.CURRENT_DATE)
    return drift.psi_table(_frozen_features(spark, sf_dir), cur, D.FEATURE_NUMERIC, D.FEATURE_CATEGORICAL)


@register("dr9_noise_floor")
def dr9_noise_floor(spark, sf_dir):
    cur = D.lineitem_period(spark, sf_dir, "current")
    b = _frozen_li(spark, sf_dir)
    # n = rows of the live sample, as a scalar subquery (no collect, no cross join).
    sizes = b.select("feature").distinct().withColumn("n", cur.agg(F.count(F.lit(1))).scalar())
    return drift.noise_floor(b, sizes)


@register("dr10_dr11_lineitem_verdict")
def dr10_verdict(spark, sf_dir):
    cur = D.lineitem_period(spark, sf_dir, "current")
    return drift.drift_verdict(_frozen_li(spark, sf_dir), cur, D.LINEITEM_NUMERIC, D.LINEITEM_CATEGORICAL)


@register("dr10_feature_verdict")
def dr10_feature_verdict(spark, sf_dir):
    cur = D.replay_snapshot(spark, sf_dir, D.CURRENT_DATE)
    return drift.drift_verdict(_frozen_features(spark, sf_dir), cur, D.FEATURE_NUMERIC, D.FEATURE_CATEGORICAL)


# ----------------------------------------------------------------- score drift and decision
_SCORE_SRC = [
    O.ADAPTER, O.STAGING, O.history_cte(), O.PREDICTIONS,
    "train_scores AS (SELECT churn_probability FROM scored WHERE snapshot_date = DATE '2024-01-20')",
    "cur_scores AS (SELECT churn_probability FROM scored WHERE snapshot_date = DATE '2024-01-30' AND churn_probability IS NOT NULL)",
]


def _scores_on(spark, sf_dir, day, features=None):
    """The log's scores of a day; ``features``: the stored feature table behind the log.  Without it the day is stored, as
    baselines and indices go over their rows many times."""
    p = D.predictions(spark, sf_dir) if features is None else D.score_features(features)
    rows = p.where(F.col("snapshot_date") == F.lit(day).cast("date")).select("churn_probability")
    return D.stored(rows) if features is None else rows


def _score_baseline(spark, sf_dir, features=None):
    return drift.build_baseline(_scores_on(spark, sf_dir, D.BASELINE_DATE, features), [drift.SCORE_FEATURE], [])


@register(
    "dr14_so6_model_baseline",
    O.with_ctes(
        *_SCORE_SRC,
        O.features_cte("fb", "2024-01-20", replay=True),
        O.baseline_ctes("fbb", "fb", O.FEATURE_NUMERIC, O.FEATURE_CATEGORICAL),
        O.baseline_ctes("sb", "train_scores", ["churn_probability"], []),
        body="SELECT * FROM fbb UNION ALL SELECT * FROM sb",
    ),
    doubles=BASELINE_DOUBLES,
)
def dr14_model_baseline(spark, sf_dir):
    """Feature baselines merged with the score baseline frozen from training scores."""
    return _feature_baseline(spark, sf_dir).unionByName(_score_baseline(spark, sf_dir))


@register(
    "dr13_score_psi",
    O.with_ctes(*_SCORE_SRC, O.baseline_ctes("sb", "train_scores", ["churn_probability"], []),
                O.psi_ctes("sp", "sb", "cur_scores", ["churn_probability"], []), body="SELECT * FROM sp"),
    doubles=PSI_DOUBLES,
)
def dr13_score_psi(spark, sf_dir):
    live = _scores_on(spark, sf_dir, D.CURRENT_DATE).where(F.col(drift.SCORE_FEATURE).isNotNull())
    return drift.psi_table(drift.freeze(_score_baseline(spark, sf_dir)), live, [drift.SCORE_FEATURE], [])


@register("dr13_score_drift_verdict")
def dr13_score_verdict(spark, sf_dir):
    b = drift.freeze(_score_baseline(spark, sf_dir))
    return drift.score_drift(b, _scores_on(spark, sf_dir, D.CURRENT_DATE))


@register("dr16_dq12_drift_decision")
def dr16_decision(spark, sf_dir):
    """The nightly decision: champion churn-v2, newest feature partition against the frozen
    model baseline, score drift, persistence over the drift history, quality override."""
    from riskloom.plans import jobs

    features = D.stored(D.history(spark, sf_dir))
    model_baseline = drift.freeze(_feature_baseline(spark, sf_dir).unionByName(_score_baseline(spark, sf_dir, features)))
    return jobs.run_drift_check(
        features, model_baseline, "churn-v2", D.FEATURE_NUMERIC, D.FEATURE_CATEGORICAL,
        drift_history=D.drift_history(spark, sf_dir), scores=_scores_on(spark, sf_dir, D.CURRENT_DATE, features),
    )


@register("snk12_dr15_rebuild_baseline")
def snk12_rebuild(spark, sf_dir):
    """Rebuild the frozen baseline from the training split (dry run returns the table) and
    re-verify the score baseline against training scores."""
    from riskloom.operators import splits
    from riskloom.plans import jobs

    split_table = splits.stratified_split(D.stored(D.replay_snapshot(spark, sf_dir, D.BASELINE_DATE)), assigned_at="2024-01-20 04:00:00")
    old = drift.freeze(_score_baseline(spark, sf_dir))
    return jobs.rebuild_baseline(
        split_table, D.BASELINE_DATE, D.FEATURE_NUMERIC, D.FEATURE_CATEGORICAL,
        old_baseline=old, train_scores=_scores_on(spark, sf_dir, D.BASELINE_DATE), dry_run=True,
    )
