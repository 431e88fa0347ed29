"""Deterministic splits and samples (WN3, WN11, PRJ11, SL4, FN7, FN12).

All orderings use the md5 hex digest of the key (optionally seeded) — reproducible across
runs and engines.  Ranks inside each label stratum are computed with the bucketed ranker
(:mod:`riskloom.operators.ordered`), so a stratum holding most rows is still spread over
many tasks (SURVEY H1); the plain window form is what the oracle runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalar import hash_order_key, ntz_literal
from riskloom.operators.ordered import hex_bucket, ranked

TEST_SIZE = 0.20  # fixed value: share of each stratum held out


def stratified_split(
    features: DataFrame,
    key: str = "customer_id",
    label: str = "churned",
    train_fraction: float = 1 - TEST_SIZE,
    assigned_at=None,
) -> DataFrame:
    """WN3 + PRJ11: ``percent_rank() over (partition by label order by hash(key)) < f`` →
    'train' else 'test'; build timestamps dropped, ``assigned_at`` stamped (PRJ12)."""
    h = hash_order_key(F.col(key))
    x = features.withColumn("_h", h)
    r = ranked(x, [label], ["_h", key], hex_bucket(F.col("_h")))
    pr = F.when(F.col("_group_n") > 1, (F.col("_rank") - 1) / (F.col("_group_n") - 1)).otherwise(F.lit(0.0))
    out = r.withColumn("split", F.when(pr < train_fraction, "train").otherwise("test"))
    stamp = ntz_literal(assigned_at) if assigned_at is not None else F.col("feature_computed_at")
    keep = [c for c in features.columns if c not in ("feature_computed_at", "latest_event_ts")]
    return out.select(*keep, "split", stamp.alias("assigned_at"))


def stratified_folds(df: DataFrame, k: int = 5, seed: int = 42, key: str = "customer_id", label: str = "churned") -> DataFrame:
    """WN11: fold = (row_number within label ordered by md5(seed‖key)) − 1) mod k.

    Each stratum is dealt round-robin over the folds in a seeded pseudo-random order, so
    every fold holds the same label balance (±1 row), like a shuffled stratified k-fold.
    """
    x = df.withColumn("_h", hash_order_key(F.col(key), seed))
    r = ranked(x, [label], ["_h", key], hex_bucket(F.col("_h")))
    return r.select(*df.columns, ((F.col("_row_number") - 1) % k).cast("int").alias("fold"))


def seeded_sample(df: DataFrame, n: int, seed: int = 7, key: str = "event_id") -> DataFrame:
    """SL4 / FN12: reproducible 'ORDER BY RAND() LIMIT n' — the n smallest seeded hashes.

    A top-n (TakeOrderedAndProject): each task keeps n candidates, so nothing beyond n·tasks
    rows moves; the limit is the feature (a sample), not a cap on a result.
    """
    return df.withColumn("_h", hash_order_key(F.col(key), seed)).orderBy("_h", key).limit(n).drop("_h")
