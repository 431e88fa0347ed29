"""Radix histograms against numpy, and the sizes of what they write and shuffle."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift, radix

PROBS = [i / 10 for i in range(11)]


def test_order_keys_sort_like_doubles():
    x = np.array([-np.inf, -1e300, -2.5, -5e-324, -0.0, 0.0, 5e-324, 1e-9, 1.0, 1.0000000000000002, 7e200, np.inf])
    keys = radix.order_keys(x)
    assert (np.diff(keys.astype(object)) >= 0).all() and keys[4] == keys[5]
    assert [radix.key_value(int(k)) for k in keys] == [v + 0.0 for v in x.tolist()]


@pytest.mark.parametrize("shape", ["wide", "narrow", "ties", "signs"])
def test_quantiles_equal_numpy(spark, shape):
    rng = np.random.default_rng(3)
    n = 5_000
    a = {"wide": rng.lognormal(0, 40, n), "narrow": 1e9 + rng.random(n) * 1e-2, "ties": rng.integers(0, 40, n) / 8, "signs": rng.normal(0, 1, n)}[shape]
    b = np.where(rng.random(n) < 0.3, np.nan, rng.normal(5, 2, n))
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b.c": b, "none": np.full(n, np.nan), "one": 1.0})).repartition(7)
    x = radix.Radix(df, ["a", "b.c", "none", "one"], 20)
    got = x.quantiles(["a", "b.c", "none", "one"], PROBS)
    prof = {r.feature: r for r in x.profile().collect()}
    x.close()
    assert got["a"] == pytest.approx(np.quantile(a, PROBS), rel=1e-14, abs=0)
    assert got["b.c"] == pytest.approx(np.quantile(b[~np.isnan(b)], PROBS), rel=1e-14, abs=0)
    assert got["one"] == [1.0] * 11 and "none" not in got
    assert (prof["b.c"].n_rows, prof["b.c"].n_present, prof["b.c"].is_few) == (n, int((~np.isnan(b)).sum()), False)
    assert prof["one"].is_few and prof["none"].is_few and prof["none"].null_rate == 1.0 and prof["a"].is_few is False


def test_few_values_are_counted_exactly_across_tasks(spark):
    """20 values are few, 21 aren't, also when no task sees more than a handful of them."""
    df = spark.range(0, 42_000, 1, 42).select((F.floor(F.col("id") / 1000) % 20).cast("double").alias("twenty"), (F.floor(F.col("id") / 1000) % 21).alias("more"))
    x = radix.Radix(df, ["twenty", "more"], 20)
    assert {r.feature: (r.kinds, r.is_few) for r in x.profile().collect()} == {"twenty": (20, True), "more": (21, False)}
    assert sorted((r.feature, r.value, r.cnt) for r in x.values().collect()) == [("twenty", float(v), 3000 if v < 2 else 2000) for v in range(20)]


def test_a_million_distinct_values_leave_no_table_of_values(spark, monkeypatch):
    sizes = []

    def counted(df, keep=radix.materialize):
        out = keep(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(radix, "materialize", counted)
    monkeypatch.setattr(drift, "materialize", counted)
    n = 1_000_000
    df = spark.range(n).select((F.col("id") * F.lit(0.1) - 20_000).alias("v"), (F.col("id") % 3).alias("d"))
    rows = drift.build_baseline(df, ["v", "d"], []).collect()
    edges = sorted((r.lo, r.hi) for r in rows if r.feature == "v" and r.bucket != drift.NULL_BUCKET)
    want = np.quantile(np.arange(n) * 0.1 - 20_000, PROBS)
    assert [e[0] for e in edges][1:] == pytest.approx(want[1:-1], rel=1e-12) and len(edges) == 10
    assert sum(r.expected for r in rows if r.feature == "v") == pytest.approx(1.0)
    assert sorted(r.bucket_value for r in rows if r.feature == "d" and r.bucket != drift.NULL_BUCKET) == [0, 1, 2]
    assert max(sizes) < 10_000  # digits of the first pass, not values


def test_an_empty_frame_has_no_statistics(spark):
    x = radix.Radix(spark.createDataFrame([], "a double"), ["a"], 20)
    assert x.profile().count() == 0 and x.quantiles(["a"], PROBS) == {}
    assert drift.build_baseline(spark.createDataFrame([], "a double, b string"), ["a"], ["b"]).count() == 0
