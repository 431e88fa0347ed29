import math

from pyspark.sql import functions as F

from riskloom.functions import scalar as S


def test_capped_min_keeps_null_for_never_paid(spark):
    # T1: Spark's least() skips NULL, so "never paid" must not turn into the cap.
    df = spark.createDataFrame([(1, None), (2, 45), (3, 12)], "id int, m int")
    out = {r.id: r.v for r in df.select("id", S.capped_min(F.col("m"), 30).alias("v")).collect()}
    assert out == {1: None, 2: 30, 3: 12}


def test_safe_divide_returns_null_on_zero(spark):
    row = spark.range(1).select(S.safe_divide(F.lit(1), F.lit(0)).alias("a"), S.safe_divide(F.lit(3), F.lit(4)).alias("b")).first()
    assert row.a is None and row.b == 0.75


def test_risk_band_is_lower_inclusive(spark):
    df = spark.createDataFrame([(0.0,), (0.3999,), (0.4,), (0.6999,), (0.7,), (1.0,), (None,)], "p double")
    bands = [r.b for r in df.select(S.risk_band(F.col("p")).alias("b")).collect()]
    assert bands == ["Low", "Low", "Medium", "Medium", "High", "High", None]


def test_clip_ln_floors_at_epsilon(spark):
    r = spark.range(1).select(S.clip_ln(F.lit(0.0)).alias("a")).first()
    assert math.isclose(r.a, math.log(1e-4))


def test_last_segment_and_stale(spark):
    r = spark.range(1).select(
        S.last_segment(F.lit("projects/p/models/churn-v2")).alias("n"),
        S.is_stale("2024-02-01", F.lit("2024-01-30").cast("date")).alias("s"),
        S.is_stale("2024-02-01", F.lit("2024-01-31").cast("date")).alias("t"),
    ).first()
    assert (r.n, r.s, r.t) == ("churn-v2", True, False)


def test_ci_contains_null_is_false(spark):
    df = spark.createDataFrame([("AbC",), (None,), ("xyz",)], "s string")
    assert [r.m for r in df.select(S.ci_contains(F.col("s"), "abc").alias("m")).collect()] == [True, False, False]


def test_arrays_close_handles_infinities(spark):
    inf = float("inf")
    r = spark.range(1).select(
        S.arrays_close(F.array(F.lit(-inf), F.lit(1.0), F.lit(inf)), F.array(F.lit(-inf), F.lit(1.0005), F.lit(inf))).alias("ok"),
        S.arrays_close(F.array(F.lit(1.0)), F.array(F.lit(1.1))).alias("bad"),
    ).first()
    assert r.ok is True and r.bad is False
