import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.operators.ordered import BUCKET_COL, hex_bucket, range_bucketed, ranked, running_sums
from riskloom.operators.quantiles import exact_quantiles, value_counts


def test_narrow_values_spread_over_buckets(spark):
    df = spark.range(20000).select((F.lit(0.9999) + F.col("id") / 1e9).alias("v"))
    dealt = range_bucketed(df, [], "v").groupBy(BUCKET_COL).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("lo").toPandas()
    assert len(dealt) >= 4 and dealt["n"].max() < 20000 / 3
    assert (dealt["hi"][:-1].to_numpy() < dealt["lo"][1:].to_numpy()).all()
    assert dealt[BUCKET_COL].is_monotonic_increasing


def test_quantiles_with_infinity_and_nan(spark):
    vals = [1.0, 2.0, float("inf"), float("nan"), -4.0]
    df = spark.createDataFrame([("f", v) for v in vals], "feature string, value double")
    q = exact_quantiles(value_counts(df, ["feature"], "value"), ["feature"], "value", [0.0, 1 / 3, 1.0]).orderBy("q_index").toPandas()
    assert q["quantile"].tolist() == [-4.0, 1.0, float("inf")]


def test_running_sums_match_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 400), "s": rng.normal(size=400).round(3), "x": rng.integers(0, 5, 400)})
    pdf = pdf.groupby(["g", "s"], as_index=False)["x"].sum()
    df = spark.createDataFrame(pdf)
    out = running_sums(df, ["g"], "s", ["x"], descending=True).toPandas().sort_values(["g", "s"], ascending=[True, False])
    exp = pdf.sort_values(["g", "s"], ascending=[True, False]).copy()
    exp["cum_x"] = exp.groupby("g")["x"].cumsum()
    assert out["cum_x"].tolist() == exp["cum_x"].tolist()


def test_ranked_matches_window_rank(spark):
    rng = np.random.default_rng(9)
    ids = rng.permutation(300)
    df = spark.createDataFrame(pd.DataFrame({"id": ids, "lbl": ids % 3 == 0}))
    df = df.withColumn("h", F.md5(F.col("id").cast("string")))
    out = ranked(df, ["lbl"], ["h", "id"], hex_bucket(F.col("h"))).toPandas()
    exp = df.toPandas()
    exp["r"] = exp.groupby("lbl")["h"].rank(method="min").astype(int)
    m = out.merge(exp, on="id")
    assert (m["_rank"] == m["r"]).all()
    assert (m["_group_n"] == m.groupby("lbl_x")["id"].transform("size")).all()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False).map(lambda x: round(x, 2)), min_size=1, max_size=60))
def test_exact_quantiles_equal_numpy(spark, values):
    df = spark.createDataFrame([("f", v) for v in values], "feature string, value double")
    probs = [i / 10 for i in range(11)]
    q = exact_quantiles(value_counts(df, ["feature"], "value"), ["feature"], "value", probs).orderBy("q_index").toPandas()
    assert np.allclose(q["quantile"].to_numpy(), np.quantile(np.array(values), probs), rtol=1e-12, atol=1e-9)
