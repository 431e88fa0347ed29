"""Streaming jobs and pyspark.ml properties (scores are not compared to another library)."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ml, splits
from riskloom.plans import queries_streaming, sinks
from riskloom.plans.evaluate import evaluate_stage, rejoin_scores, scratch_dir
from riskloom.plans.versions import VersionedTable
from riskloom.sources import derived as D
from riskloom.sources import scans
from riskloom.sources.event_log import activity_log
from riskloom.streaming import landing

from .conftest import SF_SMALL

derived_stored = D.stored


@pytest.mark.parametrize("files", [1, 3])
def test_landing_loses_no_event(spark, files):
    base = scratch_dir(spark, "landing-test")
    raw = activity_log(spark, SF_SMALL)
    raw.repartition(6, "event_id").write.parquet(f"{base}/in")
    landing.land_events(landing.event_stream(spark, f"{base}/in", files), f"{base}/table", f"{base}/ckpt")
    assert spark.read.parquet(f"{base}/table").count() == raw.count()
    assert landing.landed_events(spark, f"{base}/table").count() == raw.select("event_id").distinct().count()


def copies(spark, *rows):
    """(event_id, hour, amount) as events of one customer."""
    full = [(i, dt.datetime(2024, 1, 5) + dt.timedelta(hours=h), 1, "page_view", "EU", "friend", a, "pending", 1, None, 5, 0, False, "web", False) for i, h, a in rows]
    return spark.createDataFrame(full, landing.CDC_SCHEMA)


def test_late_newer_copies_win_one_file_a_trigger(spark):
    base = scratch_dir(spark, "newest-test")
    arrivals = [[(1, 5, 1.0), (2, 5, 1.0)], [(1, 3, 9.0)], [(1, 30, 2.0), (3, 1, 1.0)], [(1, 4, 9.0), (2, 5, 7.0), (2, 2, 9.0)]]
    for k, rows in enumerate(arrivals):
        copies(spark, *rows).coalesce(1).write.mode("append").parquet(f"{base}/in")
        landing.land_newest(landing.event_stream(spark, f"{base}/in", 1), f"{base}/table", f"{base}/ckpt")
    table = VersionedTable(spark, f"{base}/table")
    got = table.read()
    want = landing.dedupe_newest(spark.read.parquet(f"{base}/in"))
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert sorted((r.event_id, r.event_timestamp.day, r.monthly_transaction) for r in got.collect()) == [(1, 6, 2.0), (2, 5, 7.0), (3, 5, 1.0)]
    assert len(table.manifest().batches) == 1 and len(table.versions()) == len(arrivals) - 1  # the older copy of event 1 never reached the table


def test_newest_of_a_stream_equals_batch_staging(spark):
    base = scratch_dir(spark, "newest-test")
    raw = activity_log(spark, SF_SMALL)
    raw.repartition(4, "event_timestamp").write.parquet(f"{base}/in")
    landing.land_newest(landing.event_stream(spark, f"{base}/in", 2), f"{base}/table", f"{base}/ckpt")
    got, want = VersionedTable(spark, f"{base}/table").read().drop("event_date"), landing.dedupe_newest(raw)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_state_goes_after_its_time_to_live(spark):
    """Without state an old copy passes the stream again; the table still keeps the newest."""
    base = scratch_dir(spark, "newest-test")
    short = dt.timedelta(milliseconds=1)
    for rows in ([(1, 5, 1.0)], [(1, 3, 9.0)], [(2, 1, 1.0)]):
        copies(spark, *rows).coalesce(1).write.mode("append").parquet(f"{base}/in")
        q = landing.land_newest(landing.event_stream(spark, f"{base}/in", 1), f"{base}/table", f"{base}/ckpt", short)
        state = q.lastProgress["stateOperators"][0]["numRowsTotal"] if q.lastProgress["stateOperators"] else 0
    assert state <= 2
    got = VersionedTable(spark, f"{base}/table").read().collect()
    assert sorted((r.event_id, r.monthly_transaction) for r in got) == [(1, 1.0), (2, 1.0)]


def test_state_is_held_by_few_keys_and_counts_by_event(spark, monkeypatch):
    """Many events share a key of state; each is judged by its own newest copy, also without an id or a time."""
    monkeypatch.setattr(landing, "STATE_KEYS", 4)
    base = scratch_dir(spark, "newest-test")
    kind = landing.T.StructType([landing.T.StructField(f.name, f.dataType) for f in landing.CDC_SCHEMA])

    def arrive(*rows):
        full = [(i, h and dt.datetime(2024, 1, 5, h, 0, 0, 1), 1, None, "EU", None, a, None, None, None, None, None, None, None, None) for i, h, a in rows]
        spark.createDataFrame(full, kind).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        return landing.land_newest(stream, f"{base}/table", f"{base}/ckpt")

    arrive(*[(i, 5, float(i)) for i in range(40)], (0, 4, -1.0), (-7, 5, 1.0), (None, 5, 1.0), (50, None, 1.0))
    q = arrive(*[(i, 4 + i % 3, 100.0 + i) for i in range(40)], (-7, 6, float("nan")), (None, 6, 2.0), (50, None, 2.0), (2**60 + 1, 1, 3.0))
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 5
    got = {r.event_id: r.monthly_transaction for r in VersionedTable(spark, f"{base}/table").read().collect()}
    want = {i: float(i) if i % 3 == 0 else 100.0 + i for i in range(40)} | {None: 2.0, 50: 2.0, 2**60 + 1: 3.0}
    assert np.isnan(got.pop(-7)) and got == want


SCORES = "customer_id long, snapshot_date date, churn_probability double, predicted_at timestamp_ntz"


def scores(spark, *rows):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame([(c, day + dt.timedelta(d), p, dt.datetime(2024, 1, 1, h)) for c, d, p, h in rows], SCORES)


def held(table):
    return sorted((r.customer_id, r.snapshot_date.day, r.churn_probability) for r in table.read().collect())


def test_upsert_raises_when_the_table_cannot_be_read(spark):
    base = scratch_dir(spark, "upsert-test")
    rows = scores(spark, (1, 0, 0.5, 3))
    rows.write.parquet(f"{base}/in")
    table = VersionedTable(spark, f"{base}/target")
    table.replace(rows)
    name = table.manifest().parts["2024-01-01"][0]
    for f in os.listdir(f"{base}/target/data/{name}"):
        if f.startswith("part-"):
            with open(f"{base}/target/data/{name}/{f}", "w") as out:
                out.write("not parquet")
    stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
    with pytest.raises(Exception):  # noqa: B017
        landing.upsert_scores(stream, f"{base}/target", f"{base}/ckpt")
    assert table.versions() == [1]


def test_a_batch_counts_once(spark):
    table = VersionedTable(spark, scratch_dir(spark, "upsert-test"))
    keys = ["customer_id", "snapshot_date"]
    first, second = scores(spark, (1, 0, 0.5, 3), (2, 0, 0.4, 3), (2, 1, 0.3, 3)), scores(spark, (2, 0, 0.9, 4))
    assert landing.merge_scores(table, keys, first, 0, "q") == 1
    assert landing.merge_scores(table, keys, second, 1, "q") == 2
    want = [(1, 1, 0.5), (2, 1, 0.9), (2, 2, 0.3)]
    assert held(table) == want
    assert landing.merge_scores(table, keys, first, 0, "q") is None  # replayed: it would bring 0.4 back
    assert landing.merge_scores(table, keys, second, 1, "q") is None
    assert held(table) == want and table.versions() == [1, 2]
    assert landing.merge_scores(table, keys, scores(spark, (1, 0, 0.1, 5)), 0, "another") == 3  # its own numbers


def test_a_batch_that_dies_before_its_commit_leaves_nothing(spark, monkeypatch):
    table = VersionedTable(spark, scratch_dir(spark, "upsert-test"))
    keys = ["customer_id", "snapshot_date"]
    landing.merge_scores(table, keys, scores(spark, (1, 0, 0.5, 3)), 0, "q")
    late = scores(spark, (1, 0, 0.7, 4), (3, 0, 0.6, 4))

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(VersionedTable, "_publish", dies)
    with pytest.raises(RuntimeError):
        landing.merge_scores(table, keys, late, 1, "q")
    monkeypatch.undo()
    assert held(table) == [(1, 1, 0.5)] and table.done("q") == 0
    landing.merge_scores(table, keys, late, 1, "q")
    assert held(table) == [(1, 1, 0.7), (3, 1, 0.6)]


def test_a_restarted_stream_does_not_repeat_its_batches(spark):
    base = scratch_dir(spark, "upsert-test")
    for hour, rows in ((3, [(1, 0, 0.5, 3)]), (4, [(1, 0, 0.7, 4), (2, 1, 0.2, 4)])):
        scores(spark, *rows).write.mode("append").parquet(f"{base}/in")
        landing.upsert_scores(spark.readStream.schema(scores(spark, (1, 0, 0.5, 3)).schema).parquet(f"{base}/in"), f"{base}/target", f"{base}/ckpt")
    table = VersionedTable(spark, f"{base}/target")
    assert held(table) == [(1, 1, 0.7), (2, 2, 0.2)] and list(table.manifest().batches.values()) == [1]


def test_scores_arrive_in_a_file_per_day(spark, monkeypatch):
    """A small day is one file, however many tasks wrote the rows: a stream of few batches, the later ones merged."""
    seen = []
    merge = landing.merge_scores
    monkeypatch.setattr(landing, "merge_scores", lambda *a: seen.append(merge(*a)) or seen[-1])
    monkeypatch.setattr(queries_streaming.D, "stored", lambda df: derived_stored(df.repartition(5)))
    out = queries_streaming.st3_upsert(spark, SF_SMALL)
    assert seen == [1, 2]
    assert out.count() == D.predictions(spark, SF_SMALL).count()


def test_stratified_folds_are_balanced(spark):
    snap = D.snapshot(spark, SF_SMALL)
    f = splits.stratified_folds(snap, k=5).groupBy("churned", "fold").count().toPandas()
    for _, g in f.groupby("churned"):
        assert g["count"].max() - g["count"].min() <= 1


@pytest.fixture(scope="module")
def trained(spark):
    snap = D.stored(D.snapshot(spark, SF_SMALL))
    return snap, ml.fit(snap, D.FEATURE_NUMERIC, D.FEATURE_CATEGORICAL, {"maxIter": 5, "maxDepth": 2})


def test_model_scores_are_probabilities_and_deterministic(spark, trained):
    snap, model = trained
    a = ml.score(model, snap, D.FEATURE_NUMERIC).orderBy("customer_id").collect()
    again = ml.fit(snap, D.FEATURE_NUMERIC, D.FEATURE_CATEGORICAL, {"maxIter": 5, "maxDepth": 2})
    b = ml.score(again, snap, D.FEATURE_NUMERIC).orderBy("customer_id").collect()
    assert all(0.0 <= r.churn_probability <= 1.0 for r in a)
    assert [r.churn_probability for r in a] == pytest.approx([r.churn_probability for r in b])


def test_importances_cover_every_feature(trained):
    _, model = trained
    imp = ml.feature_importance(model, D.FEATURE_NUMERIC, D.FEATURE_CATEGORICAL)
    assert set(imp) == set(D.FEATURE_NUMERIC + D.FEATURE_CATEGORICAL)
    assert sum(imp.values()) == pytest.approx(1.0)


def test_candidates_respect_bounds():
    for c in ml.draw_candidates(20, seed=1):
        for name, (lo, hi, _, typ) in ml.SEARCH_SPACE.items():
            assert lo <= c[name] <= hi and isinstance(c[name], typ)


def test_defaults_respect_bounds():
    assert set(ml.DEFAULT_PARAMS) == set(ml.SEARCH_SPACE)
    for name, (lo, hi, _, _) in ml.SEARCH_SPACE.items():
        assert lo <= ml.DEFAULT_PARAMS[name] <= hi, name


def test_candidates_cover_the_whole_declared_space():
    drawn = ml.draw_candidates()
    assert len(drawn) == ml.TRIALS == 100
    depths, trees = ([c[x] for c in drawn] for x in ("maxDepth", "maxIter"))
    assert min(depths) == 3 and max(depths) == 10 and min(trees) < 100 and max(trees) > 450


def test_sweep_equals_a_plain_loop_over_fitted_models(spark):
    """Real models on a small table: per candidate the mean and spread of the folds' average precision."""
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, 90)
    made = [(i, float(x[i]), "ab"[i % 2], bool(x[i] + rng.normal() > 0), i % 2) for i in range(90)]
    folded = spark.createDataFrame(made, "customer_id long, x double, c string, churned boolean, fold int")
    candidates = [{"maxDepth": 2, "maxIter": 3}, {"maxDepth": 3, "maxIter": 2}]
    got = {r.candidate: r for r in ml.sweep(folded, ["x"], ["c"], 2, candidates).collect()}
    means = []
    for i, params in enumerate(candidates):
        precision = []
        for j in range(2):
            model = ml.fit(folded.where(F.col("fold") != j), ["x"], ["c"], params)
            rest = folded.where(F.col("fold") == j)
            scored = {r.customer_id: r.churn_probability for r in ml.score(model, rest, ["x"]).collect()}
            y = np.array([churned for i_, _, _, churned, f in made if f == j], float)
            p = np.array([scored[i_] for i_, _, _, _, f in made if f == j])
            levels = np.unique(p)[::-1]
            recall = np.array([0.0] + [y[p >= t].sum() / y.sum() for t in levels])
            precision.append(float(sum((recall[k + 1] - recall[k]) * y[p >= t].mean() for k, t in enumerate(levels))))
        assert got[i].mean_pr_auc == pytest.approx(np.mean(precision), abs=1e-9)
        assert got[i].std_pr_auc == pytest.approx(np.std(precision), abs=1e-9)
        means.append(np.mean(precision))
    assert [got[i].is_best for i in range(2)] == [m == max(means) for m in means]


def test_prediction_shards_have_the_names_that_the_reader_takes(spark):
    d = scratch_dir(spark, "t")
    rows = spark.createDataFrame([(str(i), (i / 10, i > 4)) for i in range(10)], "customer_id string, prediction struct<churn_probability:double, churn_prediction:boolean>").repartition(3)
    sinks.prediction_shards(rows, d)
    assert all(n.startswith("prediction.results-0000") for n in os.listdir(d) if not n.endswith(".crc"))
    assert sorted((r.customer_id, r.churn_probability) for r in scans.read_prediction_shards(spark, d).collect()) == [(str(i), i / 10) for i in range(10)]


def test_rejoin_raises_on_missing_ids(spark):
    d = scratch_dir(spark, "t")
    spark.createDataFrame([("1", 0.5)], "customer_id string, churn_probability double").write.json(d)
    scores = spark.read.json(d).withColumn("_place", F.monotonically_increasing_id())
    req = spark.createDataFrame([("1", 1), ("2", 0)], "customer_id string, y int")
    with pytest.raises(LookupError):
        rejoin_scores(req, scores)


def test_rejoin_keeps_the_last_record(spark):
    d = scratch_dir(spark, "t")
    os.makedirs(d)
    for name, p in (("prediction.results-00001", [0.2, 0.9]), ("prediction.results-00000", [0.4])):
        with open(f"{d}/{name}", "w") as f:
            f.writelines(f'{{"customer_id": "1", "prediction": {{"churn_probability": {x}, "churn_prediction": true}}}}\n' for x in p)
    req = spark.createDataFrame([("1", 1)], "customer_id string, y int")
    assert rejoin_scores(req, scans.read_prediction_shards(spark, d)).first().churn_probability == 0.9


def test_training_with_an_empty_column_and_many_levels(spark):
    rows = spark.range(400).select(F.col("id").alias("customer_id"), (F.col("id") % 3 == 0).alias("churned"), F.lit(None).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"), (F.col("id") % 90).cast("string").alias("c"))
    model = ml.fit(rows, ["a", "b"], ["c"], {"maxIter": 2, "maxDepth": 2})
    assert ml.score(model, rows, ["a", "b"]).count() == 400


def test_boosting_has_a_task_for_many_rows_not_for_each_partition(spark, monkeypatch):
    seen = []

    class Booster(ml.GBTClassifier):
        def _fit(self, dataset):
            seen.append(dataset.rdd.getNumPartitions())
            return super()._fit(dataset)

    monkeypatch.setattr(ml, "GBTClassifier", Booster)
    noise = (F.xxhash64("id") % 1000).cast("double")
    rows = spark.range(300).select(F.col("id").alias("customer_id"), (noise % 3 == 0).alias("churned"), (noise / 7).alias("a"), (F.col("id") % 4).cast("string").alias("c"), (F.col("id") % 2).cast("int").alias("fold"))
    few = {"maxIter": 4, "maxDepth": 3}
    for n in (3, 7):
        ml.fit(rows.repartition(n), ["a"], ["c"], few)
    assert seen == [1, 1]
    ml.fold_scores(rows.repartition(7), ["a"], ["c"], 2, [few])
    assert seen == [1] * 4
    monkeypatch.setattr(ml, "ROWS_PER_TASK", 100)
    ml.fit(rows.repartition(7), ["a"], ["c"], few)
    assert seen[-1] == 3


def test_evaluate_stage_with_fixed_scores(spark):
    rows = spark.createDataFrame([(1, True), (2, False), (3, True), (4, False)], "customer_id long, churned boolean")

    def scorer(scores):
        table = F.create_map(*[F.lit(x) for pair in scores.items() for x in pair])

        def run(instances, out):
            p = F.struct(F.element_at(table, F.col("customer_id")).alias("churn_probability"), F.lit(True).alias("churn_prediction"))
            instances.select(F.col("customer_id").cast("string").alias("customer_id"), p.alias("prediction")).write.json(out)

        return run

    good, bad = scorer({1: 0.9, 2: 0.1, 3: 0.8, 4: 0.2}), scorer({1: 0.1, 2: 0.9, 3: 0.2, 4: 0.8})
    r = evaluate_stage(rows, good, 0.5, bad, 0.5, glob="part-*").first()
    assert r.promote and r.challenger_pr_auc == 1.0 and r.challenger_f1 == 1.0 and r.champion_f1 == 0.0
    assert evaluate_stage(rows, bad, 0.5, good, 0.5, glob="part-*").first().promote is False
