"""The pipeline's stages against plain versions, and its registration."""

import random

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from riskloom.llm import queries

from .conftest import prose
from .test_operators import near_components


def test_stages_and_queries_are_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in queries.QUERIES} and set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert set(queries.ORACLE_SQL) <= set(entry.oracle_sql())


def test_stages_keep_clean_rows_and_columns(spark, docs, rows, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([("1", rows[3][1])], "item_id string, text string").write.parquet(f"{sf}/benchmark.parquet")
    with_ids = [r for r in rows if r[0] is not None]
    some = docs.where("doc_id is not null")
    near = corpus_pipeline.near_dedup_stage(spark, some, sf)
    assert near.columns == docs.columns
    assert sorted(r.doc_id for r in near.collect()) == sorted(d for d, _, _, kept in near_components(with_ids) if kept)
    exact = corpus_pipeline.exact_dedup_stage(spark, docs, sf)
    texts = [" ".join((r.text or "").split()) for r in exact.collect() if r.doc_id is not None and r.doc_id != 701]
    assert len(texts) == len(set(texts)) + 1  # white space alone is one space, not the empty text
    clean = corpus_pipeline.decontamination_stage(spark, docs, sf)
    gone = {r.doc_id for r in docs.select("doc_id").collect()} - {r.doc_id for r in clean.collect()}
    assert gone == {3, 103}
    packed = corpus_pipeline.packing_stage(spark, clean, sf)
    assert packed.select(F.countDistinct("doc_id")).first()[0] == clean.select(F.countDistinct("doc_id")).first()[0]


def test_whole_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert 0 < out.select("doc_id").distinct().count() <= docs.count()
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_pipelines_near_stage_links_from_similarity_80(spark, tmp_path):
    rng = random.Random(80)
    made = []
    for n in range(45, 70):  # one word of n changed: similarity (n - 9) / (n + 1), 0.80 at 49 words
        words = prose(rng, n).split(" ")
        made.append((n, " ".join(words)))
        words[n // 2] = "changed"
        made.append((1000 + n, " ".join(words)))
    some = spark.createDataFrame(made, "doc_id long, text string")
    near = dict(corpus_pipeline.STAGES)["near_dedup"](spark, some, str(tmp_path))
    want = sorted(d for d, _, _, kept in near_components(made, 80) if kept)
    assert want == [*range(45, 70), *range(1045, 1049)]
    assert sorted(r.doc_id for r in near.collect()) == want


def test_stages_decide_by_row(spark, tmp_path):
    """Repeated rows of one doc_id, rows without doc_id, and a doc_id on two texts."""
    rng = random.Random(7)
    a, b, c, leak = (prose(rng, 60) for _ in range(4))
    near = " ".join([*b.split(" ")[:-1], "changed"])
    sf = str(tmp_path)
    spark.createDataFrame([("1", leak)], "item_id string, text string").write.parquet(f"{sf}/benchmark.parquet")
    made = [(1, a), (1, a), (1, a), (None, a), (2, a), (2, b), (2, b), (None, near), (3, c), (None, None), (4, leak), (4, c + " x"), (None, leak)]
    some = spark.createDataFrame(made, "doc_id long, text string").withColumn("row_number", F.lit("clash")).repartition(3)
    stage = dict(corpus_pipeline.STAGES)

    def run(name):
        out = stage[name](spark, some, sf)
        assert out.columns == some.columns
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    assert run("exact_dedup") == sorted([(1, a), (2, b), (None, near), (3, c), (None, None), (4, leak), (4, c + " x")], key=str)
    assert run("near_dedup") == sorted([(1, a), (2, b), (3, c), (None, None), (4, leak)], key=str)
    assert run("decontamination") == sorted([r for r in made if r[1] != leak], key=str)


def test_toxicity_stage_decides_by_row(spark, tmp_path, monkeypatch):
    sf = str(tmp_path)
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{sf}/labels.parquet")
    made = [(1, "bad"), (1, "good"), (None, "bad"), (None, "good"), (2, "good")]
    monkeypatch.setattr(corpus_pipeline.toxicity, "train", lambda docs, labels: None)
    monkeypatch.setattr(corpus_pipeline.toxicity, "judged", lambda docs, m: docs.select("doc_id", (F.col("text") == "bad").cast("int").alias("predicted")))
    out = corpus_pipeline.toxicity_stage(spark, spark.createDataFrame(made, "doc_id long, text string"), sf)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(1, "good"), (None, "good"), (2, "good")], key=str)
