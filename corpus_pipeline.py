"""Corpus clean-up as a chain of operators; each stage's table is written and read again."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import decontaminate, exact_dedup, near_dedup, packing, toxicity
from riskloom.llm.base import Scope, all_but_first, drop_table, numbered, small_batches, table, without
from riskloom.llm.queries import see_package

# The pipeline's near-duplicate stage: similarity in per cent, and 28 bands of four, which lose a pair of
# that similarity with probability (1 - 0.8**4)**28, 4e-7.
NEAR = {"per_cent": 80, "permutations": 56, "rows": 4}


def by_row(docs: DataFrame, row: str) -> DataFrame:
    """(doc_id, text) for the operators, with the row's number as doc_id: they answer each row for
    itself, also where a doc_id is null, repeated or on two texts."""
    return docs.select(F.col(row).alias("doc_id"), "text")


def prepare(spark: SparkSession) -> None:
    see_package(spark)
    small_batches(spark)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go.  Null and empty texts are scored like any other; without
    labels nothing is learnt and no document is rejected; an empty table stays empty."""
    prepare(spark)
    docs, row = numbered(docs)
    with Scope(spark) as tables:
        model = toxicity.train(docs, table(spark, sf_dir, "labels"))  # labels name documents by doc_id
        judged = toxicity.judged(by_row(docs, row), model)
        gone = tables.keep(judged.where("predicted = 1").select(F.col("doc_id").alias(row)), "toxic")
    return without(docs, gone, key=row).drop(row)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays: one with the smallest doc_id (null last).  Null texts equal empty
    ones; an empty table stays empty."""
    prepare(spark)
    docs, row = numbered(docs)
    with Scope(spark) as tables:
        equal = exact_dedup.exact_duplicates(by_row(docs, row)).where("group_size > 1")
        groups = equal.select(F.col("doc_id").alias(row), F.col("keep_id").alias("group"))
        gone = tables.keep(all_but_first(docs, groups, row), "copies")
    return without(docs, gone, key=row).drop(row)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, **how: int) -> DataFrame:
    """One row of each near-duplicate component stays: one with the smallest doc_id (null last).  Null, empty and
    wordless texts stand alone; an empty table stays empty.
    ``how`` goes to the operator, whose own similarity is 85 per cent; the pipeline's is ``NEAR``."""
    prepare(spark)
    docs, row = numbered(docs)
    with Scope(spark) as tables:
        near = near_dedup.near_duplicates(by_row(docs, row), **how)
        groups = near.select(F.col("doc_id").alias(row), F.col("component_id").alias("group"))
        gone = tables.keep(all_but_first(docs, groups, row), "near")
    return without(docs, gone, key=row).drop(row)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.  Null and empty texts hold none; an empty table or
    benchmark takes nothing away."""
    prepare(spark)
    docs, row = numbered(docs)
    with Scope(spark) as tables:
        found = decontaminate.contamination(by_row(docs, row), table(spark, sf_dir, "benchmark"))
        gone = tables.keep(found.where("contaminated").select(F.col("doc_id").alias(row)), "contaminated")
    return without(docs, gone, key=row).drop(row)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every remaining document and its place in a sequence.  Null and empty texts are their end
    token alone, repeated rows are packed each for itself; an empty table gives no rows."""
    prepare(spark)
    with Scope(spark) as tables:
        return tables.keep(packing.pack(packing.tokens(docs, packing.default_tokenizer())), "packed")


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", partial(near_dedup_stage, **NEAR)),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# Model scores, components and packings can't be written as SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table.

    Every stage numbers its rows, decides on each row by that number, and passes on the rows it
    keeps with all their columns, so extra columns stay and rows with a null or repeated doc_id are
    judged by their own text.  An empty table gives no rows.  A stage's intermediate tables go when its
    output is written, and its input when it is the stage's before.
    """
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with Scope(spark) as tables:
            docs = tables.keep(stage(spark, docs, sf_dir), name)
        if last is not None:
            drop_table(last)
        last = docs
    return docs
