"""Shared folder, intermediate tables, bounded bit filters and table access of the operators."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir

_made: set[str] = set()  # tables that go when the session's Python ends
_scopes: list[list[str]] = []  # tables that go when the innermost scope ends


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` (shared by driver and executors); it goes at
    the end of the innermost ``Scope``, or without one when the session's Python ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
        return path
    if not _made:
        atexit.register(_clean, spark)
    _made.add(path)
    return path


def free(spark: SparkSession, paths: Iterable[str]) -> None:
    jvm = spark._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _clean(spark: SparkSession) -> None:
    try:
        free(spark, _made)
    except Exception:  # noqa: BLE001  the gateway may already be gone
        pass


class Scope:
    """Lifetime of the intermediate tables made inside a ``with`` block: they are deleted at its end.
    What is to outlive it is written by ``keep`` and belongs to the scope around it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> Scope:
        _scopes.append([])
        return self

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        inner = _scopes.pop()
        try:
            return cut(df, name)
        finally:
            _scopes.append(inner)

    def __exit__(self, *_) -> None:
        free(self.spark, _scopes.pop())


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, no lineage behind it,
    and a lost executor costs a re-read only."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop_table(df: DataFrame) -> None:
    """Delete a table that ``cut`` or ``keep`` returned, before its time."""
    free(df.sparkSession, [df._scratch])
    for paths in [_made, *_scopes]:
        if df._scratch in paths:
            paths.remove(df._scratch)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Arrow batches of at most ``size`` bytes from now on: with whole texts in them Spark's own bound is eight
    times that for each task, in the JVM and again in its Python worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).lower().rstrip("b")) > size:
        spark.conf.set(key, str(size))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one batch."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(go, schema)


class BitFilter:
    """A set of 64-bit keys as a bit table of fixed size: no false negatives.

    Its size (``2**bits`` bits) is a parameter and never grows with the data, so it may be
    sent to every task.  It only spares a later exact join most of the rows that would find
    no partner; when it fills up, more rows go to that join and the result is the same.
    """

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    @staticmethod
    def of(df: DataFrame, column: str, bits: int = 23) -> BitFilter:
        """``column`` holds uniform 64-bit hashes; the driver gets 2**(bits - 6) numbers at most."""
        slot = F.shiftrightunsigned(F.col(column), 64 - bits)
        got = (
            df.where(F.col(column).isNotNull())
            .select(F.shiftright(slot, 6).alias("w"), F.expr("shiftleft(1L, 0)").alias("one"), slot.bitwiseAND(F.lit(63)).cast("int").alias("s"))
            .select("w", F.call_function("shiftleft", F.col("one"), F.col("s")).alias("b"))
            .groupBy("w")
            .agg(F.bit_or("b").alias("b"))
            .toArrow()
        )
        words = np.zeros(max(1, 1 << (bits - 6)), np.int64)
        words[got["w"].to_numpy()] = got["b"].to_numpy()
        return BitFilter(words, bits)

    def contains(self, h: np.ndarray) -> np.ndarray:
        slot = h.view(np.uint64) >> np.uint64(64 - self.bits)
        word = self.words.view(np.uint64)[(slot >> np.uint64(6)).astype(np.int64)]
        return (word >> (slot & np.uint64(63))) & np.uint64(1) == 1

    def shared(self, spark: SparkSession):
        return spark.sparkContext.broadcast(self)

    def flag(self, spark: SparkSession, h: Column) -> Column:
        """Boolean column: may the key be in the set?  Only the hash column goes to Python."""
        sent = self.shared(spark)

        @F.pandas_udf("boolean")
        def test(x: pd.Series) -> pd.Series:
            return pd.Series(sent.value.contains(x.to_numpy(dtype=np.int64)))

        return test(h)


def key_hash(c: Column | str) -> Column:
    """Uniform 64-bit hash of an id; null hashes too, so that a null id never breaks a flag."""
    return F.xxhash64(F.col(c) if isinstance(c, str) else c)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """(``docs`` with a number of its own for each row, that column's name, which clashes with no column).

    Every reader sees the same number.  Rows straight from files have one already: a hash of the file's
    path, tested to be another one for each file, and the row's place in it.  Other rows are written
    with a number."""
    name = "row_number"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    if docs._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation" and "_metadata" not in docs.columns:
        files = docs.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("at")).groupBy("path").agg(F.max("at").alias("at"))
        hashes = [F.shiftrightunsigned(F.xxhash64("path", F.lit(seed)), 33) for seed in range(8)]
        kinds = files.agg(F.count("*").alias("n"), F.max("at").alias("most"), *[F.count_distinct(h).alias(f"h{seed}") for seed, h in enumerate(hashes)]).first()
        for seed in range(len(hashes)):
            if kinds[f"h{seed}"] == kinds["n"] and (kinds["most"] or 0) < 1 << 32:
                file = F.shiftrightunsigned(F.xxhash64(F.col("_metadata.file_path"), F.lit(seed)), 33)
                return docs.withColumn(name, F.shiftleft(file, 32) + F.col("_metadata.row_index")), name
    return cut(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


SENT_IDS = 1 << 20  # at most so many numbers are broadcast


def without(docs: DataFrame, dropped: DataFrame, bits: int = 23, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose ``key`` isn't in ``dropped`` (a table with a column of that name); rows with a
    null key stay.  Up to ``SENT_IDS`` different keys are broadcast, counted before.  Of more, a bit filter
    finds the rows that may be meant, and only those are shuffled for the exact answer."""
    spark = docs.sparkSession
    ids = dropped.select(key).where(F.col(key).isNotNull()).distinct()
    if ids.limit(SENT_IDS + 1).count() <= SENT_IDS:
        return docs.join(F.broadcast(ids), key, "left_anti").select(docs.columns)
    maybe = BitFilter.of(ids.select(key_hash(key).alias("h")), "h", bits).flag(spark, key_hash(key))
    return docs.where(~maybe).unionByName(docs.where(maybe).join(ids, key, "left_anti").select(docs.columns))


def all_but_first(rows: DataFrame, groups: DataFrame, row: str) -> DataFrame:
    """The numbers ``row`` that go when one row of each group stays: the one with the smallest doc_id
    (null last), of several the one with the smallest number.  ``rows`` holds doc_id and ``row``,
    ``groups`` gives ``row`` its ``group``; rows outside of ``groups`` stay."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"), F.col(row).alias("at"))
    members = cut(rows.select(row, place.alias("place")).join(groups.select(row, "group"), row), "members")
    first = members.groupBy("group").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    return members.join(first.select("group", "first"), "group").where(F.col(row) != F.col("first.at")).select(row)


def batch_of(schema: pa.Schema, *columns: pa.Array | np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns], schema=schema)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType | None = None) -> pa.ListArray:
    offs = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(values, kind))
