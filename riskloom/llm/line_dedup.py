"""Line de-duplication over levelled sorted runs of line keys.

A run is a table of (key, documents that hold the line, largest doc_id), dealt out and sorted by key.  Each
new batch of documents is summed up by key and merge-anti-joined with the runs: lines never
seen before are added as the batch's own run of level 0, the counts of lines that repeat go to
a side table, so runs are disjoint.  When a level has ``FANOUT`` runs they are compacted to
one run of the next level, so a key is rewritten a logarithmic number of times.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import text as T
from riskloom.llm.base import BitFilter, arrow_map, batch_of, cut, key_hash, scratch

FANOUT = 4
MIN_CODE_POINTS = 20
MIN_DOCUMENTS = 3
BATCHES = 6  # at least
BATCH_DOCUMENTS = 1 << 20  # at most, on average: the number of batches grows with the corpus
_SECOND = np.uint64(0x5851F42D4C957F2D)


def split_lines(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, start, end, key start, key end) of each line of a run; an empty text has one."""
    n = len(offs) - 1
    brk = np.flatnonzero(buf == 0x0A)
    start = np.concatenate([offs[:-1], brk + 1])
    doc = np.concatenate([np.arange(n), np.searchsorted(offs, brk, "right") - 1])
    order = np.argsort(doc * (len(buf) + 1) + start - offs[doc], kind="stable") if n else np.arange(0)
    start, doc = start[order], doc[order]
    last = np.ones(len(doc), bool)
    last[:-1] = doc[1:] != doc[:-1]
    end = np.empty_like(start)
    end[:-1] = start[1:] - 1
    end[last] = offs[doc[last] + 1]
    # key borders: nearest byte that isn't white space, from both ends
    solid = np.flatnonzero(~T.SPACE[buf])
    a = np.searchsorted(solid, start)
    b = np.searchsorted(solid, end) - 1
    has = a <= b
    left, right = start.copy(), start.copy()
    left[has] = solid[a[has]]
    right[has] = solid[b[has]] + 1
    return doc, start, end, left, right


def line_keys(buf: np.ndarray, left: np.ndarray, right: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of lines with long enough keys, two 64-bit hashes of their keys)."""
    points = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=points[1:])
    at = np.flatnonzero(points[right] - points[left] >= least)
    one = T.span_hashes(buf, left[at], right[at], lower=True)
    # a second, independent one: each byte weighted by a hash of its value and neighbour
    near = T.LOWER[buf]
    pair = near.astype(np.uint64) << np.uint64(8)
    pair[1:] |= near[:-1]
    fwd, back = T.powers(len(buf) + 1)
    other = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(T.mix(pair * _SECOND) * fwd[: len(buf)], out=other[1:])
    two = T.mix((other[right[at]] - other[left[at] + 1]) * back[left[at]] ^ near[left[at]].astype(np.uint64)) if len(at) else one
    two = T.long_hashes(two, buf, left[at], right[at], lower=True, seed=2)
    return at, one, two


def lines_of(docs: DataFrame, least: int = MIN_CODE_POINTS) -> DataFrame:
    """(doc_id, a, b, part): the distinct long line keys of each document, as 128 bits."""
    schema = pa.schema([("doc_id", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def keys(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, end, buf, offs in T.runs(batch.column(1)):
            doc, _, _, left, right = split_lines(buf, offs)
            at, one, two = line_keys(buf, left, right, least)
            if len(at):
                order = np.lexsort((two, one, doc[at]))
                d, one, two = doc[at][order], one[order], two[order]
                new = np.ones(len(d), bool)
                new[1:] = (d[1:] != d[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
                yield batch_of(schema, batch.column(0).slice(first, end - first).take(pa.array(d[new])), T.signed(one[new]), T.signed(two[new]))

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), keys, "doc_id long, a long, b long")


class LineRuns:
    """The store: sorted runs by level, in the shared folder."""

    SCHEMA = "a long, b long, n long, top long"

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = []
        self.repeats: list[str] = []

    def _keep(self, path: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def _read(self, paths: list[str]) -> DataFrame:
        """All rows of some runs; a batch without fresh or without known keys left no folder."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        there = [p for p in paths if jvm.org.apache.hadoop.fs.Path(p).getFileSystem(conf).exists(jvm.org.apache.hadoop.fs.Path(p))]
        return self.spark.read.schema(self.SCHEMA).parquet(*there) if there else self.spark.createDataFrame([], self.SCHEMA)

    def runs(self) -> DataFrame:
        """Every key ever added, once, with what its first batch held."""
        return self._read([p for level in self.levels for p in level])

    def totals(self) -> DataFrame:
        """(a, b, n, top) over all batches."""
        both = self.runs().unionByName(self._read(self.repeats))
        return both.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("top").alias("top"))

    def add(self, lines: DataFrame) -> None:
        """Add a batch (doc_id, a, b): keys that no run holds become a run, the counts of the
        others go to the repeats."""
        batch = lines.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("doc_id").alias("top"))
        known = self.runs().select("a", "b", F.lit(True).alias("known"))
        told = batch.join(known, ["a", "b"], "left").withColumn("known", F.coalesce("known", F.lit(False)))
        path = scratch(self.spark, "batch")
        told.sortWithinPartitions("known", "a", "b").write.partitionBy("known").parquet(path)
        self._keep(f"{path}/known=false", 0)
        self.repeats.append(f"{path}/known=true")
        level = 0
        while len(self.levels[level]) >= self.fanout:  # runs are disjoint: compacting only sorts them into one
            merged = scratch(self.spark, f"run-l{level + 1}")
            self._read(self.levels[level]).repartition("a", "b").sortWithinPartitions("a", "b").write.parquet(merged)
            self.levels[level] = []
            self._keep(merged, level + 1)
            level += 1


def drop_lines(docs: DataFrame, drops: DataFrame | None, keep_text: bool, least: int) -> DataFrame:
    """Rewrite texts without the lines whose keys are listed for their document in ``drops``
    (doc_id, keys: pairs a, b); with None nothing is dropped."""
    kind = "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + ", text string" * keep_text
    fields = [("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema(fields + [("text", pa.string())] * keep_text)
    listed = drops is not None

    def rewrite(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        marked = batch.column(2) if listed else None
        for first, end, buf, offs in T.runs(batch.column(1)):
            n = end - first
            doc, start, stop, left, right = split_lines(buf, offs)
            gone = np.zeros(len(doc), bool)
            if marked is not None:
                at, one, two = line_keys(buf, left, right, least)
                lim = T.bounds(doc[at], n)
                for i, pairs in enumerate(marked.slice(first, n).to_pylist()):
                    if pairs:
                        bad = {(p["a"], p["b"]) for p in pairs}
                        x, y = T.signed(one[lim[i] : lim[i + 1]]).tolist(), T.signed(two[lim[i] : lim[i + 1]]).tolist()
                        gone[at[lim[i] : lim[i + 1]]] = [p in bad for p in zip(x, y, strict=True)]
            total = np.bincount(doc, minlength=n)
            dropped = np.bincount(doc[gone], minlength=n)
            raw, lim = buf.tobytes(), T.bounds(doc, n)
            kept = []
            for i in range(n):
                if dropped[i]:
                    kept.append(b"\n".join(raw[start[j] : stop[j]] for j in range(lim[i], lim[i + 1]) if not gone[j]))
                else:
                    kept.append(raw[offs[i] : offs[i + 1]])
            out = [batch.column(0).slice(first, n), total, dropped, pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
            yield batch_of(schema, *out, *([pa.array(kept, pa.binary()).cast(pa.string())] * keep_text))

    cols = ["doc_id", "text"] + ["keys"] * (drops is not None)
    return arrow_map((docs if drops is None else docs.join(drops, "doc_id", "left")).select(*cols), rewrite, kind)


def dedup_lines(docs: DataFrame, least: int = MIN_CODE_POINTS, documents: int = MIN_DOCUMENTS, batches: int | None = None, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256[, text]) for every row of ``docs``.

    A line's key is the line stripped of white space at both ends, A-Z lower-cased.  A key of
    ``least`` code points or more that stands in ``documents`` rows or more loses all its lines except
    those of the largest doc_id that holds it.  Documents arrive in ``batches`` batches (by a hash
    of the doc_id, the stand-in for arrival order; the result doesn't depend on it); by default as many as
    ``BATCH_DOCUMENTS`` asks for, and ``BATCHES`` at least.  Null and empty texts are
    one empty line.  Each row counts as a document: a repeated doc_id counts again, and all rows
    with the largest doc_id keep the line; a null doc_id is never the largest and is never rewritten.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if batches is None:
        batches = max(BATCHES, -(-docs.count() // BATCH_DOCUMENTS))
    lines = cut(lines_of(docs, least).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")), "lines")
    store = LineRuns(spark)
    for part in range(batches):
        store.add(lines.where(F.col("part") == part))
    often = store.totals().where((F.col("n") >= documents) & F.col("top").isNotNull()).select("a", "b", "top")
    hits = lines.join(often, ["a", "b"]).where(F.col("doc_id") < F.col("top"))
    drops = cut(hits.groupBy("doc_id").agg(F.collect_list(F.struct("a", "b")).alias("keys")), "drops")  # a document's own lines
    touched = BitFilter.of(drops.select(key_hash("doc_id").alias("h")), "h").flag(spark, key_hash("doc_id"))
    return drop_lines(docs.where(~touched), None, keep_text, least).unionByName(drop_lines(docs.where(touched), drops, keep_text, least))
