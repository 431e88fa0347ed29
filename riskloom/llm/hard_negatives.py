"""Hard negatives by a secondary-sort shuffle.

Scores of (anchor, row) pairs are packed into keys whose bytes sort by anchor, then descending score,
then id; ``repartitionAndSortWithinPartitions`` brings an anchor's keys together in that order, and a
streaming iterator opens a window for each positive it meets and gives out the negatives that fall
into the open windows.  It holds an anchor's few windows and nothing else of it.

Pairs are scored in blocks: anchors in blocks of bounded size, rows in strips, one task for each
pair of a block and a strip.  A task sends on only the pairs that may be results: an anchor's best rows of
its own label, then (once its positives are known) the best rows of other labels inside each of
its windows.  So what is shuffled stays in proportion to anchors times strips, not to the pairs.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import arrow_map, batch_of, cut

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # a negative's score in per cent of the positive's
SCALE = 256
BLOCK_ANCHORS = 65_536
STRIP_ROWS = 1 << 20
STRIPS = 24  # at least, so that a small table is shared out too
PACK_ROWS = 4096
TILE_ANCHORS = 128

_NONE = np.iinfo(np.int64).min  # no score
_BIAS = 1 << 63
_KEY = struct.Struct(">QQBQ")  # anchor, descending score, 0 for a positive, id
_PACKED = "cell long, kind int, ids binary, labels binary, vectors binary, dims int, narrow boolean, windows binary"
_SCHEMA = pa.schema(
    [("cell", pa.int64()), ("kind", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary()), ("dims", pa.int32()), ("narrow", pa.bool_()), ("windows", pa.binary())]
)


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, embedding): the rows that take part, one for each vec_id."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(sound)
    label = F.col("label").cast("long")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("one"))
    return one.select("vec_id", "one.label", "one.embedding")


def _matrix(column: pa.Array) -> np.ndarray:
    """floor(256 x) of every component; shorter vectors are filled up with zeros."""
    values, count = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE), column.value_lengths().to_numpy()
    dims = int(count.max(initial=0))
    if (count == dims).all():
        return values.reshape(len(count), dims)
    out = np.zeros((len(count), dims))
    out[np.arange(dims) < count[:, None]] = values
    return out


def _pack(cell: int, kind: int, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, windows: np.ndarray | None) -> list:
    narrow = bool(np.abs(vectors).max(initial=0) < 1 << 15)
    raw = vectors.astype("<i2" if narrow else "<f8").tobytes()
    return [cell, kind, ids.astype("<i8").tobytes(), labels.astype("<i8").tobytes(), raw, vectors.shape[1], narrow, None if windows is None else windows.astype("<i8").tobytes()]


def _unpack(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(batch["ids"][i].as_buffer(), "<i8")
    raw = np.frombuffer(batch["vectors"][i].as_buffer(), "<i2" if batch["narrow"][i].as_py() else "<f8")
    return ids, np.frombuffer(batch["labels"][i].as_buffer(), "<i8"), raw.reshape(len(ids), batch["dims"][i].as_py()).astype(np.float64)


def _strips(vectors: DataFrame, strips: int) -> DataFrame:
    """All rows in packed blocks, dealt over the strips in turn."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId() * 7
        for batch in batches:
            step = max(1, min(PACK_ROWS, -(-batch.num_rows // strips)))
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                order = np.argsort(part.column(0).to_numpy())
                row = _pack(turn % strips, 1, part.column(0).to_numpy()[order], part.column(1).to_numpy()[order], _matrix(part.column(2))[order], None)
                yield batch_of(_SCHEMA, *(pa.array([x], f.type) for x, f in zip(row, _SCHEMA, strict=True)))
                turn += 1

    return vectors.select("vec_id", "label", "embedding").mapInArrow(go, _PACKED)


def _blocks(anchors: DataFrame, blocks: int) -> DataFrame:
    """Anchors (vec_id, label, embedding, windows) in packed blocks; ``cell`` is the block's number."""

    def go(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        block = batch.column(0).to_numpy()
        for b in np.unique(block):
            mine = np.flatnonzero(block == b)
            for a in range(0, len(mine), PACK_ROWS):
                part = batch.take(pa.array(mine[a : a + PACK_ROWS]))
                windows = np.full((part.num_rows, POSITIVES), _NONE)
                for k, scores in enumerate(part.column(4).to_pylist()):
                    windows[k, : len(scores)] = scores
                row = _pack(int(b), 0, part.column(1).to_numpy(), part.column(2).to_numpy(), _matrix(part.column(3)), windows)
                yield batch_of(_SCHEMA, *(pa.array([x], f.type) for x, f in zip(row, _SCHEMA, strict=True)))

    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    return arrow_map(anchors.select(block.alias("block"), "vec_id", "label", "embedding", "windows"), go, _PACKED)


def _scores(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, bool]:
    """(inner products as 64-bit integers, whether they leave room for a row number); exact, or an error."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(d, 1)
    if most < 1 << 52:
        return (a @ b.T).astype(np.int64), most * max(len(b), 1) < 1 << 62
    whole = [[int(x) for x in row] for row in a], [[int(x) for x in row] for row in b]
    got = np.array([[sum(x * y for x, y in zip(p, q, strict=True)) for q in whole[1]] for p in whole[0]], object)
    return got.astype(np.int64), False  # OverflowError where a score isn't a long


def _top(scores: np.ndarray, ok: np.ndarray, ids: np.ndarray, k: int, room: bool) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best (score, id) of each line among ``ok``; columns stand in order of ids."""
    n = scores.shape[1]
    k = min(k, n)
    if room:  # the column goes into the key, so that every key is another one
        key = np.where(ok, scores * n + np.arange(n - 1, -1, -1), _NONE)
        key = np.partition(key, n - k, axis=1)[:, n - k :]
        found = key != _NONE
        score = np.where(found, key // n, _NONE)
        return score, np.where(found, ids[np.where(found, n - 1 - key % n, 0)], 0)
    at = np.argsort(np.where(ok, ~scores, np.iinfo(np.int64).max), axis=1, kind="stable")[:, :k]
    found = np.take_along_axis(ok, at, 1)
    return np.where(found, np.take_along_axis(scores, at, 1), _NONE), np.where(found, ids[at], 0)


class _Best:
    """The best (score, id) of a block's anchors in the strip so far: ``lines`` lists of ``k``."""

    def __init__(self, lines: int, k: int):
        self.score, self.id = np.full((lines, k), _NONE), np.zeros((lines, k), np.int64)

    def add(self, lines: np.ndarray | slice, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score[lines], score], 1), np.concatenate([self.id[lines], ids], 1)
        at = np.lexsort((ids, ~score), axis=1)[:, : self.score.shape[1]]
        self.score[lines], self.id[lines] = np.take_along_axis(score, at, 1), np.take_along_axis(ids, at, 1)


def keys(anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, negative: bool) -> np.ndarray:
    """Packed keys, 25 bytes each: big-endian numbers whose byte order is the order wanted."""
    out = np.zeros(len(ids), np.dtype([("a", ">u8"), ("s", ">u8"), ("k", "u1"), ("i", ">u8")]))
    bias = np.uint64(_BIAS)
    out["a"], out["i"] = anchor.astype(np.int64).view(np.uint64) ^ bias, ids.astype(np.int64).view(np.uint64) ^ bias
    out["s"] = ~(score.astype(np.int64).view(np.uint64) ^ bias)
    out["k"] = negative
    return out


def _unkey(key: bytes) -> tuple[int, int, int, int]:
    a, s, kind, i = _KEY.unpack(key)
    return a - _BIAS, (_BIAS << 1) - 1 - s - _BIAS, kind, i - _BIAS


def _cells(strips: DataFrame, blocks: DataFrame, n_strips: int, n_blocks: int, negatives: bool) -> DataFrame:
    """(key): the packed keys that each pair of a block and a strip sends on."""
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    columns = [f.name for f in _SCHEMA if f.name != "cell"]
    left = blocks.select(every(n_strips).alias("strip"), F.col("cell").alias("block"), *columns)
    right = strips.select(F.col("cell").alias("strip"), every(n_blocks).alias("block"), *columns)
    cells = left.unionByName(right).select((F.col("block") * n_strips + F.col("strip")).alias("cell"), *columns)
    schema = pa.schema([("key", pa.binary())])

    def sent(best: _Best, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        per = len(best.score) // max(len(ids), 1)
        line, k = np.nonzero(best.score != _NONE)
        got = np.unique(keys(ids[line // per], best.score[line, k], best.id[line, k], negatives)) if len(line) else keys(*[np.zeros(0, np.int64)] * 3, negatives)
        for a in range(0, len(got), 100_000):
            yield batch_of(schema, pa.array([x.tobytes() for x in got[a : a + 100_000]], pa.binary()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, best = None, [], None
        ids = labels = vectors = windows = None
        for batch in batches:
            for i in range(batch.num_rows):
                at = batch["cell"][i].as_py()
                if at != cell:
                    if best is not None:
                        yield from sent(best, ids)
                    cell, held, best = at, [], None
                if batch["kind"][i].as_py() == 0:
                    held.append((*_unpack(batch, i), np.frombuffer(batch["windows"][i].as_buffer(), "<i8").reshape(-1, POSITIVES)))
                    continue
                if not held:  # a block without anchors
                    continue
                if best is None:
                    ids, labels, windows = (np.concatenate([h[c] for h in held]) for c in (0, 1, 3))
                    dims = max(h[2].shape[1] for h in held)
                    vectors = np.concatenate([np.pad(h[2], ((0, 0), (0, dims - h[2].shape[1]))) for h in held])
                    held = [True]
                    best = _Best(len(ids) * POSITIVES, NEGATIVES) if negatives else _Best(len(ids), POSITIVES)
                rid, rlabel, rvec = _unpack(batch, i)
                for a in range(0, len(ids), TILE_ANCHORS):
                    b = min(a + TILE_ANCHORS, len(ids))
                    got, room = _scores(vectors[a:b], rvec)
                    same = labels[a:b, None] == rlabel
                    if not negatives:
                        best.add(slice(a, b), *_top(got, same & (ids[a:b, None] != rid), rid, POSITIVES, room))
                        continue
                    for p in range(POSITIVES):
                        low, high = _window(windows[a:b, p])
                        ok = ~same & (got >= low[:, None]) & (got <= high[:, None])
                        some = np.flatnonzero(ok.any(1))
                        if len(some):
                            best.add((a + some) * POSITIVES + p, *_top(got[some], ok[some], rid, NEGATIVES, room))
        if best is not None:
            yield from sent(best, ids)

    n = n_strips * n_blocks
    dealt = cells.repartition(n, "cell").sortWithinPartitions("cell", "kind")
    return dealt.mapInArrow(score, "key binary")


def _window(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score of a negative, in exact integers; an empty range where there is no positive."""
    low = [-(-LOW * int(s) // 100) if s != _NONE else 1 for s in positive]
    high = [HIGH * int(s) // 100 if s != _NONE else 0 for s in positive]
    return np.array(low, np.int64), np.array(high, np.int64)


def _sorted(packed: DataFrame, parts: int):
    """The secondary sort: an anchor's keys in one partition, in the order of their bytes."""
    return packed.rdd.map(lambda r: (bytes(r[0]), None)).repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:8]))


def first_positives(pairs: Iterable[tuple[bytes, None]]) -> Iterator[tuple[int, int, int]]:
    """(anchor, score, id) of the first ``POSITIVES`` keys of each anchor."""
    anchor, n = None, 0
    for key, _ in pairs:
        anchor, n = (anchor, n + 1) if key[:8] == anchor else (key[:8], 1)
        if n <= POSITIVES:
            a, s, _, i = _unkey(key)
            yield a, s, i


def mined(pairs: Iterable[tuple[bytes, None]]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Result rows from sorted keys: a positive opens a window, later negatives fall into the open ones."""
    anchor, windows = None, []
    for key, _ in pairs:
        if key[:8] != anchor:
            anchor, windows = key[:8], []
        a, s, negative, i = _unkey(key)
        if not negative:
            windows.append([i, s, 0])
            continue
        for w in windows:
            if w[2] < NEGATIVES and LOW * w[1] <= 100 * s <= HIGH * w[1]:
                w[2] += 1
                yield a, w[0], w[2], i, w[1], s


def hard_negatives(embeddings: DataFrame, anchors: Column | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, embedding, label, ...).

    Anchors are the rows for which ``anchors`` holds (a condition on vec_id; by default those whose vec_id is divisible by
    100).  Rows with a null vec_id, label, vector or component, or a component that isn't finite, take no part; of
    rows with the same vec_id the one with the least (label, embedding) does, so repeated rows count once.  Ties go to
    the smaller vec_id.  The shorter of two vectors counts as filled up with zeros, an empty one scores 0.
    Components may be of any size; a score that isn't a 64-bit number is an error.  An anchor without positives, or a
    positive without negatives in its window, gives no rows, and neither does an empty table.
    """
    spark = embeddings.sparkSession
    vectors = cut(usable(embeddings), "vectors")
    chosen = vectors.where(anchors if anchors is not None else F.col("vec_id") % 100 == 0)
    total, n = vectors.count(), chosen.count()
    n_blocks, n_strips = max(1, -(-n // BLOCK_ANCHORS)), max(STRIPS, -(-total // STRIP_ROWS))
    parts = max(spark.sparkContext.defaultParallelism, n_blocks * 8)
    strips = cut(_strips(vectors, n_strips), "strips")
    none = F.array().cast("array<long>")
    found = _cells(strips, _blocks(chosen.withColumn("windows", none), n_blocks), n_strips, n_blocks, False)
    positives = spark.createDataFrame(_sorted(found, parts).mapPartitions(first_positives), "vec_id long, score long, id long", verifySchema=False)
    positives = cut(positives, "positives")
    windows = positives.groupBy("vec_id").agg(F.sort_array(F.collect_list("score"), False).alias("windows"))  # five at most
    opened = chosen.join(windows, "vec_id")
    negatives = _cells(strips, _blocks(opened, n_blocks), n_strips, n_blocks, True)

    def packed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        got = keys(*(batch.column(c).to_numpy() for c in range(3)), False)
        yield batch_of(pa.schema([("key", pa.binary())]), pa.array([x.tobytes() for x in got], pa.binary()))

    all_keys = negatives.unionByName(arrow_map(positives.select("vec_id", "score", "id"), packed, "key binary"))
    rows = _sorted(all_keys, parts).mapPartitions(mined)
    return spark.createDataFrame(rows, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long", verifySchema=False)
