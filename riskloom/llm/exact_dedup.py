"""Exact de-duplication with counting quotient filters.

Each partition puts the 64-bit fingerprints of its normalised texts into a counting quotient
filter: the high bits (the quotient) choose a home slot, the rest (the remainder) is stored
whole, runs of one quotient stand together sorted by remainder, and a counter goes with each
slot.  As remainders are whole, filters merge without loss: runs of equal quotient are merged
by sorted remainder and their counters added.  The merge is dealt out by ranges of quotients;
a text that fills a third of the rows is one counted slot of each partition's filter.

Fingerprints counted more than once route their texts to the byte check, a grouping by the
whole normalised text; all other texts are known to be single.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import text as T
from riskloom.llm.base import BitFilter, arrow_map, batch_of, cut, key_hash

QUOTIENT_BITS = 10  # most significant bits that deal filters out for the merge
LOAD = 0.75  # share of a filter's slots that are filled


@dataclass
class QuotientFilter:
    """A counting quotient filter of 64-bit fingerprints with ``q`` quotient bits."""

    q: int
    occupied: np.ndarray  # by quotient: has it a run?
    run_end: np.ndarray  # by slot: is it the last of its run?
    remainder: np.ndarray  # by slot
    count: np.ndarray  # by slot; 0: free

    @classmethod
    def of(cls, prints: np.ndarray, counts: np.ndarray | None = None, load: float = LOAD) -> QuotientFilter:
        """From fingerprints (uint64) in any order, repeats allowed."""
        weight = np.ones(len(prints), np.int64) if counts is None else counts
        keys, at = np.unique(prints, return_inverse=True)
        total = np.bincount(at, weights=weight, minlength=len(keys)).astype(np.int64) if len(keys) else np.zeros(0, np.int64)
        q = max(1, int(np.ceil(np.log2(max(2, len(keys) / load)))))
        quotient = (keys >> np.uint64(64 - q)).astype(np.int64)
        ramp = np.arange(len(keys))
        slot = np.maximum.accumulate(quotient - ramp) + ramp if len(keys) else ramp  # pushed on by the runs before
        size = max(1 << q, int(slot[-1]) + 1 if len(keys) else 0)
        f = cls(q, np.zeros(1 << q, bool), np.zeros(size, bool), np.zeros(size, np.uint64), np.zeros(size, np.int64))
        f.occupied[quotient] = True
        if len(keys):
            f.run_end[slot[np.append(quotient[1:] != quotient[:-1], True)]] = True
            f.remainder[slot] = keys & np.uint64((1 << (64 - q)) - 1)
            f.count[slot] = total
        return f

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """All fingerprints, ascending, and their counts: read back from runs and remainders."""
        used = np.flatnonzero(self.count)
        if not len(used):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        run = np.concatenate([[0], np.cumsum(self.run_end[used])[:-1]])
        quotient = np.flatnonzero(self.occupied)[run].astype(np.uint64)
        return (quotient << np.uint64(64 - self.q)) | self.remainder[used], self.count[used]

    def merge(self, other: QuotientFilter) -> QuotientFilter:
        a, b = self.items(), other.items()
        return QuotientFilter.of(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]))


def squeeze(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of [\\x20\\x09-\\x0D] of each text becomes one space."""
    if not len(buf):
        return buf, offs
    space = T.SPACE[buf]
    again = np.zeros(len(buf), bool)
    again[1:] = space[1:] & space[:-1]
    first = offs[:-1]
    again[first[first < len(buf)]] = False
    out = np.where(space, np.uint8(0x20), buf)[~again]
    gone = np.concatenate([[0], np.cumsum(again)])
    return out, offs - gone[offs]


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, text_sha256) of the normalised texts; ``fp`` is the digest's first 64 bits."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), ("text_sha256", pa.string())])

    def digest(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a, b, buf, offs in T.runs(batch.column(1)):
            out, at = squeeze(buf, offs)
            raw = memoryview(out.tobytes())
            sha = [hashlib.sha256(raw[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            fp = np.frombuffer(b"".join(s.digest()[:8] for s in sha), ">u8").astype(np.uint64)
            yield batch_of(schema, batch.column(0).slice(a, b - a), T.signed(fp), pa.array([s.hexdigest() for s in sha]))

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), digest, "doc_id long, fp long, text_sha256 string")


def repeated(prints: DataFrame, quotient_bits: int = QUOTIENT_BITS) -> DataFrame:
    """(fp, n) of the fingerprints that occur more than once, from merged quotient filters."""
    piece = pa.schema([("range", pa.int32()), ("prints", pa.binary()), ("counts", pa.binary())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One filter for the partition, handed on by ranges of quotients.  It grows batch by batch."""
        f = QuotientFilter.of(np.zeros(0, np.uint64))
        for batch in batches:
            f = f.merge(QuotientFilter.of(batch.column(0).to_numpy().view(np.uint64)))
        keys, count = f.items()
        part = (keys >> np.uint64(64 - quotient_bits)).astype(np.int32)
        lim = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else [0]
        rows = list(zip(lim[:-1], lim[1:], strict=True))
        if rows:
            yield batch_of(piece, part[lim[:-1]], pa.array([keys[a:b].tobytes() for a, b in rows], pa.binary()), pa.array([count[a:b].tobytes() for a, b in rows], pa.binary()))

    found = pa.schema([("fp", pa.int64()), ("n", pa.int64())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by range: the filters of a range are merged as they come."""
        now, f = None, None

        def told() -> Iterator[pa.RecordBatch]:
            keys, count = f.items()
            more = count > 1
            if more.any():
                yield batch_of(found, T.signed(keys[more]), count[more])

        for batch in batches:
            for part, keys, counts in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                g = QuotientFilter.of(np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.int64))
                if part != now:
                    if f is not None:
                        yield from told()
                    now, f = part, g
                else:
                    f = f.merge(g)
        if f is not None:
            yield from told()

    pieces = prints.select("fp").mapInArrow(build, "range int, prints binary, counts binary")
    return pieces.repartition("range").sortWithinPartitions("range").mapInArrow(join, "fp long, n long")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Texts are equal when identical after every run of white space became one space; null is an
    empty text, and empty texts are equal to each other.  Of equal texts the smallest doc_id
    stays.  Rows that repeat a doc_id with an equal text are counted in group_size and answered
    alike; a null doc_id stays only if its group has no other.  Empty tables give no rows.
    """
    spark = docs.sparkSession
    prints = cut(fingerprints(docs), "fingerprints")
    more = prints.join(repeated(prints).select("fp"), "fp", "left_semi").select(key_hash("doc_id").alias("h"))
    wanted = BitFilter.of(more, "h").shared(spark)
    schema = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("body", pa.binary())])

    def bodies(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        some = batch.filter(pa.array(wanted.value.contains(batch.column(2).to_numpy())))
        for a, b, buf, offs in T.runs(some.column(1)):
            out, at = squeeze(buf, offs)
            raw = out.tobytes()
            body = [raw[i:j] for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield batch_of(schema, some.column(0).slice(a, b - a), pa.array([hashlib.sha256(x).hexdigest() for x in body]), pa.array(body, pa.binary()))

    long_id = F.col("doc_id").cast("long")
    routed = arrow_map(docs.select(long_id.alias("doc_id"), "text", key_hash(long_id)), bodies, "doc_id long, text_sha256 string, body binary")
    groups = routed.groupBy("text_sha256", "body").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")).drop("body")
    groups = cut(groups.where("group_size > 1"), "equal")
    out = prints.join(groups, "text_sha256", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")
