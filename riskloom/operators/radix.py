"""Exact quantiles and small value sets of many columns by radix histograms.

A double's bits, taken as an unsigned number with the sign flipped (all bits of a negative
one), sort like the double itself.  Four passes over the columns narrow every wanted rank down by 16
bits each: a task counts the next 16 bits of the values whose higher bits are still of
interest, for all columns together; the counts are summed, and the window over at most 65,536 of them finds
the digit that holds the rank.  What is shuffled or kept has a size given by the number of columns
and ranks, not by the number of rows or of distinct values.

The first pass also counts rows and present values, and keeps the values of a column
as long as there are few: a set of at most ``few`` values a task and a mark beyond.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize

DIGIT = 16  # bits a pass
PASSES = 64 // DIGIT
_HELD = 1 << 20  # counters a task holds before it sums them up

ROWS, PRESENT, DIGITS, VALUE, MANY = range(5)


def order_keys(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the doubles; the two zeros are one."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63) == 1, ~bits, bits | np.uint64(1 << 63))


def key_value(key: int) -> float:
    bits = key ^ (1 << 63) if key >> 63 else ~key & ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


class _Counts:
    """Counters by number, summed up in arrays."""

    def __init__(self):
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray) -> None:
        k, n = np.unique(keys, return_counts=True)
        self.keys.append(k)
        self.counts.append(n)
        self.size += len(k)
        if self.size > _HELD:
            self._sum()

    def _sum(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate(self.counts), minlength=len(keys)).astype(np.int64)
        self.keys, self.counts, self.size = [keys], [counts], len(keys) // 2
        return keys, counts

    total = _sum


def _present(batch: pa.RecordBatch, c: int) -> np.ndarray:
    x = batch.column(c).to_numpy(zero_copy_only=False)
    return x[~np.isnan(x)]


_STATS = "feature int, what int, key long, value double, cnt long"


def _first_pass(columns: int, few: int):
    schema = pa.schema([("feature", pa.int32()), ("what", pa.int32()), ("key", pa.int64()), ("value", pa.float64()), ("cnt", pa.int64())])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, present, digits = 0, np.zeros(columns, np.int64), _Counts()
        sets: list[dict[float, int] | None] = [{} for _ in range(columns)]
        for batch in batches:
            rows += batch.num_rows
            for c in range(columns):
                x = _present(batch, c)
                present[c] += len(x)
                digits.add(c << DIGIT | (order_keys(x) >> np.uint64(64 - DIGIT)).astype(np.int64))
                mine = sets[c]
                if mine is not None:
                    kinds, n = np.unique(x + 0.0, return_counts=True)
                    if len(kinds) > few:
                        sets[c] = None
                        continue
                    for v, k in zip(kinds.tolist(), n.tolist(), strict=True):
                        mine[v] = mine.get(v, 0) + k
                    if len(mine) > few:
                        sets[c] = None
        if not rows:
            return
        out = [(c, ROWS, 0, None, rows) for c in range(columns)] + [(c, PRESENT, 0, None, int(present[c])) for c in range(columns)]
        for c, mine in enumerate(sets):
            if mine is None:
                out.append((c, MANY, 0, None, 1))
            else:
                keys = order_keys(np.array(list(mine), np.float64)).view(np.int64).tolist()
                out += [(c, VALUE, k, v, n) for k, (v, n) in zip(keys, mine.items(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        keys, counts = digits.total()
        for a in range(0, len(keys), 100_000):
            k = keys[a : a + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(k >> DIGIT, pa.int32()), pa.array(np.full(len(k), DIGITS), pa.int32()), pa.array(k & (1 << DIGIT) - 1), pa.nulls(len(k), pa.float64()), pa.array(counts[a : a + 100_000])],
                schema=schema,
            )

    return go


def _next_pass(prefixes: dict[int, np.ndarray], done: int):
    """Counts of the next digit of values whose first ``done`` bits are among a column's ``prefixes``."""
    schema = pa.schema([("feature", pa.int32()), ("prefix", pa.int32()), ("digit", pa.int32()), ("cnt", pa.int64())])
    order = sorted(prefixes)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        for batch in batches:
            for c, feature in enumerate(order):
                key = order_keys(_present(batch, c))
                head, mine = key >> np.uint64(64 - done), prefixes[feature]
                at = np.minimum(np.searchsorted(mine, head), len(mine) - 1)
                ok = mine[at] == head
                digit = (key[ok] >> np.uint64(64 - done - DIGIT)).astype(np.int64) & (1 << DIGIT) - 1
                counts.add((feature << 40) | (at[ok].astype(np.int64) << DIGIT) | digit)
        keys, n = counts.total()
        for a in range(0, len(keys), 100_000):
            k = keys[a : a + 100_000]
            cols = [pa.array(k >> 40, pa.int32()), pa.array(k >> DIGIT & (1 << 24) - 1, pa.int32()), pa.array(k & (1 << DIGIT) - 1, pa.int32()), pa.array(n[a : a + 100_000])]
            yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return go


def _doubles(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])


@dataclass
class Radix:
    """Statistics of a frame's numeric columns.  A frame whose plan shuffles is persisted between the passes
    (``close`` lets it go); one that only scans is scanned again, in fewer columns."""

    df: DataFrame
    columns: list[str]
    few: int

    def __post_init__(self):
        self.held = "Exchange" in self.df._jdf.queryExecution().executedPlan().toString()
        rows = _doubles(self.df, self.columns)
        self.rows = rows.persist(StorageLevel.MEMORY_AND_DISK) if self.held else rows
        got = self.rows.mapInArrow(_first_pass(len(self.columns), self.few), _STATS)
        # at most a few numbers and 65,536 digits a column
        self.stats = materialize(got.groupBy("feature", "what", "key").agg(F.max("value").alias("value"), F.sum("cnt").alias("cnt")))

    def close(self) -> None:
        if self.held:
            self.rows.unpersist()

    def _name(self):
        return F.element_at(F.array(*[F.lit(c) for c in self.columns]), F.col("feature") + 1)

    def profile(self) -> DataFrame:
        """(feature, n_rows, n_present, null_rate, kinds, is_few): a row for each column of a frame with rows."""
        count = lambda what: F.coalesce(F.sum(F.when(F.col("what") == what, F.col("cnt"))), F.lit(0))
        kinds = F.coalesce(F.sum((F.col("what") == VALUE).cast("int")), F.lit(0))
        is_few = (F.max((F.col("what") == MANY).cast("int")) == 0) & (kinds <= self.few)
        by = self.stats.where(F.col("what") != DIGITS).groupBy("feature").agg(count(ROWS).alias("n_rows"), count(PRESENT).alias("n_present"), kinds.alias("kinds"), is_few.alias("is_few"))
        rate = F.when(F.col("n_rows") > 0, (F.col("n_rows") - F.col("n_present")) / F.col("n_rows")).otherwise(F.lit(0.0))
        return by.select(self._name().alias("feature"), "n_rows", "n_present", rate.alias("null_rate"), "kinds", "is_few")

    def values(self) -> DataFrame:
        """(feature, value, cnt) of the columns with at most ``few`` distinct values."""
        rows = self.stats.where(F.col("what") == VALUE).select(self._name().alias("feature"), "value", "cnt")
        return rows.join(F.broadcast(self.profile().where("is_few").select("feature")), "feature", "left_semi")  # a row a column

    def quantiles(self, features: list[str], probs: list[float]) -> dict[str, list[float]]:
        """Interpolated quantiles (position p * (n - 1)) of each feature with a present value.

        The driver holds the wanted ranks: two a probability and feature.
        """
        rows = self.stats.where(F.col("what") == PRESENT).select("feature", "cnt").collect()
        n = {r.feature: r.cnt for r in rows if r.cnt and self.columns[r.feature] in features}
        place = {f: [p * (size - 1) for p in probs] for f, size in n.items()}
        ranks = {f: sorted({int(r) for x in ps for r in (math.floor(x), math.ceil(x))}) for f, ps in place.items()}
        wanted = [(f, 0, r, r) for f, rs in ranks.items() for r in rs]  # feature, prefix, rank, rank among the prefix's values
        heads: dict[int, list[int]] = {f: [0] for f in ranks}
        digits = self.stats.where(F.col("what") == DIGITS).select("feature", F.lit(0).alias("prefix"), F.col("key").cast("int").alias("digit"), "cnt")
        found: dict[tuple[int, int], int] = {}
        for done in range(0, 64, DIGIT):
            if not wanted:
                break
            if done:
                order = sorted(heads)
                some = self.rows.select(*[f"c{f}" for f in order])
                prefixes = {f: np.array(heads[f], np.uint64) for f in order}
                digits = some.mapInArrow(_next_pass(prefixes, done), "feature int, prefix int, digit int, cnt long")
                digits = digits.groupBy("feature", "prefix", "digit").agg(F.sum("cnt").alias("cnt"))
            before = Window.partitionBy("feature", "prefix").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)  # 65,536 rows at most
            placed = digits.withColumn("before", F.coalesce(F.sum("cnt").over(before), F.lit(0)))
            asked = self.df.sparkSession.createDataFrame(wanted, "feature int, prefix int, rank long, inside long")
            hit = placed.join(F.broadcast(asked), ["feature", "prefix"]).where("inside >= before and inside < before + cnt")
            hits = hit.select("feature", "prefix", "rank", (F.col("inside") - F.col("before")).alias("inside"), "digit").collect()
            now = {(h.feature, h.rank): (heads[h.feature][h.prefix] << DIGIT | h.digit, h.inside) for h in hits}
            heads = {f: sorted({head for (g, _), (head, _) in now.items() if g == f}) for f in ranks}
            wanted = [(f, heads[f].index(head), rank, inside) for (f, rank), (head, inside) in now.items()]
            found = {at: head for at, (head, _) in now.items()}
        out = {}
        for f, ps in place.items():
            one = []
            for x in ps:
                lo, hi = (key_value(found[f, int(r)]) for r in (math.floor(x), math.ceil(x)))
                frac = x - math.floor(x)
                one.append(lo if frac == 0 or lo == hi else lo + (hi - lo) * frac)
            out[self.columns[f]] = one
        return out
