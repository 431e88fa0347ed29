"""Spelling variants by dynamic programming over sorted word lists.

Two words with one edit between them share a head or a tail: with ``l`` the shorter length, either
the first ``l // 2`` code points or the last ``l - l // 2``.  Words are dealt out by such a shared
part; a group holds the words of lengths ``l`` and ``l + 1`` that have it, and the words of length ``l`` are
looked up in the group's sorted list.

The lookup is the edit-distance recurrence with a band of one.  A row of the matrix depends on a prefix of the
list word alone, so the rows of adjacent words are the same up to their longest common prefix and
are computed once for the whole range that shares it; a range whose shared prefix is more than one edit away is skipped as a
whole.  All lookups of many groups go down the list's prefixes together, as numpy arrays.

A group of over ``GROUP_WORDS`` words is dealt again by a longer shared part (the same halving, of what
isn't shared yet), until no group is larger: at the end one or two code points are free, which
bounds a group by the alphabet.  Every pair is found in exactly one group, the one that its common prefix names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import arrow_map, batch_of, cut

LEAST_LETTERS = 7
LEAST_COUNT = 2
TIMES = 10  # a form is so many times as frequent as the word
DELETE_ONE_IN = 31
GROUP_WORDS = 20_000
HELD_KINDS = 200_000
FRONT = 1 << 20  # lookups in hand at once

_FAR = np.int8(2)  # any distance beyond one


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all runs of letters after the deletions, from whole texts; counted in each task first."""
    run = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}")
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                head = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(run.findall(text.encode().lower().decode())).items():
                    h = zlib.crc32(word.encode(), head)
                    if h % DELETE_ONE_IN == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < LEAST_LETTERS:
                            continue
                    held[word] += n
                if len(held) > HELD_KINDS:
                    yield batch_of(schema, pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64()))
                    held.clear()
        if held:
            yield batch_of(schema, pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64()))

    counts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(go, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


_MEMBER = "l int, head int, tail int, below int, part string, word string, n long"


def _part() -> F.Column:
    """What a group's words share: the first ``head`` and last ``tail`` code points."""
    return F.concat(F.expr("substring(word, 1, head)"), F.expr("if(tail = 0, '', substring(word, -tail, tail))"))


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumn("part", _part()).selectExpr(*[f"cast({c.split()[0]} as {c.split()[1]}) {c.split()[0]}" for c in _MEMBER.split(", ")])


def memberships(words: DataFrame) -> DataFrame:
    """Four rows for each word: as the shorter (or equal) and as the longer one, with a shared head or tail.
    A group by tail takes only pairs with a common prefix ``below`` a length, so that none is found twice."""
    l = F.explode(F.expr("array(length(word), length(word) - 1)"))
    halves = "array(struct(l div 2 as head, 0 as tail, 2147483647 as below), struct(0 as head, l - l div 2 as tail, l div 2 as below))"
    rows = words.select("word", "n", l.alias("l")).select("word", "n", "l", F.explode(F.expr(halves)).alias("half"))
    return _named(rows.select("word", "n", "l", "half.*"))


def _again(rows: DataFrame) -> DataFrame:
    """The members of a large group, dealt by half of what they don't share yet."""
    halves = """array(struct(head + (l - head - tail) div 2 as head, tail as tail, below as below),
                      struct(head as head, l - head - (l - head - tail) div 2 as tail, least(below, head + (l - head - tail) div 2) as below))"""
    return _named(rows.select("word", "n", "l", F.explode(F.expr(halves)).alias("half")).select("word", "n", "l", "half.*"))


class SortedLists:
    """Groups of sorted words as arrays: all code points in a row, common prefix lengths of neighbours."""

    def __init__(self, words: list[str], group: np.ndarray):
        flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.first = np.cumsum(self.size) - self.size
        self.flat = np.append(flat, np.uint32(0)).astype(np.int64)
        self.words = words
        lcp = np.zeros(len(words), np.int64)
        on = np.flatnonzero(group[1:] == group[:-1]) + 1
        d = 0
        while len(on):  # one step a code point, for the neighbours that still agree
            on = on[(self.size[on] > d) & (self.size[on - 1] > d)]
            on = on[self.flat[self.first[on] + d] == self.flat[self.first[on - 1] + d]]
            d += 1
            lcp[on] = d
        order = np.lexsort((np.arange(len(words)), lcp))
        self.breaks = order  # places, by the common prefix with the word before, then by place
        self.break_key = lcp[order] * (len(words) + 1) + order

    def at(self, word: np.ndarray, d: np.ndarray | int) -> np.ndarray:
        """Code point ``d`` of each word; 0 where it has none."""
        ok = (d >= 0) & (d < self.size[word])
        return np.where(ok, self.flat[np.where(ok, self.first[word] + d, 0)], 0)

    def children(self, lo: np.ndarray, hi: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranges that share one code point more: (index of the range they come from, lo, hi)."""
        n = len(self.words) + 1
        a = np.searchsorted(self.break_key, d * n + lo, "right")
        b = np.searchsorted(self.break_key, d * n + hi, "left")
        count = b - a + 1
        source = np.repeat(np.arange(len(lo)), count)
        k = np.arange(len(source)) - np.repeat(np.cumsum(count) - count, count)
        start = np.where(k == 0, lo[source], self.breaks[np.minimum(np.maximum(a[source] + k - 1, 0), len(self.breaks) - 1)])
        end = np.append(start[1:], 0)
        last = k == count[source] - 1
        return source, start, np.where(last, hi[source], end)


def one_edit_pairs(lists: SortedLists, query: np.ndarray, lo: np.ndarray, hi: np.ndarray, head: np.ndarray, length: np.ndarray, below: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, word) with one edit between them: ``query`` has ``length`` code points, its word stands in the
    sorted range [lo, hi) whose words share its first ``head`` ones, and has that length or one more.

    A row of the banded matrix after ``d`` code points of a list word: the distances to the first
    d - 1, d and d + 1 code points of the query.
    """
    waiting = [(query, lo, hi, head.astype(np.int64), np.ones(len(query), np.int8), np.zeros(len(query), np.int8), np.ones(len(query), np.int8), head.astype(np.int64), length, below)]
    while waiting:
        state = waiting.pop()
        if len(state[0]) > FRONT:
            half = len(state[0]) // 2
            waiting += [tuple(x[:half] for x in state), tuple(x[half:] for x in state)]
            continue
        q, lo, hi, d, left, here, right, prefix, length, below = state
        if not len(q):
            continue
        # the first word of a sorted range may end here; equal words of a list don't occur
        ended = lists.size[lo] == d
        if ended.any():
            dist = np.where(d == length, here, np.where(d == length + 1, left, _FAR))
            found = ended & (dist == 1) & (prefix < below)
            if found.any():
                yield q[found], lo[found]
            lo = lo + ended
            go = lo < hi
            q, lo, hi, d, left, here, right, prefix, length, below = (x[go] for x in (q, lo, hi, d, left, here, right, prefix, length, below))
            if not len(q):
                continue
        source, lo, hi = lists.children(lo, hi, d)
        q, d, left, here, right, prefix, length, below = (x[source] for x in (q, d, left, here, right, prefix, length, below))
        c = lists.at(lo, d)
        before = np.minimum(left + (lists.at(q, d - 1) != c), here + 1)
        same = lists.at(q, d) == c
        diagonal = np.minimum(np.minimum(here + ~same, right + 1), before + 1)
        after = np.minimum(right + (lists.at(q, d + 1) != c), diagonal + 1)
        before, diagonal, after = (np.minimum(x, _FAR).astype(np.int8) for x in (before, diagonal, after))
        prefix = np.where(same & (here == 0) & (prefix == d), d + 1, prefix)
        d = d + 1
        # cells beyond the query's end stand for nothing
        before, diagonal, after = np.where(d - 1 <= length, before, _FAR), np.where(d <= length, diagonal, _FAR), np.where(d + 1 <= length, after, _FAR)
        go = np.minimum(np.minimum(before, diagonal), after) < 2
        waiting.append(tuple(x[go] for x in (q, lo, hi, d, before, diagonal, after, prefix, length, below)))


def near_pairs(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, near, near_n): both directions of every pair of words with one edit between them."""
    members = cut(memberships(words), "members")
    by = ["l", "head", "tail", "part"]
    done = []
    while True:
        large = cut(members.groupBy(by).agg(F.count("*").alias("size")).where((F.col("size") > group_words) & (F.expr("l - head - tail") > 1)).select(by), "large")
        if large.isEmpty():
            done.append(members)
            break
        done.append(members.join(large, by, "left_anti").select(members.columns))
        members = cut(_again(members.join(large, by, "left_semi")), "members")
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])

    def look_up(t: pa.Table) -> Iterator[pa.RecordBatch]:
        """Whole groups, in order of group and word."""
        t = t.combine_chunks()
        l, head, tail, below = (t[c].to_numpy().astype(np.int64) for c in ("l", "head", "tail", "below"))
        part, words, n = t["part"].to_pylist(), t["word"].to_pylist(), t["n"].to_numpy()
        new = np.ones(len(words), bool)
        new[1:] = (l[1:] != l[:-1]) | (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
        for i in np.flatnonzero(~new):
            new[i] = part[i] != part[i - 1]
        group = np.cumsum(new) - 1
        lim = np.append(np.flatnonzero(new), len(words))
        lists = SortedLists(words, group)
        query = np.flatnonzero((lists.size == l) & (np.diff(lim)[group] > 1))
        g = group[query]
        for q, v in one_edit_pairs(lists, query, lim[g], lim[g + 1], head[query], l[query], below[query]):
            # of two words of equal length each finds the other; a longer one is found only from the shorter
            longer = lists.size[v] > lists.size[q]
            a, b = np.concatenate([q, v[longer]]), np.concatenate([v, q[longer]])
            yield batch_of(schema, pa.array([words[i] for i in a], pa.string()), pa.array([words[i] for i in b], pa.string()), n[b])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; the last group of a batch waits for the next batch."""
        wait: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            wait = t if wait is None else pa.concat_tables([wait, t])
            key = [wait[c][-1].as_py() for c in by]
            same = np.ones(wait.num_rows, bool)
            for c, k in zip(by, key, strict=True):
                same &= pa.compute.equal(wait[c], pa.scalar(k, wait.schema.field(c).type)).to_numpy()
            first = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if first:
                yield from look_up(wait.slice(0, first))
                wait = wait.slice(first)
        if wait is not None:
            yield from look_up(wait)

    dealt = rows.repartition(*[F.col(c) for c in by]).sortWithinPartitions(*by, "word")
    return dealt.mapInArrow(go, "word string, near string, near_n long")


def spelling_variants(docs: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs`` (doc_id, text, ...).

    Words are runs of letters of the whole texts, A-Z lower-cased, some with one code point deleted (by the
    checksum of doc_id and run), with at least 7 code points and 2 occurrences.  Null and empty texts have none, a null
    doc_id counts as empty in the checksum, repeated rows count each, words may be of any length;
    an empty table gives no rows.  Of near words that are equally frequent the first in code-point order is the form.
    """
    words = cut(word_counts(docs), "words")
    near = near_pairs(words, group_words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    formed = F.col("n_near").isNotNull() & (-F.col("best.less") >= TIMES * F.col("n"))
    rows = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n"))
    rows = cut(rows, "forms")
    # every step multiplies the count by TIMES at least, so chains are short; each round doubles the step
    step = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        later = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut(step.join(later, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = step.where("moved").isEmpty()
        step = step.select("word", "root")
        if moved:
            break
    return rows.join(step, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
