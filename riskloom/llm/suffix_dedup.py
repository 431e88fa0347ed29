"""Removal of repeated byte strings with difference-cover suffix sorting.

A repeat is a string of ``LENGTH`` bytes that starts at two places of the corpus or more.

1. Reduction without loss.  Each window of ``LENGTH`` bytes is owned by the 64-byte core in it whose
   hash is least (leftmost of equals), so equal windows have equal cores at equal offsets.  Only windows whose
   core occurs again can repeat.  The windows one core occurrence owns form a fragment; a
   fragment that occurs again, whole, is a repeat throughout.
2. Fragments that differ but share a core hold all that is left to decide.  Spark deals them out by
   core; a task sorts the suffixes of its fragments by the difference-cover algorithm:
   sort and name the triples at positions 1 and 2 modulo 3, recurse on the names, sort the remaining
   suffixes by first byte and the rank after it, merge, and compare adjacent prefixes.
3. Repeats become byte ranges of documents, which are joined, merged and cut out.

A core with more than ``CLASS`` different fragments isn't handed to one task: its windows are summed up by their
digest, which Spark combines before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import text as T
from riskloom.llm.base import BitFilter, arrow_map, batch_of, cut, key_hash

LENGTH = 200
CORE = 64
CLASS = 20_000
SORTED_BYTES = 1 << 19  # suffixes sorted at once, whole classes
RUN = 1 << 18
NO_ID = -(1 << 63)


def owned_windows(buf: np.ndarray, offs: np.ndarray, sums: np.ndarray, length: int, core: int) -> tuple[np.ndarray, ...]:
    """(core hash, fragment hash, document, first window start, number of windows) of each fragment of a run."""
    none = np.zeros(0, np.int64)
    if len(buf) < length:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    _, back = T.powers(len(buf) + 1)
    h = (sums[core:] - sums[:-core]) * back[: len(buf) - core + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    span, w = length - core + 1, 1
    while 2 * w <= span:  # minimum over 2, 4, 8, ... cores, then over all of a window
        least = np.minimum(least[:-w], least[w:])
        w *= 2
    if w < span:
        least = np.minimum(least[: len(least) - (span - w)], least[span - w :])
    inside = np.zeros(len(least) + 1, np.int32)
    full = np.diff(offs) >= length
    np.add.at(inside, offs[:-1][full], 1)
    np.add.at(inside, offs[1:][full] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if not len(at):
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    owner = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)]))
    last = np.append(first[1:], len(at)) - 1
    s1, s2, p = at[first], at[last], owner[first]
    own = T.long_hashes(T.span_hash(sums, s1, s2 + length), buf, s1, s2 + length) ^ T.mix((p - s1 + 1).astype(np.uint64))
    return T.span_hash(sums, p, p + core), own, np.searchsorted(offs, s1, "right") - 1, s1, s2 - s1 + 1


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of ``text`` (numbers from 1) in order, by the difference cover {1, 2} modulo 3."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    s = np.concatenate([text.astype(np.int64), np.zeros(3, np.int64)])
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    size = int(s.max()) + 1
    if size < 1 << 21:
        key = (s[sample] * size + s[sample + 1]) * size + s[sample + 2]
    else:  # names too large for one number: name pairs first
        pair = np.unique(s[sample] * size + s[sample + 1], return_inverse=True)[1]
        key = pair * size + s[sample + 2]
    kinds, name = np.unique(key, return_inverse=True)
    if len(kinds) == len(sample):
        order = np.argsort(name)
    else:
        order = suffix_array(name + 1)
    rank = np.zeros(n + 3, np.int64)
    sorted_sample = sample[order]
    rank[sorted_sample] = np.arange(1, len(sample) + 1)
    top = len(sample) + 2
    rest = np.arange(0, n, 3)
    rest_key = s[rest] * top + rank[rest + 1]
    by = np.argsort(rest_key, kind="stable")
    rest, rest_key = rest[by], rest_key[by]
    sorted_sample = sorted_sample[sorted_sample < n]
    a, b = sorted_sample[sorted_sample % 3 == 1], sorted_sample[sorted_sample % 3 == 2]
    # how many sampled suffixes come before each of the rest: both kinds compare by symbols and a rank
    before = np.searchsorted(s[a] * top + rank[a + 1], rest_key)
    if size < 1 << 20:
        before += np.searchsorted((s[b] * size + s[b + 1]) * top + rank[b + 2], (s[rest] * size + s[rest + 1]) * top + rank[rest + 2])
    else:
        both = np.unique(np.concatenate([s[b] * size + s[b + 1], s[rest] * size + s[rest + 1]]), return_inverse=True)[1]
        before += np.searchsorted(both[: len(b)] * top + rank[b + 2], both[len(b) :] * top + rank[rest + 2])
    out = np.empty(n, np.int64)
    place = np.arange(len(rest)) + before
    taken = np.zeros(n, bool)
    taken[place] = True
    out[place] = rest
    out[~taken] = sorted_sample
    return out


def repeated_starts(fragments: list[bytes], windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(fragment, start) of each window that occurs at another place of the fragments.

    Fragment i holds windows[i] window starts, from its first byte on.
    """
    joined = b"\x00".join(fragments) + b"\x00"  # shifted below: a separator is 1, byte b is b + 2
    raw = np.frombuffer(joined, np.uint8)
    size = np.array([len(f) for f in fragments])
    base = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    text = raw.astype(np.int64) + 2
    text[base + size] = 1
    mark = np.zeros(len(raw) + 1, np.int32)
    mark[base] += 1
    mark[base + windows] -= 1
    start = np.cumsum(mark[:-1]) > 0
    order = suffix_array(text)
    p, q = order[:-1], order[1:]
    ok = start[p] & start[q]
    p, q = p[ok], q[ok]
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    word = np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(raw)]
    word = np.ascontiguousarray(word).view(np.uint64).ravel()
    for off in [*range(0, length - 7, 8), length - 8]:
        same = word[p + off] == word[q + off]
        p, q = p[same], q[same]
    hit = np.unique(np.concatenate([p, q]))
    of = np.searchsorted(base, hit, "right") - 1
    return of, hit - base[of]


def _scan(length: int, core: int, sent, what: str):
    """Map function over (did, text): ``cores`` gives all core hashes, ``rows`` those fragments whose core is
    in the filter, ``bytes`` those whose fragment hash is, with their bytes."""
    fields = [("core", pa.int64()), ("frag", pa.int64()), ("did", pa.int64()), ("tk", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("body", pa.binary())]
    schema = pa.schema(fields[: {"cores": 1, "rows": 6, "bytes": 7}[what]])

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a, b, buf, offs in T.runs(batch.column(1), RUN):
            sums = T.prefix_hash(buf)
            c, f, doc, at, n = owned_windows(buf, offs, sums, length, core)
            if what == "cores":
                yield batch_of(schema, T.signed(c))
                continue
            ok = np.flatnonzero(sent.value.contains(c if what == "rows" else f))
            if not len(ok):
                continue
            c, f, doc, at, n = c[ok], f[ok], doc[ok], at[ok], n[ok]
            tk = T.signed(T.long_hashes(T.span_hash(sums, offs[:-1], offs[1:]), buf, offs[:-1], offs[1:]))
            cols = [T.signed(c), T.signed(f), batch.column(0).slice(a, b - a).take(pa.array(doc)), tk[doc], (at - offs[doc]).astype(np.int32), n.astype(np.int32)]
            if what == "bytes":
                raw = buf.tobytes()
                cols.append(pa.array([raw[i:j] for i, j in zip(at.tolist(), (at + n + length - 1).tolist(), strict=True)], pa.binary()))
            yield batch_of(schema, *cols)

    return scan, ", ".join(f"{f.name} {'binary' if f.name == 'body' else 'int' if f.name in ('at', 'n') else 'long'}" for f in schema)


def _sort_classes(length: int):
    """Over rows (core, single, did, tk, at, n, body) sorted by core: ranges of single fragments' repeats."""
    schema = pa.schema([("did", pa.int64()), ("tk", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])

    def solve(wait: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(wait)
        of, start = repeated_starts(t["body"].to_pylist(), t["n"].to_numpy().astype(np.int64), length)
        single = t["single"].to_numpy(zero_copy_only=False)
        keep = single[of]
        of, start = of[keep], start[keep]
        if len(of):
            first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (start[1:] != start[:-1] + 1)]))
            last = np.append(first[1:], len(of)) - 1
            o = of[first]
            at = t["at"].to_numpy().astype(np.int64)[o]
            yield batch_of(schema, t["did"].to_numpy()[o], t["tk"].to_numpy()[o], at + start[first], at + start[last] + length)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            core = batch.column(0).to_numpy()
            size = np.cumsum(batch.column(batch.schema.get_field_index("n")).to_numpy().astype(np.int64) + length)
            edges = np.flatnonzero(np.concatenate([[True], core[1:] != core[:-1]])).tolist()
            if wait and edges and core[0] == wait[-1].column(0)[-1].as_py():
                edges = edges[1:]
            a = 0
            for e in edges:  # cut only where a class begins
                before = held + int(size[e - 1] - (size[a - 1] if a else 0)) if e else held
                if before >= SORTED_BYTES:
                    if e > a:
                        wait.append(batch.slice(a, e - a))
                    yield from solve(wait)
                    wait, held, a = [], 0, e
            if batch.num_rows > a:
                wait.append(batch.slice(a))
                held += int(size[-1] - (size[a - 1] if a else 0))
        if wait:
            yield from solve(wait)

    return go


def repeated_ranges(docs: DataFrame, length: int = LENGTH, core: int = CORE, largest: int = CLASS, bits: int = 24) -> DataFrame:
    """(did, tk, lo, hi): byte ranges of documents (id, hash of the text) that repeats cover; they overlap."""
    spark = docs.sparkSession

    def scanned(what: str, sent=None) -> DataFrame:
        scan, kind = _scan(length, core, sent, what)
        return arrow_map(docs.select("did", "text"), scan, kind)

    again = cut(scanned("cores").groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"), "cores")
    rows = cut(scanned("rows", BitFilter.of(again, "core", bits).shared(spark)), "fragments")
    groups = rows.groupBy("core", "frag").agg(F.count("*").alias("times"), F.min(F.struct("did", "tk", "at")).alias("rep"))
    groups = cut(groups, "groups")
    whole = rows.join(groups.where("times > 1").select("core", "frag"), ["core", "frag"]).select("did", "tk", F.col("at").cast("long").alias("lo"), (F.col("at") + F.col("n") - 1 + length).cast("long").alias("hi"))
    classes = groups.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1")
    open_ones = cut(groups.join(classes, "core").select("core", "frag", (F.col("times") == 1).alias("single"), "kinds", "rep.did", "rep.tk", "rep.at"), "open")
    bodies = scanned("bytes", BitFilter.of(open_ones, "frag", bits).shared(spark))
    bodies = bodies.join(open_ones, ["core", "frag", "did", "tk", "at"]).select("core", "single", "did", "tk", "at", "n", "body", "kinds")
    bodies = cut(bodies, "bodies")
    usual = bodies.where(F.col("kinds") <= largest).drop("kinds")
    sorted_ = usual.repartition("core").sortWithinPartitions("core").mapInArrow(_sort_classes(length), "did long, tk long, lo long, hi long")
    window = bodies.where(F.col("kinds") > largest).select("core", "single", "did", "tk", "at", "body", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    window = window.select("core", "single", "did", "tk", (F.col("at") + F.col("i")).cast("long").alias("lo"), F.sha2(F.substring("body", F.col("i") + 1, F.lit(length)), 256).alias("w"))
    often = window.groupBy("core", "w").agg(F.count("*").alias("m")).where("m > 1").select("core", "w")
    hot = window.where("single").join(often, ["core", "w"]).select("did", "tk", "lo", (F.col("lo") + length).alias("hi"))
    return whole.unionByName(sorted_).unionByName(hot)


def _cut_out(keep_bytes: bool, listed: bool, skip=None):
    """Map function over (doc_id, text, spans) or, for texts without spans, over (doc_id, text, id hash),
    where rows in the filter ``skip`` are left out."""
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    more = [("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary())]
    schema = pa.schema(fields + more * keep_bytes)

    def rewrite(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not listed:
            batch = batch.filter(pa.array(~skip.value.contains(batch.column(2).to_numpy())))
        for a, b, buf, offs in T.runs(batch.column(1)):
            raw = buf.tobytes()
            tk = T.signed(T.span_hashes(buf, offs[:-1], offs[1:])) if listed else None
            out = []
            marked = batch.column(2).slice(a, b - a) if listed else [None] * (b - a)
            for i, cell in enumerate(marked):
                body = raw[offs[i] : offs[i + 1]]
                spans: list[list[int]] = []
                if listed and cell.is_valid:
                    v = cell.values
                    mine = v.field("tk").to_numpy() == tk[i]
                    lo, hi = v.field("lo").to_numpy()[mine], v.field("hi").to_numpy()[mine]
                    order = np.argsort(lo, kind="stable")
                    for x, y in zip(lo[order].tolist(), hi[order].tolist(), strict=True):
                        if spans and x <= spans[-1][1]:
                            spans[-1][1] = max(y, spans[-1][1])
                        else:
                            spans.append([x, y])
                kept = b"".join(body[x:y] for x, y in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(body)], strict=True))
                out.append((len(body), len(body) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), *((spans, kept) if keep_bytes else ())))
            yield batch_of(schema, batch.column(0).slice(a, b - a), *(pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), list(schema)[1:], strict=True)))

    kind = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", spans array<array<long>>, kept binary" * keep_bytes
    return rewrite, kind


def remove_repeats(docs: DataFrame, length: int = LENGTH, core: int = CORE, largest: int = CLASS, keep_bytes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, spans, kept]) for every row of ``docs``.

    Each byte covered by a string of ``length`` bytes that also starts elsewhere, in any row, is removed; strings
    are judged on the input and matches never cross documents.  ``spans`` are the maximal
    removed runs [from, to); ``kept`` is what remains, as bytes.  Null is an empty text; texts shorter
    than ``length`` stay whole; a repeated row is a copy like any other, so its long enough text goes.  A null doc_id is an id
    like any other.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("did", F.coalesce("doc_id", F.lit(NO_ID)))
    ranges = repeated_ranges(docs, length, core, largest)
    spans = cut(ranges.groupBy("did").agg(F.collect_list(F.struct("tk", "lo", "hi")).alias("spans")), "spans")  # a document's own ranges
    touched = BitFilter.of(spans.select(key_hash("did").alias("h")), "h")
    plain, kind = _cut_out(keep_bytes, False, touched.shared(spark))
    marked, _ = _cut_out(keep_bytes, True)
    rest = arrow_map(docs.select("doc_id", "text", key_hash("did")), plain, kind)
    some = docs.where(touched.flag(spark, key_hash("did"))).join(spans, "did", "left").select("doc_id", "text", "spans")
    return rest.unionByName(arrow_map(some, marked, kind))
