"""Benchmark decontamination as a prefix-filtered set join.

A window of an item is a set of tokens: its word shingles of ``SHINGLE`` words with their offsets
(a shorter window is one token).  Tokens are ordered by rarity, counted over all documents.
A document contains a window only if it contains all its tokens, so a prefix of one
token, the rarest, is necessary, and only occurrences of that token become candidates.  Bounds: the
window must begin at or after the document's first word (position) and end within its words
(length).  Each candidate is then verified word by word over the item-sized window.

Documents are read once.  A task keeps the shingles that a bit filter of the benchmark's tokens
lets through, with the words around them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import text as T
from riskloom.llm.base import BitFilter, arrow_map, batch_of, cut

WINDOW = 10
SHINGLE = 5


def _words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    start, end, doc = T.word_spans(buf, offs, T.ALNUM)
    return start, end, T.bounds(doc, len(offs) - 1), T.span_hashes(buf, start, end, lower=True)


def _text(raw: bytes, start: np.ndarray, end: np.ndarray) -> str:
    return b" ".join(raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)).decode("utf-8", "replace")


def windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, words, size, token, at): a row for each window of each item and each of its tokens."""
    schema = pa.schema([("item_id", pa.string()), ("words", pa.string()), ("size", pa.int32()), ("token", pa.int64()), ("at", pa.int32())])

    def cut_up(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a, b, buf, offs in T.runs(batch.column(1)):
            start, end, lim, h = _words(buf, offs)
            raw = T.LOWER[buf].tobytes()
            rows = []
            for i, item in enumerate(batch.column(0).slice(a, b - a).to_pylist()):
                lo, hi = int(lim[i]), int(lim[i + 1])
                size = min(window, hi - lo)
                k = min(shingle, size)
                for s in range(lo, hi - size + 1 if size else lo):
                    words = _text(raw, start[s : s + size], end[s : s + size])
                    token, _ = T.shingles(h[s : s + size], np.array([0, size]), k)
                    rows += [(item, words, size, t, j) for j, t in enumerate(T.signed(token).tolist())]
            if rows:
                yield batch_of(schema, *(pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)))

    items = benchmark.select(F.col("item_id").cast("string"), "text").where("item_id is not null")
    return arrow_map(items, cut_up, "item_id string, words string, size int, token long, at int")


def occurrences(docs: DataFrame, tokens: BitFilter, sizes: list[int], reach: int) -> DataFrame:
    """(row, doc_id, n_words, found): one row per document, with each shingle that may be a token.

    ``found`` holds the token, the position of its first word and the words from ``reach``
    before to ``reach`` after that position, with the position of the first of them.
    """
    spark = docs.sparkSession
    sent = tokens.shared(spark)
    hit = pa.struct([("token", pa.int64()), ("pos", pa.int32()), ("from", pa.int32()), ("around", pa.string())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("found", pa.list_(hit))])

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a, b, buf, offs in T.runs(batch.column(1)):
            n = b - a
            start, end, lim, h = _words(buf, offs)
            raw = T.LOWER[buf].tobytes()
            token, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for k in sizes:
                s, p = T.shingles(h, lim, k)
                ok = sent.value.contains(s)
                token.append(s[ok])
                at.append(p[ok])
            token, at = np.concatenate(token), np.concatenate(at)
            order = np.argsort(at, kind="stable")
            token, at = token[order], at[order]
            doc = np.searchsorted(lim, at, "right") - 1
            lo = np.maximum(lim[doc], at - reach)
            hi = np.minimum(lim[doc + 1], at + reach)
            around = [_text(raw, start[x:y], end[x:y]) for x, y in zip(lo.tolist(), hi.tolist(), strict=True)]
            found = pa.StructArray.from_arrays([pa.array(T.signed(token)), pa.array((at - lim[doc]).astype(np.int32)), pa.array((lo - lim[doc]).astype(np.int32)), pa.array(around, pa.string())], fields=list(hit))
            count = np.bincount(doc, minlength=n)
            offsets = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
            yield batch_of(schema, batch.column(0).slice(a, n), np.diff(lim), pa.ListArray.from_arrays(offsets, found))

    kind = "doc_id long, n_words long, found array<struct<token: long, pos: int, from: int, around: string>>"
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), scan, kind).withColumn("row", F.monotonically_increasing_id())


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, bits: int = 23) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, items_sha256, contaminated) for every row of ``docs``.

    Words are maximal runs of letters, digits and non-ASCII characters, A-Z lower-cased.  A
    window is ``window`` consecutive words of an item, or all words of a shorter one; items
    without words (null, empty, marks only) and with a null item_id have none.  Every word inside an occurrence
    of a window is hit.  ``items`` are the ids, as sorted strings, of items with an occurring window; a repeated
    item_id counts once.  Null and empty texts have no words.  Each row of a repeated doc_id is
    answered by its own text.  Without items, or without documents, nothing is hit.
    """
    win = cut(windows(benchmark, window, shingle), "windows")
    sizes = sorted(min(shingle, r["size"]) for r in win.select(F.least("size", F.lit(shingle)).alias("size")).distinct().collect())  # at most ``shingle`` numbers
    reach = window
    seen = cut(occurrences(docs, BitFilter.of(win, "token", bits), sorted(set(sizes)), reach), "occurrences")
    hits = seen.select("row", "n_words", F.explode("found").alias("f")).select("row", "n_words", "f.*")
    # rarity over all documents; a token that occurs nowhere rules its windows out
    tokens = win.select("token").distinct()
    rarity = hits.groupBy("token").agg(F.count("*").alias("freq")).join(tokens, "token", "right").select("token", F.coalesce("freq", F.lit(0)).alias("freq"))
    prefix = win.join(rarity, "token").groupBy("words", "size").agg(F.min(F.struct("freq", "token", "at")).alias("p"))
    prefix = cut(prefix.where("p.freq > 0").select("words", "size", "p.token", "p.at"), "prefix")
    pairs = hits.join(prefix, "token")
    begin = F.col("pos") - F.col("at")
    pairs = pairs.where((begin >= 0) & (begin + F.col("size") <= F.col("n_words")))
    same = F.array_join(F.slice(F.split("around", " "), begin - F.col("from") + 1, F.col("size")), " ") == F.col("words")
    sure = cut(pairs.where(same).select("row", begin.alias("begin"), "size", "words"), "verified")
    n_hit = sure.select("row", F.explode(F.sequence("begin", F.expr("begin + size - 1"))).alias("w")).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    owners = win.select("words", "item_id").distinct()
    items = sure.select("row", "words").distinct().join(owners, "words").select("row", "item_id").distinct()
    items = items.groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("items"))  # of one document
    out = seen.select("row", "doc_id", "n_words").join(n_hit, "row", "left").join(items, "row", "left")
    n = F.coalesce("n_hit", F.lit(0)).cast("long")
    found = F.coalesce("items", F.expr("cast(array() as array<string>)"))
    return out.select("doc_id", "n_words", n.alias("n_hit"), F.size(found).cast("long").alias("n_items"), found.alias("items"), F.sha2(F.array_join(found, ",").cast("binary"), 256).alias("items_sha256"), (n > 0).alias("contaminated"))
