"""License notices found by patience alignment.

Words that are unique to both a stretch of text and a template anchor the alignment; the longest
increasing subsequence of anchors is kept, and the gaps between neighbouring anchors are aligned in the same
way, with equal words at the borders of a gap taken first.  Coverage is the share of the template's
words that are aligned.  Stretches are chosen by a sliding count of template words, over all of every text;
each occurrence of a notice is aligned by itself.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import text as T
from riskloom.llm.base import arrow_map, batch_of

COVERAGE = 0.8
STRETCH = 1.5  # of the template's words

# Public license notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
}


def increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence."""
    tails: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
        before[i] = at[k - 1] if k else -1
    out: list[int] = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(text: list[int], template: list[int]) -> list[tuple[int, int]]:
    """Aligned places (in text, in template), increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        place = {text[i]: i for i in range(a, b)}
        anchors = [(place[w], j) for j in range(c, d) if in_template[w := template[j]] == 1 and in_text.get(w) == 1]
        kept = [anchors[k] for k in increasing([i for i, _ in anchors])]
        if not kept:
            continue
        out += kept
        for (i, j), (x, y) in zip([(a - 1, c - 1), *kept], [*kept, (b, d)], strict=True):
            if i + 1 < x and j + 1 < y:
                todo.append((i + 1, x, j + 1, y))
    return sorted(out)


def find(words: list[int], template: list[int], coverage: float) -> list[tuple[int, int, float]]:
    """(first word, end, coverage) of each occurrence of a template in a stretch of text."""
    need, reach, known = max(1, int(np.ceil(coverage * len(template) - 1e-9))), int(np.ceil(STRETCH * len(template))), set(template)
    spots = [i for i, w in enumerate(words) if w in known]
    out = []
    k = 0
    while k + need <= len(spots):
        p = spots[k]
        if spots[k + need - 1] >= p + reach:
            k += 1
            continue
        got = align(words[p : p + reach], template)
        if len(got) >= need and got[0][0] == 0:
            end = p + got[-1][0] + 1
            out.append((p, end, len(got) / len(template)))
            k = bisect_left(spots, end)
        else:
            k += 1
    return out


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, n_words, found): ``found`` lists (license, from, to, coverage), word spans in order, for every row.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.  Null and empty texts hold no words and
    no notice; a notice that occurs several times is listed each time; a template without words finds nothing;
    repeated rows are answered alike; an empty table gives no rows.
    """
    wanted: list[tuple[str, np.ndarray]] = []
    for name, body in sorted((TEMPLATES if templates is None else templates).items()):
        buf = np.frombuffer(body.encode(), np.uint8)
        start, end, _ = T.word_spans(buf, np.array([0, len(buf)]), T.ALNUM)
        if len(start):
            wanted.append((name, T.signed(T.span_hashes(buf, start, end, lower=True))))
    hit = pa.struct([("license", pa.string()), ("from", pa.int64()), ("to", pa.int64()), ("coverage", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("found", pa.list_(hit))])

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a, b, buf, offs in T.runs(batch.column(1)):
            start, end, doc = T.word_spans(buf, offs, T.ALNUM)
            lim = T.bounds(doc, b - a)
            h = T.signed(T.span_hashes(buf, start, end, lower=True))
            found: list[list[dict]] = [[] for _ in range(b - a)]
            vocabulary = np.unique(np.concatenate([t for _, t in wanted])) if wanted else np.zeros(0, np.int64)
            at = np.searchsorted(vocabulary, h)
            code = np.where(vocabulary[np.minimum(at, len(vocabulary) - 1)] == h, at, -1) if len(vocabulary) else np.full(len(h), -1)
            for name, t in wanted:
                inside = np.append(np.isin(vocabulary, t), False)[code]
                total = np.concatenate([[0], np.cumsum(inside)])
                reach = int(np.ceil(STRETCH * len(t)))
                stop = np.minimum(np.arange(len(h)) + reach, lim[doc + 1])
                dense = np.flatnonzero(inside & (total[stop] - total[:-1] >= np.ceil(coverage * len(t) - 1e-9)))
                for i in np.unique(doc[dense]):
                    lo = dense[np.searchsorted(doc[dense], i)]
                    hi = min(lim[i + 1], dense[np.searchsorted(doc[dense], i, "right") - 1] + reach)
                    for x, y, c in find(h[lo:hi].tolist(), t.tolist(), coverage):
                        found[i].append({"license": name, "from": int(lo - lim[i] + x), "to": int(lo - lim[i] + y), "coverage": c})
            for f in found:
                f.sort(key=lambda x: (x["from"], x["license"]))
            yield batch_of(schema, batch.column(0).slice(a, b - a), np.diff(lim), pa.array(found, pa.list_(hit)))

    kind = "doc_id long, n_words long, found array<struct<license: string, from: long, to: long, coverage: double>>"
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), scan, kind)
