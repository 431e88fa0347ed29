"""Each operator against a plain version of its rules."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import base, components, decontaminate, exact_dedup, license_scan, line_dedup, lm_score, near_dedup, packing, suffix_dedup, toxicity, url_filter

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def same(df, want):
    """Multisets of rows; None sorts as text."""
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))


def crc(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n if doc_id is not None else None


# -- helpers -----------------------------------------------------------------------------


def test_bit_filter_has_no_false_negatives(spark):
    some = spark.range(0, 3000, 3).select(base.key_hash("id").alias("h"))
    f = base.BitFilter.of(some, "h", 16)
    every = np.array([r.h for r in spark.range(3000).select(base.key_hash("id").alias("h")).orderBy(F.col("id")).collect()])
    got = f.contains(every)
    assert got[::3].all() and got.mean() < 0.5
    left = base.without(spark.range(30).select(F.col("id").alias("doc_id")), spark.range(0, 30, 2).select(F.col("id").alias("doc_id")), bits=8)
    assert sorted(r.doc_id for r in left.collect()) == list(range(1, 30, 2))


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(1)
    edges = {
        "chain": [(i, i + 1) for i in range(40)] + [(100, 100)],
        "star": [(0, i) for i in range(1, 30)] + [(50, 51), (51, 50)],
        "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(None, 3)],
        "none": [],
    }[shape]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None and u != v:
            parent[find(u)] = find(v)
    got = components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    by_root, want = defaultdict(set), defaultdict(set)
    for r in got:
        by_root[r.root].add(r.node)
    for x in parent:
        want[find(x)].add(x)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, want.values()))
    assert len(got) == len(parent) and all(root in nodes for root, nodes in by_root.items())


# -- 1: decontamination --------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def test_decontamination(spark, docs, rows, none):
    bench = [(1, rows[3][1]), ("2", "two words"), ("3", None), ("4", "!?"), ("5", rows[4][1][:60].upper()), (None, rows[5][1]), ("1", rows[6][1]), ("7", "ONE")]
    bench = [(None if i is None else str(i), t) for i, t in bench]
    items = spark.createDataFrame(bench, "item_id string, text string").withColumn("words", F.lit(1))
    win = defaultdict(set)
    for i, t in bench:
        w = WORD.findall((t or "").translate(UP))
        if i is not None and w:
            n = min(10, len(w))
            for k in range(len(w) - n + 1):
                win[tuple(w[k : k + n])].add(i)
    want = []
    for d, t in rows:
        w = WORD.findall((t or "").translate(UP))
        hit, found = set(), set()
        for n in {len(x) for x in win}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in win:
                    hit |= set(range(k, k + n))
                    found |= win[tuple(w[k : k + n])]
        want.append((d, len(w), len(hit), len(found), sorted(found), sha(",".join(sorted(found))), bool(hit)))
    assert sum(x[-1] for x in want) > 5
    same(decontaminate.contamination(docs, items), want)
    assert decontaminate.contamination(none, items).count() == 0
    assert decontaminate.contamination(docs, items.where("false")).where("contaminated").count() == 0


# -- 2: exact de-duplication ------------------------------------------------------------------


def test_quotient_filters_merge_without_loss():
    rng = np.random.default_rng(0)
    a, b = (rng.integers(0, 1 << 63, 500, dtype=np.uint64) >> np.uint64(rng.integers(0, 55)) for _ in range(2))
    both = exact_dedup.QuotientFilter.of(a).merge(exact_dedup.QuotientFilter.of(np.concatenate([b, a[:50]])))
    keys, counts = both.items()
    want = Counter(np.concatenate([a, b, a[:50]]).tolist())
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == want
    assert both.run_end.sum() == both.occupied.sum()


def test_exact_duplicates(docs, rows, none):
    norm = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (d, _), t in zip(rows, norm, strict=True):
        groups[t].append(d)
    want = []
    for (d, _), t in zip(rows, norm, strict=True):
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        want.append((d, keep if len(groups[t]) > 1 else d, len(groups[t]), d == (keep if len(groups[t]) > 1 else d), sha(t)))
    same(exact_dedup.exact_duplicates(docs), want)
    assert exact_dedup.exact_duplicates(none).count() == 0


# -- 3: license scan ------------------------------------------------------------------------------


def test_longest_increasing():
    rng = random.Random(2)
    for _ in range(50):
        v = rng.sample(range(30), rng.randint(0, 9))
        got = [v[i] for i in license_scan.increasing(v)]
        best = max((sum(m >> i & 1 for i in range(len(v))) for m in range(1 << len(v)) if (s := [v[i] for i in range(len(v)) if m >> i & 1]) == sorted(s)), default=0)
        assert got == sorted(got) and len(got) == best


def test_alignment_is_common_and_increasing():
    rng = random.Random(3)
    for _ in range(50):
        a = [rng.randrange(12) for _ in range(20)]
        b = [rng.randrange(12) for _ in range(15)]
        got = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:], strict=False))
    assert license_scan.align([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)]


def test_license_scan(spark, none):
    mit = license_scan.TEMPLATES["MIT"]
    apache = license_scan.TEMPLATES["Apache-2.0-header"]
    texts = [None, "", f"x {mit} y", f"{mit} {mit}", "words " * 50 + mit.upper(), apache.replace("compliance", "accordance") + " more", "released under a licence", "under the the the MIT " * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("found", F.lit(1))
    got = {r.doc_id: [(f.license, f["from"], f["to"]) for f in r.found] for r in license_scan.scan_licenses(df).collect()}
    assert got[0] == got[1] == got[6] == []
    assert got[2] == [("MIT", 1, 6)] and got[3] == [("MIT", 0, 5), ("MIT", 5, 10)] and got[4] == [("MIT", 50, 55)]
    assert "Apache-2.0-header" in [x[0] for x in got[5]] and "Apache-2.0" in [x[0] for x in got[5]]
    assert license_scan.scan_licenses(none).count() == 0


# -- 4: repeated bytes --------------------------------------------------------------------------------


def test_suffix_array_and_repeats():
    rng = np.random.default_rng(0)
    for n in [1, 2, 3, 4, 5, 7, *rng.integers(1, 200, 60)]:
        t = rng.integers(1, 4, int(n))
        assert suffix_dedup.suffix_array(t).tolist() == sorted(range(int(n)), key=lambda i: t[i:].tolist())
    for _ in range(30):
        text, size = bytes(rng.integers(97, 100, 300).astype(np.uint8)), 16
        parts = [text[a : a + size + int(rng.integers(0, 30))] for a in rng.integers(0, 250, 8)]
        parts = [p for p in parts if len(p) >= size]
        of, start = suffix_dedup.repeated_starts(parts, np.array([len(p) - size + 1 for p in parts]), size)
        seen = Counter(p[i : i + size] for p in parts for i in range(len(p) - size + 1))
        assert set(zip(of.tolist(), start.tolist(), strict=True)) == {(k, i) for k, p in enumerate(parts) for i in range(len(p) - size + 1) if seen[p[i : i + size]] > 1}


@pytest.mark.parametrize("largest", [20_000, 1])
def test_repeats_are_removed(docs, rows, none, largest):
    size = 200
    seen = Counter()
    raw = [(d, (t or "").encode()) for d, t in rows]
    for _, t in raw:
        seen.update(t[i : i + size] for i in range(len(t) - size + 1))
    want = []
    for d, t in raw:
        cover = np.zeros(len(t) + 1, int)
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                cover[i] += 1
                cover[i + size] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        want.append((d, len(t), int(gone.sum()), len(edges) // 2, sha(kept), edges.reshape(-1, 2).tolist(), kept))
    assert sum(w[3] > 0 for w in want) > 10
    same(suffix_dedup.remove_repeats(docs, largest=largest, keep_bytes=True), want)
    if largest > 1:
        assert suffix_dedup.remove_repeats(none).count() == 0


# -- 5: repeated lines ----------------------------------------------------------------------------------


def lines_dropped(rows):
    white = " \t\n\v\f\r"
    holders = defaultdict(list)
    for d, t in rows:
        for k in {x.strip(white).translate(UP) for x in (t or "").split("\n")}:
            if len(k) >= 20:
                holders[k].append(d)
    out = []
    for d, t in rows:
        parts, kept = (t or "").split("\n"), []
        for x in parts:
            ids = holders.get(x.strip(white).translate(UP), [])
            top = max((i for i in ids if i is not None), default=None)
            if len(ids) < 3 or top is None or d is None or d == top:
                kept.append(x)
        out.append((d, len(parts), len(parts) - len(kept), sha("\n".join(kept)), "\n".join(kept)))
    return out


@pytest.mark.parametrize(("size", "want"), [(1 << 20, 6), (10, 8)])
def test_line_batches_grow_with_the_documents(docs, monkeypatch, size, want):
    added, runs = [], []
    add = line_dedup.LineRuns.add

    def watched(self, lines):
        add(self, lines)
        added.append(lines)
        runs.append([len(level) for level in self.levels])

    monkeypatch.setattr(line_dedup.LineRuns, "add", watched)
    monkeypatch.setattr(line_dedup, "BATCH_DOCUMENTS", size)
    line_dedup.dedup_lines(docs)
    assert len(added) == want and runs[:4] == [[1], [2], [3], [0, 1]]


@pytest.mark.parametrize("batches", [1, 7])
def test_line_dedup(docs, rows, none, batches):
    want = lines_dropped(rows)
    assert sum(w[2] for w in want) > 3
    same(line_dedup.dedup_lines(docs, batches=batches, keep_text=True), want)
    assert line_dedup.dedup_lines(none, batches=2).count() == 0


# -- 6: language model -------------------------------------------------------------------------------------


def test_lm_scores(docs, rows, none):
    def tokens(t):
        return [*(w for w in re.split("[\x20\x09-\x0d]+", (t or "").translate(UP)) if w), 0]

    train = Counter(w for d, t in rows if crc(d, 7) != 2 for w in tokens(t))
    total = train.total()
    low = math.log10(total + len(train) + 1)
    got = lm_score.lm_scores(docs, frequent=40, steps=300).collect()  # most tokens take the join
    want = defaultdict(list)
    for d, t in rows:
        w = tokens(t)
        want[d].append((crc(d, 7) == 2, len(w), sum(train[x] > 0 for x in w), total, sum(math.log10(train[x] + 1) - low for x in w)))
    assert len(got) == len(rows)
    for d, expected in want.items():
        mine = sorted((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got if r.doc_id == d)
        for x, y in zip(mine, sorted(expected), strict=True):
            assert x[:4] == y[:4] and x[4] == pytest.approx(y[4])
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in got)
    assert lm_score.lm_scores(none, steps=5).count() == 0


def test_lm_probabilities_are_normalised_and_fit():
    rng = np.random.default_rng(0)
    code = (np.arange(30) % 5 * lm_score.CONTEXTS + 3) * lm_score.UNITS + np.arange(30) % 5
    n = rng.integers(50, 90, 30)
    code, at = np.unique(code, return_inverse=True)
    table = lm_score.train(code, np.bincount(at, weights=n), steps=800)
    assert np.allclose((10 ** table.astype(float)).sum(axis=1), 1, atol=1e-4)
    assert (table[code // lm_score.UNITS, code % lm_score.UNITS] > math.log10(0.4)).all()


# -- 7: packing ------------------------------------------------------------------------------------------------


def test_local_search_empties_bins():
    lengths = np.array([6, 6, 4, 4, 5, 5, 3, 7])
    bad = [[0, 2], [1], [3, 4], [5], [6], [7]]
    got = packing.improve([list(b) for b in bad], lengths, 10)
    assert sorted(i for b in got for i in b) == list(range(8)) and all(lengths[b].sum() <= 10 for b in got) and len(got) == 4
    rng = np.random.default_rng(1)
    for _ in range(20):
        lengths = rng.integers(1, 100, 60)
        before = packing.best_fit(lengths, 100)
        after = packing.improve([list(b) for b in before], lengths, 100)
        squares = [sum(int(lengths[b].sum()) ** 2 for b in bins) for bins in (before, after)]
        assert sorted(i for b in after for i in b) == list(range(60)) and max(lengths[b].sum() for b in after) <= 100
        assert len(after) <= len(before) and squares[1] >= squares[0]


@pytest.mark.parametrize("shard", [20_000, 15])
def test_packing(docs, rows, none, shard):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    whole = Tokenizer.from_file(path)
    got = packing.pack(packing.tokens(docs, path), shard=shard).collect()
    want = []
    for d, t in rows:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        want += [(d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert sorted(repr(tuple(r)[:5]) for r in got) == sorted(map(repr, want))
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-sum(w[3] for w in want) // 2048) + 1
    assert packing.pack(packing.tokens(none, path)).count() == 0


def test_sequences_hold_their_ids(docs, rows):
    path = packing.default_tokenizer()
    small = docs.where("doc_id between 0 and 9")
    got = packing.sequences(small, path).collect()
    assert all(len(r.ids) == 4 * r.length for r in got)
    assert sum(r.length for r in got) == packing.tokens(small, path).agg(F.sum("length")).first()[0]


def test_tokenizer_parts_equal_whole_texts():
    t = packing.WordTokenizer(packing.default_tokenizer())
    for text in ["a b\nc", " a", "a ", "a  b", "a\n\nb", "a \n b", "don't 've x's", "x y z", "a<|endoftext|>b", "tab\there", "é ü\nß 12 3!?", "\n", "a\r\nb", "x\x1cy z"]:
        assert np.frombuffer(t(text), "<u4").tolist() == t.whole.encode(text, add_special_tokens=False).ids, text


# -- 8: near duplicates ------------------------------------------------------------------------------------------


def near_components(rows, per_cent=85):
    sets = []
    for _, t in rows:
        w = [x for x in re.split("[\x20\x09-\x0d]+", (t or "").translate(UP)) if x]
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= per_cent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = min(least[find(i)], default=d) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return out


@pytest.mark.parametrize("members", [512, 2])
def test_near_duplicates(docs, rows, none, members, monkeypatch):
    rows = [r for r in rows if r[0] is not None]
    monkeypatch.setattr(near_dedup.links, "__defaults__", (5, 85, members))
    want = near_components(rows)
    assert sum(not w[3] for w in want) > 15
    same(near_dedup.near_duplicates(docs.where("doc_id is not null")), want)
    if members > 2:
        assert near_dedup.near_duplicates(none).count() == 0


def test_near_duplicates_without_ids(docs, rows):
    got = {r.n_shingles: r for r in near_dedup.near_duplicates(docs).where("doc_id is null").collect()}
    assert len(got) == 2 and got[0].component_id is None and got[0].kept


# -- 9: URL rules ---------------------------------------------------------------------------------------------------


def test_url_rules(spark):
    urls = [
        (1, "http://a.net/x", None), (2, "https://A.Example.NET/en/1?q", ""), (3, "http://example.com/de/1", None), (4, "http://x.example.com/en/", None),
        (5, "http://b.org/fr/1", None), (6, "http://b.org/de/1", None), (7, None, None), (8, "no scheme", None), (9, "http://anet/x", None), (10, "http://a.net", None),
        (11, "http://c.example.org/p", '<link rel="canonical" href="http://z.net/q">'), (12, "http://d.org/p", "<link href='/old.html' rel=canonical>"),
        (13, "http://d.org/old", '<META http-equiv="Refresh" content="0; url=http://e.net/">'), (14, "http://f.org/p#x", '<link rel="canonical" href="http://g.net/"><link rel="canonical" href="http://example.net/en/k">'),
        (14, "http://f.org/p#x", None), (15, "http://f.org/p/?ref=1", None),
    ]
    df = spark.createDataFrame(urls, "page_id long, url string, html string").withColumn("node", F.lit(1)).withColumn("verdict", F.lit(1))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df).collect()}
    assert got[1] == ("a.net", "/x", "net/", "block") and got[2] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[3][2:] == ("example.com/de/", "block") and got[4][2:] == (None, "allow") and got[5][2:] == ("org/fr/", "allow")
    assert got[7] == ("", "", None, "allow") and got[8] == ("", "", None, "allow") and got[9][2] is None
    assert got[10] == ("a.net", "", None, "allow")
    assert got[11][3] == "block" and got[12][3] == "block" and got[13][3] == "block"  # through a link, and through two
    assert got[14][3] == "allow" and got[15][3] == "allow"  # an allowed member goes before a blocked one
    assert url_filter.judge_urls(df).count() == len(urls) and url_filter.judge_urls(df.where("false")).count() == 0
    more = spark.createDataFrame([("http://x.example.com/en/", "http://blocked.net/")], "url string, target string")
    assert {r.page_id: r.verdict for r in url_filter.judge_urls(df, redirects=more).collect()}[4] == "block"


# -- 10: toxicity ------------------------------------------------------------------------------------------------------


def test_toxicity(spark, none):
    rng = random.Random(5)
    plain = ["soft", "green", "river", "table", "morning", "quiet", "letter", "window"]
    bad = ["grumbzak", "vlorpish"]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = [rng.choice(plain) for _ in range(rng.randint(20, 60))]
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(bad) + rng.choice(["", "er", "ing"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (1002, "abc"), (None, "soft green river"), (1003, "green river " * 20_000 + "grumbzak")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("toxic", F.lit(1)).withColumn("part", F.lit(1))
    marks = spark.createDataFrame([*labels, (None, 1), (5000, 1), (3, 7)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, marks).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (crc(r.doc_id, 4) == 2) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 400]
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in held]) > 0.95
    assert {r.doc_id: r.predicted for r in got}[1003] == 1  # one expression in a long text
    assert toxicity.toxicity(none, marks).count() == 0
    assert {r.score for r in toxicity.toxicity(docs, marks.where("false")).collect()} == {0.0}
