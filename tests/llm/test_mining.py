"""Operators 11 to 13 against plain versions, and their odd cases."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import hard_negatives, harmonic_packing, spelling

NAN, INF = float("nan"), float("inf")


def plain_negatives(rows, every=100):
    """The contract, pair by pair, in Python integers."""
    items = {}
    for i, vec, label in rows:
        if i is None or vec is None or label is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        one = ((label + 1) % 10 if i % 7 == 0 else label, vec)
        items[i] = min(items.get(i, one), one)
    items = {i: (label, [math.floor(256 * x) for x in vec]) for i, (label, vec) in items.items()}
    out = []
    for a, (label, v) in items.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), i, other == label) for i, (other, w) in items.items() if i != a)
        for s, p, _ in [x for x in scored if x[2]][:5]:
            fit = [(n, -t) for t, n, same in scored if not same and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out += [(a, p, k, n, -s, t) for k, (n, t) in enumerate(fit, 1)]
    return sorted(out)


def negatives(spark, rows, kind="array<float>", **more):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label int")
    df = df.select("*", *[F.lit("clash").alias(c) for c in ("cell", "kind", "key", "windows", "score", "block")]).repartition(3)
    return sorted(tuple(r) for r in hard_negatives.hard_negatives(df, **more).collect())


def test_hard_negatives_are_the_plain_ones(spark):
    rng = random.Random(11)
    rows = [(i, [rng.gauss(0.1, 0.2) for _ in range(8)], rng.randrange(10)) for i in range(600)]
    rows = [(i, [float(np.float32(x)) for x in v], c) for i, v, c in rows]
    same = [0.25] * 8
    rows += [(1000 + i, same, i % 3) for i in range(150)]  # one vector under many ids: ties everywhere
    rows += [(1200, [0.0] * 8, 4), (1300, [-0.5] * 8, 1)]  # scores 0 and below
    want = plain_negatives(rows)
    assert want and negatives(spark, rows) == want


def test_hard_negatives_odd_rows(spark):
    rng = random.Random(12)
    rows = [(i, [rng.choice([0.5, 0.25, 1.0]) for _ in range(4)], rng.randrange(3)) for i in range(0, 400)]
    odd = [(None, [0.5] * 4, 1), (401, None, 1), (402, [0.5] * 4, None), (403, [0.5, None, 0.5, 0.5], 1), (404, [NAN, 0.5, 0.5, 0.5], 1), (405, [INF, 0.5, 0.5, 0.5], 1)]
    odd += [(406, [], 2), (500, [0.5, 0.5], 1), (-100, [0.5] * 4, 0), (407, [0.5] * 9, 2)]  # empty, short and long vectors, a negative id
    twice = rows[:50] + rows[100:101] * 200  # repeated rows count once
    want = plain_negatives(rows + odd)
    assert want and negatives(spark, rows + odd + twice) == want
    other = [(100, [1.0] * 4, 9)]  # another row of an id: the least counts
    assert negatives(spark, rows + other) == plain_negatives(rows + other)
    assert negatives(spark, []) == []
    assert negatives(spark, [(100, [1.0], 1)]) == []


def test_hard_negatives_of_any_size(spark):
    rng = random.Random(13)
    rows = [(i, [rng.choice([3.0e6, 2.5e6, -1.0e5, 0.3]) for _ in range(3)], i % 2) for i in range(250)]  # no float holds these scores
    assert negatives(spark, rows, "array<double>") == plain_negatives(rows)
    with pytest.raises(Exception, match="Overflow|too large"):
        negatives(spark, [(100, [1e30], 1), (101, [1e30], 1), (102, [1e29], 2)], "array<double>")


def test_hard_negatives_in_blocks_and_strips(spark, monkeypatch):
    rng = random.Random(14)
    rows = [(i, [float(np.float32(rng.gauss(0.1, 0.2))) for _ in range(6)], rng.randrange(4)) for i in range(800)]
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 3)
    monkeypatch.setattr(hard_negatives, "STRIPS", 5)
    monkeypatch.setattr(hard_negatives, "PACK_ROWS", 7)
    monkeypatch.setattr(hard_negatives, "TILE_ANCHORS", 2)
    assert negatives(spark, rows, anchors=F.col("vec_id") % 50 == 0) == plain_negatives(rows, 50)


def test_streaming_iterator_opens_windows_in_score_order():
    pack = lambda rows, neg: [(bytes(k.tobytes()), None) for k in hard_negatives.keys(*(np.array(c) for c in zip(*rows, strict=True)), neg)]
    keys = sorted(pack([(5, 100, 1), (5, 50, 2), (-3, 0, 9)], False) + pack([(5, 91, 3), (5, 90, 4), (5, 40, 8), (5, 40, 7), (5, 14, 6), (-3, 0, 1), (-3, -1, 2)], True))
    assert list(hard_negatives.mined(iter(keys))) == [(-3, 9, 1, 1, 0, 0), (5, 1, 1, 4, 100, 90), (5, 1, 2, 7, 100, 40), (5, 2, 1, 7, 50, 40), (5, 1, 3, 8, 100, 40), (5, 2, 2, 8, 50, 40)]


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_variants(rows):
    letters = set("abcdefghijklmnopqrstuvwxyz") | {chr(c) for c in range(0xC0, 0x100)}
    counts = Counter()
    for doc, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        run = ""
        for c in low + " ":
            if c in letters:
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += len(run) >= 7
                run = ""
    n = {w: k for w, k in counts.items() if k >= 2}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def variants(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.select("*", *[F.lit("clash").alias(c) for c in ("word", "n", "l", "part", "head", "near", "form", "root")]).repartition(4)
    return sorted((tuple(r) for r in spelling.spelling_variants(df, **more).collect()))


def misspelt(seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(7, 9))) for _ in range(40)]
    rows = []
    for doc in range(120):
        some = []
        for _ in range(60):
            w = rng.choice(words[: 1 + rng.randrange(40)])
            while rng.random() < 0.2:
                i = rng.randrange(len(w))
                w = w[:i] + rng.choice(["", rng.choice("abcdeé"), w[i] + "x"]) + w[i + 1 :]
            some.append(w.upper() if rng.random() < 0.2 and w.isascii() else w)
        rows.append((doc, rng.choice([" ", "-", "\n", "1"]).join(some)))
    return [*rows, (500, "wonderful " * 400 + "wonderfulx " * 30 + "wonderfulxy wonderfulxy")]


@pytest.mark.parametrize("group_words", [20_000, 4])
def test_spelling_variants_are_the_plain_ones(spark, group_words):
    rows = misspelt()
    want = plain_variants(rows)
    assert any(r[1] for r in want) and any(r[1] and r[2] != r[1] for r in want)
    assert variants(spark, rows, group_words=group_words) == want


def test_spelling_odd_rows(spark):
    long = "".join(random.Random(3).choice("abc") for _ in range(30_000))
    rows = [(1, None), (2, ""), (None, "wonderful wonderful"), (3, "Wonderful WONDERFUL wonderfull"), (3, "Wonderful WONDERFUL wonderfull"), (4, "short words only"), (5, f"{long} {long} {long}x {long}x"), (6, "ÀÉÎõüæø ÀÉÎõüæø àéîõüæø×÷ àéîõüæø×÷")]
    assert variants(spark, rows) == plain_variants(rows)
    assert variants(spark, []) == [] == variants(spark, [(1, None)])


def test_a_hot_beginning_is_dealt_again(spark):
    rng = random.Random(8)
    words = sorted({"common" + "".join(rng.choice("ab") for _ in range(9)) for _ in range(700)})
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = [(r.word, r.near) for r in spelling.near_pairs(df, 30).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a in words for b in words if one_edit(a, b)}


def pieces(spark, rows, capacity=4096):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.select("*", *[F.lit("clash").alias(c) for c in ("start", "length", "ids", "offset", "sequence_id")]).repartition(3)
    return harmonic_packing.pack(df, harmonic_packing.default_tokenizer(), capacity, keep_ids=True).collect()


def whole_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(harmonic_packing.default_tokenizer())
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for x in texts]


def check_packing(got, capacity):
    seq = {}
    for r in got:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    lengths = []
    for places in seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity and at & (at - 1) == 0  # no padding anywhere
        lengths.append(at)
    return lengths


def test_harmonic_packing_holds_every_id_once(spark, rows):
    texts = [(i, t) for i, (_, t) in enumerate(rows)]
    odd = ["tab\tand hard space", "mid<|endoftext|>dle <|StartOfText|>", "don't we'll x² ª №", "école ́x İstanbul ΑΣ", "日本語 текст ﬁ", "a\x1cb\x85c", "q" * 500, " lead", "trail ", "<|endoftext|>"]
    texts += [(1000 + i, t) for i, t in enumerate(odd)]
    got = pieces(spark, texts)
    lengths = check_packing(got, 4096)
    want = dict(zip([i for i, _ in texts], whole_ids([t for _, t in texts]), strict=True))
    for doc, ids in want.items():
        mine = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start)
        assert [r.start for r in mine] == list(np.cumsum([0] + [r.length for r in mine])[:-1])
        assert b"".join(bytes(r.ids) for r in mine) == ids and {r.doc_tokens for r in mine} == {len(ids) // 4}
    total = sum(len(ids) // 4 for ids in want.values())
    assert sum(lengths) == total and len(lengths) <= total // 4096 + 3 * 13  # a task leaves a dozen short ones


def test_harmonic_packing_odd_rows(spark):
    assert pieces(spark, []) == []
    got = pieces(spark, [(1, None), (1, None), (None, "x"), (2, "")])
    assert sorted((r.doc_id is None, r.doc_id, r.length) for r in got if r.doc_id) == [(False, 1, 1), (False, 1, 1), (False, 2, 1)]
    assert sum(r.length for r in got if r.doc_id is None) == 2
    check_packing(pieces(spark, [(i, "word " * i) for i in range(60)], 16), 16)
    with pytest.raises(ValueError):
        harmonic_packing.pack(spark.createDataFrame([], "doc_id long, text string"), harmonic_packing.default_tokenizer(), 100)


def test_sequences_are_padded_unless_a_power_of_two(spark):
    df = spark.createDataFrame([(i, "some words " * i) for i in range(30)], "doc_id long, text string").coalesce(1)
    out = harmonic_packing.sequences(df, harmonic_packing.default_tokenizer(), 64).collect()
    assert all(len(r.ids) == 4 * r.length for r in out) and sum(r.length for r in out) == sum(2 * i + 1 for i in range(30))
