"""Hashes of long spans: strings on which polynomials modulo 2**64 agree."""

import numpy as np
import pytest

from riskloom.llm import line_dedup, lm_score, near_dedup, suffix_dedup
from riskloom.llm import text as T


def doubling(n, a="a", b="b"):
    while len(a) < n:
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("n", [64, 512, 1024, 2048, 8192, 65536])
def test_doubling_strings_have_different_hashes(n):
    for pair in (doubling(n), doubling(n, "ab", "ba"), doubling(n, "abcdefgh", "hgfedcba")):
        buf = np.frombuffer(" ".join(pair).encode(), np.uint8)
        start, end, _ = T.word_spans(buf, np.array([0, len(buf)]), T.NOT_SPACE)
        one, two = T.span_hashes(buf, start, end)
        assert one != two
        again = T.span_hashes(np.concatenate([buf[:3] * 0 + 32, buf]), start + 3, end + 3)
        assert list(again) == [one, two]  # wherever they stand


@pytest.mark.parametrize("n", [1024, 2048, 16384])
def test_operators_tell_doubling_strings_apart(spark, n):
    a, b = doubling(n)
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    near = near_dedup.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in near) == [(1, 1, True), (2, 2, True)]
    five = spark.createDataFrame([(1, f"w x y z {a}"), (2, f"w x y z {b}"), (3, f"w x y z {a}")], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in near_dedup.near_duplicates(five).collect()) == [(1, 1), (2, 2), (3, 1)]
    lines = spark.createDataFrame([(1, a), (2, a), (3, b)], "doc_id long, text string")
    assert sum(r.n_dropped for r in line_dedup.dedup_lines(lines, documents=3).collect()) == 0
    assert sum(r.n_dropped for r in line_dedup.dedup_lines(lines, documents=2).collect()) == 1


def test_repeats_of_doubling_strings_are_judged_by_bytes(spark):
    a, b = doubling(4096)
    rows = [(1, "x" + a), (2, b + "y"), (3, a[:1000])]
    seen = {}
    for doc, t in rows:
        for i in range(len(t) - 199):
            seen.setdefault(t[i : i + 200], []).append((doc, i))
    gone = {doc: set() for doc, _ in rows}
    for places in seen.values():
        if len(places) > 1:
            for doc, i in places:
                gone[doc].update(range(i, i + 200))
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in got} == {doc: len(x) for doc, x in gone.items()}


def test_unknown_doubling_word_is_not_known(spark):
    a, b = doubling(1024)
    texts = [(i, f"some plain words {a}") for i in range(40)] + [(100 + i, f"other words {b}") for i in range(40)]
    import zlib

    held = [d for d, _ in texts if zlib.crc32(str(d).encode()) % 7 == 2 and d >= 100]
    rows = [(d, t) for d, t in texts if d < 100 or d in held]
    assert held
    got = {r.doc_id: r for r in lm_score.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d in held:
        assert (got[d].n_tokens, got[d].n_known) == (4, 2)  # "words" and the end
