"""Vectorised text helpers used inside Arrow tasks.

Texts arrive as Arrow batches; a batch is cut into runs of whole documents of about
``CHUNK`` bytes, and every step (word borders, hashes, shingles) is a numpy operation over
all bytes of a run.  A single document longer than ``CHUNK`` is one run, never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

CHUNK = 1 << 20
LONG_SPAN = 128
_RADIX = np.uint64(0x9E3779B97F4A7C15 | 1)
_RNG = np.random.default_rng(20240215)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[LOWER]

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """radix**i and radix**-i modulo 2**64 for i < n (kept between calls, grown on demand)."""
    if len(_powers[0]) < n:
        n = -(-n // (1 << 17)) << 17  # small steps: every worker holds its own
        inverse = np.uint64(pow(int(_RADIX), -1, 1 << 64))
        for k, base in enumerate((_RADIX, inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def runs(column: pa.Array | pa.ChunkedArray, chunk: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) for runs of whole texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return
    _, where, data = column.buffers()
    offs = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        lens = np.where(valid, np.diff(offs), 0)
        if int(lens.sum()) != int(offs[-1] - offs[0]):  # bytes under nulls: pack the rest anew
            raw = np.concatenate([raw[offs[i] : offs[i + 1]] for i in np.flatnonzero(valid)] or [raw[:0]])
            offs = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + chunk, "right")) - 1)
        b = min(b, n)
        yield a, b, raw[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        a = b


def prefix_hash(buf: np.ndarray, lower: bool = False) -> np.ndarray:
    """Polynomial prefix sums of a run, length len(buf) + 1."""
    fwd, _ = powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[buf] * fwd[: len(buf)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes [start, end), the same wherever they stand; the length is hashed in.

    For short spans alone: modulo 2**64 the two strings got by doubling "a" -> "ab", "b" -> "ba" agree from
    some 512 bytes on, whatever the radix.  ``span_hashes`` takes spans of any length."""
    _, back = powers(len(sums))
    return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def long_hashes(h: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False, seed: int = 1) -> np.ndarray:
    """``h`` with spans of over ``LONG_SPAN`` bytes hashed anew over their bytes, eight at a time."""
    at = np.flatnonzero(end - start > LONG_SPAN)
    if len(at):
        raw = memoryview(np.ascontiguousarray(LOWER[buf] if lower else buf))
        h = h.copy()
        h[at] = np.fromiter((xxh3_64_intdigest(raw[a:b], seed) for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)), np.uint64, len(at))
    return h


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of spans of any length."""
    return long_hashes(span_hash(prefix_hash(buf, lower), start, end), buf, start, end, lower)


def word_spans(buf: np.ndarray, offs: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and the document (row of the run) of every maximal word; words stay in one text."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    m = np.zeros(n + 2, bool)
    m[1:-1] = word[buf]
    first = m[1:-1] & ~m[:-2]
    last = m[1:-1] & ~m[2:]
    edges = offs[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    first[edges] = m[1:-1][edges]
    last[edges - 1] = m[1:-1][edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(offs, start, "right") - 1
    return start, end, doc


def bounds(doc: np.ndarray, n: int) -> np.ndarray:
    """Offsets of each document's items in an array sorted by document."""
    return np.searchsorted(doc, np.arange(n + 1))


_STEP = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(words: np.ndarray, lim: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of first word) of every k-word shingle; ``lim`` are the documents' word offsets."""
    if len(words) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(words) - k + 1
    h = np.full(m, k * 0xC2B2AE3D27D4EB4F % (1 << 64), np.uint64)
    for j in range(k):
        h += words[j : j + m] * _STEP[j]
    ok = np.ones(len(words), bool)
    for j in range(1, k):  # the last k - 1 words of a document start none
        at = lim[1:] - j
        ok[at[at >= lim[:-1]]] = False
    at = np.flatnonzero(ok[:m])
    return mix(h[at]), at


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
