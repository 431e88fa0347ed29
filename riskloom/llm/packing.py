"""Best-fit packing of tokenised documents with swap-based local search.

Tokenising deals documents out over tasks and keeps (doc, piece, length) rows; packing works on
those alone.  Pieces are dealt into shards of bounded size by a hash; each shard is packed by best
fit over decreasing lengths and then improved: move, one-for-one and two-for-one exchanges
between underfull bins, each of which increases the sum of squared fills, concentrate the free
space until bins empty.  The bins that stay underfull in a shard are dissolved and their pieces
packed again in ever fewer shards, so what is lost to the borders of shards is at most a
bin or so at the end.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import arrow_map, batch_of, cut

CAPACITY = 2048
SHARD_PIECES = 20_000
END = 0
CACHE_WORDS = 1_000_000


def default_tokenizer() -> str:
    """The installed vocabulary file that the registered queries use; its path is a parameter."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# Fixed value: the splitting pattern of byte-level BPE tokenizers that use their own regex.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_signs() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes for
    themselves, the others for code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def word_encoder(path: str):
    """A quick encoder of single words with the file's own vocabulary, or None if the file isn't
    a plain byte-level BPE whose ids follow the order of its merges."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
        return None
    if model.get("dropout") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return None
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"][a + b] for a, b in pairs]
    special = {t["content"] for t in spec.get("added_tokens", [])}
    if sorted(set(order)) != order:
        return None
    signs = _byte_signs()
    ranks = {bytes(signs[c] for c in word): n for word, n in model["vocab"].items() if word not in special}
    return tiktoken.Encoding("words", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class _Cache(dict):
    """Ids of words, each after a fixed prefix; words not met before are encoded."""

    def __init__(self, encode, prefix: str):
        super().__init__()
        self.encode, self.prefix = encode, prefix

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = array("I", self.encode(self.prefix + word)).tobytes()
        return ids


class WordTokenizer:
    """Ids of whole texts from a byte-level BPE tokenizer, a cache keeping those of words met.

    The tokenizer splits a text before a single space between two visible characters, and on
    both sides of such a line end, so parts cut there have the ids they have in the whole text.
    Texts with any other white space, or with a special token's string, go to the tokenizer whole.
    Words not met before are merged with the same vocabulary by ``word_encoder``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.words = word_encoder(path)
        if self.words:
            self.line_end = array("I", self.words("\n")).tobytes()
            self.first, self.later = _Cache(self.words, ""), _Cache(self.words, " ")

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        plain = self.words and " ".join(text.split()) == text.replace("\n", " ")
        if not plain or any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        for cache in (self.first, self.later):
            if len(cache) > CACHE_WORDS:
                cache.clear()
        later, out = self.later.__getitem__, []
        for line in text.split("\n"):
            words = line.split(" ")
            out.append(self.first[words[0]] + b"".join(map(later, words[1:])))
        return self.line_end.join(out)


def tokens(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): a row per piece of each document.

    A document's ids are the tokenizer's and one end; one of more than ``capacity`` ids is cut into pieces
    of ``capacity``, of which the first may be shorter.  Null and empty texts are the end alone.
    """
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.binary())] * keep_ids)
    made: dict[str, WordTokenizer] = {}

    def cut_up(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encode = made.get(tokenizer) or made.setdefault(tokenizer, WordTokenizer(tokenizer))
        last = END.to_bytes(4, "little")
        for first in range(0, batch.num_rows, 512):
            part = batch.slice(first, 512)
            rows = []
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                raw = encode(text or "") + last
                n = len(raw) // 4
                short = n % capacity or capacity
                for k, start in enumerate([0, *range(short, n, capacity)]):
                    end = short if k == 0 else start + capacity
                    ids = raw[4 * start : 4 * end]
                    rows.append((doc, k, start, end - start, zlib.crc32(ids), *([ids] * keep_ids)))
            yield batch_of(schema, *(pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)))

    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), cut_up, kind)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of piece numbers: each piece, longest first, goes to the fullest bin that takes it."""
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free space
    some = 0  # bit f: a bin with free space f exists
    bins: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = some >> n
        if fits:
            f = n + ((fits & -fits).bit_length() - 1)
            b = free[f].pop()
            if not free[f]:
                some &= ~(1 << f)
            bins[b].append(i)
        else:
            f, b = capacity, len(bins)
            bins.append([i])
        if f > n:
            free[f - n].append(b)
            some |= 1 << (f - n)
    return bins


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Local search among underfull bins, from the emptiest on: of all moves, one-for-one and
    two-for-one exchanges that fill a fuller bin further from this one, the largest is made until
    none is left.  Each step increases the sum of squared fills, so the search ends; bins
    without pieces go.  It stops when no bin can empty any more.
    """
    lengths = lengths.astype(np.int64)
    least = -(-int(lengths.sum()) // capacity)
    fill = np.array([int(lengths[b].sum()) for b in bins], np.int64)
    count = len(bins)
    under = [b for b in np.argsort(fill, kind="stable").tolist() if fill[b] < capacity]
    if count <= least or len(under) < 2:
        return bins
    item = np.array([i for b in under for i in bins[b]], np.int64)  # the pieces of underfull bins
    owner = np.array([b for b in under for _ in bins[b]], np.int64)
    size = lengths[item]
    targets = np.array(under, np.int64)
    for src in under:
        while count > least and fill[src]:
            mine = np.flatnonzero(owner == src)
            best = (0, -1, (), -1)  # gain, bin, pieces given, piece taken back
            other = (fill[targets] >= fill[src]) & (targets != src)
            room = np.where(other, capacity - fill[targets], 0)
            slack = np.where((fill[owner] >= fill[src]) & (owner != src), capacity - fill[owner], 0)
            gifts = [(int(size[i]), (i,)) for i in mine] + [(int(size[i] + size[k]), (i, k)) for x, i in enumerate(mine) for k in mine[x + 1 :]]
            for n, give in gifts:
                if len(give) == 1:
                    gain = np.where(n <= room, n, 0)
                    t = int(gain.argmax())
                    if gain[t] > best[0]:
                        best = (int(gain[t]), int(targets[t]), give, -1)
                d = n - size
                d[(d > slack) | (d < 0)] = 0
                t = int(d.argmax())
                if d[t] > best[0]:
                    best = (int(d[t]), int(owner[t]), give, t)
            gain, dst, give, back = best
            if not gain:
                break
            owner[list(give)] = dst
            if back >= 0:
                owner[back] = src
            fill[src] -= gain
            fill[dst] += gain
            count -= int(fill[src] == 0)
    done = set(under)
    out = [b for k, b in enumerate(bins) if k not in done]
    order = np.argsort(owner, kind="stable")
    lim = np.flatnonzero(np.concatenate([[True], np.diff(owner[order]) != 0, [True]]))
    return out + [item[order[a:b]].tolist() for a, b in zip(lim[:-1], lim[1:], strict=True)]


def _layout(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, fill of the bin) of each piece."""
    bins = improve(best_fit(lengths, capacity), lengths, capacity)
    where, offset, fill = (np.zeros(len(lengths), np.int64) for _ in range(3))
    for b, members in enumerate(bins):
        at = 0
        for i in members:
            where[i], offset[i] = b, at
            at += int(lengths[i])
        fill[members] = at
    return where, offset, fill


def _packer(capacity: int, level: int):
    def packed(t: pa.Table) -> pa.Table:
        t = t.sort_by("_row")
        base = t["_shard"][0].as_py()
        where, offset, fill = _layout(t["length"].to_numpy(), capacity)
        t = t.drop_columns(["_shard"])
        for name, x in (("sequence_id", ((base << 32) + where) * 64 + level), ("offset", offset), ("_fill", fill)):
            t = t.append_column(name, pa.array(x, pa.int64()))
        return t

    return packed


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` (with doc_id, piece, start, length) and their sequence_id and offset.

    Every piece has a place, sequences are gapless from offset 0 and hold ``capacity`` tokens at most;
    numbers of sequences are distinct but not dense.  Repeated rows are packed each for itself.
    An empty table gives no rows.
    """
    columns = pieces.columns
    rows = cut(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    full = rows.where(F.col("length") >= capacity)
    done = [full.select(*columns, (F.col("_row") * 64).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    left = rows.where(F.col("length") < capacity)
    total = left.count()
    level = 0
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema) + ", sequence_id long, offset long, _fill long"
    while total:
        level += 1
        shards = -(-total // shard)
        alone = shards == 1

        got = left.withColumn("_shard", F.pmod(F.xxhash64("_row", F.lit(level)), F.lit(shards))).groupBy("_shard").applyInArrow(_packer(capacity, level), kind)
        got = cut(got, f"packed-{level}")
        keep = F.lit(True) if alone else F.col("_fill") == capacity
        done.append(got.where(keep).select(*columns, "sequence_id", "offset"))
        if alone:
            break
        left = got.where(~keep).select(*columns, "_row")
        before, total = total, left.count()
        if total > 0.9 * before:  # hardly a bin came out full: these pieces are kept where they are
            done[-1] = got.select(*columns, "sequence_id", "offset")
            break
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, length, ids): the packed sequences themselves, ids as little-endian 32-bit numbers."""
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    all_pieces = cut(tokens(docs, tokenizer, capacity, keep_ids=True).withColumn("at", F.monotonically_increasing_id()), "ids")
    placed = pack(all_pieces.select(*cols, "at"), capacity).select("at", "sequence_id", "offset")
    rows = all_pieces.join(placed, "at")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # of one sequence
    joined = F.call_function("concat_ws", F.lit(""), F.transform(parts, lambda p: F.hex(p["ids"])))
    return rows.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.unhex(joined).alias("ids"))
