"""Harmonic packing of tokenised documents.

Lengths belong to reciprocal-capacity classes: class j holds pieces of capacity / j tokens, and each of its
sequences takes exactly j of them.  A document may be cut freely, so it is cut at class lengths, longest
first; with j = 1, 2, 4, ... these divide the capacity, and a filled sequence has no padding at all.  Every
task fills its own sequences as documents stream through it: a piece's place follows from the number of
pieces of its class so far, so nothing is shuffled or sorted and a task holds less than one open
sequence of each class.  What is left open at a task's end is laid out largest first and cut at the binary digits of
its total: these last sequences have lengths that are powers of two, which need no padding either.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 4096
END = 2
CACHE_WORDS = 500_000
LONG_WORD = 64  # longer ones are encoded each time and not kept
DOCS_AT_ONCE = 512


def default_tokenizer() -> str:
    """The installed vocabulary file that the registered query uses; its path is a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# White space on which engines may differ, or which is rare: such a text is encoded whole.
_ODD_SPACE = [chr(c) for c in range(0x10000) if chr(c).isspace() and chr(c) not in " \t\n\r\x0b\x0c"]
# Words beyond Latin letters, whose normal forms and lower case need care, go to the tokenizer itself.
_LATIN = re.compile(r"[\x21-\x7e\u00a1-\u012f\u0131-\u017f]+")


def word_merger(path: str):
    """A quick encoder of single Latin words with the file's own vocabulary, or None if the file isn't a lower-casing
    byte BPE with word ends whose merges stand in order.

    A word end is one more byte that no word holds, a space: the base symbols with a word end are
    the merges of every byte with it, before all others.
    """
    import regex
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, steps = spec["model"], (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    kinds = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    end = model.get("end_of_word_suffix")
    if model.get("type") != "BPE" or not end or model.get("dropout") or model.get("continuing_subword_prefix") or kinds != ["NFC", "Replace", "Lowercase"]:
        return None
    if [x["type"] for x in steps] != ["Split", "ByteLevel"] or not steps[0]["invert"] or steps[0]["behavior"] != "Removed" or steps[1]["add_prefix_space"] or steps[1]["use_regex"]:
        return None
    vocab, signs = model["vocab"], byte_signs()
    raw = lambda token: bytes(signs[c] for c in token.removesuffix(end)) + b" " * token.endswith(end)
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocab.get(c) for c in sorted(signs, key=signs.get)] + [vocab.get(c + end) for c in sorted(signs, key=signs.get)] + [vocab[a + b] for a, b in merges]
    words = [bytes([k]) for k in range(256)] + [bytes([k]) + b" " for k in range(256)] + [raw(a + b) for a, b in merges]
    ranks = {w: k for k, w in enumerate(words)}
    if None in ids or len(ranks) != len(words):
        return None
    coder = tiktoken.Encoding("words", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
    parts, id_of, encode_ordinary = regex.compile(steps[0]["pattern"]["Regex"]), ids.__getitem__, coder.encode_ordinary

    def encode(word: str) -> bytes:
        word = word.lower()
        pieces = word if word.isascii() and word.isalpha() else " ".join(parts.findall(word))
        return array("I", map(id_of, encode_ordinary(pieces + " "))).tobytes() if pieces else b""

    return encode


def byte_signs() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes for
    themselves, the others for code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Words(dict):
    """Ids of the words met; others are encoded and kept."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(word) <= LONG_WORD:
            self[word] = ids
        return ids


class WordEncoder:
    """Ids of whole texts from a tokenizer that drops white space, a cache keeping those of words met.

    Holds for tokenizers whose normalizer and splitting never reach across white space (checked on the file's
    own splitting rule: white space is removed); special-token strings and odd white space go to the tokenizer
    whole.  Words not met before are merged with the same vocabulary by ``word_merger``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        probe = self.tokenizer.pre_tokenizer.pre_tokenize_str("a b") if self.tokenizer.pre_tokenizer else []
        self.by_word = [w for w, _ in probe] == ["a", "b"]
        self.merge = word_merger(path)
        self.words = _Words(self._word)

    def _word(self, word: str) -> bytes:
        return self.merge(word) if self.merge and _LATIN.fullmatch(word) else self.whole(word)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        if not self.by_word or any(c in text for c in _ODD_SPACE) or any(s[0] in text and s in text.lower() for s in self.special):
            return self.whole(text)
        return b"".join(map(self.words.__getitem__, text.split()))


def class_lengths(n: int, capacity: int) -> list[int]:
    """A document's cuts: lengths capacity / j, longest first."""
    out = [capacity] * (n // capacity)
    rest, size = n % capacity, capacity
    while rest:
        size //= 2
        if rest >= size:
            out.append(size)
            rest -= size
    return out


class Filler:
    """Open sequences of one task: ``place`` gives each piece its sequence and offset, or keeps it back
    until the sequence is full."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next = capacity, first
        self.open: dict[int, list[tuple]] = {}

    def place(self, piece: tuple, length: int) -> list[tuple]:
        mine = self.open.setdefault(length, [])
        mine.append(piece)
        if len(mine) * length < self.capacity:
            return []
        del self.open[length]
        return self._sequence(mine, [length] * len(mine))

    def _sequence(self, pieces: list[tuple], lengths: list[int]) -> list[tuple]:
        at, out = 0, []
        for piece, n in zip(pieces, lengths, strict=True):
            out.append((*piece, self.next, at))
            at += n
        self.next += 1
        return out

    def rest(self) -> Iterator[tuple]:
        """The open sequences' pieces, largest first.  A piece starts at a multiple of its length, so
        neither full sequences nor the ever shorter ones of the total's binary digits cut one."""
        left = [(p, n) for n in sorted(self.open, reverse=True) for p in self.open[n]]
        total, at = sum(n for _, n in left), 0
        for size in class_lengths(total, self.capacity):
            held, filled = [], 0
            while filled < size:
                held.append(left[at])
                filled += left[at][1]
                at += 1
            yield from self._sequence([p for p, _ in held], [n for _, n in held])
        self.open = {}


_FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
_PLACE = [("sequence_id", pa.int64()), ("offset", pa.int64())]


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids], sequence_id, offset): a row for each piece of each document.

    A document's ids are the tokenizer's and one end; null and empty texts are the end alone.  ``capacity``
    is a power of two.  Sequences are gapless from offset 0; all but a few of a task are full, and those have a power of
    two as length.  Repeated rows and rows without doc_id are packed each for itself, texts of any length
    in pieces; an empty table gives no rows.  Columns other than doc_id and text are not used.  Numbers of
    sequences are distinct, not dense, and no sequence reaches across tasks, so a lost task is just run again.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    schema = pa.schema(_FIELDS + [("ids", pa.binary())] * keep_ids + _PLACE)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = WordEncoder(tokenizer), END.to_bytes(4, "little")
        filler = Filler(capacity, TaskContext.get().partitionId() << 40)

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            for first in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(first, DOCS_AT_ONCE)
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), map(encode, [t or "" for t in part.column(1).to_pylist()]), strict=True):
                    raw = memoryview(ids + last)
                    n, start = len(raw) // 4, 0
                    for length in class_lengths(n, capacity):
                        own = raw[4 * start : 4 * (start + length)]
                        rows += filler.place((doc, start, length, zlib.crc32(own), n, *([bytes(own)] * keep_ids)), length)
                        start += length
                if rows:
                    yield made(rows)
        rest = list(filler.rest())
        if rest:
            yield made(rest)

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * keep_ids + ", sequence_id long, offset long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(go, kind)


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, pad: int = END) -> DataFrame:
    """(sequence_id, length, ids): the sequences themselves, little-endian 32-bit ids, padded with ``pad`` to
    ``capacity`` unless their length is a power of two."""
    pieces = pack(docs, tokenizer, capacity, keep_ids=True)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # of one sequence
    whole = F.concat_ws("", F.transform(parts, lambda p: F.hex(p["ids"])))
    rows = pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), whole.alias("hex"))
    short = F.when(F.bit_count("length") == 1, 0).otherwise(capacity - F.col("length"))
    return rows.select("sequence_id", "length", F.unhex(F.concat("hex", F.expr(f"repeat('{pad.to_bytes(4, 'little').hex()}', int({capacity}))").substr(F.lit(1), 8 * short))).alias("ids"))
