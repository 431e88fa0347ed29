"""MinHash near-duplicates by min-max hashing.

Every permutation of the shingles gives two signature values, its minimum and its maximum, so
a signature of 120 values takes 60 hash evaluations for each shingle.  Both ends agree with
probability equal to the Jaccard similarity and are negatively correlated, which lowers the
variance of the agreement against independent minima.  24 bands of five values make two sets
of similarity 0.85 candidates with probability 1 - (1 - 0.85**5)**24, all but one in a
million; every candidate is then compared on its full set.

Documents with the same set form a class that is carried by one representative.  A band's
bucket is a unit of comparison; buckets with the same members are compared once.  Large units
are cut into blocks, and a task compares two blocks, so no task holds an unbounded group; it
returns a spanning forest of the links it finds, so the number of rows stays in proportion to
the members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import text as T
from riskloom.llm.base import BitFilter, arrow_map, batch_of, cut, key_hash, lists
from riskloom.llm.components import connected_components

SHINGLE_WORDS = 5
SIMILARITY = 85  # per cent
PERMUTATIONS = 60
BAND_ROWS = 5
BLOCK_MEMBERS = 512
BLOCK_SHINGLES = 1_000_000

_rng = np.random.default_rng(77)
_MULTIPLIERS = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIXERS = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of all documents of a run, sorted in each; counts by document)."""
    n = len(offs) - 1
    start, end, doc = T.word_spans(buf, offs, T.NOT_SPACE)
    words = T.span_hashes(buf, start, end, lower=True)
    lim = T.bounds(doc, n)
    sh, at = T.shingles(words, lim, k)
    owner = doc[at]
    size = np.diff(lim)
    for i in np.flatnonzero((size > 0) & (size < k)):  # the whole sequence is one shingle
        part, _ = T.shingles(words[lim[i] : lim[i + 1]], np.array([0, size[i]]), int(size[i]))
        sh, owner = np.append(sh, part), np.append(owner, i)
    order = np.lexsort((sh, owner))
    sh, owner = sh[order], owner[order]
    keep = np.ones(len(sh), bool)
    keep[1:] = (sh[1:] != sh[:-1]) | (owner[1:] != owner[:-1])
    sh, owner = sh[keep], owner[keep]
    return sh, np.bincount(owner, minlength=n).astype(np.int64)


def class_ids(sh: np.ndarray, count: np.ndarray) -> list[bytes | None]:
    """A 128-bit name of each set; None for an empty one."""
    sums = [np.zeros(len(sh) + 1, np.uint64), np.zeros(len(sh) + 1, np.uint64)]
    np.cumsum(T.mix(sh ^ _MIXERS[62]), out=sums[0][1:])
    np.cumsum(T.mix(sh ^ _MIXERS[63]), out=sums[1][1:])
    hi = np.cumsum(count)
    lo = hi - count
    both = np.stack([T.mix(sums[0][hi] - sums[0][lo] + count.astype(np.uint64)), sums[1][hi] - sums[1][lo]], axis=1)
    return [both[i].tobytes() if c else None for i, c in enumerate(count)]


def signatures(docs: DataFrame, k: int = SHINGLE_WORDS, permutations: int = PERMUTATIONS, rows: int = BAND_ROWS) -> DataFrame:
    """(doc_id, n_shingles, cid, bands): size and name of the shingle set, one key for each band."""
    bands = 2 * permutations // rows
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("cid", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def sign(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0)
        for a, b, buf, offs in T.runs(batch.column(1)):
            sh, count = shingle_sets(buf, offs, k)
            full = np.flatnonzero(count)
            keys = np.zeros((len(full), bands), np.uint64)
            if len(full):
                first = (np.cumsum(count) - count)[full]
                # all minima, then all maxima: the two ends of a permutation are in different bands
                for at in range(2 * permutations):
                    p = at % permutations
                    if at < permutations:
                        x = sh * _MULTIPLIERS[p]
                        low = np.minimum.reduceat(x, first)
                        high = np.maximum.reduceat(x, first)
                        for value, slot in ((low, p), (high, p + permutations)):
                            if slot // rows < bands:
                                keys[:, slot // rows] += T.mix(value) * _MIXERS[slot % rows]
                keys = T.mix(keys)
            yield batch_of(schema, ids.slice(a, b - a), count, pa.array(class_ids(sh, count), pa.binary()), lists(T.signed(keys.ravel()), np.where(count > 0, bands, 0)))

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), sign, "doc_id long, n_shingles long, cid binary, bands array<long>")


def _compare(ids: list[bytes], block: np.ndarray, sets: list[np.ndarray], per_cent: int) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the links between two blocks (or within one) of a unit."""
    first: dict[bytes, int] = {}
    for i, c in enumerate(ids):
        first.setdefault(c, i)
    keep = list(first.values())
    ids, block, sets = [ids[i] for i in keep], block[keep], [sets[i] for i in keep]
    n = len(ids)
    if n < 2:
        return []
    size = np.array([len(s) for s in sets])
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [(ids[0], ids[1])] if 100 * both >= per_cent * (size.sum() - both) else []
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    lim = np.concatenate([[0], np.cumsum(size)])
    mark = np.zeros(int(flat.max()) + 1, np.int32)
    root = np.arange(n)
    out = []
    two = block.min() != block.max()
    for i in range(n - 1):
        mine = flat[lim[i] : lim[i + 1]]
        mark[mine] = 1
        both = np.add.reduceat(mark[flat[lim[i + 1] :]], lim[i + 1 : -1] - lim[i + 1])
        mark[mine] = 0
        ok = 100 * both >= per_cent * (size[i] + size[i + 1 :] - both)
        if two:
            ok &= block[i + 1 :] != block[i]
        for j in np.flatnonzero(ok) + i + 1:
            if root[i] != root[j]:
                root[root == root[j]] = root[i]
                out.append((ids[i], ids[j]))
    return out


def links(docs: DataFrame, sig: DataFrame, k: int = SHINGLE_WORDS, per_cent: int = SIMILARITY, members: int = BLOCK_MEMBERS) -> tuple[DataFrame, DataFrame]:
    """(classes: cid, rep; links: u, v between cids).  Every pair of classes that shares a
    bucket is compared on its full sets or already joined through links of its unit."""
    spark = docs.sparkSession
    classes = sig.where("cid is not null and doc_id is not null").groupBy("cid").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = cut(classes, "classes")
    slots = classes.select("cid", "rep", "n", F.posexplode("bands").alias("band", "key"))
    units = (
        slots.groupBy("band", "key")
        .agg(F.count("*").alias("m"), F.sum("n").alias("total"), F.bit_xor(F.xxhash64("cid")).alias("x"), F.min("cid").alias("first"))
        .where("m > 1")
        .groupBy("m", "total", "x", "first")
        .agg(F.min(F.struct("band", "key")).alias("at"))
        .select(F.col("at.band").alias("band"), F.col("at.key").alias("key"), F.greatest(F.ceil(F.col("m") / members), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    )
    held = slots.join(units, ["band", "key"]).select("band", "key", "cid", "rep", F.expr("pmod(xxhash64(cid, 5), blocks)").cast("int").alias("block"), "blocks")
    held = held.select("band", "key", "cid", "rep", "block", F.explode(F.expr("transform(sequence(0, blocks - 1), j -> struct(least(j, block) as lo, greatest(j, block) as hi))")).alias("pair"))
    held = cut(held.select("band", "key", "pair.lo", "pair.hi", "block", "cid", "rep"), "held")
    wanted = BitFilter.of(held.select("rep").distinct().select(key_hash("rep").alias("h")), "h").shared(spark)
    schema = pa.schema([("rep", pa.int64()), ("cid", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def full_sets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        some = batch.filter(pa.array(wanted.value.contains(batch.column(2).to_numpy())))
        for a, b, buf, offs in T.runs(some.column(1)):
            sh, count = shingle_sets(buf, offs, k)
            yield batch_of(schema, some.column(0).slice(a, b - a), pa.array(class_ids(sh, count), pa.binary()), lists(T.signed(sh), count))

    sets = arrow_map(docs.select(F.col("doc_id").cast("long"), "text", key_hash(F.col("doc_id").cast("long"))), full_sets, "rep long, cid binary, shingles array<long>")
    rows = held.join(sets, ["rep", "cid"]).select("band", "key", "lo", "hi", "block", "cid", "shingles")
    pair = pa.schema([("u", pa.binary()), ("v", pa.binary())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by unit and pair of blocks; the last group of a batch waits for the next."""
        wait: list[pa.RecordBatch] = []
        last = None

        def done() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(wait).combine_chunks()
            if t.num_rows < 2:
                return
            col = [t[c].to_numpy() for c in ("band", "key", "lo", "hi")]
            lim = np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in col], axis=0), [True]]))
            ids, block = t["cid"].to_pylist(), t["block"].to_numpy()
            arr = t["shingles"].combine_chunks()
            arr = arr.chunk(0) if isinstance(arr, pa.ChunkedArray) else arr
            values, offs = arr.values.to_numpy().view(np.uint64), arr.offsets.to_numpy()
            out = []
            for a, b in zip(lim[:-1], lim[1:], strict=True):
                if b - a > 1:
                    out += _compare(ids[a:b], block[a:b], [values[offs[i] : offs[i + 1]] for i in range(a, b)], per_cent)
            if out:
                yield batch_of(pair, pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary()))

        def border(batch: pa.RecordBatch) -> int:
            """Row at which the last group of the batch begins."""
            same = np.ones(batch.num_rows, bool)
            for c in range(4):
                x = batch.column(c).to_numpy()
                same &= x == x[-1]
            return int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0

        for batch in batches:
            if not batch.num_rows:
                continue
            head = tuple(batch.column(c)[0].as_py() for c in range(4))
            if wait and head != last:
                yield from done()
                wait = []
            cut_at = border(batch)
            if cut_at:
                wait.append(batch.slice(0, cut_at))
                yield from done()
                wait = [batch.slice(cut_at)]
            else:
                wait.append(batch)
            last = tuple(batch.column(c)[batch.num_rows - 1].as_py() for c in range(4))
        if wait:
            yield from done()

    parted = rows.repartition("band", "key", "lo", "hi").sortWithinPartitions("band", "key", "lo", "hi")
    return classes.select("cid", "rep"), parted.mapInArrow(compare, "u binary, v binary")


def near_duplicates(docs: DataFrame, k: int = SHINGLE_WORDS, per_cent: int = SIMILARITY, permutations: int = PERMUTATIONS, rows: int = BAND_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text, ...).

    ``component_id`` is the smallest doc_id reachable over links of Jaccard similarity
    ``per_cent`` or more between sets of ``k``-word shingles; a lower one needs more bands or
    fewer ``rows`` in each (see above).  Null, empty and wordless texts have no
    shingles and stand alone; texts of fewer than ``k`` words are one shingle.  Repeated rows
    (same doc_id) are answered alike, each by its own text.  A row without doc_id is linked
    with nothing of its own but gets the component of its set.  An empty table gives no rows.
    """
    sig = cut(signatures(docs, k, permutations, rows), "signatures")
    classes, found = links(docs, sig, k, per_cent)
    roots = connected_components(cut(found, "links"))
    named = classes.join(roots, classes.cid == roots.node, "left").select("cid", "rep", F.coalesce("root", "cid").alias("root"))
    named = cut(named, "named")
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "root").select("cid", "component_id")
    out = sig.drop("bands").join(named, "cid", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
