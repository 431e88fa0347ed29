"""Language-model scores from a log-bilinear model trained with noise-contrastive estimation.

The vocabulary is factored so that normalising is cheap: the most frequent words are units of
their own, all others belong to a unit by their ending, and one unit ends a text.  The
log-bilinear model predicts the next unit from the two before it; a word's probability is its unit's
times its share of the unit's training counts, add-one smoothed, with a place for the unseen.

Counts come from Spark: words, then triples of units, over all training texts.  The parameters
(a few thousand numbers) are fitted in numpy on the triple counts, against noise drawn from the units'
frequencies.  Matrix products over all pairs of context units give the normalised log-probability of
every unit, and a table of those (bounded by the units) scores texts.  Counts of the ``FREQUENT``
words go to the tasks; all rarer tokens find theirs in a join, so every token has its exact count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import text as T
from riskloom.llm.base import arrow_map, batch_of, cut, lists

OWN = 96
ENDINGS = 64
END, START = OWN + ENDINGS, OWN + ENDINGS + 1
UNITS = OWN + ENDINGS + 1  # that can be predicted
CONTEXTS = UNITS + 1
FREQUENT = 1 << 18
DIMENSIONS = 24
NOISE = 32
STEPS = 6000
BATCH = 256  # products this small stay on one thread
HELD_OUT = 2  # of the remainders of crc32(doc_id) modulo 7


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(7)) == HELD_OUT, F.lit(False))


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, their endings, the documents' word offsets)."""
    start, end, doc = T.word_spans(buf, offs, T.NOT_SPACE)
    h = T.signed(T.span_hashes(buf, start, end, lower=True))
    low = T.LOWER[buf] if len(buf) else buf
    last = low[end - 1].astype(np.int64)
    before = np.where(end - start > 1, low[np.maximum(end - 2, 0)], 0).astype(np.int64)
    return h, (before * 37 + last) % ENDINGS, T.bounds(doc, len(offs) - 1)


@dataclass
class Vocabulary:
    """Counts of the frequent words, and which of them are units."""

    keys: np.ndarray  # sorted hashes
    count: np.ndarray
    unit: np.ndarray  # of each key, -1 if it has none of its own

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among the keys, is it there?)"""
        if not len(self.keys):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return at, self.keys[at] == h

    def units(self, h: np.ndarray, ending: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(unit of each word, place, is it frequent?)"""
        at, known = self.find(h)
        own = np.where(known, self.unit[at], -1) if len(self.keys) else np.full(len(h), -1)
        return np.where(own >= 0, own, OWN + ending), at, known


def contexts(unit: np.ndarray, lim: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pair of context units, unit) for each word and each text's end, in order."""
    n = len(lim) - 1
    size = np.diff(lim)
    row = np.repeat(np.arange(n), size)
    seq = np.full(len(unit) + 3 * n, START, np.int64)  # two starts before, the end after each text
    seq[np.arange(len(unit)) + 3 * row + 2] = unit
    seq[lim[1:] + 3 * np.arange(n) + 2] = END
    real = np.ones(len(seq), bool)
    first = lim[:-1] + 3 * np.arange(n)
    real[first] = real[first + 1] = False
    at = np.flatnonzero(real)
    return seq[at - 2] * CONTEXTS + seq[at - 1], seq[at]


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, ending, c) over all tokens of ``texts`` (text)."""
    schema = pa.schema([("h", pa.int64()), ("ending", pa.int32()), ("c", pa.int64())])

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for _, _, buf, offs in T.runs(batch.column(0), 1 << 23):
            h, ending, _ = words(buf, offs)
            keys, first, c = np.unique(h, return_index=True, return_counts=True)
            yield batch_of(schema, keys, ending[first].astype(np.int32), c)

    return arrow_map(texts, count, "h long, ending int, c long").groupBy("h").agg(F.first("ending").alias("ending"), F.sum("c").alias("c"))


def triple_counts(texts: DataFrame, sent) -> DataFrame:
    """(code, n): counts of three units in a row; codes are bounded by the units."""
    schema = pa.schema([("code", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CONTEXTS * CONTEXTS * UNITS, np.int32)
        for batch in batches:
            for _, _, buf, offs in T.runs(batch.column(0)):
                h, ending, lim = words(buf, offs)
                pair, unit = contexts(sent.value.units(h, ending)[0], lim)
                code, n = np.unique(pair * UNITS + unit, return_counts=True)
                total[code] += n.astype(np.int32)
        some = np.flatnonzero(total)
        yield batch_of(schema, some, total[some].astype(np.int64))

    return texts.mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def train(code: np.ndarray, n: np.ndarray, dims: int = DIMENSIONS, steps: int = STEPS, seed: int = 6) -> np.ndarray:
    """log10 P(unit | pair of context units), normalised: an array [pair, unit].

    Noise-contrastive estimation with Adam: each drawn triple is told from
    ``NOISE`` units drawn by frequency, which the triples of a batch share.
    """
    rng = np.random.default_rng(seed)
    pair, unit = np.divmod(code, UNITS)
    one, two = np.divmod(pair, CONTEXTS)
    freq = np.bincount(unit, weights=n, minlength=UNITS) + 1.0
    noise = freq / freq.sum()
    chance = np.cumsum(n) / n.sum() if len(n) else None
    p = {
        "r": rng.normal(0, 0.1, (CONTEXTS, dims)),  # context vectors
        "q": rng.normal(0, 0.1, (UNITS, dims)),  # target vectors
        "c1": np.eye(dims) * 0.5 + rng.normal(0, 0.05, (dims, dims)),
        "c2": np.eye(dims) + rng.normal(0, 0.05, (dims, dims)),
        "b": np.log(noise),
    }
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(x) for k, x in p.items()}
    noise_sum, log_noise = np.cumsum(noise), np.log(NOISE * noise)
    for step in range(1, steps + 1 if len(n) else 1):
        at = np.searchsorted(chance, rng.random(BATCH))
        a, b, true = one[at], two[at], unit[at]
        false = np.minimum(np.searchsorted(noise_sum, rng.random(NOISE)), UNITS - 1)  # shared by the batch
        ra, rb = p["r"][a], p["r"][b]
        hidden = ra @ p["c1"] + rb @ p["c2"]
        q_true, q_false = p["q"][true], p["q"][false]
        s_true = (hidden * q_true).sum(axis=1) + p["b"][true] - log_noise[true]
        s_false = hidden @ q_false.T + p["b"][false] - log_noise[false]
        d_true = (1 / (1 + np.exp(-np.clip(s_true, -30, 30))) - 1) / BATCH
        d_false = 1 / (1 + np.exp(-np.clip(s_false, -30, 30))) / BATCH
        g = {k: np.zeros_like(x) for k, x in p.items()}
        np.add.at(g["b"], true, d_true)
        np.add.at(g["b"], false, d_false.sum(axis=0))
        np.add.at(g["q"], true, d_true[:, None] * hidden)
        np.add.at(g["q"], false, d_false.T @ hidden)
        dh = d_true[:, None] * q_true + d_false @ q_false
        g["c1"], g["c2"] = ra.T @ dh, rb.T @ dh
        np.add.at(g["r"], a, dh @ p["c1"].T)
        np.add.at(g["r"], b, dh @ p["c2"].T)
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    first, second = p["r"] @ p["c1"], p["r"] @ p["c2"]
    out = np.empty((CONTEXTS * CONTEXTS, UNITS), np.float32)
    for a in range(CONTEXTS):  # one batched product for each first unit
        z = (first[a] + second) @ p["q"].T + p["b"]
        z -= z.max(axis=1, keepdims=True)
        out[a * CONTEXTS : (a + 1) * CONTEXTS] = (z - np.log(np.exp(z).sum(axis=1, keepdims=True))) / np.log(10)
    return out


def lm_scores(docs: DataFrame, frequent: int = FREQUENT, steps: int = STEPS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, per_token) for every row.

    Tokens are words between white space, A-Z lower-cased, and one end.  Rows whose crc32(doc_id) modulo 7
    isn't 2, those without doc_id too, are learned from.  ``base_score`` is the add-one unigram log10 probability,
    ``score`` the model's.  Null and empty texts are their end alone.  Repeated rows count, and are
    scored, each for itself.  Empty tables give no rows; without training rows all tokens are unknown.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out().alias("held_out"))
    texts = docs.where(~F.col("held_out")).select("text")
    counts = cut(word_counts(texts), "word-counts")
    ends = texts.count()
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, kinds = sums["n"] + ends, sums["v"] + (ends > 0)
    top = counts.orderBy(F.desc("c"), "h").limit(frequent).select("h", "c").toArrow()  # at most ``frequent`` rows
    h, c = top["h"].to_numpy(), top["c"].to_numpy()
    unit = np.full(len(h), -1)
    unit[np.lexsort((h, -c))[:OWN]] = np.arange(min(OWN, len(h)))
    order = np.argsort(h)
    vocabulary = Vocabulary(h[order], c[order], unit[order])
    sent = spark.sparkContext.broadcast(vocabulary)
    triples = triple_counts(texts, sent).toArrow()  # bounded by the units
    table = spark.sparkContext.broadcast(train(triples["code"].to_numpy(), triples["n"].to_numpy(), steps=steps))
    own = pa.array(h[unit >= 0])
    own_sum = {r["ending"]: r for r in counts.where(~F.col("h").isin(own.to_pylist())).groupBy("ending").agg(F.sum("c").alias("c"), F.count("*").alias("k")).collect()}  # at most ENDINGS rows
    share = np.log10([own_sum[e]["c"] + own_sum[e]["k"] + 1 if e in own_sum else 1 for e in range(ENDINGS)])
    fields = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("model", pa.float64()), ("rare", pa.list_(pa.int64()))]
    schema = pa.schema(fields)
    end_count = np.log10(ends + 1)

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        log_count = np.append(np.log10(sent.value.count + 1.0), 0.0)
        for a, b, buf, offs in T.runs(batch.column(2)):
            h, ending, lim = words(buf, offs)
            units, at, known = sent.value.units(h, ending)
            pair, u = contexts(units, lim)
            n = b - a

            def by_doc(x: np.ndarray, lim: np.ndarray) -> np.ndarray:
                s = np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)])
                return s[lim[1:]] - s[lim[:-1]]

            log_c = np.where(known, log_count[at], 0.0)
            in_class = units >= OWN
            model = by_doc(table.value[pair, u], lim + np.arange(n + 1)) + by_doc(np.where(in_class, log_c - share[ending], 0.0), lim)
            rare = h[~known]
            size = by_doc(~known, lim).astype(np.int64)
            known_n = np.diff(lim) - size + (ends > 0)
            yield batch_of(schema, batch.column(0).slice(a, n), batch.column(1).slice(a, n), np.diff(lim) + 1, known_n, by_doc(log_c, lim) + end_count, model, lists(rare, size, pa.int64()))

    kind = "doc_id long, held_out boolean, n_tokens long, known long, base double, model double, rare array<long>"
    rows = cut(arrow_map(docs.select("doc_id", "held_out", "text"), score, kind).withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    hits = rows.select("row", F.explode("rare").alias("h")).join(counts.select("h", "c"), "h")
    extra = hits.groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("c") + 1)).alias("plus"))
    out = rows.drop("rare").join(extra, "row", "left")
    plus = F.coalesce("plus", F.lit(0.0))
    base = F.col("base") + plus - F.col("n_tokens") * F.lit(float(np.log10(total + kinds + 1)))
    model = F.col("model") + plus
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"), base.alias("base_score"), model.alias("score"), (model / F.col("n_tokens")).alias("per_token"))
