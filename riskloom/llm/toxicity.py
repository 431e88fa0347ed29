"""Toxicity by class-conditional Kneser-Ney models of bytes.

Both classes share one Kneser-Ney hierarchy: the probability of a byte after a context of four
bytes is the class's own discounted count, and what the discount sets free goes to continuation
counts gathered over both classes.  A rare expression that a class never showed is therefore
judged by the shared counts alike in both, and only the mass each class leaves for novelty
differs.  Log-likelihood ratios of toxic against ordinary are averaged over the
text's length and over short stretches of it (an insult is a few words in a long text), and a logistic
curve, fitted on labelled documents that the models haven't seen, turns them into a score.

The models learn from at most ``TOXIC`` and ``ORDINARY`` labelled documents, whole texts, chosen by a
hash of the doc_id; all counts are Spark aggregates.  What goes to the tasks is a table of
``SLOTS`` and one of ``CONTEXTS`` slots of ``WAYS`` places, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import text as T
from riskloom.llm.base import arrow_map, batch_of, cut

ORDER = 5
DISCOUNT = 0.75
TOXIC = 10_000
ORDINARY = 30_000
SLOTS = 1_048_573  # primes: a gram's slot is its remainder
CONTEXTS = 262_139
WAYS = 4  # places in a slot, for the most frequent
STRETCH = 16  # bytes
BLOCK = 64  # bytes
THRESHOLD = 0.3
HELD_OUT = 2  # of the remainders of crc32(doc_id) modulo 4
CALIBRATE = 3


def remainder(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4))


def grams(buf: np.ndarray, offs: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, position) of each run of ``order`` bytes inside a text, A-Z lower-cased."""
    if len(buf) < order:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = T.LOWER[buf].astype(np.int64)
    m = len(buf) - order + 1
    code = np.zeros(m, np.int64)
    for j in range(order):
        code = (code << 8) | low[j : j + m]
    ok = np.ones(len(buf), bool)
    for j in range(1, order):
        at = offs[1:] - j
        ok[at[at >= offs[:-1]]] = False
    at = np.flatnonzero(ok[:m])
    return code[at], at


class Table:
    """Ratios by gram in a fixed number of places: remainder for the slot, a tag of the quotient in each place."""

    def __init__(self, slots: int, rows: pa.Table):
        self.slots = slots
        self.tag = np.zeros(slots * WAYS, np.uint16)  # 0: free
        self.ratio = np.zeros(slots * WAYS, np.float32)
        key = rows["key"].to_numpy()
        at = key % slots * WAYS + rows["place"].to_numpy() - 1
        self.tag[at] = self._tag(key)
        self.ratio[at] = rows["r"].to_numpy()

    def _tag(self, key: np.ndarray) -> np.ndarray:
        return (key // self.slots % 65535 + 1).astype(np.uint16)

    @classmethod
    def of(cls, df: DataFrame, slots: int) -> Table:
        """From (key, n, r): the most frequent ``WAYS`` keys of each slot, chosen before they are gathered."""
        place = F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("n"), "key"))
        rows = df.withColumn("slot", F.pmod("key", F.lit(slots))).withColumn("place", place).where(F.col("place") <= WAYS)
        return cls(slots, rows.select("key", "place", F.col("r").cast("float")).toArrow())

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, ratio)"""
        out, found = np.zeros(len(key), np.float32), np.zeros(len(key), bool)
        base, tag = key % self.slots * WAYS, self._tag(key)
        rest = np.arange(len(key))
        for way in range(WAYS):
            at = base[rest] + way
            there = self.tag[at]
            hit = there == tag[rest]
            found[rest[hit]] = True
            out[rest[hit]] = self.ratio[at[hit]]
            rest = rest[~hit & (there > 0)]
        return found, out


@dataclass
class Model:
    """Ratios of seen grams, of what follows a context unseen, and the fitted curve."""

    seen: Table
    novelty: Table
    curve: np.ndarray | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    prior: float = 0.0

    def byte_ratios(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        out = np.zeros(len(buf), np.float32)
        code, at = grams(buf, offs, ORDER)
        found, out[at] = self.seen.find(code)
        new = np.flatnonzero(~found)
        out[at[new]] = self.novelty.find(code[new] >> 8)[1]
        return out

    def features(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """A row per text: ratio per byte, the highest of a stretch, means of the highest few blocks' stretches, the
        share of blocks with a high one, and the log of the length."""
        n = len(offs) - 1
        out = np.zeros((n, 6))
        ratio = self.byte_ratios(buf, offs)
        sums = np.concatenate([[0.0], np.cumsum(ratio, dtype=np.float64)])
        for i in range(n):
            a, b = int(offs[i]), int(offs[i + 1])
            if b - a < ORDER:
                continue
            w = min(STRETCH, b - a)
            run = sums[a + w : b + 1] - sums[a : b + 1 - w]
            top = np.sort(np.maximum.reduceat(run, np.arange(0, len(run), BLOCK)))[::-1]
            out[i] = (100 * (sums[b] - sums[a]) / (b - a), top[0], top[:3].mean(), top[:6].mean(), 1000 * float((top > 6).sum()) / (b - a), np.log(b - a))
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(x), self.prior)
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))]) @ self.curve
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def sample(docs: DataFrame, labels: DataFrame, toxic: int, ordinary: int) -> DataFrame:
    """(doc_id, toxic, part) of at most ``toxic`` + ``ordinary`` labelled documents, none held out."""
    marked = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("doc_id is not null and toxic in (0, 1)")
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("part", remainder()).where(F.col("part") != HELD_OUT)
    by_hash = F.xxhash64("doc_id", F.lit(10))
    some = [marked.where(F.col("toxic") == c).orderBy(by_hash, "doc_id").limit(n) for c, n in ((1, toxic), (0, ordinary))]
    return cut(some[0].unionByName(some[1]), "sample")


def counts(texts: DataFrame) -> DataFrame:
    """(g, n0, n1): how often each gram stands in ordinary and in toxic texts (text, toxic)."""
    schema = pa.schema([("g", pa.int64()), ("n0", pa.int64()), ("n1", pa.int64())])

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bad = batch.column(1).to_numpy()
        for a, b, buf, offs in T.runs(batch.column(0), 1 << 21):
            code, at = grams(buf, offs, ORDER)
            g, inverse = np.unique(code, return_inverse=True)
            one = np.bincount(inverse, weights=bad[a:b][np.searchsorted(offs, at, "right") - 1], minlength=len(g)).astype(np.int64)
            yield batch_of(schema, g, np.bincount(inverse, minlength=len(g)) - one, one)

    return arrow_map(texts, count, "g long, n0 long, n1 long").groupBy("g").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def shared_backoff(g: DataFrame, order: int) -> DataFrame:
    """(k, p): Kneser-Ney probability of the last byte of each run of ``order`` bytes after the others,
    from continuation counts: in how many longer runs, of either class, it ends them."""
    levels = {order: g.select(F.col("g").bitwiseAND(F.lit((1 << 8 * order) - 1)).alias("k"))}
    for o in range(order - 1, 0, -1):
        levels[o] = levels[o + 1].distinct().select(F.col("k").bitwiseAND(F.lit((1 << 8 * o) - 1)).alias("k"))
    lower = None
    for o in range(1, order + 1):
        seen = levels[o].groupBy("k").agg(F.count("*").alias("n")).withColumn("h", F.shiftright("k", 8))
        total = seen.groupBy("h").agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
        seen = seen.join(total, "h")
        if lower is None:
            base = seen.withColumn("q", F.lit(1 / 256))
        else:
            base = seen.withColumn("s", F.col("k").bitwiseAND(F.lit((1 << 8 * (o - 1)) - 1))).join(lower.select(F.col("k").alias("s"), F.col("p").alias("q")), "s")
        lower = base.select("k", ((F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("kinds") * F.col("q")) / F.col("all")).alias("p"))
        lower = cut(lower, f"backoff-{o}")
    return lower


def ratios(g: DataFrame) -> Model:
    """The two models' log ratios, bounded by slots before they are gathered."""
    shared = shared_backoff(g, ORDER - 1)
    g = g.withColumn("h", F.shiftright("g", 8))
    by_class = [x for c in (0, 1) for x in (F.sum(f"n{c}").alias(f"all{c}"), F.sum((F.col(f"n{c}") > 0).cast("int")).alias(f"kinds{c}"))]
    context = cut(g.groupBy("h").agg(*by_class), "contexts")
    free = {c: F.when(F.col(f"all{c}") > 0, DISCOUNT * F.col(f"kinds{c}") / F.greatest(F.col(f"all{c}"), F.lit(1))).otherwise(1.0) for c in (0, 1)}
    rows = g.join(context, "h").withColumn("k", F.col("g").bitwiseAND(F.lit((1 << 8 * (ORDER - 1)) - 1))).join(shared, "k")
    p = {c: F.greatest(F.col(f"n{c}") - DISCOUNT, F.lit(0.0)) / F.greatest(F.col(f"all{c}"), F.lit(1)) + free[c] * F.col("p") for c in (0, 1)}
    seen = rows.select(F.col("g").alias("key"), (F.col("n0") + F.col("n1")).alias("n"), F.log(p[1] / p[0]).alias("r"))
    new = context.select(F.col("h").alias("key"), (F.col("all0") + F.col("all1")).alias("n"), F.log(free[1] / free[0]).alias("r"))
    return Model(Table.of(seen, SLOTS), Table.of(new, CONTEXTS))


def fit_curve(m: Model, x: np.ndarray, y: np.ndarray) -> None:
    """Logistic regression by Newton steps with a small ridge."""
    m.mean, m.scale = x.mean(0), x.std(0) + 1e-9
    a = np.column_stack([(x - m.mean) / m.scale, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -60, 60)))
        hess = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(hess, a.T @ (p - y) + 1e-2 * w)
    m.curve = w


def train(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, ordinary: int = ORDINARY) -> Model:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = sample(docs, labels, toxic, ordinary)
    texts = docs.join(F.broadcast(chosen), "doc_id")  # at most toxic + ordinary rows of three numbers
    m = ratios(cut(counts(texts.where(F.col("part") != CALIBRATE).select("text", "toxic")), "grams"))
    sent = docs.sparkSession.sparkContext.broadcast(m)
    schema = pa.schema([("x", pa.list_(pa.float64())), ("y", pa.int32())])

    def measure(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a, b, buf, offs in T.runs(batch.column(0)):
            yield batch_of(schema, pa.array(list(sent.value.features(buf, offs)), pa.list_(pa.float64())), batch.column(1).slice(a, b - a))

    rest = arrow_map(texts.where(F.col("part") == CALIBRATE).select("text", "toxic"), measure, "x array<double>, y int").toArrow()
    y = rest["y"].to_numpy()
    m.prior = float(y.mean()) if len(y) else 0.0
    if 0 < y.sum() < len(y):
        fit_curve(m, np.array(rest["x"].to_pylist()), y.astype(float))
    return m


def toxicity(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, ordinary: int = ORDINARY) -> DataFrame:
    """(doc_id, held_out, score, predicted, llr_per_byte) for every row of ``docs``, by its whole text.

    The models see the text alone.  Null and empty texts, and those of fewer than five bytes, have
    all features zero and get the curve's score for that.  A doc_id labelled twice counts as toxic if
    either label says so; labels other than 0 and 1 are ignored.  Without labels of both classes
    every score is the share of toxic ones (0 without any).  A null doc_id isn't held out; repeated rows
    are scored alike; empty tables give no rows.
    """
    return judged(docs, train(docs, labels, toxic, ordinary))


def judged(docs: DataFrame, m: Model) -> DataFrame:
    """The rows of ``toxicity`` by a trained model; it doesn't look at doc_id but for held_out."""
    sent = docs.sparkSession.sparkContext.broadcast(m)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("llr_per_byte", pa.float64())])

    def judge(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a, b, buf, offs in T.runs(batch.column(2)):
            x = sent.value.features(buf, offs)
            score = sent.value.score(x)
            yield batch_of(schema, batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), score, (score >= THRESHOLD).astype(np.int32), x[:, 0] / 100)

    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    held = F.coalesce(remainder() == HELD_OUT, F.lit(False)).alias("held_out")
    return arrow_map(docs.select(doc_id, held, "text"), judge, "doc_id long, held_out boolean, score double, predicted int, llr_per_byte double")
