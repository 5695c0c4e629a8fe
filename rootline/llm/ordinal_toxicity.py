"""Toxicity by cumulative-link ordinal regression on sparse text features (operator 4).

Grades are 0 (not toxic) to 3.  The labels say toxic or not, and nothing in them orders toxic texts (their quality does
not: as a second threshold it halved the toxic texts found).  So the labelled sample is cut in two, a model of one half
rates the toxic texts of the other, and the tertile of that rating is a text's grade; no text is graded by a model that
has seen its label.  The model is P(grade <= j) = F(theta_j - w.x) with the logistic F: one weight vector for all ordered thresholds.  x holds log counts
of whole words and of word beginnings (inflected insults share a beginning), as exact 64-bit hashes of the features
that training selected.  The output is the expected grade, the median grade (the largest that the text reaches with a
likelihood of a half or more), and whether that is above 0.

Training reads at most ``per_class`` labelled texts of each class, those with the least hash of doc_id (a documented
bound; the default takes 10,000 each).  Scoring reads every text whole, shuffles nothing and is a row by row map.

Defined results: null, empty and blank texts score as texts without features; labels without a toxic value or text are
not used; of labels that contradict each other toxic counts; without toxic or without clean labels nothing is toxic; repeated rows and rows without doc_id are scored one by
one; a very long text is one row like any other; extra columns, whatever their names, are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import units
from .shared import Sent, documents, store, tidy

PREFIXES = (4, 5, 6, 7, 8)
GRADES = 3
SCORES = "doc_id long, severity double, grade int, toxic boolean, probabilities array<double>"


class Features:
    """Hashes of the words and word beginnings of a chunk of texts."""

    def __init__(self):
        self.mask, self.lower, self.roll = units.word_mask(units.NOT_ALNUM), units.lower_table(), units.Rolling()

    def read(self, data: np.ndarray, offsets: np.ndarray):
        """Yield (row, hash) arrays, one pair for each kind of feature."""
        starts, ends, bounds = units.words(data, offsets, self.mask)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
        values, long = self.roll.bytes[self.lower], [np.flatnonzero(ends - starts > k) for k in PREFIXES]
        found = np.empty(len(starts), np.uint64), *[np.empty(len(x), np.uint64) for x in long]
        for lo, hi in units.pieces(starts, ends):
            first = starts[lo]
            prefix = self.roll.prefix(values[data[first : ends[hi - 1]]])
            found[0][lo:hi] = self.roll.span(prefix, starts[lo:hi] - first, ends[lo:hi] - first)
            for k, x, h in zip(PREFIXES, long, found[1:]):
                a, b = np.searchsorted(x, [lo, hi])
                at = starts[x[a:b]] - first
                h[a:b] = units.mix(self.roll.span(prefix, at, at + k) ^ np.uint64(k))
        yield row, found[0]
        for x, h in zip(long, found[1:]):
            yield row[x], h


class Lookup:
    """Exact positions of hashes in a small sorted set, behind a bit table that most hashes fail."""

    def __init__(self, hashes: np.ndarray, bits: int = 20):
        self.hashes, self.shift = np.sort(hashes), np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[self.hashes >> self.shift] = True

    def find(self, row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        some = np.flatnonzero(self.table[hashes >> self.shift])
        at = np.minimum(np.searchsorted(self.hashes, hashes[some]), max(0, len(self.hashes) - 1))
        hit = self.hashes[at] == hashes[some] if len(self.hashes) else np.zeros(len(some), bool)
        return row[some[hit]], at[hit]


def sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(toxic, text) of at most per_class labelled documents of each class; equal texts once."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    chosen = None
    for c in (1, 0):
        few = known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = few if chosen is None else chosen.unionByName(few)
    return docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))


def _select(texts: DataFrame, toxic: int, most: int) -> np.ndarray:
    """Hashes of the features that occur mostly in toxic texts, the most telling first, at most ``most``."""

    def count(batches):
        features, found = Features(), []
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in units.text_chunks(batch, "text", 1 << 20):
                for row, h in features.read(data, offsets):
                    order = np.lexsort((h, row))
                    row, h = row[order], h[order]
                    new = np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, bool)
                    h, y = h[new], label[lo:hi][row[new]]
                    u, inverse = np.unique(h, return_inverse=True)
                    found.append((u, np.bincount(inverse, y, len(u)), np.bincount(inverse, minlength=len(u))))
        if found:
            u, inverse = np.unique(np.concatenate([x[0] for x in found]), return_inverse=True)
            bad, n = (np.bincount(inverse, np.concatenate([x[i] for x in found]), len(u)).astype(np.int64) for i in (1, 2))
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(bad), pa.array(n)], ["h", "bad", "n"])

    least = max(4, toxic // 100)
    rows = texts.select("text", "toxic").mapInArrow(tidy(count), "h long, bad long, n long").groupBy("h").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    rows = rows.where(f"bad >= {least} and bad >= 0.6 * (n + 2)").orderBy(F.expr("bad * bad / n").desc(), "h").limit(most).collect()
    return np.array([r.h for r in rows], np.int64).view(np.uint64)


def _matrix(texts: DataFrame, lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Labels, and row, column and count of the selected features, of the sample, its texts ordered by hash.

    Tasks deliver rows in no fixed order; ordered, every run splits and fits the same rows alike."""

    def find(batches):
        features, known = Features(), lookup.load()
        for batch in batches:
            for lo, hi, data, offsets in units.text_chunks(batch, "text", 1 << 20):
                n, width = hi - lo, len(known.hashes)
                pairs = [known.find(row, h) for row, h in features.read(data, offsets)]
                key, times = np.unique(np.concatenate([r * width + c for r, c in pairs]), return_counts=True)
                told = batch.column(1).slice(lo, n).to_numpy(zero_copy_only=False).astype(np.int8), batch.column(2).slice(lo, n).to_numpy(zero_copy_only=False).astype(np.int64)
                packed = *told, (key // max(1, width)).astype(np.int32), (key % max(1, width)).astype(np.int32), times.astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in packed], ["toxic", "place", "row", "at", "times"])

    rows = texts.select("text", "toxic", F.xxhash64("text").alias("place")).mapInArrow(tidy(find), "toxic binary, place binary, row binary, at binary, times binary").collect()
    flat = lambda name, kind: np.concatenate([np.zeros(0, kind), *[np.frombuffer(r[name], kind) for r in rows]])
    size = np.cumsum([0] + [len(r["toxic"]) for r in rows])
    row = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(r["row"], np.int32) + first for r, first in zip(rows, size)]])
    order = np.argsort(flat("place", np.int64), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    row, at = rank[row.astype(np.int64)], flat("at", np.int32).astype(np.int64)
    by_row = np.lexsort((at, row))
    return flat("toxic", np.int8).astype(np.int64)[order], row[by_row], at[by_row], flat("times", np.int32).astype(np.int64)[by_row]


def fit(y: np.ndarray, row: np.ndarray, col: np.ndarray, x: np.ndarray, width: int, grades: int, steps: int = 1000, l1: float = 0.01, rate: float = 0.05):
    """Weights and thresholds of the cumulative-link model, by Adam with soft thresholding of the weights."""
    n, f = len(y), lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    w, theta = np.zeros(width), np.linspace(1, 3, grades)
    m, v = np.zeros(width + grades), np.zeros(width + grades)
    for t in range(1, steps + 1):
        eta = np.bincount(row, w[col] * x, n)
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        a, b = f(edge[y + 1] - eta), f(edge[y] - eta)
        a[y == grades], b[y == 0] = 1, 0
        gap = np.maximum(a - b, 1e-9)
        g_eta = -(a + b - 1) / n
        g_theta = -(np.bincount(y, a * (1 - a) / gap, grades + 1)[:grades] - np.bincount(y, b * (1 - b) / gap, grades + 1)[1:]) / n
        g = np.concatenate([np.bincount(col, g_eta[row] * x, width), g_theta])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w -= move[:width]
        w = np.sign(w) * np.maximum(np.abs(w) - rate * l1, 0)
        theta = np.maximum.accumulate(theta - move[width:] + 1e-3 * np.arange(grades))
    return w, theta


def grades(toxic: np.ndarray, row: np.ndarray, col: np.ndarray, x: np.ndarray, width: int) -> np.ndarray:
    """0 for clean texts; toxic ones get the tertile, from 1, of their rating by a model of the half without them."""
    half, rating = np.arange(len(toxic)) % 2, np.zeros(len(toxic))
    for h in (0, 1):
        known = half[row] != h
        number = np.cumsum(half != h) - 1
        w, _ = fit(toxic[half != h], number[row[known]], col[known], x[known], width, 1, steps=300)
        rating += np.where(half == h, np.bincount(row, w[col] * x, len(toxic)), 0)
    cuts = np.quantile(rating[toxic == 1], np.arange(1, GRADES) / GRADES)
    return np.where(toxic == 1, 1 + np.searchsorted(cuts, rating, "left"), 0)


def train(docs: DataFrame, labels: DataFrame, per_class: int = 10_000, most: int = 4000):
    """(lookup, weights, thresholds); no features when a class is missing."""
    texts = store(sample(docs, labels, per_class), "toxic-sample")
    spark = docs.sparkSession
    number = {r.toxic: r["count"] for r in texts.groupBy("toxic").count().collect()}
    hashes = _select(texts, number[1], most) if len(number) == 2 else np.zeros(0, np.uint64)
    lookup = Lookup(hashes)
    if not len(hashes):
        return lookup, np.zeros(0), np.full(GRADES, 10.0)
    known = labels.where("toxic is not null").agg(F.sum(F.expr("if(toxic > 0, 1, 0)")).alias("bad"), F.count("*").alias("n")).first()
    ratio = max(1.0, (known.n - known.bad) / number[0] * number[1] / known.bad)  # the sample may hold a smaller share of clean texts
    toxic, row, col, times = _matrix(texts, Sent(spark, lookup))
    y = grades(toxic, row, col, np.log1p(times), len(hashes))
    w, theta = fit(y, row, col, np.log1p(times), len(hashes), GRADES)
    return lookup, w, theta + np.log(ratio)


def score(docs: DataFrame, model, chunk: int = 2 << 20) -> DataFrame:
    """doc_id, severity (expected grade), grade, toxic and the grades' probabilities of every document."""
    shared = Sent(docs.sparkSession, model)

    def rows(batches):
        lookup, w, theta = shared.load()
        features = Features()
        for batch in batches:
            for lo, hi, data, offsets in units.text_chunks(batch, "text", chunk):
                n, eta = hi - lo, np.zeros(hi - lo)
                if len(w):
                    pairs = [lookup.find(row, h) for row, h in features.read(data, offsets)]
                    key, times = np.unique(np.concatenate([r * len(w) + c for r, c in pairs]), return_counts=True)
                    eta = np.bincount(key // len(w), w[key % len(w)] * np.log1p(times), n)
                over = 1 / (1 + np.exp(np.clip(theta[None, :] - eta[:, None], -40, 40)))  # P(grade > j)
                p = np.concatenate([np.ones((n, 1)), over], axis=1) - np.concatenate([over, np.zeros((n, 1))], axis=1)
                lists = pa.ListArray.from_arrays(pa.array((np.arange(n + 1) * p.shape[1]).astype(np.int32)), pa.array(p.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), pa.array(over.sum(axis=1)), pa.array((over >= 0.5).sum(axis=1).astype(np.int32)), pa.array(over[:, 0] >= 0.5), lists], ["doc_id", "severity", "grade", "toxic", "probabilities"])

    return docs.select("doc_id", "text").mapInArrow(tidy(rows), SCORES)


def op4_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = score(docs, train(docs, documents(spark, sf_dir, "labels")))
    return found.select("doc_id", F.round("severity", 6).alias("severity"), "grade", "toxic")
