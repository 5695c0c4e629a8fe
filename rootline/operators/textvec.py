"""Vectors of texts: words weighed by rarity and reduced to their main directions, or any model applied in batches.

Words are hashed to ``features`` columns and weighed by their number in the text times ln((texts + 1) / (texts with it + 1)).
The main directions of that table are found by block power iteration: each pass multiplies every text's row with the
directions so far and adds up its share of the next ones, a small dense matrix a task; sums meet by row block, and only
the sum, of fixed size, comes to the driver.  The start is drawn with a fixed seed and each direction's largest entry made
positive, so a table gives the same vectors but for rounding.

Defined results: equal texts have one vector; a null text is an empty one; a text without words, or whose words stand in
every text, has a vector of zeros; a text of any length is one row.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import store

FEATURES = 4096
ROWS = 256


def weighed(texts: DataFrame, column: str, features: int) -> tuple[DataFrame, np.ndarray]:
    """(text column, at, n) of each distinct text, its feature numbers and counts; and the weight of each feature."""
    few = ROWS

    def count(batches):
        import re
        import zlib
        from collections import Counter

        word, known = re.compile(r"\w+"), {}

        def feature(w):
            if w not in known:
                if len(known) > 1 << 18:
                    known.clear()
                known[w] = zlib.crc32(w.encode()) % features
            return known[w]

        for b in batches:
            for lo in range(0, b.num_rows, few):
                part = b.slice(lo, few)
                found = [sorted(Counter(feature(m.group()) for m in word.finditer((t or "").lower())).items()) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([[i for i, _ in x] for x in found], pa.list_(pa.int32())), pa.array([[n for _, n in x] for x in found], pa.list_(pa.int32()))], [column, "at", "n"])

    rows = store(texts.select(F.coalesce(column, F.lit("")).alias(column)).distinct().mapInArrow(count, f"`{column}` string, at array<int>, n array<int>"), "words")
    total, weights = rows.count(), np.zeros(features)
    for r in rows.select(F.explode("at").alias("at")).groupBy("at").count().collect():  # a row a feature
        weights[r["at"]] = np.log((total + 1) / (r["count"] + 1))
    return rows, weights


def directions(rows: DataFrame, weights: np.ndarray, dims: int, rounds: int, seed: int) -> np.ndarray:
    """The ``dims`` main directions (columns) of the weighed table."""
    spark, features, few, side = rows.sparkSession, len(weights), ROWS, 256
    width = min(features, dims + 8)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(features, width)))[0]
    dense = densely(features, few)

    def multiplied(q):
        sent = spark.sparkContext.broadcast((weights, q))

        def share(batches):
            weights, q = sent.value
            total = np.zeros(q.shape)
            for x in dense(batches):
                x *= weights
                total += x.T @ (x @ q)
            cuts = range(0, features, side)
            yield pa.RecordBatch.from_arrays([pa.array([lo // side for lo in cuts], pa.int32()), pa.array([total[lo : lo + side].tobytes() for lo in cuts], pa.binary())], ["block", "share"])

        def add(table):
            total = sum(np.frombuffer(x.as_buffer()) for x in table.column("share"))
            return pa.table({"block": table.column("block").slice(0, 1), "share": pa.array([total.tobytes()], pa.binary())})

        found = rows.select("at", "n").mapInArrow(share, "block int, share binary").groupBy("block").applyInArrow(add, "block int, share binary").collect()
        sent.destroy()
        return np.concatenate([np.frombuffer(r.share) for r in sorted(found)]).reshape(q.shape) if found else np.zeros(q.shape)

    for _ in range(rounds):
        q = np.linalg.qr(multiplied(q))[0]
    small = q.T @ multiplied(q)
    value, turn = np.linalg.eigh((small + small.T) / 2)
    found = (q @ turn)[:, np.argsort(-value)[:dims]]
    return found * np.where(found[np.argmax(np.abs(found), axis=0), np.arange(found.shape[1])] < 0, -1.0, 1.0)


def densely(features: int, few: int):
    """Batches (..., at, n) as dense matrices of some rows."""

    def dense(batches):
        for b in batches:
            for lo in range(0, b.num_rows, few):
                at, n = b.slice(lo, few).columns[-2:]
                row = np.repeat(np.arange(len(at)), at.value_lengths().to_numpy(zero_copy_only=False))
                x = np.zeros((len(at), features))
                x[row, at.flatten().to_numpy(zero_copy_only=False)] = n.flatten().to_numpy(zero_copy_only=False)
                yield x

    return dense


def text_vectors(texts: DataFrame, column: str = "embedding_text", dims: int = 64, features: int = FEATURES, rounds: int = 3, seed: int = 42) -> DataFrame:
    """(text column, embedding): a unit vector for each distinct text."""
    rows, weights = weighed(texts, column, features)
    sent = texts.sparkSession.sparkContext.broadcast((weights, directions(rows, weights, min(dims, features), rounds, seed)))
    dense = densely(features, ROWS)

    def place(batches):
        weights, v = sent.value
        for b in batches:
            made = [(x * weights) @ v for x in dense([b])] or [np.zeros((0, v.shape[1]))]
            e = np.concatenate(made)
            e /= np.linalg.norm(e, axis=1, keepdims=True) + 1e-12
            flat = pa.array(e.astype(np.float32).reshape(-1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(np.arange(len(e) + 1) * v.shape[1], pa.int32()), flat)], [column, "embedding"])

    return rows.mapInArrow(place, f"`{column}` string, embedding array<float>")


def modelled_vectors(texts: DataFrame, make_model, column: str = "embedding_text", batch: int = 256) -> DataFrame:
    """(text column, embedding) by a model of one's own: ``make_model()`` runs once a worker and returns a function from an
    array of texts to a matrix."""
    from pyspark.ml.functions import predict_batch_udf

    def make():
        model = make_model()
        return lambda given: np.asarray(model(given), np.float32)

    embed = predict_batch_udf(make, return_type=T.ArrayType(T.FloatType()), batch_size=batch)
    return texts.select(F.coalesce(column, F.lit("")).alias(column)).distinct().withColumn("embedding", embed(column))
