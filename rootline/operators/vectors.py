"""Embedding vectors: hashing embedder, centroids, representatives, nearest centroid, k nearest vectors, k-means."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import scores as S
from ..storage import new_path


def dot(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(column: str):
    """The vector divided by its length (plus 1e-12)."""
    length = F.sqrt(dot(column, column)) + 1e-12
    return F.transform(column, lambda x: (x.cast("double") / length).cast("float"))


def hashed_vectors(texts: DataFrame, column: str = "embedding_text", size: int = 256) -> DataFrame:
    """A unit vector of hashed words for each distinct text: embed once, join back by text."""
    from pyspark.ml.feature import HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    words = texts.select(column).distinct().withColumn("_w", F.split(F.lower(F.coalesce(column, F.lit(""))), r"[^a-z0-9_]+"))
    tf = HashingTF(inputCol="_w", outputCol="_tf", numFeatures=size).transform(words)
    return Normalizer(inputCol="_tf", outputCol="_n").transform(tf).select(column, vector_to_array("_n", "float32").alias("embedding"))


def centroids(vectors: DataFrame, label: str = "label") -> DataFrame:
    """Mean vector of each label, with partial sums in every task."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    mean = Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>")))
    return vectors.where("embedding is not null").groupBy(label).agg(vector_to_array(mean).alias("centroid"))


def nearest_of(vectors: DataFrame, centers: DataFrame, label: str, block: int = 4096) -> DataFrame:
    """(vec_id, nearest, cosine): for each vector the center (label, c) of largest product; the least label of equal ones.

    Centers go to all tasks in blocks of about ``block``; a task multiplies its vectors with a block as matrices and keeps
    the best.  With several blocks, each block's result is written before the next one is sent, then the best of all taken.
    """
    spark = vectors.sparkSession
    blocks = max(1, -(-centers.count() // block))
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("nearest", centers.schema[label].dataType), T.StructField("cosine", T.DoubleType())])

    def best_of(i: int):
        few = centers.select(label, "c").where(F.col(label).isNotNull())
        few = (few.where(F.pmod(F.xxhash64(label), F.lit(blocks)) == i) if blocks > 1 else few).orderBy(label).collect()
        shared = spark.sparkContext.broadcast(([r[0] for r in few], np.array([r[1] for r in few], np.float64)))
        kind = to_arrow_type(centers.schema[label].dataType)

        def search(batches):
            names, c = shared.value
            for b in batches:
                for lo in range(0, b.num_rows if names else 0, 2048):
                    part = b.slice(lo, 2048)
                    x = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(part.num_rows, -1)
                    dots = x @ c.T
                    at = np.argmax(dots, axis=1)
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array([names[j] for j in at], kind), pa.array(dots[np.arange(len(at)), at])], ["vec_id", "nearest", "cosine"])

        given = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>")).where("vec_id is not null and embedding is not null")
        return given.mapInArrow(search, schema)

    if blocks == 1:
        return best_of(0)
    path = new_path(spark, "nearest")
    for i in range(blocks):
        best_of(i).write.mode("append").parquet(path)
    found = spark.read.schema(schema).parquet(path)
    # the greatest product, then the least label
    first = F.min(F.struct((-F.col("cosine")).alias("far"), "nearest"))
    return found.groupBy("vec_id").agg(first.alias("b")).select("vec_id", F.col("b.nearest").alias("nearest"), (-F.col("b.far")).alias("cosine"))


def nearest_centroid(vectors: DataFrame, centers: DataFrame, label: str = "label") -> DataFrame:
    """The centroid of largest cosine for each vector, for any number of centroids."""
    found = nearest_of(vectors, centers.select(label, unit("centroid").alias("c")), label)
    return found.withColumn("cosine", F.round("cosine", 5))


def representatives(vectors: DataFrame, label: str = "label") -> DataFrame:
    """The member of each label nearest to its unit centroid."""
    c = centroids(vectors, label).select(label, unit("centroid").alias("c"))
    j = vectors.join(c, label).withColumn("score", dot("embedding", "c"))
    return j.groupBy(label).agg(F.max_by("vec_id", F.struct("score", -F.col("vec_id"))).alias("representative"), F.round(F.max("score"), 5).alias("score"), F.count("*").alias("size"))


def nearest_vectors(vectors: DataFrame, queries: DataFrame, k: int = 10, block: int = 10_000) -> DataFrame:
    """The k vectors of largest inner product (to five places) with each query; equal ones rank by vec_id.

    Queries go to all tasks in blocks of about ``block``; a task multiplies its vectors with them in small matrices and
    sends on its k best a query, so no scored pair leaves a task but those.  With several blocks, each block's result is
    written before the next one is sent.
    """
    spark = vectors.sparkSession
    blocks = max(1, -(-queries.count() // block))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best_of(i: int):
        few = queries.select("vec_id", "embedding").where("vec_id is not null and embedding is not null")
        few = (few.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == i) if blocks > 1 else few).collect()
        shared = spark.sparkContext.broadcast((np.array([r[0] for r in few], np.int64), np.array([r[1] for r in few], np.float64)))

        def search(batches):
            ids, q = shared.value
            score, near = np.full((len(ids), k), -np.inf), np.full((len(ids), k), -1, np.int64)
            for b in batches:
                b = b.filter(pc.and_(b.column(0).is_valid(), b.column(1).is_valid()))
                for lo in range(0, b.num_rows if len(ids) else 0, 2048):
                    part = b.slice(lo, 2048)
                    at = part.column(0).to_numpy(zero_copy_only=False)
                    x = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), -1)
                    for first in range(0, len(ids), 512):
                        rows = slice(first, first + 512)
                        dots = q[rows] @ x.T
                        s = np.concatenate([score[rows], np.sign(dots) * np.floor(np.abs(dots) * 1e5 + 0.5) / 1e5], axis=1)
                        n = np.concatenate([near[rows], np.broadcast_to(at, dots.shape)], axis=1)
                        s[n == ids[rows][:, None]] = -np.inf
                        least = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
                        r, c = np.nonzero(s >= least[:, None])
                        order = np.lexsort((n[r, c], -s[r, c], r))
                        r, c = r[order], c[order]
                        edge = np.searchsorted(r, np.arange(len(s)))
                        keep = edge[:, None] + np.arange(k)
                        score[rows], near[rows] = s[r[keep], c[keep]], n[r[keep], c[keep]]
            if len(ids):
                some = np.isfinite(score)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, some.sum(axis=1))), pa.array(near[some]), pa.array(score[some])], ["query_id", "vec_id", "score"])

        found = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>")).mapInArrow(search, "query_id long, vec_id long, score double")
        return shared, found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    if blocks == 1:
        return best_of(0)[1]
    path = new_path(spark, "nearest")
    for i in range(blocks):
        shared, found = best_of(i)
        found.write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.schema(found.schema).parquet(path)


def kmeans_k(n: int, min_size: int = 15, most: int = 300) -> int:
    return max(1, min(n, max(8, min(most, n // max(min_size * 6, 60)))))


def kmeans(vectors: DataFrame, min_size: int = 15, seed: int = 42) -> DataFrame:
    """(vec_id, cluster) by k-means, k after the number of vectors; clusters below min_size are noise (-1)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    v = vectors.select("vec_id", array_to_vector(unit("embedding")).alias("features"))
    model = KMeans(k=kmeans_k(v.count(), min_size), seed=seed, maxIter=20).fit(v)
    found = model.transform(v).select("vec_id", F.col("prediction").alias("cluster"))
    size = found.groupBy("cluster").agg(F.count("*").alias("size"))
    return found.join(F.broadcast(size), "cluster").select("vec_id", F.when(F.col("size") >= min_size, F.col("cluster")).otherwise(-1).alias("cluster"))


def reduced(vectors: DataFrame, dims: int) -> DataFrame:
    """Principal components of unit vectors (signs and rotation may differ between implementations)."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = vectors.withColumn("_v", array_to_vector(unit("embedding")))
    return PCA(k=dims, inputCol="_v", outputCol="_p").fit(v).transform(v).withColumn("embedding", vector_to_array("_p", "float32")).drop("_v", "_p")


def cluster_table(events: DataFrame) -> DataFrame:
    """Size, span and type of each cluster of a run."""
    total = Window.partitionBy("run_id")
    g = events.groupBy("run_id", "cluster_id").agg(F.count("*").alias("size"), F.min("us").alias("first_us"), F.max("us").alias("last_us"), F.min_by("event_id", F.struct("us", "event_id")).alias("representative"))
    return g.withColumn("cluster_type", S.cluster_type("size", F.sum("size").over(total)))


def signature_clusters(events: DataFrame, text: str = "embedding_text", min_size: int = 15) -> DataFrame:
    """Exact clusters: events of one embedding text; texts with fewer than min_size events are noise (-1)."""
    size = events.groupBy(text).agg(F.count("*").alias("size"))
    named = size.select(text, F.when(F.col("size") >= min_size, F.concat(F.lit("S"), F.substring(F.sha2(text, 256), 1, 12))).otherwise("-1").alias("cluster_id"), "size")
    return events.drop("cluster_id").join(named, text)
