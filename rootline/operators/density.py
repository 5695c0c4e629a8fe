"""Hierarchical density clusters: a bounded, evenly spaced sample is clustered, every other vector placed beside it.

The clusters are those of a hierarchy by mutual reachability (Campello, Moulavi, Sander): the distance of two vectors is the
largest of their own distance and their core distances (to the ``min_size``-th other vector); its minimum spanning tree is
found in Boruvka rounds; the tree, cut from the longest edge down, is condensed to clusters of ``min_size`` members, and
those of largest stability are chosen.

Every pass over pairs runs in Spark tasks, a block of the sample's rows against all of it; the sample has ``most`` rows at
most and goes to all tasks, core distances and component numbers likewise.  A round sends one edge a component to the
driver.  Larger tables are sampled by place in the order of vec_id and all their rows placed at the nearest centroid, so no
row is without a cluster; at or below ``most`` rows the members are those of the tree, the rest is noise (-1).

Defined results: rows without vec_id or vector are left out; distances count to six places, equal ones go by vec_id; a vec_id
that repeats is two vectors; clusters are numbered from 0 by their least vec_id; a table of fewer than ``min_size`` + 1 rows
is noise.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clusters import evenly
from .vectors import kmeans, nearest_of, unit

MOST = 10_000
FAST = 60_000
PLACES = 1e6
SMALL = 1e-6
BLOCK = 256


def spanning_tree(spark, data: np.ndarray, core_of: int) -> list[tuple[float, int, int]]:
    """Edges (distance, a, b) of the minimum spanning tree by mutual reachability over the rows of ``data``."""
    n = len(data)
    shared = spark.sparkContext.broadcast(data)
    rows = spark.range(0, n, 1, min(n, max(8, -(-n // BLOCK)))).select(F.col("id"))

    def passes(step, schema):
        block, places = BLOCK, PLACES

        def run(batches):
            x = shared.value
            square = (x * x).sum(axis=1)
            for b in batches:
                ids = b.column(0).to_numpy()
                for lo in range(0, len(ids), block):
                    at = ids[lo : lo + block]
                    far = np.sqrt(np.maximum(square[at][:, None] + square[None] - 2 * (x[at] @ x.T), 0))
                    yield step(at, np.rint(far * places) / places)

        return rows.mapInArrow(run, schema)

    def core(at, far):
        far[np.arange(len(at)), at] = -1.0
        return pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.partition(far, core_of, axis=1)[:, core_of])], ["id", "core"])

    cores = np.zeros(n)
    for r in passes(core, "id long, core double").collect():
        cores[r.id] = r.core
    own, edges = np.arange(n), []
    while len(edges) < n - 1:
        sent = spark.sparkContext.broadcast((cores, own))

        def nearest(at, far, sent=sent):
            cores, own = sent.value
            far = np.maximum(np.maximum(far, cores[at][:, None]), cores[None])
            far[own[at][:, None] == own[None]] = np.inf
            to = np.argmin(far, axis=1)  # the least number of equal ones
            ends = [np.minimum(at, to), np.maximum(at, to)]
            return pa.RecordBatch.from_arrays([pa.array(own[at]), pa.array(far[np.arange(len(at)), to]), *map(pa.array, ends)], ["own", "far", "a", "b"])

        least = passes(nearest, "own long, far double, a long, b long").groupBy("own").agg(F.min(F.struct("far", "a", "b")).alias("e")).select("e.*").collect()
        parent = np.arange(n)

        def top(i):
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            return i

        for far, a, b in sorted(set(map(tuple, least))):
            one, other = top(own[a]), top(own[b])
            if one != other:
                parent[max(one, other)] = min(one, other)
                edges.append((far, a, b))
        own = np.array([top(i) for i in own])
        sent.destroy()
    shared.destroy()
    return sorted(edges)


def chosen(edges: list[tuple[float, int, int]], n: int, min_size: int) -> np.ndarray:
    """A cluster for each of n members (-1: none) from the sorted edges of their spanning tree."""
    # the hierarchy: node n + i joins the two nodes that edge i connects
    node, parent = np.arange(n), np.arange(n)
    kids, size = {}, [1] * n

    def top(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, (_, a, b) in enumerate(edges):
        one, other = top(a), top(b)
        kids[n + i] = (node[one], node[other])
        size.append(size[node[one]] + size[node[other]])
        parent[other] = one
        node[one] = n + i
    # condensed: clusters with the density at which they begin, and at which each member or pair of new clusters leaves
    begin, above, stable, left, new = [0.0], [-1], [0.0], np.zeros(n, int), [[]]
    todo = [(n + len(edges) - 1, 0)] if edges else []
    while todo:
        at, c = todo.pop()
        if at < n:
            continue
        density = 1 / max(edges[at - n][0], SMALL)
        big = [k for k in kids[at] if size[k] >= min_size]
        for k in kids[at]:
            gone = k not in big or len(big) == 2
            if gone:
                stable[c] += size[k] * (density - begin[c])
            if len(big) == 2:
                begin.append(density)
                above.append(c)
                stable.append(0.0)
                new[c].append(len(new))
                new.append([])
                todo.append((k, len(new) - 1))
            elif not gone:
                todo.append((k, c))
            else:
                inside = [k]
                while inside:
                    x = inside.pop()
                    if x < n:
                        left[x] = c
                    else:
                        inside += kids[x]
    best, keep = list(stable), [True] * len(new)
    for c in range(len(new) - 1, 0, -1):  # those below have larger numbers
        below = sum(best[k] for k in new[c])
        if new[c] and below > best[c]:
            best[c], keep[c] = below, False
    keep[0] = False
    label = []
    for c in range(len(new)):  # the highest cluster kept on the way down
        over = label[above[c]] if c else -1
        label.append(over if over >= 0 else c if keep[c] else -1)
    return np.array(label)[left] if len(edges) else np.full(n, -1)


def tree_clusters(spark, ids: np.ndarray, data: np.ndarray, min_size: int) -> np.ndarray:
    """Cluster numbers of bounded vectors, in order of their ids."""
    if len(ids) <= min_size:
        return np.full(len(ids), -1)
    found = chosen(spanning_tree(spark, data, min_size), len(ids), min_size)
    order = sorted({c for c in found if c >= 0}, key=lambda c: ids[found == c].min())
    return np.array([order.index(c) if c >= 0 else -1 for c in found])


def density_clusters(vectors: DataFrame, min_size: int = 15, most: int = MOST, overflow: str = "downsample", mode: str = "standard") -> DataFrame:
    """(vec_id, cluster).  mode: standard (the tree), fast (k-means over all rows) or auto (fast from ``FAST`` rows on);
    overflow: what happens beyond ``most`` rows, downsample or fail."""
    if mode not in ("standard", "fast", "auto") or overflow not in ("downsample", "fail"):
        raise ValueError("mode is standard, fast or auto, overflow downsample or fail")
    spark = vectors.sparkSession
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>")).where("vec_id is not null and embedding is not null")
    n = v.count()
    if mode == "fast" or (mode == "auto" and n > FAST):
        return kmeans(v, min_size)
    if n > most and overflow == "fail":
        raise ValueError(f"{n} vectors are more than {most}")
    sample = (evenly(v, ["vec_id", "embedding"], most) if n > most else v).toArrow().sort_by([("vec_id", "ascending")])
    ids = sample.column("vec_id").to_numpy()
    data = np.array(sample.column("embedding").to_pylist(), np.float64)
    found = tree_clusters(spark, ids, data, min_size)
    if n <= most:
        order = np.lexsort((found, ids))
        return spark.createDataFrame(pa.table({"vec_id": ids[order], "cluster": found[order]}))
    if not (found >= 0).any():
        return v.select("vec_id", F.lit(-1).cast("long").alias("cluster"))
    centers = [(int(c), data[found == c].mean(axis=0).tolist()) for c in range(found.max() + 1)]
    near = spark.createDataFrame(centers, "cluster long, centroid array<double>").select("cluster", unit("centroid").alias("c"))
    return nearest_of(v.withColumn("embedding", unit("embedding")), near, "cluster").select("vec_id", F.col("nearest").alias("cluster"))
