"""Exact top-k search of binary codes by incremental multi-index hashing (operator 8).

A vector's code has one sign bit for each of its first 64 components.  Codes are cut into segments, and each segment
indexes all codes.  A query searches every segment with all values within a radius that grows by one: after radius r,
every code within ``segments * (r + 1) - 1`` bits has been seen, because a code further off in all segments differs in
more bits than that.  The radius grows until the k-th verified Hamming distance is so covered.

Equal codes are one index entry that keeps its k + 1 smallest ids (more can never be returned), summed up before the
shuffle, so a vector that fills a third of the table is one entry.  The index lies in shards; queries, the rows whose
id is divisible by ``every``, go to all shards in blocks of bounded size, and each shard returns k + 1 rows a query.
With several blocks, each block's result is written before the next one is sent, so neither the plan nor what is held
for sending grows with the number of queries.

Defined results: a null id or vector is left out; of an id that repeats the least code counts; missing or null
components give a 0 bit; a query is not its own neighbour; equal distances rank by id; fewer than k others give fewer;
components after the 64th and extra columns, whatever their names, are ignored.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import units
from .shared import documents, new_path, parts, store

HITS = "query_id long, neighbor_id long, distance int"


def sign_codes(vectors: DataFrame) -> DataFrame:
    """(id, code) with each id once."""

    def rows(batches):
        for b in batches:
            lists = b.column(1)
            flat = np.nan_to_num(pa.compute.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False).astype(np.float64), nan=-1.0)
            size = np.diff(lists.offsets.to_numpy())
            row, at = np.repeat(np.arange(len(size)), size), units.ragged(size)
            first = at < 64
            code = np.zeros(len(size), np.uint64)
            np.bitwise_or.at(code, row[first], (flat[first] >= 0).astype(np.uint64) << at[first].astype(np.uint64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(code.view(np.int64))], ["id", "code"])

    known = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<float>").alias("v")).where("id is not null and v is not null")
    return known.mapInArrow(rows, "id long, code long").groupBy("id").agg(F.min("code").alias("code"))


def entries(codes: DataFrame, keep: int) -> DataFrame:
    """(code, ids): each code with its ``keep`` smallest ids; every batch sends no more than that many an entry."""

    def rows(batches):
        for b in batches:
            ids, code = b.column(0).to_numpy(), b.column(1).to_numpy()
            order = np.lexsort((ids, code))
            ids, code = ids[order], code[order]
            new = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
            size = np.diff(np.concatenate([new, [len(code)]]))
            few = np.minimum(size, keep)
            take = np.repeat(new, few) + units.ragged(few)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(few)]).astype(np.int32)), pa.array(ids[take]))
            yield pa.RecordBatch.from_arrays([pa.array(code[new]), lists], ["code", "ids"])

    return codes.mapInArrow(rows, "code long, ids array<long>").groupBy("code").agg(F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, keep).alias("ids"))


class Shard:
    """Multi-index over the codes of one shard."""

    def __init__(self, codes: np.ndarray, number: np.ndarray, segments: int):
        self.codes, self.number, self.segments, self.width = codes, number, segments, 64 // segments
        self.mask = np.uint64((1 << self.width) - 1)
        self.order, self.start = [], []
        for s in range(segments):
            value = (codes >> np.uint64(s * self.width)) & self.mask
            order = np.argsort(value, kind="stable")
            self.order.append(order)
            self.start.append(np.searchsorted(value[order], np.arange((1 << self.width) + 1, dtype=np.uint64)))
        self.flips: list[np.ndarray] = []

    def within(self, radius: int) -> np.ndarray:
        while len(self.flips) <= radius:
            r = len(self.flips)
            self.flips.append(np.array([sum(1 << i for i in c) for c in combinations(range(self.width), r)], np.uint64))
        return self.flips[radius]

    def nearest(self, query: np.uint64, want: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries and distances, all that can hold one of the ``want`` nearest ids."""
        seen = np.zeros(len(self.codes), bool)
        at, far = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for radius in range(self.width + 1):
            for s in range(self.segments):
                value = ((query >> np.uint64(s * self.width)) & self.mask) ^ self.within(radius)
                lo = self.start[s][value]
                size = self.start[s][value + np.uint64(1)] - lo
                some = size > 0
                found = self.order[s][np.repeat(lo[some], size[some]) + units.ragged(size[some])]
                found = found[~seen[found]]
                seen[found] = True
                at = np.concatenate([at, found])
                far = np.concatenate([far, np.bitwise_count(self.codes[found] ^ query).astype(np.int64)])
            covered = self.segments * (radius + 1) - 1
            sure = far <= covered
            if len(at) == len(self.codes) or self.number[at[sure]].sum() >= want:
                order = np.argsort(far, kind="stable")
                reach = np.cumsum(self.number[at[order]])
                last = far[order][min(len(order) - 1, int(np.searchsorted(reach, want)))] if len(order) else 0
                near = far <= last
                return at[near], far[near]
        return at, far


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, segments: int = 4, block: int = 65_536) -> DataFrame:
    """query_id, rank, neighbor_id, distance: the k nearest others of each row whose id is divisible by ``every``."""
    if segments not in (4, 8, 16):
        raise ValueError("segments must be 4, 8 or 16")
    codes = store(sign_codes(vectors), "mih-codes")
    index = store(entries(codes, k + 1).repartition(parts(codes), "code"), "mih-index")
    queries = codes.where(F.pmod("id", F.lit(every)) == 0)
    blocks = max(1, -(-queries.count() // block))
    spark = codes.sparkSession
    best = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")

    def found(i: int):
        """The broadcast queries of a block and their ranked neighbours."""
        few = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i).orderBy("id").collect()
        shared = spark.sparkContext.broadcast((np.array([r.id for r in few], np.int64), np.array([r.code for r in few], np.int64).view(np.uint64)))

        def search(batches):
            got = [b for b in batches if b.num_rows]
            if not got:
                return
            ids = pa.chunked_array([b.column(1) for b in got]).combine_chunks()
            edge, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
            shard = Shard(np.concatenate([b.column(0).to_numpy() for b in got]).view(np.uint64), np.diff(edge), segments)
            out, rows = [], 0
            for q, code in zip(*shared.value):
                at, far = shard.nearest(code, k + 1)
                size = np.diff(edge)[at]
                near = flat[np.repeat(edge[at], size) + units.ragged(size)]
                far = np.repeat(far, size)
                order = np.lexsort((near, far))
                order = order[near[order] != q][:k]
                out.append((np.full(len(order), q), near[order], far[order].astype(np.int32)))
                rows += len(order)
                if rows >= 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["query_id", "neighbor_id", "distance"])
                    out, rows = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["query_id", "neighbor_id", "distance"])

        rows = index.mapInArrow(search, HITS).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return shared, rows.select("query_id", "rank", "neighbor_id", "distance")

    if blocks == 1:
        return found(0)[1]
    path = new_path(spark, "mih-found")
    for i in range(blocks):
        shared, rows = found(i)
        rows.write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.schema(rows.schema).parquet(path)


def op8_mih_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(documents(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH c AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x >= 0 AS INTEGER)) AS b FROM embeddings),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS neighbor_id, CAST(list_sum(list_transform(list_zip(q.b, c.b), lambda z: CAST(z[1] <> z[2] AS INTEGER))) AS INTEGER) AS distance
      FROM c AS q, c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, neighbor_id, distance FROM r WHERE rank <= 10
"""
