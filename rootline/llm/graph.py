"""Connected components of an edge table, without gathering a node's neighbours or the graph anywhere."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import store


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge in ``edges`` (a, b); component is the smallest node reachable.

    Alternates large-star and small-star steps until the edges stay the same.  Each step is a grouped minimum and a
    plain join, so a node with any number of neighbours is spread over tasks.
    """
    now = store(edges.selectExpr("greatest(a, b) as u", "least(a, b) as v").where("u <> v").distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(both.where("v < u").groupBy("u").agg(F.min("v").alias("v")))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = store(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
