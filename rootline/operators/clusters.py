"""Cluster features, graph neighbourhoods, event index rows, even samples and explaining edges."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import store
from .trigger import KEYS, count_if

INDEX = "event_id timestamp service severity actor verb resource response_code http_class status_family failure_hint path stage semantic signature embedding_text".split()


def event_index(events: DataFrame) -> DataFrame:
    """The columns of an event that stand beside its vector; columns that are not there are null."""
    return events.select(*[F.col(c) if c in events.columns else F.lit(None).cast("string").alias(c) for c in INDEX])


def cluster_features(events: DataFrame) -> DataFrame:
    """Per cluster: worst status class, whether all codes are successes, span, severities and the first event."""
    worst = F.max(F.when(F.col("status_class") != "unknown", F.col("status_class")))
    good = F.bool_and(F.coalesce(F.col("response_code").between(200, 399), F.lit(False)))
    return events.groupBy(*KEYS).agg(
        worst.alias("worst_class"), good.alias("all_success"), F.min("us").alias("first_us"), F.max("us").alias("last_us"), *[count_if(F.col("severity") == s).alias(f"n_{s.lower()}") for s in ("ERROR", "WARN", "INFO")],
        F.min_by("event_id", F.struct("us", "event_id")).alias("representative"),
    )


def neighbours(edges: DataFrame, firsts: DataFrame, starts: DataFrame, k: int = 5) -> DataFrame:
    """Per cluster of a graph: summed weight out and in, its k strongest targets, and the bonus for beginning early.

    firsts: first_us of each cluster; starts: start_us of each run's incident.  The bonus is 6, 4, 2 or 0 by the delay from
    that start (ranker.early_bonus), 0 in a run without incident.
    """
    from .ranker import early_bonus

    order = Window.partitionBy("run_id", "source").orderBy(F.desc("score"), "target")
    ranked = edges.withColumn("k", F.row_number().over(order))
    out = ranked.groupBy("run_id", F.col("source").alias("cluster_id")).agg(F.round(F.sum("score"), 6).alias("out_weight"), F.expr(f"array_join(transform(array_sort(collect_list(if(k <= {k}, struct(k, target), null))), x -> x.target), ',')").alias("targets"))
    into = edges.groupBy("run_id", F.col("target").alias("cluster_id")).agg(F.round(F.sum("score"), 6).alias("in_weight"))
    both = out.join(into, KEYS, "full_outer").na.fill(0, ["out_weight", "in_weight"]).na.fill("", ["targets"])
    timed = both.join(firsts.select(*KEYS, "first_us"), KEYS, "left").join(starts.select("run_id", "start_us"), "run_id", "left")
    return timed.withColumn("bonus", early_bonus("first_us", "start_us")).drop("first_us", "start_us")


def numbered(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds _r, a row's place in its group from 0 in ``order``, and _n, the rows of the group.

    Rows are sorted by range and counted by partition, so a group of any size is spread over tasks and only its counts meet.
    """
    spark, by = df.sparkSession, [*keys, *order]
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = df.repartitionByRange(count, *by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    rows = store(at.withColumn("_part", F.shiftright("_at", 33)), "numbered")
    whole = Window.partitionBy(*keys)
    runs = rows.groupBy(*keys, "_part").agg(F.count("*").alias("_c"), F.min("_at").alias("_first"))
    runs = runs.withColumn("_n", F.sum("_c").over(whole)).withColumn("_before", F.sum("_c").over(whole.orderBy("_part")) - F.col("_c")).drop("_c")
    same = [F.col("x._part") == F.col("y._part"), *[F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in keys]]
    placed = rows.alias("x").join(runs.alias("y"), same)
    return placed.select("x.*", F.col("y._n").alias("_n"), (F.col("x._at") - F.col("y._first") + F.col("y._before")).alias("_r")).drop("_at", "_part")


def even_sample(df: DataFrame, keys: list[str], order: list[str], cap: int) -> DataFrame:
    """At most ``cap`` rows of each group, evenly spaced in its order, first and last among them (a downsampling operator)."""
    r = numbered(df, keys, order)
    step = F.expr(f"(_r * {max(1, cap - 1)} + _n - 2) div (_n - 1)")
    spaced = r.withColumn("_i", F.when(F.col("_n") > cap, step)).where(f"_n <= {cap} or (_i * (_n - 1)) div {max(1, cap - 1)} = _r")
    return spaced.where(f"_n <= {cap} or _r = 0 or {cap} > 1").drop("_r", "_n", "_i")


def evenly(df: DataFrame, order: list[str], cap: int) -> DataFrame:
    """At most ``cap`` rows of a table, evenly spaced in its order."""
    return even_sample(df.withColumn("_g", F.lit(0)), ["_g"], order, cap).drop("_g")


def explaining_edges(events: DataFrame, clusters: DataFrame) -> DataFrame:
    """(run_id, source, target, kind): an edge from each cluster of ``clusters`` to each of its events."""
    return events.join(clusters.select(*KEYS).distinct(), KEYS, "left_semi").select("run_id", F.col("cluster_id").alias("source"), F.col("event_id").cast("string").alias("target"), F.lit("contains").alias("kind"))
