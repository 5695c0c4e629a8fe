"""Root-cause ranking of an incident's clusters against what was usual before it.

The incident's events are split at their median time, and each cluster weighed by how its rate changed across it; the
abnormal onset is the earliest failing event inside the incident, and a cluster counts the more the nearer to it it
begins.  Edges in and out, what a cluster leads to, severities, codes, and its trigger statistics make up the rest; factors
below one hold back clusters of successes, of routine traffic and those that were there before the incident.

Defined results: only events with a time count; a cluster of the incident without events is not ranked; where fewer than
three clusters have a trigger score above 0.5 or more than five errors, all of them are; equal scores rank by name.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scores import c
from ..storage import store
from . import causal
from .incidents import SECOND
from .temporal import median_times
from .trigger import KEYS, count_if

INCIDENT = ["run_id", "incident_id"]
# Weights of worst code classes and of cluster types.
CLASS_WEIGHT = {5: 3.0, 4: 2.4, 3: 1.0, 2: 0.6}
TYPE_WEIGHT = {"candidate": 2.0, "baseline": -2.0}
OTHER_TYPE = -1.5


def between(low: float, x: Column, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(x, F.lit(high)))


def early_bonus(first_us, start_us) -> Column:
    """6, 4, 2 or 0: for beginning by the start, less than 30 s or less than 120 s after it."""
    late = (c(first_us) - c(start_us)) / SECOND
    return F.when(late <= 0, 6).when(late < 30, 4).when(late < 120, 2).otherwise(0)


def member_features(events: DataFrame, members: DataFrame, incidents: DataFrame) -> DataFrame:
    """A row an incident and cluster: size, first time, severities, codes, change across the median, and the incident's onset."""
    window = incidents.select(*INCIDENT, "start_us", "end_us")
    own = members.select(*INCIDENT, "cluster_id").distinct().join(window, INCIDENT)
    e = events.where("us is not null").select(*KEYS, "us", "severity", "response_code").join(own, KEYS)
    e = store(e.withColumn("incident", F.struct(*INCIDENT)), "member-events")
    split = median_times(e.select(F.col("incident").alias("run_id"), "us")).select(F.col("run_id").alias("incident"), "split")
    code = F.nullif(F.col("response_code"), F.lit(0))
    level = F.when(F.upper(F.trim("severity")) == "WARNING", "WARN").otherwise(F.upper(F.trim("severity")))
    failing = F.coalesce(code >= 400, level.isin("ERROR", "WARN"), F.lit(False))
    inside = F.col("us").between(F.col("start_us"), F.col("end_us"))
    g = e.join(split, "incident").groupBy(*INCIDENT, "cluster_id", "start_us", "end_us").agg(
        F.count("*").alias("size"), F.min("us").alias("first_us"), F.min(F.when(failing & inside, F.col("us"))).alias("failing_us"), *[count_if(level == s).alias(f"n_{s.lower()}") for s in ("ERROR", "WARN", "INFO")],
        F.max(code).alias("worst"), F.coalesce(F.bool_and(code.between(200, 299)), F.lit(False)).alias("all_success"), count_if(F.col("us") < F.col("split")).alias("before"),
    )
    whole = Window.partitionBy(*INCIDENT)
    g = g.withColumn("onset_us", F.coalesce(F.min("failing_us").over(whole), "start_us")).withColumn("share", F.col("size") / F.sum("size").over(whole))
    return g.withColumn("change", (F.col("size") - 2 * F.col("before")) / F.col("size"))


def member_weights(members: DataFrame, edges: DataFrame) -> DataFrame:
    """Weights in and out of each cluster over the edges that begin at clusters of its incident."""
    own = members.select(*INCIDENT, "cluster_id").distinct()
    sub = edges.select("run_id", F.col("source").alias("cluster_id"), "target", "score").join(own, KEYS)
    out = sub.groupBy(*INCIDENT, "cluster_id").agg(F.sum("score").alias("out_weight"))
    into = sub.groupBy(*INCIDENT, F.col("target").alias("cluster_id")).agg(F.sum("score").alias("in_weight"))
    key = [*INCIDENT, "cluster_id"]
    return own.join(out, key, "left").join(into, key, "left").na.fill(0.0, ["out_weight", "in_weight"])


def ranked_causes(incidents: DataFrame, members: DataFrame, events: DataFrame, edges: DataFrame, stats: DataFrame, types: DataFrame, top: int | None = 5) -> DataFrame:
    """The ``top`` clusters (None: all) of each incident with score, its parts and rank.

    incidents: run_id, incident_id, start_us, end_us; members: run_id, incident_id, cluster_id; edges: run_id, source,
    target, score; stats: trigger_score and error_count a cluster; types: cluster_type a cluster.
    """
    key = [*INCIDENT, "cluster_id"]
    f = member_features(events, members, incidents).join(member_weights(members, edges), key)
    direct = edges.where("score > 0").groupBy("run_id", F.col("source").alias("cluster_id")).agg(F.count_distinct("target").alias("direct"))
    f = f.join(stats.select(*KEYS, "trigger_score", "error_count"), KEYS, "left").join(types.select(*KEYS, "cluster_type"), KEYS, "left")
    f = f.join(direct, KEYS, "left").join(causal.reach(edges), KEYS, "left").na.fill(0, ["trigger_score", "error_count", "direct", "downstream"])
    whole = Window.partitionBy(*INCIDENT)
    strong = (F.col("trigger_score") > 0.5) | (F.col("error_count") > 5)
    f = f.withColumn("_strong", count_if(strong).over(whole)).where(strong | (F.col("_strong") < 3)).drop("_strong")
    weight = F.coalesce(*[F.when(F.col("cluster_type") == t, w) for t, w in TYPE_WEIGHT.items()], F.lit(OTHER_TYPE))
    structure = between(0.0, F.col("out_weight") - 0.5 * F.col("in_weight") + 0.1 * F.log1p("size") + weight, 5.0)
    severity = (2.0 * F.col("n_error") + F.col("n_warn") - 0.7 * F.col("n_info")) / F.greatest("size", F.lit(1))
    span = F.greatest(F.lit(60.0), (F.col("end_us") - F.col("start_us")) / SECOND)
    late = F.greatest(F.lit(0.0), (F.col("first_us") - F.col("onset_us")) / SECOND)
    idle = F.col("out_weight") <= 0
    worst = F.floor(F.greatest(F.coalesce("worst", F.lit(200)), F.lit(200)) / 100)
    parts = {
        "structure": structure * between(0.25, 1 + F.col("change"), 2.0) * between(0.5, 1 + 0.25 * severity, 2.0),
        "proximity": 1 - F.least(F.lit(1.0), late / span),
        "reach": F.least(F.lit(4.0), 0.4 * F.col("direct")) + F.log1p("downstream"),
        "factor": F.coalesce(*[F.when(worst == k, w) for k, w in CLASS_WEIGHT.items()], F.lit(1.0)) * F.when(F.col("all_success") & idle, 0.2).otherwise(1.0) * F.when((F.col("share") > 0.15) & idle, 0.3).otherwise(1.0) * F.when(F.col("first_us") < F.col("start_us"), 0.4).otherwise(1.0),
        "bonus": early_bonus("first_us", "start_us"),
    }
    for name, col in parts.items():
        f = f.withColumn(name, col)
    score = (F.col("structure") + 3.0 * F.col("proximity") + 2.0 * F.col("trigger_score") + 0.4 * F.sqrt("error_count") + F.col("reach")) * F.col("factor") + F.col("bonus")
    f = f.withColumn("score", F.round(score, 6))
    rank = F.row_number().over(whole.orderBy(F.desc("score"), "cluster_id")).alias("rank")
    rounded = [F.round(x, 6).alias(x) for x in ("change", "proximity", "reach", "factor", "out_weight", "in_weight", "share")]
    f = f.select(*key, "start_us", "onset_us", "first_us", "size", *rounded, "bonus", "score", rank)
    return f if top is None else f.where(F.col("rank") <= top)
