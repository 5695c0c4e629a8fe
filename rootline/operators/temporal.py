"""Bucketed co-occurrence, precedence and lag correlation of clusters, incident graphs, patterns and change scores."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scores as S
from .incidents import SECOND
from .trigger import KEYS, most_frequent, value_counts


def active_buckets(events: DataFrame, seconds: int, cap: int | None = 5) -> DataFrame:
    """Distinct (run, bucket, cluster), the first ``cap`` clusters by name of a bucket (None: all)."""
    b = events.select("run_id", F.expr(f"us div {seconds * SECOND}").alias("bucket"), "cluster_id").distinct()
    if cap is None:
        return b
    order = Window.partitionBy("run_id", "bucket").orderBy("cluster_id")
    return b.withColumn("k", F.row_number().over(order)).where(F.col("k") <= cap).drop("k")


def cooccurrence(buckets: DataFrame) -> DataFrame:
    """Unordered pairs of clusters and the number of buckets they share; at most 10 pairs come from a bucket of 5."""
    a, b = buckets.withColumnRenamed("cluster_id", "a"), buckets.withColumnRenamed("cluster_id", "b")
    return a.join(b, ["run_id", "bucket"]).where("a < b").groupBy("run_id", "a", "b").agg(F.count("*").alias("n"))


def precedence(buckets: DataFrame, ahead: int = 3, decay: float = 0.7) -> DataFrame:
    """Directed pairs weighted by how many buckets later the second follows: decay ** (steps - 1), summed."""
    a = buckets.withColumnRenamed("cluster_id", "source").select("run_id", "source", "bucket", F.explode(F.sequence(F.lit(1), F.lit(ahead))).alias("step"))
    a = a.select("run_id", "source", "step", (F.col("bucket") + F.col("step")).alias("bucket"))
    b = buckets.withColumnRenamed("cluster_id", "target")
    g = a.join(b, ["run_id", "bucket"]).where("source <> target").groupBy("run_id", "source", "target").agg(F.sum(F.pow(F.lit(decay), F.col("step") - 1)).alias("w"), F.count("*").alias("n"))
    return g.select("run_id", "source", "target", F.round("w", 6).alias("weight"), "n")


def count_series(events: DataFrame, seconds: int = 3600) -> DataFrame:
    """Zero-filled event counts of each cluster over its run's buckets: (run, cluster, i, n)."""
    width = seconds * SECOND
    b = events.groupBy(*KEYS, F.expr(f"us div {width}").alias("bucket")).agg(F.count("*").alias("n"))
    run = b.groupBy("run_id").agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    spine = b.select(*KEYS).distinct().join(run, "run_id").select(*KEYS, "lo", F.explode(F.sequence("lo", "hi")).alias("bucket"))
    return spine.join(b, [*KEYS, "bucket"], "left").select(*KEYS, (F.col("bucket") - F.col("lo")).cast("int").alias("i"), F.coalesce("n", F.lit(0)).alias("n"))


def series_stats(series: DataFrame) -> DataFrame:
    """Peak, its first bucket, the burst's onset and the largest rise as a share of all events."""
    order = Window.partitionBy(*KEYS).orderBy("i")
    s = series.withColumn("rise", F.col("n") - F.lag("n").over(order)).withColumn("peak", F.max("n").over(Window.partitionBy(*KEYS)))
    floor = F.greatest(F.lit(2), F.ceil(0.2 * F.col("peak")))
    g = s.groupBy(*KEYS).agg(F.sum("n").alias("events"), F.max("n").alias("peak"), F.min(F.when(F.col("n") == F.col("peak"), F.col("i"))).alias("peak_bucket"), F.coalesce(F.min(F.when(F.col("n") >= floor, F.col("i"))), F.lit(0)).alias("onset_bucket"), F.max("rise").alias("rise"))
    return g.withColumn("acceleration", F.round(F.coalesce("rise", F.lit(0)) / F.greatest(F.lit(1), F.col("events")), 6)).drop("rise")


def min_max(df: DataFrame, column: str, name: str, by: str = "run_id") -> DataFrame:
    """The column scaled to 0..1 in its group; 0 where all values are equal."""
    w = Window.partitionBy(by)
    lo, hi = F.min(column).over(w), F.max(column).over(w)
    return df.withColumn(name, F.when(hi > lo, (F.col(column) - lo) / (hi - lo)).otherwise(0.0))


def lag_correlation(series: DataFrame, most: int = 10, clusters: int | None = 15, least: float = 0.25) -> DataFrame:
    """Best lag (1..most) at which one cluster's counts lead another's, by Pearson's r; the busiest clusters of a run only.

    A lag needs three points; a constant side has r = 0.  Pairs are bounded by ``clusters`` squared a run (None: all).
    """
    busy = series.groupBy(*KEYS).agg(F.sum("n").alias("total"))
    order = Window.partitionBy("run_id").orderBy(F.desc("total"), "cluster_id")
    busy = busy.withColumn("k", F.row_number().over(order)).where(F.col("k") <= clusters).select(*KEYS) if clusters else None
    s = series.join(busy, KEYS) if clusters else series
    a = s.select("run_id", F.col("cluster_id").alias("a"), F.col("n").cast("double").alias("x"), "i", F.explode(F.sequence(F.lit(1), F.lit(most))).alias("lag"))
    a = a.select("run_id", "a", "x", "lag", (F.col("i") + F.col("lag")).alias("i"))
    b = s.select("run_id", F.col("cluster_id").alias("b"), F.col("n").cast("double").alias("y"), "i")
    g = a.join(b, ["run_id", "i"]).where("a <> b").groupBy("run_id", "a", "b", "lag").agg(
        F.count("*").alias("m"), F.sum("x").alias("sx"), F.sum("y").alias("sy"), F.sum(F.col("x") * F.col("x")).alias("sxx"), F.sum(F.col("y") * F.col("y")).alias("syy"), F.sum(F.col("x") * F.col("y")).alias("sxy")
    )
    vx, vy = F.col("m") * F.col("sxx") - F.col("sx") * F.col("sx"), F.col("m") * F.col("syy") - F.col("sy") * F.col("sy")
    g = g.where("m >= 3").withColumn("r", F.when((vx > 0) & (vy > 0), F.round((F.col("m") * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.sqrt(vx) * F.sqrt(vy)), 6)).otherwise(0.0))
    best = Window.partitionBy("run_id", "a", "b").orderBy(F.desc("r"), "lag")
    return g.withColumn("k", F.row_number().over(best)).where(F.col("k") == 1).where(F.col("r") >= least).select("run_id", "a", "b", "lag", "r")


def median_times(events: DataFrame) -> DataFrame:
    """(run_id, split): the exact median time of each run, from counts by minute and the order inside the middle ones."""
    e = events.where("us is not null").select("run_id", "us", F.expr(f"us div {60 * SECOND}").alias("minute"))
    minutes = e.groupBy("run_id", "minute").agg(F.count("*").alias("n"))
    run = Window.partitionBy("run_id")
    before = F.sum("n").over(run.orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    middle = minutes.select("run_id", "minute", "n", before.alias("before"), F.sum("n").over(run).alias("total")).withColumn("a", F.expr("(total - 1) div 2")).withColumn("b", F.expr("total div 2"))
    middle = middle.where("before <= b and a < before + n")
    at = F.row_number().over(Window.partitionBy("run_id", "minute").orderBy("us")) - 1 + F.col("before")
    inside = e.join(middle, ["run_id", "minute"]).withColumn("at", at).where("at = a or at = b")
    return inside.groupBy("run_id").agg(((F.min("us") + F.max("us")) / 2).alias("split"))


def change_score(events: DataFrame) -> DataFrame:
    """(after - before) / all events of each cluster around the exact median time of its run."""
    g = events.join(median_times(events), "run_id").groupBy(*KEYS).agg(F.count(F.when(F.col("us") < F.col("split"), 1)).alias("pre"), F.count(F.when(F.col("us") >= F.col("split"), 1)).alias("post"))
    return g.withColumn("change", F.round((F.col("post") - F.col("pre")) / (F.col("post") + F.col("pre")), 6))


def incident_links(windows: DataFrame, gap_seconds: int = 300, least: float = 0.45) -> DataFrame:
    """Edges from incidents to later ones that overlap or follow within the gap, scored by shared roots and services.

    windows: run_id, incident_id, start_us, end_us, root, services (array), n_4xx, n_5xx.  The join is keyed by run and
    by the time bucket in which the later incident starts.
    """
    width = max(3600, gap_seconds) * SECOND
    a = windows.select("run_id", *[F.col(x).alias(f"a_{x}") for x in ("incident_id", "start_us", "end_us", "root", "services", "n_5xx")])
    b = windows.select("run_id", *[F.col(x).alias(f"b_{x}") for x in ("incident_id", "start_us", "end_us", "root", "n_4xx")])
    later = "(b_start_us > a_start_us or b_start_us = a_start_us and b_incident_id > a_incident_id)"
    near = f"(b_start_us <= a_end_us and b_end_us >= a_start_us or (b_start_us - a_end_us) div {SECOND} between 0 and {gap_seconds})"
    a = a.withColumn("bucket", F.explode(F.expr(f"sequence(a_start_us div {width}, (a_end_us + {(gap_seconds + 1) * SECOND}) div {width})")))
    e = a.join(b.withColumn("bucket", F.expr(f"b_start_us div {width}")), ["run_id", "bucket"]).where(f"{later} and {near}")
    score = 0.35 + F.expr("if(array_contains(a_services, b_root), 0.35D, 0D) + if(a_root = b_root, 0.2D, 0D) + if(a_n_5xx > 0 and b_n_4xx > 0, 0.1D, 0D)")
    e = e.withColumn("score", score).where(F.col("score") >= least)
    kind = F.when(F.col("a_root") == F.col("b_root"), "continued_incident_phase").otherwise("downstream_incident")
    return e.select("run_id", F.col("a_incident_id").alias("source"), F.col("b_incident_id").alias("target"), kind.alias("relationship"), F.round(F.least(F.col("score"), F.lit(0.99)), 3).alias("confidence"), F.expr(f"(b_start_us - a_end_us) div {SECOND}").alias("gap_seconds"))


def behaviours(events: DataFrame) -> DataFrame:
    """The most frequent service, verb, resource and status class of each cluster."""
    kinds = ["service", "verb", "resource", "status_class"]
    return most_frequent(value_counts(events, kinds), kinds)


def patterns(events: DataFrame) -> DataFrame:
    """Clusters of a run grouped by behaviour: members, events, errors, span and coarse failure domain."""
    counts = events.groupBy(*KEYS).agg(F.count("*").alias("events"), F.count(F.when(P.failure("trigger"), 1)).alias("errors"), F.min("us").alias("first_us"), F.max("us").alias("last_us"))
    g = behaviours(events).join(counts, KEYS).groupBy("run_id", "service", "verb", "resource", "status_class").agg(F.count("*").alias("clusters"), F.sum("events").alias("events"), F.sum("errors").alias("errors"), F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"))
    domain = F.when(F.col("status_class") == "5xx", "service_failure").when(F.col("status_class") == "4xx", "authz").otherwise("other")
    return g.withColumn("domain", domain).withColumn("control_plane", F.coalesce(F.col("service").rlike("kube-|apiserver|etcd|controller"), F.lit(False)))


def domain_candidates(found: DataFrame) -> DataFrame:
    """Failure domains of each run ranked by events, errors and how early their patterns start (weight 1 / (1 + rank))."""
    order = Window.partitionBy("run_id").orderBy("first_us", "service", "verb", "resource", "status_class")
    p = found.withColumn("weight", 1 / F.row_number().over(order))
    g = p.where("domain <> 'other' or errors > 0").groupBy("run_id", "domain").agg(F.count("*").alias("patterns"), F.sum("events").alias("events"), F.sum("errors").alias("errors"), F.count_distinct("service").alias("actors"), F.round(F.sum(F.col("weight") * F.col("errors")), 6).alias("score"), F.min("first_us").alias("first_us"))
    rank = Window.partitionBy("run_id").orderBy(F.desc("score"), "first_us", "domain")
    return g.withColumn("rank", F.row_number().over(rank)).withColumn("valid_root", F.expr("errors > 0 and patterns > 0"))


def chain_roles(found: DataFrame, candidates: DataFrame) -> DataFrame:
    """Patterns of each run in time order as root, propagation, impact or context of the best domain."""
    top = candidates.where("rank = 1").select("run_id", F.col("domain").alias("root_domain"), F.col("first_us").alias("root_us"))
    order = Window.partitionBy("run_id").orderBy("first_us", "service", "verb", "resource", "status_class")
    role = F.when(F.col("domain") == F.col("root_domain"), "root").when((F.col("errors") > 0) & (F.col("first_us") <= F.col("root_us")), "propagation").when(F.col("errors") > 0, "impact").otherwise("context")
    return found.join(top, "run_id").withColumn("step", F.row_number().over(order)).select("run_id", "step", "service", "verb", "resource", "status_class", role.alias("role"))


def churn_penalties(events: DataFrame, text: str = "raw_text") -> DataFrame:
    g = events.groupBy(*KEYS).agg(F.round(F.avg(P.churn(text).cast("int")), 6).alias("churn"))
    return g.withColumn("penalty", S.churn_penalty("churn"))


def root_confidence(df: DataFrame) -> DataFrame:
    """Confidence with reasons.  df: trigger, errors, out_weight, in_weight, proximity, consistent, penalty."""
    influence = F.greatest(F.col("out_weight") - F.col("in_weight"), F.lit(0.0))
    steps = [
        (F.col("trigger") >= 3, 0.22, "strong trigger anomaly", F.col("trigger") >= 1.5, 0.12, "moderate trigger anomaly"),
        (F.col("errors") >= 100, 0.22, "large error burst", F.col("errors") >= 20, 0.12, "meaningful error burst"),
        (influence >= 5, 0.20, "strong downstream influence", influence >= 1, 0.10, "some downstream influence"),
        (F.col("proximity") >= 0.85, 0.18, "near the incident's onset", F.col("proximity") >= 0.5, 0.08, "reasonably early"),
        (F.col("consistent"), 0.12, "time order fits", ~F.col("consistent"), -0.10, "time order weakens it"),
        (F.col("penalty") >= 6, -0.16, "resembles expected churn", F.col("penalty") > 0, -0.08, "partly expected churn"),
    ]
    score = sum((F.when(a, x).when(b, y).otherwise(0.0) for a, x, _, b, y, _ in steps), F.lit(0.0))
    reasons = F.array_compact(F.array(*[F.when(a, s).when(b, t) for a, _, s, b, _, t in steps]))
    out = df.withColumn("confidence", F.round(S.clamp(score), 3)).withColumn("reasons", reasons)
    return out.withColumn("label", S.level("confidence", 0.75, 0.45))
