"""Cluster windows, episodes and incidents.

Windows merge by a left-to-right fold over a run's windows.  The fold runs inside the JVM as an aggregate over the
run's sorted array of windows, whose length is the run's number of candidate clusters, never its events.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores as S
from ..storage import store
from .trigger import KEYS, suppression_hints, top_values, transitions, trigger_stats, value_counts

SECOND = 1_000_000


def cluster_windows(stats: DataFrame, cap_seconds: int = 900) -> DataFrame:
    """Windows of candidate clusters, cut at ``cap_seconds`` after their start."""
    w = stats.where("is_candidate and first_us is not null and last_us is not null")
    end = F.least("last_us", F.col("first_us") + cap_seconds * SECOND) if cap_seconds > 0 else F.col("last_us")
    return w.select(*KEYS, F.col("first_us").alias("start_us"), end.alias("end_us"), "trigger_score", "incident_strength", "error_count", "event_count")


def gap_sessions(events: DataFrame, gap_seconds: int = 120, seconds: int = 3600) -> DataFrame:
    """Sessions of a run: an event at most the gap after the one before joins it; a null time joins the last session.

    Sessions are found inside time buckets and stitched at their borders, where a bucket is one row: no task orders the
    events of a whole run.
    """
    order = Window.partitionBy("run_id", "bucket").orderBy("us", "event_id")
    width, gap = seconds * SECOND, gap_seconds * SECOND
    timed = events.where("us is not null").select("run_id", "us", "event_id", "cluster_id", F.expr(f"us div {width}").alias("bucket"))
    new = F.when(F.col("us") - F.lag("us").over(order) <= gap, 0).otherwise(1)
    local = timed.withColumn("new", new).withColumn("local", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    local = store(local.groupBy("run_id", "bucket", "local", "cluster_id").agg(F.min("us").alias("start_us"), F.max("us").alias("end_us"), F.count("*").alias("events")), "sessions")
    buckets = local.groupBy("run_id", "bucket").agg(F.max("local").alias("found"), F.min("start_us").alias("lo"), F.max("end_us").alias("hi"))
    run = Window.partitionBy("run_id").orderBy("bucket")
    joins = F.when(F.col("lo") - F.lag("hi").over(run) <= gap, 1).otherwise(0)
    buckets = buckets.withColumn("joins", joins).withColumn("reached", F.sum(F.col("found") - F.col("joins")).over(run.rowsBetween(Window.unboundedPreceding, 0)))
    numbered = local.join(buckets.select("run_id", "bucket", (F.col("reached") - F.col("found")).alias("before")), ["run_id", "bucket"])
    parts = numbered.select("run_id", (F.col("before") + F.col("local")).alias("session"), "cluster_id", "start_us", "end_us", "events")
    last = buckets.groupBy("run_id").agg(F.max("reached").alias("session"))
    none = F.lit(None).cast("bigint")
    rest = events.where("us is null").groupBy("run_id", "cluster_id").agg(F.count("*").alias("events")).join(last, "run_id", "left")
    parts = parts.unionByName(rest.select("run_id", F.coalesce("session", F.lit(0)).alias("session"), "cluster_id", none.alias("start_us"), none.alias("end_us"), "events"))
    return parts.groupBy("run_id", "session").agg(F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.sum("events").alias("events"), F.count_distinct("cluster_id").alias("clusters"))


def chained_windows(windows: DataFrame, gap_seconds: int = 30) -> DataFrame:
    """First pass of the older detector: a window joins if it starts within the gap after the last window's end."""
    order = Window.partitionBy("run_id").orderBy("start_us", "end_us", "cluster_id")
    new = F.when(F.col("start_us") <= F.lag("end_us").over(order) + gap_seconds * SECOND, 0).otherwise(1)
    return windows.withColumn("new", new).withColumn("chain", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("new")


def _folded(windows: DataFrame, keys: list[str], step: str, name: str) -> DataFrame:
    """Numbers windows by a fold.  step: SQL condition on acc (first, last, reach: microseconds) and x that lets x join."""
    fold = f"""aggregate(w, cast(struct(0 as k, 0L as first, 0L as last, 0L as reach, array() as ids) as struct<k:int,first:bigint,last:bigint,reach:bigint,ids:array<int>>),
      (acc, x) -> if(acc.k > 0 and {step},
        struct(acc.k as k, acc.first as first, x.end_us as last, greatest(acc.reach, x.end_us) as reach, array_append(acc.ids, acc.k) as ids),
        struct(acc.k + 1 as k, x.start_us as first, x.end_us as last, x.end_us as reach, array_append(acc.ids, acc.k + 1) as ids)), acc -> acc.ids)"""
    rest = [x for x in windows.columns if x not in keys]
    sort = ["start_us", "end_us", "cluster_id", *[x for x in rest if x not in ("start_us", "end_us", "cluster_id")]]
    groups = windows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*sort))).alias("w"))
    return groups.select(*keys, F.explode(F.arrays_zip("w", F.expr(fold).alias("k"))).alias("z")).select(*keys, F.col("z.w.*"), F.col("z.k").alias(name))


def split_chains(chained: DataFrame, gap_seconds: int = 30, max_seconds: int = 14_400) -> DataFrame:
    """Second pass of the older detector: chains are split where they break off or would last too long."""
    join = f"x.start_us <= acc.reach + {gap_seconds * SECOND}L and (greatest(acc.reach, x.end_us) - acc.first) div {SECOND} <= {max_seconds}"
    return _folded(chained, ["run_id", "chain"], join, "part")


def episodes(windows: DataFrame, gap_seconds: int = 120, max_seconds: int = 1200) -> DataFrame:
    """A window joins an episode if it starts within the gap after the last window's end and the span stays in bounds."""
    bound = f" and (greatest(acc.last, x.end_us) - acc.first) div {SECOND} <= {max_seconds}" if max_seconds > 0 else ""
    return _folded(windows, ["run_id"], f"x.start_us <= acc.last + {max(1, gap_seconds) * SECOND}L{bound}", "episode")


def cluster_sets(events: DataFrame) -> DataFrame:
    """Failure modes, dependency targets and actor or resource tokens of each cluster, as arrays; one pass."""
    top = top_values(value_counts(events, ["failure_mode", "target", "actor", "resource"]), 5)
    kind = F.col("kind")
    some = lambda k, x, name: F.collect_set(F.when(kind.isin(*k), x)).alias(name)
    token = F.concat(kind, F.lit(":"), "value")
    return top.groupBy(*KEYS).agg(some(["failure_mode"], F.col("value"), "modes"), some(["target"], F.col("value"), "targets"), some(["actor", "resource"], token, "tokens"))


def episode_signatures(events: DataFrame, gap_seconds: int = 120, max_seconds: int = 1200) -> DataFrame:
    """One row an episode: span, number of windows, summed strength and the unions of its clusters' sets."""
    e = episodes(cluster_windows(trigger_stats(events)), gap_seconds, max_seconds).join(cluster_sets(events), KEYS, "left")
    union = lambda x: F.array_sort(F.array_distinct(F.flatten(F.collect_list(x)))).alias(x)
    return e.groupBy("run_id", "episode").agg(
        F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.count("*").alias("windows"), F.round(F.sum("incident_strength"), 6).alias("strength"), union("modes"), union("targets"), union("tokens")
    )


def incident_class(modes, tokens, targets):
    """Keyword rules over the joined names, in order."""
    m, t = F.lower(F.concat_ws(" ", modes)), F.lower(F.concat_ws(" ", tokens))
    return (
        F.when(m.rlike("auth|token|cert|forbidden|permission"), "security_access")
        .when(m.rlike("oom|evict|disk|memory|resource|pressure|quota"), "capacity_resource")
        .when(m.rlike("timeout|latency|throttl|queue"), "performance_latency")
        .when(F.size(targets) > 0, "dependency_propagation")
        .when(m.rlike("service_failure|connection|refused|unavailable|5xx"), "availability_outage")
        .when(t.contains("resource:"), "correctness_data")
        .otherwise("unknown_technical")
    )


def merged_episodes(signatures: DataFrame, gap_seconds: int = 30, max_seconds: int = 14_400, similar: float = 0.3) -> DataFrame:
    """Episodes numbered by incident: near in time, short enough together, alike in sets, and of like strength."""
    kind = "struct<k:int,first:bigint,last:bigint,reach:bigint,score:double,modes:array<string>,targets:array<string>,tokens:array<string>,ids:array<int>>"
    jaccard = lambda x: f"if(size(array_union(acc.{x}, e.{x})) = 0, 1D, size(array_intersect(acc.{x}, e.{x})) / size(array_union(acc.{x}, e.{x})))"
    bound = f"and (greatest(acc.reach, e.end_us) - acc.first) div {SECOND} <= {max_seconds}" if max_seconds > 0 else ""
    step = f"""acc.k > 0 and e.start_us <= acc.last + {max(1, gap_seconds) * SECOND}L {bound}
      and (greatest({jaccard('modes')}, {jaccard('tokens')}) >= {similar} or {jaccard('targets')} >= 0.2)
      and greatest(acc.score, e.strength, 1e-9D) / greatest(least(greatest(acc.score, 1e-9D), greatest(e.strength, 1e-9D)), 1e-9D) <= 8"""
    fold = f"""aggregate(s, cast(struct(0 as k, 0L as first, 0L as last, 0L as reach, 0D as score, array() as modes, array() as targets, array() as tokens, array() as ids) as {kind}),
      (acc, e) -> if({step},
        cast(struct(acc.k as k, acc.first as first, e.end_us as last, greatest(acc.reach, e.end_us) as reach, acc.score + e.strength as score, array_union(acc.modes, e.modes) as modes, array_union(acc.targets, e.targets) as targets, array_union(acc.tokens, e.tokens) as tokens, array_append(acc.ids, acc.k) as ids) as {kind}),
        cast(struct(acc.k + 1 as k, e.start_us as first, e.end_us as last, e.end_us as reach, e.strength as score, e.modes as modes, e.targets as targets, e.tokens as tokens, array_append(acc.ids, acc.k + 1) as ids) as {kind})), acc -> acc.ids)"""
    groups = signatures.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("episode", "start_us", "end_us", "strength", "modes", "targets", "tokens"))).alias("s"))
    return groups.select("run_id", F.explode(F.arrays_zip("s", F.expr(fold).alias("k"))).alias("z")).select("run_id", F.col("z.s.*"), F.col("z.k").alias("incident"))


def incidents(events: DataFrame, gap_seconds: int = 30, max_seeds: int = 3, cap_seconds: int = 900, episode_gap: int = 120, episode_max: int = 1200, max_seconds: int = 14_400, similar: float = 0.3) -> DataFrame:
    """Incidents of each run with class, declaration, confidence and seed clusters; suppressed ones are left out.

    Numbers are given before suppression, so they may have gaps.
    """
    stats, sets = store(trigger_stats(events), "trigger-stats"), store(cluster_sets(events), "cluster-sets")
    windows = episodes(cluster_windows(stats, cap_seconds), episode_gap, episode_max)
    union = lambda x: F.array_sort(F.array_distinct(F.flatten(F.collect_list(x)))).alias(x)
    members = store(windows.join(sets, KEYS, "left"), "episode-members")
    signatures = members.groupBy("run_id", "episode").agg(F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.sum("incident_strength").alias("strength"), union("modes"), union("targets"), union("tokens"))
    numbered = merged_episodes(signatures, gap_seconds, max_seconds, similar).select("run_id", "episode", "incident")
    extra = stats.select(*KEYS, "coverage", "services")
    hints = suppression_hints(events).select(*KEYS, F.col("ratio").alias("suppression"))
    turns = transitions(events).select(*KEYS, "recovery_strength")
    flat = members.join(numbered, ["run_id", "episode"]).join(extra, KEYS).join(hints, KEYS).join(turns, KEYS)
    g = flat.groupBy("run_id", "incident").agg(
        F.min("start_us").alias("start_us"),
        F.max("end_us").alias("end_us"),
        F.count_distinct("episode").alias("episodes"),
        F.count("*").alias("clusters"),
        F.sum("incident_strength").alias("strength"),
        F.sum("error_count").alias("errors"),
        F.sum("event_count").alias("events"),
        F.avg("coverage").alias("coverage"),
        F.avg("suppression").alias("suppression"),
        F.avg("recovery_strength").alias("recovery"),
        F.avg("services").alias("service_spread"),
        union("modes"),
        union("targets"),
        union("tokens"),
        F.array_sort(F.collect_list(F.struct((-F.col("incident_strength")).alias("minus"), "start_us", "cluster_id"))).alias("ranked"),
    )
    g = g.withColumn("duration", F.expr(f"cast((end_us - start_us) div {SECOND} as bigint)")).withColumn("error_ratio", F.col("errors") / F.greatest(F.lit(1), "events")).withColumn("score_norm", F.least(F.lit(1.0), F.col("strength") / F.col("clusters")))
    coherence = F.greatest(F.least(F.lit(1.0), F.size("modes") / 4), F.least(F.lit(1.0), F.size("targets") / 3), F.least(F.lit(1.0), F.size("tokens") / 6))
    g = g.withColumn("confidence", S.policy_confidence("score_norm", "duration", "coverage", "error_ratio", coherence, "recovery")).withColumn("level", S.level("confidence", 0.65, 0.45))
    firm = F.expr("(error_ratio >= 0.08 and duration >= 180 and clusters >= 2 and score_norm >= 0.20) or (error_ratio >= 0.15 and duration >= 90 and score_norm >= 0.18)")
    declared = F.when((F.col("suppression") >= 0.4) & (F.col("error_ratio") < 0.25), "suppressed").when((F.col("duration") < 120) | (F.col("errors") < 12) | ~firm | (F.col("level") == "low"), "possible_incident").otherwise("incident")
    g = g.withColumn("declaration", declared).where("declaration <> 'suppressed'")
    return g.select(
        "run_id",
        F.concat(F.lit("I"), F.col("incident").cast("string")).alias("incident_id"),
        "start_us",
        "end_us",
        "duration",
        "episodes",
        "clusters",
        incident_class(F.col("modes"), F.col("tokens"), F.col("targets")).alias("incident_class"),
        "declaration",
        "confidence",
        "level",
        F.round("error_ratio", 6).alias("error_ratio"),
        F.round("coverage", 6).alias("coverage"),
        F.round("suppression", 6).alias("suppression"),
        F.round("recovery", 6).alias("recovery"),
        F.round("service_spread", 6).alias("service_spread"),
        F.expr("transform(ranked, x -> x.cluster_id)").alias("trigger_clusters"),
        F.expr(f"transform(slice(ranked, 1, {max(1, max_seeds)}), x -> struct(x.cluster_id as cluster_id, round(-x.minus, 6) as trigger_score))").alias("seed_clusters"),
    )


def detection_status(found: DataFrame, windows: DataFrame) -> DataFrame:
    """One row a run that has candidate clusters: status, reason and counts."""
    n = found.groupBy("run_id").agg(F.count("*").alias("incidents"), F.count(F.when(F.col("declaration") == "possible_incident", 1)).alias("possible"))
    w = windows.groupBy("run_id").agg(F.count("*").alias("candidates"))
    s = w.join(n, "run_id", "left").na.fill(0, ["incidents", "possible"])
    reason = F.when(F.col("incidents") == 0, "all_candidates_suppressed").when(F.col("possible") == F.col("incidents"), "possible_incidents_only").otherwise("trigger_episodes_found")
    return s.withColumn("status", F.when(F.col("incidents") > 0, "incident_detected").otherwise("no_incident")).withColumn("reason", reason)


def retry_loops(events: DataFrame, keys: tuple = ("run_id", "service"), text: str = "raw_text", min_events: int = 3, max_seconds: int = 900, min_errors: int = 2, min_hits: int = 2) -> DataFrame:
    """Groups of few, close, failing and retrying events: one row each."""
    # Words of retries.
    hit = F.lower(text).rlike("retry|retrying|backoff|reconnect|attempt|timeout|refused")
    g = events.groupBy(*keys).agg(
        F.count("*").alias("events"), F.min("us").alias("start_us"), F.max("us").alias("end_us"), F.count(F.when(F.col("severity") == "ERROR", 1)).alias("errors"), F.count(F.when(F.col("severity") == "WARN", 1)).alias("warnings"),
        F.count(F.when(F.col("status_class") == "5xx", 1)).alias("n_5xx"), F.count(F.when(hit, 1)).alias("retry_hits"), F.count_distinct("cluster_id").alias("clusters"),
    )
    return g.where(f"events >= {min_events} and end_us - start_us <= {max_seconds * SECOND} and (errors >= {min_errors} or warnings >= 3 or n_5xx >= 1) and retry_hits >= {min_hits}")


def bucket_scores(events: DataFrame, stats: DataFrame, seconds: int = 10, signal: float = 0.1) -> DataFrame:
    """The anomaly score of each active time bucket of a run: the largest trigger score of its clusters, times up to 3 errors."""
    start = events.groupBy("run_id").agg(F.min("us").alias("t0"))
    b = events.join(start, "run_id").select(*KEYS, F.expr(f"(us - t0) div {seconds * SECOND}").alias("bucket")).distinct()
    s = b.join(stats.select(*KEYS, "trigger_score", "error_count"), KEYS)
    score = F.when(F.col("trigger_score") >= signal, F.col("trigger_score") * F.least(F.lit(3), F.col("error_count"))).otherwise(0.0)
    return s.groupBy("run_id", "bucket").agg(F.round(F.max(score), 6).alias("score"))


def bucket_waves(scores: DataFrame, threshold: float = 0.5, cooldown: int = 6, weak: bool = True) -> DataFrame:
    """Waves of anomalous buckets with hysteresis: a strong rise opens, half the threshold holds, a cooldown closes.

    The fold goes over a run's active buckets, sorted, inside one aggregate.
    """
    kind = "struct<open:boolean,first:bigint,last:bigint,below:int,prev:bigint,prev_score:double,waves:array<struct<first:bigint,last:bigint>>>"
    half = threshold / 2 if weak else threshold
    fold = f"""aggregate(s, cast(struct(false as open, 0L as first, 0L as last, 0 as below, -9L as prev, 0D as prev_score, array() as waves) as {kind}), (a, x) ->
      case when x.score >= {threshold} and x.score - if(a.prev = x.bucket - 1, a.prev_score, 0D) >= 0.05
             then cast(struct(true as open, if(a.open, a.first, x.bucket) as first, x.bucket as last, 0 as below, x.bucket as prev, x.score as prev_score, a.waves as waves) as {kind})
           when a.open and x.score >= {half} then cast(struct(true as open, a.first as first, x.bucket as last, 0 as below, x.bucket as prev, x.score as prev_score, a.waves as waves) as {kind})
           when a.open and a.below + 1 >= {cooldown} and a.last < x.bucket - {cooldown} then cast(struct(false as open, 0L as first, 0L as last, 0 as below, x.bucket as prev, x.score as prev_score, array_append(a.waves, struct(a.first as first, a.last as last)) as waves) as {kind})
           when a.open and a.below + 1 >= {cooldown} then cast(struct(true as open, a.first as first, a.last as last, 0 as below, x.bucket as prev, x.score as prev_score, a.waves as waves) as {kind})
           else cast(struct(a.open as open, a.first as first, a.last as last, if(a.open, a.below + 1, 0) as below, x.bucket as prev, x.score as prev_score, a.waves as waves) as {kind}) end,
      a -> if(a.open, array_append(a.waves, struct(a.first as first, a.last as last)), a.waves))"""
    runs = scores.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("bucket", "score"))).alias("s"))
    return runs.select("run_id", F.posexplode(F.expr(fold)).alias("wave", "w")).select("run_id", "wave", F.col("w.first").alias("first_bucket"), F.col("w.last").alias("last_bucket"))
