"""Profiles of an incident's clusters, precedence edges between them, root candidates and their grounding events.

Scope is a run: the clusters of one run_id are compared with each other only.  The precedence join carries a time-bucket
key besides the run, so it stays a hash join on long runs.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scores as S
from ..storage import store
from .incidents import SECOND
from .trigger import KEYS, most_frequent, named, trigger_stats, value_counts

# The failure domains, in the order that breaks ties.
DOMAINS = ("rbac_authorization", "authentication", "resource_missing", "control_plane", "admission_controller", "scheduler", "node_kubelet", "networking", "storage")


# What votes for a domain, as (domain, kind, words, whole word or part, votes for each distinct value).
VOTES = (
    ("rbac_authorization", "actor", ("system:node",), False, 1),
    ("rbac_authorization", "resource", ("configmaps", "secrets"), True, 1),
    ("control_plane", "actor", ("kube-apiserver",), False, 2),
    ("admission_controller", "actor", ("gatekeeper",), False, 3),
    ("admission_controller", "resource", ("constrainttemplates", "assign", "assignmetadata"), True, 2),
    ("scheduler", "actor", ("kube-scheduler",), False, 3),
    ("scheduler", "resource", ("pods", "nodes"), True, 1),
    ("node_kubelet", "actor", ("system:node",), False, 2),
    ("storage", "resource", ("volume",), False, 2),
)
# What the dominant code adds, as (domain, lowest code, highest code, votes).
CODE_VOTES = (("rbac_authorization", 403, 403, 3), ("authentication", 401, 401, 3), ("resource_missing", 404, 404, 2), ("control_plane", 500, 599, 3))


def voted_kinds() -> dict:
    """What the votes are counted from, for value_counts."""
    return {"code": F.when(F.col("response_code") != 0, F.col("response_code")), "actor": F.col("actor"), "resource": F.col("resource")}


def failure_domain(events: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Votes of the dominant code and of distinct actors and resources for a failure domain; the first best wins."""
    counts = value_counts(events, voted_kinds()) if counts is None else counts
    kind, value = F.col("kind"), F.col("value")
    code = F.when(kind == "code", value.cast("int"))
    g = counts.groupBy(*KEYS).agg(
        F.max_by(code, F.when(kind == "code", F.struct("n", -F.col("first_at"), value.cast("int")))).alias("code"),
        F.when(F.count(F.when(kind == "resource", 1)) >= 3, 1).otherwise(0).alias("many"),
        *[(w * F.count(F.when((kind == k) & (value.isin(*words) if whole else value.contains(words[0])), 1))).alias(f"v{i}") for i, (_, k, words, whole, w) in enumerate(VOTES)],
    )
    score = {d: F.lit(0) for d in DOMAINS}
    score["rbac_authorization"] = F.col("many")
    for i, (d, *_) in enumerate(VOTES):
        score[d] = score[d] + F.col(f"v{i}")
    for d, low, high, w in CODE_VOTES:
        score[d] = score[d] + F.when(F.col("code") >= low if high == 599 else F.col("code") == low, w).otherwise(0)
    best = F.array_max(F.array(*[F.struct(x.cast("int").alias("score"), F.lit(-i).alias("order"), F.lit(d).alias("name")) for i, (d, x) in enumerate(score.items())]))
    return g.select(*KEYS, F.col("code").alias("dominant_code"), F.when(best["score"] > 0, best["name"]).otherwise("unknown").alias("failure_domain"), best["score"].alias("votes"))


def profiles(events: DataFrame) -> DataFrame:
    """One row a cluster with errors: first time, scores, dominant actor and resource (or the last part of a path), domain.

    Two passes over the events: the trigger statistics, and the counts that names and votes come from.
    """
    stats = trigger_stats(events).select(*KEYS, "first_us", "last_us", "trigger_score", "error_count", F.round("error_rate", 6).alias("error_rate"), "severity", F.least(F.lit(1.0), F.col("actors") / 3).alias("systemic_spread"))
    last = F.expr("try_element_at(filter(split(path, '/'), x -> x <> ''), -1)")
    kinds = {"main_actor": F.nullif(F.coalesce(named("actor"), F.col("service"), F.lit("unknown_actor")), F.lit("")), "main_resource": F.coalesce(named("resource"), last, F.lit("unknown_resource"))}
    counts = store(value_counts(events, voted_kinds() | kinds), "profile-counts")
    main = most_frequent(counts.where("kind like 'main%'"), list(kinds)).withColumnsRenamed({"main_actor": "actor", "main_resource": "resource"})
    domain = failure_domain(events, counts.where("kind not like 'main%'")).select(*KEYS, "failure_domain")
    # an event without code, actor and resource casts no vote; a cluster of such events has no known domain
    return stats.join(main, KEYS, "left").join(domain, KEYS, "left").na.fill("unknown", ["failure_domain"]).where("error_count > 0")


def causal_edges(nodes: DataFrame, gap_seconds: int = 30) -> DataFrame:
    """Edges from earlier to later clusters of a run within the gap; far ranks count only within five seconds.

    Ties in time are ordered by trigger score, largest first, then by name.
    """
    order = Window.partitionBy("run_id").orderBy("first_us", F.desc("trigger_score"), "cluster_id")
    width = gap_seconds * SECOND
    n = nodes.withColumn("rank", F.row_number().over(order) - 1).select("run_id", "cluster_id", "first_us", "rank", "actor", "resource", "failure_domain", F.expr(f"first_us div {width}").alias("bucket"))
    a = n.withColumn("bucket", F.explode(F.array(F.col("bucket"), F.col("bucket") + 1)))
    a, b = a.alias("a"), n.alias("b")
    near = (F.col("b.rank") > F.col("a.rank")) & (F.col("b.first_us") - F.col("a.first_us") <= width) & ((F.col("b.first_us") - F.col("a.first_us") <= 5 * SECOND) | (F.col("b.rank") <= F.col("a.rank") + 5))
    links = sum(F.coalesce((F.col(f"a.{x}") == F.col(f"b.{x}")).cast("int"), F.lit(0)) for x in ("actor", "resource", "failure_domain"))
    e = a.join(b, (F.col("a.run_id") == F.col("b.run_id")) & (F.col("a.bucket") == F.col("b.bucket")) & near)
    e = e.select(F.col("a.run_id").alias("run_id"), F.col("a.cluster_id").alias("source"), F.col("b.cluster_id").alias("target"), links.alias("semantic_links"), F.expr(f"(b.first_us - a.first_us) div {SECOND}").alias("lag_seconds"))
    return e.withColumn("score", S.edge_score("semantic_links"))


def fallback_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """A chain over the clusters of runs that have no edge."""
    order = Window.partitionBy("run_id").orderBy("first_us", F.desc("trigger_score"), "cluster_id")
    n = nodes.join(edges.select("run_id").distinct(), "run_id", "left_anti")
    n = n.withColumn("target", F.lead("cluster_id").over(order)).withColumn("next", F.lead("first_us").over(order)).where("target is not null")
    return n.select("run_id", F.col("cluster_id").alias("source"), "target", F.lit(0).alias("semantic_links"), F.expr(f"(next - first_us) div {SECOND}").alias("lag_seconds"), F.lit(0.6).cast("double").alias("score"))


def causal_graph(nodes: DataFrame, gap_seconds: int = 30) -> DataFrame:
    edges = causal_edges(nodes, gap_seconds)
    return edges.unionByName(fallback_edges(nodes, edges))


def root_candidates(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Clusters ranked as roots: early, strong, and leading rather than following."""
    out = edges.groupBy("run_id", F.col("source").alias("cluster_id")).agg(F.sum("score").alias("out_strength"), F.count("*").alias("out_degree"))
    into = edges.groupBy("run_id", F.col("target").alias("cluster_id")).agg(F.sum("score").alias("in_strength"), F.count("*").alias("in_degree"))
    run = Window.partitionBy("run_id")
    order = run.orderBy("first_us", F.desc("trigger_score"), "cluster_id")
    c = nodes.join(out, KEYS, "left").join(into, KEYS, "left").na.fill(0, ["out_strength", "in_strength", "out_degree", "in_degree"])
    c = c.withColumn("temporal_rank", F.row_number().over(order) - 1)
    share = lambda x: F.when(F.max(x).over(run) > 0, F.col(x) / F.max(x).over(run)).otherwise(0.0)
    c = c.withColumn("o", share("out_strength")).withColumn("i", share("in_strength"))
    c = c.withColumn("candidate_score", S.candidate_score("temporal_rank", "trigger_score", "o", "i"))
    c = c.withColumn("candidate_rank", F.row_number().over(run.orderBy(F.desc("candidate_score"), "temporal_rank")))
    return c.select(*KEYS, "candidate_score", "temporal_rank", "candidate_rank", "out_degree", "in_degree", F.round("out_strength", 6).alias("out_strength"), F.round("in_strength", 6).alias("in_strength"), "failure_domain", "actor", "resource", "first_us")


def grounded_events(events: DataFrame, k: int = 3) -> DataFrame:
    """The k earliest failures of each cluster; the first is the earliest, the others support it."""
    order = Window.partitionBy(*KEYS).orderBy(F.col("us").asc_nulls_last(), "event_id")
    e = events.where(P.failure("grounding")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    reason = F.when(F.col("rank") == 1, "earliest_failure").otherwise("supporting_failure")
    return e.select(*KEYS, "event_id", "us", "rank", "response_code", "status_family", "severity", "failure_hint", F.coalesce("service", "actor").alias("service"), "actor", "resource", "failure_mode", reason.alias("reason"))


def events_in_windows(events: DataFrame, windows: DataFrame, k: int = 3) -> DataFrame:
    """The k best HTTP failures of each window of a run by nearness to its start and code class."""
    e = events.where(P.failure("code")).join(windows.select("run_id", "incident_id", "start_us", "end_us"), "run_id").where("us between start_us and end_us")
    e = e.withColumn("score", F.round(S.grounding_score((F.col("us") - F.col("start_us")) / 1e6, "response_code"), 6))
    order = Window.partitionBy("run_id", "incident_id", "cluster_id").orderBy(F.desc("score"), "us", "event_id")
    return e.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("run_id", "incident_id", "cluster_id", "event_id", "us", "response_code", "score", "rank")


def report_confidence(candidates: DataFrame, roots: DataFrame) -> DataFrame:
    """Confidence of each run's best candidate from its score, lead, rank, graph support and events."""
    order = Window.partitionBy("run_id").orderBy("candidate_rank")
    support = roots.groupBy("run_id").agg(F.count("*").alias("events"))
    c = candidates.withColumn("second", F.lead("candidate_score").over(order)).where("candidate_rank = 1").join(support, "run_id", "left").na.fill(0, ["events"])
    c = c.withColumn("gap", F.round(F.greatest(F.lit(0.0), F.col("candidate_score") - F.coalesce("second", F.lit(0.0))), 6))
    c = c.withColumn("confidence", S.report_confidence("candidate_score", "gap", "temporal_rank", "out_degree", "in_degree", "events"))
    return c.select("run_id", "cluster_id", "candidate_score", "gap", "events", "confidence", S.level("confidence", 0.80, 0.55).alias("label"))


def chain_edges(candidates: DataFrame, edges: DataFrame, k: int = 5) -> DataFrame:
    """The first k edges that leave each run's best candidate: soonest, then strongest."""
    top = candidates.where("candidate_rank = 1").select("run_id", F.col("cluster_id").alias("source"))
    order = Window.partitionBy("run_id").orderBy("lag_seconds", F.desc("score"), "target")
    return edges.join(top, ["run_id", "source"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def graph_violations(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges that break a rule: loops, unknown clusters, scores outside 0..1, targets that start before their source."""
    ends = nodes.select("run_id", "cluster_id", "first_us")
    e = edges.join(ends.withColumnsRenamed({"cluster_id": "source", "first_us": "s_us"}), ["run_id", "source"], "left").join(ends.withColumnsRenamed({"cluster_id": "target", "first_us": "t_us"}), ["run_id", "target"], "left")
    rule = F.when(F.col("source") == F.col("target"), "self_loop").when(F.col("s_us").isNull() | F.col("t_us").isNull(), "unknown_cluster").when(~F.col("score").between(0, 1), "score_range").when(F.col("t_us") < F.col("s_us"), "backward")
    return e.withColumn("rule", rule).where("rule is not null").select("run_id", "source", "target", "rule")


def candidate_violations(candidates: DataFrame, nodes: DataFrame) -> DataFrame:
    top = candidates.where("candidate_rank = 1").join(nodes.select(*KEYS, "error_count"), KEYS, "left").where("coalesce(error_count, 0) = 0")
    return top.select("run_id", "cluster_id", F.lit("top_without_errors").alias("rule"))


def root_violations(roots: DataFrame, text: str | None = None) -> DataFrame:
    """Grounding events that are no failures."""
    r = roots if text else roots.withColumn("raw_text", F.lit(""))
    return r.where(~P.failure("grounding", text or "raw_text")).select("run_id", "cluster_id", "event_id", F.lit("not_a_failure").alias("rule"))


def reach(edges: DataFrame, depth: int = 4) -> DataFrame:
    """How many clusters each cluster leads to within ``depth`` steps (itself included when a path returns)."""
    step = edges.select("run_id", F.col("source").alias("cluster_id"), "target").distinct()
    seen = frontier = step
    hop = step.select("run_id", F.col("cluster_id").alias("target"), F.col("target").alias("next"))
    for _ in range(depth - 1):
        frontier = frontier.join(hop, ["run_id", "target"]).select("run_id", "cluster_id", F.col("next").alias("target")).distinct()
        seen = seen.unionByName(frontier).distinct()
    return seen.groupBy("run_id", "cluster_id").agg(F.count_distinct("target").alias("downstream"))
