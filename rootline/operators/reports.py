"""Patterns, blast radius, explanations, and the report of each run as one row; Markdown from at most k collected rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions import text as X

# Actions by pattern.
ACTIONS = {
    "authorization_failure": "Review role bindings of the affected actors.",
    "authentication_failure": "Check credentials and token expiry.",
    "resource_missing_or_unavailable": "Check that the resource exists and its controller runs.",
    "server_or_control_plane_failure": "Look at the failing service's logs and saturation.",
    "client_or_api_failure": "Check the callers' requests.",
    "component_specific_failure": "Look at the named component first.",
}


def failure_pattern(roots: DataFrame) -> DataFrame:
    """The failure pattern of each run's grounding events, the first event deciding before the rest."""
    r = roots.withColumn("component", X.component(F.coalesce("service", "actor"), F.lit("")))
    first = F.struct("us", "event_id")
    g = r.groupBy("run_id").agg(
        F.min_by("response_code", first).alias("primary_code"),
        F.min_by("actor", first).alias("primary_actor"),
        F.min_by("component", first).alias("component"),
        F.min_by("failure_mode", first).alias("mode"),
        F.count_distinct("actor").alias("actors"),
        F.count_distinct("resource").alias("resources"),
        F.count_distinct("service").alias("services"),
        F.count("*").alias("events"),
    )
    code, mode = F.col("primary_code"), F.col("mode")
    pattern = (
        F.when((code == 403) & F.col("primary_actor").startswith("system:") & ((F.col("resources") >= 2) | (F.col("actors") >= 2)), "cluster_wide_authorization_failure")
        .when(F.col("component") != "unknown_component", "component_specific_failure")
        .when(code == 403, "authorization_failure")
        .when(code == 401, "authentication_failure")
        .when(code == 404, "resource_missing_or_unavailable")
        .when(code >= 500, "server_or_control_plane_failure")
        .when(code >= 400, "client_or_api_failure")
        .when(mode == "authz_failure", "authorization_failure")
        .when(mode == "resource_not_found", "resource_missing_or_unavailable")
        .when(mode.isin("service_failure", "dependency_failure"), "server_or_control_plane_failure")
        .otherwise("unknown")
    )
    return g.withColumn("pattern", pattern)


def blast_radius(patterns: DataFrame, spans: DataFrame) -> DataFrame:
    """Scope, severity and depth of each run's failure.  spans: run_id, clusters, duration (seconds)."""
    p = patterns.join(spans, "run_id")
    scope = F.when(F.col("clusters") >= 20, "cluster-wide").when(F.col("clusters") >= 5, "multi-component").otherwise("localized")
    heavy = F.col("pattern").isin("cluster_wide_authorization_failure", "server_or_control_plane_failure")
    severity = F.when(heavy | (F.col("duration") >= 120), "high").when(F.col("duration") >= 30, "medium").otherwise("low")
    depth = F.least(F.lit(5), F.greatest(F.lit(1), F.floor(F.col("clusters") / 5).cast("int")))
    return p.select("run_id", "pattern", scope.alias("scope"), severity.alias("severity"), depth.alias("depth"), "actors", "resources", "clusters", "duration")


def complexity(edges):
    e = S.c(edges)
    return F.when(e >= 80, "high").when(e >= 25, "medium").otherwise("low")


def root_cause_report(candidates: DataFrame, roots: DataFrame, patterns: DataFrame, confidence: DataFrame, edges: DataFrame, k: int = 5) -> DataFrame:
    """One row a run: best candidate, pattern, confidence, first events, top candidates, complexity and a sentence."""
    top = candidates.where(F.col("candidate_rank") <= k)
    listed = top.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("candidate_rank", "cluster_id", "candidate_score"))).alias("candidates"))
    best = candidates.where("candidate_rank = 1").select("run_id", "cluster_id", "failure_domain", "actor", "resource")
    seen = roots.join(best.select("run_id", "cluster_id"), ["run_id", "cluster_id"]).groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("rank", "event_id", "response_code", "service", "resource"))).alias("events"))
    linked = edges.groupBy("run_id").agg(F.count("*").alias("edges"))
    action = F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair])
    j = best.join(listed, "run_id").join(seen, "run_id", "left").join(patterns.select("run_id", "pattern", "primary_code"), "run_id", "left").join(confidence.select("run_id", "confidence", "label"), "run_id", "left").join(linked, "run_id", "left")
    told = F.format_string("%s: %s on %s, confidence %s", F.coalesce("pattern", F.lit("unknown")), F.col("actor"), F.col("resource"), F.coalesce("label", F.lit("low")))
    return j.withColumn("complexity", complexity(F.coalesce("edges", F.lit(0)))).withColumn("action", F.coalesce(F.try_element_at(action, F.col("pattern")), F.lit("Inspect the grounding events."))).withColumn("summary", told)


def markdown(report: DataFrame, k: int = 20) -> str:
    """The first k runs of a report as Markdown."""
    out = ["# Root causes", ""]
    for r in report.orderBy("run_id").limit(k).collect():
        out += [f"## {r['run_id']}", "", r["summary"], "", f"- Root cluster: {r['cluster_id']} ({r['failure_domain']})", f"- Complexity: {r['complexity']}", f"- Action: {r['action']}"]
        out += [f"- {c['candidate_rank']}. {c['cluster_id']}: {c['candidate_score']:.6f}" for c in r["candidates"]] + [""]
    return "\n".join(out)
