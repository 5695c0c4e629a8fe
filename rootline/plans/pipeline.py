"""The whole analysis from events to report: tables that others read are stored, the rest stay lazy."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import causal, evidence, incidents, quality, reports, trigger
from ..storage import store


def run_all(events: DataFrame, gap_seconds: int = 30, **options) -> dict[str, DataFrame]:
    """Every table of a run by name.  events: canonical events with run_id, us, cluster_id, target and failure_mode.

    options go to incident detection.  Statistics, incidents, graph, candidates and grounding events are stored in the
    shared folder, as most other tables read them; those are small (a row a cluster, incident or edge).
    """
    stats = store(trigger.trigger_stats(events), "trigger-stats")
    found = store(incidents.incidents(events, **options), "incidents")
    nodes = store(causal.profiles(events), "nodes")
    edges = store(causal.causal_graph(nodes, gap_seconds), "edges")
    candidates = store(causal.root_candidates(nodes, edges), "candidates")
    roots = store(causal.grounded_events(events).join(candidates.where("candidate_rank <= 5").select("run_id", "cluster_id"), ["run_id", "cluster_id"], "left_semi"), "roots")
    onset = store(evidence.anomaly_onset(roots), "onset")
    confidence = store(causal.report_confidence(candidates, roots), "confidence")
    patterns = store(reports.failure_pattern(roots), "patterns")
    spans = stats.groupBy("run_id").agg(F.count("*").alias("clusters"), F.expr("(max(last_us) - min(first_us)) div 1000000").alias("duration"))
    violations = {"graph": causal.graph_violations(nodes, edges), "candidates": causal.candidate_violations(candidates, nodes), "roots": causal.root_violations(roots)}
    return {
        "trigger_stats": stats,
        "incidents": found,
        "status": incidents.detection_status(found, incidents.cluster_windows(stats)),
        "profiles": nodes,
        "edges": edges,
        "candidates": candidates,
        "roots": roots,
        "onset": onset,
        "impacts": evidence.post_impacts(events, onset),
        "breakdown": evidence.impact_breakdown(events, onset),
        "dependencies": evidence.dependency_edges(events, onset),
        "lift": evidence.failure_lift(events, onset),
        "timeline": evidence.timeline(events),
        "patterns": patterns,
        "blast_radius": reports.blast_radius(patterns, spans),
        "confidence": confidence,
        "report": reports.root_cause_report(candidates, roots, patterns, confidence, edges),
        "assertions": evidence.assertions(candidates, roots, found),
        "diagnostics": quality.diagnostics(events),
        "checks": quality.checks(violations),
    }
