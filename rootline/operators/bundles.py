"""Evidence of each run gathered in one row: symptoms, provenance, overall lift, bundle and detailed report."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scores as S
from .evidence import MINUTE, with_onset
from .trigger import count_if, present, top_values, value_counts

RUN = ["run_id"]


def symptoms(roots: DataFrame, k: int = 3) -> DataFrame:
    """(run_id, kind, value, n, rank): the k most frequent codes, actors and resources of a run's grounding events."""
    counts = value_counts(roots, ["response_code", "actor", "resource"], RUN)
    return top_values(counts, k, RUN).select("run_id", "kind", "value", "n", "rank")


def provenance(roots: DataFrame, claims: DataFrame) -> DataFrame:
    """One row a run of ``claims`` or with grounding events: where its root cause comes from, and how many of those events
    speak for it by code, by family or hint, and by naming a component or service.

    claims: run_id and evidence (whether the candidates of the run have any); a run without events is inferred.
    """
    named = present("component") | present("service") if "component" in roots.columns else present("service")
    g = roots.groupBy("run_id").agg(
        F.count("*").alias("observed_events"),
        count_if(P.http_failure()).alias("http_events"),
        count_if(P.family_failure() | P.hinted()).alias("multisignal_events"),
        count_if(named).alias("component_events"),
    )
    j = claims.groupBy("run_id").agg(F.bool_or("evidence").alias("evidence")).join(g, RUN, "full_outer")
    j = j.na.fill(0, ["observed_events", "http_events", "multisignal_events", "component_events"])
    source = F.when(F.col("observed_events") > 0, "logs_only").when(F.col("evidence"), "inferred_from_candidates").otherwise("inferred_only")
    return j.withColumn("root_cause_source", source).withColumn("external_context_used", F.lit(False)).drop("evidence")


def overall_lift(events: DataFrame, onset: DataFrame, minutes: int = 5) -> DataFrame:
    """Failures of each run in the minutes before and after its onset, whatever their mode: counts, rates and lift."""
    span = max(1, minutes) * MINUTE
    e = with_onset(events, onset).where(f"us >= t0 - {span} and us <= t0 + {span}")
    bad, before = P.failure("evidence"), F.col("us") < F.col("t0")
    g = e.groupBy("run_id").agg(count_if(before).alias("pre_events"), count_if(~before).alias("post_events"), count_if(bad & before).alias("pre_failures"), count_if(bad & ~before).alias("post_failures"))
    seconds = F.lit(float(max(1, minutes) * 60))
    return g.withColumn("pre_rate", F.round(S.rate("pre_failures", seconds), 6)).withColumn("post_rate", F.round(S.rate("post_failures", seconds), 6)).withColumn("lift", F.round(S.lift("pre_failures", "post_failures"), 6))


def window_lift(events: DataFrame, windows: DataFrame) -> DataFrame:
    """Failures by mode inside each incident window and in the stretch of equal length before it, over the modes of both."""
    w = windows.select("run_id", "incident_id", "start_us", "end_us")
    e = events.where(P.failure("evidence")).join(w, "run_id").where("us between 2 * start_us - end_us and end_us")
    g = e.groupBy("run_id", "incident_id", "failure_mode").agg(F.count(F.expr("if(us < start_us, 1, null)")).alias("pre_count"), F.count(F.expr("if(us >= start_us, 1, null)")).alias("in_count"))
    return g.withColumn("lift", F.round(S.lift("pre_count", "in_count"), 6))


def bundle(candidates: DataFrame, roots: DataFrame, onset: DataFrame, impacts: DataFrame, lift: DataFrame, dependencies: DataFrame, assertions: DataFrame) -> DataFrame:
    """One row a run: its claim, the events behind it, impact, lift, dependencies, assertions, and the claim's coverage.

    Coverage is the share of the five kinds of evidence (events, onset, impact, lift, assertions) that the run has.
    """
    claim = candidates.where("candidate_rank = 1").select("run_id", F.struct("cluster_id", "candidate_score", "failure_domain", "actor", "resource").alias("claim"))
    seen = roots.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("us", "event_id", "cluster_id", "response_code", "failure_mode", "reason"))).alias("events"))
    called = dependencies.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("impact", "source", "target", "n"))).alias("dependencies"))
    tested = assertions.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("assertion", "status"))).alias("assertions"))
    one = lambda df, name: df.select("run_id", F.struct(*[c for c in df.columns if c != "run_id"]).alias(name))
    out = claim
    for part in (seen, one(onset, "onset"), one(impacts, "impact"), one(lift, "lift"), called, tested):
        out = out.join(part, "run_id", "left")
    kinds = ("events", "onset", "impact", "lift", "assertions")
    return out.withColumn("coverage", F.round(sum(F.col(k).isNotNull().cast("int") for k in kinds) * 100.0 / len(kinds), 2))


def detailed_report(report: DataFrame, bundles: DataFrame, incidents: DataFrame) -> DataFrame:
    """The report of each run with its bundle and incidents, and a confidence merged from report and detection."""
    found = incidents.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("start_us", "incident_id", "incident_class", "declaration", "confidence"))).alias("incidents"), F.max("confidence").alias("detection"))
    j = report.join(bundles.select("run_id", F.col("events").alias("evidence"), "impact", "lift", "dependencies", "assertions", "coverage"), "run_id", "left").join(found, "run_id", "left")
    return j.withColumn("merged_confidence", S.merged_confidence(F.coalesce("confidence", F.lit(0.0)), F.coalesce("detection", F.lit(0.0))))
