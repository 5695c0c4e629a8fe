"""The artifact validator: rows (step, name, passed, details) about the tables of a run, one step after another.

Every check is an aggregate over the tables that it names; a table that is missing fails its existence check, and the
checks of its content are left out.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import causal, reconcile

# The steps in order and the tables that each must leave.
STEPS = {
    "ingest": ("events",), "embed": ("events", "index", "vectors"), "cluster": ("clusters", "members"), "trigger_analysis": ("trigger_stats",), "incident_detection": ("status", "incidents"), "causal_analysis": ("profiles", "edges", "candidates", "roots"),
    "report": ("report",), "evidence_bundle": ("bundle",), "detailed_report": ("detailed",), "incident_assertions": ("assertions",), "timeline_or_diagnostics": ("timeline", "diagnostics"),
}
COMPARED = ("timestamp", "service", "severity", "actor", "verb", "resource", "response_code", "http_class", "status_family", "failure_hint", "path", "stage")


def _none_of(df: DataFrame, bad, what: str) -> tuple[DataFrame, str]:
    """An aggregate that passes when no row is bad."""
    return df.agg(F.count(F.when(bad, 1)).alias("n")).select((F.col("n") == 0).alias("passed"), F.concat(F.lit(f"{what}="), F.col("n").cast("string")).alias("details")), what


def _counted(df: DataFrame, passes: str, what: str) -> tuple[DataFrame, str]:
    return df.agg(F.count("*").alias("n")).select(F.expr(passes).alias("passed"), F.concat(F.lit(f"{what}="), F.col("n").cast("string")).alias("details")), what


def _absent(left: DataFrame, right: DataFrame, key: str, what: str) -> tuple[DataFrame, str]:
    return _counted(left.select(key).distinct().join(right.select(key), key, "left_anti"), "n = 0", what)


def _content(t: dict[str, DataFrame]) -> dict[str, list]:
    """The content checks that the tables at hand allow, by step."""
    has = lambda *names: all(n in t for n in names)
    out: dict[str, list] = {s: [] for s in STEPS}
    if has("events"):
        out["ingest"] += [_counted(t["events"], "n > 0", "events"), _none_of(t["events"], F.col("event_id").isNull(), "events without id"), _counted(t["events"].groupBy("event_id").count().where("count > 1"), "n = 0", "repeated event ids")]
    if has("raw_records", "events"):
        told = t["events"].select(F.get_json_object("structured_fields", "$.source_file").alias("source_file"), F.col("raw_text").alias("raw"))
        out["ingest"] += [_counted(t["raw_records"], "n > 0", "raw records"), _none_of(reconcile.compared(t["raw_records"], told), ~F.col("same"), "files whose events are not their records")]
    if has("events", "index"):
        out["embed"] += [_absent(t["events"], t["index"], "event_id", "events without index row"), _absent(t["index"], t["events"], "event_id", "index rows without event")]
        both = [c for c in COMPARED if c in t["events"].columns and c in t["index"].columns]
        right = t["index"].select("event_id", *[F.col(c).alias(f"r_{c}") for c in both])
        differ = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in both], F.lit(False))
        out["embed"].append(_none_of(t["events"].select("event_id", *both).join(right, "event_id"), differ, "rows whose fields differ"))
    if has("index", "vectors"):
        out["embed"].append(_absent(t["index"], t["vectors"], "event_id", "index rows without vector"))
    if has("members", "events"):
        out["cluster"].append(_absent(t["members"], t["events"], "event_id", "members that are no events"))
    if has("members", "clusters"):
        out["cluster"].append(_absent(t["members"], t["clusters"], "cluster_id", "members of no cluster"))
        size = t["members"].groupBy("cluster_id").agg(F.count("*").alias("held"))
        out["cluster"].append(_none_of(t["clusters"].join(size, "cluster_id", "left"), F.coalesce("held", F.lit(0)) != F.col("size"), "clusters whose size is not their members'"))
    if has("trigger_stats"):
        out["trigger_analysis"] += [_counted(t["trigger_stats"], "n > 0", "clusters"), _counted(t["trigger_stats"].where("is_candidate"), "true", "candidates")]
    if has("status"):
        out["incident_detection"].append(_none_of(t["status"], ~F.col("status").isin("incident_detected", "no_incident"), "unknown statuses"))
    if has("incidents"):
        out["incident_detection"] += [_counted(t["incidents"], "true", "incidents"), _none_of(t["incidents"], F.col("start_us") > F.col("end_us"), "incidents that end before they start")]
    if has("profiles", "edges"):
        out["causal_analysis"].append(_counted(causal.graph_violations(t["profiles"], t["edges"]), "n = 0", "graph violations"))
    if has("candidates", "profiles"):
        out["causal_analysis"].append(_counted(causal.candidate_violations(t["candidates"], t["profiles"]), "n = 0", "candidate violations"))
    if has("roots"):
        out["causal_analysis"].append(_counted(causal.root_violations(t["roots"]), "n = 0", "grounding events that are no failures"))
    if has("report", "candidates"):
        out["report"].append(_absent(t["candidates"].where("candidate_rank = 1"), t["report"], "run_id", "runs without report"))
    if has("bundle"):
        out["evidence_bundle"].append(_none_of(t["bundle"], ~F.col("coverage").between(0, 100), "coverages out of range"))
    if has("detailed", "report"):
        out["detailed_report"].append(_absent(t["report"], t["detailed"], "run_id", "reports without details"))
    if has("assertions"):
        out["incident_assertions"].append(_none_of(t["assertions"], ~F.col("status").isin("pass", "fail", "inconclusive"), "unknown results"))
    if has("timeline"):
        out["timeline_or_diagnostics"].append(_none_of(t["timeline"], F.col("failures") > F.col("total"), "buckets with more failures than events"))
    return out


def validate(spark: SparkSession, tables: dict[str, DataFrame], steps: tuple[str, ...] = tuple(STEPS), optional: tuple[str, ...] = ()) -> DataFrame:
    """(step, name, passed, details) for each check of the steps, in their order.

    optional: tables that may be missing.  With a table raw_records (logs.file_records), events are held against it.
    """
    content, rows = _content(tables), []
    last = {"timeline_or_diagnostics": any}  # one of the two tables is enough there
    for number, step in enumerate(STEPS, 1):
        if step not in steps:
            continue
        there = [name in tables for name in STEPS[step]]
        for name, found in zip(STEPS[step], there):
            passed = found or name in optional or (step in last and last[step](there))
            rows.append(spark.range(1).select(F.lit(number).alias("step"), F.lit(f"{name} exists").alias("name"), F.lit(passed).alias("passed"), F.lit("present" if found else "missing").alias("details")))
        rows += [df.select(F.lit(number).alias("step"), F.lit(what).alias("name"), "passed", "details") for df, what in content[step]]
    return reduce(DataFrame.unionByName, rows)
