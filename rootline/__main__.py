"""Command line: python -m rootline STEP --outputs-root ROOT [options]; each step reads the tables it needs below ROOT."""

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as X
from .operators import bundles, causal, clusters, density, evidence, incidents, quality, reports, textvec, triage, trigger, validate, vectors
from .plans import layout
from .sources import artifacts, logs
from .sources.events import micros
from .storage import store

STEPS = ("ingest", "triage", "embed", "cluster", "trigger_analysis", "incident_detection", "causal_analysis", "report", "evidence_bundle", "detailed_report", "incident_assertions", "preincident_diagnostics", "timeline", "validate", "all")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="rootline")
    p.add_argument("step", choices=STEPS)
    p.add_argument("--outputs-root", required=True)
    p.add_argument("--pipeline-profile", choices=("v1", "v2"), default="v2")
    p.add_argument("--clean", action="store_true", help="replace tables that lie there")
    p.add_argument("--logfile", nargs="*", default=[])
    p.add_argument("--logfile-list", help="a text file that names one log file a line")
    p.add_argument("--triage", action="store_true", help="ingest only the files that the triage selects")
    p.add_argument("--triage-input-dir", help="what the triage searches (default: the log files)")
    p.add_argument("--triage-output-dir", help="where slices, selected and manifest go (default: below the output root)")
    p.add_argument("--triage-top-n", type=int, default=40)
    p.add_argument("--triage-min-weighted-score", type=int, default=10)
    p.add_argument("--triage-max-lines-per-file", type=int, default=0, help="0: whole files")
    p.add_argument("--embed-method", choices=("hashed", "words"), default="hashed", help="hashed words, or words weighed and reduced")
    p.add_argument("--min-cluster-size", type=int, default=15)
    p.add_argument("--cluster-mode", choices=("signature", "standard", "fast", "auto"), default="signature", help="equal texts, density of vectors, k-means, or density up to a size")
    p.add_argument("--pca-dims", type=int, default=0, help="principal components to cluster by (0: vectors as they are)")
    p.add_argument("--max-cluster-events", type=int, default=density.MOST)
    p.add_argument("--cluster-overflow-mode", choices=("fail", "downsample"), default="downsample")
    p.add_argument("--causal-gap-seconds", type=int, default=30)
    p.add_argument("--incident-gap-seconds", type=int, default=30)
    p.add_argument("--max-seeds", type=int, default=3)
    p.add_argument("--semantic-jaccard-threshold", type=float, default=0.3)
    p.add_argument("--cluster-window-cap-seconds", type=int, default=900)
    p.add_argument("--episode-gap-seconds", type=int, default=120)
    p.add_argument("--max-episode-duration-seconds", type=int, default=1200)
    p.add_argument("--max-incident-duration-seconds", type=int, default=14_400)
    p.add_argument("--raw-log", nargs="*", default=[], help="validate: log files or folders that the events must hold exactly")
    p.add_argument("--compat-v142", action="store_true", help="validate: status and timeline may be missing")
    p.add_argument("--timeline-minutes", type=int, default=60)
    return p


def log_paths(spark: SparkSession, args) -> list[str]:
    listed = [r.value.strip() for r in spark.read.text(args.logfile_list).collect()] if args.logfile_list else []  # a list of file names
    return [*args.logfile, *[x for x in listed if x]]


def analysed(events: DataFrame, members: DataFrame) -> DataFrame:
    """Canonical events with the columns that the analysis needs: time, run (a day) and cluster."""
    at = X.parsed_time(F.col("timestamp"))
    e = events.join(members, "event_id").withColumn("ts", at).withColumn("us", micros("ts")).withColumn("run_id", F.coalesce(F.date_format("ts", "yyyy-MM-dd"), F.lit("undated")))
    return e.withColumn("status_class", F.coalesce("http_class", F.lit("unknown"))).withColumn("failure_mode", F.get_json_object("semantic", "$.failure_mode")).withColumn("target", F.element_at(F.split(X.dependency_host("raw_text"), r"\."), 1))


def triage_input(spark: SparkSession, args) -> list[str]:
    return [args.triage_input_dir] if args.triage_input_dir else log_paths(spark, args)


def triaged(spark: SparkSession, args) -> list[str]:
    """The files that the triage selects; its slices and manifest are written."""
    out = args.triage_output_dir or f"{args.outputs_root.rstrip('/')}/log_triage"
    chosen = triage.write_triage(spark, triage_input(spark, args), out, args.triage_top_n, args.triage_min_weighted_score, args.triage_max_lines_per_file)
    if not chosen:
        raise ValueError("the triage selects no file")
    return chosen


def by_vectors(found: DataFrame, args) -> DataFrame:
    """(event_id, cluster_id) by the density of vectors or k-means; -1 is noise."""
    v = clusters.numbered(found.select("event_id", "embedding", F.lit(0).alias("_g")), ["_g"], ["event_id"]).select("event_id", F.col("_r").alias("vec_id"), "embedding")
    v = store(vectors.reduced(v, args.pca_dims) if args.pca_dims else v, "clustered")
    number = density.density_clusters(v.select("vec_id", "embedding"), args.min_cluster_size, args.max_cluster_events, args.cluster_overflow_mode, args.cluster_mode)
    name = F.when(F.col("cluster") >= 0, F.concat(F.lit("C"), F.col("cluster").cast("string"))).otherwise("-1")
    return v.join(number, "vec_id").select("event_id", name.alias("cluster_id"))


def step_tables(spark: SparkSession, step: str, args, have: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables that a step makes of those that are there."""
    t = have
    e = lambda: analysed(t["events"], t["members"])
    if step == "ingest":
        from .sources.events import canonical

        paths = triaged(spark, args) if args.triage else log_paths(spark, args)
        return {"events": canonical(logs.ingest(spark, paths))}
    if step == "triage":
        triaged(spark, args)
        picked = triage.triage_files(spark, triage_input(spark, args), args.triage_top_n, args.triage_min_weighted_score, args.triage_max_lines_per_file)[1]
        return {"triage": picked}
    if step == "embed":
        index = clusters.event_index(t["events"])
        by_text = textvec.text_vectors(index) if args.embed_method == "words" else vectors.hashed_vectors(index)
        return {"index": index, "vectors": index.select("event_id", "embedding_text").join(by_text, "embedding_text").select("event_id", "embedding")}
    if step == "cluster":
        members = by_vectors(t["vectors"], args) if args.cluster_mode != "signature" else vectors.signature_clusters(t["events"], min_size=args.min_cluster_size).select("event_id", "cluster_id")
        members = store(members, "members")
        return {"members": members, "clusters": members.groupBy("cluster_id").agg(F.count("*").alias("size"))}
    if step == "trigger_analysis":
        return {"trigger_stats": trigger.trigger_stats(e())}
    if step == "incident_detection":
        cap, episode = args.cluster_window_cap_seconds, (args.episode_gap_seconds, args.max_episode_duration_seconds)
        found = store(incidents.incidents(e(), args.incident_gap_seconds, args.max_seeds, cap, *episode, args.max_incident_duration_seconds, args.semantic_jaccard_threshold), "incidents")
        return {"incidents": found, "status": incidents.detection_status(found, incidents.cluster_windows(t["trigger_stats"], cap))}
    if step == "causal_analysis":
        nodes = store(causal.profiles(e()), "nodes")
        edges = store(causal.causal_graph(nodes, args.causal_gap_seconds), "edges")
        candidates = store(causal.root_candidates(nodes, edges), "candidates")
        roots = store(causal.grounded_events(e()).join(candidates.where("candidate_rank <= 5").select("run_id", "cluster_id"), ["run_id", "cluster_id"], "left_semi"), "roots")
        return {"profiles": nodes, "edges": edges, "candidates": candidates, "roots": roots, "confidence": causal.report_confidence(candidates, roots), "patterns": reports.failure_pattern(roots)}
    if step == "report":
        spans = t["trigger_stats"].groupBy("run_id").agg(F.count("*").alias("clusters"), F.expr("(max(last_us) - min(first_us)) div 1000000").alias("duration"))
        return {"report": reports.root_cause_report(t["candidates"], t["roots"], t["patterns"], t["confidence"], t["edges"]), "blast_radius": reports.blast_radius(t["patterns"], spans)}
    if step == "incident_assertions":
        return {"assertions": evidence.assertions(t["candidates"], t["roots"], t["incidents"])}
    if step == "evidence_bundle":
        onset, events = store(evidence.anomaly_onset(t["roots"]), "onset"), store(e(), "analysed")
        made = {"onset": onset, "impacts": evidence.post_impacts(events, onset), "breakdown": evidence.impact_breakdown(events, onset), "dependencies": evidence.dependency_edges(events, onset), "lift": evidence.failure_lift(events, onset), "overall_lift": bundles.overall_lift(events, onset)}
        return made | {"bundle": bundles.bundle(t["candidates"], t["roots"], onset, made["impacts"], made["overall_lift"], made["dependencies"], t["assertions"])}
    if step == "detailed_report":
        return {"detailed": bundles.detailed_report(t["report"], t["bundle"], t["incidents"])}
    if step == "preincident_diagnostics":
        return {"diagnostics": quality.diagnostics(e())}
    if step == "timeline":
        return {"timeline": evidence.timeline(e(), args.timeline_minutes)}
    if args.raw_log:
        t = t | {"raw_records": store(logs.file_records(logs.file_lines(spark, args.raw_log)), "raw-records")}
    return {"checks": validate.validate(spark, t, optional=("status", "timeline", "diagnostics") if args.compat_v142 else ())}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run a step, or all in order; returns 1 if a check of ``validate`` fails."""
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("rootline").getOrCreate()
    order = ["ingest", "embed", "cluster", "trigger_analysis", "incident_detection", "causal_analysis", "report", "incident_assertions", "evidence_bundle", "detailed_report", "preincident_diagnostics", "timeline", "validate"]
    for step in order if args.step == "all" else [args.step]:
        have = layout.read_tables(spark, args.outputs_root, args.pipeline_profile)
        layout.write_tables(step_tables(spark, step, args, have), args.outputs_root, args.pipeline_profile, args.clean)
    if args.step not in ("validate", "all"):
        return 0
    checks = layout.read_tables(spark, args.outputs_root, args.pipeline_profile, ("checks",))["checks"]
    artifacts.write(checks.orderBy("step", "name").coalesce(1), f"{layout.path_of(args.outputs_root, 'checks', args.pipeline_profile).removesuffix('.parquet')}.json", "overwrite")
    failed = checks.where("not passed").orderBy("step", "name").collect()
    for r in failed:
        print(f"step {r['step']}: {r['name']}: {r['details']}", file=sys.stderr)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
