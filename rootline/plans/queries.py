"""Registered queries: each takes (spark, sf_dir) and runs over whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions import text as X
from ..operators import bundles, causal, clusters, density, evidence, incidents, packets, quality, ranker, registry, reports, temporal, textvec, triage, trigger, vectors
from ..sources import logs
from ..sources.events import daily_type_clusters, stream_events, table
from ..storage import store
from . import logtable

EDGE_GAP = 1800
REGISTRY: dict = {}


def query(f):
    REGISTRY[f.__name__] = f
    return f


def _nodes(spark, d):
    return store(causal.profiles(daily_type_clusters(spark, d)), "nodes")  # a row a cluster; the graph reads it often


def _graph(spark, d):
    nodes = _nodes(spark, d)
    return nodes, store(causal.causal_graph(nodes, EDGE_GAP), "edges")


def _roots(spark, d):
    return causal.grounded_events(stream_events(spark, d))


def _windows(spark, d):
    return incidents.cluster_windows(trigger.trigger_stats(stream_events(spark, d)))


@query
def canonical_events(spark: SparkSession, d: str) -> DataFrame:
    return stream_events(spark, d).select("event_id", "us", "run_id", "service", "actor", "verb", "resource", "response_code", "failure_hint", "target", "cluster_id", "severity", "status_family", "status_class", "failure_mode")


@query
def status_classes(spark, d):
    return trigger.cluster_counts(stream_events(spark, d)).select("run_id", "cluster_id", "n_2xx", "n_4xx", "n_5xx", "n_unknown")


@query
def run_windows(spark, d):
    return trigger.run_window(stream_events(spark, d))


@query
def trigger_base(spark, d):
    return trigger.trigger_base(stream_events(spark, d))


@query
def trigger_stats(spark, d):
    s = trigger.trigger_stats(stream_events(spark, d))
    return s.select("run_id", "cluster_id", "event_count", "error_count", "fallback_error_count", "actors", "services", "hint_diversity", F.round("coverage", 6).alias("coverage"), "trigger_score", "incident_strength", "is_candidate")


@query
def top_actors(spark, d):
    return trigger.top_k(stream_events(spark, d), trigger.KEYS, "actor", 5)


@query
def dominant_values(spark, d):
    return trigger.dominant(stream_events(spark, d))


@query
def top_modes(spark, d):
    return trigger.failure_modes(stream_events(spark, d))


@query
def hint_diversity(spark, d):
    e = stream_events(spark, d)
    return e.where("failure_hint is not null").groupBy("run_id", "cluster_id").agg(F.count_distinct("failure_hint").alias("hints"), F.count("*").alias("events"))


@query
def dependency_targets(spark, d):
    return trigger.top_k(stream_events(spark, d), trigger.KEYS, "target", 5)


@query
def transitions(spark, d):
    return trigger.transitions(stream_events(spark, d))


@query
def minute_activity(spark, d):
    return trigger.minute_activity(stream_events(spark, d))


@query
def field_coverage(spark, d):
    return trigger.field_coverage(stream_events(spark, d))


@query
def suppression_hints(spark, d):
    return trigger.suppression_hints(stream_events(spark, d))


@query
def cluster_windows(spark, d):
    return _windows(spark, d)


@query
def gap_sessions(spark, d):
    return incidents.gap_sessions(stream_events(spark, d))


@query
def chained_windows(spark, d):
    return incidents.chained_windows(_windows(spark, d)).select("run_id", "cluster_id", "start_us", "end_us", "chain")


@query
def split_windows(spark, d):
    return incidents.split_chains(incidents.chained_windows(_windows(spark, d))).select("run_id", "cluster_id", "start_us", "end_us", "chain", "part")


@query
def episodes(spark, d):
    return incidents.episodes(_windows(spark, d)).select("run_id", "cluster_id", "start_us", "end_us", "episode")


@query
def episode_signatures(spark, d):
    s = incidents.episode_signatures(stream_events(spark, d))
    return s.select("run_id", "episode", "start_us", "end_us", "windows", "strength", F.array_join("modes", ",").alias("modes"), F.array_join("targets", ",").alias("targets"))


@query
def incidents_found(spark, d):
    return incidents.incidents(stream_events(spark, d))


@query
def incident_status(spark, d):
    e = stream_events(spark, d)
    return incidents.detection_status(incidents.incidents(e), incidents.cluster_windows(trigger.trigger_stats(e)))


@query
def mode_similarity(spark, d):
    s = incidents.cluster_sets(stream_events(spark, d))
    a, b = s.select("run_id", F.col("cluster_id").alias("a"), F.col("modes").alias("ma")), s.select("run_id", F.col("cluster_id").alias("b"), F.col("modes").alias("mb"))
    return a.join(b, "run_id").where("a < b").select("run_id", "a", "b", F.round(S.jaccard("ma", "mb"), 6).alias("jaccard"))


@query
def failure_domain(spark, d):
    return causal.failure_domain(stream_events(spark, d))


@query
def causal_edges(spark, d):
    return causal.causal_edges(_nodes(spark, d), EDGE_GAP)


@query
def fallback_edges(spark, d):
    nodes = _nodes(spark, d)
    return causal.fallback_edges(nodes, nodes.limit(0).select("run_id"))


@query
def root_candidates(spark, d):
    return causal.root_candidates(*_graph(spark, d)).drop("actor", "resource", "first_us")


@query
def grounded_events(spark, d):
    return _roots(spark, d)


@query
def windowed_grounding(spark, d):
    e = stream_events(spark, d)
    w = e.groupBy("run_id").agg(F.min("us").alias("start_us"), (F.min("us") + 3_600_000_000).alias("end_us")).withColumn("incident_id", F.lit("I1"))
    return causal.events_in_windows(e, w)


@query
def confidence_gap(spark, d):
    return causal.report_confidence(causal.root_candidates(*_graph(spark, d)), causal.grounded_events(daily_type_clusters(spark, d)))


@query
def chain_edges(spark, d):
    nodes, edges = _graph(spark, d)
    return causal.chain_edges(causal.root_candidates(nodes, edges), edges)


@query
def downstream_reach(spark, d):
    return causal.reach(causal.causal_edges(_nodes(spark, d), EDGE_GAP))


@query
def anomaly_onset(spark, d):
    return evidence.anomaly_onset(_roots(spark, d))


@query
def post_impacts(spark, d):
    return evidence.post_impacts(stream_events(spark, d), evidence.anomaly_onset(_roots(spark, d)))


@query
def impact_breakdown(spark, d):
    return evidence.impact_breakdown(stream_events(spark, d), evidence.anomaly_onset(_roots(spark, d)))


@query
def dependency_edges(spark, d):
    return evidence.dependency_edges(stream_events(spark, d), evidence.anomaly_onset(_roots(spark, d)))


def _noon(spark, d):
    return stream_events(spark, d).groupBy("run_id").agg((F.floor(F.min("us") / 86_400_000_000) * 86_400_000_000 + 43_200_000_000).cast("bigint").alias("onset_us"))


@query
def failure_lift(spark, d):
    return evidence.failure_lift(stream_events(spark, d), _noon(spark, d), 60)


@query
def timeline(spark, d):
    return evidence.timeline(stream_events(spark, d))


@query
def spike_shape(spark, d):
    e = stream_events(spark, d)
    w = _noon(spark, d).select("run_id", F.lit("I1").alias("incident_id"), F.col("onset_us").alias("start_us"), (F.col("onset_us") + 10_800_000_000).alias("end_us"))
    return evidence.spike_shape(evidence.timeline(e), w)


@query
def assertions(spark, d):
    return evidence.assertions(causal.root_candidates(*_graph(spark, d)), causal.grounded_events(daily_type_clusters(spark, d)))


@query
def orphan_checks(spark, d):
    e = stream_events(spark, d)
    return quality.orphans(e.select("event_id", "cluster_id"), e.where("verb <> 'signup'"), e.where("service <> 'svc_3'").select("cluster_id").distinct()).groupBy("kind").agg(F.count("*").alias("n"))


@query
def graph_checks(spark, d):
    nodes, edges = _graph(spark, d)
    return quality.checks({"graph": causal.graph_violations(nodes, edges), "candidates": causal.candidate_violations(causal.root_candidates(nodes, edges), nodes), "roots": causal.root_violations(_roots(spark, d))})


@query
def null_profile(spark, d):
    return quality.null_profile(stream_events(spark, d), ["service", "actor", "verb", "resource", "path", "response_code", "failure_hint", "target"])


@query
def class_counts(spark, d):
    return quality.class_counts(stream_events(spark, d))


@query
def run_diagnostics(spark, d):
    return quality.diagnostics(stream_events(spark, d))


@query
def redact_documents(spark, d):
    text, counts = X.redaction_steps("text")
    return table(spark, d, "documents").select("doc_id", F.md5(text.cast("binary")).alias("digest"), *[v.cast("bigint").alias(k) for k, v in counts.items() if k in ("uuid", "ip", "hex", "num")])


@query
def embedding_texts(spark, d):
    e = stream_events(spark, d).withColumn("embedding_text", X.embedding_text("service", "severity", "verb", "resource", "status_class"))
    return vectors.signature_clusters(e, min_size=5).groupBy("embedding_text").agg(F.count("*").alias("n"), F.max((F.col("cluster_id") == "-1").cast("int")).alias("noise"))


@query
def document_triage(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    # Words of the invented prose, as signals.
    signals = (("license", 6, "license"), ("the", 1, "the"), ("[0-9]{6}", 4, "number"))
    return triage.score_lines(lines, "doc_id", signals=signals).drop("top_signals")


@query
def triage_ranking(spark, d):
    return triage.ranked(document_triage(spark, d), "doc_id")


@query
def record_assembly(spark, d):
    r = logtable.generated_records(spark, d)
    return r.select(logtable.file_number().alias("file"), "record_no", "raw", F.col("json").isNotNull().alias("is_json"))


@query
def log_events(spark, d):
    e = logs.events(logtable.generated_records(spark, d))
    named = [F.col(f"semantic.{c}").alias(c) for c in ("component", "domain")]
    told = "timestamp severity service actor verb resource path stage response_code http_class status_family failure_hint target target_fqdn source_subtype inner_type failure_location failure_mode signature embedding_text".split()
    return e.select(logtable.file_number().alias("file"), F.col("raw_text").alias("raw"), *told, *named)


@query
def log_slices(spark, d):
    lines = logs.numbered_lines(logs.file_lines(spark, logtable.written(spark, d), empty=True))
    return triage.slices(lines).select(logtable.file_number().alias("file"), "line_no", "line", "matched")


def _document_records(spark, d):
    texts = table(spark, d, "documents").where("doc_id is not null").select(F.col("doc_id").cast("string").alias("source_file"), "text")
    return logs.records(texts)


@query
def document_records(spark, d):
    r = _document_records(spark, d)
    return r.select(F.col("source_file").cast("long").alias("doc_id"), "record_no", "raw", F.col("json").isNotNull().alias("is_json"))


@query
def document_events(spark, d):
    e = logs.events(_document_records(spark, d))
    return e.select("event_id", "timestamp", "severity", "service", "actor", "verb", "resource", "path", "stage", "response_code", "http_class", "status_family", "failure_hint", "target", "failure_mode", "signature", "raw_text", "normalized_text", "embedding_text")


@query
def knn_topk(spark, d):
    v = table(spark, d, "embeddings")
    return vectors.nearest_vectors(v, v.where("vec_id % 100 = 0"), 5)


@query
def nearest_centroid(spark, d):
    v = table(spark, d, "embeddings")
    return vectors.nearest_centroid(v, vectors.centroids(v))


@query
def representatives(spark, d):
    return vectors.representatives(table(spark, d, "embeddings"))


@query
def text_vectors(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = textvec.text_vectors(docs, "text", 32, rounds=2).select(F.sha2("text", 256).alias("_key"), "embedding")
    return docs.select("doc_id", F.sha2("text", 256).alias("_key")).join(found, "_key").drop("_key")


@query
def density_clusters(spark, d):
    return density.density_clusters(table(spark, d, "embeddings"))


@query
def kmeans(spark, d):
    return vectors.kmeans(table(spark, d, "embeddings"))


@query
def cluster_types(spark, d):
    return vectors.cluster_table(stream_events(spark, d))


@query
def cooccurrence(spark, d):
    return temporal.cooccurrence(temporal.active_buckets(stream_events(spark, d), 300))


@query
def precedence(spark, d):
    return temporal.precedence(temporal.active_buckets(stream_events(spark, d), 300))


@query
def series_stats(spark, d):
    return temporal.series_stats(temporal.count_series(stream_events(spark, d)))


@query
def acceleration_scaled(spark, d):
    s = temporal.min_max(temporal.series_stats(temporal.count_series(stream_events(spark, d))), "acceleration", "scaled")
    return s.select("run_id", "cluster_id", F.round("scaled", 6).alias("scaled"))


@query
def lag_correlation(spark, d):
    return temporal.lag_correlation(temporal.count_series(stream_events(spark, d)))


@query
def bucket_scores(spark, d):
    e = stream_events(spark, d)
    return incidents.bucket_scores(e, trigger.trigger_stats(e), 600)


@query
def bucket_waves(spark, d):
    return incidents.bucket_waves(bucket_scores(spark, d))


@query
def retry_loops(spark, d):
    e = stream_events(spark, d).withColumn("slot", F.expr("us div 900000000"))
    return incidents.retry_loops(e, ("run_id", "service", "slot"))


@query
def change_score(spark, d):
    return temporal.change_score(stream_events(spark, d))


def _service_windows(spark, d):
    e = stream_events(spark, d).where("severity = 'ERROR'").withColumn("slot", F.expr("us div 3600000000"))
    g = e.groupBy("run_id", "slot").agg(F.min("us").alias("start_us"), F.max("us").alias("end_us"), F.min_by("service", F.struct("us", "event_id")).alias("root"), F.array_sort(F.collect_set("service")).alias("services"), F.count(F.when(F.col("status_class") == "4xx", 1)).alias("n_4xx"), F.count(F.when(F.col("status_class") == "5xx", 1)).alias("n_5xx"))
    return g.withColumn("incident_id", F.concat(F.lit("W"), F.col("slot").cast("string")))


@query
def incident_graph(spark, d):
    return temporal.incident_links(_service_windows(spark, d), 1200)


@query
def behaviour_patterns(spark, d):
    return temporal.patterns(stream_events(spark, d))


@query
def domain_candidates(spark, d):
    return temporal.domain_candidates(temporal.patterns(stream_events(spark, d)))


@query
def chain_roles(spark, d):
    p = temporal.patterns(stream_events(spark, d))
    return temporal.chain_roles(p, temporal.domain_candidates(p))


@query
def churn_penalties(spark, d):
    return temporal.churn_penalties(stream_events(spark, d))


@query
def failure_patterns(spark, d):
    return reports.failure_pattern(_roots(spark, d))


@query
def blast_radius(spark, d):
    e = stream_events(spark, d)
    spans = e.groupBy("run_id").agg(F.count_distinct("cluster_id").alias("clusters"), F.expr("(max(us) - min(us)) div 1000000").alias("duration"))
    return reports.blast_radius(reports.failure_pattern(_roots(spark, d)), spans)


@query
def root_cause_report(spark, d):
    nodes, edges = _graph(spark, d)
    c, r = store(causal.root_candidates(nodes, edges), "candidates"), store(causal.grounded_events(daily_type_clusters(spark, d)), "roots")
    return reports.root_cause_report(c, r, reports.failure_pattern(r), causal.report_confidence(c, r), edges)


@query
def symptoms(spark, d):
    return bundles.symptoms(_roots(spark, d))


@query
def provenance(spark, d):
    e = stream_events(spark, d)
    # a run's candidates are evidence if a cluster of it makes trouble at all
    claims = trigger.trigger_stats(e).groupBy("run_id").agg(F.bool_or("is_candidate").alias("evidence"))
    return bundles.provenance(_roots(spark, d), claims)


@query
def overall_lift(spark, d):
    return bundles.overall_lift(stream_events(spark, d), _noon(spark, d), 60)


@query
def window_lift(spark, d):
    w = _noon(spark, d).select("run_id", F.lit("I1").alias("incident_id"), F.col("onset_us").alias("start_us"), (F.col("onset_us") + 10_800_000_000).alias("end_us"))
    return bundles.window_lift(stream_events(spark, d), w)


@query
def cluster_features(spark, d):
    return clusters.cluster_features(stream_events(spark, d))


@query
def neighbours(spark, d):
    nodes, stats = _nodes(spark, d), trigger.trigger_stats(daily_type_clusters(spark, d))
    return clusters.neighbours(causal.causal_edges(nodes, EDGE_GAP), stats, _run_incidents(stats))


def _run_incidents(stats):
    """One incident a run: all windows of its candidate clusters."""
    return incidents.cluster_windows(stats).groupBy("run_id").agg(F.lit("I1").alias("incident_id"), F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"))


def _ranked(spark, d, top):
    """Ranked causes, and the events, edges, trigger statistics and cluster table that they come from."""
    e = daily_type_clusters(spark, d)
    stats = store(trigger.trigger_stats(e), "stats")
    members = stats.where("is_candidate").select("run_id", F.lit("I1").alias("incident_id"), "cluster_id")
    edges, types = store(causal.causal_edges(_nodes(spark, d), EDGE_GAP), "edges"), vectors.cluster_table(e)
    return ranker.ranked_causes(_run_incidents(stats), members, e, edges, stats, types, top), e, edges, stats, types


def _packets(spark, d):
    ranked, *rest = _ranked(spark, d, None)
    ranked = store(ranked, "ranked")
    return ranked, store(packets.evidence_packets(ranked, *rest), "packets"), rest[2]


@query
def ranked_causes(spark, d):
    return _ranked(spark, d, 5)[0]


@query
def evidence_packets(spark, d):
    """The first cause of each run's incident and five more; lists as text."""
    p = _packets(spark, d)[1]
    services = F.expr("array_join(transform(top_services, x -> concat(x.service, ':', x.count)), ',')").alias("services")
    classes = F.concat_ws(",", *[F.concat(F.lit(f"{x}:"), F.col(f"classes.n_{x}")) for x in packets.CLASSES]).alias("classes")
    edges = [F.coalesce(F.expr(f"array_join(transform({w}_edges, x -> x.cluster_id), ',')"), F.lit("")).alias(f"{w}_edges") for w in ("in", "out")]
    degrees = [F.coalesce(f"{w}_degree", F.lit(0)).alias(f"{w}_degree") for w in ("in", "out")]
    events = [F.col("earliest.event_id").alias("first_event"), F.col("representative_event.event_id").alias("representative"), F.col("earliest.text").alias("first_text")]
    return p.select("run_id", "cluster_id", "rank", "role", "score", "confidence", "label", "size", "cluster_type", "first_us", "last_us", services, classes, F.array_join("examples", "|").alias("examples"), *events, *edges, *degrees)


@query
def packet_timeline(spark, d):
    return packets.packet_timeline(_packets(spark, d)[1])


@query
def packet_stats(spark, d):
    ranked, p, stats = _packets(spark, d)
    return packets.packet_stats(_run_incidents(stats), ranked, p)


@query
def even_samples(spark, d):
    """At most 100 events of each run, evenly spaced: the limit is the operator."""
    e = stream_events(spark, d).select("run_id", "event_id", "us")
    return clusters.even_sample(e, ["run_id"], ["us", "event_id"], 100)


@query
def explaining_edges(spark, d):
    e = stream_events(spark, d)
    return clusters.explaining_edges(e, trigger.trigger_stats(e).where("is_candidate"))


@query
def assertion_summary(spark, d):
    return evidence.assertion_summary(assertions(spark, d))


@query
def missing_reports(spark, d):
    e = stream_events(spark, d)
    runs = e.select("run_id").distinct()
    return quality.missing_ids(runs, {"failing": e.where("response_code = 503 and target is not null").select("run_id").distinct(), "signup": e.where("verb = 'signup' and resource = 'res_1'").select("run_id").distinct()}, "run_id")


@query
def field_differences(spark, d):
    e = stream_events(spark, d).select("event_id", "service", "resource", "response_code")
    changed = e.withColumn("service", F.expr("if(event_id % 7 = 0, 'other', service)")).withColumn("response_code", F.expr("if(event_id % 5 = 0, null, response_code)"))
    return quality.differences(e, changed, ["service", "resource", "response_code"])


@query
def dependency_hosts(spark, d):
    e = stream_events(spark, d)
    said = F.concat(F.lit("dial http://"), "service", F.lit(".core.svc:80/x, then HTTPS://"), F.upper(F.coalesce("target", F.lit("none"))), F.lit("_1.core.svc and https://"), F.translate("service", "_", "-"), F.lit(".core.svc:443/"), "resource")
    return e.select("event_id", F.array_join(X.dependency_hosts(said), ",").alias("hosts"))


@query
def payload_types(spark, d):
    e = stream_events(spark, d)
    shape = F.to_json(F.struct(F.expr("if(verb = 'error', response_code, null)").alias("statusCode"), F.expr("if(event_id % 2 = 0, verb, null)").alias("method"), F.expr("if(verb = 'click', service, null)").alias("caller"), F.expr("if(event_id % 3 <> 0, resource, null)").alias("msg"), F.expr("if(verb = 'view', named_struct('$date', run_id), null)").alias("t"), F.expr("if(event_id % 5 = 0, raw_text, null)").alias("log")))
    return e.groupBy(X.payload_type(F.when(F.col("event_id") % 11 != 0, shape).otherwise(F.lit("no json"))).alias("kind")).agg(F.count("*").alias("n"))


@query
def subsystems(spark, d):
    e = stream_events(spark, d)
    # A small table in the shape of a pod registry.
    prefixes, spaces = {"svc_1": "one", "svc_1-res_1": "one-one", "svc_2-": "two", "svc": "any"}, {"click": "clicks", "view": "views"}
    pod = F.expr("if(service in ('svc_5', 'svc_6'), null, concat(upper(service), '-', resource))")
    return e.groupBy("service", "verb", X.subsystem("verb", pod, prefixes, spaces).alias("subsystem")).agg(F.count("*").alias("n"))


@query
def pod_registry(spark, d):
    known = registry.read(spark)
    found = registry.component_subsystems(registry.pod_subsystems(logtable.spark_pods(spark, d), known), known)
    return found.select("event_id", "pod_subsystem", "component", "domain", "subsystem")


@query
def service_owners(spark, d):
    services = logtable.spark_pods(spark, d).groupBy(F.col("container").alias("service")).agg(F.count("*").alias("n"))
    return registry.owners(services, registry.read(spark))


@query
def root_confidence(spark, d):
    f = trigger.trigger_stats(stream_events(spark, d))
    shaped = f.select("run_id", "cluster_id", (F.col("trigger_score") * 4).alias("trigger"), F.col("error_count").alias("errors"), F.col("actors").cast("double").alias("out_weight"), F.lit(2.0).alias("in_weight"), F.col("error_rate").alias("proximity"), (F.col("fallback_error_count") == 0).alias("consistent"), F.col("services").cast("double").alias("penalty"))
    return temporal.root_confidence(shaped).select("run_id", "cluster_id", "confidence", "label", F.size("reasons").alias("reasons"))


@query
def lagged_edges(spark, d):
    e = causal.causal_edges(_nodes(spark, d), EDGE_GAP)
    return e.select("run_id", "source", "target", F.round(S.lagged_edge_score("lag_seconds", "semantic_links"), 6).alias("score"))
