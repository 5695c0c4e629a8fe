"""What happened after an anomaly's onset: impact tables, dependency edges, failure lift, timelines and assertions."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scores as S
from .incidents import SECOND
from .trigger import top_k

MINUTE = 60 * SECOND


def anomaly_onset(roots: DataFrame) -> DataFrame:
    """The earliest anomalous grounding event of each run, and its distance to the first one of the best cluster."""
    bad = roots.where(P.failure("evidence"))
    g = bad.groupBy("run_id").agg(F.min("us").alias("onset_us"), F.min_by("event_id", F.struct("us", "event_id")).alias("onset_event"), F.min_by("cluster_id", F.struct("us", "event_id")).alias("onset_cluster"), F.max("us").alias("last_us"))
    return g.withColumn("spread_seconds", F.expr(f"(last_us - onset_us) div {SECOND}")).drop("last_us")


def with_onset(events: DataFrame, onset: DataFrame, end: str = "max") -> DataFrame:
    """Events of runs that have an onset, with it; one row a run is joined, so any run size is fine."""
    return events.join(onset.select("run_id", F.col("onset_us").alias("t0")), "run_id")


def post_impacts(events: DataFrame, onset: DataFrame) -> DataFrame:
    """Per run, from the onset on: events, failures, status classes, first 5xx, and the number of services and resources hit."""
    e = with_onset(events, onset).where("us >= t0")
    bad = P.failure("evidence")
    cls = F.when(F.col("response_code").isNull(), "null").otherwise(F.col("status_class"))
    return e.groupBy("run_id").agg(
        F.count("*").alias("events"),
        F.count(F.when(bad, 1)).alias("failures"),
        *[F.count(F.when(cls == x, 1)).alias(f"n_{x}") for x in ("2xx", "3xx", "4xx", "5xx", "null")],
        F.min(F.when(F.col("response_code") >= 500, F.col("us"))).alias("first_5xx_us"),
        F.count_distinct(F.when(bad, F.col("service"))).alias("services"),
        F.count_distinct(F.when(bad, F.col("resource"))).alias("resources"),
    )


def impact_breakdown(events: DataFrame, onset: DataFrame, k: int = 5) -> DataFrame:
    """The most hit services, resources and failure modes of each run after the onset, as (kind, value, n, rank)."""
    e = with_onset(events, onset).where("us >= t0").where(P.failure("evidence"))
    long = e.select("run_id", "us", F.explode(F.expr("array(struct('service' as kind, service as value), struct('resource' as kind, resource as value), struct('failure_mode' as kind, failure_mode as value))")).alias("x")).select("run_id", "us", "x.kind", "x.value")
    return top_k(long, ["run_id", "kind"], "value", k)


def dependency_edges(events: DataFrame, onset: DataFrame, k: int = 10) -> DataFrame:
    """Failing calls from service to dependency after the onset: count, first time, and rank (earliest first, then largest)."""
    e = with_onset(events, onset).where("us >= t0 and target is not null").where(P.failure("evidence"))
    g = e.groupBy("run_id", F.coalesce("service", F.lit("unknown_service")).alias("source"), "target").agg(F.count("*").alias("n"), F.min("us").alias("first_us"))
    most = Window.partitionBy("run_id").orderBy(F.desc("n"), "first_us", "source", "target")
    first = Window.partitionBy("run_id").orderBy("first_us", F.desc("n"), "source", "target")
    g = g.withColumn("k", F.row_number().over(most)).where(F.col("k") <= k).withColumn("impact", F.row_number().over(first))
    return g.select("run_id", "source", "target", "n", "first_us", "impact", F.when(F.col("impact") == 1, "primary").otherwise("secondary").alias("impact_rank"))


def failure_lift(events: DataFrame, onset: DataFrame, minutes: int = 5) -> DataFrame:
    """Failures by mode in the minutes before and after the onset, their rates, and post over pre (null without a pre)."""
    span = max(1, minutes) * MINUTE
    e = with_onset(events, onset).where(f"us >= t0 - {span} and us <= t0 + {span}").where(P.failure("evidence"))
    g = e.groupBy("run_id", "failure_mode").agg(F.count(F.when(F.col("us") < F.col("t0"), 1)).alias("pre_count"), F.count(F.when(F.col("us") >= F.col("t0"), 1)).alias("post_count"))
    seconds = F.lit(float(max(1, minutes) * 60))
    g = g.withColumn("pre_rate", F.round(S.rate("pre_count", seconds), 6)).withColumn("post_rate", F.round(S.rate("post_count", seconds), 6))
    return g.withColumn("lift", F.round(S.lift("pre_count", "post_count"), 6))


def timeline(events: DataFrame, minutes: int = 60) -> DataFrame:
    """Events and failures of each bucket of a run, zero-filled between its first and last."""
    width = minutes * MINUTE
    b = events.select("run_id", F.expr(f"us div {width}").alias("bucket"), P.failure("timeline").cast("int").alias("bad"))
    g = b.groupBy("run_id", "bucket").agg(F.count("*").alias("total"), F.sum("bad").alias("failures"))
    spine = g.groupBy("run_id").agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi")).select("run_id", F.explode(F.sequence("lo", "hi")).alias("bucket"))
    return spine.join(g, ["run_id", "bucket"], "left").na.fill(0, ["total", "failures"]).select("run_id", "bucket", "total", "failures")


def spike_shape(line: DataFrame, windows: DataFrame, minutes: int = 60) -> DataFrame:
    """The shape of failures before, in and after each incident window."""
    width = minutes * MINUTE
    x = F.col("bucket") * width
    j = line.join(windows.select("run_id", "incident_id", "start_us", "end_us"), "run_id")
    part = F.when(x < F.col("start_us"), "pre").when(x > F.col("end_us"), "post").otherwise("in")
    mean = lambda p: F.coalesce(F.avg(F.when(part == p, F.col("failures"))), F.lit(0.0))
    g = j.groupBy("run_id", "incident_id").agg(F.max("failures").alias("peak"), F.count(F.when(part == "in", 1)).alias("n_in"), mean("pre").alias("pre_avg"), mean("in").alias("in_avg"), mean("post").alias("post_avg"))
    label = (
        F.when(F.col("peak") <= 0, "flat_or_no_failure_signal")
        .when(F.col("n_in") == 0, "insufficient_data")
        .when(F.col("in_avg") < F.greatest(F.lit(1.0), F.col("pre_avg") * 1.2), "weak_spike")
        .when(F.col("post_avg") <= F.col("in_avg") * 0.4, "spike_and_recover")
        .when(F.col("post_avg") >= F.col("in_avg") * 0.8, "spike_and_plateau")
        .otherwise("spike_and_drop")
    )
    return g.select("run_id", "incident_id", "peak", *[F.round(c, 6).alias(c) for c in ("pre_avg", "in_avg", "post_avg")], label.alias("shape"))


def assertions(candidates: DataFrame, roots: DataFrame, incidents: DataFrame | None = None) -> DataFrame:
    """Checks of each run's result as rows (run_id, assertion, status).

    With incidents, their declaration and confidence are checked as well (one incident a run is looked at, the first).
    """
    order = Window.partitionBy("run_id").orderBy("candidate_rank")
    top = candidates.withColumn("second", F.coalesce(F.lead("candidate_score").over(order), F.lit(0.0))).where("candidate_rank = 1")
    support = roots.groupBy("run_id").agg(F.avg(P.failure("evidence").cast("int")).alias("failure_ratio"), F.count("*").alias("observed"))
    t = top.join(support, "run_id", "left").withColumn("net", F.col("out_strength") - F.col("in_strength")).withColumn("gap", F.round(F.col("candidate_score") - F.col("second"), 6))
    none = F.lit(None).cast("string")
    if incidents is not None:
        first = incidents.groupBy("run_id").agg(F.min_by("declaration", "start_us").alias("declaration"), F.min_by("confidence", "start_us").alias("confidence"))
        t = t.join(first, "run_id", "left")
    else:
        t = t.withColumn("declaration", none).withColumn("confidence", F.lit(None).cast("double"))
    claims = F.when(F.col("observed") > 0, 100.0).otherwise(0.0)
    rows = {
        "A0_declaration_allowed": F.when(F.col("declaration").isNull(), "inconclusive").when(F.col("declaration").isin("incident", "possible_incident"), "pass").otherwise("fail"),
        "A1_net_influence_positive": S.threshold_status("net", ">", 0.0),
        "A2_score_gap_significant": S.threshold_status("gap", ">=", 0.10),
        "A3_root_events_failures": S.threshold_status(F.coalesce("failure_ratio", F.lit(0.0)), "==", 1.0),
        "A4_claim_coverage_complete": S.threshold_status(claims, "==", 100.0),
        "A5_possible_incident_bound": F.when(F.col("declaration") == "possible_incident", F.when(F.col("confidence") < 0.70, "pass").otherwise("fail")).otherwise("inconclusive"),
        "A6_observed_logs_present": F.when(F.coalesce("observed", F.lit(0)) > 0, "pass").otherwise("fail"),
    }
    return t.select("run_id", F.explode(F.array(*[F.struct(F.lit(k).alias("assertion"), v.alias("status")) for k, v in rows.items()])).alias("a")).select("run_id", "a.assertion", "a.status")


def assertion_summary(found: DataFrame) -> DataFrame:
    return found.groupBy("run_id").pivot("status", ["pass", "fail", "inconclusive"]).count().na.fill(0)
