"""Per-cluster statistics of a run and the trigger score: which clusters burst with failures."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scores as S

KEYS = ["run_id", "cluster_id"]
# The fields whose presence measures signal quality.
SIGNAL_FIELDS = ("actor", "resource", "verb", "response_code", "failure_hint")
# Words that hint at planned or noisy churn.
SUPPRESSION = {
    "startup": ("startup", "boot", "warmup", "initializing"),
    "deploy": ("deploy", "rollout", "deployment", "upgrading"),
    "maintenance": ("maintenance", "drain", "cordon", "planned"),
    "healthcheck": ("health", "liveness", "readiness", "probe"),
}


def present(name: str):
    col = F.col(name)
    return F.coalesce(col.cast("string") != "", F.lit(False))


def count_if(cond):
    return F.count(F.when(cond, 1))


def named(name: str):
    """A column's value as text; null for blanks."""
    return F.nullif(F.col(name).cast("string"), F.lit(""))


def value_counts(events: DataFrame, kinds: dict | list, keys: list[str] = KEYS) -> DataFrame:
    """keys, kind, value, n, first_at: how often each value stands in each group, for several columns in one pass.

    kinds: column names, or names with the column that each stands for; null values do not count.
    """
    kinds = kinds if isinstance(kinds, dict) else {k: named(k) for k in kinds}
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("string").alias("value")) for k, c in kinds.items()]))
    long = events.select(*keys, "us", pairs.alias("p")).select(*keys, "us", "p.kind", "p.value").where("value is not null")
    return long.groupBy(*keys, "kind", "value").agg(F.count("*").alias("n"), F.min("us").alias("first_at"))


def top_values(counts: DataFrame, k: int, keys: list[str] = KEYS) -> DataFrame:
    """The k most frequent values of each kind and group; equal counts in order of first appearance."""
    order = Window.partitionBy(*keys, "kind").orderBy(F.desc("n"), "first_at", "value")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def of_kind(counts: DataFrame, kind: str, name: str | None = None) -> DataFrame:
    return counts.where(F.col("kind") == kind).withColumnRenamed("value", name or kind).drop("kind")


def top_k(df: DataFrame, keys: list[str], value: str, k: int, order: str = "us", weight=None, name: str = "n") -> DataFrame:
    """keys, value, n, rank: the k most frequent values of each group; equal counts in order of first appearance."""
    counts = df.where(present(value)).groupBy(*keys, value).agg((weight or F.count("*")).alias(name), F.min(order).alias("first_at"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(name), "first_at", value)))
    return ranked.where(F.col("rank") <= k).select(*keys, value, name, "rank")


def run_window(events: DataFrame) -> DataFrame:
    """One row a run: events, first and last time, seconds (one at least) and events a second."""
    g = events.groupBy("run_id").agg(F.count("*").alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us"))
    g = g.withColumn("seconds", F.greatest(F.lit(1.0), (F.col("last_us") - F.col("first_us")) / 1e6))
    return g.withColumn("rate", F.round(F.col("n") / F.col("seconds"), 9))


def cluster_counts(events: DataFrame) -> DataFrame:
    """Events, errors, errors without HTTP code, response classes, spans and spreads of each cluster.

    Events are first summed by cluster, actor, service and hint; only those sums are expanded for the distinct counts.
    """
    code = F.coalesce("response_code", F.lit(0))
    sums = {
        "event_count": F.lit(True), "error_count": P.failure("trigger"), "fallback_error_count": P.fallback_failure(), "n_2xx": code.between(200, 399), "n_4xx": code.between(400, 499),
        "n_5xx": code >= 500, "n_unknown": code < 200, **{f"has_{x}": present(x) for x in SIGNAL_FIELDS},
    }
    few = events.groupBy(*KEYS, F.coalesce("actor", "service").alias("who"), "service", F.when(P.fallback_failure(), F.col("failure_hint")).alias("hint"))
    few = few.agg(*[count_if(c).alias(k) for k, c in sums.items()], F.min("us").alias("first_us"), F.max("us").alias("last_us"))
    g = few.groupBy(*KEYS).agg(*[F.sum(k).alias(k) for k in sums], F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"), F.count_distinct("who").alias("actors"), F.count_distinct("service").alias("services"), F.count_distinct("hint").alias("hint_diversity"))
    return g.select("*", *[(F.col(f"has_{x}") / F.col("event_count")).alias(f"cov_{x}") for x in SIGNAL_FIELDS]).drop(*[f"has_{x}" for x in SIGNAL_FIELDS])


def trigger_stats(events: DataFrame) -> DataFrame:
    """Cluster counts with burst, severity, trigger score, coverage, strength and the candidate gate."""
    run = Window.partitionBy("run_id")
    s = cluster_counts(events)
    s = s.withColumn("run_seconds", F.greatest(F.lit(1.0), (F.max("last_us").over(run) - F.min("first_us").over(run)) / 1e6)).withColumn("run_events", F.sum("event_count").over(run))
    s = s.withColumn("seconds", F.greatest(F.lit(1.0), (F.col("last_us") - F.col("first_us")) / 1e6))
    s = s.withColumn("burst_factor", (F.col("event_count") / F.col("seconds")) / F.greatest(F.lit(1e-9), F.col("run_events") / F.col("run_seconds")))
    s = s.withColumn("error_rate", F.col("error_count") / F.col("event_count"))
    s = s.withColumn("severity", S.severity_step("error_rate")).withColumn("raw_trigger", S.trigger_raw("burst_factor", "error_rate"))
    s = s.withColumn("trigger_score", S.trigger_adjusted("raw_trigger", "event_count", "actors"))
    s = s.withColumn("coverage", sum(F.col(f"cov_{x}") for x in SIGNAL_FIELDS) / len(SIGNAL_FIELDS))
    s = s.withColumn("incident_strength", S.strength("trigger_score", "error_rate", "coverage", F.col("fallback_error_count") / F.col("event_count"), "hint_diversity"))
    return s.withColumn("is_candidate", S.is_candidate("trigger_score", "incident_strength", "error_count", "error_rate", "fallback_error_count", "hint_diversity"))


def trigger_base(events: DataFrame) -> DataFrame:
    return trigger_stats(events).select(*KEYS, "event_count", "error_count", F.round("burst_factor", 6).alias("burst_factor"), F.round("error_rate", 6).alias("error_rate"), "severity", F.round("raw_trigger", 6).alias("raw_trigger"))


def field_coverage(events: DataFrame) -> DataFrame:
    """Coverage of the signal fields and the flags of those that are low."""
    s = cluster_counts(events)
    flags = F.array_join(F.array_compact(F.array(F.when(F.col("cov_actor") < 0.2, "low_actor_coverage"), F.when(F.col("cov_resource") < 0.2, "low_resource_coverage"), F.when(F.col("cov_response_code") < 0.1, "low_response_code_coverage"))), ",")
    return s.select(*KEYS, *[F.round(f"cov_{x}", 6).alias(f"cov_{x}") for x in SIGNAL_FIELDS], F.round(sum(F.col(f"cov_{x}") for x in SIGNAL_FIELDS) / len(SIGNAL_FIELDS), 6).alias("coverage"), flags.alias("low_flags"))


def failure_modes(events: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent failure modes of each cluster and their share of its events."""
    total = events.groupBy(*KEYS).agg(F.count("*").alias("total"))
    return top_k(events, KEYS, "failure_mode", k).join(total, KEYS).select(*KEYS, "failure_mode", "n", "rank", F.round(F.col("n") / F.col("total"), 6).alias("ratio"))


def dominant(events: DataFrame) -> DataFrame:
    """The most frequent actor, resource and service of each cluster."""
    return most_frequent(value_counts(events, ["actor", "resource", "service"]), ["actor", "resource", "service"])


def most_frequent(counts: DataFrame, kinds: list[str]) -> DataFrame:
    """The most frequent value of each kind, as one column a kind."""
    return top_values(counts, 1).groupBy(*KEYS).agg(*[F.max(F.when(F.col("kind") == k, F.col("value"))).alias(k) for k in kinds])


def minute_activity(events: DataFrame) -> DataFrame:
    """Lower median and 95th value of the events in active minutes, by index into the sorted counts."""
    minutes = events.groupBy(*KEYS, F.expr("us div 60000000").alias("minute")).agg(F.count("*").alias("n"))
    sizes = minutes.groupBy(*KEYS).agg(F.sort_array(F.collect_list("n")).alias("a"))
    return sizes.select(*KEYS, F.size("a").alias("minutes"), F.expr("a[size(a) div 2]").alias("p50"), F.expr("a[least(size(a) - 1, cast(floor(size(a) * 0.95) as int))]").alias("p95"))


def transitions(events: DataFrame, seconds: int = 3600) -> DataFrame:
    """Changes from failure to success in time order, and their share of the errors.

    Events are ordered inside time buckets of a cluster; a bucket hands its last state to the next one, so a busy
    cluster is spread over its buckets.
    """
    bucket = [*KEYS, "bucket"]
    order = Window.partitionBy(*bucket).orderBy("us", "event_id")
    is_failure = P.http_failure() | P.family_failure()
    e = events.select(*KEYS, F.expr(f"us div {seconds * 1_000_000}").alias("bucket"), "us", "event_id", is_failure.alias("bad"), P.success().alias("good"), P.failure("trigger").alias("err"))
    e = e.withColumn("turn", F.coalesce(F.lag("bad").over(order), F.lit(False)) & F.col("good"))
    at = F.struct(F.col("us").isNotNull().alias("timed"), "us", "event_id")
    b = e.groupBy(*bucket).agg(count_if(F.col("turn")).alias("turns"), count_if(F.col("err")).alias("errors"), F.min_by("good", at).alias("good"), F.max_by("bad", at).alias("bad"))
    turn = F.coalesce(F.lag("bad").over(Window.partitionBy(*KEYS).orderBy("bucket")), F.lit(False)) & F.col("good")
    s = b.withColumn("turn", turn).groupBy(*KEYS).agg((F.sum("turns") + count_if(F.col("turn"))).alias("failure_to_success"), F.sum("errors").alias("errors"))
    return s.withColumn("recovery_strength", F.when(F.col("errors") > 0, F.round(F.least(F.lit(1.0), F.col("failure_to_success") / F.col("errors")), 6)).otherwise(0.0))


def suppression_hints(events: DataFrame, text: str = "raw_text") -> DataFrame:
    """Words of churn and of recovery by cluster, and churn hints an event."""
    low = F.lower(F.concat_ws(" ", text, "failure_hint", "path", "resource"))
    hits = [count_if(low.rlike("|".join(words))).alias(name) for name, words in SUPPRESSION.items()]
    s = events.groupBy(*KEYS).agg(F.count("*").alias("n"), *hits, count_if(low.rlike("retry|backoff")).alias("retry_hints"), count_if(low.rlike("recovered|recovery|restored|stabilized")).alias("recovered_hints"))
    return s.withColumn("ratio", F.round(sum(F.col(x) for x in SUPPRESSION) / F.col("n"), 6))
