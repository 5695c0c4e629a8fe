"""Evidence packets of incidents: what stands behind each ranked cause, its edges, and a short timeline.

Every list of a packet is a bounded best-of: ``leading`` numbers the rows of a key behind a limit, which Spark applies in
each task before rows are shuffled, so a key's task sees at most k rows a task that read some, never a whole cluster.  The lists
that are counted further (services, code classes, examples) are taken from the first 100 rows of a cluster.  The earliest and the
representative event are aggregates with partial results.

Defined results: a cause whose cluster has no events has no packet; an event without time is no earliest event, and a cluster of
such events alone has no place in the timeline; a service is the service, else the actor; empty texts are no examples; equal
counts stand in order of first appearance, equal weights in order of names; edges count only between causes of one incident.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores as S
from .ranker import INCIDENT
from .trigger import KEYS

# The code classes that a packet counts.
CLASSES = ("2xx", "3xx", "4xx", "5xx", "other", "unknown")


def leading(df: DataFrame, keys: list[str], order: list, k: int, name: str = "place") -> DataFrame:
    """The first k rows of each key in ``order``, numbered from 1."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)


def filled(*names: str) -> Column:
    """The first of the columns that holds more than blanks, without blanks around it."""
    return F.coalesce(*[F.nullif(F.trim(F.col(n)), F.lit("")) for n in names])


def code_class(code: str) -> Column:
    x = F.col(code)
    return F.when(x.isNull(), "unknown").when(x.between(200, 599), F.concat(F.floor(x / 100).cast("string"), F.lit("xx"))).otherwise("other")


def event_facts(events: DataFrame, clusters: DataFrame, text: str = "raw_text", order: tuple = ("event_id",), first: int = 100) -> DataFrame:
    """A row a cluster: its earliest and its representative event, and services, code classes and examples of its first rows.

    clusters: run_id, cluster_id and representative (an event_id or null: the first row stands in).
    """
    seen = F.struct("us", "event_id", filled("service", "actor").alias("service"), "response_code", F.coalesce(filled(text), F.lit("")).alias("text"))
    e = events.join(clusters.select(*KEYS, "representative").distinct(), KEYS).select(*KEYS, "us", *{*order, "event_id"} - {"us"}, "representative", code_class("response_code").alias("class"), seen.alias("seen"))
    whole = e.groupBy(*KEYS).agg(F.min_by("seen", F.when(F.col("us").isNotNull(), F.struct("us", *order))).alias("earliest"), F.max(F.when(F.col("event_id") == F.col("representative"), F.col("seen"))).alias("named"))
    rows = leading(e, KEYS, list(order), first).groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("place", "class", "seen"))).alias("m"))
    counted = rows.select(
        *KEYS,
        F.expr("m[0].seen").alias("first_row"),
        F.expr("transform(m, x -> x.seen.service)").alias("services"),
        F.expr("slice(array_distinct(filter(transform(m, x -> x.seen.text), x -> x <> '')), 1, 3)").alias("examples"),
        F.struct(*[F.expr(f"size(filter(m, x -> x.class = '{c}'))").alias(f"n_{c}") for c in CLASSES]).alias("classes"),
    )
    best = "slice(array_sort(transform(array_distinct(filter(services, x -> x is not null)), (s, i) -> struct(-size(filter(services, x -> x = s)) as n, i, s))), 1, 5)"
    counted = counted.withColumn("top_services", F.expr(f"transform({best}, x -> struct(x.s as service, -x.n as count))")).drop("services")
    return whole.join(counted, KEYS).withColumn("representative_event", F.coalesce("named", "first_row")).drop("named", "first_row")


def graph_context(ranked: DataFrame, edges: DataFrame, k: int = 10) -> DataFrame:
    """Per incident, of its first cause: the k heaviest edges in and out among its causes, and the number of all of them."""
    root = ranked.where("rank = 1").select(*INCIDENT, "cluster_id")
    other = ranked.select(*INCIDENT, F.col("cluster_id").alias("other")).distinct()
    sides = [edges.select("run_id", F.col(a).alias("cluster_id"), F.col(b).alias("other"), "score", F.lit(way).alias("way")) for a, b, way in (("source", "target", "out"), ("target", "source", "in"))]
    near = root.join(sides[0].unionByName(sides[1]), KEYS).join(other, [*INCIDENT, "other"])
    key = [*INCIDENT, "cluster_id"]
    degree = near.groupBy(*key).agg(*[F.count(F.when(F.col("way") == w, 1)).alias(f"{w}_degree") for w in ("in", "out")])
    edge = F.struct("place", F.col("other").alias("cluster_id"), F.col("score").alias("weight"))
    lists = leading(near, [*key, "way"], [F.desc("score"), "other"], k).groupBy(*key).agg(*[F.sort_array(F.collect_list(F.when(F.col("way") == w, edge))).alias(f"{w}_edges") for w in ("in", "out")])
    for w in ("in", "out"):
        lists = lists.withColumn(f"{w}_edges", F.expr(f"transform({w}_edges, x -> struct(x.cluster_id as cluster_id, x.weight as weight))"))
    return degree.join(lists, key)


def evidence_packets(ranked: DataFrame, events: DataFrame, edges: DataFrame, stats: DataFrame, types: DataFrame, others: int = 5, **facts) -> DataFrame:
    """A row an incident and cause, the first and ``others`` more: confidence, cluster, events, and the edges of the first.

    ranked: ranker.ranked_causes; stats: trigger_score and error_count a cluster; types: size, span, representative and
    cluster_type a cluster; facts: see event_facts.
    """
    some = ranked.where(F.col("rank") <= others + 1).select(*INCIDENT, "cluster_id", "rank", "score", "proximity", "out_weight", "in_weight")
    known = types.select(*KEYS, "size", "cluster_type", "first_us", "last_us", "representative")
    found = event_facts(events, some.select(*KEYS).distinct().join(known, KEYS), **facts)
    p = some.join(known.drop("representative"), KEYS).join(stats.select(*KEYS, "trigger_score", "error_count"), KEYS, "left").na.fill(0, ["trigger_score", "error_count"])
    p = p.join(found, KEYS).join(graph_context(ranked, edges), [*INCIDENT, "cluster_id"], "left")
    p = p.withColumn("confidence", S.packet_confidence("score", "trigger_score", "error_count", "out_weight", "in_weight", "proximity"))
    return p.withColumn("label", S.level("confidence", 0.80, 0.55)).withColumn("role", F.when(F.col("rank") == 1, "root_cause").otherwise("candidate"))


def packet_timeline(packets: DataFrame, k: int = 5) -> DataFrame:
    """The earliest events of the first k causes of each incident, in order of time, then of score."""
    rows = packets.where((F.col("rank") <= k) & F.col("earliest").isNotNull()).select(*INCIDENT, "cluster_id", "rank", "score", "earliest.*")
    placed = leading(rows, INCIDENT, ["us", F.desc("score"), "rank"], k)
    return placed.select(*INCIDENT, "place", "us", "cluster_id", "score", "event_id", "service", "response_code", F.col("text").alias("summary"))


def packet_stats(incidents: DataFrame, ranked: DataFrame, packets: DataFrame) -> DataFrame:
    """Every incident, with the number of its causes and whether the first has a packet."""
    n = ranked.groupBy(*INCIDENT).agg(F.count("*").alias("candidate_count"))
    root = packets.where("rank = 1").select(*INCIDENT, F.lit(True).alias("has_root_cause"))
    return incidents.select(*INCIDENT, "start_us", "end_us").join(n, INCIDENT, "left").join(root, INCIDENT, "left").na.fill({"candidate_count": 0, "has_root_cause": False})
