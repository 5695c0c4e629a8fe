"""Which subsystem, component and owner a pod or service belongs to, by a registry kept in a file.

A registry is a table (kind, name, value, owner) of any size; the one in ``data/registry.tsv`` is the default.  A pod's rule
is the longest one its name begins with: its beginnings of the lengths that rules have are joined with the rules, each
distinct name once, so neither table is sent anywhere whole.

Defined results: pod names and namespaces of pod rules ignore case and, for namespaces, outer blanks; a null name is
empty; names without a rule are ``unknown_...``; two rules of one name count as the greater value.
"""

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import matching
from ..functions import text as X

DEFAULT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "data", "registry.tsv")
SCHEMA = "kind string, name string, value string, owner string"


def bundled() -> list[tuple[str, ...]]:
    """The rows of the default registry, read where the program runs."""
    with open(DEFAULT, encoding="utf-8") as f:
        return [tuple(line.rstrip("\n").split("\t")) for line in f if line.strip() and not line.startswith("#")]


def read(spark: SparkSession, path: str | None = None) -> DataFrame:
    """A registry of tab-separated rows; lines that begin with # are remarks."""
    if path is None:
        return spark.createDataFrame(bundled(), SCHEMA)
    return spark.read.schema(SCHEMA).csv(path, sep="\t", comment="#")


def rules(registry: DataFrame, kind: str, name: str, value: str) -> DataFrame:
    return registry.where(F.col("kind") == kind).groupBy(F.col("name").alias(name)).agg(F.max("value").alias(value))


def pod_subsystems(df: DataFrame, registry: DataFrame, namespace: str = "namespace", pod: str = "pod") -> DataFrame:
    """Adds pod_subsystem: by the longest rule that the pod's name begins with, else by its namespace."""
    by_pod, by_space = rules(registry, "pod", "_begins", "_by_pod"), rules(registry, "namespace", "_space", "_by_space")
    lengths = [r[0] for r in by_pod.select(F.length("_begins")).distinct().collect()]  # as many as names have lengths
    keyed = df.withColumn("_pod", F.lower(F.coalesce(pod, F.lit("")))).withColumn("_space", F.lower(F.trim(F.coalesce(namespace, F.lit("")))))
    starts = keyed.select("_pod").distinct().withColumn("_length", F.explode(F.array(*map(F.lit, lengths)))).where(F.length("_pod") >= F.col("_length"))
    longest = starts.withColumn("_begins", F.expr("substring(_pod, 1, _length)")).join(by_pod, "_begins").groupBy("_pod").agg(F.max_by("_by_pod", "_length").alias("_by_pod"))
    found = keyed.join(longest, "_pod", "left").join(by_space, "_space", "left")
    return found.withColumn("pod_subsystem", F.coalesce("_by_pod", "_by_space", F.lit("unknown_asup_subsystem"))).drop("_pod", "_space", "_by_pod", "_by_space")


def component_subsystems(df: DataFrame, registry: DataFrame, namespace: str = "namespace", pod: str = "pod", container: str = "container", text: str | None = None, labels: str | None = None) -> DataFrame:
    """Adds subsystem, component and domain: of the component that container, pod, labels (a map) and text name, else the
    domain its namespace is known for."""
    blank = lambda c: F.nullif(F.trim(F.coalesce(F.col(c), F.lit(""))), F.lit(""))
    told = [blank(pod), blank(container)]
    if labels:
        told.append(F.nullif(F.array_join(F.transform(F.map_entries(labels), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), " "), F.lit("")))
    if text:
        told.append(F.nullif(F.col(text), F.lit("")))
    named = df.withColumn("_actor", F.coalesce(blank(container), blank(pod), F.lit(""))).withColumn("_told", F.concat_ws(" ", *told))
    named = named.withColumn("component", matching.labels(F.lit(None).cast("string"), X.actor_role("_actor"), F.col("_told"))["component"]).withColumn("domain", X.component_domain("component"))
    found = named.withColumn("_space", F.trim(F.coalesce(namespace, F.lit("")))).join(rules(registry, "domain", "_space", "_hint"), "_space", "left")
    return found.withColumn("subsystem", F.coalesce("domain", "_hint", F.lit("unknown_subsystem"))).drop("_space", "_hint", "_actor", "_told")


def owners(df: DataFrame, registry: DataFrame, service: str = "service", text: str | None = None) -> DataFrame:
    """Adds component, domain, system and owner_hint of a service."""
    told = F.coalesce(F.col(text), F.lit("")) if text else F.lit("")
    named = df.withColumn("component", matching.labels(F.lit(None).cast("string"), X.actor_role(service), told)["component"]).withColumn("domain", X.component_domain("component"))
    known = registry.where("kind = 'system'").groupBy(F.col("name").alias("domain")).agg(F.max(F.struct("value", "owner")).alias("_known"))
    found = named.join(known, "domain", "left")
    return found.select(*[c for c in named.columns if c != "domain"], F.coalesce("domain", F.lit("unknown_domain")).alias("domain"), F.coalesce("_known.value", F.lit("unknown_system")).alias("system"), F.coalesce("_known.owner", F.lit("unknown_owner")).alias("owner_hint"))
