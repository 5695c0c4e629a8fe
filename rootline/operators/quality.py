"""Null profiles, field coverage, referential checks, scorecards and the artifact validator."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, nulls, percent) in one aggregate over the table."""
    empty = [F.count(F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), 1)).alias(c) for c in columns]
    g = df.agg(F.count("*").alias("_n"), *empty)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns]))
    return g.select("_n", pairs.alias("x")).select("x.column", "x.nulls", F.round(F.when(F.col("_n") > 0, 100.0 * F.col("x.nulls") / F.col("_n")).otherwise(0.0), 4).alias("percent"))


def class_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("severity", "status_family", "status_class").agg(F.count("*").alias("n"))


def orphans(members: DataFrame, events: DataFrame, clusters: DataFrame) -> DataFrame:
    """Members whose event or cluster does not exist: (kind, id)."""
    e = members.join(events.select("event_id"), "event_id", "left_anti").select(F.lit("event").alias("kind"), F.col("event_id").cast("string").alias("id"))
    c = members.select("cluster_id").distinct().join(clusters.select("cluster_id"), "cluster_id", "left_anti").select(F.lit("cluster").alias("kind"), F.col("cluster_id").cast("string").alias("id"))
    return e.unionByName(c)


def missing_ids(ids: DataFrame, artifacts: dict[str, DataFrame], key: str = "incident_id") -> DataFrame:
    """(artifact, id) of ids that an artifact lacks."""
    parts = [ids.select(key).join(df.select(key), key, "left_anti").select(F.lit(name).alias("artifact"), F.col(key).cast("string").alias("id")) for name, df in artifacts.items()]
    return reduce(DataFrame.unionByName, parts)


def differences(left: DataFrame, right: DataFrame, columns: list[str], key: str = "event_id") -> DataFrame:
    """(key, column) where two tables that should agree do not; nulls agree with nulls."""
    j = left.select(key, *[F.col(c).alias(f"l_{c}") for c in columns]).join(right.select(key, *[F.col(c).alias(f"r_{c}") for c in columns]), key)
    bad = F.filter(F.array(*[F.when(~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")), c) for c in columns]), lambda x: x.isNotNull())
    return j.select(key, F.explode(bad).alias("column"))


def diagnostics(events: DataFrame) -> DataFrame:
    """One row a run: volume, severities, and the share of events that have each signal field."""
    from .trigger import SIGNAL_FIELDS, present

    return events.groupBy("run_id").agg(
        F.count("*").alias("events"),
        *[F.count(F.when(F.col("severity") == s, 1)).alias(f"n_{s.lower()}") for s in ("ERROR", "WARN", "INFO")],
        F.count(F.when(F.col("severity").isNull(), 1)).alias("n_none"),
        *[F.round(F.avg(present(x).cast("int")), 6).alias(f"cov_{x}") for x in SIGNAL_FIELDS],
    )


def scorecard(events: DataFrame, clusters: DataFrame, incidents: DataFrame, artifacts: dict[str, DataFrame]) -> DataFrame:
    """Points out of 100: parsing, coverage of clusters, non-null actors, incidents present in every artifact."""
    e = events.agg(F.count("*").alias("events"), F.avg(F.col("ts").isNotNull().cast("int")).alias("parsed"), F.avg(F.col("cluster_id").isNotNull().cast("int")).alias("mapped"), F.avg(F.col("actor").isNotNull().cast("int")).alias("actors"))
    m = missing_ids(incidents, artifacts).agg(F.count("*").alias("missing"))
    c = clusters.agg(F.count("*").alias("clusters"))
    points = 30 * F.when(F.col("parsed") >= 0.995, 1.0).otherwise(F.col("parsed")) + 30 * F.when(F.col("mapped") >= 0.94, 1.0).otherwise(F.col("mapped")) + 20 * F.col("actors") + F.when(F.col("missing") == 0, 20).otherwise(0)
    return e.crossJoin(m).crossJoin(c).withColumn("points", F.round(points, 2))


def checks(named: dict[str, DataFrame]) -> DataFrame:
    """(check, passed, violations) from tables of violations: a check passes if its table is empty."""
    parts = [df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), (F.col("violations") == 0).alias("passed"), "violations") for name, df in named.items()]
    return reduce(DataFrame.unionByName, parts)
