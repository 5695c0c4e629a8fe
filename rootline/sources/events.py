"""Canonical events: schema, files, and the adapter from the generic event stream table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import predicates as P

TEXT = "event_id source_type timestamp severity service actor verb resource path stage".split()
AFTER = "http_class status_family failure_hint raw_text normalized_text embedding_text structured_fields redactions semantic signature".split()
CANONICAL = T.StructType([T.StructField(x, T.StringType()) for x in TEXT] + [T.StructField("response_code", T.LongType())] + [T.StructField(x, T.StringType()) for x in AFTER])


def micros(ts: str = "ts"):
    """Microseconds since 1970 of a timestamp without zone, in any session time zone."""
    return F.expr(f"cast(cast(cast(cast({ts} as timestamp_ntz) - timestamp_ntz'1970-01-01 00:00:00' as interval second) as decimal(20, 6)) * 1000000 as bigint)")


def canonical(df: DataFrame) -> DataFrame:
    """Exactly the canonical columns in order: missing ones null, codes outside the type null, nested ones as JSON."""
    have, out = dict(df.dtypes), []
    for field in CANONICAL:
        name, kind = field.name, have.get(field.name)
        if kind is None:
            col = F.lit(None)
        elif kind.startswith(("struct", "map", "array", "variant")):
            col = F.to_json(name)
        else:
            col = F.col(name)
        out.append((F.expr(f"try_cast({name} as bigint)") if kind and name == "response_code" else col.cast(field.dataType)).alias(name))
    return df.select(*out)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Canonical events from Parquet, or from JSON lines (.jsonl or .json, one object a line)."""
    if path.rstrip("/").endswith((".jsonl", ".json")):
        return canonical(spark.read.schema(CANONICAL).json(path))
    return canonical(spark.read.parquet(path))


def write_events(df: DataFrame, path: str, kind: str = "parquet", mode: str = "errorifexists") -> None:
    """Canonical events with the pinned schema, so that an all-null column keeps its type."""
    getattr(canonical(df).write.mode(mode), kind)(path)


def nested(df: DataFrame, column: str, schema: str) -> DataFrame:
    """A JSON column restored to its struct or map; text that is no JSON becomes null."""
    return df.withColumn(column, F.from_json(column, schema, {"mode": "PERMISSIVE"}))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_events(spark: SparkSession, sf_dir: str, cluster: str = "concat('C', user_id % 20)") -> DataFrame:
    """The event stream table as failure-bearing service events, one run a day.

    Columns: event_id, ts, us (microseconds), run_id, service, actor, verb, resource, path, response_code, failure_hint,
    target, cluster_id, severity, status_family, status_class, failure_mode, raw_text.
    """
    k = F.expr("cast(get_json_object(props, '$.k') as int)").alias("k")
    raw = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", k)
    base = raw.selectExpr(
        "event_id",
        "ts",
        "date_format(ts, 'yyyy-MM-dd') as run_id",
        "concat('svc_', user_id % 8) as service",
        "concat('user_', user_id) as actor",
        "event_type as verb",
        "concat('res_', k % 10) as resource",
        "cast(null as string) as path",
        "case when event_type = 'error' then element_at(array(500, 403, 404, 503), k % 4 + 1) when event_type = 'signup' then 201 when event_type = 'view' and k % 10 = 0 then null else 200 end as response_code",
        "case when event_type = 'error' then element_at(array('timeout', 'forbidden', null, 'connection_refused'), k % 4 + 1) end as failure_hint",
        "case when event_type = 'error' and k % 3 = 0 then concat('svc_', (user_id + 1) % 8) end as target",
        f"{cluster} as cluster_id",
    )
    code = F.col("response_code")
    out = base.withColumn("us", micros()).withColumn("severity", P.severity_of(code, F.lit(""))).withColumn("status_family", P.family_of(code, F.col("severity")))
    out = out.withColumn("status_class", P.status_class(code)).withColumn("failure_mode", P.failure_mode(code, F.col("status_family"), F.col("failure_hint")))
    return out.withColumn("raw_text", F.concat_ws(" ", "verb", "resource", "failure_hint"))


def daily_type_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events in clusters by type and service shard, whose starts lie close enough to link."""
    return stream_events(spark, sf_dir, "concat(event_type, '_', user_id % 8)")
