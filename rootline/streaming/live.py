"""Live failure counts: events per minute and service with a watermark, and a trigger on their error rate."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores as S

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of Parquet event files that arrive in a folder."""
    return spark.readStream.schema(EVENTS).parquet(folder)


def minute_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 minute") -> DataFrame:
    """Events and errors by window and service; rows later than the watermark are left out."""
    e = events.withColumn("time", F.col("ts").cast("timestamp")).withColumn("service", F.concat(F.lit("svc_"), (F.col("user_id") % 8).cast("string")))
    g = e.withWatermark("time", late).groupBy(F.window("time", width), "service")
    return g.agg(F.count("*").alias("events"), F.count(F.when(F.col("event_type") == "error", 1)).alias("errors"))


def alerts(counts: DataFrame, least: float = 0.4) -> DataFrame:
    rate = F.col("errors") / F.col("events")
    return counts.where(rate >= least).select(F.col("window.start").alias("start"), "service", "events", "errors", F.round(rate, 6).alias("error_rate"), S.severity_step(rate).alias("severity"))
