"""Whether events hold exactly the records of the raw logs: order-free fingerprints of the two record sets, file by file.

A fingerprint is the number of records and two sums over hashes of them, so it is an aggregate with partial sums and one
row a file; it tells lost, doubled and changed records apart from none.  Only files whose fingerprints differ are compared
record by record.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILE = "source_file"


def fingerprints(df: DataFrame, raw: str = "raw") -> DataFrame:
    """(source_file, n, mark): mark is equal for equal multisets of records."""
    sums = [F.sum(F.xxhash64(F.lit(salt), F.coalesce(raw, F.lit(""))).cast("decimal(38,0)")).cast("string") for salt in (1, 2)]
    return df.groupBy(FILE).agg(F.count("*").alias("n"), F.concat_ws(":", *sums).alias("mark"))


def compared(records: DataFrame, events: DataFrame) -> DataFrame:
    """(source_file, n_records, n_events, same) of every file that either side has."""
    a = fingerprints(records).withColumnsRenamed({"n": "n_records", "mark": "a"})
    b = fingerprints(events).withColumnsRenamed({"n": "n_events", "mark": "b"})
    both = a.join(b, FILE, "full_outer").na.fill(0, ["n_records", "n_events"])
    return both.select(FILE, "n_records", "n_events", F.coalesce(F.col("a") == F.col("b"), F.lit(False)).alias("same"))


def differences(records: DataFrame, events: DataFrame) -> DataFrame:
    """(source_file, raw, n_records, n_events) of the records that stand more often on one side, in files that differ."""
    bad = compared(records, events).where("not same").select(FILE)
    sides = records.select(FILE, "raw", F.lit(1).alias("side")).unionByName(events.select(FILE, "raw", F.lit(0).alias("side"))).join(bad, FILE, "left_semi")
    g = sides.groupBy(FILE, "raw").agg(F.sum("side").alias("n_records"), F.sum(1 - F.col("side")).alias("n_events"))
    return g.where("n_records <> n_events")
