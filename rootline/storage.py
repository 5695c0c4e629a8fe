"""Tables stored between steps, in the folder that the driver and all executors share."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, list[str]] = {}


def folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; on a local master without one (tests), a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="rootline-")
        atexit.register(shutil.rmtree, base, True)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet; release() deletes it."""
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: lineage ends there, and a lost executor costs no rerun."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(spark: SparkSession) -> int:
    """How many tables this application has stored so far; a mark for release()."""
    return len(_written.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, since: int = 0, keep: str | None = None) -> None:
    """Delete the tables stored after the mark ``since``, but those whose name starts with ``keep``.

    Only when nothing reads them any more: a frame over a deleted table fails.
    """
    paths, jvm = _written.get(spark.sparkContext.applicationId, []), spark.sparkContext._jvm
    left = [p for p in paths[since:] if keep and p.rsplit("/", 1)[1].startswith(keep)]
    for p in set(paths[since:]) - set(left):
        at = jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    paths[since:] = left
