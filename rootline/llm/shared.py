"""What several operators need from Spark: partition counts, values sent to executors and bounded document filters."""

import ctypes
import pickle

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import new_path, store  # noqa: F401  (operators take them from here)

FILTER_BITS = 1 << 25
PIECE_BITS = 1 << 19
PART_BYTES = 16 << 20
FILTER_ROWS = 1 << 10


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Sent:
    """A value sent to all executors as bytes that carry its classes, so that workers need no copy of this package."""

    def __init__(self, spark: SparkSession, value):
        self.data = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def load(self, again: bool = False):
        """The value, on an executor; again: its bytes are dropped from memory, to be read from disk the next time."""
        value = pickle.loads(self.data.value)
        if again:
            self.data.__dict__.pop("_value", None)
        return value


def parts(df: DataFrame, per_byte: float = 1.0) -> int:
    """Partitions for a shuffle of ``per_byte`` times the input's bytes: follows the data, never below the session's setting.

    The bytes are those of the plan's sources; a source whose size Spark does not know counts as nothing.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    size = sum(x for x in sizes if x < 1 << 55)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(1_000_000, int(size * per_byte) // PART_BYTES))


def one_per_id(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with each doc_id once; rows without a doc_id go.

    Where a doc_id repeats, its least text stands for it (null before all others).  Only if some doc_id repeats are
    texts shuffled for that.
    """
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    if docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs
    return docs.groupBy("doc_id").agg(F.min(F.struct(F.col("text").isNotNull().alias("there"), "text")).alias("row")).select("doc_id", F.col("row.text").alias("text"))


def _places(ids: np.ndarray) -> np.ndarray:
    h = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h >> np.uint64(64 - FILTER_BITS.bit_length() + 1)


def tidy(step):
    """``step`` (for mapInArrow); what a task has freed goes back to the system at its end, as workers live on for other steps."""

    def run(batches):
        yield from step(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries hold freed memory and have it
        if trim:
            trim(0)

    return run


class IdFilter:
    """A bit array of fixed size (4 MB) that holds every id put in and, seldom, says yes to others.

    It only spares work: whoever uses it joins exactly afterwards.
    """

    def __init__(self, ids: DataFrame, column: str = "doc_id"):
        spark = ids.sparkSession

        def mark(batches):
            bits = np.zeros(FILTER_BITS // 8, np.uint8)
            for b in batches:
                at = _places(b.column(0).to_numpy(zero_copy_only=False))
                np.bitwise_or.at(bits, at >> np.uint64(3), (1 << (at & np.uint64(7))).astype(np.uint8))
            pieces = bits.reshape(-1, PIECE_BITS // 8)
            used = np.flatnonzero(pieces.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([pieces[i].tobytes() for i in used], pa.binary())], ["piece", "bits"])

        def merge(batches):
            found = {}
            for b in batches:
                for piece, bits in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    have = found.setdefault(piece, np.zeros(PIECE_BITS // 8, np.uint8))
                    have |= np.frombuffer(bits, np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([x.tobytes() for x in found.values()], pa.binary())], ["piece", "bits"])

        schema = "piece int, bits binary"
        rows = ids.select(column).mapInArrow(tidy(mark), schema).repartition(FILTER_BITS // PIECE_BITS, "piece").mapInArrow(tidy(merge), schema).collect()
        bits = np.zeros((FILTER_BITS // PIECE_BITS, PIECE_BITS // 8), np.uint8)
        for r in rows:
            bits[r.piece] = np.frombuffer(r.bits, np.uint8)
        self.bits = spark.sparkContext.broadcast(bits.reshape(-1))

    def step(self, at: int, wanted: bool = True):
        """For mapInArrow: the rows whose id, in column ``at``, may be in (wanted) or surely is not (not wanted); a few at a time."""
        bits = self.bits

        def select(batches):
            for whole in batches:
                for part in range(0, whole.num_rows, FILTER_ROWS):
                    b = whole.slice(part, FILTER_ROWS)
                    place = _places(b.column(at).to_numpy(zero_copy_only=False))
                    hit = (bits.value[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    yield b.filter(pa.array(hit if wanted else ~hit))

        return select

    def keep(self, df: DataFrame, wanted: bool = True, column: str = "doc_id") -> DataFrame:
        """The rows whose id may be in (wanted) or surely is not (not wanted)."""
        return df.mapInArrow(tidy(self.step(df.columns.index(column), wanted)), df.schema)
