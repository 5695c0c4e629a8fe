"""Merkle manifest of a dataset with a proof for every row (operator 13).

A row's leaf is the SHA-256 of its fields, each written as byte count, colon and value (``-`` for null).  The leaves of a
source, in ascending doc_id, are hashed in runs of ``FANOUT`` until one node is left, its subroot; the subroots, in order
of their source, are hashed likewise to the root.  Digests are concatenated as lower-case hex text.

Rows are dealt to aligned blocks of ``FANOUT ** LEVELS`` consecutive nodes of one tree, however large a source is.  In a
block the 64-byte hex digests are one contiguous numpy matrix: each level is that matrix cut at multiples of the fanout,
hashed row by row, and a node's siblings are the bytes before and after it in its run, found by index arithmetic.  Blocks
become the nodes of the next step (a job of 1/4096 of the rows), and on the way back each block is given the siblings
above it once, not once a row.  Places in a source come from a range sort by (source, doc_id): rows are counted by range
partition, so no task orders or counts the rows of a whole source.

Defined results: null fields are ``-``; a null source is a source of its own, first in order; rows without doc_id come
first in their source and are never tampered with; rows with the same doc_id are ordered by leaf, so repeated rows give a
row each with one leaf and neighbouring places; very long texts are hashed by Spark like any other; a table without rows
gives none; extra columns, whatever their names, are ignored.
"""

import hashlib
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import documents, parts, store

FANOUT = 16
LEVELS = 3
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<left:string,right:string>>"


def leaf(**changed):
    """The leaf of a row, with the columns in ``changed`` in place of its own."""
    written = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        written.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*written).cast("binary"), 256)


def ranked(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds pos, a row's place in its group from 0 in ``order``, and n, the rows of the group."""
    keys = [group, *order]
    at = F.monotonically_increasing_id()  # 33 bits count the rows of a partition, those above are its number
    rows = store(df.repartitionByRange(parts(df), *keys).sortWithinPartitions(*keys).withColumn("_at", at).withColumn("_part", F.shiftright("_at", 33)), "ranked")
    whole = Window.partitionBy(group)
    runs = rows.groupBy(group, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    runs = runs.withColumn("n", F.sum("_n").over(whole)).withColumn("_before", F.sum("_n").over(whole.orderBy("_part")) - F.col("_n"))
    placed = rows.join(runs.drop("_n"), [group, "_part"])
    return placed.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_first", "_before")


def height(n: int) -> int:
    """Levels from n nodes to one."""
    h = 0
    while n > 1:
        n, h = -(-n // FANOUT), h + 1
    return h


def levels(rows: pa.Table) -> list[np.ndarray]:
    """The digest matrices of a block, its nodes first, as far up as the block or the tree reaches."""
    nodes = "".join(rows.column("digest").to_pylist()).encode()
    found = [np.frombuffer(nodes, np.uint8).reshape(-1, HEX)]
    for _ in range(min(LEVELS, height(rows.column("n")[0].as_py()))):
        low, full = found[-1], len(found[-1]) // FANOUT
        runs = [*low[: full * FANOUT].reshape(full, FANOUT * HEX), *([low[full * FANOUT :].reshape(-1)] if len(low) % FANOUT else [])]
        found.append(np.frombuffer("".join(hashlib.sha256(r).hexdigest() for r in runs).encode(), np.uint8).reshape(-1, HEX))
    return found


def in_order(rows: pa.Table) -> pa.Table:
    return rows.combine_chunks().sort_by("pos")


def climb(nodes: DataFrame) -> list[DataFrame]:
    """The nodes (g, pos, n, digest) of each step, from those given to one row a tree."""

    def up(rows):
        rows = in_order(rows)
        found, first = levels(rows), {c: rows.column(c)[0].as_py() for c in ("g", "pos", "n")}
        assert len(found[-1]) == 1
        block = FANOUT**LEVELS
        row = {"g": first["g"], "pos": first["pos"] // block, "n": -(-first["n"] // block), "digest": found[-1].tobytes().decode()}
        return pa.Table.from_pylist([row], schema=pa.schema([("g", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())]))

    steps = [nodes]
    while not steps[-1].where("n > 1").isEmpty():
        now = steps[-1].select("g", "pos", "n", "digest", in_block())
        steps.append(store(now.groupBy("g", "block").applyInArrow(up, "g string, pos long, n long, digest string"), "nodes"))
    return steps


def in_block():
    return F.floor(F.col("pos") / FANOUT**LEVELS).alias("block")


def descend(steps: list[DataFrame], above: DataFrame) -> DataFrame:
    """The nodes of the first step with top and proof: the siblings (left, right) in each run up to the root.

    above: (g, block, top, proof) of every tree, block 0.
    """

    def prove(rows, over):
        rows = in_order(rows)
        found, over = levels(rows), over.slice(0, 1).to_pylist()[0]
        rest_left, rest_right = ([p[side] for p in over["proof"]] for side in ("left", "right"))
        flat = [(m.tobytes().decode(), len(m)) for m in found[:-1]]
        left, right = [], []
        for i in range(rows.num_rows):
            for text, count in flat:
                run = i - i % FANOUT
                left.append(text[run * HEX : i * HEX])
                right.append(text[(i + 1) * HEX : min(run + FANOUT, count) * HEX])
                i //= FANOUT
            left += rest_left
            right += rest_right
        each = len(flat) + len(rest_left)
        at = pa.array(np.arange(rows.num_rows + 1) * each, pa.int32())
        proof = pa.ListArray.from_arrays(at, pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], ["left", "right"]))
        return rows.drop_columns(["block"]).append_column("top", pa.array([over["top"]] * rows.num_rows, pa.string())).append_column("proof", proof)

    for now in reversed(steps[:-1] or steps):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in now.schema) + f", top string, proof {PROOF}"
        blocks = now.withColumn("block", in_block()).groupBy("g", "block")
        proved = blocks.cogroup(above.groupBy("g", "block")).applyInArrow(prove, schema)
        above = proved.select("g", F.col("pos").alias("block"), "top", "proof")
    return proved


def folded(leaf_, proof):
    """The root that a leaf and the siblings of a proof give."""
    return F.aggregate(proof, leaf_, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]).cast("binary"), 256))


def manifest(docs: DataFrame, **also) -> DataFrame:
    """doc_id, leaf, subroot, root and proof of every row; ``also`` names further columns over the input's row to carry."""
    # a null source sorts before all others, also before an empty one
    key = F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit(""))
    leaves = store(docs.select(key.alias("g"), "doc_id", leaf().alias("digest"), *[c.alias(name) for name, c in also.items()]), "leaves")
    leaves = store(ranked(leaves, "g", ["doc_id", "digest"]), "leaves")
    steps = climb(leaves)
    tops = steps[-1].select(F.lit("").alias("g"), F.col("g").alias("of"), "digest")
    sources = store(ranked(tops, "g", ["of"]), "sources")
    upper = climb(sources)
    root = upper[-1].first()
    if not root:
        return leaves.select("doc_id", F.col("digest").alias("leaf"), *[F.lit("").alias(x) for x in ("subroot", "root")], F.array().cast(PROOF).alias("proof"), *also)
    root = root.digest
    over = docs.sparkSession.createDataFrame([("", 0, root, [])], f"g string, block long, top string, proof {PROOF}")
    over = store(descend(upper, over).select(F.col("of").alias("g"), F.lit(0).cast("long").alias("block"), F.col("digest").alias("top"), "proof"), "over")
    return descend(steps, over).select("doc_id", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), F.lit(root).alias("root"), "proof", *also)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = manifest(documents(spark, sf_dir), changed=F.when(chosen, leaf(text=lowered)))
    rows = rows.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("proof")))
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
