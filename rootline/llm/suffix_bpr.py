"""Suffix-array dedup by bucket-pointer refinement (operator 9).

Texts are UTF-8 bytes.  Suffixes are dealt into initial buckets by a q-gram: the anchor (see anchored.py) that every
string of ``window`` bytes around it shares.  A bucket whose members all have the same surroundings is done.  In the
others the members are suffix-sorted to a depth of ``window`` bytes: buckets of 8-byte prefixes are refined by sorting
on the bucket identifiers that stand 8, 16, 32, ... bytes later, and each pass uses the identifiers that the pass
before has updated; suffixes alone in their bucket leave.  Members that still share a bucket at full depth are equal
strings, compared byte by byte, and all but the earliest are removed.

A bucket with more than ``hot`` members is not gathered in one task.  It is split by all ``window`` bytes of its strings
at once: Spark groups the strings themselves with partial sums and joins them, so equal ones are compared byte by byte
there too, and the result is the same for a bucket of any size.

Defined results: null is empty; texts shorter than ``window`` lose nothing; a text equal to one of a smaller doc_id
loses everything; a doc_id that repeats counts once (its least text), a row without doc_id is not returned; matches
never cross texts but may overlap each other within one; very long texts are chunks of their own.  Extra columns,
whatever their names, are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import units
from .anchored import Reader, Spec, equal_texts, lists, shared_anchors
from .shared import IdFilter, documents, one_per_id, parts, store

RESULT = "doc_id long, n_bytes long, n_removed long, kept_sha256 string, spans array<struct<start:int,length:int>>"
SLICE = "anchor long, doc_id long, start int, body binary"
RANGES = "doc_id long, lo int, hi int"


def refine(data: np.ndarray, at: np.ndarray, depth: int, q: int = 8) -> np.ndarray:
    """Bucket identifiers of the suffixes ``at`` of ``data``, sorted to ``depth`` bytes; -1 for one alone in its bucket.

    Every suffix has ``depth`` bytes at least, so each pass finds the identifiers that it points to.
    """
    word = np.ndarray(max(0, len(data) - q + 1), ">u8", np.ascontiguousarray(data), strides=(1,))
    ident, lost = np.empty(len(data), np.int64), np.zeros(len(data) + 1, np.int64)
    alive, h, step = np.arange(len(at)), q, 0
    while True:
        place = np.flatnonzero(units.covered(len(data), at[alive], at[alive] + depth - h + 1))
        if step:
            key = ident[place].astype(np.uint64) * np.uint64(len(data)) + ident[place + step].astype(np.uint64)
        else:
            key = word[place].astype(np.uint64)
        order = np.argsort(key)
        ranked = key[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1], [True]])
        shared = ~(new[:-1] & new[1:])  # not alone in its bucket
        ident.fill(-1)
        ident[place[order[shared]]] = (np.cumsum(new[:-1]) - 1)[shared]
        np.cumsum(ident < 0, out=lost[1:])
        alive = alive[lost[at[alive] + depth - h + 1] == lost[at[alive]]]
        if h == depth or not len(alive):
            break
        step = min(h, depth - h)
        h += step
    out = np.full(len(at), -1, np.int64)
    out[alive] = ident[at[alive]]
    return out


def _window_rows(docs: DataFrame, seeds: DataFrame, spec: Spec, keyed: bool) -> DataFrame:
    """Strings around the open anchors of each text: slices of neighbouring strings, or (keyed) one row each for hot anchors."""
    column, schema = ("hot_at", "body binary, doc_id long, start int") if keyed else ("open_at", SLICE)

    def rows(batches):
        reader = Reader(spec)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            open_at, done_at = lists(batch, column), lists(batch, "anchors")
            for lo, hi, data, offsets in units.text_chunks(batch, "text", spec.chunk):
                reader.load(data, offsets)
                if reader.n < spec.window:
                    continue
                base = reader.bounds[:-1]
                at = reader.anchors()
                row = np.searchsorted(reader.bounds, at, "right") - 1
                opened = np.zeros(reader.n, bool)
                opened[at[reader.flags(at, row, open_at[lo:hi])]] = True
                s, own = reader.open_windows(at, opened, at[reader.flags(at, row, done_at[lo:hi])], narrow=True)
                if not len(s):
                    continue
                if keyed:
                    row = np.searchsorted(reader.bounds, s, "right") - 1
                    doc, start = ids[lo:hi][row], (s - base[row]).astype(np.int32)
                    strings = np.lib.stride_tricks.sliding_window_view(data, spec.window)
                    for part in range(0, len(s), 1 << 16):
                        some = strings[s[part : part + (1 << 16)]]
                        body = pa.FixedSizeBinaryArray.from_buffers(pa.binary(spec.window), len(some), [None, pa.py_buffer(some.tobytes())])
                        yield pa.RecordBatch.from_arrays([body.cast(pa.binary()), pa.array(doc[part : part + len(some)]), pa.array(start[part : part + len(some)])], ["body", "doc_id", "start"])
                    continue
                new = np.concatenate([[True], (np.diff(s) > 1) | (reader.grams[own][1:] != reader.grams[own][:-1])])
                first = s[new]
                last = s[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(s) - 1]])]
                row = np.searchsorted(reader.bounds, first, "right") - 1
                raw = data.tobytes()
                body = pa.array([raw[a : b + spec.window] for a, b in zip(first.tolist(), last.tolist())], pa.binary())
                columns = reader.grams[own[new]].view(np.int64), ids[lo:hi][row], (first - base[row]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in columns), body], ["anchor", "doc_id", "start", "body"])

    wanted = seeds.where(F.size(column) > 0).select("doc_id", column, "anchors")
    return IdFilter(wanted).keep(docs).join(wanted.hint("shuffle_hash"), "doc_id").select("doc_id", "text", column, "anchors").mapInArrow(rows, schema)


def _sort_buckets(slices: DataFrame, spec: Spec, count: int) -> DataFrame:
    """(doc_id, lo, hi): starts of strings that also start earlier, from the refined buckets of each task's anchors."""

    def sort(body: pa.Array, doc: np.ndarray, start: np.ndarray):
        """Slices come by doc_id and start; those of one text hold no start twice, so their strings are in order too."""
        offsets = np.frombuffer(body.buffers()[1], np.int64)[body.offset : body.offset + len(body) + 1]
        data = np.frombuffer(body.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        number = np.diff(offsets) - spec.window + 1
        row, step = np.repeat(np.arange(len(number)), number), units.ragged(number)
        bucket = refine(data, offsets[:-1][row] + step, spec.window)
        kept = bucket >= 0
        row, bucket, step = row[kept], bucket[kept], step[kept]
        place = np.arange(len(bucket))
        first = np.zeros(bucket.max(initial=-1) + 1, np.int64)
        first[bucket[::-1]] = place[::-1]  # the last one written stays: the earliest
        later = first[bucket] != place
        doc, start = doc[row[later]], start[row[later]] + step[later]
        new = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(start) > 1)]) if len(doc) else np.zeros(0, bool)
        last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(doc) - 1]]) if len(doc) else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(doc[new]), pa.array(start[new].astype(np.int32)), pa.array(start[last].astype(np.int32))], ["doc_id", "lo", "hi"])

    def ranges(batches):
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        table = pa.Table.from_batches(found)
        del found
        anchor, doc, start = (table.column(c).to_numpy() for c in ("anchor", "doc_id", "start"))
        order = np.argsort(anchor, kind="stable")
        size = pc.binary_length(table.column("body")).to_numpy()[order]
        edge = np.flatnonzero(np.concatenate([[True], anchor[order][1:] != anchor[order][:-1]]))  # buckets stay whole
        total = np.concatenate([[0], np.cumsum(size)])
        lo = 0
        while lo < len(order):
            fits = edge[(edge > lo) & (total[edge] <= total[lo] + spec.chunk)]
            after = edge[edge > lo]
            hi = int(fits[-1]) if len(fits) else int(after[0]) if len(after) else len(order)
            if total[-1] <= total[lo] + spec.chunk:
                hi = len(order)
            some = order[lo:hi]
            part = table.take(pa.array(some[np.lexsort((start[some], doc[some]))]))
            body = pa.concat_arrays([c.cast(pa.large_binary()) for c in part.column("body").chunks])
            yield sort(body, part.column("doc_id").to_numpy(), part.column("start").to_numpy())
            lo = hi

    return slices.repartition(count, "anchor").mapInArrow(ranges, RANGES)


def merged(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Spans [lo, hi) as maximal runs; spans that touch are one."""
    if not len(lo):
        return []
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > reach[:-1]])
    return list(zip(lo[new].tolist(), reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(lo) - 1]])].tolist()))


def remove_repeats(docs: DataFrame, window: int = 100, gram: int = 28, hot: int = 50_000, chunk: int = 1 << 20) -> DataFrame:
    """One row a document: bytes, removed bytes, sha256 of the rest, and the maximal removed runs.

    hot: members from which a bucket is grouped string by string by Spark instead of sorted in one task.
    """
    if not 8 <= gram <= window:
        raise ValueError("gram must lie between 8 and window")
    spec = Spec("byte", window, gram, chunk)
    docs = one_per_id(docs)
    found = shared_anchors(docs, spec, 1.2, once=True)
    seeds = store(
        found.groupBy("doc_id").agg(
            F.collect_set(F.expr(f"if(not settled and n <= {hot}, anchor, null)")).alias("open_at"),
            F.collect_set(F.expr(f"if(not settled and n > {hot}, anchor, null)")).alias("hot_at"),
            F.collect_set(F.expr("if(settled and first.doc_id <> doc_id, anchor, null)")).alias("anchors"),
            F.collect_set(F.expr("if(settled and first.doc_id = doc_id and first.pos <> pos, anchor, null)")).alias("again"),
        ),
        "bpr-seeds",
    )
    ranges = _sort_buckets(_window_rows(docs, seeds, spec, False), spec, parts(docs, 0.6))
    if not seeds.where(F.size("hot_at") > 0).isEmpty():
        strings = store(_window_rows(docs, seeds, spec, True), "bpr-strings")
        firsts = strings.groupBy("body").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
        later = strings.join(firsts, "body").where("first.doc_id <> doc_id or first.start <> start")
        ranges = ranges.unionByName(later.select("doc_id", F.col("start").alias("lo"), F.col("start").alias("hi")))
    single = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("r")).select("doc_id", F.col("r.lo").alias("lo"), F.col("r.hi").alias("hi"))
    copies = equal_texts(docs).withColumn("whole", F.lit(True))
    none = lambda kind: F.expr(f"cast(array() as array<{kind}>)")
    fill = [F.coalesce(c, none(k)).alias(c) for c, k in (("anchors", "bigint"), ("again", "bigint"), ("lo", "int"), ("hi", "int"))] + [F.coalesce("whole", F.lit(False)).alias("whole")]
    known = seeds.where(F.size("anchors") + F.size("again") > 0).select("doc_id", "anchors", "again")
    hits = store(known.join(single, "doc_id", "full_outer").join(copies, "doc_id", "full_outer").select("doc_id", *fill), "bpr-hits")

    def cut(batches):
        span = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
        reader = Reader(spec)
        for batch in batches:
            anchors, again, los, his, whole = lists(batch, "anchors"), lists(batch, "again"), lists(batch, "lo"), lists(batch, "hi"), batch.column(6).to_pylist()
            for lo, hi, data, offsets in units.text_chunks(batch, "text", chunk):
                reader.load(data, offsets)
                at = reader.anchors()
                row = np.searchsorted(reader.bounds, at, "right") - 1
                own = reader.flags(at, row, again[lo:hi])
                for i in np.flatnonzero(own):  # in the text where an anchor stands first, all its places but that one
                    own[i] = bool((reader.grams[at[np.searchsorted(row, row[i]) : i]] == reader.grams[at[i]]).any())
                held = reader.flags(at, row, anchors[lo:hi]) | own
                at, row = at[held], row[held]
                edge = np.searchsorted(row, np.arange(hi - lo + 1))
                raw = data.tobytes()
                sizes, removed, digests, spans = [], [], [], []
                for i in range(hi - lo):
                    text = raw[offsets[i] : offsets[i + 1]]
                    n, runs = len(text), []
                    if n >= window:
                        a = at[edge[i] : edge[i + 1]] - offsets[i]
                        runs = [(0, n)] if whole[lo + i] else merged(np.concatenate([np.maximum(0, a + gram - window), los[lo + i]]), np.concatenate([np.minimum(a + window, n), his[lo + i] + window]))
                    digest, last = hashlib.sha256(), 0
                    for x, y in runs:
                        digest.update(text[last:x])
                        last = y
                    digest.update(text[last:])
                    sizes.append(n)
                    removed.append(sum(y - x for x, y in runs))
                    digests.append(digest.hexdigest())
                    spans.append([{"start": x, "length": y - x} for x, y in runs])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(spans, span)], ["doc_id", "n_bytes", "n_removed", "kept_sha256", "spans"])

    held = IdFilter(hits)
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    spans = F.array().cast("array<struct<start:int,length:int>>")
    clean = held.keep(docs, wanted=False).select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.sha2(text, 256).alias("kept_sha256"), spans.alias("spans"))
    touched = held.keep(docs).join(hits.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", *fill)
    return clean.unionByName(touched.mapInArrow(cut, RESULT))


def op9_suffix_bpr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
