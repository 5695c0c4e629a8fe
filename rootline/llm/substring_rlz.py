"""Substring dedup by anchors and window hashes, in place of relative Lempel-Ziv parsing (operator 2).

The index holds phrases of ``gram`` words, chosen so that every window of ``window`` words holds one (see anchored.py),
and the document in which each phrase stands first.  Where a phrase has the same surroundings in every document, the
index alone settles all windows around it; the windows around phrases that stand in differing surroundings are looked up
one by one by a 128-bit key.  No longest match is computed: a factor is the union of overlapping windows that occur in
documents of a smaller doc_id, not necessarily one document.  Factors become the removed spans.

Defined results: null and blank texts have no words and lose none; fewer words than a window lose none; a doc_id that
repeats counts once (its least text), a row without doc_id is not returned; copies of one text lose everything but in
the smallest doc_id; matches within one document alone remove nothing.  Extra columns are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import units
from .anchored import Reader, Spec, equal_texts, lists, shared_anchors, to_ranges
from .shared import IdFilter, documents, one_per_id, parts, store, tidy

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:int,length:int>>"


def _none(kind: str):
    return F.expr(f"cast(array() as array<{kind}>)")


def factors(n: int, window: int, copied: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unions of overlapping windows, as starts and ends, from the sorted starts of windows that an earlier document holds."""
    lo, hi = to_ranges(copied)
    hi = hi + window
    if len(lo) > 1:  # windows that overlap continue the factor
        new = np.concatenate([[True], lo[1:] > np.maximum.accumulate(hi)[:-1]])
        lo, hi = lo[new], np.maximum.reduceat(hi, np.flatnonzero(new))
    return lo, np.minimum(hi, n)


def boundary_windows(docs: DataFrame, seeds: DataFrame, spec: Spec) -> DataFrame:
    """(k1, k2, doc_id, lo, hi): windows whose own phrase stands in differing surroundings; a text's equal ones are one row."""

    def rows(batches):
        reader, second = Reader(spec), units.Rolling(base=0x165667B19E3779F9, seed=11)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            open_at, done_at = lists(batch, "open_at"), lists(batch, "anchors")
            for lo, hi, data, offsets in units.text_chunks(batch, "text", spec.chunk):
                reader.load(data, offsets)
                if reader.n < spec.window:
                    continue
                base = reader.bounds[:-1]
                at = reader.anchors()
                row = np.searchsorted(reader.bounds, at, "right") - 1
                opened = np.zeros(reader.n, bool)
                opened[at[reader.flags(at, row, open_at[lo:hi])]] = True
                s, _ = reader.open_windows(at, opened, at[reader.flags(at, row, done_at[lo:hi])])
                if not len(s):
                    continue
                starts, ends, _ = units.words(data, offsets, reader.mask)
                other = reader.seq.prefix(second.sound_words(data, starts, ends))
                k1, k2 = reader.hash.span(reader.prefix, s, s + spec.window), reader.seq.span(other, s, s + spec.window)
                new = np.concatenate([[True], (np.diff(s) > 1) | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
                last = s[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(s) - 1]])]
                s, k1, k2 = s[new], k1[new], k2[new]
                row = np.searchsorted(reader.bounds, s, "right") - 1
                order = np.lexsort((s, k2, k1, row))  # equal windows of one text are one row
                s, last, k1, k2, row = s[order], last[order], k1[order], k2[order], row[order]
                first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]))
                edge = pa.array(np.concatenate([first, [len(s)]]).astype(np.int32))
                places = [pa.ListArray.from_arrays(edge, pa.array((x - base[row]).astype(np.int32))) for x in (s, last)]
                yield pa.RecordBatch.from_arrays([pa.array(k1[first].view(np.int64)), pa.array(k2[first].view(np.int64)), pa.array(ids[lo:hi][row[first]]), *places], ["k1", "k2", "doc_id", "lo", "hi"])

    wanted = seeds.where(F.size("open_at") > 0)
    texts = IdFilter(wanted).keep(docs)
    joined = texts.join(wanted.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "open_at", "anchors")
    return joined.mapInArrow(tidy(rows), "k1 long, k2 long, doc_id long, lo array<int>, hi array<int>")


def copied_windows(docs: DataFrame, spec: Spec) -> DataFrame:
    """(doc_id, anchors, lo, hi): hashes of settled phrases of earlier blocks, and runs of single windows of earlier blocks."""
    found = shared_anchors(docs, spec, 0.6)
    seeds = store(
        found.groupBy("doc_id").agg(
            F.collect_set(F.expr("if(not settled, anchor, null)")).alias("open_at"),
            F.collect_set(F.expr("if(settled and first.doc_id < doc_id, anchor, null)")).alias("anchors"),
        ),
        "rlz-seeds",
    )
    rows = boundary_windows(docs, seeds, spec).repartition(parts(docs, 0.3), "k1", "k2")
    firsts = rows.groupBy("k1", "k2").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b")
    single = rows.join(firsts.hint("shuffle_hash"), ["k1", "k2"]).where("doc_id > a").groupBy("doc_id").agg(F.flatten(F.collect_list("lo")).alias("lo"), F.flatten(F.collect_list("hi")).alias("hi"))
    return (
        seeds.where(F.size("anchors") > 0)
        .select("doc_id", "anchors")
        .join(single, "doc_id", "full_outer")
        .select("doc_id", F.coalesce("anchors", _none("bigint")).alias("anchors"), F.coalesce("lo", _none("int")).alias("lo"), F.coalesce("hi", _none("int")).alias("hi"))
    )


def remove_copied(docs: DataFrame, window: int = 50, gram: int = 26, chunk: int = 1 << 20) -> DataFrame:
    """One row a document: words, removed words, sha256 of the kept words joined by one space, and the removed spans."""
    if not 1 < gram <= window:
        raise ValueError("gram must lie between 2 and window")
    spec = Spec("word", window, gram, chunk)
    docs = one_per_id(docs)
    copies = equal_texts(docs).withColumn("whole", F.lit(True))
    fill = [F.coalesce("anchors", _none("bigint")).alias("anchors"), F.coalesce("lo", _none("int")).alias("lo"), F.coalesce("hi", _none("int")).alias("hi"), F.coalesce("whole", F.lit(False)).alias("whole")]
    hits = store(copied_windows(docs, spec).join(copies, "doc_id", "full_outer").select("doc_id", *fill), "rlz-hits")

    def rows_of(ids, texts, spans_of):
        out = [], [], [], []
        for i, text in enumerate(texts):
            found = (text or b"").split()
            spans = spans_of(i, len(found))
            kept, last = [], 0
            for a, b in spans:
                kept += found[last:a]
                last = b
            kept = kept + found[last:] if spans else found
            for x, y in zip(out, (len(found), len(found) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), [{"start": a, "length": b - a} for a, b in spans])):
                x.append(y)
        span = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
        return pa.RecordBatch.from_arrays([ids, pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], span)], ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"])

    def plain(batches):  # selects and hashes in one step: two would take two workers a task
        for batch in unheld(batches):
            yield rows_of(batch.column(0), batch.column(1).cast(pa.large_binary()).to_pylist(), lambda i, n: [])

    def parse(batches):
        reader = Reader(spec)
        for batch in batches:
            for lo, hi, data, offsets in units.text_chunks(batch, "text", chunk):
                some = batch.slice(lo, hi - lo)
                anchors, los, his, whole = lists(some, "anchors"), lists(some, "lo"), lists(some, "hi"), some.column(5).to_pylist()
                reader.load(data, offsets)
                at = reader.anchors()
                row = np.searchsorted(reader.bounds, at, "right") - 1
                held = reader.flags(at, row, anchors)
                at, row = at[held], row[held]
                edge = np.searchsorted(row, np.arange(hi - lo + 1))

                def spans_of(i, n):
                    if n < window:
                        return []
                    if whole[i]:
                        return [(0, n)]
                    a = at[edge[i] : edge[i + 1]] - reader.bounds[i]
                    first = np.concatenate([np.maximum(0, a + gram - window), los[i]])
                    copied = units.covered(n - window + 1, first, np.concatenate([np.minimum(a, n - window), his[i]]) + 1)
                    return list(zip(*(x.tolist() for x in factors(n, window, np.flatnonzero(copied)))))

                raw = data.tobytes()
                texts = [raw[offsets[i] : offsets[i + 1]] for i in range(hi - lo)]
                yield rows_of(batch.column(0).slice(lo, hi - lo), texts, spans_of)

    held = IdFilter(hits)
    unheld = held.step(0, wanted=False)
    clean = docs.mapInArrow(tidy(plain), RESULT)
    touched = held.keep(docs).join(hits.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", *fill)
    return clean.unionByName(touched.mapInArrow(tidy(parse), RESULT))


def op2_substring_rlz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_copied(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256", F.size("spans").cast("long").alias("n_spans"))
