"""Index of anchors shared by documents: the first step of both substring operators.

An anchor is a gram of ``gram`` units that is the least by hash in some window of ``window`` units, so every window
holds one, at an offset that depends on the window's content alone.  Its context is all that any window around it can
see.  Two equal windows therefore meet at equal anchors, and an anchor whose context is the same wherever it occurs
settles every window around it without a look at the texts again.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import units
from .shared import parts, tidy

ANCHORS = "anchor long, ctx long, doc_id long, pos int"


@dataclass(frozen=True)
class Spec:
    """unit: 'word' (between ASCII white space) or 'byte'; window: units of a matching string; gram: units of an anchor."""

    unit: str
    window: int
    gram: int
    chunk: int


class Reader:
    """Unit hashes, window validity and anchors of a chunk of texts."""

    def __init__(self, spec: Spec):
        self.spec, self.roll, self.seq = spec, units.Rolling(), units.Rolling(base=0xC2B2AE3D27D4EB4F)
        self.mask = units.word_mask(units.SPACES)

    def load(self, data: np.ndarray, offsets: np.ndarray) -> None:
        s = self.spec
        if s.unit == "word":
            starts, ends, self.bounds = units.words(data, offsets, self.mask)
            self.prefix = self.seq.prefix(self.roll.sound_words(data, starts, ends))
        else:
            self.bounds = offsets
            self.prefix = self.roll.prefix(self.roll.bytes[data])
        self.n = len(self.prefix) - 1
        self.hash = self.seq if s.unit == "word" else self.roll
        self.limit = units.ends_of(self.bounds)

    def anchors(self) -> np.ndarray:
        s, n = self.spec, self.n
        self.valid = self.limit[: max(0, n - s.window + 1)] - np.arange(max(0, n - s.window + 1)) >= s.window
        self.grams = self.hash.grams(self.prefix, s.gram)
        at, self.least = units.window_minima(self.grams, s.window - s.gram + 1, self.valid)
        return at

    def open_windows(self, at: np.ndarray, opened: np.ndarray, done: np.ndarray, narrow: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows whose own anchor is open, but not those around an anchor of ``done``; and that anchor.

        Only a window's own anchor, its leftmost least gram, is an anchor wherever the window stands.  opened: flags
        by unit; done: anchors that settle the windows around them as copies; narrow: the own anchor is only sought for
        windows that hold an open one, with the same result.
        """
        s = self.spec
        some, reach = np.flatnonzero(opened), s.window - s.gram
        if not len(self.valid) or not len(some):
            return some[:0], some[:0]
        if narrow:
            near = units.covered(self.n, np.maximum(0, some - reach), some + 1)
            near &= ~units.covered(self.n, np.maximum(0, done - reach), done + 1)
            starts = np.flatnonzero(self.valid & near[: len(self.valid)])
            own = at[units.own_minimum(self.grams, self.least, at, starts)]
            keep = opened[own]
        else:
            starts = np.flatnonzero(self.valid)
            own = at[units.own_minimum(self.grams, self.least, at, starts)]
            known = units.covered(self.n, np.maximum(0, done - reach), done + 1)
            keep = opened[own] & ~known[starts]
        return starts[keep], own[keep]

    def contexts(self, at: np.ndarray, row: np.ndarray) -> np.ndarray:
        s = self.spec
        a = np.maximum(self.bounds[row], at - (s.window - s.gram))
        b = np.minimum(self.bounds[row + 1], at + s.window)
        h = self.hash.span(self.prefix, a, b)
        h ^= (at - a).astype(np.uint64) * units.SALT
        return units.mix(h)


    def flags(self, at: np.ndarray, row: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
        """For anchors ``at`` of texts ``row``: whether the text's list has the anchor's hash."""
        c1, c2 = np.uint64(0x9FB21C651E98DF25), np.uint64(0xA24BAED4963EE407)
        theirs = np.concatenate([x.view(np.uint64) for x in lists]) if lists else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(lists), dtype=np.uint64), [len(x) for x in lists])
        return np.isin(self.grams[at] * c1 + row.astype(np.uint64) * c2, theirs * c1 + owner * c2)


def _first_of_equals(reader: Reader, ids: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Flags: no text of this chunk equals this row's text and has a smaller doc_id (or, of one id, stands before)."""
    whole = reader.hash.span(reader.prefix, reader.bounds[:-1], reader.bounds[1:])
    order = np.lexsort((np.arange(len(ids)), ids, whole))
    same = np.concatenate([[False], whole[order][1:] == whole[order][:-1]])
    keep = np.ones(len(ids), bool)
    keep[order[same]] = False
    lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    for i, j in zip(order[same], lead[same]):  # an equal hash alone does not drop a text
        keep[i] = not np.array_equal(data[offsets[i] : offsets[i + 1]], data[offsets[j] : offsets[j + 1]])
    return keep


def _two_each(row: np.ndarray, gram: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    """Indices, per text and anchor, of the first place and of one more: one with other surroundings if there is any.

    Two places tell all that the index needs of a text, so repetitive texts add no long runs of equal rows.
    """
    order = np.lexsort((gram, row))  # stable: places stay in order
    again = np.concatenate([[False], (row[order][1:] == row[order][:-1]) & (gram[order][1:] == gram[order][:-1])]) if len(order) else np.zeros(0, bool)
    group = np.cumsum(~again) - 1
    lead = np.flatnonzero(~again)
    other = np.flatnonzero(again & (ctx[order] != ctx[order][lead[group]] if len(order) else again))
    odd_group, odd = np.unique(group[other], return_index=True)
    size = np.diff(np.concatenate([lead, [len(order)]]))
    plain = size > 1
    plain[odd_group] = False
    return order[np.concatenate([lead, other[odd], lead[plain] + 1])]


def anchor_rows(docs: DataFrame, spec: Spec) -> DataFrame:
    """Two rows at most for each anchor hash and text; of equal texts that one task reads together only the smallest id's."""

    def rows(batches):
        reader = Reader(spec)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in units.text_chunks(batch, "text", spec.chunk):
                reader.load(data, offsets)
                if reader.n < spec.window:
                    continue
                at = reader.anchors()
                row = np.searchsorted(reader.bounds, at, "right") - 1
                first = _first_of_equals(reader, ids[lo:hi], data, offsets)
                at, row = at[first[row]], row[first[row]]
                gram, ctx = reader.grams[at], reader.contexts(at, row)
                kept = _two_each(row, gram, ctx)
                at, row = at[kept], row[kept]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (gram[kept].view(np.int64), ctx[kept].view(np.int64), ids[lo:hi][row], (at - reader.bounds[row]).astype(np.int32))],
                    ["anchor", "ctx", "doc_id", "pos"],
                )

    return docs.select("doc_id", "text").mapInArrow(tidy(rows), ANCHORS)


def shared_anchors(docs: DataFrame, spec: Spec, weight: float, once: bool = False) -> DataFrame:
    """Anchors that occur twice at least: anchor, doc_id, pos, first (doc_id, pos), settled (one context everywhere), n.

    weight: bytes of rows a byte of input; once: one exchange serves the totals and the join with them, as a condition
    that always holds keeps their columns alike.
    """
    rows = anchor_rows(docs, spec)
    dealt = rows.repartition(parts(docs, weight), "anchor")
    totals = (
        dealt.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("ctx").alias("c0"), F.max("ctx").alias("c1"), F.min(F.struct("doc_id", "pos")).alias("first"))
        .where("n > 1")
        .select("anchor", "n", "c0", (F.col("c0") == F.col("c1")).alias("settled"), "first")
    )
    if once:
        return dealt.join(totals.hint("shuffle_hash"), "anchor").where("coalesce(ctx >= c0 and pos >= 0, true)").drop("ctx", "c0")
    totals = totals.drop("c0")
    return dealt.drop("ctx").join(totals.hint("shuffle_hash"), "anchor")


def equal_texts(docs: DataFrame) -> DataFrame:
    """(doc_id) of texts that also stand whole under a smaller doc_id.

    Counted with partial sums and joined back as a plain join, so a group of copies of any size is spread.
    """
    keyed = docs.where("text is not null").select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha"))
    firsts = keyed.groupBy("sha").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1")
    return keyed.join(firsts, "sha").where("doc_id > first_id").select("doc_id")


def lists(batch: pa.RecordBatch, column: str) -> list[np.ndarray]:
    """A column of integer arrays, as one numpy array a row (null: empty)."""
    col = batch.column(batch.schema.get_field_index(column))
    values = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    return [values[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def to_ranges(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted starts as runs [lo, hi] of consecutive numbers."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.concatenate([[0], cut + 1])], starts[np.concatenate([cut, [len(starts) - 1]])]
