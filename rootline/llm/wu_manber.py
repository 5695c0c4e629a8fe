"""Benchmark decontamination by Wu-Manber multi-pattern search over words (operator 6).

The patterns are the benchmark's windows of ``window`` consecutive words (an item of fewer words is one pattern).
Patterns of one length share a block shift table, which tells from the last ``block`` words of a text window how many
words can be skipped, and suffix-hash buckets, which list the patterns that end in such a block.  Many text positions
are searched at once: each text is cut into lanes, and all lanes of a chunk take their next jump together.  A window
that reaches shift 0 and whose bucket holds its hash is compared with the pattern strings themselves.

The benchmark is cut into blocks of about ``block_words`` words.  Documents are read once: a task holds some of them,
takes one block's tables after the other from its disk, and lets them go again, so a task's memory is that of one block
however large the benchmark is.

Defined results: null and blank texts have no words, hits or items; a null benchmark text or item_id has no windows;
items that repeat count once.  Documents are handled row by row: repeated rows and rows without doc_id give a row each;
a very long text is one chunk of its own; extra columns, whatever their names, are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import units
from .shared import Sent, documents, tidy

TABLE_BITS = 16
FOUND = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>, spans array<struct<start:int,length:int>>"


class Patterns:
    """Patterns of one length: shift table, the hashes of each suffix bucket, and the strings with their items."""

    def __init__(self, length: int, found: dict[bytes, list[str]], block: int):
        self.length, self.block, self.items = length, min(block, length), found
        roll, seq = units.Rolling(), units.Rolling(base=0xC2B2AE3D27D4EB4F)
        data = np.frombuffer(b" ".join(found), np.uint8)
        starts, ends, _ = units.words(data, np.array([0, len(data)]), units.word_mask(units.SPACES))
        prefix = seq.prefix(roll.words(data, starts, ends))
        at = np.arange(len(found)) * length
        self.shift = np.full(1 << TABLE_BITS, length - self.block + 1, np.int32)
        for i in range(length - self.block + 1):  # block i ends where its last word stands; the last one may not be skipped
            place = seq.span(prefix, at + i, at + i + self.block) >> np.uint64(64 - TABLE_BITS)
            np.minimum.at(self.shift, place, length - self.block - i)
        last = seq.span(prefix, at + length - self.block, at + length) >> np.uint64(64 - TABLE_BITS)
        whole = seq.span(prefix, at, at + length)
        order = np.lexsort((whole, last))
        self.hashes = whole[order]
        self.bucket = np.searchsorted(last[order], np.arange((1 << TABLE_BITS) + 1))
        self.depth = int(np.diff(self.bucket).max())

    def search(self, prefix: np.ndarray, seq: units.Rolling, bounds: np.ndarray, lane: int) -> np.ndarray:
        """First words of the windows whose hash is in their suffix bucket."""
        m, b = self.length, self.block
        room = np.diff(bounds) - m + 1
        row = np.flatnonzero(room > 0)
        lanes = -(-room[row] // lane)
        first = np.repeat(bounds[row] + m, lanes) + units.ragged(lanes) * lane  # one after a window's last word
        stop = np.minimum(first + lane, np.repeat(bounds[row + 1] + 1, lanes))
        at, hits = first, []
        while len(at):
            place = seq.span(prefix, at - b, at) >> np.uint64(64 - TABLE_BITS)
            jump = self.shift[place].astype(np.int64)
            here = np.flatnonzero(jump == 0)
            if len(here):
                end = at[here]
                whole = seq.span(prefix, end - m, end)
                lo, hi = self.bucket[place[here]], self.bucket[place[here] + np.uint64(1)]
                hit = np.zeros(len(here), bool)
                for step in range(int((hi - lo).max())):
                    inside = lo + step < hi
                    hit[inside] |= self.hashes[lo[inside] + step] == whole[inside]
                hits.append(end[hit] - m)
                jump[here] = 1
            at = at + jump
            left = at < stop
            at, stop = at[left], stop[left]
        return np.concatenate(hits) if hits else np.zeros(0, np.int64)


def build(rows: list, window: int, block: int) -> list[Patterns]:
    """Tables from (item_id, text) rows, one for each pattern length."""
    mask, lower = units.word_mask(units.NOT_ALNUM), units.lower_table()
    by_length: dict[int, dict[bytes, list[str]]] = {}
    for item, text in rows:
        data = np.frombuffer((text or "").encode(), np.uint8)
        starts, ends, _ = units.words(data, np.array([0, len(data)]), mask)
        raw = lower[data].tobytes()
        found = [raw[a:b] for a, b in zip(starts, ends)]
        m = min(window, len(found))
        for i in range(len(found) - m + 1 if m else 0):
            items = by_length.setdefault(m, {}).setdefault(b" ".join(found[i : i + m]), [])
            if str(item) not in items:
                items.append(str(item))
    return [Patterns(m, found, block) for m, found in sorted(by_length.items())]


def _spans(lo: np.ndarray, hi: np.ndarray) -> list[dict]:
    out = []
    for a, b in sorted(zip(lo.tolist(), hi.tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"start": a, "length": b - a} for a, b in out]


def _rows(ids, n_words, items, spans, percent):
    span = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
    items = [sorted(x) for x in items]
    hit = [sum(s["length"] for s in x) for x in spans]
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(n_words, pa.int64()),
            pa.array(hit, pa.int64()),
            pa.array([len(x) for x in items], pa.int64()),
            pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
            pa.array([h > 0 and 100 * h >= percent * n for h, n in zip(hit, n_words)], pa.bool_()),
            pa.array(items, pa.list_(pa.string())),
            pa.array(spans, span),
        ],
        ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans"],
    )


class Chunk:
    """Words and hashes of some documents, and what the blocks searched so far have found in them."""

    def __init__(self, ids, data, offsets, mask, lower, roll, seq):
        self.ids, n = ids, len(offsets) - 1
        self.starts, self.ends, self.bounds = units.words(data, offsets, mask)
        data = lower[data]
        self.prefix, self.raw = seq.prefix(roll.words(data, self.starts, self.ends)), data.tobytes()
        self.items, self.edges = [set() for _ in range(n)], [([], []) for _ in range(n)]

    def search(self, tables: list[Patterns], seq: units.Rolling, lane: int) -> None:
        for table in tables:
            at = table.search(self.prefix, seq, self.bounds, lane)
            row = np.searchsorted(self.bounds, at, "right") - 1
            for a, r in zip(at.tolist(), row.tolist()):
                text = b" ".join(self.raw[self.starts[i] : self.ends[i]] for i in range(a, a + table.length))
                if text in table.items:
                    self.items[r].update(table.items[text])
                    self.edges[r][0].append(a - int(self.bounds[r]))
                    self.edges[r][1].append(a - int(self.bounds[r]) + table.length)

    def rows(self, percent: int):
        return _rows(self.ids, np.diff(self.bounds), self.items, [_spans(np.array(a), np.array(b)) for a, b in self.edges], percent)


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = 13, percent: int = 5, block: int = 3, block_words: int = 2_000_000, chunk: int = 4 << 20, lane: int = 256, hold: int = 32 << 20) -> DataFrame:
    """One row a document: words, words inside any occurrence of a pattern, the items, and whether that is contamination.

    contaminated: some word is hit, and at least ``percent`` per cent of the words are.  hold: bytes of documents that a
    task searches with a block before it takes the next one, if there are several.
    """
    if not (1 <= block <= window):
        raise ValueError("block must lie between 1 and window")
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").where("item_id is not null and text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // (block_words * 6)))

    def tables(k):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == k).collect()
        return Sent(spark, build([(r.item_id, r.text) for r in rows], window, block))

    blocks = [tables(k) for k in range(count)]

    def search(batches):
        mask, lower = units.word_mask(units.NOT_ALNUM), units.lower_table()
        roll, seq = units.Rolling(), units.Rolling(base=0xC2B2AE3D27D4EB4F)
        single = blocks[0].load() if len(blocks) == 1 else None
        held, size = [], 0

        def finish():
            for sent in blocks:
                found = single or sent.load(again=True)
                for c in held:
                    c.search(found, seq, lane)
            for c in held:
                yield c.rows(percent)
            held.clear()

        for batch in batches:
            for lo, hi, data, offsets in units.text_chunks(batch, "text", chunk):
                held.append(Chunk(batch.column(0).slice(lo, hi - lo), data, offsets, mask, lower, roll, seq))
                size += len(data)
                if len(blocks) == 1 or size >= hold:
                    yield from finish()
                    size = 0
        yield from finish()

    return docs.select("doc_id", "text").mapInArrow(tidy(search), FOUND)


def op6_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_benchmark(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
OP6_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT DISTINCT item, least(len(w), 13) AS m, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS s
      FROM (SELECT item, w, unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) AS i FROM b WHERE len(w) > 0)),
x AS (SELECT doc_id, m, i, array_to_string(list_slice(w, i, i + m - 1), ' ') AS s
      FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM d, (SELECT DISTINCT m FROM p) WHERE len(w) >= m)),
h AS (SELECT x.doc_id, x.i, x.m, p.item FROM x JOIN p ON x.s = p.s AND x.m = p.m),
n AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS j FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""
