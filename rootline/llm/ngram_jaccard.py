"""N-gram Jaccard join by vertical partitioning (operator 3).

A document is the set of its distinct word n-grams, as 64-bit hashes, which are carried whole at any input size.  The global n-gram order is cut into fragments;
every document sends each fragment its segment, packed, in one exchange.  A fragment sees every holder of its n-grams
and so knows their document frequencies: n-grams of one document only are dropped there, and what remains of a
document, with the number dropped, bounds any overlap it can have.  Documents that cannot reach the threshold with
anyone are out before a single pair exists.

Candidate pairs come from prefixes in rarest-first order, of the documents left and of one document per class of equal
sets.  In each prefix group everybody is first paired with a leader, the member of like size nearest to what the others
hold; the overlaps of a pair are counted per fragment and summed.  Then members of groups that still lie in different
components are paired, if their sizes, bounds and the ranks of the common n-gram allow a link.  Pairs inside one component
add nothing to the result and are not formed, so a group of thousands of near copies costs about one pair a member, and no
link between components is lost.  Two bounds spare counting: a pair must hold enough common n-grams in its prefixes (what
is common beyond the prefix that ends first lies in its rest), and the marks of two sets, bit fields that every n-gram
flips a bit of, cannot differ in more bits than the sets do in n-grams.

Defined results: null, empty and blank texts have no shingles and are their own component; fewer words than n make one
shingle; a doc_id that repeats counts once (its least text), a row without doc_id is not returned; a very long text is
one set like any other; extra columns, whatever their names, are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import units
from .graph import components
from .shared import documents, one_per_id, parts, store, tidy

CHUNK_ROWS = 1 << 12
SEGMENTS = "frag int, ids binary, counts binary, grams binary, own_ids binary, own_n binary, own_c binary"
HELD = "home int, ids binary, sizes binary, grams binary, df binary, own_ids binary, own_n binary, own_c binary"
SETS = "doc_id long, n int, c1 long, c2 long, grams array<long>, df array<int>, marks array<long>"
VERIFY_FRAGMENTS = 8
MARK_BITS, MARK_ROWS = 512, 512


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int, mask: np.ndarray, lower: np.ndarray, roll: units.Rolling, seq: units.Rolling):
    """Row and hash of every word n-gram, repeats included; a text of fewer words than n has one gram of them all."""
    starts, ends, bounds = units.words(data, offsets, mask)
    prefix = seq.prefix(roll.sound_words(data, starts, ends, lower))
    number = np.diff(bounds)
    grams = seq.grams(prefix, n)
    whole = np.flatnonzero((units.ends_of(bounds) - np.arange(len(starts)) >= n)[: len(grams)])
    short = np.flatnonzero((number > 0) & (number < n))
    row = np.concatenate([np.searchsorted(bounds, whole, "right") - 1, short])
    return row, np.concatenate([grams[whole], seq.span(prefix, bounds[short], bounds[short + 1])])


def segments(docs: DataFrame, n: int, fragments: int, chunk: int) -> DataFrame:
    """One row a fragment and chunk of texts: the chunk's segments in that fragment, and sizes and digests of the sets.

    Of equal sets in a chunk only the smallest doc_id sends segments; all send size and digest.
    """
    def rows(batches):
        mask, lower = units.word_mask(units.SPACES), units.lower_table()
        roll, seq = units.Rolling(), units.Rolling(base=0xC2B2AE3D27D4EB4F)
        for whole in batches:
            for part in range(0, whole.num_rows, CHUNK_ROWS):
                batch = whole.slice(part, CHUNK_ROWS)
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                for lo, hi, data, offsets in units.text_chunks(batch, "text", chunk):
                    row, gram = gram_sets(data, offsets, n, mask, lower, roll, seq)
                    order = np.argsort(gram)
                    order = order[np.argsort(row[order].astype(np.uint16), kind="stable")]
                    row, gram = row[order], gram[order]
                    new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])]) if len(gram) else np.zeros(0, bool)
                    row, gram = row[new], gram[new]
                    frag = (((gram >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)).astype(np.int64)
                    size = np.bincount(row, minlength=hi - lo)
                    bounds = np.concatenate([[0], np.cumsum(size)])
                    digest = []
                    for salt in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
                        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(units.mix(gram * np.uint64(salt) + np.uint64(salt >> 7)))])
                        digest.append(total[bounds[1:]] - total[bounds[:-1]])
                    doc = ids[lo:hi]
                    order = np.lexsort((doc, digest[1], digest[0], size))
                    again = np.zeros(hi - lo, bool)
                    same = np.ones(max(0, len(order) - 1), bool)
                    for x in (size, *digest):
                        same &= x[order][1:] == x[order][:-1]
                    again[order[1:][same]] = True
                    # segments of (row, fragment), then by fragment
                    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (frag[1:] != frag[:-1])])) if len(gram) else np.zeros(0, np.int64)
                    count = np.diff(np.concatenate([first, [len(gram)]]))
                    seg_row, seg_frag = row[first], frag[first]
                    sent = np.flatnonzero(~again[seg_row])
                    sent = sent[np.argsort(seg_frag[sent], kind="stable")]
                    first, count, seg_row, seg_frag = first[sent], count[sent], seg_row[sent], seg_frag[sent]
                    take = np.repeat(first, count) + units.ragged(count)
                    token = gram[take]
                    home = _home(doc, fragments)
                    home_order = np.argsort(home, kind="stable")
                    home = home[home_order]
                    edge = np.searchsorted(seg_frag, np.arange(fragments + 1))
                    token_edge = np.concatenate([[0], np.cumsum(count)])[edge]
                    home_edge = np.searchsorted(home, np.arange(fragments + 1))
                    used = np.flatnonzero((np.diff(edge) > 0) | (np.diff(home_edge) > 0))
                    seg_id, count = doc[seg_row], count.astype(np.uint32)
                    own_id, own_n = doc[home_order], size[home_order].astype(np.int32)
                    own_c = np.stack(digest, axis=1)[home_order]
                    cut = lambda x, e: pa.array([x[e[f] : e[f + 1]].tobytes() for f in used], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(used, pa.int32()), cut(seg_id, edge), cut(count, edge), cut(token, token_edge), cut(own_id, home_edge), cut(own_n, home_edge), cut(own_c, home_edge)],
                        ["frag", "ids", "counts", "grams", "own_ids", "own_n", "own_c"],
                    )

    return docs.select("doc_id", "text").mapInArrow(tidy(rows), SEGMENTS)


def _home(ids: np.ndarray, fragments: int) -> np.ndarray:
    return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(fragments)


def _joined(batches, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x for b in batches for x in b.column(b.schema.get_field_index(name)).to_pylist()), kind)


def held_twice(fragments: int):
    """For mapInArrow: a fragment's n-grams with two holders or more, with their document frequency, packed by the
    holder's home; and the sizes and digests that came for this home."""

    def fragment(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        ids, count = _joined(got, "ids", np.int64), _joined(got, "counts", np.uint32).astype(np.int64)
        gram = _joined(got, "grams", np.uint64)
        own, own_n, own_c = _joined(got, "own_ids", np.int64), _joined(got, "own_n", np.int32), _joined(got, "own_c", np.int64).reshape(-1, 2)
        del got
        order = np.argsort(gram)
        ranked = gram[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
        held = np.diff(np.concatenate([first, [len(ranked)]]))
        df = np.empty(len(gram), np.int32)
        df[order] = np.repeat(held, held)
        del order, ranked
        kept = df > 1
        left = np.concatenate([[0], np.cumsum(kept)])
        edge = np.concatenate([[0], np.cumsum(count)])
        start, size = left[edge[:-1]], left[edge[1:]] - left[edge[:-1]]
        gram, df = gram[kept], df[kept]
        some = np.flatnonzero(size > 0)
        home = _home(ids[some], fragments)
        by_home = np.argsort(home, kind="stable")
        some, home = some[by_home], home[by_home]
        ids, start, size = ids[some], start[some], size[some]
        own_home = _home(own, fragments)
        by_home = np.argsort(own_home, kind="stable")
        own, own_n, own_c, own_home = own[by_home], own_n[by_home], own_c[by_home], own_home[by_home]
        seg, seen = np.searchsorted(home, np.arange(fragments + 1)), np.searchsorted(own_home, np.arange(fragments + 1))
        token = np.concatenate([[0], np.cumsum(size)])
        used = np.flatnonzero((np.diff(seg) > 0) | (np.diff(seen) > 0))
        take = np.repeat(start, size) + units.ragged(size)
        gram, df, size = gram[take], df[take], size.astype(np.int32)
        cut = lambda x, e: pa.array([x[e[i] : e[i + 1]].tobytes() for i in used], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), cut(ids, seg), cut(size, seg), cut(gram, token[seg]), cut(df, token[seg]), cut(own, seen), cut(own_n, seen), cut(own_c, seen)],
            ["home", "ids", "sizes", "grams", "df", "own_ids", "own_n", "own_c"],
        )

    return fragment


def set_marks(gram: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One row of 64-bit words a set; sets stand one after another in ``gram``.  A bit is set if an odd number of n-grams
    fall on it."""
    out, edge = np.empty((len(size), MARK_BITS // 64), np.int64), np.concatenate([[0], np.cumsum(size)])
    for lo in range(0, len(size), MARK_ROWS):
        hi = min(len(size), lo + MARK_ROWS)
        bit = units.mix(gram[edge[lo] : edge[hi]].astype(np.uint64)) % np.uint64(MARK_BITS)
        at = np.repeat(np.arange(hi - lo), size[lo:hi]) * MARK_BITS + bit.astype(np.int64)
        odd = (np.bincount(at, minlength=(hi - lo) * MARK_BITS) & 1).astype(np.uint8)
        out[lo:hi] = np.packbits(odd.reshape(-1, MARK_BITS), axis=1).view(np.int64)
    return out


def gathered(percent: int):
    """For mapInArrow: one row a document; its n-grams only if enough of them have another holder for any link."""

    def home(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        ids, size = _joined(got, "ids", np.int64), _joined(got, "sizes", np.int32).astype(np.int64)
        gram, df = _joined(got, "grams", np.int64), _joined(got, "df", np.int32)
        own, n, c = _joined(got, "own_ids", np.int64), _joined(got, "own_n", np.int32), _joined(got, "own_c", np.int64).reshape(-1, 2)
        order = np.argsort(own, kind="stable")
        own, n, c = own[order], n[order], c[order]
        at = np.searchsorted(own, ids)
        total = np.bincount(at, size, len(own)).astype(np.int64)
        may = (n > 0) & (100 * total >= percent * n.astype(np.int64))
        start = np.cumsum(size) - size
        seg = np.flatnonzero(may[at]) if len(at) else np.zeros(0, np.int64)
        seg = seg[np.argsort(at[seg], kind="stable")]
        take = np.repeat(start[seg], size[seg]) + units.ragged(size[seg])
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.where(may, total, 0))]).astype(np.int32))
        mask = pa.array(~may)
        gram, df = gram[take], df[take]
        marks = set_marks(gram, total[may])
        mark_offsets = pa.array(np.concatenate([[0], np.cumsum(np.where(may, marks.shape[1], 0))]).astype(np.int32))
        marks = pa.ListArray.from_arrays(mark_offsets, pa.array(marks.reshape(-1)), mask=mask)
        columns = [pa.array(own), pa.array(n), pa.array(c[:, 0]), pa.array(c[:, 1]), pa.ListArray.from_arrays(offsets, pa.array(gram), mask=mask), pa.ListArray.from_arrays(offsets, pa.array(df), mask=mask), marks]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "c1", "c2", "grams", "df", "marks"])

    return home


def overlaps(pairs: DataFrame, pieces: DataFrame) -> DataFrame:
    """(a, b, overlap): the partial overlap in each fragment, summed per pair."""
    each = pairs.select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(VERIFY_FRAGMENTS - 1))).alias("piece"))
    side = lambda x: pieces.select(F.col("doc").alias(x), "piece", F.col("grams").alias(f"grams_{x}"))
    both = each.join(side("a"), ["a", "piece"]).join(side("b"), ["b", "piece"])
    return both.select("a", "b", F.size(F.array_intersect("grams_a", "grams_b")).alias("part")).groupBy("a", "b").agg(F.sum("part").alias("overlap"))


def duplicate_groups(docs: DataFrame, n: int = 5, percent: int = 75, chunk: int = 4 << 20) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id.

    Two documents link when 100 * overlap >= percent * union of their n-gram sets.
    """
    docs = one_per_id(docs)
    count = parts(docs, 2.0)
    dealt = segments(docs, n, count, chunk).repartitionById(count, F.col("frag")).mapInArrow(tidy(held_twice(count)), HELD)
    table = store(dealt.repartitionById(count, F.col("home")).mapInArrow(tidy(gathered(percent)), SETS), "jaccard-sets")
    classes = table.where("n > 0").groupBy("n", "c1", "c2").agg(F.min("doc_id").alias("rep"))
    member = store(table.select("doc_id", "n", "c1", "c2").join(classes, ["n", "c1", "c2"], "left").select("doc_id", F.col("n"), F.coalesce("rep", "doc_id").alias("rep")), "jaccard-classes")
    reps = member.where("doc_id = rep").select("doc_id")
    # a link needs ceil(percent * n / 100) common n-grams; n - s of the rarest have no other holder
    taken = F.expr(f"transform(slice(z, 1, cast(s - ({percent}L * n + 99) div 100 + 1 as int)), x -> x.grams)").alias("taken")
    core = F.expr("aggregate(z, 0D, (a, x) -> a + ln(x.df)) / n").alias("core")  # highest where the set is nearest to what others hold
    ranked = table.where("grams is not null").join(reps, "doc_id").select(F.col("doc_id").alias("doc"), "n", F.size("grams").alias("s"), "grams", "marks", F.array_sort(F.arrays_zip("df", "grams")).alias("z"))
    last = F.expr(f"z[cast(s - ({percent}L * n + 99) div 100 as int)]").alias("last")  # where the prefix ends in the global order
    held = store(ranked.select("doc", "n", "s", "grams", "marks", taken, last, core), "jaccard-reps")
    prefix = held.select("doc", "n", "s", "core", F.posexplode("taken").alias("i", "gram")).select("doc", "n", "s", "core", "gram", (F.col("n") - F.col("s") + F.col("i") + 1).alias("r"))
    prefix = store(prefix, "jaccard-prefix")
    pieces = store(
        held.select("doc", F.explode("grams").alias("gram")).groupBy("doc", F.expr(f"cast(pmod(xxhash64(gram), {VERIFY_FRAGMENTS}) as int)").alias("piece")).agg(F.collect_list("gram").alias("grams")),
        "jaccard-pieces",
    )
    # sizes, shared n-grams, and what can still follow the first common n-gram at ranks r and r2
    allowed = f"(1L + least(n - r, n2 - r2)) * {100 + percent} >= {percent}L * (n + n2) and 100L * least(s, s2) * {100 + percent} >= 100L * {percent} * (n + n2) and 100L * least(n, n2) >= {percent}L * greatest(n, n2)"
    linked = f"{100 + percent}L * overlap >= {percent}L * (n + n2)"

    side = lambda x: held.select(F.col("doc").alias(x), F.struct("n", "s", "taken", "last", "marks").alias(f"of_{x}"))
    rest = f"({percent}L * if(of_a.last <= of_b.last, of_a.n, of_b.n) + 99) div 100 - 1"
    enough = f"{100 + percent}L * (size(array_intersect(of_a.taken, of_b.taken)) + {rest}) >= {percent}L * (of_a.n + of_b.n)"

    # sets that link differ in at most (100 - percent) / (100 + percent) of both sizes
    apart = "aggregate(zip_with(of_a.marks, of_b.marks, (x, y) -> bit_count(x ^ y)), 0, (x, y) -> x + y) + of_a.n - of_a.s + of_b.n - of_b.s"
    near = f"{100 + percent}L * ({apart}) <= {100 - percent}L * (of_a.n + of_b.n)"

    def links(pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b, n, n2) that link."""
        able = store(pairs.join(side("a"), "a").join(side("b"), "b").where(f"{near} and {enough}").select("a", "b", "n", "n2"), "jaccard-able")
        found = overlaps(able.select("a", "b"), pieces)
        return found.join(able, ["a", "b"]).where(linked).select("a", "b")

    def band(half: int) -> Column:
        """Documents that may link lie in one band of sizes or in neighbouring ones; half = 1 is half a band further."""
        return F.floor(F.log("n") / F.log(F.lit(100 / percent)) + half / 2)

    banded = prefix.select("*", F.explode(F.array(*[F.struct(F.lit(h).alias("half"), band(h).alias("band")) for h in (0, 1)])).alias("g")).select("gram", "g.half", "g.band", "doc", "n", "s", "r", "core")
    leaders = banded.groupBy("gram", "half", "band").agg(F.max(F.struct("core", (-F.col("doc")).alias("neg"), "n", "s", "r")).alias("top"), F.count("*").alias("k")).where("k > 1")
    star = (
        banded.join(leaders.select("gram", "half", "band", (-F.col("top.neg")).alias("doc2"), F.col("top.n").alias("n2"), F.col("top.s").alias("s2"), F.col("top.r").alias("r2")), ["gram", "half", "band"])
        .where(f"doc <> doc2 and {allowed}")
        .selectExpr("least(doc, doc2) as a", "greatest(doc, doc2) as b", "n", "n2")
        .groupBy("a", "b")
        .agg(F.min(F.least("n", "n2")).alias("n"), F.max(F.greatest("n", "n2")).alias("n2"))
    )
    star = store(star, "jaccard-star")
    edges = store(links(star), "jaccard-links")
    label = components(edges)
    placed = prefix.join(label.withColumnRenamed("node", "doc"), "doc", "left").select("gram", "doc", "n", "s", "r", F.coalesce("component", "doc").alias("c"))
    placed = store(placed, "jaccard-placed")
    mixed = placed.groupBy("gram").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1").select("gram")
    left = placed.join(mixed, "gram")
    right = left.select("gram", *[F.col(x).alias(f"{x}2") for x in ("doc", "n", "s", "r", "c")])
    cross = left.join(right, "gram").where(f"doc < doc2 and c <> c2 and {allowed}").select(F.col("doc").alias("a"), F.col("doc2").alias("b"), "n", "n2").distinct()
    cross = store(cross.join(star.select("a", "b"), ["a", "b"], "left_anti"), "jaccard-cross")
    edges = store(edges.unionByName(links(cross)), "jaccard-links")
    label = components(edges)
    return member.join(label, member.rep == label.node, "left").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(documents(spark, sf_dir))
