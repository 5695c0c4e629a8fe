"""Substring operators, near duplicates and line dedup against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

pytest.importorskip("rootline.llm")
from rootline.llm import anchored, graph, line_winnow, ngram_jaccard, substring_rlz, suffix_bpr, units  # noqa: E402

VOCABULARY = "the of and on re er an in tion eau ß été".split()


def corpus(seed=1, n=60):
    """Texts with copies, near copies, shared passages, repetition, white space, null, empty and one-word texts."""
    r = random.Random(seed)
    words = lambda k: [r.choice(VOCABULARY) + r.choice("abcdefgh") for _ in range(k)]
    passage, texts = words(70), []
    for i in range(n):
        w = words(r.randint(5, 160))
        kind = i % 6
        if kind == 1 and texts:
            w = r.choice(texts).split()
        elif kind == 2 and texts:
            w = r.choice(texts).split()
            if w:
                for _ in range(r.randint(1, 3)):
                    w[r.randrange(len(w))] = "new" + str(i)
        elif kind == 3:
            at = r.randint(0, len(w))
            w[at:at] = passage
        texts.append(" ".join(w))
    texts += ["", "  \n ", "one", "Same " * 150, "Same " * 120, "a\tb c\n" * 40, "\n".join(" ".join(words(12)) for _ in range(2000))]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    rows[-3], rows[-2] = (rows[-2][0], rows[-3][1]), (rows[-3][0], rows[-2][1])
    return rows + [(1000, None), (1001, texts[3])]


def frame(spark, rows):
    """With columns whose names clash with those the operators use inside."""
    return spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], "doc_id long, text string, anchor string, n int, rep int").repartition(5)


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def brute_words(rows, size):
    words = {d: (t or "").encode().split() for d, t in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - size + 1):
            first.setdefault(tuple(words[d][i : i + size]), d)
    out = {}
    for d, w in words.items():
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone[i : i + size] = True
        out[d] = (len(w), int(gone.sum()), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest())
    return out


def brute_bytes(rows, size):
    texts, first, out = {d: (t or "").encode() for d, t in rows}, {}, {}
    for d in sorted(texts):
        for i in range(len(texts[d]) - size + 1):
            first.setdefault(texts[d][i : i + size], (d, i))
    for d, t in texts.items():
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - size + 1):
            if first[t[i : i + size]] < (d, i):
                gone[i : i + size] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[d] = (len(t), int(gone.sum()), runs, hashlib.sha256(bytes(x for x, g in zip(t, gone) if not g)).hexdigest())
    return out


@pytest.mark.parametrize("window,gram", [(50, 26), (12, 5)])
def test_words_removed(spark, window, gram):
    rows = corpus()
    df = substring_rlz.remove_copied(frame(spark, rows), window, gram, chunk=4000)
    assert by_id(df, "n_words", "n_removed", "kept_sha256") == brute_words(rows, window)


@pytest.mark.parametrize("hot", [50_000, 2])
def test_bytes_removed(spark, hot):
    from pyspark.sql import functions as F

    rows = corpus(2)
    df = suffix_bpr.remove_repeats(frame(spark, rows), hot=hot, chunk=4000)
    assert by_id(df.withColumn("k", F.size("spans")), "n_bytes", "n_removed", "k", "kept_sha256") == brute_bytes(rows, 100)


def test_buckets_are_equal_strings():
    r = np.random.default_rng(3)
    data = r.integers(97, 99, 3000).astype(np.uint8)
    at = np.arange(len(data) - 20)
    found = suffix_bpr.refine(data, at, 20)
    groups = collections.Counter(bytes(data[i : i + 20]) for i in at)
    for i, b in zip(at, found):
        assert (b < 0) == (groups[bytes(data[i : i + 20])] == 1)
    seen = {}
    for i, b in zip(at, found):
        if b >= 0:
            assert seen.setdefault(b, bytes(data[i : i + 20])) == bytes(data[i : i + 20])
    assert len(seen) == sum(v > 1 for v in groups.values())


def test_buckets_of_slices_keep_their_earliest_string(spark):
    r, window = random.Random(5), 20
    rows = [(r.randrange(3), d, 50 * k, bytes(r.choice(b"ab") for _ in range(3)) * r.randint(7, 12)) for d in range(40) for k in range(3)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, suffix_bpr.SLICE).repartition(4)
    for chunk in (1, 300, 1 << 20):
        got = suffix_bpr._sort_buckets(df, anchored.Spec("byte", window, 8, chunk), 3).collect()
        found = sorted((x.doc_id, i) for x in got for i in range(x.lo, x.hi + 1))
        strings = sorted((d, s + i, b[i : i + window]) for _, d, s, b in rows for i in range(len(b) - window + 1))
        least = {(a, b[i : i + window]): (9**9, 0) for a, _, _, b in rows for i in range(len(b) - window + 1)}
        for a, d, s, b in rows:
            for i in range(len(b) - window + 1):
                least[a, b[i : i + window]] = min(least[a, b[i : i + window]], (d, s + i))
        anchors = {(d, s + i): a for a, d, s, b in rows for i in range(len(b) - window + 1)}
        if chunk == 1:  # each anchor's bucket by itself
            assert found == [(d, s) for d, s, b in strings if least[anchors[d, s], b] < (d, s)]
        else:  # equal strings have one anchor in real texts; here they may meet across anchors too
            assert set(found) >= {(d, s) for d, s, b in strings if least[anchors[d, s], b] < (d, s)}


def test_anchors_are_dealt_once(spark):
    from pyspark.sql import functions as F

    docs, spec = frame(spark, corpus(4)).select("doc_id", "text"), anchored.Spec("byte", 100, 28, 4000)
    want = anchored.shared_anchors(docs, spec, 1.2)
    found = anchored.shared_anchors(docs, spec, 1.2, once=True)
    assert sorted(found.collect()) == sorted(want.select(found.columns).collect())
    used = found.groupBy("doc_id").agg(F.collect_set("anchor"), F.max("pos"), F.max("n"), F.max("settled"), F.max("first.pos"))
    used.collect()
    assert "ReusedExchange" in used._jdf.queryExecution().executedPlan().toString()


def test_windows_near_open_anchors_are_all_open_windows():
    r = np.random.default_rng(7)
    for _ in range(30):
        reader = anchored.Reader(anchored.Spec("byte", 20, 8, 1 << 20))
        data = r.integers(97, 97 + int(r.integers(1, 4)), 600).astype(np.uint8)
        reader.load(data, np.array([0, 15, 15, 200, 600]))
        at = reader.anchors()
        opened, done = np.zeros(reader.n, bool), r.permutation(at)[: int(r.integers(0, 4))]
        opened[r.permutation(at)[: int(r.integers(0, 12))]] = True
        want, found = reader.open_windows(at, opened, done), reader.open_windows(at, opened, done, narrow=True)
        assert want[0].tolist() == found[0].tolist() and want[1].tolist() == found[1].tolist()


def brute_components(rows, n=5, percent=75):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t or ""))
        sets[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {d: (len(s), top(d)) for d, s in sets.items()}


@pytest.mark.parametrize("seed,percent", [(4, 75), (5, 90)])
def test_components(spark, seed, percent):
    rows = corpus(seed)
    assert by_id(ngram_jaccard.duplicate_groups(frame(spark, rows), percent=percent, chunk=4000), "n_shingles", "component_id") == brute_components(rows, percent=percent)


def test_chains_of_near_copies(spark):
    """A hundred texts, each a small change of the one before: one component, though few pairs are alike."""
    r = random.Random(7)
    words, rows = [f"w{i}" for i in range(120)], []
    for i in range(100):
        words[r.randrange(120)] = f"x{i}"
        rows.append((500 - i, " ".join(words)))
    assert by_id(ngram_jaccard.duplicate_groups(frame(spark, rows)), "n_shingles", "component_id") == brute_components(rows)


def test_graph_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def brute_lines(rows, run, lone=None):
    lines = {d: t.split("\n") for d, t in rows if t is not None}
    first, out = {}, {d: (0, 0, "") for d, t in rows if t is None}
    for d in sorted(lines):
        for i in range(len(lines[d]) - run + 1):
            first.setdefault(tuple(lines[d][i : i + run]), (d, i))
    for d in sorted(lines):
        for i, s in enumerate(lines[d]):
            first.setdefault(s, (d, i))
    long = lambda s: lone is not None and len(re.findall(r"[^\x20\x09-\x0D]+", s)) >= lone
    for d, x in lines.items():
        gone = {j for i in range(len(x) - run + 1) if first[tuple(x[i : i + run])] < (d, i) for j in range(i, i + run)}
        gone |= {i for i, s in enumerate(x) if long(s) and first[s] < (d, i)}
        out[d] = (len(x), len(gone), "\n".join(s for i, s in enumerate(x) if i not in gone))
    return out


@pytest.mark.parametrize("run", [1, 3, 4])
def test_lines_removed(spark, run):
    r = random.Random(run)
    pool = [f"line {i}" for i in range(12)] + [""]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randint(0, 14)))) for i in range(60)] + [(90, None), (91, ""), (92, "same\n" * 30)]
    assert by_id(line_winnow.drop_repeated_lines(frame(spark, rows), run), "n_lines", "n_removed", "text") == brute_lines(rows, run)


@pytest.mark.parametrize("run,lone", [(3, 5), (2, 3), (3, 50)])
def test_lone_lines_removed(spark, run, lone):
    """A repeated long line goes though its neighbours differ, also in texts of one line; short ones go in runs only."""
    r = random.Random(lone)
    line = " ".join(f"w{i}" for i in range(50))
    pool = ["a b", "c  d\te", "f g h i j", "k l m n o p", line, " ", ""]
    rows = [(i, "\n".join(r.choice(pool) if r.random() < 0.5 else f"own {i} {k}" for k in range(r.randint(1, 9)))) for i in range(50)]
    rows += [(90, line), (91, line + "\n" + line), (92, None), (93, ""), (94, line + " "), (95, "own\n" + line + "\nother")]
    got = by_id(line_winnow.drop_repeated_lines(frame(spark, rows), run, lone), "n_lines", "n_removed", "text")
    assert got == brute_lines(rows, run, lone) and got[90][1] == 1 and got[95][1] == 1 and got[94][1] == 0


@pytest.mark.parametrize("fragments", [3, 70_000])
def test_fragments_keep_all_bits(fragments):
    """N-grams that differ in any one bit stay apart, also with more fragments than 16 bits can number."""
    import pyarrow as pa

    base = 0x0123456789ABCDEF
    grams = {7: [base, base ^ (1 << 63)], 8: [base, base ^ 1], 9: [base ^ (1 << 63), base ^ (1 << 48), base ^ (1 << 52)]}
    pack = lambda x, kind: np.array(x, kind).tobytes()
    row = [5 % fragments, pack(list(grams), np.int64), pack([len(x) for x in grams.values()], np.uint32), pack(sum(grams.values(), []), np.uint64), b"", b"", b""]
    batch = pa.RecordBatch.from_arrays([pa.array([x], pa.int32() if i == 0 else pa.binary()) for i, x in enumerate(row)], ["frag", "ids", "counts", "grams", "own_ids", "own_n", "own_c"])
    found = {}
    for b in ngram_jaccard.held_twice(fragments)(iter([batch])):
        for x in b.to_pylist():
            ids, size, gram, df = (np.frombuffer(x[k], t) for k, t in (("ids", np.int64), ("sizes", np.int32), ("grams", np.uint64), ("df", np.int32)))
            for d, g, n in zip(ids, np.split(gram, np.cumsum(size)[:-1]), np.split(df, np.cumsum(size)[:-1])):
                found[int(d)] = dict(zip(g.tolist(), n.tolist()))
    assert found == {7: {base: 2, base ^ (1 << 63): 2}, 8: {base: 2}, 9: {base ^ (1 << 63): 2}}


@pytest.mark.parametrize("f", [substring_rlz.remove_copied, suffix_bpr.remove_repeats, ngram_jaccard.duplicate_groups, line_winnow.drop_repeated_lines])
def test_empty_tables_and_repeated_ids(spark, f):
    assert f(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    twice = spark.createDataFrame([(1, "b " * 200), (1, "a " * 200), (1, "a " * 200), (None, "x"), (2, None), (2, None)], "doc_id long, text string")
    assert sorted(r.doc_id for r in f(twice).collect()) == [1, 2]


def test_window_minima_cover_every_window():
    r = np.random.default_rng(5)
    for values in (r.integers(1, 1 << 62, 500).astype(np.uint64), r.integers(1, 4, 500).astype(np.uint64)):
        valid = np.ones(500 - 7 + 1, bool)
        at, least = units.window_minima(values, 7, valid)
        for i in range(len(valid)):
            inside = at[(at >= i) & (at < i + 7)]
            assert len(inside) and values[inside].min() == values[i : i + 7].min() == least[i]


def test_set_marks_bound_the_difference():
    rng = np.random.default_rng(5)
    a, b = rng.integers(-(1 << 62), 1 << 62, 900), rng.integers(-(1 << 62), 1 << 62, 40)
    sets = [a[:300], np.concatenate([a[5:300], b[:7]]), a, np.concatenate([a[:880], b]), a[:0], b[:1]]
    marks = ngram_jaccard.set_marks(np.concatenate(sets), np.array([len(x) for x in sets]))
    assert marks.shape == (len(sets), ngram_jaccard.MARK_BITS // 64) and not marks[4].any()
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            apart = sum(int(w).bit_count() for w in (marks[i] ^ marks[j]).view(np.uint64))
            assert apart <= len(set(x) ^ set(y)) and (apart - len(set(x) ^ set(y))) % 2 == 0


def test_near_copies_of_a_template(spark):
    """Most pairs of the group do not link by themselves, some documents only through copies with the same changes."""
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for i in range(160):
        words = list(base if i % 3 else base[:60])
        for at in rng.choice(len(words), int(rng.integers(0, 4)), replace=False):
            words[at] = f"x{rng.integers(0, 3)}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.duplicate_groups(frame(spark, rows)).collect()}
    assert got == {d: tuple(x) for d, x in brute_components(rows).items()}


def test_word_hashes_hold_sums_of_a_piece_only():
    import tracemalloc

    r = np.random.default_rng(11)
    data = r.choice(np.frombuffer(b"abcdefgh ", np.uint8), 4 << 20)
    data[700_000:1_300_000] = ord("x")  # a word longer than a piece
    starts, ends, _ = units.words(data, np.array([0, 1000, len(data)]), units.word_mask(units.SPACES))
    roll, whole = units.Rolling(), units.Rolling()
    want = whole.span(whole.prefix(whole.bytes[data]), starts, ends)
    tracemalloc.start()
    found = roll.words(data, starts, ends)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(found, want)
    assert peak < 2 * found.nbytes + 8 * len(data)  # sums of all bytes were 32 bytes a byte and more
    assert len(roll.words(data, starts[:0], ends[:0])) == 0


def twins(size):
    """Two words of ``size`` bytes (a power of two) whose sums modulo 2**64 are equal for every base."""
    one, two = b"a", b"b"
    while len(one) < size:
        one, two = one + two, two + one
    return one, two


def test_word_hashes_tell_all_bytes_apart():
    r, lower = np.random.default_rng(3), units.lower_table()
    words = [b"a", b"a\x00", b"aaaaaaa", b"aaaaaaaa", b"AAAAAAAA", b"aaaaaaa\x00", b"\xc3\xa9t\xc3\xa9", b"x" * 300_000, b"x" * 300_001]
    words += [w for size in (512, 1024, 2048, 4096, 8192) for w in twins(size)]
    words += [bytes(r.choice(np.frombuffer(b"abAB", np.uint8), int(n))) for n in r.integers(1, 14, 20_000)]
    words += words[:9]
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends, _ = units.words(data, np.array([0, len(data)]), units.word_mask(units.SPACES))
    assert len(starts) == len(words)
    for roll in units.Rolling(), units.Rolling(base=0x165667B19E3779F9, seed=11):
        for table, want in (None, words), (lower, [w.lower() for w in words]):
            got = roll.sound_words(data, starts, ends, table)
            pairs = set(zip(want, got.tolist()))
            assert len(pairs) == len(set(want)) == len(set(got.tolist()))
    again = units.Rolling().sound_words(data, starts[5:], ends[5:])
    assert np.array_equal(again, units.Rolling().sound_words(data, starts, ends)[5:])  # pieces cut elsewhere
    assert len(units.Rolling().sound_words(data, starts[:0], ends[:0])) == 0


@pytest.mark.parametrize("size", [1024, 4096])
def test_words_that_sums_confuse_are_told_apart(spark, size):
    one, two = (x.decode() for x in twins(size))
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:30] + [one] + words[31:])), (3, " ".join(words[:30] + [two] + words[31:])), (4, " ".join(words[:30] + [two] + words[31:]))]
    long = [f"v{i}" for i in range(3000)]
    rows += [(5, " ".join(long + rows[1][1].split() + long[::-1])), (6, " ".join(long[::2] + rows[2][1].split()))]
    got = by_id(substring_rlz.remove_copied(frame(spark, rows)), "n_words", "n_removed", "kept_sha256")
    assert got == brute_words(rows, 50)
    assert got[2][1] == got[3][1] == 0 and got[4][1] == 60 and got[5][1] == got[6][1] == 60
    short = [f"w{i}" for i in range(11)]
    rows = [(i, " ".join(short[:6] + [x] + short[6:])) for i, x in enumerate((one, two, "w", one.upper()))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.duplicate_groups(frame(spark, rows)).collect()}
    assert got == {d: tuple(x) for d, x in brute_components(rows).items()} == {0: (8, 0), 1: (8, 1), 2: (8, 2), 3: (8, 0)}


def test_words_removed_with_one_worker_a_task(spark):
    """Two steps with no exchange between them take two workers for each task."""
    docs = spark.createDataFrame([(d, " ".join(f"{d % 7}-{i}" for i in range(60 + d % 3))) for d in range(40)], "doc_id long, text string").repartition(3)
    plan, above, steps = substring_rlz.remove_copied(docs)._jdf.queryExecution().executedPlan().toString(), [], []
    for line in plan.split("\n"):
        depth = re.search(r"\w", line + "x").start()
        above = [x for x in above if x[0] < depth]
        above.append((depth, line[depth:].split(" ")[0]))
        down = " ".join(name for _, name in above).rsplit("Exchange", 1)[-1]
        steps.append(down.count("MapInArrow"))
    assert max(steps) == 1


def test_filter_hands_on_a_few_rows_at_a_time(spark):
    import pyarrow as pa

    from rootline.llm import shared

    ids = np.arange(5000)
    held = shared.IdFilter(spark.createDataFrame([(int(i),) for i in ids[::3]], "doc_id long"))
    batch = pa.RecordBatch.from_arrays([pa.array(["x"] * 5000), pa.array(ids)], ["text", "doc_id"])
    kept, other = ([b.column(1).to_pylist() for b in held.step(1, wanted)(iter([batch.slice(0, 0), batch]))] for wanted in (True, False))
    assert max(map(len, kept + other)) <= shared.FILTER_ROWS
    assert sorted(sum(kept + other, [])) == ids.tolist() and set(ids[::3].tolist()) <= set(sum(kept, []))


def test_lists_of_slices_and_nulls():
    import pyarrow as pa

    want = [[1, 2], [], None, [3], [4, 5, 6], None]
    for kind in (pa.int32(), pa.int64()):
        batch = pa.RecordBatch.from_arrays([pa.array(want, pa.list_(kind))], ["x"])
        for lo in range(7):
            for n in range(7 - lo):
                found = anchored.lists(batch.slice(lo, n), "x")
                assert [x.tolist() for x in found] == [x or [] for x in want[lo : lo + n]] and all(x.dtype == np.int64 for x in found)
