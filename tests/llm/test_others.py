"""Extraction, toxicity, decontamination, licenses, search and packing."""

import hashlib
import re
import zlib
from types import SimpleNamespace

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("rootline.llm")
from rootline.llm import gbt_extract, html_dom, license_diagonals, line_winnow, mih_search, ordinal_toxicity, ss_packing, units, wu_manber  # noqa: E402


@pytest.fixture(scope="module")
def trees():
    return gbt_extract.train(300)


def texts_of(spark, trees, sources):
    df = spark.createDataFrame([(i, "u", s, 1) for i, s in enumerate(sources)], "page_id long, url string, html string, text int")
    return [r.text for r in gbt_extract.extract(df, trees).orderBy("page_id").collect()]


def test_pages_of_the_tables(spark, small, trees):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in gbt_extract.extract(pages, trees).collect()}
    import html

    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(x for x in blocks if x)
        assert got[r.page_id] == (want, len(want))


def test_held_out_layouts(spark, trees):
    sources = gbt_extract.written_pages(120, 4242)
    got = texts_of(spark, trees, sources)
    want = [gbt_extract.article_of(s) for s in sources]
    assert sum(a.replace(gbt_extract.MARK, "") == b for a, b in zip(got, want)) >= 100


def test_odd_pages(spark, trees):
    got = texts_of(spark, trees, [None, "", "<", "<div", "<p>a &amp b &lt;c&gt;", "<script>x</script>", "<p" * 3000, "text only " * 50])
    assert got[0] == got[1] == got[5] == "" and len(got) == 8


WORDS = "The valley lies between two ranges, and the river that runs through it has carried timber for many years. "


@pytest.mark.parametrize(
    "inner,want",
    [
        ("<p>The value <math><mi>x</mi><mo>=</mo><mn>3</mn></math> is shown <object data=a>fallback text</object> and kept.</p>", "The value x=3 is shown fallback text and kept."),
        ("<p>Before <noscript>plain</noscript> after <canvas>drawn</canvas> it.</p>", "Before plain after drawn it."),
        ("<p>Left <script>var a = '<p>';</script>right <svg><text>no</text></svg>end.</p>", "Left right end."),
        ("<p>One<p>Two <b>bold<p>Three</b> four", "One\nTwo bold\nThree four"),
        ("<p>Tom &amp Ann &lt;3 &#8211; &eacute;&nbsp;x</p>", "Tom & Ann <3 \u2013 \u00e9 x"),
        ("<p>5 < 6 and 7 > 2</p>", "5 < 6 and 7 > 2"),
        ("<p>a<br>b<br/>c</p><ul><li>one<li>two</ul>", "a b c\none\ntwo"),
        ("<p title='x>y'>quoted</p><p class=\"a'b\">odd</p>", "quoted\nodd"),
        ("<p>left open <i>and cut", "left open and cut"),
    ],
)
def test_text_of_broken_pages(spark, trees, inner, want):
    """Markup inside an article, broken or odd, gives exactly this text; the article stands among furniture."""
    page = f"<html><head><title>t</title></head><body><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><article><h1>The river</h1><p>{WORDS * 3}</p><p>{WORDS * 2}</p>{inner}"
    closed = page + "</article><footer>&copy; all rights</footer></body></html>" if not inner.endswith("cut") else page
    assert texts_of(spark, trees, [closed]) == ["\n".join(["The river", (WORDS * 3).strip(), (WORDS * 2).strip(), want])]


def test_pages_one_by_one(spark, trees):
    page = f"<nav><a href=/>x</a></nav><article><p>{WORDS * 400}</p></article>"
    rows = [(1, None, page, 0), (1, None, page, 0), (None, "u", page, 1), (2, "u", None, 1)]
    got = gbt_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int"), trees).collect()
    assert len(got) == 4 and [r.n_chars for r in got if r.page_id == 2] == [0]
    assert {r.text for r in got if r.page_id != 2} == {(WORDS * 400).strip()}
    assert gbt_extract.extract(spark.createDataFrame(rows[:0], "page_id long, url string, html string, n_chars int"), trees).count() == 0


def test_decoding_has_no_contradictions():
    r = np.random.default_rng(1)
    parent = [-1] + [int(r.integers(0, i)) for i in range(1, 200)]
    yes, no = -r.exponential(size=200), -r.exponential(size=200)
    keep = html_dom.decode(parent, yes, no)
    assert all(not keep[i] or keep[parent[i]] for i in range(1, 200))


def test_decoding_is_optimal():
    r = np.random.default_rng(2)
    for _ in range(20):
        parent = [-1] + [int(r.integers(0, i)) for i in range(1, 9)]
        yes, no = -r.exponential(size=9), -r.exponential(size=9)
        worth = lambda k: sum(yes[i] if k >> i & 1 else no[i] for i in range(9))
        fits = [k for k in range(512) if all(not k >> i & 1 or k >> parent[i] & 1 for i in range(1, 9))]
        keep = html_dom.decode(parent, yes, no)
        assert worth(sum(int(x) << i for i, x in enumerate(keep))) == pytest.approx(max(map(worth, fits)))


def test_toxicity_on_held_out_labels(spark, small):
    root = small.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet")
    model = ordinal_toxicity.train(docs, labels.where("doc_id % 5 <> 0"))
    held = ordinal_toxicity.score(docs, model).join(labels.where("doc_id % 5 = 0").selectExpr("doc_id", "toxic as label"), "doc_id").collect()
    bad, good = [r for r in held if r.label], [r for r in held if not r.label]
    assert sum(r.toxic for r in bad) >= 0.85 * len(bad) and sum(r.toxic for r in good) <= 0.02 * len(good)
    assert all(abs(sum(r.probabilities) - 1) < 1e-6 and 0 <= r.severity <= 3 for r in held)


def test_features_hold_sums_of_a_piece_only():
    import tracemalloc

    r = np.random.default_rng(11)
    data = r.choice(np.frombuffer(b"abcdEFGH ", np.uint8), 4 << 20)
    data[700_000:1_300_000] = ord("x")  # a word longer than a piece
    offsets, features, whole = np.array([0, 1000, len(data)]), ordinal_toxicity.Features(), units.Rolling()
    starts, ends, bounds = units.words(data, offsets, features.mask)
    row, prefix = np.repeat([0, 1], np.diff(bounds)), whole.prefix(whole.bytes[features.lower][data])
    want = [(row, whole.span(prefix, starts, ends))]
    for k in ordinal_toxicity.PREFIXES:
        long = ends - starts > k
        want.append((row[long], units.mix(whole.span(prefix, starts[long], starts[long] + k) ^ np.uint64(k))))
    tracemalloc.start()
    found = list(features.read(data, offsets))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == len(want) and all(np.array_equal(x, y) for a, b in zip(found, want) for x, y in zip(a, b))
    assert peak < 25 * len(data)  # with sums of all bytes 40 bytes a byte and more
    assert [len(x) for pair in features.read(data[:0], np.array([0, 0])) for x in pair] == [0] * 12


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "x"), (3, "x"), (None, "y")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = ordinal_toxicity.score(docs, ordinal_toxicity.train(docs, none)).collect()
    assert len(got) == 5 and not any(r.toxic for r in got)
    assert ordinal_toxicity.score(docs.limit(0), ordinal_toxicity.train(docs, none)).count() == 0


def test_toxicity_model_does_not_depend_on_the_order_of_rows(spark, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    models = [ordinal_toxicity.train(docs.repartition(n).orderBy(F.rand(n)), labels) for n in (1, 7)]
    assert (models[0][0].hashes == models[1][0].hashes).all() and len(models[0][1])
    assert (models[0][1] == models[1][1]).all() and (models[0][2] == models[1][2]).all()


def test_thresholds_share_weights():
    r = np.random.default_rng(0)
    y = r.integers(0, 4, 400)
    w, theta = ordinal_toxicity.fit(y, np.arange(400), np.zeros(400, int), y + r.normal(0, 0.3, 400), 1, 3)
    assert w[0] > 0 and list(theta) == sorted(theta)


def likelihood(y, row, col, x, w, theta):
    eta = np.zeros(len(y))
    for r, c, v in zip(row, col, x):
        eta[r] += w[c] * v
    f = lambda z: 1 / (1 + np.exp(-z))
    p = [[f(theta[0] - e), *(f(b - e) - f(a - e) for a, b in zip(theta, theta[1:])), 1 - f(theta[-1] - e)] for e in eta]
    return p, np.mean([np.log(q[k]) for q, k in zip(p, y)])


def test_fit_reaches_the_largest_likelihood():
    """Without a penalty no small move of a weight or threshold raises the likelihood, computed text by text."""
    r = np.random.default_rng(5)
    n, width = 300, 3
    row, col = np.repeat(np.arange(n), width), np.tile(np.arange(width), n)
    x = r.normal(size=n * width)
    eta = (x.reshape(n, width) @ [1.0, -0.5, 0.2]) + r.logistic(size=n)
    y = np.searchsorted([-1.0, 0.5, 2.0], eta)
    w, theta = ordinal_toxicity.fit(y, row, col, x, width, 3, steps=4000, l1=0.0, rate=0.01)
    best = likelihood(y, row, col, x, w, theta)[1]
    for i in range(width + 3):
        for step in (-0.05, 0.05):
            move = np.zeros(width + 3)
            move[i] = step
            assert likelihood(y, row, col, x, w + move[:width], theta + move[width:])[1] < best + 1e-6


def test_scores_by_brute_force(spark):
    """Severity, grade and likelihoods from the words and word beginnings of each text, one by one."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    features = ordinal_toxicity.Features()

    def hashed(name, kind):
        data = np.frombuffer(name.encode(), np.uint8)
        return [h for _, h in features.read(data, np.array([0, len(data)]))][kind][0]

    chosen = {("idiot", 0): 1.5, ("stup", 1): 0.8, ("thanks", 0): -0.7}  # whole words, and a beginning of four letters
    key = {hashed(w if k == 0 else w + "x", k): v for (w, k), v in chosen.items()}
    lookup = ordinal_toxicity.Lookup(np.array(list(key), np.uint64))
    model = lookup, np.array([key[h] for h in lookup.hashes.tolist()]), np.array([0.9, 1.6, 2.5])
    texts = ["You IDIOT idiot", "stupid stupidity thanks", "stup", "thanks", None, "", " \n", "idiot " * 30_000, "you idiot", "you idiot", "Éidiot idiot-stupé"]
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in enumerate(texts)] + [(None, "idiot", 1, "y")], "doc_id long, text string, grade int, h string").repartition(3)
    got = {r.doc_id: r for r in ordinal_toxicity.score(df, model, chunk=1000).collect()}
    assert len(got) == len(texts) + 1
    for i, t in [*enumerate(texts), (None, "idiot")]:
        found = words(t)
        n = {("idiot", 0): found.count("idiot"), ("stup", 1): sum(len(x.encode()) > 4 and x.encode()[:4] == b"stup" for x in found), ("thanks", 0): found.count("thanks")}
        p, _ = likelihood([0], [0] * 3, range(3), [np.log1p(n[c]) for c in chosen], list(chosen.values()), model[2])
        over = [sum(p[0][k + 1 :]) for k in range(3)]
        assert got[i].probabilities == pytest.approx(p[0], abs=1e-9) and got[i].severity == pytest.approx(sum(over))
        assert got[i].grade == sum(x >= 0.5 for x in over) and got[i].toxic == (got[i].grade > 0)


def brute_hits(docs, items, window):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    patterns = {}
    for i, t in items:
        w = words(t)
        m = min(window, len(w))
        for k in range(len(w) - m + 1 if m and i is not None else 0):
            patterns.setdefault(tuple(w[k : k + m]), set()).add(str(i))
    out = {}
    for d, t in docs:
        w, hit, seen = words(t), set(), set()
        for m in {len(p) for p in patterns}:
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in patterns:
                    hit.update(range(k, k + m))
                    seen |= patterns[tuple(w[k : k + m])]
        out[d] = (len(w), len(hit), len(seen), hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("block_words", [2_000_000, 20])
def test_benchmark_hits(spark, block_words):
    import random

    r = random.Random(3)
    words = lambda k: " ".join(r.choice(["A", "b", "cé", "d1", "e"]) for _ in range(k))
    items = [(i, words(r.choice([1, 3, 6, 7, 20]))) for i in range(2, 12)] + [(2, None), (None, "b b b b"), (50, "..."), (51, "zq"), (51, "zq")]
    docs = [(i, words(r.randint(0, 80))) for i in range(40)] + [(98, "zQ, " * 3), (99, None), (97, ""), (96, "x " * 5000 + items[0][1])]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, items int").repartition(3)
    found = wu_manber.find_benchmark(df, spark.createDataFrame(items, "item_id long, text string"), 7, block_words=block_words, chunk=500, lane=16)
    assert {x.doc_id: (x.n_words, x.n_hit, x.n_items, x.items_sha256, x.contaminated) for x in found.collect()} == brute_hits(docs, items, 7)


@pytest.mark.parametrize("block_words", [2_000_000, 2])
def test_benchmark_hits_of_repeated_rows(spark, block_words):
    items = spark.createDataFrame([(1, "a b c d e f g"), (2, "h i j k l m n"), (3, "q r s t u v w")], "item_id long, text string")
    rows = [(1, "x a b c d e f g h i j k l m n")] * 3 + [(None, "q r s t u v w")] * 2 + [(None, "none")] * 2 + [(4, None)] * 2 + [(1, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = wu_manber.find_benchmark(df, items, 7, block_words=block_words)
    want = [(1, 15, 14, 2)] * 3 + [(None, 7, 7, 1)] * 2 + [(None, 1, 0, 0)] * 2 + [(4, 0, 0, 0)] * 2 + [(1, 1, 0, 0)]
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in found.collect()), key=str) == sorted(want, key=str)


def test_empty_benchmark(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [(r.n_words, r.n_hit, r.contaminated) for r in wu_manber.find_benchmark(docs, spark.createDataFrame([], "item_id long, text string")).collect()] == [(2, 0, False)]
    assert wu_manber.find_benchmark(docs.limit(0), docs.selectExpr("doc_id as item_id", "text")).count() == 0


def test_licenses(spark):
    notice = license_diagonals.NOTICES[0][0].replace("charge to", "charge, XX to").upper()
    rows = [(1, "Under the MIT License. CC BY mit-license"), (2, notice), (3, None), (4, ""), (5, "apache"), (6, "a " * 30000 + "GNU General  Public\nLicense"), (6, "zz")]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, score int")
    got = {r.doc_id: r for r in license_diagonals.scan(df).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels, got[1].score) == (8, 3, 2, 6, "cc-by,mit", 1.0)
    assert got[2].labels == "mit-text" and got[2].n_base == 0 and got[2].first_word is None and 0.7 <= got[2].score < 1
    assert (got[3].n_words, got[4].n_words, got[5].labels) == (0, 0, "") and got[6].base_labels == "gpl" and got[6].n_words == 30004
    assert license_diagonals.scan(df.limit(0)).count() == 0


def shares(words, template, reach):
    """Share of the template's 2-grams that stand in order, for each diagonal that a 2-gram of the text votes for."""
    grams = list(zip(template, template[1:]))
    hits = [(i - p, p) for i, g in enumerate(zip(words, words[1:])) for p, h in enumerate(grams) if g == h]
    out = {}
    for d in {d for d, _ in hits}:
        places = {}
        for e, p in sorted(hits):
            if d <= e <= d + reach:
                places.setdefault(p, e + p)
        at = [places[p] for p in sorted(places)]
        out[d] = (1 + sum(y > x for x, y in zip(at, at[1:]))) / len(grams)
    return out


def test_licenses_stand_in_order(spark):
    r, texts, firsts = np.random.default_rng(5), [], []
    for t, (words, _, base) in enumerate(license_diagonals.TEMPLATES):
        firsts.append(len(texts))
        grams = [" ".join(g) for g in zip(words, words[1:])]
        texts += ["x " * t + " ".join(words), " and ".join(grams[::-1]), " and ".join(r.permutation(grams)), " ".join(words[::-1])]
        for _ in range(6 * (not base)):
            w = list(words) * int(r.integers(1, 3))
            for _ in range(int(r.integers(1, 9))):
                at = int(r.integers(0, len(w)))
                if r.random() < 0.5:
                    w.insert(at, str(r.choice(words)))
                else:
                    del w[at]
            texts.append(" ".join(w))
    got = {x.doc_id: x for x in license_diagonals.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    kept = 0
    for d, text in enumerate(texts):
        best, labels = 0.0, set()
        for words, label, base in license_diagonals.TEMPLATES:
            found = max(shares(text.split(), words, 0 if base else license_diagonals.REACH).values(), default=0)
            if found >= (1 if base else 0.7):
                best, labels = max(best, found), labels | {label}
        assert got[d].labels == ",".join(sorted(labels)) and abs(got[d].score - best) < 1e-9
        for x in got[d].spans:
            kept += 1
            assert 0 <= x.stop - x.start and x.label in labels
    assert kept > 60
    for first, (words, label, _) in zip(firsts, license_diagonals.TEMPLATES):
        whole, backward, mixed, reverse = (got[first + i] for i in range(4))
        assert label in whole.labels.split(",") and whole.score == 1.0
        if len(words) > 7:
            assert all(label not in x.labels.split(",") for x in (backward, mixed, reverse))


@pytest.mark.parametrize("segments", [4, 8])
def test_nearest_codes(spark, segments):
    r = np.random.default_rng(segments)
    vectors = r.normal(size=(300, 64))
    vectors[50:200] = vectors[0]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(None, [1.0] * 64), (900, None), (901, [1.0, None]), (5, [-1.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    codes = {r.id: r.code for r in mih_search.sign_codes(df).collect()}
    got = {}
    for x in mih_search.top_k(df, 5, every=50, segments=segments, block=3).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.distance, x.neighbor_id))
    for q in (i for i in codes if i % 50 == 0):
        near = sorted((bin((codes[q] ^ c) & (2**64 - 1)).count("1"), i) for i, c in codes.items() if i != q)[:5]
        assert sorted(got[q]) == [(k + 1, d, i) for k, (d, i) in enumerate(near)]
    assert mih_search.top_k(df.limit(0)).count() == 0


def check_packing(rows, texts, size, ids_of):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for d, t in texts.items():
        ids, at = np.array(ids_of(t) + [1], np.uint32), 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and zlib.crc32(ids[at : at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == size or at & (at - 1) == 0 and at < size


def test_packing(spark, small):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(ss_packing.vocabulary())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()}
    texts |= {10_000: None, 10_001: "", 10_002: "  two  spaces \n\n\t x", 10_003: "<|endoftext|> it's 3.14! ok \U0001f600", 10_004: "long " * 9000}
    df = spark.createDataFrame([(d, t, 0) for d, t in texts.items()], "doc_id long, text string, length int").repartition(3)
    rows = ss_packing.pack(df, ss_packing.vocabulary(), 512).collect()
    check_packing(rows, texts, 512, lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids)
    assert ss_packing.pack(df.limit(0), ss_packing.vocabulary()).count() == 0


def test_level_minimises_the_sum_of_squares():
    r = np.random.default_rng(0)
    for _ in range(50):
        levels = ss_packing.Levels(16)
        for h in np.repeat(np.arange(1, 16), r.integers(0, 4, 15)):
            levels.add(int(h), [])
        n = int(r.integers(1, 16))

        def after(h):
            c = np.array(levels.count)
            c[h] -= h > 0
            if h + n < 16:
                c[h + n] += 1
            return int((c[1:] ** 2).sum())

        fits = [h for h in range(0, 16 - n + 1) if h == 0 or levels.count[h] > 0]
        assert after(levels.place(n)) == min(map(after, fits))


def test_full_levels_cut_by_the_sum_of_squares():
    r = np.random.default_rng(1)
    for _ in range(50):
        levels = ss_packing.Levels(16, most=4)
        for h in [*r.integers(1, 16, 4), 3, 3]:
            levels.add(int(h), [])
        n = int(r.integers(1, 16))

        def after(h):
            c = np.array(levels.count)
            c[h] -= 1
            if (h + n) % 16:
                c[(h + n) % 16] += 1
            return int((c[1:] ** 2).sum())

        assert after(levels.place(n)) == min(after(h) for h in range(1, 16) if levels.count[h])


def test_ids_of_all_documents(spark, small):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(ss_packing.vocabulary())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    hard = [" ", "a \n b", "a\t b", "it's 's x 't", " \u00a0 b", "a\u2003b \u3000 c", "<|endoftext|> a", "1 2 3.5", "\x00 a", "\n a \n", "e\u0301 e", " x", "x ", "a,b a, a.. a!? a.b a,' a.'s don't, é. ß?! x,1 ١.", "a.\n b,\t c"]
    texts |= {-1 - i: t for i, t in enumerate(hard)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    rows = ss_packing.pack(df, ss_packing.vocabulary()).collect()
    check_packing(rows, texts, 2048, lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids)


def test_ids_of_joined_words():
    import random

    from tokenizers import Tokenizer

    tokenizer, encoder, r = Tokenizer.from_file(ss_packing.vocabulary()), ss_packing.Encoder(ss_packing.vocabulary(), 500), random.Random(3)
    fixed = ["a \u00a0 \u00a0 b", " \u00a0 \u00a0", "1 \u00a0 \u00a0 1", "x\u00a0 y \u00a0z", "a\n \nb", "b\u00a0 \n \u00a0 c.", ""]
    drawn = ["".join(r.choice(kind) for _ in range(r.randint(1, 30))) for kind in (r.sample("ab'st\u00e9.,!-1\n\t\r\u00a0\u2003\u3000\u0120\u4e00\x85", 6) + [" "] * 3 for _ in range(3000))]
    for text in fixed + drawn:
        assert encoder.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("most", [1, 2, 16])
def test_packing_holds_every_id_with_few_open_windows(spark, small, most):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(ss_packing.vocabulary())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(80).collect()} | {10_000: None, 10_001: "long " * 900}
    rows = ss_packing.pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2), ss_packing.vocabulary(), 256, most=most).collect()
    check_packing(rows, texts, 256, lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids)


def test_words_of_many_texts_are_encoded_together(monkeypatch):
    import pyarrow as pa

    class Counting:
        def __init__(self, inner):
            self.inner, self.calls = inner, 0

        def __getattr__(self, name):
            self.calls += name.startswith("encode")
            return getattr(self.inner, name)

    class Task:
        select = lambda self, *names: self
        mapInArrow = lambda self, step, schema: step
        get = classmethod(lambda cls: cls)
        partitionId = staticmethod(lambda: 0)

    encoder = ss_packing.Encoder(ss_packing.vocabulary(), 1000)
    encoder.tokenizer = counting = Counting(encoder.tokenizer)
    monkeypatch.setattr(ss_packing.Encoder, "of_worker", classmethod(lambda *a: encoder))
    monkeypatch.setattr(ss_packing, "TaskContext", Task)
    texts = {d: f"the word{d} of{d} a." + " text, and" * (d % 7) for d in range(300)}
    batch = pa.record_batch({"doc_id": pa.array(list(texts), pa.int64()), "text": list(texts.values())})
    rows = [SimpleNamespace(**r) for out in ss_packing.pack(Task(), "", 64)([batch]) for r in out.to_pylist()]
    assert counting.calls < 30
    check_packing(rows, texts, 64, lambda t: counting.inner.encode(t, add_special_tokens=False).ids)


def test_ids_of_texts_encoded_in_parts(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    letters = [chr(c) for c in range(1, 0x110000) if chr(c).isalpha() and not 0x3400 <= c <= 0x9FFF and not 0x17000 <= c <= 0x18CFF and not 0x20000 <= c]
    texts = [None, "", "x", " ", "a", "<|endoftext|> a.", "b  c", None, "\u00a0 d e!", "no\nspace", "y" * 70000 + " z", " ".join("w" * 300 + str(i) for i in range(300))]
    texts += [" ".join(f"{a}{b}. {a}?!" for a, b in zip(letters[i : i + 50], letters[i + 1 :])) for i in range(0, len(letters), 50)] + ["", None, "a. b", "a. b"]
    tokenizer = Tokenizer.from_file(ss_packing.vocabulary())
    for size, cache, kind in [(1, 100, pa.string()), (300, 10, pa.large_string()), (1 << 24, 10**6, pa.string())]:
        monkeypatch.setattr(ss_packing.Encoder, "TEXTS", size)
        encoder = ss_packing.Encoder(ss_packing.vocabulary(), cache)
        got = [(i, ids.tolist()) for i, ids in encoder.parts(pa.array([None, *texts], kind).slice(1))]
        assert got == [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in enumerate(texts)]
    assert list(encoder.parts(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("module,name", [(line_winnow, "op5_line_winnow"), (wu_manber, "op6_wu_manber"), (license_diagonals, "op7_license_diagonals"), (mih_search, "op8_mih_search")])
def test_oracle(spark, small, module, name):
    from tests.test_oracle import plain

    from rootline.llm.queries import ORACLE

    import os

    c = duckdb.connect()
    for table in os.listdir(small):
        c.execute(f"create view {table.removesuffix('.parquet')} as select * from '{small}/{table}'")
    df, found = getattr(module, name)(spark, small), c.execute(ORACLE[name])
    columns = [x[0] for x in found.description]
    order, key = sorted(columns), lambda r: tuple((x is None, str(x)) for x in r)
    assert order == sorted(df.columns)
    want = sorted((tuple(plain(r[columns.index(x)]) for x in order) for r in found.fetchall()), key=key)
    assert sorted((tuple(plain(r[x]) for x in order) for r in df.collect()), key=key) == want
