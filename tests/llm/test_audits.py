"""Source divergence, class language model and Merkle manifest against brute force."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

pytest.importorskip("rootline.llm")
from rootline.llm import merkle_manifest as merkle  # noqa: E402

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, tmp_path, rows, schema=DOC):
    df = spark.createDataFrame(rows, schema)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def siblings(nodes, at):
    """Root of a list of digests, and for one place the siblings (left, right) level by level."""
    found = []
    while len(nodes) > 1:
        run = at - at % 16
        found.append((nodes[run:at], nodes[at + 1 : run + 16]))
        nodes = [sha(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        at //= 16
    return nodes[0], found


def manifest_of(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf_of(*r), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda x: x[:3])
    tops = [siblings([x[2] for x in groups[s]], 0)[0] for s in order]
    out = []
    for i, s in enumerate(order):
        root, above = siblings(tops, i)
        for j, (there, doc_id, leaf, r) in enumerate(groups[s]):
            path = siblings([x[2] for x in groups[s]], j)[1] + above
            changed = leaf
            if there and zlib.crc32(str(doc_id).encode()) % 5 == 0 and r[1] is not None:
                changed = leaf_of(r[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]), *r[2:])
            for a, b in path:
                changed = sha(*a, changed, *b)
            out.append((r[0], leaf, tops[i], root, sha(*[x for a, b in path for x in a + b]), changed, changed == root))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest_is_brute_force(spark, tmp_path, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows = [(i * 7, f"Text {i} ÄÉ" if i % 3 else f"text {i}", "en", f"s{'hot' if i % 2 else i % 40}", i) for i in range(700)]
    rows += [(1, None, None, None, None), (2, "", "", "", 0), (None, "No id", "en", "", 3), (2, "", "", "", 0), (3, "A" * 300_000, "de", "\U0001f600", 9), (4, "x", "de", "￮", 9)]
    sf = table(spark, tmp_path, rows)
    assert got(merkle.op13_merkle_manifest(spark, sf)) == manifest_of(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17])
def test_manifest_of_few_rows(spark, tmp_path, n):
    rows = [(i, "Ab", "en", "only", 2) for i in range(n)]
    assert got(merkle.op13_merkle_manifest(spark, table(spark, tmp_path, rows))) == manifest_of(rows)


def test_manifest_proofs_fold_and_other_columns_are_ignored(spark):
    docs = spark.createDataFrame([(i, "T", "en", "s", 1, "x", 5, 7) for i in range(20)], DOC + ", digest string, pos int, g int")
    found = merkle.manifest(docs).withColumn("again", merkle.folded(F.col("leaf"), F.col("proof"))).collect()
    assert len(found) == 20 and all(r.again == r.root for r in found)
    assert [len(r.proof) for r in found] == [2] * 20


def audit_of(rows, least=3, ranks=200):
    """Every term with every source, in whole numbers of any size."""
    import re

    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        kept = sorted({t for d in own for t in d[2] if sum(t in e[2] for e in own) >= least})
        sources = sorted({d[1] for d in own})
        counts = {s: {t: sum(d[2].count(t) for d in own if d[1] == s) for t in kept} for s in sources}
        counts[None] = {t: sum(counts[s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10**9 * (n[t] + 1) // (sum(n.values()) + len(kept)) for t in kept} for s, n in counts.items()}
        value = lambda s, o, t: (p[s][t] - p[o][t]) ** 2 // p[o][t]
        for s in sources:
            pair = sorted((-sum(value(s, o, t) for t in kept), o.encode(), o) for o in sources if o != s)
            term = sorted((-value(s, None, t), t.encode(), t) for t in kept if counts[s][t] and p[s][t] > p[None][t])[:ranks]
            for part, found in (("pair", pair), ("term", term)):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(found)]
    return sorted(out, key=str)


def words(seed, n):
    import random

    r = random.Random(seed)
    return " ".join(r.choice(["the", "The", "a", "of", "straße", "日本", "x1y", f"w{r.randrange(9)}", f"rare{'abcdefghij'[r.randrange(10)]}"]) for _ in range(n))


AUDITED = [
    *[(words(i, 3 + i % 40), "en" if i % 4 else "de", f"s{'0' if i % 3 else i % 7}") for i in range(120)],
    (None, "en", "s1"), ("", None, None), ("the the the", None, ""), (None, "fr", "only"), ("one two", "fr", "other"), ("the", "en", None), ("the", "en", None), ("\x00the\ttHE", "en", "\U0001f600"), ("a " * 200_000, "de", "long"), ("z" * 700_000, "de", "long"),
]


@pytest.mark.parametrize("held", [3, 400_000])
def test_divergence_is_brute_force(spark, monkeypatch, held):
    from rootline.llm import divergence_audit

    monkeypatch.setattr(divergence_audit, "HELD", held)
    docs = spark.createDataFrame([(*r, 1, 2) for r in AUDITED], "text string, lang string, source string, n int, m int")
    assert got(divergence_audit.audit(docs)) == audit_of(AUDITED)
    assert got(divergence_audit.audit(docs, 2, 3)) == audit_of(AUDITED, 2, 3)
    assert got(divergence_audit.audit(docs.limit(0))) == []


def test_divergence_is_the_sql(spark, small):
    import duckdb

    from rootline.llm.divergence_audit import OP11_SQL, op11_divergence_audit

    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{small}/documents.parquet'")
    df = op11_divergence_audit(spark, small)
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert got(df) == sorted(c.execute(OP11_SQL).fetchall(), key=str)


def test_shares_of_large_counts(spark):
    from rootline.llm.divergence_audit import share

    pairs = [(0, 1), (1, 9_000_000_000_000_000), (8_999_999_999_999_998, 9_000_000_000_000_000), (10**15 + 7, 7 * 10**15 + 3), (5, 7)]
    df = spark.createDataFrame(pairs, "n long, total long")
    assert [r.p for r in df.select("n", share(F.col("n"), F.col("total")).alias("p")).collect()] == [1 + 10**9 * (n + 1) // t for n, t in pairs]


@pytest.mark.parametrize("data", [b"", b" ", b"ab cd", b"x" * 1000, b"ab " * 300, b"a" * 63 + b" b", b"\xc3\xa4" * 99 + b"\n" + b"y" * 65])
def test_pieces_split_no_word(monkeypatch, data):
    from rootline.llm import units

    monkeypatch.setattr(units, "PIECE", 7)
    same = bytes(range(256))
    assert [w for p in units.cut(data, same) for w in p.split()] == data.split() and b"".join(units.cut(data, same)) == data


def ascii_words(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()


def model_of(rows, k, rounds, sweeps):
    """Classes, counts and probabilities, word by word in plain loops."""
    import math
    from collections import Counter

    train = [ascii_words(t) + [b"\n"] for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    n = Counter(w for t in train for w in t)
    order = sorted(n, key=lambda w: (-n[w], w))
    cls = {w: min(i, k - 1) for i, w in enumerate(order)}
    for _ in range(rounds):
        near = {w: Counter() for w in n}
        for t in train:
            for i, w in enumerate(t):
                near[w][cls[t[i - 1]] if i else k] += 1
                near[w][k + 1 + (cls[t[i + 1]] if i + 1 < len(t) else k)] += 1
        moving = dict(cls)
        for _ in range(sweeps):
            table = [[0.0] * (2 * k + 2) for _ in range(k)]
            for w in n:
                for c, x in near[w].items():
                    table[moving[w]][c] += x
            log = []
            for c in range(k):
                line = []
                for side in (0, k + 1):
                    plain = [sum(table[d][side + j] for d in range(k)) + 1e-3 for j in range(k + 1)]
                    line += [math.log((table[c][side + j] + plain[j] / sum(plain)) / (sum(table[c][side : side + k + 1]) + 1)) for j in range(k + 1)]
                log.append(line)
            moving = {w: max(range(k), key=lambda c: (sum(x * log[c][j] for j, x in near[w].items()), -c)) for w in n}
        cls = moving
    after, total = Counter(), sum(n.values())
    for t in train:
        after.update(zip(["start"] + [cls[w] for w in t], [cls[w] for w in t]))
    of_class = Counter()
    for w in n:
        of_class[cls[w]] += n[w]
    unknown = (sum(x == 1 for x in n.values()) + 1) / (total + sum(x == 1 for x in n.values()) + 1)

    def p(w, before):
        if w not in n:
            return unknown
        c = cls[w]
        seen = sum(after[before, d] for d in range(k))
        return (1 - unknown) * (after[before, c] + 100 * of_class[c] / total) / (seen + 100) * n[w] / of_class[c]

    def scores(text):
        t, before, out = ascii_words(text) + [b"\n"], "start", [0.0, 0.0]
        for w in t:
            out[0] += math.log10((n[w] + 1) / (total + len(n) + 1))
            out[1] += math.log10(p(w, before))
            before = cls.get(w, "unknown")
        return (len(t), sum(w in n for w in t), total, *out)

    return n, cls, p, scores


SPOKEN = [(i, " ".join(f"{a} {b}" for a, b in zip(words(i, 20 + i % 30).split(), ["Runs", "sees", "näher", "x"] * 20))) for i in range(150)]
SPOKEN += [(1000, None), (1001, ""), (1002, " \t\n"), (None, "the runs"), (None, "the runs"), (1003, "the runs"), (1003, "a sees"), (1004, "only here " * 300), (1005, "y" * 600_000), (1006, "the the"), (1007, "never seen words\x00here")]


@pytest.mark.parametrize("k,rounds,sweeps,chunk", [(6, 1, 1, 8 << 20), (6, 2, 3, 50), (1, 1, 2, 50)])
def test_model_is_brute_force(spark, monkeypatch, k, rounds, sweeps, chunk):
    from rootline.llm import class_lm

    monkeypatch.setattr(class_lm, "CHUNK", chunk)
    docs = spark.createDataFrame([(*r, 1, 2) for r in SPOKEN], "doc_id long, text string, chunk int, words int")
    trains = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    found, classes, figures = class_lm.language_model(docs, trains, k, rounds, sweeps)
    n, cls, p, scores = model_of(SPOKEN, k, rounds, sweeps)
    assert {bytes(r.word): (r.n, r.cls) for r in classes.collect()} == {w: (n[w], cls[w]) for w in n}
    rows = found.collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[4])
    want = sorted(((i, i is None or zlib.crc32(str(i).encode()) % 7 != 2, *scores(t)[:2], *scores(t)[3:]) for i, t in SPOKEN), key=key)
    have = sorted(map(tuple, rows), key=key)
    assert [r[:4] for r in have] == [r[:4] for r in want] and figures["tokens"] == sum(n.values())
    assert [r[4:] for r in have] == [pytest.approx(r[4:], rel=1e-9) for r in want]
    for before in ["start", "unknown", *range(k)]:
        assert sum(p(w, before) for w in [*n, b"\n never"]) == pytest.approx(1)
    for began in figures["likelihood"]:
        assert all(b >= a - 3.0 for a, b in zip(began, began[1:]))  # smoothing moves it by little


def test_model_of_no_rows_and_of_no_training_rows(spark):
    from rootline.llm import class_lm

    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found, classes, _ = class_lm.language_model(docs, F.lit(False), 3)
    assert [(r.n_tokens, r.n_known, r.base_score, r.score) for r in found.orderBy("doc_id").collect()] == [(3, 0, 0.0, 0.0), (1, 0, 0.0, 0.0)] and classes.isEmpty()
    assert class_lm.language_model(docs.limit(0), F.lit(True), 3)[0].isEmpty()


def test_model_is_better_than_single_words(spark, small):
    from rootline.llm import class_lm

    rows = [r for r in class_lm.op12_class_lm(spark, small).collect() if r.held_out]
    assert sum(r.score for r in rows) > 0.95 * sum(r.base_score for r in rows)
