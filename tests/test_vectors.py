"""Density clusters, projection, places and text vectors against plain computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rootline.operators import clusters, density, vectors


def blobs(seed, sizes, width=8, spread=0.05):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(len(sizes), width))
    x = np.concatenate([c + r.normal(scale=spread * (1 + i), size=(n, width)) for i, (c, n) in enumerate(zip(centers, sizes))] + [r.normal(scale=2, size=(20, width))])
    return x[r.permutation(len(x))].astype(np.float32)


def table(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>").repartition(3)


def hierarchy(x, min_size):
    """Clusters by cutting the longest edge again and again, over sets of members."""
    x = x.astype(np.float64)
    far = np.rint(np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)) * 1e6) / 1e6
    core = np.sort(far, axis=1)[:, min_size]
    far = np.maximum(far, np.maximum(core[:, None], core[None]))
    n, group, tree = len(x), list(range(len(x))), []
    for d, a, b in sorted((far[a, b], a, b) for a in range(n) for b in range(a + 1, n)):
        if group[a] != group[b]:
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
            tree.append((d, a, b))

    def parts(members, edges):
        near = {m: [] for m in members}
        for _, a, b in edges:
            near[a].append(b)
            near[b].append(a)
        seen, todo = set(), [min(members)]
        while todo:
            m = todo.pop()
            if m not in seen:
                seen.add(m)
                todo += near[m]
        return seen, members - seen

    def grow(members, edges, began, root=False):
        stable, rest, kept = 0.0, members, []
        while edges:
            edges = sorted(edges)
            d = 1 / max(edges[-1][0], 1e-6)
            one, other = parts(rest, edges[:-1])
            inside = lambda s: [e for e in edges[:-1] if e[1] in s]
            big = [s for s in (one, other) if len(s) >= min_size]
            stable += sum(len(s) for s in (one, other) if s not in big or len(big) == 2) * (d - began)
            if len(big) == 2:
                kept = [grow(s, inside(s), d) for s in big]
                break
            if not big:
                break
            rest, edges = big[0], inside(big[0])
        below = sum(s for s, _ in kept)
        if root or (kept and below > stable):
            return below, [c for _, cs in kept for c in cs]
        return stable, [members]

    found = grow(set(range(n)), tree, 0.0, True)[1]
    out = np.full(n, -1)
    for i, members in enumerate(sorted(found, key=min)):
        out[list(members)] = i
    return out


@pytest.mark.parametrize("seed,sizes,min_size", [(1, [60, 40, 30], 10), (2, [25, 25, 25, 80], 5), (3, [50], 8), (4, [12, 12], 3)])
def test_density_clusters_are_the_hierarchy(spark, seed, sizes, min_size):
    x = blobs(seed, sizes)
    got = {r.vec_id: r.cluster for r in density.density_clusters(table(spark, x), min_size).collect()}
    assert [got[i] for i in range(len(x))] == hierarchy(x, min_size).tolist()


def test_density_clusters_of_two_thousand(spark):
    x = blobs(5, [700, 500, 400, 250, 130])
    got = {r.vec_id: r.cluster for r in density.density_clusters(table(spark, x), 15).collect()}
    assert [got[i] for i in range(len(x))] == hierarchy(x, 15).tolist() and max(got.values()) >= 4


def test_density_clusters_of_odd_tables(spark):
    same = np.ones((30, 4), np.float32)
    got = density.density_clusters(table(spark, np.concatenate([same, -same])), 5).collect()
    assert sorted((r.cluster, r.vec_id) for r in got) == [(i // 30, i) for i in range(60)]
    assert [r.cluster for r in density.density_clusters(table(spark, same[:5]), 5).collect()] == [-1] * 5
    empty = spark.createDataFrame([(None, [1.0]), (1, None)], "vec_id long, embedding array<float>")
    assert density.density_clusters(empty, 5).isEmpty()
    with pytest.raises(ValueError):
        density.density_clusters(table(spark, same), 5, most=10, overflow="fail")
    with pytest.raises(ValueError):
        density.density_clusters(table(spark, same), mode="slow")
    assert density.density_clusters(table(spark, blobs(1, [40, 40])), 5, mode="fast").count() == 100


def test_rows_beyond_the_sample_are_placed(spark):
    x = blobs(6, [300, 200, 100])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = {r.vec_id: r.cluster for r in density.density_clusters(table(spark, x), 10, most=200).collect()}
    at = [i * (len(x) - 1) // 199 for i in range(200)]
    found = hierarchy(x[at], 10)
    centers = np.array([x[at][found == c].astype(np.float64).mean(axis=0) for c in range(found.max() + 1)])
    centers /= np.linalg.norm(centers, axis=1, keepdims=True)
    assert [got[i] for i in range(len(x))] == np.argmax(x @ centers.T, axis=1).tolist()


@pytest.mark.parametrize("block", [3, 4096])
def test_nearest_of_any_number_of_centers(spark, block):
    x, c = blobs(7, [50]), blobs(8, [10])[:11]
    c[5] = c[2]
    centers = spark.createDataFrame([(f"c{i:02d}", v.tolist()) for i, v in enumerate(c)], "name string, c array<float>")
    got = {r.vec_id: r.nearest for r in vectors.nearest_of(table(spark, x), centers, "name", block).collect()}
    assert [got[i] for i in range(len(x))] == [f"c{j:02d}" for j in np.argmax(x.astype(np.float64) @ c.astype(np.float64).T, axis=1)]


def test_places_in_a_group(spark):
    rows = [(g, i % 50, i) for g in ("a", None, "b") for i in range(200)] + [("one", 0, 0)]
    df = spark.createDataFrame(rows, "g string, us long, event_id long").repartition(5)
    got = {(r.g, r.event_id): (r._r, r._n) for r in clusters.numbered(df, ["g"], ["us", "event_id"]).collect()}
    for g in ("a", None, "b"):
        assert [got[g, i] for _, i in sorted((i % 50, i) for i in range(200))] == [(k, 200) for k in range(200)]
    assert got["one", 0] == (0, 1)


def said(seed, n):
    r = np.random.default_rng(seed)
    topics = [["disk", "full", "write"], ["login", "denied", "user"], ["node", "down", "restart"], ["größe", "日本", "x_1"]]
    return [" ".join(r.choice(topics[i % 4], 4)) + f" id{r.integers(30)} the" for i in range(n)]


def test_text_vectors_keep_the_cosines_of_their_rank(spark):
    import zlib

    from rootline.operators import textvec

    texts = said(1, 120) + ["", "the", None, "The  THE", said(1, 1)[0]]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "embedding_text string, at int").repartition(4)
    got = {r.embedding_text: np.array(r.embedding) for r in textvec.text_vectors(df, dims=6, features=512).collect()}
    assert set(got) == {t or "" for t in texts}
    again = {r.embedding_text: np.array(r.embedding) for r in textvec.text_vectors(df.repartition(2), dims=6, features=512).collect()}
    assert all(np.allclose(got[t], again[t], atol=1e-5) for t in got)
    import re

    names = sorted(got)
    x = np.zeros((len(names), 512))
    for i, t in enumerate(names):
        for w in re.findall(r"\w+", t.lower()):
            x[i, zlib.crc32(w.encode()) % 512] += 1
    x *= np.log((len(names) + 1) / ((x > 0).sum(axis=0) + 1))
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    best = x @ vt[:6].T
    best /= np.linalg.norm(best, axis=1, keepdims=True) + 1e-12
    have = np.array([got[t] for t in names])
    assert np.abs(have @ have.T - best @ best.T).max() < 0.02
    assert np.abs(got[""]).max() == 0 and np.allclose(np.linalg.norm(got[texts[0]]), 1, atol=1e-4)
    # neighbours by all words and by main directions mostly agree in topic
    near = np.argmax(have @ have.T - 2 * np.eye(len(have)), axis=1)
    topic = [{"disk": 0, "full": 0, "write": 0, "login": 1, "denied": 1, "user": 1, "node": 2, "down": 2, "restart": 2}.get(t.split(" ")[0], 3) for t in names]
    spoken = [i for i, t in enumerate(names) if len(t) > 8]
    assert sum(topic[i] == topic[near[i]] for i in spoken) >= 0.9 * len(spoken)


def test_text_vectors_of_no_rows_and_of_a_model(spark):
    from rootline.operators import textvec

    df = spark.createDataFrame([("ab",), (None,), ("ab",), ("c",)], "embedding_text string")
    assert textvec.text_vectors(df.limit(0)).isEmpty()

    def make():
        return lambda texts: [[len(t), 1.0] for t in texts]

    assert sorted((r.embedding_text, r.embedding) for r in textvec.modelled_vectors(df, make).collect()) == [("", [0.0, 1.0]), ("ab", [2.0, 1.0]), ("c", [1.0, 1.0])]
