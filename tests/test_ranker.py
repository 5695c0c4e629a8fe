"""The ranking of an incident's clusters against the formulas written out, and provenance by hand."""

import math
import statistics

from rootline.operators import bundles, clusters, ranker

M = 1_000_000
EVENTS = [  # cluster, second, code, severity
    *[("A", s, 500, "ERROR") for s in (100, 101, 102, 103, 130, 140, 150)],
    *[("B", s, 403, "WARN") for s in (90, 118, 125)],
    *[("C", s, 200, "INFO") for s in range(100, 400, 4)],
    *[("D", s, None, "warning") for s in (500, 501)],
    ("E", 260, 404, "WARN"),
    ("X", 100, 500, "ERROR"),
]
EDGES = [("A", "B", 0.9), ("A", "X", 0.8), ("B", "E", 0.7), ("E", "D", 0.7), ("X", "A", 0.9)]
STATS = {"A": (0.9, 7), "B": (0.4, 3), "C": (0.1, 0), "D": (0.6, 6), "E": (0.55, 1)}
TYPES = {"A": "candidate", "B": "contextual", "C": "baseline", "D": "minor_pattern"}
START, END = 100, 420


def by_hand():
    members = ["A", "B", "C", "D", "E"]
    own = {m: [e for e in EVENTS if e[0] == m] for m in members}
    every = [e for m in members for e in own[m]]
    split = statistics.median(e[1] for e in every)
    bad = lambda e: e[2] >= 400 if e[2] else e[3].upper() in ("ERROR", "WARN", "WARNING")
    onset = min((e[1] for e in every if START <= e[1] <= END and bad(e)), default=START)
    sub = [e for e in EDGES if e[0] in members]
    scores = {}
    for m in members:
        if not (STATS[m][0] > 0.5 or STATS[m][1] > 5):
            continue
        size, first = len(own[m]), min(e[1] for e in own[m])
        out, into = sum(w for a, _, w in sub if a == m), sum(w for _, b, w in sub if b == m)
        after, todo = set(), [m]
        for _ in range(4):
            todo = [b for t in todo for a, b, _ in EDGES if a == t and b not in after and not after.add(b)]
        direct = {b for a, b, _ in EDGES if a == m}
        change = sum(1 if e[1] >= split else -1 for e in own[m]) / size
        level = [e[3].upper().replace("WARNING", "WARN") for e in own[m]]
        severity = (2 * level.count("ERROR") + level.count("WARN") - 0.7 * level.count("INFO")) / size
        kind = {"candidate": 2.0, "baseline": -2.0}.get(TYPES.get(m), -1.5)
        structure = max(0, min(5, out - 0.5 * into + 0.1 * math.log1p(size) + kind))
        near = 1 - min(1, max(0, first - onset) / max(60, END - START))
        score = structure * max(0.25, min(2, 1 + change)) * max(0.5, min(2, 1 + 0.25 * severity)) + 3 * near + 2 * STATS[m][0] + 0.4 * math.sqrt(STATS[m][1]) + min(4, 0.4 * len(direct)) + math.log1p(len(after))
        codes = [e[2] for e in own[m] if e[2]]
        score *= {5: 3.0, 4: 2.4, 3: 1.0, 2: 0.6}.get(max(codes) // 100 if codes else 2, 1.0)
        score *= 0.2 if codes and all(200 <= x < 300 for x in codes) and out <= 0 else 1
        score *= 0.3 if size / len(every) > 0.15 and out <= 0 else 1
        score *= 0.4 if first < START else 1
        late = first - START
        scores[m] = score + (6 if late <= 0 else 4 if late < 30 else 2 if late < 120 else 0)
    return sorted(scores.items(), key=lambda x: (-x[1], x[0]))


def frames(spark):
    e = spark.createDataFrame([("r", c, s * M, code, sev) for c, s, code, sev in EVENTS] + [("r", "A", None, 500, "ERROR"), ("other", "A", 1, 500, "ERROR")], "run_id string, cluster_id string, us long, response_code int, severity string")
    incidents = spark.createDataFrame([("r", "I1", START * M, END * M)], "run_id string, incident_id string, start_us long, end_us long")
    members = spark.createDataFrame([("r", "I1", c) for c in "ABCDE"] + [("r", "I1", "none")], "run_id string, incident_id string, cluster_id string")
    edges = spark.createDataFrame([("r", *x) for x in EDGES], "run_id string, source string, target string, score double")
    stats = spark.createDataFrame([("r", c, *x) for c, x in STATS.items()], "run_id string, cluster_id string, trigger_score double, error_count long")
    types = spark.createDataFrame([("r", c, t) for c, t in TYPES.items()], "run_id string, cluster_id string, cluster_type string")
    return incidents, members, e, edges, stats, types


def test_ranked_causes_by_hand(spark):
    got = [(r.cluster_id, r.score) for r in ranker.ranked_causes(*frames(spark)).orderBy("rank").collect()]
    want = by_hand()
    assert [c for c, _ in got] == [c for c, _ in want] == ["A", "E", "D"] and all(abs(a - b) < 1e-5 for (_, a), (_, b) in zip(got, want))


def test_all_clusters_where_few_are_strong(spark):
    incidents, members, e, edges, stats, types = frames(spark)
    weak = stats.where("cluster_id in ('A', 'B')")
    got = ranker.ranked_causes(incidents, members, e, edges, weak, types, 10).orderBy("rank").collect()
    assert {r.cluster_id for r in got} == set("ABCDE") and [r["rank"] for r in got] == [1, 2, 3, 4, 5]
    assert ranker.ranked_causes(incidents, members, e.limit(0), edges, stats, types).isEmpty()


def test_bonus_of_neighbours(spark):
    edges = spark.createDataFrame([("r", "a", "b", 1.0), ("r", "b", "c", 0.5), ("r", "c", "d", 0.5), ("q", "a", "b", 1.0)], "run_id string, source string, target string, score double")
    firsts = spark.createDataFrame([("r", c, s * M) for c, s in (("a", 9), ("b", 39), ("c", 129), ("d", 130))] + [("q", "a", 0)], "run_id string, cluster_id string, first_us long")
    starts = spark.createDataFrame([("r", 10 * M)], "run_id string, start_us long")
    got = {(r.run_id, r.cluster_id): (r.bonus, r.out_weight, r.in_weight, r.targets) for r in clusters.neighbours(edges, firsts, starts).collect()}
    assert got == {("r", "a"): (6, 1.0, 0.0, "b"), ("r", "b"): (4, 0.5, 1.0, "c"), ("r", "c"): (2, 0.5, 0.5, "d"), ("r", "d"): (0, 0.0, 0.5, ""), ("q", "a"): (0, 1.0, 0.0, "b"), ("q", "b"): (0, 0.0, 1.0, "")}


def test_provenance_by_hand(spark):
    schema = "run_id string, response_code int, status_family string, failure_hint string, service string, component string"
    roots = spark.createDataFrame([("a", 500, "failure", None, "s", None), ("a", 200, "normal", "timeout", None, None), ("a", None, None, None, "", "etcd")], schema)
    claims = spark.createDataFrame([("a", False), ("b", True), ("b", False), ("c", False), ("d", None)], "run_id string, evidence boolean")
    got = {r.run_id: (r.root_cause_source, r.observed_events, r.http_events, r.multisignal_events, r.component_events, r.external_context_used) for r in bundles.provenance(roots, claims).collect()}
    assert got == {"a": ("logs_only", 3, 1, 2, 2, False), "b": ("inferred_from_candidates", 0, 0, 0, 0, False), "c": ("inferred_only", 0, 0, 0, 0, False), "d": ("inferred_only", 0, 0, 0, 0, False)}
