"""Evidence packets by hand, the bounded best-of against the plain window, and its plan."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from rootline.operators import packets

M = 1_000_000
E = "run_id string, cluster_id string, event_id long, us long, service string, actor string, response_code int, raw_text string"


def frames(spark):
    rows = [("r", "A", 1, 50 * M, " s1 ", "x", 500, "late"), ("r", "A", 2, 9 * M, None, "act", 404, " first "), ("r", "A", 3, None, "s2", None, None, "late"), ("r", "A", 4, 9 * M, "", " ", 700, "  "), ("r", "A", 5, 60 * M, "s2", None, 302, "more"), ("r", "A", 6, 70 * M, "s1", None, 200, "never")]
    rows += [("r", "A", 10 + i, 80 * M, "many", None, 200, f"t{i}") for i in range(200)]
    rows += [("r", "B", 300, None, None, None, None, None), ("r", "B", 301, None, "b", None, 503, "b"), ("q", "A", 900, 1, "other", None, 200, "other run"), ("r", "Z", 901, 1, "z", None, 200, "no cause")]
    events = spark.createDataFrame(rows, E).repartition(7)
    ranked = spark.createDataFrame([("r", "I1", "A", 1, 40.0, 0.5, 3.0, 1.0), ("r", "I1", "B", 2, 9.0, 0.0, 0.0, 2.0), ("r", "I1", "gone", 3, 1.0, 0.0, 0.0, 0.0), *[("r", "I1", f"N{i:02}", 4 + i, 0.5, 0.0, 0.0, 0.0) for i in range(14)]],
                                   "run_id string, incident_id string, cluster_id string, rank int, score double, proximity double, out_weight double, in_weight double")
    edges = [("r", "A", f"N{i:02}", 0.7) for i in range(13)] + [("r", "A", "N13", 0.9), ("r", "B", "A", 0.8), ("r", "Y", "A", 1.0), ("r", "A", "Y", 1.0), ("q", "A", "B", 1.0), ("r", "N01", "B", 1.0)]
    edges = spark.createDataFrame(edges, "run_id string, source string, target string, score double")
    stats = spark.createDataFrame([("r", "A", 0.9, 7)], "run_id string, cluster_id string, trigger_score double, error_count long")
    types = spark.createDataFrame([("r", "A", 206, "baseline", 9 * M, 80 * M, 5), ("r", "B", 2, "minor_pattern", None, None, None), ("r", "gone", 1, "minor_pattern", 1, 1, 1)], "run_id string, cluster_id string, size long, cluster_type string, first_us long, last_us long, representative long")
    return ranked, events, edges, stats, types


def test_packets_by_hand(spark):
    ranked, *rest = frames(spark)
    p = packets.evidence_packets(ranked, *rest)
    got = {r.cluster_id: r for r in p.collect()}
    assert set(got) == {"A", "B"}  # the others have no events
    a, b = got["A"], got["B"]
    assert tuple(a.earliest) == (9 * M, 2, "act", 404, "first") and a.representative_event.event_id == 5
    assert [tuple(x) for x in a.top_services] == [("many", 94), ("s1", 2), ("s2", 2), ("act", 1)]
    assert a.examples == ["late", "first", "more"] and tuple(a.classes) == (95, 1, 1, 1, 1, 1)
    assert (a.in_degree, a.out_degree) == (1, 14) and [tuple(x) for x in a.in_edges] == [("B", 0.8)]
    assert [x.cluster_id for x in a.out_edges] == ["N13", *[f"N{i:02}" for i in range(9)]]
    want = 0.4 * 0.4 + 0.2 * 0.9 / 5 + 0.15 * math.log1p(7) / 5 + 0.15 * 2.5 / 10 + 0.1 * 0.5
    assert a.confidence == round(want, 3) and a.label == "low" and a.role == "root_cause" and b.role == "candidate"
    assert b.earliest is None and b.representative_event.event_id == 300 and b.examples == ["b"] and b.in_degree is None and b.trigger_score == 0
    line = packets.packet_timeline(p).collect()
    assert [(r.place, r.cluster_id, r.us, r.summary) for r in line] == [(1, "A", 9 * M, "first")]
    incidents = spark.createDataFrame([("r", "I1", 1, 2), ("q", "I1", 1, 2)], "run_id string, incident_id string, start_us long, end_us long")
    assert {(r.run_id, r.candidate_count, r.has_root_cause) for r in packets.packet_stats(incidents, ranked, p).collect()} == {("r", 17, True), ("q", 0, False)}


def test_packets_of_nothing(spark):
    ranked, events, edges, stats, types = frames(spark)
    assert packets.evidence_packets(ranked, events.limit(0), edges, stats, types).isEmpty()
    assert packets.evidence_packets(ranked.limit(0), events, edges, stats, types).isEmpty()
    assert {r.out_degree for r in packets.evidence_packets(ranked, events, edges.limit(0), stats, types).collect()} == {None}


def test_leading_is_the_window_cut_off_and_limits_each_task(spark):
    rows = spark.range(20_000).select((F.col("id") % 3).alias("key"), F.pmod(F.hash("id"), F.lit(50)).alias("x"), "id").repartition(6)
    order = [F.desc("x"), "id"]
    got = packets.leading(rows, ["key"], order, 7)
    want = rows.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy(*order))).collect()
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r) for r in want if r["place"] <= 7)
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    limits = [i for i in range(len(plan)) if plan.startswith("WindowGroupLimit", i)]
    assert len(limits) == 2 and "Partial" in plan and limits[0] < plan.rindex("Exchange hashpartitioning(key") < limits[1]
