"""Formulas and folds on hand-computed cases."""

import random

import pytest
from pyspark.sql import functions as F

from rootline.functions import scores as S
from rootline.functions import text as X
from rootline.operators import incidents, quality, temporal
from rootline.sources import logs
from rootline.sources.events import CANONICAL, canonical, read_events, write_events


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_trigger_case(spark):
    lit = F.lit
    raw = S.trigger_raw(lit(10 / 60 / 0.05), lit(0.8))
    trigger = S.trigger_adjusted(raw, lit(10), lit(2))
    power = S.strength(trigger, lit(0.8), lit(0.6), lit(0.2), lit(1))
    r = one(spark, F.round(raw, 6).alias("raw"), trigger.alias("t"), power.alias("p"), S.is_candidate(trigger, power, lit(8), lit(0.8), lit(2), lit(1)).alias("c"))
    assert (r.raw, r.t, r.p, r.c) == (5.919209, 0.797615, 0.705593, True)


def test_candidate_and_edge_scores(spark):
    lit = F.lit
    r = one(spark, S.candidate_score(lit(0), lit(0.5), lit(1.0), lit(0.0)).alias("a"), S.candidate_score(lit(1), lit(0.8), lit(0.5), lit(1.0)).alias("b"), *[S.edge_score(lit(i)).alias(f"e{i}") for i in range(4)])
    assert (r.a, r.b, r.e0, r.e1, r.e2, r.e3) == (0.75, 0.45, 0.7, 0.8, 0.9, 1.0)


def test_jaccard_and_lift(spark):
    arr = lambda *x: F.array(*[F.lit(i) for i in x]).cast("array<string>")
    r = one(spark, S.jaccard(arr(), arr()).alias("a"), S.jaccard(arr("a"), arr()).alias("b"), S.jaccard(arr("a", "b"), arr("b", "c")).alias("c"), S.lift(F.lit(0.0), F.lit(1.0)).alias("d"), S.lift(F.lit(0.01), F.lit(0.05)).alias("e"))
    assert (r.a, r.b, round(r.c, 6), r.d, round(r.e, 6)) == (1.0, 0.0, 0.333333, None, 5.0)


def test_cluster_types(spark):
    r = one(spark, *[S.cluster_type(F.lit(n), F.lit(100)).alias(f"c{n}") for n in (20, 10, 5)])
    assert tuple(r) == ("baseline", "contextual", "minor_pattern")


def test_redaction(spark):
    df = spark.createDataFrame([("GET 10.0.0.1 id=1234567 0xFF",)], "t string")
    r = df.select(X.normalized("t").alias("n"), X.redactions("t").alias("r")).first()
    assert r.n == "get <ip> id=<num> <hex>" and r.r == {"ip": 1, "hex": 1, "num": 1}


def test_text_columns(spark):
    df = spark.createDataFrame([("context deadline exceeded status=503 GET /api/v1/pods level=warning http://a-b.ns.svc:80",), ("nothing here",), (None,)], "t string")
    r = df.select(X.failure_hint("t").alias("h"), X.code_in_text("t").alias("c"), X.verb_in_text("t").alias("v"), X.path_in_text("t").alias("p"), X.severity_in_text("t").alias("s"), X.dependency_host("t").alias("d")).collect()
    assert tuple(r[0]) == ("timeout", 503, "get", "/api/v1/pods", "WARN", "a-b.ns.svc")
    assert tuple(r[1]) == (None,) * 6 and tuple(r[2]) == (None,) * 6


def test_components(spark):
    df = spark.createDataFrame([("system:node:x", ""), ("x", "the etcd leader"), ("x", "nothing"), ("etcd", "pod milvus-etcd-0")], "a string, t string")
    got = [r[0] for r in df.select(X.component("a", "t")).collect()]
    assert got == ["kubelet", "etcd", "unknown_component", "milvus-core"]


def windows(spark, spans):
    return spark.createDataFrame([("r", f"c{i}", a * 1_000_000, b * 1_000_000) for i, (a, b) in enumerate(spans)], "run_id string, cluster_id string, start_us long, end_us long")


def test_episode_case(spark):
    got = {r.cluster_id: r.episode for r in incidents.episodes(windows(spark, [(0, 900), (10, 20), (130, 140), (300, 310)])).collect()}
    assert got == {"c0": 1, "c1": 1, "c2": 1, "c3": 2}


@pytest.mark.parametrize("seed", range(3))
def test_episode_fold_against_loop(spark, seed):
    r = random.Random(seed)
    spans = sorted((s := r.randrange(5000), s + r.randrange(400)) for _ in range(60))
    want, number, first, last = [], 0, 0, 0
    for a, b in spans:
        if number and a <= last + 120 and max(last, b) - first <= 1200:
            last = b
        else:
            number, first, last = number + 1, a, b
        want.append(number)
    got = incidents.episodes(windows(spark, spans)).orderBy("start_us", "end_us", "cluster_id").collect()
    assert [x.episode for x in got] == want


def test_sessions_join_at_the_gap(spark):
    df = spark.createDataFrame([("r", t * 1_000_000, i, "c") for i, t in enumerate((0, 120, 241))], "run_id string, us long, event_id long, cluster_id string")
    assert sorted(r.events for r in incidents.gap_sessions(df).collect()) == [1, 2]


def test_waves_close_after_the_cooldown(spark):
    scores = [0.9, 0.3, 0.0] + [0.0] * 12 + [0.8]
    df = spark.createDataFrame([("r", i, s) for i, s in enumerate(scores)], "run_id string, bucket long, score double")
    assert [(r.first_bucket, r.last_bucket) for r in incidents.bucket_waves(df).orderBy("wave").collect()] == [(0, 1), (15, 15)]


def test_root_confidence(spark):
    df = spark.createDataFrame([(3.0, 100, 6.0, 1.0, 0.9, True, 0.0), (0.0, 0, 0.0, 0.0, 0.0, False, 12.0)], "trigger double, errors long, out_weight double, in_weight double, proximity double, consistent boolean, penalty double")
    rows = temporal.root_confidence(df).collect()
    assert [(r.confidence, r.label) for r in rows] == [(0.94, "high"), (0.0, "low")]
    assert rows[0].reasons[0] == "strong trigger anomaly" and len(rows[1].reasons) == 2


def test_records(spark):
    lines = "2024-01-01 00:00:00 a\n  at x\n\n{\"k\":1}\ntail1\ntail2\n2024-01-01T00:00:05 b"
    df = spark.createDataFrame([("f", lines)], "source_file string, text string")
    assert [r.raw for r in logs.records(df).orderBy("record_no").collect()] == ["2024-01-01 00:00:00 a\n  at x", '{"k":1}', "tail1\ntail2", "2024-01-01T00:00:05 b"]


def test_log_events(spark):
    wrapped = 'all.logs: [1704067200, {"msg": "unexpected status 503 from http://billing.core.svc:80", "kubernetes": {"labels": {"app": "etcd"}, "pod_name": "etcd-0"}}]'
    audit = '{"requestReceivedTimestamp": "2024-01-01T00:00:07Z", "user": {"username": "system:node:n1"}, "verb": "get", "objectRef": {"resource": "pods"}, "responseStatus": {"code": 403}}'
    csv = "0,2024-01-01T00:00:08Z,system:apiserver,list,pods,x,x,x,/api/v1/pods,x,ResponseComplete,500"
    df = spark.createDataFrame([("f", "\n".join((wrapped, audit, csv)))], "source_file string, text string")
    a, b, c = logs.events(logs.records(df)).orderBy("timestamp").collect()
    assert (a.timestamp, a.service, a.response_code, a.target, a.status_family, a.failure_mode) == ("2024-01-01T00:00:00+00:00", "etcd", 503, "billing", "failure", "service_failure")
    assert (b.actor, b.verb, b.response_code, b.failure_mode, b.semantic.component) == ("system:node:n1", "get", 403, "authz_failure", "kubelet")
    assert (c.actor, c.verb, c.resource, c.path, c.response_code) == ("system:apiserver", "list", "pods", "/api/v1/pods", 500)


def test_files(spark, tmp_path):
    import gzip

    (tmp_path / "a.log").write_text("2024-01-01 00:00:00 plain\n")
    (tmp_path / ".hidden.log").write_text("x\n")
    (tmp_path / "b.bin").write_text("x\n")
    with gzip.open(tmp_path / "c.log.gz", "wt") as f:
        f.write("2024-01-01 00:00:00 packed\n")
    assert sorted(r.raw for r in logs.file_records(logs.file_lines(spark, str(tmp_path))).collect()) == ["2024-01-01 00:00:00 packed", "2024-01-01 00:00:00 plain"]


def test_canonical_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("e1", "404", {"a": 1}), ("e2", "x", None)], "event_id string, response_code string, redactions map<string,int>")
    write_events(df, str(tmp_path / "events"))
    back = read_events(spark, str(tmp_path / "events"))
    assert back.columns == CANONICAL.names and sorted((r.event_id, r.response_code, r.redactions) for r in back.collect()) == [("e1", 404, '{"a":1}'), ("e2", None, None)]
    assert canonical(df).dtypes == back.dtypes


def test_quality_tables(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "event_id long, x string")
    right = spark.createDataFrame([(1, "b"), (2, None)], "event_id long, x string")
    assert [tuple(r) for r in quality.differences(left, right, ["x"]).collect()] == [(1, "x")]
    assert [(r.check, r.passed) for r in quality.checks({"none": left.limit(0), "some": left}).orderBy("check").collect()] == [("none", True), ("some", False)]


def test_stream(spark, small, tmp_path):
    from rootline.streaming import live

    folder = tmp_path / "in"
    spark.read.parquet(f"{small}/events.parquet").coalesce(1).write.parquet(str(folder))
    counts = live.minute_counts(live.read_stream(spark, str(folder)), width="1 hour")
    q = counts.writeStream.outputMode("complete").format("memory").queryName("live_counts").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("live_counts").agg(F.sum("events")).first()[0] == spark.read.parquet(f"{small}/events.parquet").count()
    assert live.alerts(spark.table("live_counts")).where("error_rate < 0.4").isEmpty()
