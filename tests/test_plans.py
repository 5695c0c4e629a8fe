"""Whole plans: the driver entry, the full run, and results that must not depend on partitions or order."""

import __spark_entry__
from pyspark.sql import functions as F
from rootline.operators import incidents, reports, trigger, vectors
from rootline.plans.pipeline import run_all
from rootline.sources.events import stream_events


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "trigger_score" in df.columns


def test_registry():
    known = __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(known) and len(known) >= 70


def test_partitions_and_order_do_not_matter(spark, small):
    e = stream_events(spark, small)
    rows = lambda df: sorted(map(str, incidents.episodes(incidents.cluster_windows(trigger.trigger_stats(df))).collect()))
    assert rows(e) == rows(e.orderBy(F.rand(1)).repartition(7))


SAMPLE_LOG = """2024-01-01 00:00:00 a
  at x

{"k":1}
tail1
tail2
2024-01-01T00:00:05 connection refused by 10.0.0.1 id=1234567 0xFF
all.logs: [1704067200, {"time": "2024-01-01T00:00:06Z", "msg": "unexpected status 503 from http://billing.core.svc:80/api/v1/x", "level": "error", "method": "GET", "kubernetes": {"labels": {"app": "etcd"}, "pod_name": "etcd-0"}}]"""


def test_records_and_events_of_whole_documents(spark, small, tmp_path):
    given = [(1, SAMPLE_LOG), (2, "b 2024-01-02 00:00:00\r\n\n more\n{}"), (3, ""), (4, None), (None, "x")]
    spark.createDataFrame(given, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    known = __spark_entry__.queries()
    records = known["document_records"](spark, str(tmp_path))
    got = sorted((r.doc_id, r.record_no, r.raw, r.is_json) for r in records.collect())
    lines = SAMPLE_LOG.split("\n")
    sample = [(1, 1, "\n".join(lines[:2]), False), (1, 2, lines[3], True), (1, 3, "\n".join(lines[4:6]), False), (1, 4, lines[6], False), (1, 5, lines[7], True)]
    assert got == [*sample, (2, 1, "b 2024-01-02 00:00:00\n more", False), (2, 2, "{}", True)]
    events = known["document_events"](spark, str(tmp_path)).collect()
    assert len(events) == len({e.event_id for e in events}) == len(got) and {e.raw_text for e in events} == {x[2] for x in got}
    assert [(e.service, e.response_code, e.target) for e in events if e.raw_text.startswith("all.logs")] == [("etcd", 503, "billing")]

    whole = known["document_records"](spark, small).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    back = {}
    for r in sorted(whole, key=lambda r: (r.doc_id, r.record_no)):
        back.setdefault(r.doc_id, []).append(r.raw)
    assert {d: "\n".join(x) for d, x in back.items()} == {d: "\n".join(filter(None, t.replace("\r\n", "\n").split("\n"))) for d, t in texts.items() if t and t.strip("\r\n")}
    assert known["document_events"](spark, small).count() == len(whole)


def test_run_all(spark, small):
    e = stream_events(spark, small).where("run_id < '2024-01-06'").cache()
    tables = run_all(e, gap_seconds=1800)
    report = tables["report"].collect()
    assert report and all(r["summary"] for r in report)
    assert tables["status"].where("status not in ('incident_detected', 'no_incident')").isEmpty()
    assert {r["check"] for r in tables["checks"].collect()} == {"graph", "candidates", "roots"}
    assert "# Root causes" in reports.markdown(tables["report"])
    e.unpersist()


def test_incidents_are_consistent(spark, small):
    found = incidents.incidents(stream_events(spark, small)).collect()
    assert found
    for r in found:
        assert r.start_us <= r.end_us and 0 <= r.confidence <= 1 and 1 <= len(r.seed_clusters) <= 3 and r.declaration in ("incident", "possible_incident")


def test_vectors(spark, small):
    v = spark.read.parquet(f"{small}/embeddings.parquet")
    assert vectors.kmeans(v).count() == v.count()
    assert vectors.hashed_vectors(spark.createDataFrame([("a b",), ("a b",), ("c",)], "embedding_text string")).count() == 2
    assert vectors.kmeans_k(10) == 8 and vectors.kmeans_k(3) == 3 and vectors.kmeans_k(100_000) == 300


def test_nearest_vectors_of_many_queries(spark):
    import numpy as np

    r = np.random.default_rng(0)
    few, many = r.normal(size=(6, 3)).astype("float32"), r.normal(size=(10_001, 3)).astype("float32")
    frame = lambda ids, x: spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    got = vectors.nearest_vectors(frame(range(6), few), frame(range(10_001), many), 2).collect()
    score = np.round(many.astype(float) @ few.astype(float).T, 5)
    want = {(q, v, n + 1) for q in range(10_001) for n, v in enumerate(sorted((i for i in range(6) if i != q), key=lambda i: (-score[q, i], i))[:2])}
    assert {(x.query_id, x.vec_id, x["rank"]) for x in got} == want and len(got) == 20_002
