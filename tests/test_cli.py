"""The command line from log files to validated tables, and what the validator finds in broken ones."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from rootline import storage
from rootline.__main__ import main
from rootline.functions import text as X
from rootline.operators import validate
from rootline.plans import layout


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    lines = []
    for i in range(240):
        at = f"2024-03-{1 + i % 2:02d}T0{i % 6}:{i % 60:02d}:00Z"
        if i % 3 == 0:
            lines.append("all.logs: " + json.dumps([1704067200, {"time": at, "msg": f"status {500 if i % 2 else 200} connection refused by http://billing.core.svc:80/api/v1/x", "level": "error", "method": "GET", "kubernetes": {"labels": {"app": f"app{i % 5}"}, "pod_name": "etcd-0"}}]))
        elif i % 3 == 1:
            lines.append(json.dumps({"requestReceivedTimestamp": at, "user": {"username": f"system:node:n{i % 4}"}, "verb": "get", "objectRef": {"resource": "pods"}, "requestURI": "/api/v1/pods", "stage": "ResponseComplete", "responseStatus": {"code": 403 if i % 4 else 200}}))
        else:
            lines += [f"{at.replace('T', ' ')[:19]} panic in worker {i}", "  at frame 1"]
    (base / "logs").mkdir()
    (base / "logs" / "a.log").write_text("\n".join(lines[:150]))
    with gzip.open(base / "logs" / "b.log.gz", "wt") as f:
        f.write("\n".join(lines[150:]))
    (base / "list.txt").write_text(f"{base}/logs/a.log\n{base}/logs/b.log.gz\n")
    assert main(["all", "--outputs-root", f"{base}/out", "--logfile-list", str(base / "list.txt"), "--min-cluster-size", "2", "--causal-gap-seconds", "7200"], spark) == 0
    return base


def test_all_steps_leave_their_tables(spark, root):
    t = layout.read_tables(spark, f"{root}/out")
    assert {n for names in validate.STEPS.values() for n in names} <= set(t)
    assert t["events"].count() == 240 and t["index"].count() == 240 and len(t["index"].columns) == 16
    checks = t["checks"].collect()
    assert checks and all(r.passed for r in checks) and {r.step for r in checks} == set(range(1, 12))
    assert t["bundle"].where("coverage between 0 and 100").count() == t["report"].count() > 0
    assert t["detailed"].where("merged_confidence is null").isEmpty()


def test_steps_again(spark, root):
    out = ["--outputs-root", f"{root}/out"]
    with pytest.raises(Exception, match="already exists"):
        main(["timeline", *out], spark)
    assert main(["timeline", "--clean", "--timeline-minutes", "30", *out], spark) == 0
    assert main(["triage", "--logfile", f"{root}/logs", "--triage-min-weighted-score", "1", *out], spark) == 0
    assert layout.read_tables(spark, f"{root}/out", names=("triage",))["triage"].count() == 2
    other = ["--outputs-root", f"{root}/picked", "--triage", "--triage-input-dir", f"{root}/logs", "--triage-output-dir", f"{root}/found", "--triage-top-n", "1", "--triage-min-weighted-score", "1", "--triage-max-lines-per-file", "100"]
    assert main(["ingest", *other], spark) == 0
    picked = [r.value for r in spark.read.text(f"{root}/found/selected").collect()]
    assert len(picked) == 1 and 0 < layout.read_tables(spark, f"{root}/picked", names=("events",))["events"].count() < 240


def test_validator_holds_events_against_the_raw_log(spark, root):
    out = ["--outputs-root", f"{root}/out", "--clean"]
    assert main(["validate", *out, "--raw-log", f"{root}/logs"], spark) == 0
    (root / "logs" / "more.log").write_text("2024-01-01 00:00:00 not ingested\n")
    try:
        assert main(["validate", *out, "--raw-log", f"{root}/logs"], spark) == 1
    finally:
        (root / "logs" / "more.log").unlink()
    report = [json.loads(r.value) for r in spark.read.text(layout.path_of(f"{root}/out", "checks").replace(".parquet", ".json")).collect()]
    assert [r["name"] for r in report if not r["passed"]] == ["files whose events are not their records"]
    assert main(["validate", *out, "--compat-v142"], spark) == 0


def test_validator_finds_faults(spark, root):
    t = layout.read_tables(spark, f"{root}/out")
    broken = dict(t)
    broken["index"] = t["index"].withColumn("service", F.lit("x")).limit(230)
    broken["members"] = t["members"].unionByName(spark.createDataFrame([("none", "C?")], "event_id string, cluster_id string"))
    broken["status"] = t["status"].withColumn("status", F.lit("odd"))
    broken["edges"] = spark.createDataFrame([("2024-03-01", "a", "a", 0, 0, 2.0)], "run_id string, source string, target string, semantic_links int, lag_seconds long, score double")
    broken["assertions"] = t["assertions"].withColumn("status", F.lit("maybe"))
    broken["timeline"] = t["timeline"].withColumn("failures", F.col("total") + 1)
    del broken["report"], broken["diagnostics"]
    failed = {(r.step, r.name) for r in validate.validate(spark, broken).where("not passed").collect()}
    assert failed == {
        (2, "events without index row"), (2, "rows whose fields differ"), (3, "members that are no events"), (3, "members of no cluster"), (3, "clusters whose size is not their members'"), (5, "unknown statuses"), (6, "graph violations"),
        (7, "report exists"), (10, "unknown results"), (11, "buckets with more failures than events"),
    } - ({(3, "clusters whose size is not their members'")} if t["clusters"].where("cluster_id = 'C?'").isEmpty() else set())
    assert {r.name for r in validate.validate(spark, {}).collect() if r.passed} == set()
    one = validate.validate(spark, {"timeline": t["timeline"]}, ("timeline_or_diagnostics",)).collect()
    assert all(r.passed for r in one)


def test_folder_must_be_shared_off_local_masters():
    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Context:
        master, getCheckpointDir = "spark://host:7077", staticmethod(lambda: None)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.folder(Session)


def test_small_text_columns(spark):
    df = spark.createDataFrame([("1.5", "2024-01-01T00:00:05Z", None), ("x", None, "1704067205"), (None, "bad", "bad")], "a string, b string, c string")
    got = df.select(X.float_or("a", -1.0).alias("a"), X.time_of("b", "c").cast("long").alias("t"), *X.normalized_fields(["b"])).collect()
    assert [(r.a, r.t) for r in got] == [(1.5, 1704067205), (-1.0, 1704067205), (-1.0, None)] and got[2].b == "bad"


def test_clusters_of_vectors(spark, root):
    out = ["--outputs-root", f"{root}/dense"]
    assert main(["ingest", *out, "--logfile", f"{root}/logs"], spark) == 0
    assert main(["embed", *out, "--embed-method", "words"], spark) == 0
    assert main(["cluster", *out, "--cluster-mode", "auto", "--pca-dims", "8", "--min-cluster-size", "5", "--max-cluster-events", "100"], spark) == 0
    t = layout.read_tables(spark, f"{root}/dense")
    assert t["members"].count() == 240 and t["members"].select("event_id").distinct().count() == 240
    assert t["clusters"].agg(F.sum("size")).first()[0] == 240 and t["clusters"].where("cluster_id like 'C%'").count() >= 2
    with pytest.raises(ValueError):
        main(["cluster", *out, "--clean", "--cluster-mode", "standard", "--max-cluster-events", "100", "--cluster-overflow-mode", "fail"], spark)
