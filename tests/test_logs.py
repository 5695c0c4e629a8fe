"""Log files in ranges against one reading from front to end, and the automaton against the ordered rules."""

import gzip
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from rootline.functions import matching
from rootline.functions import text as X
from rootline.sources import logs

START = re.compile(r"\d{4}-\d{2}-\d{2}[\sT]\d{2}:\d{2}:\d{2}|\d{6}\s+\d{6}|-\s+\d+\s+\d{4}\.\d{2}\.\d{2}")


def is_json(line):
    t = line.strip()
    if not (t.startswith("{") and t.endswith("}")):
        t = t[t.find("{") : t.rfind("}") + 1] if "{" in t and t.rfind("}") > t.find("{") else ""
    try:
        return isinstance(json.loads(t), dict)
    except ValueError:
        return False


def records_of(text):
    """One pass over all lines."""
    out, held = [], []
    for line in re.split(r"\r\n|\n|\r", text):
        audit = line.count(",") >= 10 and ("ResponseStarted" in line or "ResponseComplete" in line) and "system:" in line
        alone = is_json(line) or audit
        if line and held and (alone or START.search(line)):
            out.append("\n".join(held))
            held = []
        if alone:
            out.append(line)
        elif line:
            held.append(line)
    return [*out, *(["\n".join(held)] if held else [])]


LINES = ["2024-01-01 00:00:00 began", "x 081109 203615 148 y", "a - 1117838570 2005.06.03 b", '{"k": 1}', 'pre {"k": {"a": 2}} post', "{broken", "plain", "  at f (x.py)", "   ", "", "system:a,1,2,3,4,5,6,7,8,9,ResponseComplete,200", "größe 日本", "2024-01-01T00:00:00 " + "long " * 60]


def made(seed, n):
    r = random.Random(seed)
    return "".join(r.choice(LINES) + r.choice(["\n", "\n", "\n", "\r\n"]) for _ in range(n))


@pytest.fixture
def folder(tmp_path):
    files = {"a.log": made(1, 400), "sub/b.txt": "plain\n" * 500, "sub/c.out": made(3, 300) + "no end", "empty.log": "", "d.json": '{"k": 1}\n' * 50 + "tail\n" * 200 + "2024-01-01 00:00:00 z", "e.log": "one"}
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(text.encode())
    with gzip.open(tmp_path / "g.log.gz", "wb") as f:
        f.write(made(5, 100).encode())
    (tmp_path / ".hidden.log").write_text("x")
    (tmp_path / "other.bin").write_text("x")
    (tmp_path / "bad.log").write_bytes(b"2024-01-01 00:00:00 \xff\xfe bad\n")
    return tmp_path, files | {"g.log.gz": made(5, 100), "bad.log": "2024-01-01 00:00:00 \ufffd\ufffd bad"}


@pytest.mark.parametrize("size", ["100", "1000", "128m"])
def test_records_do_not_depend_on_ranges(spark, folder, size):
    path, files = folder
    kept = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        lines = logs.file_lines(spark, str(path))
        assert size == "128m" or lines.select("source_file", "range_start").distinct().count() > 3 * len(files)
        got = {}
        for r in logs.file_records(lines).orderBy("record_no").collect():
            got.setdefault(r.source_file.split(f"{path.name}/", 1)[1], []).append((r.record_no, r.raw, r.json is not None))
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    want = {name: [(i + 1, raw, is_json(raw)) for i, raw in enumerate(records_of(text))] for name, text in files.items()}
    assert got == {k: v for k, v in want.items() if v}


def test_named_files_are_read_whatever_their_name(spark, folder):
    path, _ = folder
    assert [r.raw for r in logs.file_records(logs.file_lines(spark, [str(path / "other.bin"), str(path / "e.log")])).orderBy("raw").collect()] == ["one", "x"]
    with pytest.raises(ValueError):
        logs.file_lines(spark, [])


def test_records_of_texts(spark):
    texts = [(f"t{i}", made(i, 60).replace("\r\n", "\n")) for i in range(30)] + [("none", None), ("blank", "")]
    got = {}
    for r in logs.records(spark.createDataFrame(texts, "source_file string, text string").repartition(3)).orderBy("record_no").collect():
        got.setdefault(r.source_file, []).append(r.raw)
    assert got == {k: records_of(v) for k, v in texts if v}


def test_rows_of_fields(spark):
    rows = ["1,2024-01-01T00:00:00Z,amy,get,pods,,,,/x,,Stage,", '1,no,"a,""b",get,pods,,,,/x,,Stage,42\nmore,of,it', "1,2,3", ",".join("abcdefghijkl"), "a" + "," * 10]
    df = spark.createDataFrame([("f", i, r, None) for i, r in enumerate(rows)], "source_file string, record_no long, raw string, json string")
    got = [(r.timestamp, r.actor, r.verb, r.stage, r.response_code) for r in logs.events(df).orderBy("record_no").collect()]
    assert got == [("2024-01-01T00:00:00Z", "amy", "get", "stage", None), (None, 'a,"b', "get", "stage", 42), (None,) * 5, (None, "c", "d", "k", None), (None,) * 5]


def test_automaton_gives_the_labels_of_the_ordered_rules(spark):
    r = random.Random(7)
    hints, names = [w for w, _ in X.HINTS], [p for found in X.COMPONENTS.values() for words in found.values() for p in words]
    glue = [" ", "  ", "\n", "", "_", "é", ".", "-", "x", "\t", ":", "ſ", "İ", "日"]
    case = lambda w: r.choice([w, w.upper(), w.title(), w.replace(" ", "\n "), w.replace("s", "ſ"), w.replace("k", "\u212a")])
    said = lambda pool: "".join(r.choice([case(r.choice(pool)), "word", "milvus-etcd"]) + r.choice(glue) for _ in range(r.randrange(5)))
    rows = [(i, said(hints), r.choice([None, "", said(names), r.choice(names), "system:node:a"]), said(names)) for i in range(3000)] + [(-1, None, None, None), (-2, "", "", ""), (-3, "a" * 100_000 + " panic", None, "b " * 50_000 + "etcd")]
    df = spark.createDataFrame(rows, "i int, message string, actor string, t string").repartition(4)
    found = {r.i: (r.found.hint, r.found.component) for r in df.withColumn("found", matching.labels(F.col("message"), X.actor_role("actor"), F.col("t"))).collect()}

    def named(text):
        return next((c for words in X.COMPONENTS.values() for c, ps in words.items() for p in ps if re.search(rf"\b{re.escape(p)}\b", text)), None)

    for i, message, actor, t in rows:
        actor, t = "kubelet" if actor == "system:node:a" else actor or "", (t or "").lower()
        hint = next((h for w, h in X.HINTS if re.search(rf"\b{re.escape(w).replace(chr(92) + ' ', chr(92) + 's+')}\b", message or "", re.IGNORECASE)), None)
        blob = f"{actor} {t}".lower()
        shared = "milvus-etcd" in blob and any(re.search(rf"\b{re.escape(p)}\b", blob) for p in X.COMPONENTS["data_platform"]["milvus-core"])
        assert found[i] == (hint, "milvus-core" if shared else named(actor) or named(t) or "unknown_component"), (i, message, actor, t[:200])
    assert len({h for h, _ in found.values()}) == len({h for _, h in X.HINTS}) + 1 and len({c for _, c in found.values()}) > 30


def test_triage_writes_slices_and_a_manifest(spark, tmp_path):
    from rootline.operators import triage

    logs_, out = tmp_path / "logs", str(tmp_path / "out")
    logs_.mkdir()
    bad, ok = ["x"] * 10, ["fine"] * 30
    for i in (3, 4, 8):
        bad[i] = f"error {i} forbidden"
    (logs_ / "bad one.log").write_text("\n".join(bad) + "\n")
    (logs_ / "ok.txt").write_text("\n".join(ok))
    (logs_ / "some.JSONL").write_text('{"code": 503}\n\n{"code": 200}\n' + "timeout\n" * 3)
    chosen = triage.write_triage(spark, str(logs_), out, 40, 10)
    assert [c.rsplit("/", 1)[1].replace("%20", " ") for c in chosen] == ["bad one.log", "some.JSONL"]
    got = {}
    for r in spark.read.parquet(f"{out}/slices").orderBy("line_no").collect():
        got.setdefault(r.source_file.rsplit("/", 1)[1].replace("%20", " "), []).append((r.line_no, r.line, r.matched))
    assert got["bad one.log"] == [(i + 1, bad[i], i in (3, 4, 8)) for i in range(1, 10)]
    assert got["some.JSONL"] == [(1, '{"code": 503}', True), (2, "", False), (3, '{"code": 200}', False), (4, "timeout", True), (5, "timeout", True), (6, "timeout", True)]
    manifest = json.loads(spark.read.text(f"{out}/manifest").first().value)
    assert (manifest["files_scanned"], manifest["files_meeting_threshold"], manifest["files_selected"]) == (3, 2, 2)
    first = manifest["selected_files"][0]
    assert (first["lines"], first["matched_lines"], first["weighted_score"], first["density"]) == (10, 3, 30, 0.3) and first["top_signals"][0]["count"] == 3
    before = {p.name for p in (tmp_path / "out" / "slices").glob("file=*")}
    # a later run over other files leaves the slices that are there
    more = tmp_path / "more"
    more.mkdir()
    (more / "new.log").write_text("panic\npanic\npanic\n")
    triage.write_triage(spark, str(more), out, 40, 10, max_lines=2)
    after = {p.name for p in (tmp_path / "out" / "slices").glob("file=*")}
    assert before < after and len(after) == 3
    manifest = json.loads(spark.read.text(f"{out}/manifest").first().value)
    assert [(f["lines"], f["matched_lines"], f["weighted_score"]) for f in manifest["selected_files"]] == [(3, 2, 10)]


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    tasks, setting = 4 * spark.sparkContext.defaultParallelism, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    for i in range(5 * tasks):
        (tmp_path / f"file={i}.log").mkdir()
        (tmp_path / f"file={i}.log" / "part.txt").write_text(f"{i}\n")
    before = spark.conf.get(setting)
    spark.sparkContext.setJobGroup("listing", "")
    try:
        lines = logs.file_lines(spark, str(tmp_path))
        tracker = spark.sparkContext.statusTracker()
        found = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found and max(found) <= tasks
    assert spark.conf.get(setting) == before
    assert sorted(int(r.line) for r in lines.collect()) == list(range(5 * tasks))


@pytest.mark.parametrize("name", ["log_events", "document_events"])
def test_events_are_planned_once_and_compiled(spark, small, name):
    from rootline.plans.queries import REGISTRY

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        shown = REGISTRY[name](spark, small)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(-?\d+)", shown)]
        plan = REGISTRY[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # a method that fails to compile has size -1, and the JVM interprets those above 8,000 bytes for ever
    assert sizes and all(0 < n <= 8000 for n in sizes), sizes
    assert plan.count("ArrowEvalPython") == 1


def test_records_of_many_batches(spark, tmp_path):
    """Records that go on over batches and ranges, one of them over all ranges of its file."""
    (tmp_path / "a.log").write_text(made(11, 3000))
    (tmp_path / "b.log").write_text("2024-01-01 00:00:00 z\n" + "plain\n" * 700)
    kept = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    for size, batch in (("700", "7"), ("128m", "1"), ("128m", "64")):
        try:
            for c, v in zip(kept, (size, "0", batch)):
                spark.conf.set(c, v)
            found = logs.file_records(logs.file_lines(spark, str(tmp_path))).orderBy("source_file", "record_no").collect()
        finally:
            for c, v in kept.items():
                spark.conf.set(c, v)
        got = {n: [(r.record_no, r.raw) for r in found if r.source_file.endswith(n)] for n in ("a.log", "b.log")}
        assert got == {n: list(enumerate(records_of((tmp_path / n).read_bytes().decode()), 1)) for n in got}
