"""Log files made of the event table, and what their records and events must be.

Every event is one of twenty-odd shapes of log lines; ``event_id`` picks it, so that all of them follow each other in a
file.  The lines are SQL that Spark and the oracle share; what becomes of them is stated shape by shape, as values.
"""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import registry, triage
from ..sources import logs
from ..sources.events import micros, table
from ..storage import new_path

FILE_EVENTS = 500
T = "t || 'Z'"
WORDS = [p for found in X.COMPONENTS.values() for words in found.values() for p in words]


def pick(values) -> str:
    """One of some texts by turns."""
    return f"CASE j % {len(values)} " + " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else str(v) if isinstance(v, int) else f"'{v}'") for i, v in enumerate(values)) + " END"


def hint_of(phrase: str) -> str:
    """The label of the first hint whose words stand in a phrase."""
    return next(label for words, label in X.HINTS if f" {words} " in f" {phrase} ")


NAMES = ["system:node:n1", "system:kube-scheduler", "system:kube-controller-manager", "system:apiserver", "admin", "main.go:12"]
CODES = [200, 403, 404, 409, 503]
SERVICES = ["etcd", "argocd-server", "file-preview", "api", "prometheus"]
LETTERS = ["F", "E", "W", "I", "D", "T", "X"]
CODE = pick(CODES)


def wrapped(payload: str, name: str = "all.logs") -> str:
    return f"'{name}: [' || s || ', {{{payload}}}]'"


def at(rest: str) -> str:
    return f'"time": "\' || {T} || \'", {rest}'


@dataclass
class Shape:
    lines: list[str]
    kind: str = "solo"  # of its first line: solo, start or plain; others are plain
    told: dict[str, str] = field(default_factory=dict)  # columns that are not null, as SQL


SHAPES = [
    Shape(["replace(t, 'T', ' ') || ' ERROR worker failed id=' || CAST(1000000 + event_id AS STRING)", "'  at run (/srv/app/main.py)'", "'  caused by context deadline exceeded'"], "start"),
    Shape(["'node 081109 203615 148 INFO dfs.DataNode served block'"], "start"),
    Shape(["'x - 1117838570 2005.06.03 R02 kernel warning raised'"], "start"),
    Shape([f"{T} || ' etcd leader changed'"], "start", {"timestamp": T}),
    Shape(["'tail of trace'", "''", "'   '"], "plain"),
    Shape(["'{\"a\": '"], "plain"),
    Shape(
        [f"""'{{"requestReceivedTimestamp": "' || {T} || '", "user": {{"username": "' || {pick(NAMES)} || '"}}, "verb": "get", "objectRef": {{"resource": "pods"}}, "requestURI": "/api/v1/pods/' || event_id || '", "stage": "ResponseComplete", "responseStatus": {{"code": ' || {CODE} || '}}}}'"""],
        told={"timestamp": T, "service": pick([*NAMES[:5], None]), "actor": pick([*NAMES[:5], None]), "verb": "'get'", "resource": "'pods'", "path": "'/api/v1/pods/' || event_id", "stage": "'responsecomplete'", "response_code": CODE},
    ),
    Shape(["'after audit'"], "plain"),
    Shape(
        [f"'0,' || {T} || ',system:apiserver,list,pods,ns,x,x,/api/v1/pods,x,ResponseComplete,' || {CODE}"],
        told={"timestamp": T, "service": "'system:apiserver'", "actor": "'system:apiserver'", "verb": "'list'", "resource": "'pods'", "path": "'/api/v1/pods'", "stage": "'responsecomplete'", "response_code": CODE},
    ),
    Shape(
        [f"'1,' || {T} || ',svc-a,Watch,nodes,a,\"b,\"\"c\",d,/healthz,e,RequestReceived,'", "'more, of, it'"],
        "start",
        {"timestamp": T, "service": "'svc-a'", "actor": "'svc-a'", "verb": "'Watch'", "resource": "'nodes'", "path": "'/healthz'", "stage": "'requestreceived'"},
    ),
    Shape(
        [wrapped(at(f'"level": "error", "error": "unexpected status 503 from http://Billing.core.svc:80/api/v1/x", "msg": "call", "method": "GET", "user_name": "amy", "path": "/api/v1/x", "stream": "STDERR", "attr": {{"collection": "orders"}}, "kubernetes": {{"labels": {{"app.kubernetes.io/name": "\' || {pick(SERVICES)} || \'"}}, "pod_name": "p-0"}}'))],
        told={"timestamp": T, "told": "'ERROR'", "service": pick(SERVICES), "actor": "'amy'", "verb": "'get'", "resource": "'orders'", "path": "'/api/v1/x'", "stage": "'stderr'", "response_code": "503", "target": "'billing'", "target_fqdn": "'billing.core.svc'", "source_subtype": "'all.logs'", "inner_type": "'other_json'"},
    ),
    Shape(
        [wrapped(f'"t": {{"$date": "\' || {T} || \'"}}, "s": "\' || {pick(LETTERS)} || \'", "level": "info", "c": "NETWORK", "ctx": "conn7", "msg": "Connection  refused by peer", "attr": {{"db": "admin"}}')],
        told={"timestamp": T, "told": pick(["FATAL", "ERROR", "WARN", "INFO", "DEBUG", "TRACE", None]), "actor": "'conn7'", "verb": "NULL", "resource": "'admin'", "failure_hint": "'connection_refused'", "source_subtype": "'all.logs'", "inner_type": "'mongodb_structured'"},
    ),
    Shape(
        [wrapped('"caller": "trace/x.go:12", "msg": "context  deadline exceeded while fetch", "kubernetes": {"container_name": "kafka-controller"}', "asup.error.logs")],
        told={"timestamp": "t || '+00:00'", "service": "'kafka-controller'", "actor": "'kafka-controller'", "verb": "'fetch'", "failure_hint": "'timeout'", "source_subtype": "'asup.error.logs'", "inner_type": "'caller_msg_structured'"},
    ),
    Shape(
        [wrapped('"log": "[warning] POST /api/v1/pods status=404 retry", "kubernetes": {"pod_name": "milvus-etcd-0", "namespace_name": "db"}', "asup.error.logs")],
        told={"timestamp": "t || '+00:00'", "told": "'WARN'", "service": "'milvus-etcd-0'", "actor": "'milvus-etcd-0'", "verb": "'post'", "resource": "'milvus-etcd-0'", "path": "'/api/v1/pods'", "response_code": "404", "source_subtype": "'asup.error.logs'", "inner_type": "'log_field_generic'"},
    ),
    Shape(
        [wrapped(at(f'"statusCode": 200, "method": "HEAD", "uri": "/readyz", "kubernetes": {{"labels": {{"app": "\' || {pick(SERVICES)} || \'"}}}}'))],
        told={"timestamp": T, "service": pick(SERVICES), "actor": pick(SERVICES), "verb": "'head'", "path": "'/readyz'", "response_code": "200", "source_subtype": "'all.logs'", "inner_type": "'http_probe_or_access'"},
    ),
    Shape([wrapped(at('"responseStatus": {"code": "409"}, "level": "Warn", "caller": "amy", "msg": "conflict"'))], told={"timestamp": T, "told": "'WARN'", "actor": "'amy'", "response_code": "409", "source_subtype": "'all.logs'", "inner_type": "'caller_msg_structured'"}),
    Shape([wrapped(at('"response": {"status": 201}, "msg": "ok"'))], told={"timestamp": T, "response_code": "201", "source_subtype": "'all.logs'", "inner_type": "'other_json'"}),
    Shape([wrapped(at('"level": "warn", "msg": "slow"'))], told={"timestamp": T, "told": "'WARN'", "source_subtype": "'all.logs'", "inner_type": "'other_json'"}),
    Shape([wrapped(at('"msg": "all fine", "status": 999'))], told={"timestamp": T, "source_subtype": "'all.logs'", "inner_type": "'other_json'"}),
    Shape([f"""'note {{"requestReceivedTimestamp": "' || {T} || '", "verb": "watch", "stage": "Panic"}} end'"""], told={"timestamp": T, "verb": "'watch'", "stage": "'panic'"}),
    Shape(["'{}'"]),
    Shape([wrapped(at(f'"msg": "\' || {pick([w for w, _ in X.HINTS])} || \'"'))], told={"timestamp": T, "failure_hint": pick([hint_of(w) for w, _ in X.HINTS]), "source_subtype": "'all.logs'", "inner_type": "'other_json'"}),
    Shape([f"{T} || ' unit (' || {pick(WORDS)} || ') ready'"], "start", {"timestamp": T}),
]


def spark_lines(spark: SparkSession, d: str) -> DataFrame:
    """(file, event_id, i, line)."""
    e = table(spark, d, "events").where("event_id is not null and ts is not null").withColumn("us", micros())
    at_ = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("t")
    e = e.select("event_id", F.expr(f"event_id div {FILE_EVENTS}").alias("file"), (F.col("event_id") % len(SHAPES)).alias("shape"), F.expr(f"event_id div {len(SHAPES)}").alias("j"), at_, F.expr("us div 1000000").alias("s"))
    made = "CASE shape " + " ".join(f"WHEN {i} THEN array({', '.join(x.lines)})" for i, x in enumerate(SHAPES)) + " END"
    return e.select("file", "event_id", F.posexplode(F.expr(made)).alias("i", "line"))


def written(spark: SparkSession, d: str) -> str:
    """The folder that the log files have been written to, one folder a file."""
    path = new_path(spark, "logs")
    lines = spark_lines(spark, d).withColumn("file", F.concat(F.col("file").cast("string"), F.lit(".log")))
    lines.repartition("file").sortWithinPartitions("file", "event_id", "i").select("file", "line").write.partitionBy("file").text(path)
    return path


def file_number():
    return F.regexp_extract("source_file", r"file=(\d+)\.log", 1).cast("long")


def generated_records(spark: SparkSession, d: str) -> DataFrame:
    return logs.file_records(logs.file_lines(spark, written(spark, d)))


_LINES = "CASE shape " + " ".join(f"WHEN {i} THEN [{', '.join(x.lines)}]" for i, x in enumerate(SHAPES)) + " END"
_KIND = "CASE shape " + " ".join(f"WHEN {i} THEN '{x.kind}'" for i, x in enumerate(SHAPES)) + " END"
_RECORDS = f"""WITH src AS (SELECT event_id, event_id // {FILE_EVENTS} AS file, event_id % {len(SHAPES)} AS shape, event_id // {len(SHAPES)} AS j, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS t, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events WHERE event_id IS NOT NULL AND ts IS NOT NULL),
ln AS (SELECT *, unnest({_LINES}) AS line, generate_subscripts({_LINES}, 1) AS i FROM src),
lk AS (SELECT *, CASE WHEN i > 1 THEN 'plain' ELSE {_KIND} END AS kind FROM ln WHERE line <> ''),
lo AS (SELECT *, kind <> 'plain' OR coalesce(lag(kind) OVER (PARTITION BY file ORDER BY event_id, i) = 'solo', true) AS opens FROM lk),
ln2 AS (SELECT *, sum(opens::INT) OVER (PARTITION BY file ORDER BY event_id, i ROWS UNBOUNDED PRECEDING) AS record_no FROM lo),
rec AS (SELECT file, CAST(record_no AS BIGINT) AS record_no, string_agg(line, chr(10) ORDER BY event_id, i) AS raw, arg_min(CASE WHEN kind = 'plain' THEN -1 ELSE shape END, event_id * 10 + i) AS shape, min(event_id) AS event_id, arg_min(j, event_id * 10 + i) AS j, arg_min(t, event_id * 10 + i) AS t,
  arg_min(kind, event_id * 10 + i) AS kind FROM ln2 GROUP BY file, record_no)"""
_JSON = [i for i, x in enumerate(SHAPES) if x.kind == "solo" and "{" in x.lines[0]]
RECORDS_SQL = _RECORDS + f"\nSELECT file, record_no, raw, shape IN ({', '.join(map(str, _JSON))}) AS is_json FROM rec"

COLUMNS = "timestamp told service actor verb resource path stage response_code failure_hint target target_fqdn source_subtype inner_type".split()
_TOLD = ",\n  ".join(f"CAST(CASE shape {' '.join(f'WHEN {i} THEN {x.told[c]}' for i, x in enumerate(SHAPES) if c in x.told)} END AS {'INTEGER' if c == 'response_code' else 'VARCHAR'}) AS {c}" for c in COLUMNS)
_ROLE = "CASE WHEN lower(actor) LIKE 'system:node:%' THEN 'kubelet' WHEN lower(actor) LIKE 'system:kube-scheduler%' THEN 'kube-scheduler' WHEN lower(actor) LIKE 'system:kube-controller-manager%' THEN 'kube-controller-manager' WHEN lower(actor) LIKE 'system:apiserver%' THEN 'kube-apiserver' ELSE actor END"


def _named(column: str, only: str | None = None) -> str:
    """CASE branches: the components of a text, in order."""
    quoted = lambda p: "".join("\\" + c if not c.isalnum() and c not in "-_/ " else c for c in p)
    rule = lambda p: f"regexp_matches({column}, '(^|[^\\pL\\pN_]){quoted(p)}($|[^\\pL\\pN_])')"
    return " ".join(f"WHEN {rule(p)} THEN '{c}'" for found in X.COMPONENTS.values() for c, words in found.items() for p in words if only in (None, c))


def component_sql(actor: str, text: str) -> str:
    blob = f"lower(concat({actor}, ' ', {text}))"
    shared = f"WHEN contains({blob}, 'milvus-etcd') AND CASE {_named(blob, 'milvus-core')} END IS NOT NULL THEN 'milvus-core'"
    return f"CASE {shared} {_named(f'coalesce({actor}, chr(32))')} {_named(f'lower({text})')} ELSE 'unknown_component' END"


DOMAIN_SQL = "CASE component " + " ".join(f"WHEN '{c}' THEN '{d}'" for c, d in X.DOMAIN_OF.items()) + " END"
RAW_SEVERITY = "CASE WHEN lower(raw) LIKE '%error%' OR lower(raw) LIKE '%failed%' THEN 'ERROR' WHEN lower(raw) LIKE '%warn%' THEN 'WARN' WHEN lower(raw) LIKE '%info%' THEN 'INFO' END"
CODE_SEVERITY = "CASE WHEN response_code >= 500 OR response_code IN (401, 403) THEN 'ERROR' WHEN response_code >= 400 THEN 'WARN' WHEN response_code IS NOT NULL THEN 'INFO' END"
EVENTS_SQL = (
    _RECORDS
    + f""",
ex AS (SELECT file, record_no, raw, {_TOLD} FROM rec),
es AS (SELECT *, coalesce(told, {CODE_SEVERITY}, {RAW_SEVERITY}) AS severity, CASE WHEN response_code IS NOT NULL THEN (response_code // 100) || 'xx' END AS http_class, {_ROLE} AS role FROM ex),
ef AS (SELECT *, CASE WHEN response_code >= 400 THEN 'failure' WHEN response_code IS NOT NULL THEN 'normal' WHEN coalesce(CASE WHEN source_subtype IS NULL THEN severity ELSE told END, '') IN ('ERROR', 'FATAL') OR failure_hint IS NOT NULL THEN 'failure'
  WHEN CASE WHEN source_subtype IS NULL THEN severity ELSE told END = 'WARN' THEN 'warning' ELSE 'unknown' END AS status_family, {component_sql("role", "raw")} AS component FROM es),
em AS (SELECT *, {DOMAIN_SQL} AS domain, CASE WHEN response_code >= 500 THEN 'service_failure' WHEN response_code = 403 THEN 'authz_failure' WHEN response_code = 404 THEN 'resource_not_found' WHEN response_code = 409 THEN 'conflict' WHEN response_code >= 400 THEN 'client_error' WHEN status_family <> 'failure' THEN 'normal'
  WHEN failure_hint IN ('timeout', 'connection_refused', 'connection_reset', 'network_unreachable', 'dns_failure', 'tls_handshake', 'tls_certificate', 'replica_instability') THEN 'dependency_failure' WHEN failure_hint IN ('forbidden', 'unauthorized', 'access_denied', 'permission_denied') THEN 'authz_failure' ELSE 'service_failure' END AS failure_mode,
  CASE WHEN source_subtype IS NULL THEN NULL WHEN target IS NOT NULL THEN 'dependency_target' WHEN status_family = 'failure' THEN 'source_service' END AS failure_location FROM ef)
SELECT file, raw, timestamp, severity, service, actor, verb, resource, path, stage, response_code, http_class, status_family, failure_hint, target, target_fqdn, source_subtype, inner_type, failure_location, component, domain, failure_mode,
  concat_ws(':', component, nullif(verb, ''), nullif(resource, ''), failure_mode) AS signature,
  concat_ws(' | ', 'service: ' || service, 'severity: ' || lower(severity), 'verb: ' || verb, 'resource: ' || resource, 'http_class: ' || http_class) AS embedding_text FROM em"""
)

# Whole documents as log files: a text without braces or quotes has records of lines and rows of fields only.
_DOCUMENTS = r"""WITH ln AS (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS i FROM (SELECT doc_id, string_split_regex(text, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]') AS x FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)),
ls AS (SELECT *, CASE WHEN regexp_matches(trim(line), '^\{.*\}$') THEN json_valid(trim(line)) ELSE coalesce(json_valid(nullif(regexp_extract(line, '\{.*\}'), '')), false) END
  OR (len(line) - len(replace(line, ',', '')) >= 10 AND regexp_matches(line, 'ResponseStarted|ResponseComplete') AND contains(line, 'system:')) AS solo FROM ln WHERE line <> ''),
lo AS (SELECT *, solo OR regexp_matches(line, '\d{4}-\d{2}-\d{2}[\sT]\d{2}:\d{2}:\d{2}|\d{6}\s+\d{6}|-\s+\d+\s+\d{4}\.\d{2}\.\d{2}') OR coalesce(lag(solo) OVER (PARTITION BY doc_id ORDER BY i), true) AS opens FROM ls),
ln2 AS (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS record_no FROM lo),
rec AS (SELECT doc_id, CAST(record_no AS BIGINT) AS record_no, string_agg(line, chr(10) ORDER BY i) AS raw FROM ln2 GROUP BY doc_id, record_no)"""
DOCUMENT_RECORDS_SQL = _DOCUMENTS + r" SELECT *, CASE WHEN regexp_matches(trim(raw), '(?s)^\{.*\}$') THEN json_valid(trim(raw)) ELSE coalesce(json_valid(nullif(regexp_extract(raw, '(?s)\{.*\}'), '')), false) END AS is_json FROM rec"


def document_events_sql(redacted: str) -> str:
    """The events of ``_DOCUMENTS``; redacted: SQL for the redacted text of ``raw``."""
    value = lambda i: f"nullif(trim(c[{i + 1}]), '')"
    return (
        _DOCUMENTS
        + rf""",
rc AS (SELECT *, CASE WHEN len(x) >= 12 THEN x END AS c FROM (SELECT *, string_split(string_split(trim(raw), chr(10))[1], ',') AS x FROM rec)),
ex AS (SELECT doc_id, record_no, raw, coalesce(CASE WHEN contains({value(1)}, 'T') AND {value(1)} LIKE '%Z' THEN {value(1)} END, nullif(regexp_extract(raw, '\d{{4}}-\d\d-\d\dT\d\d:\d\d:\d\d(?:\.\d+)?Z'), '')) AS timestamp,
  {value(2)} AS actor, {value(3)} AS verb, {value(4)} AS resource, {value(8)} AS path, lower({value(10)}) AS stage, TRY_CAST(CASE WHEN regexp_matches({value(11)}, '^[+-]?\d+$') THEN {value(11)} END AS INTEGER) AS response_code FROM rc),
es AS (SELECT *, coalesce({CODE_SEVERITY}, {RAW_SEVERITY}) AS severity, CASE WHEN response_code IS NOT NULL THEN (response_code // 100) || 'xx' END AS http_class, {_ROLE} AS role FROM ex),
ef AS (SELECT *, CASE WHEN response_code >= 400 THEN 'failure' WHEN response_code IS NOT NULL THEN 'normal' WHEN severity IN ('ERROR', 'FATAL') THEN 'failure' WHEN severity = 'WARN' THEN 'warning' ELSE 'unknown' END AS status_family, {component_sql("role", "raw")} AS component FROM es),
em AS (SELECT *, CASE WHEN response_code BETWEEN 500 AND 599 THEN 'service_failure' WHEN response_code = 403 THEN 'authz_failure' WHEN response_code = 404 THEN 'resource_not_found' WHEN response_code = 409 THEN 'conflict' WHEN response_code BETWEEN 400 AND 499 THEN 'client_error' WHEN status_family = 'failure' THEN 'service_failure' ELSE 'normal' END AS failure_mode FROM ef)
SELECT sha256(doc_id || '|' || record_no) AS event_id, timestamp, severity, actor AS service, actor, verb, resource, path, stage, response_code, http_class, status_family, NULL::VARCHAR AS failure_hint, NULL::VARCHAR AS target, failure_mode,
  concat_ws(':', component, verb, resource, failure_mode) AS signature, raw AS raw_text, lower(trim(regexp_replace({redacted}, '\s+', ' ', 'g'))) AS normalized_text,
  concat_ws(' | ', 'service: ' || actor, 'severity: ' || lower(severity), 'verb: ' || verb, 'resource: ' || resource, 'http_class: ' || http_class) AS embedding_text FROM em"""
    )


# Pods of the event table: names by turns from every rule of the registry, from components and from neither.
_PODS = registry.bundled()
_NAMES = [f"{n}7f9c-x" for k, n, *_ in _PODS if k == "pod"] + ["KAFKA-Controller-0", "milvus-Etcd-1", "web-1", "", None]
_SPACES = [n for k, n, *_ in _PODS if k in ("namespace", "domain")] + [" Vault ", "other", None]
_BOXES = [*WORDS[::7], "sidecar", None, ""]
POD_COLUMNS = {"namespace": pick(_SPACES), "pod": pick(_NAMES), "container": pick(_BOXES)}


def spark_pods(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").where("event_id is not null").select("event_id", F.col("event_id").alias("j"))
    return e.select("event_id", *[F.expr(x).alias(c) for c, x in POD_COLUMNS.items()])


def _values(kind: str) -> str:
    return "(VALUES " + ", ".join(f"('{n}', '{v}', '{o}')" for k, n, v, o in _PODS if k == kind) + ") AS"


_POD_SQL = "WITH p AS (SELECT event_id, " + ", ".join(f"{x} AS {c}" for c, x in POD_COLUMNS.items()) + " FROM (SELECT event_id, event_id AS j FROM events WHERE event_id IS NOT NULL))"
_ACTOR = "coalesce(nullif(trim(container), ''), nullif(trim(pod), ''), '')"
PODS_SQL = f"""{_POD_SQL}, r AS (SELECT * FROM {_values('pod')} t(a, b, c)), n AS (SELECT * FROM {_values('namespace')} t(a, b, c)), h AS (SELECT * FROM {_values('domain')} t(a, b, c)),
q AS (SELECT DISTINCT pod, arg_max(b, len(a)) OVER (PARTITION BY pod) AS by_pod FROM (SELECT DISTINCT pod FROM p) JOIN r ON starts_with(lower(pod), a)),
x AS (SELECT p.*, coalesce(by_pod, n.b, 'unknown_asup_subsystem') AS pod_subsystem, {component_sql(_ACTOR, "concat_ws(' ', nullif(trim(pod), ''), nullif(trim(container), ''))")} AS component FROM p LEFT JOIN q USING (pod) LEFT JOIN n ON n.a = lower(trim(namespace)))
SELECT event_id, pod_subsystem, component, {DOMAIN_SQL} AS domain, coalesce({DOMAIN_SQL}, h.b, 'unknown_subsystem') AS subsystem FROM x LEFT JOIN h ON h.a = trim(namespace)"""
OWNERS_SQL = f"""{_POD_SQL}, s AS (SELECT * FROM {_values('system')} t(a, b, c)), x AS (SELECT container AS service, count(*) AS n, {component_sql("coalesce(container, '')", "''")} AS component FROM p GROUP BY container),
y AS (SELECT *, {DOMAIN_SQL} AS domain FROM x) SELECT service, n, component, coalesce(domain, 'unknown_domain') AS domain, coalesce(b, 'unknown_system') AS system, coalesce(c, 'unknown_owner') AS owner_hint FROM y LEFT JOIN s ON s.a = y.domain"""


# Lines with signals in the log files, and two lines before and after each.
_SIGNAL = " OR ".join("regexp_matches(line, '" + p.replace("'", "''") + "')" for p, _, _ in triage.SIGNALS)
SLICES_SQL = _RECORDS.split("lk AS")[0].rstrip().rstrip(",") + f""",
nu AS (SELECT file, row_number() OVER (PARTITION BY file ORDER BY event_id, i) AS line_no, line, {_SIGNAL} AS matched FROM ln)
SELECT * FROM nu AS a WHERE EXISTS (SELECT 1 FROM nu AS b WHERE b.matched AND b.file = a.file AND b.line_no BETWEEN a.line_no - 2 AND a.line_no + 2)"""
