r"""Columns that read log text: timestamps, codes, paths, verbs, hints, severities, redaction, components.

Patterns are Java regular expressions; \b and \w are ASCII unless (?U) is set, and matching ignores case where (?i) says so.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Failure hints in the order that decides, as (words, hint); a blank stands for any white space.
HINTS = (
    ("deadline exceeded", "timeout"), ("context deadline exceeded", "timeout"), ("connection refused", "connection_refused"), ("connection reset", "connection_reset"), ("tls handshake", "tls_handshake"),
    ("certificate", "tls_certificate"), ("dns", "dns_failure"), ("no such host", "dns_failure"), ("network unreachable", "network_unreachable"), ("timeout", "timeout"), ("rpc error", "rpc_error"),
    ("leader election", "leader_election_failure"), ("crashloopbackoff", "crash_loop"), ("oomkilled", "oom_killed"), ("out of memory", "oom"), ("replica set", "replica_instability"),
    ("primary not found", "replica_instability"), ("threshold exceeded", "threshold_exceeded"), ("exceeded", "threshold_exceeded"), ("exception", "exception"), ("panic", "panic"), ("forbidden", "forbidden"),
    ("unauthorized", "unauthorized"), ("access denied", "access_denied"), ("permission denied", "permission_denied"), ("failed", "failed"),
)

# Redactions in order, as (key, pattern); each works on the text that the ones before left.
REDACTIONS = (
    ("uuid", r"\b[0-9a-fA-F]{8}-[0-9a-fA-F\-]{27}\b"),
    ("ip", r"\b(\d{1,3}\.){3}\d{1,3}\b"),
    ("hex", r"\b0x[0-9a-fA-F]+\b"),
    ("num", r"\b\d{6,}\b"),
    ("path", r"(/[\w\-.]+)+"),
)

# Components by domain with the words that name them, in the order that decides.
COMPONENTS = {
    "control_plane": {
        "kube-apiserver": ["kube-apiserver", "apiserver"], "kube-controller-manager": ["kube-controller-manager", "controller-manager"], "kube-scheduler": ["kube-scheduler", "scheduler"], "etcd": ["etcd"],
        "rke2-server": ["rke2-server", "rke2 server", "rke2r1"], "rke2-agent": ["rke2-agent", "rke2 agent"], "traefik": ["traefik", "ingressroute", "ingress-controller"],
    },
    "node": {"kubelet": ["kubelet"], "kube-proxy": ["kube-proxy"]},
    "policy": {"gatekeeper": ["gatekeeper", "constraint", "constrainttemplates"], "kyverno": ["kyverno"], "opa": ["opa"], "vault": ["vault", "vault-agent-injector", "sidecar-injector"]},
    "gitops": {"argocd": ["argocd", "argocd-server", "argocd-application-controller"], "flux": ["flux", "fluxcd"]},
    "networking": {
        "calico-node": ["calico-node", "felix", "bird", "calico"], "calico-kube-controllers": ["calico-kube-controllers", "kube-controllers/ipam"], "metallb": ["metallb", "frr"], "tigera-operator": ["tigera-operator", "tigera"],
    },
    "storage": {
        "trident-operator": ["operator.trident.netapp.io", "trident-operator"], "trident-csi-controller": ["controller.csi.trident.netapp.io", "csi-attacher", "csi-provisioner", "csi-snapshotter"], "trident-main": ["trident-main"],
        "snapshot-controller": ["snapshot-controller", "csi-snapshotter"], "ontap-proxy": ["ontap-proxy"], "support-configuration": ["support-configuration"],
    },
    "observability": {
        "prometheus": ["prometheus", "kube-prometheus"], "fluent-bit": ["fluent-bit", "fluent"], "vector-store": ["vector-store", "vector-store-chart", "vector"], "log-rotation": ["log-rotation"],
        "file-metadata": ["file-metadata", "metadata-chart", "metadata"],
    },
    "data_platform": {
        "job-tracker": ["job-tracker"], "authorizer": ["authorizer"], "occmauth": ["occmauth"], "aide-control": ["aide", "dsai"], "policy-engine": ["policy-engine"], "kafka": ["kafka-controller", "kafka-exporter"],
        "content-processing": ["content-processing", "content-processing-datacollection", "content-processing-workspace"], "ocr-service": ["ocr-service"], "file-preview": ["file-preview"],
        "dcn-manager": ["dcn_manager", "dcn-manager", "dcn_mgr", "dcn manager"], "mongodb": ["mongodb", "mongod", "replicasetmonitor", "connpool"],
        "milvus-core": ["milvus-etcd", "milvus", "milvus-operator", "milvus-autoscaler", "mixcoord", "querynode", "datanode", "indexnode", "proxy"],
        "scheduler-worker": ["scheduler", "worker", "scheduler-manager", "job-manager"],
    },
    "hardware": {"gpu-operator": ["gpu-operator", "gpu"], "node-feature-discovery": ["node-feature-discovery"]},
}
DOMAIN_OF = {c: d for d, found in COMPONENTS.items() for c in found}


def text(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def found(col: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null without one."""
    # nullif would match twice
    return F.get(F.array_remove(F.array(F.regexp_extract(col, pattern, group)), ""), F.lit(0))


def failure_hint(col) -> Column:
    t = text(col)
    return F.coalesce(*[F.when(t.rlike(r"(?iU)\b" + words.replace(" ", r"\s+") + r"\b"), hint) for words, hint in HINTS])


def iso_timestamp(col) -> Column:
    return found(text(col), r"(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(?:\.\d+)?Z)")


def parsed_time(col) -> Column:
    """A timestamp in UTC; null for text that is no ISO date and time."""
    t = text(col)
    return F.when(t.rlike(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d"), F.expr(f"try_cast({col} as timestamp)") if isinstance(col, str) else t.try_cast("timestamp"))


def epoch_iso(col) -> Column:
    """ISO text in UTC of seconds since 1970, with microseconds where there are any; null for what is no number."""
    us = (text(col).try_cast("double") * 1_000_000).cast("bigint")
    at = F.timestamp_micros(us)
    whole = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(whole, F.when(us % 1_000_000 != 0, F.date_format(at, ".SSSSSS")).otherwise(""), F.lit("+00:00"))


def http_code(value: Column) -> Column:
    code = F.trim(value.cast("string")).try_cast("int")
    return F.when(code.between(100, 599), code)


def code_in_text(col) -> Column:
    t = text(col)
    return http_code(F.coalesce(found(t, r"(?i)(?:unexpected\s+status|status)[:=\s]+(\d{3})"), found(t, r"(?i)\b(?:status|code|response)\s*[=:]?\s*(\d{3})\b")))


def path_in_text(col) -> Column:
    t = text(col)
    return F.coalesce(found(t, r"(?i)(/(?:api|apis|v1|v2|metrics|healthz|readyz|livez)[A-Za-z0-9_\-./?=&%]*)"), found(t, r"""(https?://[^\s"']+|/[A-Za-z0-9_\-./?=&%]+)"""))


def verb_in_text(col) -> Column:
    t, methods = text(col), "GET|POST|PUT|PATCH|DELETE|HEAD|OPTIONS"
    return F.lower(F.coalesce(found(t, rf"(?i)\bmethod\s*=\s*({methods})\b"), found(t, rf"(?i)\b({methods})\b"), found(t, r"(?i)\b(fetch|send|connect|watch|list|create|delete|update|retry|read|write|process)\b")))


def severity_in_text(col) -> Column:
    t, words = text(col), "fatal|error|warn|warning|info|debug|trace"
    pattern = rf"(?i)\b(?:level|severity)\s*[:=]\s*({words})\b|\[({words})\]"
    s = F.upper(F.coalesce(found(t, pattern, 1), found(t, pattern, 2)))
    return F.when(s == "WARNING", "WARN").otherwise(s)


def dependency_host(col) -> Column:
    return F.lower(found(text(col), r"(?i)https?://([a-z0-9-]+(?:\.[a-z0-9-]+){1,6}\.svc)(?::\d+)?"))


def dependency_hosts(col) -> Column:
    """All service hosts of a text, each once."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text(col), F.lit(r"(?i)https?://([a-z0-9-]+(?:\.[a-z0-9-]+){1,6}\.svc)(?::\d+)?"), 1), F.lower))


def identity(col) -> Column:
    """An actor name; null for blanks and for names that are places in code."""
    v = F.trim(text(col).cast("string"))
    code = (v.startswith("{") & (v.contains("func") | v.contains("source"))) | v.rlike(r"\.go:|\.py:|\.java:") | (v.contains("/") & v.contains(":") & v.rlike(r"trace\.go|interceptor\.go"))
    return F.when((v != "") & ~code, v)


def redaction_steps(col) -> tuple[Column, dict[str, Column]]:
    """The text with all redactions, and the number of each."""
    t, counts = F.coalesce(text(col), F.lit("")), {}
    for key, pattern in REDACTIONS:
        counts[key] = F.regexp_count(t, F.lit(pattern))
        t = F.regexp_replace(t, pattern, f"<{key}>")
    return t, counts


def normalized(col) -> Column:
    """Redacted, white space collapsed, trimmed, lower case."""
    return F.lower(F.trim(F.regexp_replace(redaction_steps(col)[0], r"\s+", " ")))


def redactions(col) -> Column:
    """Map of redactions that happened to their number."""
    counts = redaction_steps(col)[1]
    return F.map_filter(F.create_map(*[x for k, v in counts.items() for x in (F.lit(k), v)]), lambda k, v: v > 0)


def embedding_text(service, severity, verb, resource, http_class) -> Column:
    named = (("service", service), ("severity", F.lower(text(severity))), ("verb", verb), ("resource", resource), ("http_class", http_class))
    return F.concat_ws(" | ", *[F.when(text(v) != "", F.concat(F.lit(f"{k}: "), text(v))) for k, v in named])


def actor_role(col) -> Column:
    a = F.lower(text(col))
    return F.when(a.startswith("system:node:"), "kubelet").when(a.startswith("system:kube-scheduler"), "kube-scheduler").when(a.startswith("system:kube-controller-manager"), "kube-controller-manager").when(a.startswith("system:apiserver"), "kube-apiserver").otherwise(text(col))


def _word(pattern: str) -> str:
    quoted = "".join("\\" + c if c in r".-/+*?()[]{}^$|\\" else c for c in pattern)
    return rf"(?U)\b{quoted}\b"


def component(actor, message) -> Column:
    """The first component, in the table's order, that the actor names, else that the text names."""
    a, t = F.coalesce(actor_role(actor), F.lit("")), F.lower(F.coalesce(text(message), F.lit("")))
    names = [(c, p) for found_ in COMPONENTS.values() for c, words in found_.items() for p in words]
    blob = F.lower(F.concat_ws(" ", a, t))
    special = F.when(blob.contains("milvus-etcd") & F.array_max(F.array(*[blob.rlike(_word(p)) for c, p in names if c == "milvus-core"])), "milvus-core")
    by = lambda x: [F.when(x.rlike(_word(p)), c) for c, p in names]
    return F.coalesce(special, *by(a), *by(t), F.lit("unknown_component"))


def component_domain(col) -> Column:
    table = F.create_map(*[F.lit(x) for pair in DOMAIN_OF.items() for x in pair])
    return F.try_element_at(table, text(col))


def signature(component_, operation, resource, mode) -> Column:
    return F.concat_ws(":", *[F.nullif(text(x), F.lit("")) for x in (component_, operation, resource, mode)])


def payload_type(payload, keys=None) -> Column:
    """Which of five shapes a JSON payload has, by the keys it holds; keys: a column that has them already."""
    keys = F.json_object_keys(text(payload)) if keys is None else text(keys)
    has = lambda key: F.array_contains(keys, key)
    dated = F.get_json_object(text(payload), "$.t['$date']").isNotNull()
    return (
        F.when(keys.isNull(), F.lit(None))
        .when(has("statusCode") & has("method"), "http_probe_or_access")
        .when(has("caller") & has("msg"), "caller_msg_structured")
        .when(dated, "mongodb_structured")
        .when(has("log"), "log_field_generic")
        .otherwise("other_json")
    )


def subsystem(namespace, pod, prefixes: dict[str, str], namespaces: dict[str, str], unknown: str = "unknown") -> Column:
    """The subsystem of a pod: by the longest prefix of its name that the table has, else by its namespace."""
    name = F.lower(F.coalesce(text(pod), F.lit("")))
    by_pod = [F.when(name.startswith(p), s) for p, s in sorted(prefixes.items(), key=lambda x: (-len(x[0]), x[0]))]
    by_space = [F.when(F.lower(F.trim(text(namespace))) == n, s) for n, s in namespaces.items()]
    return F.coalesce(*by_pod, *by_space, F.lit(unknown))


def float_or(col, default: float = 0.0) -> Column:
    return F.coalesce(text(col).try_cast("double"), F.lit(default))


def time_of(*cols) -> Column:
    """The first of several columns that is a time: ISO text, or seconds since 1970."""
    one = lambda c: F.coalesce(parsed_time(F.col(c).cast("string")), F.timestamp_micros((F.col(c).cast("string").try_cast("double") * 1_000_000).cast("bigint")))
    return F.coalesce(*[one(c) for c in cols])


def normalized_fields(columns: list[str]) -> list[Column]:
    """Several text columns, each redacted and collapsed."""
    return [normalized(c).alias(c) for c in columns]
