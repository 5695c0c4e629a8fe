"""Oracle SQL for DuckDB, one statement a query, on the same Parquet tables."""

from . import logtable


def _events(cluster: str) -> str:
    return f"""e0 AS (SELECT event_id, ts, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
e1 AS (SELECT event_id, epoch_us(ts) AS us, strftime(ts, '%Y-%m-%d') AS run_id, 'svc_' || (user_id % 8) AS service, 'user_' || user_id AS actor, event_type AS verb, 'res_' || (k % 10) AS resource,
  CASE WHEN event_type = 'error' THEN [500, 403, 404, 503][k % 4 + 1] WHEN event_type = 'signup' THEN 201 WHEN event_type = 'view' AND k % 10 = 0 THEN NULL ELSE 200 END AS response_code,
  CASE WHEN event_type = 'error' THEN ['timeout', 'forbidden', NULL, 'connection_refused'][k % 4 + 1] END AS failure_hint,
  CASE WHEN event_type = 'error' AND k % 3 = 0 THEN 'svc_' || ((user_id + 1) % 8) END AS target, {cluster} AS cluster_id FROM e0),
e2 AS (SELECT *, CASE WHEN response_code >= 500 OR response_code IN (401, 403) THEN 'ERROR' WHEN response_code >= 400 THEN 'WARN' WHEN response_code IS NOT NULL THEN 'INFO' END AS severity,
  CASE WHEN response_code >= 400 THEN 'failure' WHEN response_code IS NOT NULL THEN 'normal' ELSE 'unknown' END AS status_family,
  CASE WHEN response_code BETWEEN 200 AND 599 THEN (response_code // 100) || 'xx' ELSE 'unknown' END AS status_class,
  CASE WHEN response_code >= 500 THEN 'service_failure' WHEN response_code = 403 THEN 'authz_failure' WHEN response_code = 404 THEN 'resource_not_found' WHEN response_code >= 400 THEN 'client_error' ELSE 'normal' END AS failure_mode FROM e1),
ev AS (SELECT *, coalesce(response_code, 0) AS rc, coalesce(response_code >= 400, false) AS http, coalesce(response_code >= 400, false) OR coalesce(severity IN ('ERROR', 'FATAL'), false) OR status_family = 'failure' OR failure_hint IS NOT NULL AS bad FROM e2)"""


EV = "WITH " + _events("'C' || (user_id % 20)")
DAILY = "WITH " + _events("event_type || '_' || (user_id % 8)")

STATS = """,
c0 AS (SELECT run_id, cluster_id, count(*) AS event_count, count(*) FILTER (bad) AS error_count, count(*) FILTER (bad AND NOT http) AS fallback_error_count,
  min(us) AS first_us, max(us) AS last_us, count(DISTINCT coalesce(actor, service)) AS actors, count(DISTINCT service) AS services, count(DISTINCT CASE WHEN bad AND NOT http THEN failure_hint END) AS hint_diversity,
  avg(CASE WHEN actor <> '' THEN 1 ELSE 0 END) AS cov_actor, avg(CASE WHEN resource <> '' THEN 1 ELSE 0 END) AS cov_resource, avg(CASE WHEN verb <> '' THEN 1 ELSE 0 END) AS cov_verb,
  avg(CASE WHEN response_code IS NOT NULL THEN 1 ELSE 0 END) AS cov_response_code, avg(CASE WHEN failure_hint <> '' THEN 1 ELSE 0 END) AS cov_failure_hint FROM ev GROUP BY run_id, cluster_id),
c1 AS (SELECT *, greatest(1.0, (max(last_us) OVER r - min(first_us) OVER r) / 1e6) AS run_seconds, sum(event_count) OVER r AS run_events, greatest(1.0, (last_us - first_us) / 1e6) AS seconds,
  error_count / event_count AS error_rate, (cov_actor + cov_resource + cov_verb + cov_response_code + cov_failure_hint) / 5 AS coverage FROM c0 WINDOW r AS (PARTITION BY run_id)),
c2 AS (SELECT *, (event_count / seconds) / greatest(1e-9, run_events / run_seconds) AS burst_factor, CASE WHEN error_rate >= 0.8 THEN 3.0 WHEN error_rate >= 0.4 THEN 2.0 WHEN error_rate >= 0.1 THEN 1.0 ELSE 0.2 END::DOUBLE AS severity FROM c1),
c3 AS (SELECT *, severity * (1 + ln(1 + burst_factor)) * error_rate AS raw_trigger FROM c2),
c4 AS (SELECT *, raw_trigger * (0.5 + 0.5 * least(1.0, ln(1 + event_count) / 5)) * (0.7 + 0.3 * least(1.0, actors / 3)) AS x FROM c3),
c5 AS (SELECT *, round(x / (1 + x), 6) AS trigger_score FROM c4),
c6 AS (SELECT *, round(greatest(0.0, least(1.0, 0.45 * trigger_score + 0.25 * error_rate + 0.15 * coverage + 0.10 * least(1.0, 2 * fallback_error_count / event_count) + 0.05 * least(1.0, hint_diversity / 3))), 6) AS incident_strength FROM c5),
st AS (SELECT *, (trigger_score >= 0.12 OR error_count >= 3 OR fallback_error_count >= 3) AND (incident_strength >= 0.22 OR (error_rate >= 0.20 AND error_count >= 5) OR fallback_error_count >= 8 OR (fallback_error_count >= 4 AND hint_diversity >= 2 AND error_rate >= 0.05)) AS is_candidate FROM c6)"""

WINDOWS = STATS + """,
win AS (SELECT run_id, cluster_id, first_us AS start_us, least(last_us, first_us + 900000000) AS end_us, trigger_score, incident_strength, error_count, event_count FROM st WHERE is_candidate)"""


def _top(keys: str, value: str, k: int, source: str = "ev") -> str:
    return f"""SELECT {keys}, {value}, n, CAST(k AS INTEGER) AS rank FROM (SELECT {keys}, {value}, count(*) AS n, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, min(us), {value}) AS k
  FROM {source} WHERE {value} <> '' GROUP BY {keys}, {value}) WHERE k <= {k}"""


CODES = """,
codes AS (SELECT run_id, cluster_id, arg_max(response_code, n * 1e17 - first_at) AS code FROM (SELECT run_id, cluster_id, response_code, count(*) AS n, min(us) AS first_at FROM ev WHERE response_code <> 0 GROUP BY ALL) GROUP BY run_id, cluster_id),
dom AS (SELECT g.run_id, g.cluster_id, code AS dominant_code, CASE WHEN code = 403 THEN 3 ELSE 0 END + CASE WHEN r >= 3 THEN 1 ELSE 0 END AS rbac, CASE WHEN code = 401 THEN 3 ELSE 0 END AS auth, CASE WHEN code = 404 THEN 2 ELSE 0 END AS missing, CASE WHEN code >= 500 THEN 3 ELSE 0 END AS control
  FROM (SELECT run_id, cluster_id, count(DISTINCT resource) AS r FROM ev GROUP BY ALL) AS g LEFT JOIN codes USING (run_id, cluster_id)),
fd AS (SELECT run_id, cluster_id, dominant_code, CASE WHEN greatest(rbac, auth, missing, control) = 0 THEN 'unknown' WHEN rbac = greatest(rbac, auth, missing, control) THEN 'rbac_authorization' WHEN auth = greatest(rbac, auth, missing, control) THEN 'authentication'
  WHEN missing = greatest(rbac, auth, missing, control) THEN 'resource_missing' ELSE 'control_plane' END AS failure_domain, greatest(rbac, auth, missing, control) AS votes FROM dom)"""


def _best(value: str) -> str:
    return f"(SELECT run_id, cluster_id, {value} FROM (SELECT run_id, cluster_id, {value}, row_number() OVER (PARTITION BY run_id, cluster_id ORDER BY count(*) DESC, min(us), {value}) AS k FROM ev WHERE {value} <> '' GROUP BY run_id, cluster_id, {value}) WHERE k = 1)"


NODES = STATS + CODES + f""",
pr AS (SELECT st.run_id, st.cluster_id, first_us, trigger_score, error_count, a.actor, r.resource, failure_domain, row_number() OVER (PARTITION BY st.run_id ORDER BY first_us, trigger_score DESC, st.cluster_id) - 1 AS rk
  FROM st LEFT JOIN {_best('actor')} AS a USING (run_id, cluster_id) LEFT JOIN {_best('resource')} AS r USING (run_id, cluster_id) LEFT JOIN fd USING (run_id, cluster_id) WHERE error_count > 0),
ce AS (SELECT a.run_id, a.cluster_id AS source, b.cluster_id AS target, coalesce(a.actor = b.actor, false)::INT + coalesce(a.resource = b.resource, false)::INT + coalesce(a.failure_domain = b.failure_domain, false)::INT AS semantic_links, (b.first_us - a.first_us) // 1000000 AS lag_seconds
  FROM pr AS a JOIN pr AS b ON a.run_id = b.run_id AND b.rk > a.rk AND b.first_us - a.first_us <= 1800000000 AND (b.first_us - a.first_us <= 5000000 OR b.rk <= a.rk + 5)),
cs AS (SELECT *, round(least(1.0, 0.7 + 0.1 * semantic_links), 6) AS score FROM ce),
nx AS (SELECT run_id, cluster_id AS source, lead(cluster_id) OVER w AS target, (lead(first_us) OVER w - first_us) // 1000000 AS lag_seconds FROM pr WINDOW w AS (PARTITION BY run_id ORDER BY rk)),
gr AS (SELECT * FROM cs UNION ALL SELECT run_id, source, target, 0, lag_seconds, 0.6 FROM nx WHERE target IS NOT NULL AND run_id NOT IN (SELECT run_id FROM cs))"""

CANDS = NODES + """,
os AS (SELECT run_id, source AS cluster_id, sum(score) AS out_strength, count(*) AS out_degree FROM gr GROUP BY ALL),
ins AS (SELECT run_id, target AS cluster_id, sum(score) AS in_strength, count(*) AS in_degree FROM gr GROUP BY ALL),
k0 AS (SELECT pr.*, coalesce(out_strength, 0) AS out_strength, coalesce(in_strength, 0) AS in_strength, coalesce(out_degree, 0) AS out_degree, coalesce(in_degree, 0) AS in_degree FROM pr LEFT JOIN os USING (run_id, cluster_id) LEFT JOIN ins USING (run_id, cluster_id)),
k1 AS (SELECT *, CASE WHEN max(out_strength) OVER r > 0 THEN out_strength / max(out_strength) OVER r ELSE 0 END AS o, CASE WHEN max(in_strength) OVER r > 0 THEN in_strength / max(in_strength) OVER r ELSE 0 END AS i FROM k0 WINDOW r AS (PARTITION BY run_id)),
k2 AS (SELECT *, round(0.5 / (1 + rk) + 0.3 * trigger_score + 0.2 * (o - i) / (1 + o + i), 6) AS candidate_score FROM k1),
ca AS (SELECT run_id, cluster_id, candidate_score, CAST(rk AS INTEGER) AS temporal_rank, CAST(row_number() OVER (PARTITION BY run_id ORDER BY candidate_score DESC, rk) AS INTEGER) AS candidate_rank, out_degree, in_degree, round(out_strength, 6) AS out_strength, round(in_strength, 6) AS in_strength, failure_domain FROM k2)"""

ROOTS = """,
g0 AS (SELECT *, row_number() OVER (PARTITION BY run_id, cluster_id ORDER BY us, event_id) AS k FROM ev WHERE bad OR regexp_matches(lower(concat_ws(' ', verb, resource, failure_hint)), 'timeout|timed out|deadline exceeded|connection refused|connection reset|exception|failed')),
ro AS (SELECT run_id, cluster_id, event_id, us, CAST(k AS INTEGER) AS rank, response_code, status_family, severity, failure_hint, service, actor, resource, failure_mode, CASE WHEN k = 1 THEN 'earliest_failure' ELSE 'supporting_failure' END AS reason FROM g0 WHERE k <= 3),
evb AS (SELECT *, http OR status_family = 'failure' OR failure_hint IS NOT NULL OR failure_mode NOT IN ('normal', 'unknown') AS evil FROM ev)"""

ONSET = ROOTS + """,
onset AS (SELECT run_id, min(us) AS onset_us, max(us) AS last_us, arg_min(event_id, us) AS onset_event, arg_min(cluster_id, us) AS onset_cluster FROM ro WHERE status_family = 'failure' OR failure_hint IS NOT NULL GROUP BY run_id)"""

AFTER = ONSET + """,
af AS (SELECT evb.*, onset_us FROM evb JOIN onset USING (run_id) WHERE us >= onset_us)"""

NOON = """,
noon AS (SELECT run_id, min(us) // 86400000000 * 86400000000 + 43200000000 AS onset_us FROM ev GROUP BY run_id),
tl0 AS (SELECT run_id, us // 3600000000 AS bucket, count(*) AS total, count(*) FILTER (http OR severity = 'ERROR') AS failures FROM ev GROUP BY ALL),
sp AS (SELECT run_id, unnest(generate_series(lo, hi)) AS bucket FROM (SELECT run_id, min(bucket) AS lo, max(bucket) AS hi FROM tl0 GROUP BY run_id)),
tl AS (SELECT run_id, bucket, coalesce(total, 0) AS total, coalesce(failures, 0) AS failures FROM sp LEFT JOIN tl0 USING (run_id, bucket))"""

BUCKETS = """,
ab AS (SELECT run_id, bucket, cluster_id FROM (SELECT run_id, bucket, cluster_id, row_number() OVER (PARTITION BY run_id, bucket ORDER BY cluster_id) AS k FROM (SELECT DISTINCT run_id, us // 300000000 AS bucket, cluster_id FROM ev)) WHERE k <= 5)"""

SERIES = """,
s0 AS (SELECT run_id, cluster_id, us // 3600000000 AS bucket, count(*) AS n FROM ev GROUP BY ALL),
s1 AS (SELECT run_id, min(bucket) AS lo, max(bucket) AS hi FROM s0 GROUP BY run_id),
s2 AS (SELECT DISTINCT run_id, cluster_id, lo, hi FROM s0 JOIN s1 USING (run_id)),
s3 AS (SELECT run_id, cluster_id, lo, unnest(generate_series(lo, hi)) AS bucket FROM s2),
se AS (SELECT run_id, cluster_id, CAST(bucket - lo AS INTEGER) AS i, coalesce(n, 0) AS n FROM s3 LEFT JOIN s0 USING (run_id, cluster_id, bucket)),
s4 AS (SELECT *, n - lag(n) OVER (PARTITION BY run_id, cluster_id ORDER BY i) AS rise, max(n) OVER (PARTITION BY run_id, cluster_id) AS pk FROM se),
ss AS (SELECT run_id, cluster_id, CAST(sum(n) AS BIGINT) AS events, max(n) AS peak, min(i) FILTER (n = pk) AS peak_bucket, coalesce(min(i) FILTER (n >= greatest(2, ceil(0.2 * pk))), 0) AS onset_bucket, round(coalesce(max(rise), 0) / greatest(1, sum(n)), 6) AS acceleration FROM s4 GROUP BY ALL)"""

PATTERNS = f""",
bh AS (SELECT run_id, cluster_id, a.service, b.verb, c.resource, d.status_class FROM {_best('service')} AS a FULL JOIN {_best('verb')} AS b USING (run_id, cluster_id) FULL JOIN {_best('resource')} AS c USING (run_id, cluster_id) FULL JOIN {_best('status_class')} AS d USING (run_id, cluster_id)),
bc AS (SELECT run_id, cluster_id, count(*) AS events, count(*) FILTER (bad) AS errors, min(us) AS first_us, max(us) AS last_us FROM ev GROUP BY ALL),
bp AS (SELECT run_id, service, verb, resource, status_class, count(*) AS clusters, CAST(sum(events) AS BIGINT) AS events, CAST(sum(errors) AS BIGINT) AS errors, min(first_us) AS first_us, max(last_us) AS last_us FROM bh JOIN bc USING (run_id, cluster_id) GROUP BY ALL),
pt AS (SELECT *, CASE status_class WHEN '5xx' THEN 'service_failure' WHEN '4xx' THEN 'authz' ELSE 'other' END AS domain, coalesce(regexp_matches(service, 'kube-|apiserver|etcd|controller'), false) AS control_plane FROM bp),
pw AS (SELECT *, 1 / row_number() OVER (PARTITION BY run_id ORDER BY first_us, service, verb, resource, status_class) AS weight FROM pt),
d0 AS (SELECT run_id, domain, count(*) AS patterns, CAST(sum(events) AS BIGINT) AS events, CAST(sum(errors) AS BIGINT) AS errors, count(DISTINCT service) AS actors, round(sum(weight * errors), 6) AS score, min(first_us) AS first_us FROM pw WHERE domain <> 'other' OR errors > 0 GROUP BY ALL),
dc AS (SELECT *, CAST(row_number() OVER (PARTITION BY run_id ORDER BY score DESC, first_us, domain) AS INTEGER) AS rank, errors > 0 AND patterns > 0 AS valid_root FROM d0)"""

FP = ROOTS + """,
fp AS (SELECT run_id, arg_min(response_code, us) AS primary_code, arg_min(actor, us) AS primary_actor, 'unknown_component' AS component, arg_min(failure_mode, us) AS mode, count(DISTINCT actor) AS actors, count(DISTINCT resource) AS resources, count(DISTINCT service) AS services, count(*) AS events FROM ro GROUP BY run_id),
fq AS (SELECT *, CASE WHEN primary_code = 403 THEN 'authorization_failure' WHEN primary_code = 401 THEN 'authentication_failure' WHEN primary_code = 404 THEN 'resource_missing_or_unavailable' WHEN primary_code >= 500 THEN 'server_or_control_plane_failure'
  WHEN primary_code >= 400 THEN 'client_or_api_failure' WHEN mode = 'authz_failure' THEN 'authorization_failure' ELSE 'unknown' END AS pattern FROM fp)"""

CONF = ROOTS + """,
sup AS (SELECT run_id, count(*) AS events FROM ro GROUP BY run_id),
cl AS (SELECT *, lead(candidate_score) OVER (PARTITION BY run_id ORDER BY candidate_rank) AS second FROM ca),
cg AS (SELECT cl.*, coalesce(events, 0) AS events, round(greatest(0.0, candidate_score - coalesce(second, 0)), 6) AS gap FROM cl LEFT JOIN sup USING (run_id) WHERE candidate_rank = 1),
cf AS (SELECT *, round(0.35 * least(1.0, candidate_score) + 0.20 * least(1.0, gap / 0.25) + 0.20 / (1 + temporal_rank) + 0.15 * CASE WHEN out_degree + in_degree > 0 THEN out_degree / (1 + out_degree + in_degree) ELSE 0 END + 0.10 * least(1.0, events / 5), 6) AS confidence FROM cg)"""

VEC = """WITH n AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ce AS (SELECT label, list(x ORDER BY i) AS c FROM (SELECT label, i, avg(e[i]) AS x FROM (SELECT label, e, unnest(generate_series(1, len(e))) AS i FROM n) GROUP BY ALL) GROUP BY label),
un AS (SELECT label, list_transform(c, lambda x: CAST(x / (sqrt(list_sum(list_transform(c, lambda y: y * y))) + 1e-12) AS FLOAT)) AS c FROM ce),
dt AS (SELECT vec_id, n.label AS own, un.label, list_sum(list_transform(list_zip(e, un.c), lambda z: z[1] * CAST(z[2] AS DOUBLE))) AS s FROM n, un)"""

_PATH = r"(/[\w\-.]+)+"
_REDACT, _REDACT_RAW = "text", "raw"
for _key, _pattern in (("uuid", r"\b[0-9a-fA-F]{8}-[0-9a-fA-F\-]{27}\b"), ("ip", r"\b(\d{1,3}\.){3}\d{1,3}\b"), ("hex", r"\b0x[0-9a-fA-F]+\b"), ("num", r"\b\d{6,}\b"), ("path", _PATH)):
    _REDACT, _REDACT_RAW = (f"regexp_replace({_x}, '{_pattern}', '<{_key}>', 'g')" for _x in (_REDACT, _REDACT_RAW))

INCIDENT = """,
inc AS (SELECT run_id, min(first_us) AS start_us, max(least(last_us, first_us + 900000000)) AS end_us FROM st WHERE is_candidate GROUP BY run_id)"""

RANKED = """,
pa AS (SELECT run_id, source, target, 1 AS d FROM cs UNION SELECT pa.run_id, pa.source, cs.target, d + 1 FROM pa JOIN cs ON cs.run_id = pa.run_id AND cs.source = pa.target WHERE d < 4),
dn AS (SELECT run_id, source AS cluster_id, count(DISTINCT target) AS downstream, count(DISTINCT target) FILTER (d = 1) AS direct FROM pa GROUP BY ALL),
me AS (SELECT ev.*, start_us, end_us FROM ev JOIN st USING (run_id, cluster_id) JOIN inc USING (run_id) WHERE is_candidate),
md AS (SELECT run_id, quantile_cont(us, 0.5) AS split, min(us) FILTER (us BETWEEN start_us AND end_us AND CASE WHEN response_code IS NULL THEN coalesce(severity, '') IN ('ERROR', 'WARN') ELSE response_code >= 400 END) AS ab FROM me GROUP BY run_id),
mf AS (SELECT run_id, cluster_id, start_us, end_us, coalesce(any_value(ab), start_us) AS onset_us, min(us) AS first_us, count(*) AS size, count(*) FILTER (severity = 'ERROR') AS ne, count(*) FILTER (severity = 'WARN') AS nw, count(*) FILTER (severity = 'INFO') AS ni,
  greatest(200, coalesce(max(response_code), 200)) // 100 AS worst, coalesce(bool_and(response_code BETWEEN 200 AND 299), false) AS good, count(*) FILTER (us < split) AS pre FROM me JOIN md USING (run_id) GROUP BY run_id, cluster_id, start_us, end_us),
ow AS (SELECT cs.run_id, source AS cluster_id, sum(cs.score) AS w FROM cs JOIN st ON st.run_id = cs.run_id AND st.cluster_id = source WHERE is_candidate GROUP BY ALL),
iw AS (SELECT cs.run_id, target AS cluster_id, sum(cs.score) AS w FROM cs JOIN st ON st.run_id = cs.run_id AND st.cluster_id = source WHERE is_candidate GROUP BY ALL),
al AS (SELECT mf.*, coalesce(ow.w, 0) AS wo, coalesce(iw.w, 0) AS wi, trigger_score, error_count, coalesce(direct, 0) AS direct, coalesce(downstream, 0) AS downstream, mf.size / sum(mf.size) OVER (PARTITION BY mf.run_id) AS sh, st.event_count / run_events AS part,
  count(*) FILTER (trigger_score > 0.5 OR error_count > 5) OVER (PARTITION BY mf.run_id) AS strong FROM mf JOIN st USING (run_id, cluster_id) LEFT JOIN dn USING (run_id, cluster_id) LEFT JOIN ow USING (run_id, cluster_id) LEFT JOIN iw USING (run_id, cluster_id)),
sp AS (SELECT *, (size - 2 * pre) / size AS ch, greatest(0.0, least(5.0, wo - 0.5 * wi + 0.1 * ln(1 + size) + CASE WHEN part >= 0.20 THEN -2.0 ELSE -1.5 END)) AS sr, 1 - least(1.0, greatest(0.0, (first_us - onset_us) / 1e6) / greatest(60.0, (end_us - start_us) / 1e6)) AS px,
  least(4.0, 0.4 * direct) + ln(1 + downstream) AS rc_, CASE worst WHEN 5 THEN 3.0 WHEN 4 THEN 2.4 WHEN 3 THEN 1.0 ELSE 0.6 END * CASE WHEN good AND wo <= 0 THEN 0.2 ELSE 1 END * CASE WHEN sh > 0.15 AND wo <= 0 THEN 0.3 ELSE 1 END * CASE WHEN first_us < start_us THEN 0.4 ELSE 1 END AS fc,
  CASE WHEN first_us <= start_us THEN 6 WHEN first_us < start_us + 30000000 THEN 4 WHEN first_us < start_us + 120000000 THEN 2 ELSE 0 END AS bn FROM al WHERE strong < 3 OR trigger_score > 0.5 OR error_count > 5),
sk AS (SELECT *, round((sr * greatest(0.25, least(2.0, 1 + ch)) * greatest(0.5, least(2.0, 1 + 0.25 * (2.0 * ne + nw - 0.7 * ni) / size)) + 3 * px + 2 * trigger_score + 0.4 * sqrt(error_count) + rc_) * fc + bn, 6) AS score FROM sp),
rk AS (SELECT run_id, 'I1' AS incident_id, cluster_id, start_us, onset_us, first_us, size, round(ch, 6) AS change, round(px, 6) AS proximity, round(rc_, 6) AS reach, round(fc, 6)::DOUBLE AS factor, round(wo, 6) AS out_weight, round(wi, 6) AS in_weight, round(sh, 6) AS share, bn AS bonus, score,
  CAST(row_number() OVER (PARTITION BY run_id ORDER BY score DESC, cluster_id) AS INTEGER) AS rank FROM sk)"""

PACKETS = RANKED + """,
tx AS (SELECT run_id, cluster_id, event_id, us, service, response_code AS code, concat_ws(' ', verb, resource, failure_hint) AS text, row_number() OVER (PARTITION BY run_id, cluster_id ORDER BY event_id) AS place FROM ev),
fr AS (SELECT * FROM tx WHERE place <= 100),
sv AS (SELECT run_id, cluster_id, service, count(*) AS n, min(place) AS at, row_number() OVER (PARTITION BY run_id, cluster_id ORDER BY count(*) DESC, min(place)) AS k FROM fr GROUP BY run_id, cluster_id, service),
sl AS (SELECT run_id, cluster_id, string_agg(service || ':' || n, ',' ORDER BY k) FILTER (k <= 5) AS services FROM sv GROUP BY ALL),
xt AS (SELECT run_id, cluster_id, text, row_number() OVER (PARTITION BY run_id, cluster_id ORDER BY min(place)) AS k FROM fr GROUP BY run_id, cluster_id, text),
xl AS (SELECT run_id, cluster_id, string_agg(text, '|' ORDER BY k) FILTER (k <= 3) AS examples FROM xt GROUP BY ALL),
hc AS (SELECT run_id, cluster_id, '2xx:' || count(*) FILTER (code // 100 = 2) || ',3xx:' || count(*) FILTER (code // 100 = 3) || ',4xx:' || count(*) FILTER (code // 100 = 4) || ',5xx:' || count(*) FILTER (code // 100 = 5)
  || ',other:' || count(*) FILTER (code // 100 NOT BETWEEN 2 AND 5) || ',unknown:' || count(*) FILTER (code IS NULL) AS classes FROM fr GROUP BY ALL),
ea AS (SELECT run_id, cluster_id, arg_min(tx, struct_pack(a := us, b := event_id)) AS e, count(*) AS size, min(us) AS first_us, max(us) AS last_us FROM tx GROUP BY ALL),
ty AS (SELECT run_id, cluster_id, CASE WHEN size / sum(size) OVER (PARTITION BY run_id) >= 0.20 THEN 'baseline' WHEN size / sum(size) OVER (PARTITION BY run_id) <= 0.05 THEN 'minor_pattern' ELSE 'contextual' END AS cluster_type FROM ea),
nr AS (SELECT r.run_id, r.cluster_id, way, o.cluster_id AS other, row_number() OVER (PARTITION BY r.run_id, way ORDER BY g.score DESC, o.cluster_id) AS k FROM rk AS r
  JOIN (SELECT run_id, source AS a, target AS b, score, 'out' AS way FROM cs UNION ALL SELECT run_id, target, source, score, 'in' FROM cs) AS g ON g.run_id = r.run_id AND g.a = r.cluster_id JOIN rk AS o ON o.run_id = r.run_id AND o.cluster_id = g.b WHERE r.rank = 1),
gc AS (SELECT run_id, cluster_id, count(*) FILTER (way = 'in') AS in_degree, count(*) FILTER (way = 'out') AS out_degree, string_agg(other, ',' ORDER BY k) FILTER (way = 'in' AND k <= 10) AS in_edges, string_agg(other, ',' ORDER BY k) FILTER (way = 'out' AND k <= 10) AS out_edges FROM nr GROUP BY ALL),
pk AS (SELECT rk.*, round(greatest(0, least(1, 0.40 * least(1, score / 100) + 0.20 * least(1, trigger_score / 5) + 0.15 * least(1, ln(1 + error_count) / 5) + 0.15 * least(1, greatest(0, out_weight - 0.5 * in_weight) / 10) + 0.10 * least(1, proximity))), 3) AS confidence
  FROM rk JOIN st USING (run_id, cluster_id) WHERE rank <= 6)"""

ORACLE = {
    "evidence_packets": DAILY.replace("WITH ", "WITH RECURSIVE ", 1) + NODES + INCIDENT + PACKETS + """ SELECT pk.run_id, pk.cluster_id, rank, CASE rank WHEN 1 THEN 'root_cause' ELSE 'candidate' END AS role, score, confidence, CASE WHEN confidence >= 0.8 THEN 'high' WHEN confidence >= 0.55 THEN 'medium' ELSE 'low' END AS label,
  ea.size, cluster_type, ea.first_us, last_us, services, classes, examples, e.event_id AS first_event, e.event_id AS representative, e.text AS first_text, coalesce(in_edges, '') AS in_edges, coalesce(out_edges, '') AS out_edges, coalesce(in_degree, 0) AS in_degree, coalesce(out_degree, 0) AS out_degree
  FROM pk JOIN ea USING (run_id, cluster_id) JOIN ty USING (run_id, cluster_id) JOIN sl USING (run_id, cluster_id) JOIN xl USING (run_id, cluster_id) JOIN hc USING (run_id, cluster_id) LEFT JOIN gc USING (run_id, cluster_id)""",
    "packet_timeline": DAILY.replace("WITH ", "WITH RECURSIVE ", 1) + NODES + INCIDENT + PACKETS + """ SELECT pk.run_id, incident_id, CAST(row_number() OVER (PARTITION BY pk.run_id ORDER BY e.us, score DESC, rank) AS INTEGER) AS place, e.us, pk.cluster_id, score, e.event_id, e.service, e.code AS response_code, e.text AS summary
  FROM pk JOIN ea USING (run_id, cluster_id) WHERE rank <= 5""",
    "packet_stats": DAILY.replace("WITH ", "WITH RECURSIVE ", 1) + NODES + INCIDENT + PACKETS + " SELECT run_id, 'I1' AS incident_id, inc.start_us, inc.end_us, count(rk.cluster_id) AS candidate_count, coalesce(bool_or(rank = 1), false) AS has_root_cause FROM inc LEFT JOIN rk USING (run_id) GROUP BY ALL",
    "canonical_events": EV + " SELECT event_id, us, run_id, service, actor, verb, resource, response_code, failure_hint, target, cluster_id, severity, status_family, status_class, failure_mode FROM ev",
    "status_classes": EV + " SELECT run_id, cluster_id, count(*) FILTER (rc BETWEEN 200 AND 399) AS n_2xx, count(*) FILTER (rc BETWEEN 400 AND 499) AS n_4xx, count(*) FILTER (rc >= 500) AS n_5xx, count(*) FILTER (rc < 200) AS n_unknown FROM ev GROUP BY run_id, cluster_id",
    "run_windows": EV + " SELECT run_id, count(*) AS n, min(us) AS first_us, max(us) AS last_us, greatest(1.0, (max(us) - min(us)) / 1e6) AS seconds, round(count(*) / greatest(1.0, (max(us) - min(us)) / 1e6), 9) AS rate FROM ev GROUP BY run_id",
    "trigger_base": EV + STATS + " SELECT run_id, cluster_id, event_count, error_count, round(burst_factor, 6) AS burst_factor, round(error_rate, 6) AS error_rate, severity, round(raw_trigger, 6) AS raw_trigger FROM st",
    "trigger_stats": EV + STATS + " SELECT run_id, cluster_id, event_count, error_count, fallback_error_count, actors, services, hint_diversity, round(coverage, 6) AS coverage, trigger_score, incident_strength, is_candidate FROM st",
    "top_actors": EV + _top("run_id, cluster_id", "actor", 5).join([" ", ""]),
    "dominant_values": EV + f" SELECT run_id, cluster_id, actor, resource, service FROM {_best('actor')} FULL JOIN {_best('resource')} USING (run_id, cluster_id) FULL JOIN {_best('service')} USING (run_id, cluster_id)",
    "top_modes": EV + f", t AS (SELECT run_id, cluster_id, count(*) AS total FROM ev GROUP BY ALL) SELECT run_id, cluster_id, failure_mode, n, rank, round(n / total, 6) AS ratio FROM ({_top('run_id, cluster_id', 'failure_mode', 5)}) JOIN t USING (run_id, cluster_id)",
    "hint_diversity": EV + " SELECT run_id, cluster_id, count(DISTINCT failure_hint) AS hints, count(*) AS events FROM ev WHERE failure_hint IS NOT NULL GROUP BY run_id, cluster_id",
    "dependency_targets": EV + _top("run_id, cluster_id", "target", 5).join([" ", ""]),
    "transitions": EV + ", f AS (SELECT *, http OR status_family = 'failure' AS b, rc BETWEEN 200 AND 399 AS g FROM ev), l AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY run_id, cluster_id ORDER BY us, event_id), false) AND g AS turn FROM f)"
    " SELECT run_id, cluster_id, count(*) FILTER (turn) AS failure_to_success, count(*) FILTER (bad) AS errors, CASE WHEN count(*) FILTER (bad) > 0 THEN round(least(1.0, count(*) FILTER (turn) / count(*) FILTER (bad)), 6) ELSE 0 END AS recovery_strength FROM l GROUP BY run_id, cluster_id",
    "minute_activity": EV + ", m AS (SELECT run_id, cluster_id, us // 60000000 AS minute, count(*) AS n FROM ev GROUP BY ALL), a AS (SELECT run_id, cluster_id, list_sort(list(n)) AS a FROM m GROUP BY ALL)"
    " SELECT run_id, cluster_id, CAST(len(a) AS INTEGER) AS minutes, a[len(a) // 2 + 1] AS p50, a[least(len(a) - 1, CAST(floor(len(a) * 0.95) AS INTEGER)) + 1] AS p95 FROM a",
    "field_coverage": EV + STATS + " SELECT run_id, cluster_id, round(cov_actor, 6) AS cov_actor, round(cov_resource, 6) AS cov_resource, round(cov_verb, 6) AS cov_verb, round(cov_response_code, 6) AS cov_response_code, round(cov_failure_hint, 6) AS cov_failure_hint, round(coverage, 6) AS coverage,"
    " concat_ws(',', CASE WHEN cov_actor < 0.2 THEN 'low_actor_coverage' END, CASE WHEN cov_resource < 0.2 THEN 'low_resource_coverage' END, CASE WHEN cov_response_code < 0.1 THEN 'low_response_code_coverage' END) AS low_flags FROM st",
    "suppression_hints": EV + ", x AS (SELECT run_id, cluster_id, lower(concat_ws(' ', verb, resource, failure_hint, failure_hint, resource)) AS t FROM ev), h AS (SELECT run_id, cluster_id, count(*) AS n, count(*) FILTER (regexp_matches(t, 'startup|boot|warmup|initializing')) AS startup,"
    " count(*) FILTER (regexp_matches(t, 'deploy|rollout|deployment|upgrading')) AS deploy, count(*) FILTER (regexp_matches(t, 'maintenance|drain|cordon|planned')) AS maintenance, count(*) FILTER (regexp_matches(t, 'health|liveness|readiness|probe')) AS healthcheck,"
    " count(*) FILTER (regexp_matches(t, 'retry|backoff')) AS retry_hints, count(*) FILTER (regexp_matches(t, 'recovered|recovery|restored|stabilized')) AS recovered_hints FROM x GROUP BY ALL) SELECT *, round((startup + deploy + maintenance + healthcheck) / n, 6) AS ratio FROM h",
    "cluster_windows": EV + WINDOWS + " SELECT * FROM win",
    "gap_sessions": EV + ", g AS (SELECT *, CASE WHEN us - lag(us) OVER w <= 120000000 THEN 0 ELSE 1 END AS new FROM ev WINDOW w AS (PARTITION BY run_id ORDER BY us, event_id)), s AS (SELECT *, sum(new) OVER (PARTITION BY run_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS session FROM g)"
    " SELECT run_id, CAST(session AS BIGINT) AS session, min(us) AS start_us, max(us) AS end_us, count(*) AS events, count(DISTINCT cluster_id) AS clusters FROM s GROUP BY run_id, session",
    "chained_windows": EV + WINDOWS + ", g AS (SELECT *, CASE WHEN start_us <= lag(end_us) OVER w + 30000000 THEN 0 ELSE 1 END AS new FROM win WINDOW w AS (PARTITION BY run_id ORDER BY start_us, end_us, cluster_id))"
    " SELECT run_id, cluster_id, start_us, end_us, CAST(sum(new) OVER (PARTITION BY run_id ORDER BY start_us, end_us, cluster_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS chain FROM g",
    "episodes": EV.replace("WITH ", "WITH RECURSIVE ", 1) + WINDOWS + ", o AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY start_us, end_us, cluster_id) AS k FROM win),"
    " f AS (SELECT run_id, cluster_id, start_us, end_us, k, 1 AS episode, start_us AS first FROM o WHERE k = 1 UNION ALL SELECT o.run_id, o.cluster_id, o.start_us, o.end_us, o.k, CASE WHEN j THEN episode ELSE episode + 1 END, CASE WHEN j THEN first ELSE o.start_us END"
    " FROM (SELECT o.*, f.episode, f.first, o.start_us <= f.end_us + 120000000 AND (greatest(f.end_us, o.end_us) - f.first) // 1000000 <= 1200 AS j FROM f JOIN o ON o.run_id = f.run_id AND o.k = f.k + 1) AS o)"
    " SELECT run_id, cluster_id, start_us, end_us, episode FROM f",
    "mode_similarity": EV + f", m AS (SELECT run_id, cluster_id, list(failure_mode) AS m FROM ({_top('run_id, cluster_id', 'failure_mode', 5)}) GROUP BY ALL) SELECT a.run_id, a.cluster_id AS a, b.cluster_id AS b, round(len(list_intersect(a.m, b.m)) / len(list_distinct(list_concat(a.m, b.m))), 6) AS jaccard FROM m AS a JOIN m AS b ON a.run_id = b.run_id AND a.cluster_id < b.cluster_id",
    "failure_domain": EV + CODES + " SELECT * FROM fd",
    "causal_edges": DAILY + NODES + " SELECT * FROM cs",
    "fallback_edges": DAILY + NODES + " SELECT run_id, source, target, 0 AS semantic_links, lag_seconds, 0.6::DOUBLE AS score FROM nx WHERE target IS NOT NULL",
    "root_candidates": DAILY + CANDS + " SELECT * FROM ca",
    "grounded_events": EV + ROOTS + " SELECT * FROM ro",
    "windowed_grounding": EV + ", w AS (SELECT run_id, min(us) AS s FROM ev GROUP BY run_id), x AS (SELECT ev.run_id, cluster_id, event_id, us, response_code, round(greatest(0.0, 1 - (us - s) / 1e6 / 300) + CASE WHEN response_code >= 500 THEN 2 ELSE 1 END, 6) AS score FROM ev JOIN w USING (run_id) WHERE http AND us <= s + 3600000000),"
    " y AS (SELECT *, row_number() OVER (PARTITION BY run_id, cluster_id ORDER BY score DESC, us, event_id) AS k FROM x) SELECT run_id, 'I1' AS incident_id, cluster_id, event_id, us, response_code, score, CAST(k AS INTEGER) AS rank FROM y WHERE k <= 3",
    "confidence_gap": DAILY + CANDS + CONF + " SELECT run_id, cluster_id, candidate_score, gap, events, confidence, CASE WHEN confidence >= 0.80 THEN 'high' WHEN confidence >= 0.55 THEN 'medium' ELSE 'low' END AS label FROM cf",
    "chain_edges": DAILY + CANDS + ", h AS (SELECT gr.*, row_number() OVER (PARTITION BY run_id ORDER BY lag_seconds, score DESC, target) AS k FROM gr JOIN (SELECT run_id, cluster_id AS source FROM ca WHERE candidate_rank = 1) USING (run_id, source)) SELECT run_id, source, semantic_links, target, lag_seconds, score, CAST(k AS INTEGER) AS rank FROM h WHERE k <= 5",
    "downstream_reach": DAILY.replace("WITH ", "WITH RECURSIVE ", 1) + NODES + ", p AS (SELECT run_id, source, target, 1 AS d FROM cs UNION SELECT p.run_id, p.source, cs.target, d + 1 FROM p JOIN cs ON cs.run_id = p.run_id AND cs.source = p.target WHERE d < 4) SELECT run_id, source AS cluster_id, count(DISTINCT target) AS downstream FROM p GROUP BY ALL",
    "anomaly_onset": EV + ONSET + " SELECT run_id, onset_us, onset_event, onset_cluster, (last_us - onset_us) // 1000000 AS spread_seconds FROM onset",
    "post_impacts": EV + AFTER + " SELECT run_id, count(*) AS events, count(*) FILTER (evil) AS failures, count(*) FILTER (status_class = '2xx') AS n_2xx, count(*) FILTER (status_class = '3xx') AS n_3xx, count(*) FILTER (status_class = '4xx') AS n_4xx, count(*) FILTER (status_class = '5xx') AS n_5xx, count(*) FILTER (response_code IS NULL) AS n_null,"
    " min(us) FILTER (response_code >= 500) AS first_5xx_us, count(DISTINCT service) FILTER (evil) AS services, count(DISTINCT resource) FILTER (evil) AS resources FROM af GROUP BY run_id",
    "impact_breakdown": EV + AFTER + f", x AS (SELECT run_id, us, 'service' AS kind, service AS value FROM af WHERE evil UNION ALL SELECT run_id, us, 'resource', resource FROM af WHERE evil UNION ALL SELECT run_id, us, 'failure_mode', failure_mode FROM af WHERE evil) {_top('run_id, kind', 'value', 5, 'x')}",
    "dependency_edges": EV + AFTER + ", g AS (SELECT run_id, service AS source, target, count(*) AS n, min(us) AS first_us FROM af WHERE evil AND target IS NOT NULL GROUP BY ALL), h AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY n DESC, first_us, source, target) AS k FROM g),"
    " i AS (SELECT *, CAST(row_number() OVER (PARTITION BY run_id ORDER BY first_us, n DESC, source, target) AS INTEGER) AS impact FROM h WHERE k <= 10) SELECT run_id, source, target, n, first_us, impact, CASE WHEN impact = 1 THEN 'primary' ELSE 'secondary' END AS impact_rank FROM i",
    "failure_lift": EV + ROOTS + NOON + ", x AS (SELECT run_id, failure_mode, count(*) FILTER (us < onset_us) AS pre_count, count(*) FILTER (us >= onset_us) AS post_count FROM evb JOIN noon USING (run_id) WHERE evil AND us BETWEEN onset_us - 3600000000 AND onset_us + 3600000000 GROUP BY ALL)"
    " SELECT *, round(pre_count / 3600, 6) AS pre_rate, round(post_count / 3600, 6) AS post_rate, CASE WHEN pre_count > 0 THEN round(post_count / pre_count, 6) END AS lift FROM x",
    "timeline": EV + NOON + " SELECT * FROM tl",
    "spike_shape": EV + NOON + ", x AS (SELECT run_id, bucket * 3600000000 AS t, failures, onset_us AS s, onset_us + 10800000000 AS e FROM tl JOIN noon USING (run_id)), y AS (SELECT run_id, max(failures) AS peak, count(*) FILTER (t BETWEEN s AND e) AS n_in, coalesce(avg(failures) FILTER (t < s), 0) AS a, coalesce(avg(failures) FILTER (t BETWEEN s AND e), 0) AS b, coalesce(avg(failures) FILTER (t > e), 0) AS c FROM x GROUP BY run_id)"
    " SELECT run_id, 'I1' AS incident_id, peak, round(a, 6) AS pre_avg, round(b, 6) AS in_avg, round(c, 6) AS post_avg, CASE WHEN peak <= 0 THEN 'flat_or_no_failure_signal' WHEN n_in = 0 THEN 'insufficient_data' WHEN b < greatest(1.0, a * 1.2) THEN 'weak_spike' WHEN c <= b * 0.4 THEN 'spike_and_recover' WHEN c >= b * 0.8 THEN 'spike_and_plateau' ELSE 'spike_and_drop' END AS shape FROM y",
    "orphan_checks": EV + " SELECT 'event' AS kind, count(*) AS n FROM ev WHERE verb = 'signup' HAVING count(*) > 0 UNION ALL SELECT 'cluster', count(*) FROM (SELECT DISTINCT cluster_id FROM ev) WHERE cluster_id NOT IN (SELECT cluster_id FROM ev WHERE service <> 'svc_3') HAVING count(*) > 0",
    "null_profile": EV + ", n AS (SELECT count(*) AS n FROM ev), x AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({'true' if c == 'path' else c + ' IS NULL'}) AS nulls FROM ev" for c in ("service", "actor", "verb", "resource", "path", "response_code", "failure_hint", "target"))
    + ') SELECT "column", nulls, round(100.0 * nulls / n, 4) AS percent FROM x, n',
    "class_counts": EV + " SELECT severity, status_family, status_class, count(*) AS n FROM ev GROUP BY ALL",
    "run_diagnostics": EV + " SELECT run_id, count(*) AS events, count(*) FILTER (severity = 'ERROR') AS n_error, count(*) FILTER (severity = 'WARN') AS n_warn, count(*) FILTER (severity = 'INFO') AS n_info, count(*) FILTER (severity IS NULL) AS n_none, 1.0::DOUBLE AS cov_actor, 1.0::DOUBLE AS cov_resource, 1.0::DOUBLE AS cov_verb,"
    " round(avg((response_code IS NOT NULL)::INT), 6) AS cov_response_code, round(avg((failure_hint IS NOT NULL)::INT), 6) AS cov_failure_hint FROM ev GROUP BY run_id",
    "embedding_texts": EV + ", t AS (SELECT concat_ws(' | ', 'service: ' || service, 'severity: ' || lower(severity), 'verb: ' || verb, 'resource: ' || resource, 'http_class: ' || status_class) AS embedding_text FROM ev) SELECT embedding_text, count(*) AS n, (count(*) < 5)::INT AS noise FROM t GROUP BY embedding_text",
    "document_triage": "WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), h AS (SELECT doc_id, regexp_matches(line, 'license') AS a, regexp_matches(line, 'the') AS b, regexp_matches(line, '[0-9]{6}') AS c FROM l)"
    " SELECT doc_id, count(*) AS lines, count(*) FILTER (a OR b OR c) AS matched_lines, CAST(sum(6 * a::INT + b::INT + 4 * c::INT) AS BIGINT) AS weighted_score, round(count(*) FILTER (a OR b OR c) / count(*), 6) AS density FROM h GROUP BY doc_id",
    "knn_topk": "WITH n AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings), p AS (SELECT q.vec_id AS query_id, n.vec_id, round(list_sum(list_transform(list_zip(q.e, n.e), lambda z: z[1] * z[2])), 5) AS score FROM n AS q, n WHERE q.vec_id % 100 = 0 AND q.vec_id <> n.vec_id),"
    " r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p) SELECT * FROM r WHERE rank <= 5",
    "nearest_centroid": VEC + " SELECT vec_id, arg_max(label, s) AS nearest, round(max(s), 5) AS cosine FROM dt GROUP BY vec_id",
    "representatives": VEC + " SELECT label, arg_max(vec_id, s) AS representative, round(max(s), 5) AS score, count(*) AS size FROM dt WHERE own = label GROUP BY label",
    "cluster_types": EV + ", c AS (SELECT run_id, cluster_id, count(*) AS size, min(us) AS first_us, max(us) AS last_us, arg_min(event_id, us) AS representative FROM ev GROUP BY ALL), f AS (SELECT *, size / sum(size) OVER (PARTITION BY run_id) AS p FROM c)"
    " SELECT run_id, cluster_id, size, first_us, last_us, representative, CASE WHEN p >= 0.20 THEN 'baseline' WHEN p <= 0.05 THEN 'minor_pattern' ELSE 'contextual' END AS cluster_type FROM f",
    "cooccurrence": EV + BUCKETS + " SELECT x.run_id, x.cluster_id AS a, y.cluster_id AS b, count(*) AS n FROM ab AS x JOIN ab AS y ON x.run_id = y.run_id AND x.bucket = y.bucket AND x.cluster_id < y.cluster_id GROUP BY ALL",
    "precedence": EV + BUCKETS + " SELECT x.run_id, x.cluster_id AS source, y.cluster_id AS target, round(sum(0.7 ** (y.bucket - x.bucket - 1)), 6) AS weight, count(*) AS n FROM ab AS x JOIN ab AS y ON x.run_id = y.run_id AND y.bucket - x.bucket BETWEEN 1 AND 3 AND x.cluster_id <> y.cluster_id GROUP BY ALL",
    "series_stats": EV + SERIES + " SELECT * FROM ss",
    "acceleration_scaled": EV + SERIES + ", m AS (SELECT *, min(acceleration) OVER (PARTITION BY run_id) AS a, max(acceleration) OVER (PARTITION BY run_id) AS b FROM ss) SELECT run_id, cluster_id, round(CASE WHEN b > a THEN (acceleration - a) / (b - a) ELSE 0 END, 6) AS scaled FROM m",
    "lag_correlation": EV + SERIES + ", bz AS (SELECT run_id, cluster_id FROM (SELECT run_id, cluster_id, row_number() OVER (PARTITION BY run_id ORDER BY sum(n) DESC, cluster_id) AS k FROM se GROUP BY run_id, cluster_id) WHERE k <= 15), sb AS (SELECT se.* FROM se JOIN bz USING (run_id, cluster_id)),"
    " j AS (SELECT x.run_id, x.cluster_id AS a, y.cluster_id AS b, y.i - x.i AS lag, count(*) AS m, sum(x.n)::DOUBLE AS sx, sum(y.n)::DOUBLE AS sy, sum(x.n * x.n)::DOUBLE AS sxx, sum(y.n * y.n)::DOUBLE AS syy, sum(x.n * y.n)::DOUBLE AS sxy FROM sb AS x JOIN sb AS y ON x.run_id = y.run_id AND x.cluster_id <> y.cluster_id AND y.i - x.i BETWEEN 1 AND 10 GROUP BY ALL HAVING count(*) >= 3),"
    " r AS (SELECT *, CASE WHEN m * sxx - sx * sx > 0 AND m * syy - sy * sy > 0 THEN round((m * sxy - sx * sy) / (sqrt(m * sxx - sx * sx) * sqrt(m * syy - sy * sy)), 6) ELSE 0 END AS r FROM j), z AS (SELECT *, row_number() OVER (PARTITION BY run_id, a, b ORDER BY r DESC, lag) AS k FROM r) SELECT run_id, a, b, lag, r FROM z WHERE k = 1 AND r >= 0.25",
    "bucket_scores": EV + STATS + ", t AS (SELECT run_id, min(us) AS t0 FROM ev GROUP BY run_id), b AS (SELECT DISTINCT run_id, cluster_id, (us - t0) // 600000000 AS bucket FROM ev JOIN t USING (run_id)) SELECT run_id, bucket, round(max(CASE WHEN trigger_score >= 0.1 THEN trigger_score * least(3, error_count) ELSE 0 END), 6) AS score FROM b JOIN st USING (run_id, cluster_id) GROUP BY run_id, bucket",
    "retry_loops": EV + ", x AS (SELECT run_id, service, us // 900000000 AS slot, count(*) AS events, min(us) AS start_us, max(us) AS end_us, count(*) FILTER (severity = 'ERROR') AS errors, count(*) FILTER (severity = 'WARN') AS warnings, count(*) FILTER (status_class = '5xx') AS n_5xx,"
    " count(*) FILTER (regexp_matches(lower(concat_ws(' ', verb, resource, failure_hint)), 'retry|retrying|backoff|reconnect|attempt|timeout|refused')) AS retry_hits, count(DISTINCT cluster_id) AS clusters FROM ev GROUP BY ALL) SELECT * FROM x WHERE events >= 3 AND (errors >= 2 OR warnings >= 3 OR n_5xx >= 1) AND retry_hits >= 2",
    "change_score": EV + ", m AS (SELECT run_id, quantile_cont(us, 0.5) AS split FROM ev GROUP BY run_id), x AS (SELECT run_id, cluster_id, count(*) FILTER (us < split) AS pre, count(*) FILTER (us >= split) AS post FROM ev JOIN m USING (run_id) GROUP BY ALL) SELECT *, round((post - pre) / (post + pre), 6) AS change FROM x",
    "incident_graph": EV + ", x AS (SELECT run_id, us // 3600000000 AS slot, min(us) AS s, max(us) AS e, arg_min(service, us) AS root, list(DISTINCT service) AS services, count(*) FILTER (status_class = '4xx') AS n4, count(*) FILTER (status_class = '5xx') AS n5 FROM ev WHERE severity = 'ERROR' GROUP BY ALL),"
    " p AS (SELECT a.run_id, a.slot AS i, b.slot AS j, 0.35::DOUBLE + CASE WHEN list_contains(a.services, b.root) THEN 0.35::DOUBLE ELSE 0 END + CASE WHEN a.root = b.root THEN 0.2::DOUBLE ELSE 0 END + CASE WHEN a.n5 > 0 AND b.n4 > 0 THEN 0.1::DOUBLE ELSE 0 END AS sc, a.root = b.root AS same, b.s - a.e AS gap FROM x AS a JOIN x AS b ON a.run_id = b.run_id AND b.slot > a.slot AND b.s - a.e < 1201000000)"
    " SELECT run_id, 'W' || i AS source, 'W' || j AS target, CASE WHEN same THEN 'continued_incident_phase' ELSE 'downstream_incident' END AS relationship, round(least(sc, 0.99), 3)::DOUBLE AS confidence, gap // 1000000 AS gap_seconds FROM p WHERE sc >= 0.45",
    "behaviour_patterns": EV + PATTERNS + " SELECT * FROM pt",
    "domain_candidates": EV + PATTERNS + " SELECT * FROM dc",
    "chain_roles": EV + PATTERNS + " SELECT pt.run_id, CAST(row_number() OVER (PARTITION BY pt.run_id ORDER BY pt.first_us, service, verb, resource, status_class) AS INTEGER) AS step, service, verb, resource, status_class, CASE WHEN pt.domain = dc.domain THEN 'root' WHEN pt.errors > 0 AND pt.first_us <= dc.first_us THEN 'propagation' WHEN pt.errors > 0 THEN 'impact' ELSE 'context' END AS role FROM pt JOIN dc ON pt.run_id = dc.run_id AND dc.rank = 1",
    "churn_penalties": EV + " SELECT run_id, cluster_id, 0.0::DOUBLE AS churn, 0.0::DOUBLE AS penalty FROM ev GROUP BY run_id, cluster_id",
    "failure_patterns": EV + FP + " SELECT * FROM fq",
    "blast_radius": EV + FP + ", s AS (SELECT run_id, count(DISTINCT cluster_id) AS clusters, (max(us) - min(us)) // 1000000 AS duration FROM ev GROUP BY run_id) SELECT run_id, pattern, CASE WHEN clusters >= 20 THEN 'cluster-wide' WHEN clusters >= 5 THEN 'multi-component' ELSE 'localized' END AS scope,"
    " CASE WHEN pattern = 'server_or_control_plane_failure' OR duration >= 120 THEN 'high' WHEN duration >= 30 THEN 'medium' ELSE 'low' END AS severity, CAST(least(5, greatest(1, clusters // 5)) AS INTEGER) AS depth, actors, resources, clusters, duration FROM fq JOIN s USING (run_id)",
    "redact_documents": rf"SELECT doc_id, md5({_REDACT}) AS digest, len(regexp_extract_all(text, '\b[0-9a-fA-F]{{8}}-[0-9a-fA-F\-]{{27}}\b')) AS uuid, len(regexp_extract_all(regexp_replace(text, '\b[0-9a-fA-F]{{8}}-[0-9a-fA-F\-]{{27}}\b', '<uuid>', 'g'), '\b(\d{{1,3}}\.){{3}}\d{{1,3}}\b')) AS ip,"
    r" len(regexp_extract_all(text, '\b0x[0-9a-fA-F]+\b')) AS hex, len(regexp_extract_all(regexp_replace(regexp_replace(text, '\b(\d{1,3}\.){3}\d{1,3}\b', '<ip>', 'g'), '\b0x[0-9a-fA-F]+\b', '<hex>', 'g'), '\b\d{6,}\b')) AS num FROM documents",
    "split_windows": EV.replace("WITH ", "WITH RECURSIVE ", 1) + WINDOWS + ", g AS (SELECT *, CASE WHEN start_us <= lag(end_us) OVER w + 30000000 THEN 0 ELSE 1 END AS new FROM win WINDOW w AS (PARTITION BY run_id ORDER BY start_us, end_us, cluster_id)),"
    " ch AS (SELECT *, CAST(sum(new) OVER (PARTITION BY run_id ORDER BY start_us, end_us, cluster_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS chain FROM g), o AS (SELECT *, row_number() OVER (PARTITION BY run_id, chain ORDER BY start_us, end_us, cluster_id) AS k FROM ch),"
    " f AS (SELECT run_id, cluster_id, start_us, end_us, chain, k, 1 AS part, start_us AS first, end_us AS reach FROM o WHERE k = 1 UNION ALL SELECT run_id, cluster_id, start_us, end_us, chain, k, CASE WHEN j THEN part ELSE part + 1 END, CASE WHEN j THEN first ELSE start_us END, CASE WHEN j THEN greatest(reach, end_us) ELSE end_us END"
    " FROM (SELECT o.*, f.part, f.first, f.reach, o.start_us <= f.reach + 30000000 AND (greatest(f.reach, o.end_us) - f.first) // 1000000 <= 14400 AS j FROM f JOIN o ON o.run_id = f.run_id AND o.chain = f.chain AND o.k = f.k + 1) AS x)"
    " SELECT run_id, cluster_id, start_us, end_us, chain, part FROM f",
    "graph_checks": "SELECT * FROM (VALUES ('graph', true, 0::BIGINT), ('candidates', true, 0), ('roots', true, 0)) AS t(\"check\", passed, violations)",
    "triage_ranking": "WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), h AS (SELECT doc_id, regexp_matches(line, 'license') AS a, regexp_matches(line, 'the') AS b, regexp_matches(line, '[0-9]{6}') AS c FROM l),"
    " g AS (SELECT doc_id, count(*) AS lines, count(*) FILTER (a OR b OR c) AS matched_lines, CAST(sum(6 * a::INT + b::INT + 4 * c::INT) AS BIGINT) AS weighted_score, round(count(*) FILTER (a OR b OR c) / count(*), 6) AS density FROM h GROUP BY doc_id)"
    " SELECT * FROM g WHERE weighted_score >= 10 ORDER BY weighted_score DESC, matched_lines DESC, density DESC, doc_id LIMIT 40",
    "assertions": DAILY + CANDS + CONF + ", q AS (SELECT cg.run_id, round(out_strength - in_strength, 9) AS net, round(candidate_score - coalesce(second, 0), 6) AS gap, (SELECT count(*) FROM ro WHERE ro.run_id = cg.run_id) AS seen, (SELECT avg((status_family = 'failure' OR failure_hint IS NOT NULL)::INT) FROM ro WHERE ro.run_id = cg.run_id) AS fr FROM cg)"
    " SELECT run_id, 'A0_declaration_allowed' AS assertion, 'inconclusive' AS status FROM q UNION ALL SELECT run_id, 'A1_net_influence_positive', CASE WHEN net > 0 THEN 'pass' ELSE 'fail' END FROM q UNION ALL SELECT run_id, 'A2_score_gap_significant', CASE WHEN gap >= 0.10 THEN 'pass' ELSE 'fail' END FROM q"
    " UNION ALL SELECT run_id, 'A3_root_events_failures', CASE WHEN coalesce(fr, 0) = 1 THEN 'pass' ELSE 'fail' END FROM q UNION ALL SELECT run_id, 'A4_claim_coverage_complete', CASE WHEN seen > 0 THEN 'pass' ELSE 'fail' END FROM q UNION ALL SELECT run_id, 'A5_possible_incident_bound', 'inconclusive' FROM q"
    " UNION ALL SELECT run_id, 'A6_observed_logs_present', CASE WHEN seen > 0 THEN 'pass' ELSE 'fail' END FROM q",
    "episode_signatures": EV.replace("WITH ", "WITH RECURSIVE ", 1) + WINDOWS + ", o AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY start_us, end_us, cluster_id) AS k FROM win),"
    " f AS (SELECT run_id, cluster_id, start_us, end_us, incident_strength, k, 1 AS episode, start_us AS first FROM o WHERE k = 1 UNION ALL SELECT run_id, cluster_id, start_us, end_us, incident_strength, k, CASE WHEN j THEN episode ELSE episode + 1 END, CASE WHEN j THEN first ELSE start_us END"
    " FROM (SELECT o.*, f.episode, f.first, o.start_us <= f.end_us + 120000000 AND (greatest(f.end_us, o.end_us) - f.first) // 1000000 <= 1200 AS j FROM f JOIN o ON o.run_id = f.run_id AND o.k = f.k + 1) AS x),"
    + f" ms AS (SELECT run_id, episode, string_agg(DISTINCT failure_mode, ',' ORDER BY failure_mode) AS modes FROM f JOIN ({_top('run_id, cluster_id', 'failure_mode', 5)}) USING (run_id, cluster_id) GROUP BY ALL), ts AS (SELECT run_id, episode, string_agg(DISTINCT target, ',' ORDER BY target) AS targets FROM f JOIN ({_top('run_id, cluster_id', 'target', 5)}) USING (run_id, cluster_id) GROUP BY ALL),"
    " e AS (SELECT run_id, episode, min(start_us) AS start_us, max(end_us) AS end_us, count(*) AS windows, round(sum(incident_strength), 6) AS strength FROM f GROUP BY ALL)"
    " SELECT e.*, coalesce(modes, '') AS modes, coalesce(targets, '') AS targets FROM e LEFT JOIN ms USING (run_id, episode) LEFT JOIN ts USING (run_id, episode)",
    "record_assembly": logtable.RECORDS_SQL,
    "log_events": logtable.EVENTS_SQL,
    "log_slices": logtable.SLICES_SQL,
    "pod_registry": logtable.PODS_SQL,
    "service_owners": logtable.OWNERS_SQL,
    "document_records": logtable.DOCUMENT_RECORDS_SQL,
    "document_events": logtable.document_events_sql(_REDACT_RAW),
    "symptoms": EV + ROOTS + ", v AS (SELECT run_id, us, 'response_code' AS kind, CAST(response_code AS VARCHAR) AS value FROM ro UNION ALL SELECT run_id, us, 'actor', actor FROM ro UNION ALL SELECT run_id, us, 'resource', resource FROM ro),"
    " r AS (SELECT run_id, kind, value, count(*) AS n, row_number() OVER (PARTITION BY run_id, kind ORDER BY count(*) DESC, min(us), value) AS k FROM v WHERE value <> '' GROUP BY run_id, kind, value) SELECT run_id, kind, value, n, CAST(k AS INTEGER) AS rank FROM r WHERE k <= 3",
    "provenance": EV + ROOTS + STATS + ", g AS (SELECT run_id, count(*) AS o, count(*) FILTER (response_code >= 400) AS h, count(*) FILTER (status_family = 'failure' OR failure_hint <> '') AS m, count(*) FILTER (service <> '') AS c FROM ro GROUP BY run_id),"
    " k AS (SELECT run_id, bool_or(is_candidate) AS e FROM st GROUP BY run_id) SELECT run_id, coalesce(o, 0) AS observed_events, coalesce(h, 0) AS http_events, coalesce(m, 0) AS multisignal_events, coalesce(c, 0) AS component_events, CASE WHEN o > 0 THEN 'logs_only' WHEN e THEN 'inferred_from_candidates' ELSE 'inferred_only' END AS root_cause_source, false AS external_context_used FROM k LEFT JOIN g USING (run_id)",
    "overall_lift": EV + ROOTS + NOON + ", x AS (SELECT run_id, count(*) FILTER (us < onset_us) AS pre_events, count(*) FILTER (us >= onset_us) AS post_events, count(*) FILTER (evil AND us < onset_us) AS pre_failures, count(*) FILTER (evil AND us >= onset_us) AS post_failures"
    " FROM evb JOIN noon USING (run_id) WHERE us BETWEEN onset_us - 3600000000 AND onset_us + 3600000000 GROUP BY run_id) SELECT *, round(pre_failures / 3600, 6) AS pre_rate, round(post_failures / 3600, 6) AS post_rate, CASE WHEN pre_failures > 0 THEN round(post_failures / pre_failures, 6) END AS lift FROM x",
    "window_lift": EV + ROOTS + NOON + ", x AS (SELECT run_id, failure_mode, count(*) FILTER (us < onset_us) AS pre_count, count(*) FILTER (us >= onset_us) AS in_count FROM evb JOIN noon USING (run_id) WHERE evil AND us BETWEEN onset_us - 10800000000 AND onset_us + 10800000000 GROUP BY ALL)"
    " SELECT run_id, 'I1' AS incident_id, failure_mode, pre_count, in_count, CASE WHEN pre_count > 0 THEN round(in_count / pre_count, 6) END AS lift FROM x",
    "cluster_features": EV + " SELECT run_id, cluster_id, max(status_class) FILTER (status_class <> 'unknown') AS worst_class, bool_and(coalesce(response_code BETWEEN 200 AND 399, false)) AS all_success, min(us) AS first_us, max(us) AS last_us,"
    " count(*) FILTER (severity = 'ERROR') AS n_error, count(*) FILTER (severity = 'WARN') AS n_warn, count(*) FILTER (severity = 'INFO') AS n_info, arg_min(event_id, (us, event_id)) AS representative FROM ev GROUP BY run_id, cluster_id",
    "neighbours": DAILY + NODES + INCIDENT + ", k AS (SELECT *, row_number() OVER (PARTITION BY run_id, source ORDER BY score DESC, target) AS k FROM cs), o AS (SELECT run_id, source AS cluster_id, round(sum(score), 6) AS out_weight, string_agg(target, ',' ORDER BY k) FILTER (k <= 5) AS targets FROM k GROUP BY ALL),"
    " i AS (SELECT run_id, target AS cluster_id, round(sum(score), 6) AS in_weight FROM cs GROUP BY ALL), b AS (SELECT run_id, cluster_id, coalesce(out_weight, 0) AS out_weight, coalesce(targets, '') AS targets, coalesce(in_weight, 0) AS in_weight FROM o FULL JOIN i USING (run_id, cluster_id))"
    " SELECT b.*, CAST(CASE WHEN first_us <= start_us THEN 6 WHEN first_us < start_us + 30000000 THEN 4 WHEN first_us < start_us + 120000000 THEN 2 ELSE 0 END AS INTEGER) AS bonus FROM b LEFT JOIN st USING (run_id, cluster_id) LEFT JOIN inc USING (run_id)",
    "ranked_causes": DAILY.replace("WITH ", "WITH RECURSIVE ", 1) + NODES + INCIDENT + RANKED + " SELECT * FROM rk WHERE rank <= 5",
    "even_samples": EV + ", r AS (SELECT run_id, event_id, us, row_number() OVER (PARTITION BY run_id ORDER BY us, event_id) - 1 AS r, count(*) OVER (PARTITION BY run_id) AS n FROM ev), p AS (SELECT DISTINCT run_id, CASE WHEN n <= 100 THEN i ELSE i * (n - 1) // 99 END AS r FROM (SELECT DISTINCT run_id, n FROM r), generate_series(0, 99) AS g(i))"
    " SELECT run_id, event_id, us FROM r JOIN p USING (run_id, r)",
    "explaining_edges": EV + STATS + " SELECT run_id, cluster_id AS source, CAST(event_id AS VARCHAR) AS target, 'contains' AS kind FROM ev WHERE (run_id, cluster_id) IN (SELECT (run_id, cluster_id) FROM st WHERE is_candidate)",
    "missing_reports": EV + " SELECT 'failing' AS artifact, run_id AS id FROM (SELECT DISTINCT run_id FROM ev) WHERE run_id NOT IN (SELECT run_id FROM ev WHERE response_code = 503 AND target IS NOT NULL) UNION ALL SELECT 'signup', run_id FROM (SELECT DISTINCT run_id FROM ev) WHERE run_id NOT IN (SELECT run_id FROM ev WHERE verb = 'signup' AND resource = 'res_1')",
    "field_differences": EV + " SELECT event_id, 'service' AS \"column\" FROM ev WHERE event_id % 7 = 0 UNION ALL SELECT event_id, 'response_code' FROM ev WHERE event_id % 5 = 0 AND response_code IS NOT NULL",
    # an underscore is no part of a host name, so only the last address of each text counts
    "dependency_hosts": EV + " SELECT event_id, replace(service, '_', '-') || '.core.svc' AS hosts FROM ev",
    "payload_types": EV + ", x AS (SELECT event_id, verb = 'error' AND response_code IS NOT NULL AND event_id % 2 = 0 AS a, verb = 'click' AND event_id % 3 <> 0 AS b, verb = 'view' AS c, event_id % 5 = 0 AS d FROM ev)"
    " SELECT CASE WHEN event_id % 11 = 0 THEN NULL WHEN a THEN 'http_probe_or_access' WHEN b THEN 'caller_msg_structured' WHEN c THEN 'mongodb_structured' WHEN d THEN 'log_field_generic' ELSE 'other_json' END AS kind, count(*) AS n FROM x GROUP BY ALL",
    "subsystems": EV + " SELECT service, verb, CASE WHEN service IN ('svc_5', 'svc_6') THEN CASE verb WHEN 'click' THEN 'clicks' WHEN 'view' THEN 'views' ELSE 'unknown' END WHEN service = 'svc_1' THEN CASE WHEN resource LIKE 'res\\_1%' ESCAPE '\\' THEN 'one-one' ELSE 'one' END WHEN service = 'svc_2' THEN 'two' ELSE 'any' END AS subsystem, count(*) AS n FROM ev GROUP BY ALL",
    "root_confidence": EV + STATS + ", x AS (SELECT run_id, cluster_id, trigger_score * 4 AS t, error_count AS e, greatest(actors - 2.0, 0) AS f, error_rate AS p, fallback_error_count = 0 AS c, services AS y FROM st),"
    " z AS (SELECT run_id, cluster_id, CASE WHEN t >= 3 THEN 0.22 WHEN t >= 1.5 THEN 0.12 ELSE 0 END + CASE WHEN e >= 100 THEN 0.22 WHEN e >= 20 THEN 0.12 ELSE 0 END + CASE WHEN f >= 5 THEN 0.20 WHEN f >= 1 THEN 0.10 ELSE 0 END + CASE WHEN p >= 0.85 THEN 0.18 WHEN p >= 0.5 THEN 0.08 ELSE 0 END"
    " + CASE WHEN c THEN 0.12 ELSE -0.10 END + CASE WHEN y >= 6 THEN -0.16 WHEN y > 0 THEN -0.08 ELSE 0 END AS s, (t >= 1.5)::INT + (e >= 20)::INT + (f >= 1)::INT + (p >= 0.5)::INT + 1 + (y > 0)::INT AS reasons FROM x),"
    " w AS (SELECT run_id, cluster_id, round(CAST(greatest(0, least(1, s)) AS DOUBLE), 3) AS confidence, reasons FROM z) SELECT run_id, cluster_id, confidence, CASE WHEN confidence >= 0.75 THEN 'high' WHEN confidence >= 0.45 THEN 'medium' ELSE 'low' END AS label, reasons FROM w",
    "lagged_edges": DAILY + NODES + " SELECT run_id, source, target, round(CAST(greatest(0.0, 1 - lag_seconds / 120) + 0.2 * semantic_links + 0.1 AS DOUBLE), 6) AS score FROM cs",
}
ORACLE["assertion_summary"] = "WITH a AS (" + ORACLE["assertions"] + ") SELECT run_id, count(*) FILTER (status = 'pass') AS pass, count(*) FILTER (status = 'fail') AS fail, count(*) FILTER (status = 'inconclusive') AS inconclusive FROM a GROUP BY run_id"
