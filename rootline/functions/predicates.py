"""Which events count as failures.  The variants differ on purpose; each caller names the one it needs."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Failure hints by the mode they stand for.
DEPENDENCY_HINTS = ("timeout", "connection_refused", "connection_reset", "network_unreachable", "dns_failure", "tls_handshake", "tls_certificate", "replica_instability")
ACCESS_HINTS = ("forbidden", "unauthorized", "access_denied", "permission_denied")
FAILURE_WORDS = ("timeout", "timed out", "deadline exceeded", "connection refused", "connection reset", "exception", "failed")


def http_failure() -> Column:
    return F.coalesce(F.col("response_code") >= 400, F.lit(False))


def severe() -> Column:
    return F.coalesce(F.upper("severity").isin("ERROR", "FATAL"), F.lit(False))


def family_failure() -> Column:
    return F.coalesce(F.lower("status_family") == "failure", F.lit(False))


def hinted() -> Column:
    return F.coalesce(F.col("failure_hint") != "", F.lit(False))


def mode_failure() -> Column:
    return F.coalesce(~F.lower("failure_mode").isin("", "normal", "unknown"), F.lit(False))


def worded(text: str) -> Column:
    return F.coalesce(F.lower(text).rlike("|".join(FAILURE_WORDS)), F.lit(False))


def failure(variant: str, text: str = "raw_text") -> Column:
    """The failure predicate of a caller.

    trigger: code, severity, family or hint; grounding: these, semantic mode or words of the text; evidence (also
    report and assertions): code, family, hint or semantic mode; timeline: code or severity; code: code alone.
    """
    parts = {
        "trigger": lambda: http_failure() | severe() | family_failure() | hinted(),
        "grounding": lambda: http_failure() | family_failure() | severe() | hinted() | mode_failure() | worded(text),
        "evidence": lambda: http_failure() | family_failure() | hinted() | mode_failure(),
        "timeline": lambda: http_failure() | severe(),
        "code": http_failure,
    }
    return parts[variant]()


def fallback_failure() -> Column:
    """A failure that no HTTP code tells."""
    return ~http_failure() & (severe() | family_failure() | hinted())


def success() -> Column:
    return F.coalesce(F.col("response_code").between(200, 399), F.lit(False)) | F.coalesce(F.lower("status_family") == "success", F.lit(False))


def severity_of(code: Column, text: Column) -> Column:
    """Severity from the code, else from words of the text."""
    low = F.lower(text)
    return (
        F.when(code >= 500, "ERROR").when(code.isin(401, 403), "ERROR").when(code >= 400, "WARN").when(code.isNotNull(), "INFO")
        .when(low.contains("error") | low.contains("failed"), "ERROR").when(low.contains("warn"), "WARN").when(low.contains("info"), "INFO")
    )


def family_of(code: Column, severity: Column) -> Column:
    return F.when(code >= 400, "failure").when(code.isNotNull(), "normal").when(severity.isin("ERROR", "FATAL"), "failure").when(severity == "WARN", "warning").otherwise("unknown")


def status_class(code: Column) -> Column:
    return F.when(code.between(200, 599), F.concat(F.floor(code / 100).cast("string"), F.lit("xx"))).otherwise("unknown")


def failure_mode(code: Column, family: Column, hint: Column) -> Column:
    return (
        F.when(code.between(500, 599), "service_failure")
        .when(code == 403, "authz_failure")
        .when(code == 404, "resource_not_found")
        .when(code == 409, "conflict")
        .when(code.between(400, 499), "client_error")
        .when((family == "failure") & hint.isin(*DEPENDENCY_HINTS), "dependency_failure")
        .when((family == "failure") & hint.isin(*ACCESS_HINTS), "authz_failure")
        .when(family == "failure", "service_failure")
        .otherwise("normal")
    )


def churn(text: str = "raw_text") -> Column:
    """Expected operational churn: routine verbs on coordination objects, metrics services, or health-check words."""
    # Coordination objects and routine verbs.
    routine = F.lower("resource").isin("leases", "events", "endpoints", "endpointslices", "configmaps") & F.lower("verb").isin("get", "watch", "update", "patch")
    metrics = F.lower("service").contains("metrics") | F.lower("service").contains("prometheus")
    words = F.lower(text).rlike("leader election|health|liveness|readiness|heartbeat")
    return F.coalesce(routine, F.lit(False)) | F.coalesce(metrics, F.lit(False)) | F.coalesce(words, F.lit(False))
