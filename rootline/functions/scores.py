"""Scoring formulas as columns over aggregates."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clamp(x, low=0.0, high=1.0) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), c(x)))


def severity_step(error_rate) -> Column:
    r = c(error_rate)
    return F.when(r >= 0.8, 3.0).when(r >= 0.4, 2.0).when(r >= 0.1, 1.0).otherwise(0.2)


def trigger_raw(burst, error_rate) -> Column:
    return severity_step(error_rate) * (1 + F.log1p(c(burst))) * c(error_rate)


def trigger_adjusted(raw, n, actors) -> Column:
    """Damped by volume and by how many actors take part, squashed to 0..1."""
    scale, spread = F.least(F.lit(1.0), F.log1p(c(n)) / 5), F.least(F.lit(1.0), c(actors) / 3)
    x = c(raw) * (0.5 + 0.5 * scale) * (0.7 + 0.3 * spread)
    return F.round(x / (1 + x), 6)


def strength(trigger, error_rate, coverage, fallback_ratio, hints) -> Column:
    return F.round(clamp(0.45 * c(trigger) + 0.25 * c(error_rate) + 0.15 * c(coverage) + 0.10 * F.least(F.lit(1.0), 2 * c(fallback_ratio)) + 0.05 * F.least(F.lit(1.0), c(hints) / 3)), 6)


def is_candidate(trigger, power, errors, error_rate, fallback, hints) -> Column:
    loud = (c(trigger) >= 0.12) | (c(errors) >= 3) | (c(fallback) >= 3)
    firm = (c(power) >= 0.22) | ((c(error_rate) >= 0.20) & (c(errors) >= 5)) | (c(fallback) >= 8) | ((c(fallback) >= 4) & (c(hints) >= 2) & (c(error_rate) >= 0.05))
    return loud & firm


def edge_score(links) -> Column:
    return F.round(F.least(F.lit(1.0), 0.7 + 0.1 * c(links)), 6)


def lagged_edge_score(lag, links) -> Column:
    """The alternative edge score: decays with the lag over two minutes."""
    return F.greatest(F.lit(0.0), 1 - c(lag) / 120) + 0.2 * c(links) + 0.1


def candidate_score(rank, trigger, out, into) -> Column:
    """rank from 0; out and into: strengths as shares of the incident's largest."""
    return F.round(0.5 / (1 + c(rank)) + 0.3 * c(trigger) + 0.2 * (c(out) - c(into)) / (1 + c(out) + c(into)), 6)


def report_confidence(score, gap, rank, out_degree, in_degree, events) -> Column:
    degree = c(out_degree) + c(in_degree)
    graph = F.when(degree > 0, c(out_degree) / (1 + degree)).otherwise(0.0)
    return F.round(0.35 * F.least(F.lit(1.0), c(score)) + 0.20 * F.least(F.lit(1.0), c(gap) / 0.25) + 0.20 / (1 + c(rank)) + 0.15 * graph + 0.10 * F.least(F.lit(1.0), c(events) / 5), 6)


def packet_confidence(score, trigger, errors, out, into, proximity) -> Column:
    """How far a ranked cause explains itself, 0 to 1; it does not change the ranking."""
    capped = lambda x: F.least(F.lit(1.0), x)
    lead = F.greatest(F.lit(0.0), c(out) - 0.5 * c(into))
    raw = 0.40 * capped(c(score) / 100) + 0.20 * capped(c(trigger) / 5) + 0.15 * capped(F.log1p(c(errors)) / 5) + 0.15 * capped(lead / 10) + 0.10 * capped(c(proximity))
    return F.round(clamp(raw), 3)


def level(score, high: float, medium: float) -> Column:
    return F.when(c(score) >= high, "high").when(c(score) >= medium, "medium").otherwise("low")


def merged_confidence(model, detection) -> Column:
    return F.round(0.7 * c(model) + 0.3 * c(detection), 6)


def policy_confidence(score, duration, coverage, error_ratio, coherence, recovery) -> Column:
    x = 0.30 * c(score) + 0.20 * F.least(F.lit(1.0), c(duration) / 900) + 0.20 * c(coverage) + 0.20 * F.least(F.lit(1.0), 3 * c(error_ratio)) + 0.10 * c(coherence)
    return F.round(clamp(x * (1 - 0.35 * F.least(F.lit(1.0), c(recovery)))), 6)


def jaccard(a, b) -> Column:
    """Of two arrays as sets; two empty ones are equal."""
    both = F.size(F.array_union(c(a), c(b)))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(c(a), c(b))) / both)


def cluster_type(size, total) -> Column:
    share = c(size) / c(total)
    return F.when(share >= 0.20, "baseline").when(share <= 0.05, "minor_pattern").otherwise("contextual")


def rate(count, seconds) -> Column:
    return F.when(c(seconds) > 0, c(count) / c(seconds)).otherwise(0.0)


def lift(pre, post) -> Column:
    return F.when(c(pre) > 0, c(post) / c(pre))


def grounding_score(distance, code) -> Column:
    return F.greatest(F.lit(0.0), 1 - c(distance) / 300) + F.when(c(code) >= 500, 2).when(c(code) >= 400, 1).otherwise(0)


def churn_penalty(share) -> Column:
    return F.when(c(share) >= 0.8, 12.0).when(c(share) >= 0.5, 6.0).when(c(share) >= 0.3, 3.0).otherwise(0.0)


def threshold_status(observed, op: str, limit: float) -> Column:
    x = c(observed)
    met = {">": x > limit, ">=": x >= limit, "==": x == limit, "<": x < limit, "<=": x <= limit}[op]
    return F.when(x.isNull(), "inconclusive").when(met, "pass").otherwise("fail")
