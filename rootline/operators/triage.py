"""Which texts hold failure signals: weighted line scores, ranked, and the lines that matched with what stands around them.

A triage of log files is written as a folder: ``slices`` (one folder a file, rows line_no, line, matched), ``selected`` (a
path a line) and ``manifest`` (one JSON object).  Slices are replaced file by file, so a run leaves those of other files.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import logs
from ..storage import store

# Signals as (pattern, weight, label).
SIGNALS = (
    (r"(?i)\bforbidden\b", 6, "forbidden"),
    (r"(?i)\bunauthorized\b", 6, "unauthorized"),
    (r"(?i)\bpermission denied\b", 6, "permission_denied"),
    (r"(?i)\btimeout\b|\bdeadline exceeded\b|\btimed out\b", 5, "timeout"),
    (r"(?i)\bconnection refused\b|\bconnection reset\b", 5, "connection"),
    (r"(?i)\bexception\b|\bpanic\b|\btraceback\b", 5, "exception"),
    (r"(?i)\berror\b|\bfatal\b|\bfailed\b", 4, "error"),
    (r"(?i)\bstatus(?:_code)?[\"'=:\s]+([45]\d\d)\b", 5, "status_code_text"),
    (r"(?i)\bresponse.*\b([45]\d\d)\b", 4, "response_code_text"),
    (r"\"code\"\s*:\s*([45]\d\d)\b", 5, "json_code"),
    (r"\"status\"\s*:\s*\"Failure\"", 4, "json_failure_status"),
)


def score_lines(lines: DataFrame, key: str, text: str = "line", signals=SIGNALS) -> DataFrame:
    """Per key: lines, matched lines, weighted score and density (matched lines a line); one pass, no explode."""
    hits = [(F.col(text).rlike(p), w, label) for p, w, label in signals]
    score = sum(F.when(h, w).otherwise(0) for h, w, _ in hits)
    any_hit = hits[0][0]
    for h, _, _ in hits[1:]:
        any_hit = any_hit | h
    g = lines.groupBy(key).agg(F.count("*").alias("lines"), F.count(F.when(any_hit, 1)).alias("matched_lines"), F.sum(score).alias("weighted_score"), *[F.count(F.when(h, 1)).alias(f"_{label}") for h, _, label in hits])
    top = F.expr("slice(array_sort(filter(array(" + ", ".join(f"struct(-`_{label}` as n, '{label}' as label)" for _, _, label in signals) + "), x -> x.n < 0)), 1, 8)")
    return g.withColumn("density", F.round(F.col("matched_lines") / F.col("lines"), 6)).withColumn("top_signals", F.transform(top, lambda x: F.struct(x["label"].alias("label"), (-x["n"]).alias("n")))).drop(*[f"_{label}" for _, _, label in signals])


def ranked(scores: DataFrame, key: str, n: int = 40, least: int = 10) -> DataFrame:
    """The n best texts of at least that score."""
    return scores.where(F.col("weighted_score") >= least).orderBy(F.desc("weighted_score"), F.desc("matched_lines"), F.desc("density"), key).limit(n)


def matched(text: str = "line", signals=SIGNALS):
    """Whether a line holds a signal."""
    return F.coalesce(F.array_max(F.array(*[F.col(text).rlike(p) for p, _, _ in signals])), F.lit(False))


def slices(lines: DataFrame, context: int = 2) -> DataFrame:
    """(source_file, line_no, line, matched): the lines with signals and ``context`` lines before and after each.

    lines: source_file, line_no, line, as logs.numbered_lines gives them.  The places around a match are joined with the
    lines, so no file is put in order.
    """
    l = lines.withColumn("matched", matched())
    around = F.explode(F.sequence(F.col("line_no") - context, F.col("line_no") + context)).alias("line_no")
    near = l.where("matched").select("source_file", around).distinct()
    return l.join(near, ["source_file", "line_no"], "left_semi").select("source_file", "line_no", "line", "matched")


def triage_files(spark: SparkSession, path: str | list[str], top_n: int = 40, least: int = 10, max_lines: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scores of all files, the selected ones, and the lines read.  max_lines: read no more of a file (0: all); a file that has
    more counts one line above it, as its first unread line is seen."""
    lines = logs.numbered_lines(logs.file_lines(spark, path, logs.TRIAGE_FILES, True))
    if max_lines > 0:
        lines = lines.where(F.col("line_no") <= max_lines + 1).withColumn("line", F.when(F.col("line_no") <= max_lines, F.col("line")).otherwise(""))
    lines = store(lines, "triage")
    scores = store(score_lines(lines, "source_file"), "scores")
    return scores, ranked(scores, "source_file", max(0, top_n), least), lines


def write_triage(spark: SparkSession, path: str | list[str], out: str, top_n: int = 40, least: int = 10, max_lines: int = 0, context: int = 2) -> list[str]:
    """Writes slices, selected and manifest below ``out``; returns the selected files, best first."""
    scores, best, lines = triage_files(spark, path, top_n, least, max_lines)
    chosen = [r.asDict(recursive=True) for r in best.orderBy(F.desc("weighted_score"), F.desc("matched_lines"), F.desc("density"), "source_file").collect()]  # top_n at most
    picked = spark.createDataFrame([(r["source_file"],) for r in chosen], "source_file string")
    name = F.concat(F.regexp_replace(F.element_at(F.split("source_file", "/"), -1), r"[^\w.-]", "_"), F.lit("-"), F.substring(F.sha2("source_file", 256), 1, 12))
    own = slices(lines.join(picked, "source_file", "left_semi"), context).withColumn("file", name)
    # a folder a file, written by range of lines, so that a large file's slice is written by several tasks
    own.repartitionByRange("file", "line_no").sortWithinPartitions("file", "line_no").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file").parquet(f"{out}/slices")
    counts = scores.agg(F.count("*").alias("scanned"), F.count(F.when(F.col("weighted_score") >= least, 1)).alias("eligible")).first()
    manifest = {
        "input_dir": path, "files_scanned": counts.scanned, "files_meeting_threshold": counts.eligible, "files_selected": len(chosen), "selection_criteria": {"top_n": top_n, "min_weighted_score": least, "max_lines_per_file": max_lines},
        "selected_files": [{"path": r["source_file"], **{k: r[k] for k in ("lines", "matched_lines", "weighted_score", "density")}, "top_signals": [{"signal": t["label"], "count": t["n"]} for t in r["top_signals"]]} for r in chosen],
    }
    for part, text in (("manifest", [json.dumps(manifest, ensure_ascii=False)]), ("selected", [r["source_file"] for r in chosen])):
        spark.createDataFrame([(x,) for x in text], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/{part}")
    return [r["source_file"] for r in chosen]
