"""Where the tables of an analysis lie below an output root, and reading and writing them there."""

from pyspark.sql import DataFrame, SparkSession

# Table names by the step that writes them.
TABLES = {
    "ingest": ("events",), "triage": ("triage",), "embed": ("index", "vectors"), "cluster": ("clusters", "members"), "trigger_analysis": ("trigger_stats",), "incident_detection": ("incidents", "status"),
    "causal_analysis": ("profiles", "edges", "candidates", "roots", "confidence", "patterns"), "report": ("report", "blast_radius", "detailed"), "evidence_bundle": ("onset", "impacts", "breakdown", "dependencies", "lift", "overall_lift", "bundle"),
    "incident_assertions": ("assertions",), "timeline": ("timeline",), "preincident_diagnostics": ("diagnostics",), "validate": ("checks",),
}
STEP_OF = {t: s for s, names in TABLES.items() for t in names}


def path_of(root: str, name: str, profile: str = "v2") -> str:
    """A table's folder: below the root by step; an older profile has a folder of its own."""
    base = root.rstrip("/") if profile == "v2" else f"{root.rstrip('/')}/{profile}"
    return f"{base}/{STEP_OF.get(name, 'other')}/{name}.parquet"


def write_tables(tables: dict[str, DataFrame], root: str, profile: str = "v2", clean: bool = False) -> None:
    """Each table as Parquet.  clean: tables that lie there are replaced; else one that is there is an error.

    Only folders of tables that are written are ever replaced, never the root.
    """
    for name, df in tables.items():
        df.write.mode("overwrite" if clean else "errorifexists").parquet(path_of(root, name, profile))


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def read_tables(spark: SparkSession, root: str, profile: str = "v2", names: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """The tables that lie below the root, of those asked for."""
    paths = {n: path_of(root, n, profile) for n in names or STEP_OF}
    return {n: spark.read.parquet(p) for n, p in paths.items() if exists(spark, p)}
