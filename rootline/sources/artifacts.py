"""JSON artifacts of any shape as VARIANT rows, and row counts that read no rows.

A table is written as JSON lines, an object a row, and read back as one VARIANT column; its values keep their nesting, and
``typed`` restores a schema.  A file that is one JSON value (an object or a list) is a row of its own, and its parts rows of
``parts``.

Defined results: text that is no JSON fails on reading (``strict``) or is null; null columns are kept as JSON null.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A table as JSON lines; VARIANT, structs, maps and lists keep their nesting."""
    df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def read(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(data VARIANT) a row of JSON lines; blank lines are none."""
    parse = F.parse_json if strict else F.try_parse_json
    return spark.read.text(path).where("trim(value) <> ''").select(parse("value").alias("data"))


def read_files(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(name, data VARIANT) a file that is one JSON value."""
    parse = F.parse_json if strict else F.try_parse_json
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), parse("value").alias("data"))


def parts(df: DataFrame, column: str = "data") -> DataFrame:
    """The other columns with pos, key and value (VARIANT) of each entry of an object or list; scalars have none."""
    return df.lateralJoin(df.sparkSession.tvf.variant_explode(F.col(column).outer())).drop(column)


def typed(df: DataFrame, schema: str | T.StructType, column: str = "data") -> DataFrame:
    """VARIANT rows as columns of a schema; a value of another type is null."""
    text = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return df.select(F.try_variant_get(column, "$", f"struct<{text_of(text)}>").alias("_v")).select("_v.*")


def text_of(ddl: str) -> str:
    """The fields of a DDL schema as a struct's."""
    return T.StructType.fromDDL(ddl).simpleString().removeprefix("struct<").removesuffix(">")


def count_rows(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table, from its footers alone; of any other path, its lines that are not blank."""
    return counted(spark, path).first()[0]


def counted(spark: SparkSession, path: str) -> DataFrame:
    if not path.rstrip("/").endswith((".parquet", ".pq")):
        return spark.read.text(path).where("trim(value) <> ''").agg(F.count("*").alias("n"))
    kept = {c: spark.conf.get(c) for c in ("spark.sql.parquet.aggregatePushdown", "spark.sql.sources.useV1SourceList")}
    try:
        spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        spark.conf.set("spark.sql.sources.useV1SourceList", "")
        found = spark.read.parquet(path).agg(F.count("*").alias("n"))
        found._jdf.queryExecution().executedPlan()  # planned with these settings
        return found
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
