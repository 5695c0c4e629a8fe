"""Corpus pipeline: toxicity, line dedup, near duplicates, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns the columns of documents; the last
returns the packed pieces.  run() writes every stage's result as Parquet in the shared folder, reads it again, and deletes
what earlier stages stored.

Defined results: the first four stages keep one row for each doc_id (of rows that share one, the least text, null first)
and none without; a null or empty text has no toxic words, lines, n-grams or windows and is kept; the packing stage packs
every row it gets; very long texts are handled whole; extra columns, whatever their names, go.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootline.llm.line_winnow import drop_repeated_lines
from rootline.llm.ngram_jaccard import duplicate_groups
from rootline.llm.ordinal_toxicity import score, train
from rootline.llm.shared import documents
from rootline.llm.ss_packing import pack, vocabulary
from rootline.llm.wu_manber import find_benchmark
from rootline.storage import release, store, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


WORD = r"[^\\x20\\x09-\\x0D]+"


def _unique(docs: DataFrame) -> DataFrame:
    """One row for each doc_id.  Only if some repeat are rows shuffled for that."""
    docs = docs.select(*COLUMNS).where("doc_id is not null")
    if docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs
    rest = [c for c in COLUMNS if c != "doc_id"]
    return docs.groupBy("doc_id").agg(F.min(F.struct(F.col("text").isNotNull().alias("there"), *rest)).alias("row")).select(*[c if c == "doc_id" else f"row.{c}" for c in COLUMNS])


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The documents that stand in ``kept`` (doc_id)."""
    return docs.join(kept.select("doc_id").hint("shuffle_hash"), "doc_id", "left_semi").select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose likelier side is grade 0."""
    docs = _unique(docs)
    found = score(docs, train(docs, documents(spark, sf_dir, "labels")))
    return _only(docs, found.where("not toxic"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines.  One of which under a quarter of the words is left repeats earlier lines as a
    near copy repeats a text, and goes."""
    docs = _unique(docs)
    left = drop_repeated_lines(docs).select("doc_id", F.col("text").alias("left"), "n_lines", "n_removed")
    joined = docs.join(left, "doc_id").where(f"n_removed = 0 or (n_removed < n_lines and 4 * regexp_count(left, '{WORD}') >= regexp_count(text, '{WORD}'))")
    text = F.expr("if(n_removed = 0, text, left)")
    return joined.select("doc_id", text.alias("text"), "lang", "source", F.expr("if(n_removed = 0, n_chars, cast(length(left) as bigint))").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each group."""
    docs = _unique(docs)
    return _only(docs, duplicate_groups(docs).where("doc_id = component_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    docs = _unique(docs)
    found = find_benchmark(docs, documents(spark, sf_dir, "benchmark"))
    return _only(docs, found.where("not contaminated"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, packed into sequences."""
    return pack(docs, vocabulary())


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("near duplicates", near_duplicates), ("decontamination", decontamination), ("packing", packing)]
ORACLE_SQL = None  # toxicity and packing are not expressible in SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mark = documents(spark, sf_dir), stored(spark)
    for name, stage in STAGES:
        table = f"stage-{name.replace(' ', '-')}"
        docs = store(stage(spark, docs, sf_dir), table)
        release(spark, mark, keep=table)
    return docs
