"""Which words set a source apart: divergences of every pair of sources and each source's own terms (operator 11).

Terms of a language that stand in ``least_docs`` of its documents are counted by source.  A term's counts make a sparse
vector (source, count); terms with the same vector are one row with a multiplicity, and every pair of sources is
evaluated once per distinct vector and weighed with it.  Pairs of which a vector holds both sources come from the vector
itself; those with one source come from the number of terms a (source, count) has, those with none from the number of
all terms, each corrected for what the closer form counts again, so no row is made for a zero.

All figures are whole numbers, kept in 64 bits: a share lies between 1 and 1 + SCALE and the shares of a source add up to
SCALE plus the number of terms at most, so a sum of divergences stays below (SCALE + terms) ** 2.  Shares are divided in three steps
of a thousand, exact up to 9e15 counted terms.

Words are counted inside tasks (one dictionary, written out whenever it holds ``HELD`` entries), summed by (language,
term, source), then gathered by term: a frequent term is one row a task and source, and its vector has one entry a
source.  Pairs are summed and terms ranked with partial results in each task, so a source or language with most of the
rows is spread.

Defined results: null text, lang and source count as ''; documents are rows, so a repeated row counts twice; a text
without terms still makes its (lang, source) occur; texts are cut at separators into pieces, so a very long one is never
held as words; equal values are ranked by item in UTF-8 order; a table without rows gives none; extra columns, whatever
their names, are ignored.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import documents, store, tidy
from .units import cut, lower_table

SCALE = 1_000_000_000
HELD = 400_000


def term_bytes() -> bytes:
    """Byte map: A-Z lower-cased, letters and all bytes of other characters kept, everything else a blank."""
    table = lower_table()
    table[[b for b in range(0x80) if not chr(b).isalpha()]] = 0x20
    return table.tobytes()


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, in parts still to be added up."""
    table = term_bytes()

    def count(batches):
        held = {}

        def rows():
            for (lang, source), (n, d) in held.items():
                terms = pa.array(list(n), pa.binary()).cast(pa.string())
                columns = [pa.array([x] * len(n), pa.string()) for x in (lang, source)] + [terms, pa.array(n.values(), pa.int64()), pa.array([d[t] for t in n], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
            held.clear()

        size = 0
        for b in batches:
            texts = b.column(2).cast(pa.large_binary())
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts):
                own = Counter()
                for piece in cut(memoryview(text.as_buffer()), table):
                    own.update(piece.split())
                n, d = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                n.update(own)
                d.update(own.keys())
                size += len(n)
                if size > HELD:
                    yield from rows()
                    size = 0
        yield from rows()

    return docs.select("lang", "source", "text").mapInArrow(tidy(count), "lang string, source string, term string, n long, docs long")


def share(count, total):
    """1 + floor(SCALE * (count + 1) / total), in steps that stay inside 64 bits."""
    out, left = F.lit(0), count + 1
    for _ in range(3):
        whole = left * 1000
        out = out * 1000 + quotient(whole, total)
        left = whole % total
    return out + 1


def quotient(a, b):
    """Whole part of a / b for positive whole numbers."""
    return F.call_function("div", a, b)


def divergence(p, q):
    return quotient((p - q) * (p - q), q)


def vectors(docs: DataFrame, least_docs: int = 3) -> DataFrame:
    """(lang, term, vector): the kept terms with their counts by source, in order of source."""
    counts = count_terms(docs).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("vector"))
    return terms.where(F.col("docs") >= least_docs).select("lang", "term", "vector")


def audit(docs: DataFrame, least_docs: int = 3, ranks: int = 200) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank.  docs: text, lang, source."""
    docs = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = store(vectors(docs, least_docs), "vectors")
    distinct = store(kept.groupBy("lang", "vector").agg(F.count("*").alias("m")), "distinct")
    entries = distinct.select("lang", "m", F.inline("vector"))
    marks = store(entries.groupBy("lang", "source", "n").agg(F.sum("m").alias("m")), "marks")  # terms with that count
    langs = distinct.groupBy("lang").agg(F.sum("m").alias("terms")).join(marks.groupBy("lang").agg(F.sum(F.col("n") * F.col("m")).alias("all")), "lang")
    occurring = docs.select("lang", "source").distinct()
    counted = marks.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("m")).alias("counted"))
    groups = occurring.join(counted, ["lang", "source"], "left").join(langs, "lang", "left")
    # total: the denominator of the group's shares; zero: its share of a term it lacks
    groups = groups.select("lang", "source", (F.coalesce("counted", F.lit(0)) + F.col("terms")).alias("total"), "terms", (F.col("all") + F.col("terms")).alias("lang_total"))
    groups = store(groups.withColumn("zero", share(F.lit(0), F.col("total"))), "groups")
    return pairs(distinct, marks, groups).unionByName(own_terms(kept, groups, ranks))


def pairs(distinct: DataFrame, marks: DataFrame, groups: DataFrame) -> DataFrame:
    """The divergence of every source from every other one of its language."""
    one, other = (groups.select("lang", *[F.col(c).alias(f"{side}_{c}") for c in ("source", "total", "zero")]) for side in "ab")
    plain = groups.select("lang", "terms").distinct()
    every = one.join(other, "lang").where("a_source <> b_source")
    none = divergence(F.col("a_zero"), F.col("b_zero"))
    base = every.join(plain, "lang").select("lang", "a_source", "b_source", F.coalesce(F.col("terms") * none, F.lit(0)).alias("value"))
    p = lambda side, n: share(F.col(n), F.col(f"{side}_total"))
    # terms that one of the two has, as if the other lacked them
    first = marks.select("lang", F.col("source").alias("a_source"), "n", "m").join(every, ["lang", "a_source"])
    first = first.select("lang", "a_source", "b_source", (F.col("m") * (divergence(p("a", "n"), F.col("b_zero")) - none)).alias("value"))
    second = marks.select("lang", F.col("source").alias("b_source"), "n", "m").join(every, ["lang", "b_source"])
    second = second.select("lang", "a_source", "b_source", (F.col("m") * (divergence(F.col("a_zero"), p("b", "n")) - none)).alias("value"))
    # terms that both have
    both = distinct.select("lang", "m", "vector", F.posexplode("vector").alias("at", "a"))
    both = both.select("lang", "m", "a", F.explode(F.expr("slice(vector, at + 2, size(vector))")).alias("b"))
    both = both.groupBy("lang", F.col("a.source").alias("x"), F.col("b.source").alias("y"), F.col("a.n").alias("x_n"), F.col("b.n").alias("y_n")).agg(F.sum("m").alias("m"))
    ends = F.inline(F.array(*[F.struct(F.col(a).alias("a_source"), F.col(b).alias("b_source"), F.col(f"{a}_n").alias("a_n"), F.col(f"{b}_n").alias("b_n")) for a, b in ("xy", "yx")]))
    both = both.select("lang", "m", ends).join(one, ["lang", "a_source"]).join(other, ["lang", "b_source"])
    a, b = p("a", "a_n"), p("b", "b_n")
    again = divergence(a, F.col("b_zero")) + divergence(F.col("a_zero"), b) - none
    both = both.select("lang", "a_source", "b_source", (F.col("m") * (divergence(a, b) - again)).alias("value"))
    found = base.unionByName(first).unionByName(second).unionByName(both)
    found = found.groupBy("lang", "a_source", "b_source").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "a_source").orderBy(F.desc("value"), "b_source")
    return found.select("lang", F.col("a_source").alias("source"), F.lit("pair").alias("part"), F.col("b_source").alias("item"), "value", F.row_number().over(order).alias("rank"))


def own_terms(kept: DataFrame, groups: DataFrame, ranks: int) -> DataFrame:
    """The terms that a source has more of than its language, to ``ranks``."""
    whole = F.aggregate("vector", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    entries = kept.select("lang", "term", whole.alias("whole"), F.inline("vector")).join(groups, ["lang", "source"])
    p, q = share(F.col("n"), F.col("total")), share(F.col("whole"), F.col("lang_total"))
    above = entries.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    found = above.select("lang", "source", F.lit("term").alias("part"), "item", divergence(F.col("p"), F.col("q")).alias("value"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir))


OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(t) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS terms FROM k GROUP BY lang),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
o AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term),
z AS (SELECT lang, sum(n) AS total FROM o GROUP BY lang),
p AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + (1000000000 * (coalesce(n, 0) + 1)::HUGEINT) // (coalesce(total, 0) + terms) AS p
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN s ON s.lang = g.lang AND s.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
q AS (SELECT lang, term, 1 + (1000000000 * (n + 1)::HUGEINT) // (total + terms) AS q FROM o JOIN v USING (lang) JOIN z USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
y AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM x)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM y WHERE part = 'pair' OR rank <= 200
"""
