"""Line dedup by winnowing over line hashes (operator 5); DataFrame functions only.

A document is its sequence of line hashes.  Every window of ``run`` lines selects its least hash (the leftmost of equal
ones) as fingerprint, so a repeated run of that many lines is guaranteed to share one at the same offset.  A line of
``lone`` words or more is a window of its own, and its hash the fingerprint, so it is found alone too.  Fingerprints
that occur once are dropped; the positions of the others are joined, and each match is extended both ways over the lines
that the windows around the fingerprint span.  Windows that match in full repeat a run; overlapping ones make up the
maximal runs, and every line of a run that also stands earlier (smaller doc_id, or the same document, earlier line) is
deleted.

Counts are grouped with partial sums and the joins are plain ones, so a line that stands in a third of all documents is
spread.  Defined results: a null text has no lines; an empty text has one, empty; shorter lines in repeated runs of fewer
than ``run`` lines stay; a doc_id that repeats counts once (its least text), a row without doc_id is not returned; very
long texts and lines are handled like any other; extra columns, whatever their names, are ignored.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents, one_per_id


# Fixed value: white space between words, as a character range for SQL text.
SPACE = r"\\x20\\x09-\\x0D"


def repeated_lines(docs: DataFrame, run: int, lone: int | None) -> DataFrame:
    """(doc_id, gone): indices of the lines to delete.  docs: doc_id, text, each doc_id once."""
    texts = docs.where("text is not null")
    hashes = texts.select("doc_id", F.expr("transform(split(text, '\\n', -1), (x, i) -> struct(xxhash64(x) as h, i as i))").alias("z")).where(F.size("z") >= run)
    chosen = f"array_distinct(transform(sequence(1, size(z) - {run - 1}), s -> array_min(slice(z, s, {run}))))"
    around = f"transform({chosen}, f -> struct(f.h as h, f.i as p, slice(z, greatest(f.i - {run - 1}, 0) + 1, f.i + {run} - greatest(f.i - {run - 1}, 0)) as near))"
    prints = hashes.select("doc_id", F.explode(F.expr(around)).alias("f")).select("doc_id", "f.h", "f.p", "f.near")
    shared = prints.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    # a match of two positions reaches as far as the lines around agree; each window whose own fingerprint this is tells
    # which of them do
    windows = f"filter(transform(sequence(1, size(near) - {run - 1}), s -> slice(near, s, {run})), w -> array_min(w).i = p)"
    reach = prints.join(shared, "h").select("doc_id", F.explode(F.expr(windows)).alias("w")).select("doc_id", F.expr("w[0].i").alias("at"), F.expr("transform(w, x -> x.h)").alias("lines"))
    if lone is not None and run > 1:
        # the pattern is done with a line once it has seen that many words
        worded = f"x rlike '^[{SPACE}]*+(?:[^{SPACE}]++[{SPACE}]++){{{lone - 1}}}[^{SPACE}]'"
        long = F.expr(f"filter(transform(split(text, '\\n', -1), (x, i) -> if({worded}, struct(xxhash64(x) as h, i as at), null)), y -> y is not null)")
        single = texts.select("doc_id", F.explode(long).alias("y")).select("doc_id", "y.h", "y.at")
        twice = single.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
        reach = reach.unionByName(single.join(twice, "h").select("doc_id", "at", F.array("h").alias("lines")))
    firsts = reach.groupBy("lines").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("n")).where("n > 1").select("lines", "first")
    matched = reach.join(firsts, "lines")
    later = matched.where("first.doc_id <> doc_id or first.at <> at").select("doc_id", F.struct("at", (F.col("at") + F.size("lines") - 1).alias("last")).alias("s"))
    return later.groupBy("doc_id").agg(F.collect_list("s").alias("spans")).select("doc_id", F.expr("array_distinct(flatten(transform(spans, s -> sequence(s.at, s.last))))").alias("gone"))


def drop_repeated_lines(docs: DataFrame, run: int = 3, lone: int | None = 5) -> DataFrame:
    """doc_id, n_lines, n_removed and the text that is left, of every document.

    run: lines of a repeated run; lone: words from which a repeated line goes by itself (None: runs only).
    """
    if run < 1 or (lone is not None and lone < 1):
        raise ValueError("run and lone must be 1 or more")
    docs = one_per_id(docs)
    found = repeated_lines(docs, run, lone)
    joined = docs.join(found.hint("shuffle_hash"), "doc_id", "left")
    lines = "split(text, '\\n', -1)"
    left = f"array_join(transform(array_except(sequence(0, size({lines}) - 1), gone), i -> {lines}[i]), '\\n')"
    return joined.select(
        "doc_id",
        F.expr(f"if(text is null, 0L, cast(size({lines}) as bigint))").alias("n_lines"),
        F.expr("coalesce(cast(size(gone) as bigint), 0L)").alias("n_removed"),
        F.expr(f"if(gone is null, coalesce(text, ''), {left})").alias("text"),
    )


def op5_line_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeated_lines(documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP5_SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, i, line AS a, lead(line, 1) OVER d AS b, lead(line, 2) OVER d AS c FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) AS k FROM w WHERE c IS NOT NULL),
o AS (SELECT doc_id, i, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) AS k FROM l WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= 5),
g AS (SELECT doc_id, i + o AS i FROM f, (VALUES (0), (1), (2)) AS t(o) WHERE k > 1 UNION SELECT doc_id, i FROM o WHERE k > 1),
s AS (SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS kept
      FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents AS d LEFT JOIN s USING (doc_id)
"""
