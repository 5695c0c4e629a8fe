"""License scans by diagonal voting (operator 7); DataFrame functions only.

Templates are the base phrases and the opening words of common licenses.  Every rolling 2-gram of a text's words is
joined, by a 64-bit hash and a second one, to the places of that 2-gram in the templates.  Each match votes for its
diagonal, the word of the text at which the template would start.  A phrase stands where all its 2-grams vote for one
diagonal, which verifies the span word by word.  For the longer templates all diagonals from one to ``reach`` words after it
are merged (for words put in or left out), so the shifts of a span add up to ``reach`` at most.  A merged span is verified by
order: the template's 2-grams that it covers are read in the template's order, each at its first place in the span, and one
counts if it stands after the 2-gram read before it.  The share of the template's 2-grams that count is the span's score; from
``least`` on the template's label is added, and spans of which a better one lies within ``reach`` are left out.

The template table has a fixed size and is broadcast.  Each text also sends one row with its word count through the same
grouping, so no text is read twice.  Defined results: null and blank texts have no words and no labels, an empty table gives no rows; very long texts are scanned
whole, all their 2-grams in one array; words are compared by both hashes of a 2-gram; a doc_id that
repeats counts once (its least text), a row without doc_id is not returned; extra columns are ignored.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import documents, one_per_id

# The base phrases and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
# Opening words of common licenses and notices, and their labels.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit-text"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-notice"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl-notice"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl-notice"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd-text"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-notice"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc-text"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-notice"),
    ("this is free and unencumbered software released into the public domain", "unlicense-text"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("released under the mit license", "mit-release"),
)
TEMPLATES = tuple((text.split(), label, i < len(PHRASES)) for i, (text, label) in enumerate(PHRASES + NOTICES))
REACH = 8
SEPARATORS = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def template_grams(spark: SparkSession) -> DataFrame:
    """(t, tpos, tlen, base, label, th, tg): every 2-gram of every template; t = -1 meets the rows that carry word counts."""
    rows = ", ".join(f"({t}, {p}, {len(w)}, {str(base).lower()}, '{label}', '{w[p]}', '{w[p + 1]}')" for t, (w, label, base) in enumerate(TEMPLATES) for p in range(len(w) - 1))
    grams = spark.sql(f"select t, tpos, tlen, base, label, xxhash64(a, b) as th, hash(a, b) as tg from values {rows} as v(t, tpos, tlen, base, label, a, b)")
    return grams.unionAll(spark.sql("select -1, 0, 0, false, '', 0L, cast(null as int)"))


def scan(docs: DataFrame, least: float = 0.7, reach: int = REACH) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and the spans found."""
    docs = one_per_id(docs)
    words = docs.select("doc_id", F.expr(f"array_remove(split(lower(coalesce(text, '')), '{SEPARATORS}'), '')").alias("w"))  # A-Z apart, lower() maps no letter across the separators
    grams = "if(size(w) < 2, cast(array() as array<struct<pos:int,h:bigint,g:int>>), transform(sequence(0, size(w) - 2), i -> struct(i as pos, xxhash64(w[i], w[i + 1]) as h, hash(w[i], w[i + 1]) as g)))"
    rows = words.select("doc_id", F.explode(F.expr(f"concat(array(struct(-1 as pos, 0L as h, size(w) as g)), {grams})")).alias("r")).select("doc_id", "r.pos", "r.h", "r.g")
    hits = rows.join(F.broadcast(template_grams(docs.sparkSession)), F.expr("h = th and (t = -1 and pos = -1 or g = tg and pos >= 0)"))
    diagonals = hits.groupBy("doc_id", "t", "tlen", "base", "label", (F.col("pos") - F.col("tpos")).alias("d")).agg(F.count("*").alias("votes"), F.max("g").alias("g"), F.collect_set("tpos").alias("seen"))
    diagonals = diagonals.where("t = -1 or not base or votes = tlen - 1")
    near = Window.partitionBy("doc_id", "t").orderBy("d")
    part = F.collect_list(F.when((F.col("t") >= 0) & ~F.col("base"), F.struct("d", "seen"))).over(near.rangeBetween(0, reach))
    spans = diagonals.withColumn("part", part).withColumn("places", F.array_sort(F.array_distinct(F.flatten("part.seen"))))
    spans = spans.where(f"t = -1 or base or size(places) >= {least} * (tlen - 1)")
    spans = spans.withColumn("at", F.expr("transform(places, p -> p + array_min(transform(filter(part, x -> array_contains(x.seen, p)), x -> x.d)))"))
    spans = spans.withColumn("share", F.expr("case when t = -1 then 0D when base then 1D else (1 + size(filter(at, (x, i) -> x > get(at, i - 1)))) / (tlen - 1) end"))
    spans = spans.withColumn("d_last", F.coalesce(F.array_max("part.d"), "d")).drop("part", "places", "at", "seen").where(f"t = -1 or base or share >= {least}")
    better = (F.max("share").over(near.rangeBetween(-reach, -1)) >= F.col("share")) | (F.max("share").over(near.rangeBetween(1, reach)) > F.col("share"))
    merged = spans.withColumn("better", F.coalesce(better, F.lit(False))).where("t = -1 or base or not better")
    found = merged.groupBy("doc_id").agg(
        F.max(F.expr("if(t = -1, g, null)")).cast("long").alias("n_words"),
        F.count(F.expr("if(base, 1, null)")).alias("n_base"),
        F.min(F.expr("if(base, d, null)")).cast("long").alias("first_word"),
        F.max(F.expr("if(base, d, null)")).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.expr("if(base, label, null)"))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.expr("if(t >= 0, label, null)"))), ",").alias("labels"),
        F.max("share").alias("score"),
        F.collect_list(F.expr("if(t >= 0, struct(label, d as start, d_last + tlen as stop), null)")).alias("spans"),
    )
    return found


def op7_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", F.round("score", 6).alias("score"))


_GRAMS = ", ".join(f"({t}, {p}, {len(w)}, {str(base).lower()}, '{label}', '{w[p]} {w[p + 1]}')" for t, (w, label, base) in enumerate(TEMPLATES) for p in range(len(w) - 1))
OP7_SQL = rf"""
WITH k(t, tpos, tlen, base, label, gram) AS (VALUES {_GRAMS}),
d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, i - 1 AS pos, w[i] || ' ' || w[i + 1] AS gram FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 1)) AS i FROM d WHERE len(w) > 1)),
v AS (SELECT doc_id, t, tlen, base, label, pos - tpos AS d, count(*) AS votes, list(DISTINCT tpos) AS seen FROM g JOIN k USING (gram) GROUP BY ALL HAVING NOT base OR count(*) = tlen - 1),
s AS (SELECT *, unnest(seen) AS tpos FROM v),
a AS (SELECT v.doc_id, v.t, v.tlen, v.base, v.label, v.d, s.tpos, min(s.d) + s.tpos AS pos FROM v JOIN s ON s.doc_id = v.doc_id AND s.t = v.t AND s.d BETWEEN v.d AND v.d + CASE WHEN v.base THEN 0 ELSE {REACH} END GROUP BY v.doc_id, v.t, v.tlen, v.base, v.label, v.d, s.tpos),
r AS (SELECT *, pos > lag(pos) OVER (PARTITION BY doc_id, t, d ORDER BY tpos) AS later FROM a),
m AS (SELECT doc_id, t, base, label, d, (1 + count(*) FILTER (later)) / (tlen - 1) AS share FROM r GROUP BY doc_id, t, tlen, base, label, d),
o AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(d) FILTER (base) AS first_word, max(d) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
      string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM m WHERE base OR share >= 0.7 GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(coalesce(score, 0), 6) AS score FROM d LEFT JOIN o USING (doc_id)
"""
