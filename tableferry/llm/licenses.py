"""Operator 6, license scan: diagonal voting, in DataFrame operations only.

All rolling word 2-grams of every text are hashed and joined to the positions of the templates' 2-grams; a hit at word ``p`` of the
text and ``q`` of a template votes for the diagonal ``p - q``. Votes are summed by (row, template, diagonal); neighbouring
diagonals (at most :data:`SLACK` words apart, their spans at most :data:`GAP` words) of one template are merged, since an inserted or
missing word moves the rest by one; a merged span is verified if it holds :data:`SHARE` of the template's 2-grams. A phrase
of the base stands where all its 2-grams vote for one diagonal. Hits of a hash are checked on the words themselves.

Defined results: null and empty text have no words and no places; the score is the largest share of a template that a
verified span holds, 0 without one; repeated rows are scanned each; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableferry.llm.contamination import SQL_WORDS
from tableferry.llm.textkit import read_table

K = 2
SLACK = 3
GAP = 6
SHARE = 0.9
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The phrases of the base and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices, lower-cased, and the label of each.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "licensed under the gnu lesser general public license": "lgpl",
    "subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "cc0",
    "this is free and unencumbered software released into the public domain": "unlicense",
}


def template_grams(spark: SparkSession, base: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """(template, label, exact, grams, at, first, second): a row for each 2-gram of each template; as many as the templates have."""
    rows = []
    for number, (phrase, label) in enumerate([*base.items(), *notices.items()]):
        words = phrase.split()
        rows += [(number, label, number < len(base), len(words) - K + 1, at, words[at], words[at + 1]) for at in range(len(words) - K + 1)]
    return spark.createDataFrame(rows, "template int, label string, exact boolean, grams int, at int, first string, second string")


def words_of(text: Column) -> Column:
    """The words of a text once A-Z is lower-cased."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), lambda w: w != "")


def scan(docs: DataFrame, keep: list[str], text: str = "text", base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES) -> DataFrame:
    """``keep`` columns, n_words and places: array of (label, exact, start, stop, share) of all verified spans, in words."""
    grams = template_grams(docs.sparkSession, base, notices).withColumn("hash", F.xxhash64("first", "second"))
    wanted = [r["hash"] for r in grams.select("hash").distinct().collect()]  # as many as the templates have
    named = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*keep).alias("kept"), words_of(F.col(text)).alias("words"))
    first, second = lambda i: F.get("words", i), lambda i: F.get("words", i + 1)
    # All rolling 2-gram hashes, of which those of some template go on: neither the words nor the other places leave the row.
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 2), lambda i: F.xxhash64(first(i), second(i)).isin(wanted))
    entries = F.transform(places, lambda i: F.struct(i.alias("place"), F.xxhash64(first(i), second(i)).alias("hash"), first(i).alias("one"), second(i).alias("two")))
    found = named.select("row", "kept", F.size("words").cast("long").alias("n_words"), F.when(F.size("words") > 1, entries).alias("entries"))
    rolling = found.select("row", "kept", "n_words", F.explode_outer("entries").alias("e")).select("row", "kept", "n_words", "e.*")
    same = (rolling["hash"] == grams["hash"]) & (F.col("one") == F.col("first")) & (F.col("two") == F.col("second"))
    hits = rolling.join(F.broadcast(grams), same, "left")  # a row without any entry comes once, without a template
    votes = hits.select("row", "kept", "n_words", "template", "label", "exact", "grams", (F.col("place") - F.col("at")).alias("diagonal"), "place", "at")
    diagonals = votes.groupBy("row", "kept", "n_words", "template", "label", "exact", "grams", "diagonal").agg(F.min("place").alias("low"), F.max("place").alias("high"), F.collect_set("at").alias("ats"))
    order = Window.partitionBy("row", "template").orderBy("low", "diagonal")
    apart = (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > SLACK) | (F.col("low") > F.lag("high").over(order) + GAP)
    merged = diagonals.withColumn("new", F.coalesce(F.col("exact") | apart, F.lit(True)).cast("int")).withColumn("span", F.sum("new").over(order))
    spans = merged.groupBy("row", "kept", "n_words", "template", "label", "exact", "grams", "span").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("found"))
    share = F.col("found") / F.col("grams")
    good = F.when(F.col("exact"), F.col("found") == F.col("grams")).otherwise(share >= SHARE)
    place = F.struct("label", "exact", F.col("low").alias("start"), (F.col("high") + K).alias("stop"), share.alias("share"))
    return spans.groupBy("row", "kept", "n_words").agg(F.collect_list(F.when(good, place)).alias("places")).select("kept.*", "n_words", "places")


def q_op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read_table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("places", lambda p: p["exact"])
    starts = F.transform(base, lambda p: p["start"])

    def labels(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"), F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"),
    )


_VALUES = ", ".join(f"({i}, '{label}', {str(i < len(BASE)).lower()}, string_split('{phrase}', ' '))" for i, (phrase, label) in enumerate([*BASE.items(), *NOTICES.items()]))
OP6_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {SQL_WORDS} AS w FROM documents),
t AS (SELECT * FROM (VALUES {_VALUES}) AS x(template, label, exact, tw)),
tg AS (SELECT template, label, exact, len(tw) - 1 AS grams, i - 1 AS q, tw[i] AS a, tw[i + 1] AS b FROM (SELECT *, unnest(range(1, len(tw))) AS i FROM t)),
g AS (SELECT r, i - 1 AS p, w[i] AS a, w[i + 1] AS b FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM d)),
v AS (
  SELECT r, template, label, exact, grams, p - q AS diagonal, min(p) AS low, max(p) AS high, list(DISTINCT q) AS ats
  FROM g JOIN tg USING (a, b) GROUP BY ALL),
o AS (
  SELECT *, CASE WHEN exact OR lag(diagonal) OVER k IS NULL OR abs(diagonal - lag(diagonal) OVER k) > {SLACK} OR low > lag(high) OVER k + {GAP} THEN 1 ELSE 0 END AS new
  FROM v WINDOW k AS (PARTITION BY r, template ORDER BY low, diagonal)),
m AS (SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY low, diagonal) AS span FROM o),
s AS (
  SELECT r, template, label, exact, grams, span, min(low) AS low, len(list_distinct(flatten(list(ats)))) AS found
  FROM m GROUP BY r, template, label, exact, grams, span),
f AS (SELECT *, found / grams AS share FROM s WHERE CASE WHEN exact THEN found = grams ELSE found / grams >= {SHARE} END),
p AS (
  SELECT r, count(*) FILTER (exact) AS n_base, min(low) FILTER (exact) AS first_word, max(low) FILTER (exact) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM f GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN p USING (r)
"""
