"""Licence scan by diagonal voting.

All rolling ``K``-word hashes of the documents are joined with the positions
of the templates' hashes (and the words compared, so a hash never decides).
A template that stands in a text puts its hits on one diagonal, document
position minus template position; missing or extra words move the rest of it
to a neighbouring one. So hits are counted by diagonal, diagonals at most
``gap`` apart are merged, and a merged span is a licence if the template words
it verifies are at least ``share`` of the template. A licence may lack up to
the rest of its words in one place (a dropped clause), so for long templates
the gap is that rest; in turn a diagonal of a long template counts from a
twentieth of its words on, lest its own repeated wording tie copies together.

Phrases are templates that count only whole, on one diagonal (the base rule).

Native: the words stay one array per document, its positions are exploded
inside one generated loop, and only hits (and one row a document) leave the
scan. The template table is small by construction: it is cut into blocks of
at most ``BLOCK`` rows, each broadcast on its own, however many templates
are given.

Templates and phrases shorter than ``K`` words are looked up by their whole
length, in a pass of its own for each such length; one without a word raises.

Null text: no words, no label, score 0. Texts shorter than ``K`` words have
no hits but those of shorter phrases. Repeated rows are rows of their own. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickvault.llm.common import alnum_words, materialize, pick, with_words
from clickvault.llm.license_texts import WHOLE

K = 3
BLOCK = 200_000
#: fixed values: base phrases and their labels
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
#: one-line notices and whole texts
TEMPLATES = [
    *WHOLE,
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "Released under the MIT License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
]


def template_grams(spark: SparkSession, templates: list[tuple[str, str]], phrases: list[tuple[str, str]]) -> DataFrame:
    """One row per template position: ``template label phrase m t hash gram`` (``m``: the template's words)."""
    rows = [(i, label, text, i >= len(templates)) for i, (text, label) in
            enumerate([(t, x) for x, t in templates] + list(phrases))]
    words = spark.createDataFrame(rows, "template int, label string, text string, phrase boolean").withColumn("w", alnum_words(F.col("text")))
    words = words.withColumn("m", F.size("w"))
    if words.filter("m = 0").count():
        raise ValueError("a template or phrase has no word")
    at = words.select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.col("m") - K, F.lit(0)))).alias("t"))
    gram = [F.get("w", F.col("t") + i) for i in range(K)]  # beyond a short one's end: null, which neither of the two below counts
    return at.select("template", "label", "phrase", "m", "t", F.xxhash64(*gram).alias("hash"), F.concat_ws(" ", *gram).alias("gram"))


def hits(docs: DataFrame, grams: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document (``pos`` null) and per position where a template's words stand."""
    short = [n for n in range(1, K) if grams.filter(F.col("m") == n).limit(1).count()]
    shorter, grams = grams.filter(F.col("m") < K), grams.filter(F.col("m") >= K)
    blocks = -(-grams.count() // BLOCK) or 1
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("rid", F.monotonically_increasing_id())
    # several blocks read the rows several times, and must find them under the same number
    words = with_words(rows if blocks == 1 and not short else materialize(rows, "license-rows"), "text", "w").withColumn("n_words", F.size("w"))
    # position -1 stands for the document itself and meets one row of its own
    at = words.select("*", F.explode_outer(F.sequence(F.lit(-1), F.greatest(F.col("n_words") - K, F.lit(-1)))).alias("pos"))
    word = [F.get("w", F.col("pos") + i) for i in range(K)]
    keyed = at.withColumn("hash", F.when(F.col("pos") >= 0, F.xxhash64(*word)).otherwise(F.lit(0)))
    own = grams.sparkSession.range(1).select(F.lit(None).cast("int").alias("template"), F.lit(None).cast("string").alias("label"),
                                             F.lit(None).cast("boolean").alias("phrase"), F.lit(None).cast("int").alias("m"),
                                             F.lit(None).cast("int").alias("t"), F.lit(0).cast("long").alias("hash"),
                                             F.lit(None).cast("string").alias("gram"))
    found = []
    for b in range(blocks):  # at most BLOCK rows each
        side = grams.filter(F.pmod("hash", F.lit(blocks)) == b) if blocks > 1 else grams
        side = side.unionByName(own) if b == 0 else side
        # a gram that hashes to 0 would meet the document's row: the words decide
        same = F.when(F.col("pos") >= 0, F.concat_ws(" ", *word).eqNullSafe(F.col("gram"))).otherwise(F.col("template").isNull())
        found.append(keyed.join(F.broadcast(side), "hash").filter(same)
                     .select("rid", "doc_id", "n_words", "template", "label", "phrase", "m", "t", F.when(F.col("pos") >= 0, F.col("pos")).alias("pos")))
    for n in short:
        few = shorter.filter(F.col("m") == n)
        blocks = -(-few.count() // BLOCK) or 1
        some = [F.get("w", F.col("pos") + i) for i in range(n)]
        at = words.filter(F.col("n_words") >= n).select("*", F.explode(F.sequence(F.lit(0), F.col("n_words") - n)).alias("pos"))
        for b in range(blocks):
            found.append(at.withColumn("hash", F.xxhash64(*some)).join(F.broadcast(few.filter(F.pmod("hash", F.lit(blocks)) == b)), "hash")
                         .filter(F.concat_ws(" ", *some) == F.col("gram"))
                         .select("rid", "doc_id", "n_words", "template", "label", "phrase", "m", "t", "pos"))
    return reduce(DataFrame.unionByName, found)


def _slack(share: float) -> int:
    """Per cent of a template that may be missing."""
    return round(100 * (1 - share))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES,
         gap: int = 2, share: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id n_words n_base first_word last_word base_labels
    labels score spans``; ``spans`` are the verified licences as label, first
    word, word after the last one, and share of the template."""
    grams = template_grams(docs.sparkSession, templates, phrases)
    rows = materialize(hits(docs, grams, id_col, text_col), "license-hits")
    votes = rows.filter("template IS NOT NULL").withColumn("diagonal", F.col("pos") - F.col("t"))
    by_diagonal = votes.groupBy("rid", "template", "label", "phrase", "m", "diagonal").agg(
        F.count(F.lit(1)).alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.collect_set("t").alias("ts"))
    base = (by_diagonal.filter(F.col("phrase") & (F.col("votes") == F.greatest(F.col("m") - K + 1, F.lit(1))))
            .groupBy("rid").agg(F.count(F.lit(1)).alias("n_base"), F.min("diagonal").cast("long").alias("first_word"),
                                F.max("diagonal").cast("long").alias("last_word"), F.collect_set("label").alias("base")))
    one = Window.partitionBy("rid", "template").orderBy("diagonal")
    apart = F.greatest(F.lit(gap), F.expr(f"m * {_slack(share)} div 100"))
    merged = by_diagonal.filter("NOT phrase AND votes >= greatest(1, m div 20)").withColumn(
        "new", F.coalesce(F.col("diagonal") - F.lag("diagonal").over(one) > apart, F.lit(True)).cast("int"))
    merged = merged.withColumn("span", F.sum("new").over(one)).groupBy("rid", "template", "label", "m", "span").agg(
        F.min("lo").alias("lo"), (F.max("hi") + F.least("m", F.lit(K))).alias("hi"), F.array_distinct(F.flatten(F.collect_list("ts"))).alias("ts"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("ts", lambda t: F.sequence(t, t + F.least("m", F.lit(K)) - 1)))))
    verified = (merged.withColumn("covered", F.round(covered / F.col("m"), 6)).filter(F.col("covered") >= share)
                .groupBy("rid").agg(F.collect_set("label").alias("own"), F.max("covered").alias("best"),
                                    F.sort_array(F.collect_list(F.struct("lo", "hi", "label", "covered"))).alias("spans")))
    docs_rows = rows.filter("template IS NULL").select("rid", "doc_id", F.col("n_words").cast("long").alias("n_words"))
    out = docs_rows.join(base, "rid", "left").join(verified, "rid", "left")
    none = F.array().cast("array<string>")
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        listed(F.coalesce("base", none)).alias("base_labels"),
        listed(F.concat(F.coalesce("base", none), F.coalesce("own", none))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"), "spans")


def oracle_sql(templates: list[tuple[str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES, gap: int = 2, share: float = 0.8) -> str:
    """The same in DuckDB's SQL, grams compared as text."""
    given = [(t, x, "false") for x, t in templates] + [(t, x, "true") for t, x in phrases]
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quoted(label)}, {quoted(text)}, {phrase})" for i, (text, label, phrase) in enumerate(given))
    words = lambda c: (f"list_filter(string_split_regex(translate(coalesce({c}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "  # noqa: E731
                       r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
    grams = lambda t, keys, n: f"""SELECT {keys}, {n}, a || ' ' || b || ' ' || c AS gram FROM (
    SELECT *, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c
    FROM (SELECT {keys}, unnest(w) AS a, generate_subscripts(w, 1) - 1 AS {n} FROM {t})
    WINDOW o AS (PARTITION BY {keys} ORDER BY {n})) WHERE c IS NOT NULL"""  # noqa: E731
    return f"""
WITH t AS (SELECT template, label, phrase, {words('body')} AS w FROM (VALUES {values}) v(template, label, body, phrase)),
tg AS ({grams('(SELECT *, len(w) AS m FROM t)', 'template, label, phrase, m', 't')}),
d AS (SELECT doc_id, {words('text')} AS w FROM documents),
dg AS ({grams('d', 'doc_id', 'pos')}),
vote AS (SELECT doc_id, template, label, phrase, m, t, pos, pos - t AS diagonal FROM dg JOIN tg USING (gram)),
diag AS (SELECT doc_id, template, label, phrase, m, diagonal, count(*) AS votes, list(DISTINCT t) AS ts
         FROM vote GROUP BY ALL),
base AS (SELECT doc_id, count(*) AS n_base, min(diagonal) AS first_word, max(diagonal) AS last_word, list(DISTINCT label) AS base
         FROM diag WHERE phrase AND votes = m - 2 GROUP BY doc_id),
marked AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER o <= greatest({gap}, m * {_slack(share)} // 100) THEN 0 ELSE 1 END AS fresh
           FROM diag WHERE NOT phrase AND votes >= greatest(1, m // 20)
           WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)),
spans AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM marked),
merged AS (SELECT doc_id, template, label, m, span, round(len(list_distinct(flatten(list(list_concat(ts, list_transform(ts, lambda x: x + 1),
           list_transform(ts, lambda x: x + 2)))))) / m, 6) AS covered FROM spans GROUP BY doc_id, template, label, m, span),
own AS (SELECT doc_id, list(DISTINCT label) AS own, max(covered) AS best FROM merged WHERE covered >= {share} GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(own, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN own USING (doc_id)
"""
