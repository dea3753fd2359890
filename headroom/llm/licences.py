"""License scan by diagonal voting. DataFrame and SQL functions only.

All rolling word k-grams of every whole text are hashed and joined with the k-gram positions of the
license templates. A hit votes for the diagonal (position in the text minus position in the
template); a passage that follows a template puts its hits on one diagonal, and an inserted or
missing word moves the rest to a neighbouring one. Votes are summed by runs of a diagonal, and runs
on neighbouring diagonals, over no more of them than the template is long, become one span.

A span is verified in order: stray runs, with less than a quarter of the votes of its strongest run,
are dropped; the others are followed through the text, and each counts only for the part of the template
that comes after all parts before it. The span is believed if enough of the template's k-grams are
found so; its score is their share, and its ends are those of the runs that count.

Defined cases: null text has no words; null doc_ids and repeated rows are kept, one result row each;
spans of several templates at one place are all told, labels sorted; very long texts give more hits,
not larger groups, as a span is bounded by its template; an empty table gives an empty result; other
columns of the input are ignored. The broadcast side is the template table, which is fixed and small;
hits are few, since a text has as many as it has license words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, read, with_row_key

K = 3
#: Diagonals at most so far apart belong to one span.
NEIGHBOURS = 4
#: A run of a span counts if it has this part of the votes of the strongest one.
STRAY = 4
#: The share of a template's k-grams that a span needs.
BELIEVED = 0.6
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The phrases of the contract, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notices of public licenses, by the label they give.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0",
    "cc-by-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "gpl-3.0-notice": "licensed under the GNU General Public License, version 3",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "mit-notice": "Released under the MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "agpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "bsd-2-conditions": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-3-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-disclaimer": "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages",
    "cc0-notice": "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work",
    "epl-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "lgpl-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "mit-disclaimer": "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
}


def license_words(text: Column) -> Column:
    """Words of letters, digits and all that isn't ASCII; A-Z in lower case."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), lambda w: w != "")


def rolling(words: str, k: int = K) -> Column:
    """Hashes of all runs of k words of the array column `words`."""
    each = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, k)]))
    return F.slice(each, 1, F.greatest(F.size(words) - (k - 1), F.lit(0)))


def template_grams(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(h, label, t_at, t_n): k-gram hashes of the templates, their positions and number."""
    rows = spark.createDataFrame(list(templates.items()), "label string, text string").select("label", license_words(F.col("text")).alias("w"))
    return rows.select("label", rolling("w").alias("g")).select("label", F.size("g").alias("t_n"), F.posexplode("g").alias("t_at", "h"))


def places(words: str, phrase: str) -> Column:
    """Starts of a phrase in the array column `words`, given the places of its last word in `__last`."""
    *before, _ = phrase.split(" ")
    n = len(before)
    hit = lambda i: [F.coalesce(F.get(words, i - n + k) == w, F.lit(False)) for k, w in enumerate(before)]

    def all_of(i: Column) -> Column:
        out = i >= n
        for c in hit(i):
            out = out & c
        return out

    return F.transform(F.filter("__last", all_of), lambda i: i - n)


def verified_spans(hits: DataFrame) -> DataFrame:
    """(__row, label, share, first, end) of the spans of hits (__row, label, t_n, t_at, at), followed in order."""
    # one exchange: all windows and groups below lie within a row of the input
    placed = hits.repartition("__row").withColumn("diagonal", F.col("at") - F.col("t_at"))
    on = Window.partitionBy("__row", "label", "diagonal").orderBy("t_at")
    broken = F.coalesce((F.col("t_at") - F.lag("t_at").over(on) > 1).cast("int"), F.lit(0))
    runs = placed.withColumn("broken", broken).withColumn("run", F.sum("broken").over(on)).groupBy("__row", "label", "diagonal", "run").agg(F.max("t_n").alias("t_n"), F.count(F.lit(1)).alias("n"), F.min("t_at").alias("t0"), F.max("t_at").alias("t1"), F.min("at").alias("a0"), F.max("at").alias("a1"))
    by = Window.partitionBy("__row", "label").orderBy("diagonal", "t0")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by) > NEIGHBOURS).cast("int"), F.lit(0))
    chained = runs.withColumn("apart", apart).withColumn("chain", F.sum("apart").over(by))
    start = F.min("diagonal").over(Window.partitionBy("__row", "label", "chain"))
    spans = chained.withColumn("part", F.floor((F.col("diagonal") - start) / F.col("t_n")))
    span = ["__row", "label", "chain", "part"]
    kept = spans.withColumn("most", F.max("n").over(Window.partitionBy(*span))).filter(STRAY * F.col("n") >= F.col("most"))
    before = Window.partitionBy(*span).orderBy("a0", "t0").rowsBetween(Window.unboundedPreceding, -1)
    gain = F.greatest(F.lit(0), F.col("t1") + 1 - F.greatest(F.col("t0"), F.coalesce(F.max("t1").over(before) + 1, F.lit(0))))
    told = kept.withColumn("gain", gain).filter("gain > 0")
    return told.groupBy(*span).agg((F.sum("gain") / F.max("t_n")).alias("share"), F.min("a0").alias("first"), (F.max("a1") + K).alias("end")).drop("chain", "part")


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, base counts, base_labels, labels and score of every row of docs (doc_id, text)."""
    grams = F.broadcast(template_grams(docs.sparkSession, templates or TEMPLATES))  # fixed: a few hundred rows
    words = with_row_key(docs.select("doc_id", "text"), "__row").select("__row", "doc_id", license_words(F.col("text")).alias("w"), F.contains(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit("license")).alias("__any"))
    # every phrase ends in this word
    last = F.filter(F.transform("w", lambda w, i: F.when(w == "license", i)), lambda i: i.isNotNull())
    found = words.select("__row", "doc_id", "w", F.when(F.col("__any"), last).otherwise(F.array().cast("array<int>")).alias("__last"))
    based = found.select("__row", "doc_id", F.size("w").cast("long").alias("n_words"), *[places("w", p).alias(f"__{label}") for p, label in PHRASES.items()], rolling("w").alias("g"))
    labels = list(PHRASES.values())
    # a null hash stands for the row itself, so that one pass over the texts gives both hits and rows
    rows = based.select("__row", "doc_id", "n_words", *[f"__{x}" for x in labels], F.posexplode(F.concat("g", F.array(F.lit(None).cast("long")))).alias("at", "h"))
    hits = rows.join(grams, "h", "left").filter("h is null or label is not null")
    own = lambda c: F.when(F.col("h").isNull(), c)
    hits = cut(hits.select("__row", own(F.col("doc_id")).alias("doc_id"), own(F.col("n_words")).alias("n_words"), *[own(F.col(f"__{x}")).alias(f"__{x}") for x in labels], "at", "h", "label", "t_at", "t_n"), "license-hits")
    spans = verified_spans(hits.filter("h is not null").select("__row", "label", "t_n", "t_at", "at"))
    believed = spans.filter(F.col("share") >= BELIEVED).groupBy("__row").agg(F.collect_set("label").alias("told"), F.max("share").alias("share"), F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "label", "first", "end"))), ",").alias("spans"))
    base = F.array_compact(F.array(*[F.when(F.size(f"__{x}") > 0, F.lit(x)) for x in labels]))
    starts = F.concat(*[F.col(f"__{x}") for x in labels])
    joined = hits.filter("h is null").join(believed, "__row", "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, F.coalesce("told", F.array().cast("array<string>"))))), ",").alias("labels"),
        F.when(F.size(base) > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read(spark, sf_dir, "documents"))


def oracle_sql(templates: dict[str, str] | None = None) -> str:
    """DuckDB SQL for op5: the same votes by joins of the words themselves, without hashes."""
    import re

    rows = []
    for label, text in (templates or TEMPLATES).items():
        words = re.findall(r"[0-9a-z]+", text.lower())
        n = len(words) - K + 1
        rows += [f"('{label}', {i}, {n}, '{words[i]}', '{words[i + 1]}', '{words[i + 2]}')" for i in range(n)]
    start = {label: len(phrase.split()) - 1 for phrase, label in PHRASES.items()}
    return f"""WITH docs AS (SELECT row_number() OVER () rid, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SEPARATORS}'), lambda x: x <> '') ws FROM documents),
    words AS (SELECT rid, unnest(ws) w, generate_subscripts(ws, 1) - 1 i FROM docs),
    near AS (SELECT rid, i, w, lead(w, 1) OVER o w1, lead(w, 2) OVER o w2, lag(w, 1) OVER o b1, lag(w, 2) OVER o b2 FROM words WINDOW o AS (PARTITION BY rid ORDER BY i)),
    base AS (SELECT rid, CASE WHEN b1 = 'mit' THEN 'mit' WHEN b1 = 'apache' THEN 'apache' ELSE 'gpl' END label, CASE WHEN b1 IN ('mit', 'apache') THEN i - {start["mit"]} ELSE i - {start["gpl"]} END AS spot
      FROM near WHERE w = 'license' AND (b1 IN ('mit', 'apache') OR (b1 = 'public' AND b2 = 'general'))),
    grams AS (SELECT * FROM (VALUES {", ".join(rows)}) v(label, t_at, t_n, a, b, c)),
    hits AS (SELECT rid, label, t_n, t_at, i AS spot, i - t_at diagonal FROM near JOIN grams ON w = a AND w1 = b AND w2 = c),
    marked AS (SELECT *, sum(broken) OVER (PARTITION BY rid, label, diagonal ORDER BY t_at) run FROM (SELECT *, CASE WHEN t_at - lag(t_at) OVER (PARTITION BY rid, label, diagonal ORDER BY t_at) > 1 THEN 1 ELSE 0 END broken FROM hits)),
    runs AS (SELECT rid, label, diagonal, run, max(t_n) t_n, count(*) n, min(t_at) t0, max(t_at) t1, min(spot) a0, max(spot) a1 FROM marked GROUP BY ALL),
    chained AS (SELECT *, sum(apart) OVER (PARTITION BY rid, label ORDER BY diagonal, t0) chain FROM (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, label ORDER BY diagonal, t0) > {NEIGHBOURS} THEN 1 ELSE 0 END apart FROM runs)),
    parted AS (SELECT *, max(n) OVER (PARTITION BY rid, label, chain, part) strongest FROM (SELECT *, floor((diagonal - min(diagonal) OVER (PARTITION BY rid, label, chain)) / t_n) part FROM chained)),
    followed AS (SELECT *, greatest(0, t1 + 1 - greatest(t0, coalesce(max(t1) OVER (PARTITION BY rid, label, chain, part ORDER BY a0, t0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, 0))) gain FROM parted WHERE {STRAY} * n >= strongest),
    spans AS (SELECT rid, label, sum(gain) / max(t_n) AS share, min(a0) AS first, max(a1) + {K} AS stop FROM followed WHERE gain > 0 GROUP BY rid, label, chain, part),
    told AS (SELECT rid, list(DISTINCT label) labels, max(share) share, array_to_string(list_sort(list(label || ':' || first || ':' || stop)), ',') spans FROM spans WHERE share >= {BELIEVED} GROUP BY rid),
    based AS (SELECT rid, count(*) n, min(spot) AS first, max(spot) AS last, list_sort(list(DISTINCT label)) labels FROM base GROUP BY rid)
    SELECT doc_id, len(ws) n_words, coalesce(n, 0) n_base, b.first first_word, b.last last_word, coalesce(array_to_string(b.labels, ','), '') base_labels,
      coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, CAST([] AS VARCHAR[])), coalesce(t.labels, CAST([] AS VARCHAR[]))))), ','), '') labels,
      CASE WHEN n > 0 THEN 1.0 ELSE coalesce(t.share, 0.0) END score, coalesce(t.spans, '') spans
    FROM docs LEFT JOIN told t USING (rid) LEFT JOIN based b USING (rid)"""
