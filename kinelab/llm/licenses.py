"""Operator 4: license scan by diagonal voting (DataFrame functions only).

Every text becomes its sequence of words; all its rolling word k-grams are
hashed (two words for the short phrases, four for the notices) and joined to
the positions of the equal k-grams in the templates. A match votes for the
diagonal ``text position - template position``. Votes of a phrase must fill
one diagonal completely. For a notice, neighbouring diagonals (words inserted
or missing) merge into one span, which is verified by the share of the
template's words that it covers and by its length in the text.

Hashes that occur in no template are dropped before the rows are exploded (an
exact test against the template hashes, a set of fixed size), and matched
k-grams are compared as words, so equal hashes alone never vote.

Defined cases: null text is empty; empty texts have no words and no labels
(empty strings, score 0); repeated rows get equal results; null ids are
ordinary; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelab.llm.common import staged

#: The phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices (words of the text, lower case) and their labels.
NOTICES = {
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under cc by 4 0": "cc-by-4.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
#: Words of a k-gram: of the phrases, of the notices.
SHORT, LONG = 2, 4
#: Share of a notice's words that a span covers at least, and words it may be longer or shorter by.
COVERED = 0.75
SHIFT = 2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_grams() -> list[tuple[str, bool, int, int, int, str]]:
    """(label, phrase?, template number, words, position, k-gram) of all templates."""
    out = []
    for number, (text, label) in enumerate([*PHRASES.items(), *NOTICES.items()]):
        words, k = text.split(), SHORT if number < len(PHRASES) else LONG
        out += [(label, number < len(PHRASES), number, len(words), i, " ".join(words[i:i + k])) for i in range(len(words) - k + 1)]
    return out


def words_of(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(low, _BREAK), lambda w: w != "")


def _hash(words: Column, i: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(words, i + j) for j in range(k)])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every document."""
    spark = docs.sparkSession
    grams = spark.createDataFrame(template_grams(), "label string, phrase boolean, template int, size int, at int, gram string")
    parts = F.split("gram", " ")
    hashed = grams.withColumn("h", F.when(F.col("phrase"), _hash(parts, F.lit(0), SHORT)).otherwise(_hash(parts, F.lit(0), LONG)))
    known = {p: [r["h"] for r in hashed.where(F.col("phrase") == p).select("h").distinct().collect()] for p in (True, False)}

    w = F.col("words")
    rolling = F.transform(w, lambda _, i: F.struct(i.alias("pos"), _hash(w, i, SHORT).alias("short"), _hash(w, i, LONG).alias("long")))
    hits = F.filter(rolling, lambda g: g["short"].isin(known[True]) | g["long"].isin(known[False]))
    spelled = F.transform(hits, lambda g: F.struct(
        g["pos"].alias("pos"), g["short"].alias("short"), g["long"].alias("long"),
        F.concat_ws(" ", F.slice(w, g["pos"] + 1, SHORT)).alias("short_gram"), F.concat_ws(" ", F.slice(w, g["pos"] + 1, LONG)).alias("long_gram")))
    texts = staged(docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), words_of(F.col("text")).alias("words"))
                   .select("doc_id", "row", F.size(w).cast("long").alias("n_words"), spelled.alias("hits")), "license-hits")

    hit = texts.where(F.size("hits") > 0).select("row", F.explode("hits").alias("g")).select("row", "g.*")
    found = (hit.select("row", "pos", F.col("short").alias("h"), F.col("short_gram").alias("gram"), F.lit(True).alias("phrase"))
             .unionByName(hit.select("row", "pos", F.col("long").alias("h"), F.col("long_gram").alias("gram"), F.lit(False).alias("phrase"))))
    votes = (found.join(F.broadcast(hashed), ["h", "gram", "phrase"])  # the templates: a table of fixed size
             .select("row", "template", "label", "phrase", "size", "at", "pos", (F.col("pos") - F.col("at")).alias("diagonal")).distinct())

    places = (votes.where("phrase").groupBy("row", "template", "label", "diagonal", "size").agg(F.count(F.lit(1)).alias("v"))
              .where(F.col("v") == F.col("size") - (SHORT - 1)).select("row", "label", F.col("diagonal").alias("start"), F.lit(1.0).alias("score")))

    along = Window.partitionBy("row", "template").orderBy("diagonal", "at")
    step = F.col("diagonal") - F.lag("diagonal").over(along)
    spans = (votes.where("not phrase").withColumn("new", F.when(step <= SHIFT, 0).otherwise(1))
             .withColumn("span", F.sum("new").over(along))
             .groupBy("row", "template", "label", "size", "span")
             .agg(F.collect_set("at").alias("at"), F.min("pos").alias("lo"), F.max("pos").alias("hi")))
    covered = F.array_distinct(F.flatten(F.transform("at", lambda a: F.sequence(a, a + (LONG - 1)))))
    score = F.size(covered) / F.col("size")
    near = F.abs(F.col("hi") + LONG - F.col("lo") - F.col("size")) <= F.col("size") * (1 - COVERED) + SHIFT
    verified = spans.where((score >= COVERED) & near).select("row", "label", F.lit(None).cast("int").alias("start"), score.alias("score"))

    labels = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))
    per_row = (places.unionByName(verified).groupBy("row")
               .agg(F.count("start").alias("n_base"), F.min("start").cast("long").alias("first_word"), F.max("start").cast("long").alias("last_word"),
                    labels(F.when(F.col("start").isNotNull(), F.col("label"))).alias("base_labels"),
                    labels(F.col("label")).alias("labels"), F.max("score").alias("score")))
    return (texts.select("doc_id", "row", "n_words").join(per_row, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
                    F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score")))
