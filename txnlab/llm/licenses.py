"""Licence scan by diagonal voting.

Every rolling k-word hash of every document joins the k-word hashes of the
licence templates.  A hit at document word p and template word q votes for the
diagonal p - q; the diagonals of one document and template that lie within
``DRIFT`` of each other are one span (words may be added or left out), and the
span's words are then compared with the template's one by one: it is verified by
the longest chain of equal words that goes forward in both, so that a template
word counts once however many diagonals show it.  A template is found where
``COVER`` of its words stand in one chain.

DataFrame operations only.  Hits are few and keyed by document, template and
diagonal, with partial counts before the shuffle; a line that many documents
share makes rows, not a hot key.  The templates, a Python list, are broadcast.

Words are runs of letters, digits and non-ASCII characters, lower-cased.  Null
and empty texts have no words and no labels.  Rows are told apart by key and
text: repeated rows have equal results, one row each.  An empty table gives an
empty one.  Only key and text are read, so that other columns can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlab.session import materialize

K = 3
DRIFT = 4
COVER = 0.8
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and labels of the base scan.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# Notices of common licences, by label.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
             "General Public License as published by the Free Software Foundation"),
    ("boost", "Distributed under the Boost Software License, Version 1.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("cc", "Licensed under CC BY 4.0"),
    ("cc", "Licensed under CC BY-NC 4.0"),
    ("cc", "Licensed under CC BY-SA 4.0"),
    ("cc", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
           "this work"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
            "License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be "
             "held liable for any damages arising from the use of this software"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced"),
]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR, -1), lambda w: w != "")


def gram_hashes(words: Column, k: int) -> Column:
    """64-bit hash of each run of k words."""
    def one(i):
        return F.xxhash64(*[F.get(words, i + j) for j in range(k)])
    return F.when(F.size(words) >= k, F.transform(F.sequence(F.lit(0), F.size(words) - k), one)).otherwise(
        F.array().cast("array<bigint>"))


def _documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    t = F.col(f"`{text}`")
    return docs.select(F.col(f"`{key}`").alias("_key"), F.xxhash64(t, F.length(t)).alias("_hash"),
                       words_of(t).alias("words"))


def _phrase_places(words: Column, phrase: str) -> Column:
    parts = phrase.split()

    def here(i):
        same = F.get(words, i) == parts[0]
        for j, w in enumerate(parts[1:], 1):
            same = same & (F.get(words, i + j) == w)
        return same
    return F.when(F.array_contains(words, parts[-1]) & (F.size(words) >= len(parts)),
                  F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), here)).otherwise(
        F.array().cast("array<int>"))


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=None, k: int = K) -> DataFrame:
    """(_key, _hash, spans): for each document with hits, its candidate spans:
    template number and, per diagonal, the first and last template word hit."""
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    t = spark.createDataFrame([(i, x) for i, (_, x) in enumerate(templates)], "t int, text string")
    t = t.select("t", F.posexplode(gram_hashes(words_of(F.col("text")), k)).alias("q", "h"))
    d = _documents(docs, key, text)
    d = d.select("_key", "_hash", F.posexplode(gram_hashes(F.col("words"), k)).alias("p", "h"))
    hits = d.join(F.broadcast(t), "h").withColumn("diagonal", F.col("p") - F.col("q"))
    votes = hits.groupBy("_key", "_hash", "t", "diagonal").agg(
        F.min("q").alias("first"), (F.max("q") + k - 1).alias("last"), F.count(F.lit(1)).alias("votes"))
    order = Window.partitionBy("_key", "_hash", "t").orderBy("diagonal")
    apart = F.when(F.col("diagonal") - F.lag("diagonal").over(order) <= DRIFT, 0).otherwise(1)
    votes = votes.withColumn("apart", apart).withColumn("span", F.sum("apart").over(order))
    found = votes.groupBy("_key", "_hash", "t", "span").agg(
        F.sort_array(F.collect_list(F.struct("diagonal", "first", "last"))).alias("runs"),
        F.sum("votes").alias("votes"))
    return found.groupBy("_key", "_hash").agg(
        F.sort_array(F.collect_list(F.struct("t", "runs", "votes"))).alias("spans"))


def _longest_chain(points: Column) -> Column:
    """Of points sorted by template word, then falling text word: for each length, the
    (end, start) of the chain that ends first; its size is the longest chain's.
    No longer than the template, however many points there are."""
    ends = F.array().cast("array<struct<end:int,start:int>>")

    def add(chain, point):
        p = -point["m"]
        n = F.size(F.filter(chain, lambda x: x["end"] < p))
        new = F.struct(p.alias("end"), F.coalesce(F.get(chain, n - 1)["start"], p).alias("start"))
        return F.concat(F.slice(chain, 1, n), F.array(new), F.slice(chain, n + 2, F.size(chain) + 1))
    return F.aggregate(points, ends, add)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=None, k: int = K) -> DataFrame:
    """One row per document: n_words, n_base, first_word and last_word (smallest
    and largest start of a base phrase), base_labels, labels, score (1 for a base phrase, else the best verified cover), and the
    verified spans (label, first word, last word, cover)."""
    templates = TEMPLATES if templates is None else templates
    found = materialize(spans(docs, key, text, templates, k), "license-spans")
    d = _documents(docs, key, text)
    f = found.select(F.col("_key").alias("_k"), F.col("_hash").alias("_h"), "spans")
    d = d.join(f, d["_key"].eqNullSafe(f["_k"]) & d["_hash"].eqNullSafe(f["_h"]), "left")
    w = F.col("words")
    names = F.array(*[F.lit(n) for n, _ in templates])
    notice = F.array(*[F.lit(x) for _, x in templates])

    def verify(s):
        own = words_of(F.element_at(notice, s["t"] + 1))

        def equal(r):  # words of the run that are the template's: (place in it, - place in the text)
            at = F.filter(F.sequence(r["first"], r["last"]), lambda q: F.get(w, q + r["diagonal"]) == F.get(own, q))
            return F.transform(at, lambda q: F.struct(q.alias("q"), (-q - r["diagonal"]).alias("m")))
        points = F.array_sort(F.flatten(F.transform(s["runs"], equal)))
        chain = _longest_chain(points)
        last = F.element_at(chain, -1)
        return F.struct(F.element_at(names, s["t"] + 1).alias("label"), last["start"].cast("long").alias("first_word"),
                        last["end"].cast("long").alias("last_word"), (F.size(chain) / F.size(own)).alias("cover"))

    none = F.array().cast("array<struct<label:string,first_word:long,last_word:long,cover:double>>")
    checked = F.when(F.col("spans").isNotNull(), F.filter(F.transform("spans", verify), lambda s: s["cover"] >= COVER))
    d = d.withColumn("found", F.coalesce(checked, none))
    places = [_phrase_places(w, p).alias(f"_p{i}") for i, (p, _) in enumerate(PHRASES)]
    d = d.select("_key", F.size(w).cast("long").alias("n_words"), "found", *places)
    every = F.concat(*[F.col(f"_p{i}") for i in range(len(PHRASES))])
    base = F.filter(F.array(*[F.when(F.size(f"_p{i}") > 0, F.lit(n)) for i, (_, n) in enumerate(PHRASES)]),
                    lambda x: x.isNotNull())
    best = F.coalesce(F.array_max(F.transform("found", lambda s: s["cover"])), F.lit(0.0))
    labels = F.array_sort(F.array_distinct(F.concat(base, F.transform("found", lambda s: s["label"]))))
    return d.select(
        F.col("_key").alias(key), "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.size(every) > 0, F.lit(1.0)).otherwise(best).alias("score"), F.col("found").alias("spans"))
