"""License scans by diagonal voting.

Texts and templates become words; every rolling k-gram of words is joined by its hash with the template positions where
the same k-gram stands (and the k-grams themselves are compared). A hit votes for its diagonal, document position minus
template position: a phrase that stands in a document as it is fills its diagonal, a changed copy of a template fills a
band of neighbouring diagonals. Votes are gathered in the scanning tasks before anything is shuffled, as one bit per
template position that a diagonal hits, so a diagonal and its bits say where every hit stands.

A phrase is found at each place whose diagonal has all its k-grams. A template's hits are verified by aligning them: a span
is a chain of hits whose document and template positions both grow and whose diagonals differ by at most ``BAND`` from one
hit to the next. It is found where a span covers at least ``COVERAGE`` of its k-grams; none counts twice, and a span is never
longer than the template with ``BAND`` words put in at every step. The templates are a fixed list, so their side of the join
is broadcast.

A null text is empty; texts with fewer than ``K`` words have no hit. Rows are told apart by where they stand, not by their
id, so null or repeated ids are rows of their own in the result.
"""

from __future__ import annotations

import re
from collections import deque

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.rows import texts

K = 3
BAND = 6  # diagonals of neighbouring hits are at most so far apart
COVERAGE = 0.6
# Phrases with their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
# Public licence notices with their labels.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # fixed value: what stands between words, after A-Z are lower-cased
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def plain_words(text: str) -> list[str]:
    return [w for w in re.split(_GAP, text.translate(str.maketrans(_CAPITALS, _SMALL))) if w]


def _template_grams(spark) -> DataFrame:
    rows = []
    sources = [(label, phrase, True) for phrase, label in PHRASES] + [(label, text, False) for label, text in TEMPLATES]
    for number, (label, text, exact) in enumerate(sources):
        words = plain_words(text)
        grams = [" ".join(words[i : i + K]) for i in range(len(words) - K + 1)]
        if len(grams) > 63:
            raise ValueError("a template of more than 63 k-grams needs wider bits")
        rows += [(number, label, exact, len(grams), at, 1 << at, gram) for at, gram in enumerate(grams)]
    table = spark.createDataFrame(rows, "template int, label string, exact boolean, n_grams int, at int, bit long, t_gram string")
    return F.broadcast(table.withColumn("hash", F.xxhash64("t_gram")))


def aligned(diagonals: list[int], bits: list[int]) -> int:
    """The most template positions that one span covers; bit ``i`` of a diagonal is a hit at template position ``i``."""
    least, most = 0, 0
    for b in bits:
        least, most = max(least, b.bit_count()), most | b
    if least == most.bit_count():
        return least
    hits = sorted((d + at, at) for d, b in zip(diagonals, bits) for at in range(b.bit_length()) if b >> at & 1)
    reach = most.bit_length() + BAND  # a span's next hit stands closer than this
    open_: deque[tuple[int, int, int]] = deque()  # position, template position, covered by the best span that ends there
    for pos, at in hits:
        while open_ and open_[0][0] < pos - reach:
            open_.popleft()
        best = 1 + max((n for p, a, n in open_ if p < pos and a < at and abs(pos - at - p + a) <= BAND), default=0)
        open_.append((pos, at, best))
        least = max(least, best)
    return least


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document.

    ``score`` is the largest share of a template's k-grams that a verified span covers, 1 with a whole phrase.
    """
    words = F.filter(F.split(F.translate("text", _CAPITALS, _SMALL), _GAP), lambda w: w != "")
    rows = texts(docs).select("doc_id", F.monotonically_increasing_id().alias("row"), words.alias("words"))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    # Three views of the words, shifted against each other, hold each k-gram in one place.
    shifted = [F.slice("words", k + 1, F.greatest(F.size("words") - K + 1, F.lit(0))) for k in range(K)]
    grams = F.transform(F.arrays_zip(*[s.alias(f"w{k}") for k, s in enumerate(shifted)]), lambda g: F.concat_ws(" ", *[g[f"w{k}"] for k in range(K)]))
    placed = rows.select("row", "doc_id", "n_words", F.posexplode_outer(grams).alias("pos", "gram")).withColumn("hash", F.xxhash64("gram"))
    table = _template_grams(docs.sparkSession)
    hits = placed.join(table, (placed.hash == table.hash) & (placed.gram == table.t_gram), "left")
    one = ["row", "doc_id", "n_words"]
    of = [*one, "template", "label", "exact", "n_grams"]
    votes = hits.groupBy(*of, (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.bit_or("bit").alias("bits"))
    whole = F.col("exact") & (F.bit_count("bits") == F.col("n_grams"))
    spans = votes.groupBy(*of).agg(
        F.count(F.when(whole, 1)).alias("places"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last"),
        F.collect_list(F.when(~F.col("exact"), F.struct("diagonal", "bits"))).alias("hits"),
    )

    @F.pandas_udf("int")
    def covered(diagonals: pd.Series, bits: pd.Series) -> pd.Series:
        return pd.Series([aligned(d.tolist(), b.tolist()) for d, b in zip(diagonals, bits)], dtype="int32")

    spans = spans.withColumn("covered", covered("hits.diagonal", "hits.bits"))
    share = F.when(F.col("exact"), (F.col("places") > 0).cast("double")).otherwise(F.col("covered") / F.col("n_grams"))
    share = F.when(F.col("template").isNull(), 0.0).otherwise(share)
    based = F.when(F.col("exact") & (F.col("places") > 0), F.col("label"))
    found = F.when(based.isNotNull() | (~F.col("exact") & (share >= COVERAGE)), F.col("label"))
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return spans.groupBy(*one).agg(
        F.sum("places").alias("n_base"),
        F.min("first").cast("long").alias("first_word"),
        F.max("last").cast("long").alias("last_word"),
        listed(based).alias("base_labels"),
        listed(found).alias("labels"),
        F.max(share).alias("score"),
    ).drop("row")
