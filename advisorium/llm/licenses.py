"""License scan: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Everything is built-in expressions over arrays, without a shuffle of texts. A segment of a text becomes hashes of
its five-word shingles, in panes of ``p`` shingles; windows are 25 panes and begin at every pane. A template of n
shingles belongs to the largest p among 1, 4, 16, ... with 3p <= n, so it is shorter than twelve panes, and the
window around a pane that holds a shingle of it holds all of it. A band is one minimum over the shingle hashes under
one mask: the template's smallest shingle lies in some pane, and is the smallest of that pane as well with a chance
of n / (n + p - 1) at least, four fifths, or surely for p = 1. So a whole occurrence is missed with a chance of
0.2 ** bands at most. Windows retrieved by equal minima are verified: the share of a template's shingles found in
the window must reach ``containment``. The panes of 4p take their minima from those of p.
"""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorium.llm.shared import packed, unpacked

WORDS = 5
# Notices as their publishers word them.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "MIT line": "Released under the MIT License.",
    "CC-BY-4.0 line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                      "provided that the following conditions are met",
    "GPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                      "General Public License as published by the Free Software Foundation, either version 3 of the "
                      "License, or (at your option) any later version.",
    "MIT permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                      "associated documentation files (the \"Software\"), to deal in the Software without restriction",
}
RESULTS = ("license", "containment", "position", "windows")


def words(text):
    """Runs of letters and digits in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def coded(array):
    """A hash of each word."""
    return F.transform(array, lambda w: F.xxhash64(w))


def shingles(codes):
    """Hashes of the five-word shingles of a column of word hashes; none for fewer words."""
    last = F.size(codes) - WORDS
    return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(F.slice(codes, i + 1, WORDS))))


def masks(bands):
    """One mask per band; an exclusive or with it orders the hashes anew."""
    return [((i + 1) * 0x9E3779B97F4A7C15) % (1 << 64) - (1 << 63) for i in range(bands)]


def literal(values):
    return F.array(*[F.lit(v) for v in values]).cast("array<bigint>")


def prepared(spark, templates, bands):
    """{p: [(name, shingle hashes, minimum per band)]}; as small as the templates, which the caller gives."""
    rows = spark.createDataFrame(list(templates.items()), "name string, text string")
    found = rows.select("name", coded(words(F.col("text"))).alias("codes")).select(
        "name", F.array_distinct(shingles(F.col("codes"))).alias("hashes")).collect()
    classes = {}
    for name, hashes in sorted((r["name"], r["hashes"]) for r in found):
        if hashes:
            p = 1
            while 12 * p <= len(hashes):
                p *= 4
            classes.setdefault(p, []).append((name, hashes, [min(h ^ m for h in hashes) for m in masks(bands)]))
    return classes


def quartered(a):
    """The minima of every four elements in a row."""
    last = F.greatest(F.floor((F.size(a) - 1) / 4).cast("int"), F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.array_min(F.slice(a, 4 * k + 1, 4)))


def retrieved(panes, members):
    """Numbers of the panes that have the minimum of a template in some band; the cheap test for any comes first."""
    bands = len(members[0][2])
    wanted = [literal(sorted({m[2][j] for m in members})) for j in range(bands)]
    some = reduce(or_, [F.coalesce(F.arrays_overlap(F.get(panes, j), wanted[j]), F.lit(False)) for j in range(bands)])

    def hits(a, j):
        return F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda k: F.array_contains(F.get(F.array(*wanted), j), F.get(a, k)))

    return F.when(some, F.array_distinct(F.flatten(F.transform(panes, hits)))).otherwise(F.array().cast("array<int>"))


def single(hashes, members, bands):
    """The same for panes of one shingle: its hash is the minimum under every mask, so one look tells for all bands."""
    wanted = literal(sorted({low ^ m for _, _, lows in members for low, m in zip(lows, masks(bands))}))
    return F.when(F.arrays_overlap(hashes, wanted), F.filter(
        F.sequence(F.lit(0), F.size(hashes) - 1), lambda k: F.array_contains(wanted, F.get(hashes, k)))).otherwise(
        F.array().cast("array<int>"))


def verified(p, name, hashes):
    """The windows of class ``p`` with the containment of one template in each, and where they begin."""
    def match(k):
        begin = F.greatest((k - 12) * p, F.lit(0))
        own = F.slice("hashes", begin + 1, (k + 13) * p - begin)
        return F.struct(F.lit(name).alias("license"), (F.size(F.array_intersect(own, literal(hashes))) / len(hashes)).alias("containment"),
                        (F.col("first") + begin).alias("position"))

    return F.transform(F.col(f"windows_{p}"), match)


def scan(df: DataFrame, templates=None, id_col="doc_id", text_col="text", carry=None, containment=0.8, bands=5,
         segment_words=4000) -> DataFrame:
    """One row per text and template found in it: license, containment (the best window), position (the word at
    which the first window found begins, from 0) and windows (how many were found).

    Null, empty and short texts (under five words) give no rows, nor does an empty table. Repeated rows are scanned
    each on its own. Long texts are cut into segments that overlap by the longest window, so a task holds one
    segment's hashes. Columns of ``df`` named like a result are replaced.
    """
    carry = [c for c in (df.columns if carry is None else carry) if c not in RESULTS]
    classes = prepared(df.sparkSession, templates or TEMPLATES, bands)
    overlap = 25 * max(classes, default=1) + WORDS
    step = max(segment_words, overlap) - overlap + 1
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = df.select(packed(df, carry), F.monotonically_increasing_id().alias("row_id"), coded(words(text)).alias("words"))
    parts = rows.select("row", "row_id", "words", F.explode_outer(F.sequence(
        F.lit(0), F.greatest(F.size("words") - WORDS, F.lit(0)), F.lit(step))).alias("first"))
    parts = parts.select("row", "row_id", "first", F.slice("words", F.col("first") + 1, max(segment_words, overlap)).alias("codes"))
    hashed = parts.select("row", "row_id", "first", shingles(F.col("codes")).alias("hashes"))
    level, p, found = hashed, 1, sorted(classes)
    if 1 in classes:
        level = level.withColumn("windows_1", single(F.col("hashes"), classes[1], bands))
    while p < max(found, default=1):
        if p == 1:
            level = level.withColumn("masked", F.transform(literal(masks(bands)), lambda m: F.transform("hashes", lambda h: h.bitwiseXOR(m))))
        level = level.withColumn("panes", F.transform("masked" if p == 1 else "panes", quartered))
        p *= 4
        if p in classes:
            level = level.withColumn(f"windows_{p}", retrieved(F.col("panes"), classes[p]))
    matches = [verified(p, name, hashes) for p in found for name, hashes, _ in classes[p]]
    # outer explodes: from others the optimizer infers filters, and computes all this a second time for them
    windows = level.select("row", "row_id", F.explode_outer(
        F.filter(F.concat(*matches), lambda m: m["containment"] >= containment)).alias("m")).where("m IS NOT NULL")
    # the segments of a text overlap, so a window may be found twice
    best = windows.groupBy("row_id", "m.license").agg(
        F.first("row").alias("row"), F.max("m.containment").alias("containment"), F.min("m.position").cast("bigint").alias("position"),
        F.count_distinct("m.position").alias("windows"))
    return unpacked(best, carry, {n: F.col(n) for n in RESULTS})
