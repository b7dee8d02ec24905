"""License scans: MinHash bands over overlapping text windows retrieve templates, containment verifies them.

Words are runs of letters and digits, lower-cased; shingles are five words. A template of n shingles is looked
for in windows of 2c shingles, c the least power of two not under n, that begin at every c: each stretch of n
shingles lies whole in one of them. The signature has BANDS bands of one minimum each. A window that holds
the needed share of a template has a Jaccard similarity of at least 0.19 with it, so it shares no band
with probability (1 - 0.19) ** 66, less than one in a million. What the bands retrieve is verified by
exact containment: the share of the template's distinct shingles, as words, that the window holds.

A band can only be shared if the window holds the template's least shingle of that band. So windows are formed
around those shingles only, wherever one occurs in a text; all other windows share no band.

Templates are a list of bounded size, checked by ``scan``; texts are never cut. Everything is SQL functions.

Defined results: a null text, or one under five words, matches nothing; a template under five words is an
error; a document has one row per license that matches; rows that repeat an identifier have one row between
them; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import shared_folder, stored

SIZE, PERCENT, BANDS = 5, 80, 66
#: Most words of all templates together: their band minima are constants of the scan.
MOST_WORDS = 20_000
SEPARATOR = r"[^\p{L}\p{N}]+"

#: Notices by which texts name their license, and the operative sentences of the licenses themselves.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "LGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at",
    ),
    ("CC0-1.0", "has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
)


def scan_words(text: Column) -> Column:
    """The words of a text, lower-cased."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR), lambda w: w != "")


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` evaluated once, however often it is used."""
    return F.transform(F.array(value), then)[0]


def _shingles(words: Column) -> Column:
    """The hash of each run of SIZE words, in order; ``words`` has SIZE words or more."""
    return F.transform(
        F.sequence(F.lit(0), F.size(words) - SIZE), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SIZE)])
    )


def _shingle_words(words: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.size(words) - SIZE), lambda i: F.array_join(F.slice(words, i + 1, SIZE), " ")
    )


def _minima(shingles: Column) -> Column:
    """BANDS minima of a set of shingle hashes, each under a hash function of its own."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda band: F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, band))),
    )


def template_table(spark, templates=TEMPLATES) -> DataFrame:
    """(template, license, words, n, step): n distinct shingles, step c; a bounded table."""
    words = scan_words(F.col("text"))
    rows = [(i, name, text) for i, (name, text) in enumerate(templates)]
    table = spark.createDataFrame(rows, "template int, license string, text string").withColumn("words", words)
    short, total = table.agg(F.min(F.size("words")), F.sum(F.size("words"))).first()
    if short is not None and short < SIZE:
        raise ValueError(f"a template needs {SIZE} words")
    if (total or 0) > MOST_WORDS:
        raise ValueError(f"the templates have more than {MOST_WORDS} words")
    n = F.size(F.array_distinct(_shingle_words(F.col("words"))))
    return table.withColumn("n", n).withColumn("step", F.pow(2, F.ceil(F.log2("n"))).cast("int"))


def _windows(hashes: Column, words: Column, keys: dict[int, list[int]]) -> Column:
    """The windows of a text that hold a template's band minimum: (step, at, hashes, words)."""

    def of(step: int, values: list[int]) -> Column:
        places = F.sequence(F.lit(0), F.size(hashes) - 1)
        hits = F.filter(places, lambda i: F.get(hashes, i).isin(values))
        block = F.transform(hits, lambda i: F.floor(i / step).cast("int"))
        begins = F.array_distinct(F.flatten(F.transform(block, lambda b: F.array(b - 1, b))))
        return F.transform(
            F.filter(begins, lambda b: b >= 0),
            lambda b: F.struct(
                F.lit(step).alias("step"),
                (b * step).alias("at"),
                F.slice(hashes, b * step + 1, 2 * step).alias("hashes"),
                F.slice(words, b * step + 1, 2 * step + SIZE - 1).alias("words"),
            ),
        )

    found = [of(step, values) for step, values in sorted(keys.items())]
    return F.flatten(F.array(*found))


def _lost(verified: DataFrame, wanted: DataFrame, path: str) -> DataFrame:
    """(lost_id, lost_template, lost_found): matches that a better one in the document explains wholly.

    Better is more of the template, then the larger template, of another license; explained is a match whose found
    shingles are all shingles of the better template. A document has one row a template on the better side.
    """
    share = F.col("n_found") / F.col("n")
    matched = stored(verified.groupBy("doc_id", "template", "license", "n").agg(F.max(share).alias("share")), path)
    weak = verified.select(
        F.col("doc_id").alias("lost_id"),
        F.col("template").alias("lost_template"),
        F.col("license").alias("lost_license"),
        F.col("found").alias("lost_found"),
        F.struct(share.alias("share"), "n").alias("lost"),
    )
    strong = matched.join(wanted.select("template", "asked"), "template")
    beaten = (
        F.col("doc_id").eqNullSafe(F.col("lost_id"))
        & (F.col("license") != F.col("lost_license"))
        & (F.struct("share", "n") > F.col("lost"))
        & (F.size(F.array_except("lost_found", "asked")) == 0)
    )
    return weak.join(strong, beaten).select("lost_id", "lost_template", "lost_found").distinct()


def scan(docs: DataFrame, templates=TEMPLATES, folder: str | None = None) -> DataFrame:
    """One row per document and license found: doc_id, license, n_shingles, n_found, containment, word_at.

    Of a license's templates and the windows of a text the best match counts, then the first. Neighbours such as
    the GNU headers hold most of each other: a match without a shingle of its own gives way to the better one.
    Where several headers in one window hold all shingles of another license, that is a match as well.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "licenses")
    table = stored(template_table(spark, templates), f"{folder}/templates")
    bands = table.select(
        "template", "step", F.posexplode(_minima(_shingles(F.col("words")))).alias("band", "value")
    )
    # The shingles that are a band's minimum: at most as many as the templates' words, see MOST_WORDS.
    least = (
        table.select("step", F.explode(_shingles(F.col("words"))).alias("shingle"), "template")
        .join(bands.select("template", "band", "value"), "template")
        .filter(F.xxhash64("shingle", "band") == F.col("value"))
        .select("step", "shingle")
        .distinct()
    )
    keys: dict[int, list[int]] = {}
    for row in least.collect():
        keys.setdefault(row["step"], []).append(row["shingle"])

    text_words = let(
        scan_words(F.col("text")),
        lambda words: F.when(
            F.size(words) >= SIZE, let(_shingles(words), lambda hashes: _windows(hashes, words, keys))
        ),
    )
    # The outer generator and the filter on its result keep Spark from cutting each text twice.
    windows = stored(
        docs.select("doc_id", F.explode_outer(text_words).alias("window"))
        .filter(F.col("window").isNotNull())
        .select(F.xxhash64("doc_id", "window.words").alias("id"), "doc_id", "window.*"),
        f"{folder}/windows",
    )
    retrieved = (
        windows.select("id", "at", "step", F.posexplode(_minima(F.col("hashes"))).alias("band", "value"))
        .join(bands, ["step", "band", "value"])
        .select("id", "at", "template")
        .distinct()
    )
    wanted = table.select("template", "license", "n", F.array_distinct(_shingle_words(F.col("words"))).alias("asked"))
    verified = (
        windows.select("id", "at", "doc_id", _shingle_words(F.col("words")).alias("held"))
        .join(retrieved, ["id", "at"])
        .join(wanted, "template")
        .withColumn("found", F.array_intersect("asked", "held"))
        .withColumn("n_found", F.size("found"))
        .filter(F.col("n_found") * 100 >= F.col("n") * PERCENT)
        .select("doc_id", "at", "template", "license", "n", "n_found", "found")
    )
    verified = stored(verified, f"{folder}/verified")
    lost = _lost(verified, wanted, f"{folder}/matched")
    verified = verified.join(
        lost,
        F.col("doc_id").eqNullSafe(F.col("lost_id"))
        & (F.col("template") == F.col("lost_template"))
        & (F.col("found") == F.col("lost_found")),
        "left_anti",
    )
    best = F.max(
        F.struct(
            (F.col("n_found") / F.col("n")).alias("containment"), "n", (-F.col("at")).alias("before"), "n_found"
        )
    )
    return (
        verified.groupBy("doc_id", "license")
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "license",
            F.col("best.n").cast("long").alias("n_shingles"),
            F.col("best.n_found").cast("long").alias("n_found"),
            F.col("best.containment").alias("containment"),
            (-F.col("best.before")).cast("long").alias("word_at"),
        )
    )


def miss_probability(n: int, percent: int = PERCENT) -> float:
    """Chance that a window with so much of a template of n shingles shares no band with it."""
    held = math.ceil(n * percent / 100)
    step = 1 << max(n - 1, 0).bit_length()
    return (1 - held / (2 * step + n - held)) ** BANDS
