"""Licence scan by MinHash over text windows, in DataFrame functions alone.

Texts and templates are lower-cased, split at everything but a-z and 0-9, and
hashed in five-word shingles. A template of L shingles belongs to windows of W
shingles, W the least power of two that is 2 L or more, laid at every W / 2, so
each run of L shingles lies whole in a window; a window that holds at least 0.8
of a template has a Jaccard similarity of 0.19 or more with it, and one of
``BANDS`` bands of a single row agrees with probability 1 - 0.81^64 > 0.999998.

A window can only agree with a template in a band if it holds the shingle whose
hash is the template's minimum there, so windows without any such shingle are
left out before their sketches are made. Windows that agree retrieve the
template, and the share of its shingles that the window holds, compared as text,
verifies the match.

Only the template library is broadcast and its size is checked.

Defined results: null, empty and wordless texts and texts under five words match
nothing; whole texts are read; repeated matches of one licence in a text are one
row with the best containment; repeated rows of one doc_id are one document;
other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from junctura.llm.common import checkpointed

SHINGLE = 5
BANDS = 64
CONTAINED = 0.8
LEAST_WINDOW = 2
MAX_LIBRARY = 1 << 20  # characters of all templates together

# Notices of public licences.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "mit-line": "Released under the MIT License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "lgpl-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")


def shingles(word: Column) -> Column:
    """Five-word shingles in order, as text."""
    n = F.size(word) - (SHINGLE - 1)
    some = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.array_join(F.slice(word, i, SHINGLE), " "))
    return F.when(n >= 1, some).otherwise(F.array().cast("array<string>"))


def sketch(hashes: Column) -> Column:
    """Minimum of each of the bands' hash functions."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda band: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, band)))
    )


def library(spark: SparkSession, templates: dict[str, str]) -> list:
    """Name, shingles, hashes and sketch of each template, on the driver."""
    if sum(map(len, templates.values())) > MAX_LIBRARY:
        raise ValueError(f"the templates have over {MAX_LIBRARY} characters; scan with parts of them in turn")
    frame = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    own = F.array_distinct(shingles(words(F.col("text"))))
    frame = frame.select("license", own.alias("own")).where(F.size("own") > 0)
    frame = frame.select("license", "own", F.transform("own", lambda s: F.xxhash64(s)).alias("hashes"))
    return frame.withColumn("sketch", sketch(F.col("hashes"))).withColumn(
        "minima", F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda band: F.array_min(F.transform("hashes", lambda h: F.struct(F.xxhash64(h, band).alias("rank"), h.alias("hash")))).hash)
    ).collect()


def window_of(n: int) -> int:
    w = LEAST_WINDOW
    while w < 2 * n:
        w *= 2
    return w


def license_matches(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and licence: doc_id, license, containment, start_word, end_word.

    start_word and end_word (exclusive) bound the shingles of the best window,
    the first of equals.
    """
    spark = docs.sparkSession
    known = library(spark, TEMPLATES if templates is None else templates)
    classes = sorted({window_of(len(r.own)) for r in known})
    table = spark.createDataFrame(
        [(r.license, window_of(len(r.own)), r.own, r.sketch) for r in known], "license string, size int, own array<string>, its_sketch array<long>"
    )
    body = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), words(F.col(f"`{text_col}`")).alias("word"))
    body = body.withColumn("hash", F.transform(shingles(F.col("word")), lambda s: F.xxhash64(s)))

    minima = {size: sorted({h for r in known if window_of(len(r.own)) == size for h in r.minima}) for size in classes}
    # One look at all shingles finds the places of any minimum; few texts have some.
    every = sorted({h for own in minima.values() for h in own})
    met = F.filter(F.transform("hash", lambda h, i: F.when(h.isin(every), F.struct(h.alias("h"), i.alias("i")))), lambda x: x.isNotNull())
    body = body.select("doc_id", "word", met.alias("met"))

    def wanted(size: int) -> Column:
        """(window size, number) of the windows of one size that hold a template's minimum."""
        at = F.transform(F.filter("met", lambda x: x.h.isin(minima[size])), lambda x: x.i)
        numbers = F.flatten(F.transform(at, lambda i: F.array(F.floor(i / (size // 2)).cast("int"), (F.floor(i / (size // 2)) - 1).cast("int"))))
        numbers = F.filter(F.array_distinct(numbers), lambda k: k >= 0)
        return F.transform(numbers, lambda k: F.struct(F.lit(size).alias("size"), k.alias("number")))

    if not classes:
        return body.select("doc_id", F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).cast("long").alias("start_word"), F.lit(0).cast("long").alias("end_word")).where("false")
    windows = body.select("doc_id", "word", F.explode(F.concat(*[wanted(size) for size in classes])).alias("w"))
    begin = F.col("w.number") * F.floor(F.col("w.size") / 2).cast("int")
    windows = windows.select("doc_id", F.col("w.size").alias("size"), begin.alias("begin"), F.slice("word", begin + 1, F.col("w.size") + (SHINGLE - 1)).alias("word"))
    windows = checkpointed(windows)
    windows = windows.withColumn("shingle", shingles(F.col("word")))
    windows = windows.withColumn("sketch", sketch(F.transform("shingle", lambda s: F.xxhash64(s))))
    met = windows.join(F.broadcast(table), "size").where(F.exists(F.zip_with("sketch", "its_sketch", lambda a, b: a == b), lambda x: x))
    shared = F.size(F.array_intersect("own", "shingle")) / F.size("own")
    places = F.filter(F.transform("shingle", lambda s, i: F.when(F.array_contains("own", s), i)), lambda i: i.isNotNull())
    met = met.select("doc_id", "license", shared.alias("containment"), "begin", places.alias("places")).where(F.col("containment") >= CONTAINED)
    best = F.max(F.struct("containment", (-(F.col("begin") + F.element_at("places", 1))).alias("from"), (F.col("begin") + F.element_at("places", -1) + SHINGLE).alias("till")))
    return met.groupBy("doc_id", "license").agg(best.alias("best")).select(
        "doc_id", "license", F.col("best.containment").alias("containment"), (-F.col("best.from")).cast("long").alias("start_word"), F.col("best.till").cast("long").alias("end_word")
    )
