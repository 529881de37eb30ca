"""Licence notices in documents: MinHash bands retrieve templates, shingle containment verifies them.

Words are runs of letters and digits in lower case; shingles are five words (a template of fewer words
would be one shingle; none is). Shingles that occur in no template cannot count for containment, so only
the others, a row each, go on. Windows are as long as the longest template and half of it. Of the hits of each
template, overlapping stretches of two windows, one every window, make MinHashes; ``BANDS`` bands of one MinHash
each retrieve the templates that share a band. A stretch that holds a window of containment s meets its template
with probability 1 - (1 - s) ** BANDS, over 0.9999998 at 0.5. A retrieved template is reported where some
window holds ``CONTAINMENT`` of its shingles or more: each hit is one more distinct shingle for the windows
that begin after its last occurrence, so running sums over begins and ends give all windows' counts exactly, in
time that grows with the hits.

Templates are a dictionary or a frame of ``name`` and ``text``; with up to ``BROADCAST`` shingles they are
broadcast, with more they are joined by shuffles. Null and empty texts have no licences. Rows with equal ids
(null included) share the licences found in any of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caretiers.llm.common import documents, let, stored

BANDS = 22
CONTAINMENT = 0.75
#: Shingles of all templates, up to which they are broadcast.
BROADCAST = 500_000

# Notices and opening paragraphs of well-known licences.
TEMPLATES = {
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MIT-notice": "Released under the MIT License",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code or binary form, for any purpose, commercial or non-commercial, and by any means.",
}


def shingles(text: str) -> str:
    """SQL text: hashes of the five-word shingles of a text in order; of all words if there are fewer, none if none."""
    normal = f"btrim(regexp_replace(lower({text}), '[^\\\\p{{L}}\\\\p{{N}}]+', ' '))"
    each = "transform(slice(_w, 1, size(_w) - 4), (_x, _i) -> xxhash64(_x, _w[_i + 1], _w[_i + 2], _w[_i + 3], _w[_i + 4]))"
    cases = f"case when size(_w) >= 5 then {each} when _w[0] = '' then cast(array() as array<bigint>) else array(xxhash64(concat_ws(' ', _w))) end"
    return let(f"split({normal}, ' ')", "_w", cases)


def minhashes(hashes: str) -> str:
    return f"transform(sequence(1, {BANDS}), _b -> array_min(transform({hashes}, _h -> xxhash64(_h, _b))))"


def template_table(spark: SparkSession, templates: dict[str, str] | DataFrame) -> DataFrame:
    """``name``, its distinct shingles and their MinHashes; as many rows as templates."""
    if isinstance(templates, dict):
        rows = ", ".join(f"struct({literal(name)} as name, {literal(text)} as text)" for name, text in sorted(templates.items()))
        templates = spark.range(1).selectExpr(f"inline(array({rows}))")
    shingled = templates.selectExpr("name", f"array_distinct({shingles("coalesce(text, '')")}) as wanted").where("size(wanted) > 0")
    return stored(shingled.selectExpr("name", "wanted", f"{minhashes('wanted')} as bands"))


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def scan(docs: DataFrame, templates: dict[str, str] | DataFrame = TEMPLATES) -> DataFrame:
    """``doc_id``, ``n_licenses`` and ``licenses``, the sorted names joined by commas, for every row."""
    table = template_table(docs.sparkSession, templates)
    size, longest = table.agg(F.coalesce(F.sum(F.size("wanted")), F.lit(0)), F.coalesce(F.max(F.expr("(3 * size(wanted) + 1) div 2")), F.lit(1))).first()

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if size <= BROADCAST else df

    # A row is named by its id and text; rows with both equal are one.
    name = "concat(coalesce(cast(doc_id as string), ''), ':', xxhash64(text)) as row"
    every = docs.where("text <> ''").selectExpr("doc_id", name, f"posexplode({shingles('text')}) as (at, hash)")
    hits = stored(every.join(small(table.selectExpr("name", "explode(wanted) as hash")), "hash").select("doc_id", "row", "name", "at", "hash"))
    stretches = hits.selectExpr("row", "name", "hash", f"explode(array(at div {longest}, at div {longest} - 1)) as stretch")
    held = stretches.groupBy("row", "name", "stretch").agg(F.collect_set("hash").alias("held"))
    values = held.selectExpr("row", f"posexplode({minhashes('held')}) as (band, value)")
    bands = table.selectExpr("name", "posexplode(bands) as (band, value)")
    retrieved = values.join(small(bands), ["band", "value"]).select("row", "name").distinct()

    # Each hit is a shingle more for windows from after its last occurrence, or from where they reach it, to itself.
    own = hits.join(retrieved, ["row", "name"]).distinct()
    last = F.lag("at").over(Window.partitionBy("row", "name", "hash").orderBy("at"))
    since = own.withColumn("since", F.greatest(F.coalesce(last, F.lit(-longest)) + 1, F.col("at") - longest + 1))
    changes = since.selectExpr("doc_id", "row", "name", "inline(array(struct(since as place, 1 as change), struct(at + 1 as place, -1 as change)))")
    summed = changes.groupBy("doc_id", "row", "name", "place").agg(F.sum("change").alias("change"))
    count = F.sum("change").over(Window.partitionBy("doc_id", "row", "name").orderBy("place"))
    most = summed.withColumn("count", count).groupBy("doc_id", "row", "name").agg(F.max("count").alias("count"))
    enough = most.join(small(table.selectExpr("name", "size(wanted) as size")), "name").where(f"count >= {CONTAINMENT} * size")
    named = enough.groupBy("doc_id").agg(F.array_sort(F.collect_set("name")).alias("names"))
    both = docs.select("doc_id").alias("d").join(named.alias("f"), F.expr("d.doc_id <=> f.doc_id"), "left")
    return both.selectExpr("d.doc_id as doc_id", "cast(coalesce(size(names), 0) as bigint) as n_licenses", "coalesce(array_join(names, ','), '') as licenses")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
