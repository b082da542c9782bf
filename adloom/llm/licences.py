"""Licences of files: notices by TF-IDF cosine, directories by inheritance. Native only.

A notice is a line of a file, a wrapped notice of up to WINDOW adjoining lines, or the
whole text of a licence file. Its words are compared with each template as sparse TF-IDF
vectors; words that no template has count in its length with the largest weight, comment
marks are no words. A notice can reach the threshold only with at least one of a
template's weightier words (by Cauchy-Schwarz the others together stay below it): only
lines with one are taken apart, a wrapped notice begins and ends with one, and each
distinct notice is scored once.

An SPDX identifier names its licence itself, with similarity 1.

A file without a notice of its own takes the licence of the nearest directory above
it that has one, where a directory's is that of the licence file in it.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.operators.joins import fits_broadcast, lookup_join
from adloom.storage import materialize

THRESHOLD = 0.6
# Adjoining lines that are read together.
WINDOW = 8
# Usual notices, file headers, titles and texts of licences: fixed values.
TEMPLATES = {
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "Apache-2.0-text": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "Apache-2.0-title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "BSD-3-Clause-clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-3-Clause-header": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-2.0-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0-text": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    "GPL-3.0-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "ISC-header": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-2.1-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0-header": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-3.0-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "MIT": "Released under the MIT License.",
    "MIT-header": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, v. 2.0.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "MPL-2.0-title": "Mozilla Public License Version 2.0",
    "Proprietary": "All rights reserved.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
# Function words take no part in the vectors.
COMMON = (
    "a all an and any are as at be but by do for from has have if in is it its may no not of on or so such that the this to was with you your"
).split()
_WORD = "[a-z0-9]+(?:\\.[0-9]+)?"
_KIND = "-(text|header|title|clause)$"
# An identifier as it is declared, and what says how later versions count.
_DECLARED, _VERSIONS = r"(?i)SPDX-License-Identifier:[ \t(]*([A-Za-z0-9][A-Za-z0-9.+-]*)", r"(?i)(-or-later|-only|\+)$"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense)(\.[a-z]+|-[0-9]+)?$"


def _template_words() -> dict[str, dict[str, int]]:
    found: dict[str, dict[str, int]] = {}
    for name, text in TEMPLATES.items():
        counts = found.setdefault(name, {})
        for word in re.findall(_WORD, text.lower()):
            if word not in COMMON:
                counts[word] = counts.get(word, 0) + 1
    return found


def _model() -> tuple[list[tuple[str, str, float]], dict[str, float], float, list[str]]:
    """(template, word, weight of unit length), idf, idf of other words, weightier words."""
    words = _template_words()
    n = len(words)
    df: dict[str, int] = {}
    for counts in words.values():
        for word in counts:
            df[word] = df.get(word, 0) + 1
    idf = {word: math.log((1 + n) / (1 + k)) + 1 for word, k in df.items()}
    rows, needed = [], set()
    for name, counts in words.items():
        length = math.sqrt(sum((tf * idf[w]) ** 2 for w, tf in counts.items()))
        weights = sorted(((tf * idf[w] / length, w) for w, tf in counts.items()))
        rows += [(name, w, weight) for weight, w in weights]
        held = 0.0
        for weight, word in weights:
            # Words that together stay below the threshold need not be looked for.
            if held + weight**2 < THRESHOLD**2 - 1e-9:
                held += weight**2
            else:
                needed.add(word)
    return rows, idf, math.log(1 + n) + 1, sorted(needed)


def licence_of(template: Column) -> Column:
    return F.regexp_replace(template, _KIND, "")


def notice_scores(notices: DataFrame, spark: SparkSession) -> DataFrame:
    """(line, licence, similarity) of the distinct notices (line, notice) that reach the
    threshold; of equally similar templates the first by name. Only the digest ``line``
    goes along with each word."""
    rows, idf, other, _ = _model()
    # The templates are a constant of this module: a broadcast of fixed size.
    vectors = spark.createDataFrame([(w, idf[w], t, weight) for t, w, weight in rows], "word string, idf double, template string, unit double")
    vectors = vectors.groupBy("word", "idf").agg(F.collect_list(F.struct("template", "unit")).alias("units"))
    words = notices.select(
        "line", F.explode(F.regexp_extract_all(F.lower("notice"), F.lit(f"({_WORD})"), F.lit(1))).alias("word")
    )
    words = words.where(~F.col("word").isin(COMMON))
    # A whole licence text has many words: counted per task before the shuffle.
    counted = words.groupBy("line", "word").agg(F.count(F.lit(1)).alias("tf"))
    weighed = counted.join(F.broadcast(vectors), "word", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(other)))
    length = weighed.groupBy("line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    parts = weighed.where("units is not null").select("line", "w", F.explode("units").alias("u"))
    dots = parts.groupBy("line", F.col("u.template").alias("template")).agg(F.sum(F.col("w") * F.col("u.unit")).alias("dot"))
    similar = dots.join(length, "line").withColumn("similarity", F.round(F.col("dot") / F.col("length"), 9))
    best = F.min_by(F.struct("template", "similarity"), F.struct(-F.col("similarity"), F.col("template")))
    return (
        similar.where(F.col("similarity") >= THRESHOLD)
        .groupBy("line")
        .agg(best.alias("best"))
        .select("line", licence_of(F.col("best.template")).alias("licence"), F.col("best.similarity").alias("similarity"))
    )


def _needed() -> str:
    """One expression for the weightier words in lower-case text, grouped by their first
    letter."""
    by_letter: dict[str, list[str]] = {}
    for word in _model()[3]:
        by_letter.setdefault(word[0], []).append(re.escape(word[1:]))
    return r"(?:^|[^a-z0-9])(?:" + "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in by_letter.items()) + r")(?:[^a-z0-9]|$)"


def _notices(text: Column, needed: str) -> Column:
    """The lines with a weightier word, and what lies between two of them less than
    WINDOW lines apart."""
    lines = F.split(text, "\n")
    numbered = F.transform(lines, lambda line, i: F.when(F.lower(line).rlike(needed), i + 1))
    marked = F.filter(numbered, lambda i: i.isNotNull())

    def from_line(first: Column, at: Column) -> Column:
        ends = F.filter(F.slice(marked, at + 1, F.lit(WINDOW)), lambda last: last < first + WINDOW)
        return F.transform(ends, lambda last: F.array_join(F.slice(lines, first, last - first + 1), "\n"))

    return F.flatten(F.transform(marked, from_line))


def declared(rows: DataFrame) -> DataFrame:
    """Rows of files for every SPDX identifier: its licence, similarity 1."""
    names = F.regexp_extract_all("text", F.lit(_DECLARED), F.lit(1))
    found = rows.where(F.col("text").rlike(_DECLARED)).withColumn("name", F.explode(F.array_distinct(names)))
    licence = F.regexp_replace(F.regexp_replace("name", r"\.+$", ""), _VERSIONS, "")
    return found.select("doc_id", "path", "_licence_file", licence.alias("licence"), F.lit(1.0).alias("similarity"))


def parent(path: Column) -> Column:
    """The directory of a path; '' is the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(files: DataFrame) -> DataFrame:
    """Per row of ``files`` (doc_id, path, text): doc_id, path, licence, similarity,
    origin ('notice', 'inherited' or null) and licence_dir, the directory inherited from.

    The best notice of a file counts, of equally similar ones the first licence by name.
    An identifier "X-or-later", "X-only" or "X+" is the licence X; each identifier counts.
    A directory with several licence files takes the most similar notice, then the first
    licence. Null and empty texts have no notice; a null path has no directory and
    inherits nothing. Rows that repeat are repeated. No rows give no rows; other columns
    are ignored. Lines that very many files share are scored once and joined back as a
    broadcast of checked size or over split keys.
    """
    spark = files.sparkSession
    rows = files.select("doc_id", "path", "text").withColumn("_licence_file", F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False)))
    needed = _needed()
    marked = rows.where(F.lower("text").rlike(needed))
    notices = _notices(F.col("text"), needed)
    notices = F.array_distinct(F.when(F.col("_licence_file"), F.array_append(notices, F.col("text"))).otherwise(notices))
    held = marked.select("doc_id", "path", "_licence_file", F.explode(notices).alias("notice"))
    held = materialize(held.withColumn("line", F.md5(F.col("notice").cast("binary"))), "notices")
    distinct = held.groupBy("line").agg(F.first("notice").alias("notice"))
    scores = materialize(notice_scores(distinct, spark), "notice-scores")
    scored = lookup_join(held.drop("notice"), scores, ["line"], "inner")
    scored = scored.select("doc_id", "path", "_licence_file", "licence", "similarity").union(declared(rows))
    first = F.struct(-F.col("similarity"), F.col("licence"))
    own = scored.groupBy("doc_id", "path", "_licence_file").agg(F.min_by(F.struct("licence", "similarity"), first).alias("best"))
    own = materialize(own.select("doc_id", "path", "_licence_file", "best.licence", "best.similarity"), "own-licences")

    per_dir = (
        own.where("_licence_file")
        .groupBy(parent(F.col("path")).alias("licence_dir"))
        .agg(F.min_by("licence", first).alias("dir_licence"))
    )
    names = rows.select("doc_id", "path", parent(F.col("path")).alias("dir"))
    steps = F.expr("transform(sequence(0, size(split(dir, '/'))), i -> array_join(slice(split(dir, '/'), 1, i), '/'))")
    above = names.select("dir").where("dir is not null").distinct().select("dir", F.explode(F.array_distinct(steps)).alias("licence_dir"))
    # The top directory is above all others: one row of the right side, many of the left.
    nearest = (
        lookup_join(above, materialize(per_dir, "directory-licences"), ["licence_dir"], "inner")
        .groupBy("dir")
        .agg(F.max_by(F.struct("licence_dir", "dir_licence"), F.length("licence_dir")).alias("near"))
        .select("dir", "near.licence_dir", "near.dir_licence")
    )
    named = lookup_join(materialize(names, "file-names"), materialize(nearest, "inherited"), ["dir"], "left", spread_by=["doc_id"])
    own = own.select(F.col("doc_id").alias("_id"), F.col("path").alias("_path"), "licence", "similarity")
    if fits_broadcast(own):
        own = F.broadcast(own)
    joined = named.join(own, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("path").eqNullSafe(F.col("_path")), "left")
    has, inherits = F.col("licence").isNotNull(), F.col("dir_licence").isNotNull()
    return joined.select(
        "doc_id",
        "path",
        F.coalesce("licence", "dir_licence").alias("licence"),
        "similarity",
        F.when(has, "notice").when(inherits, "inherited").alias("origin"),
        F.when(~has & inherits, F.col("licence_dir")).alias("licence_dir"),
    )


# Ids per directory, and which of them are licence files of the directory, of the
# language above it, and of the tree.
PER_DIRECTORY, PER_LANGUAGE, PER_TREE = 10, 50, 200


def laid_out(docs: DataFrame) -> DataFrame:
    """``documents`` has no paths: every source is a tree, every language a directory of
    it, and each PER_DIRECTORY ids a directory below. Ids that the numbers above divide
    are licence files. A row without an id has no path."""
    tree, lang, number = F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.col("doc_id").cast("string")
    folder = F.floor(F.col("doc_id") / PER_DIRECTORY).cast("string")
    licence = F.concat(F.lit("LICENSE-"), number)

    def divides(n: int) -> Column:
        return F.col("doc_id") % n == 0

    path = (
        F.when(divides(PER_TREE), F.concat_ws("/", tree, licence))
        .when(divides(PER_LANGUAGE), F.concat_ws("/", tree, lang, licence))
        .when(divides(PER_DIRECTORY), F.concat_ws("/", tree, lang, folder, licence))
        .when(number.isNotNull(), F.concat_ws("/", tree, lang, folder, F.concat(number, F.lit(".txt"))))
    )
    return docs.select("doc_id", path.alias("path"), "text")


def oracle() -> str:
    """The same in SQL; single lines are scored without the shortcut over weightier words."""
    rows, idf, other, _ = _model()
    vectors = ", ".join(f"('{t}', '{w}', {idf[w]!r}::DOUBLE, {unit!r}::DOUBLE)" for t, w, unit in rows)
    return rf"""
WITH vectors(template, word, idf, unit) AS (VALUES {vectors}),
idfs AS (SELECT DISTINCT word, idf FROM vectors),
named AS (
  SELECT doc_id, text, coalesce(source, 'none') AS s, coalesce(lang, 'none') AS l,
         CAST(CAST(floor(doc_id / {PER_DIRECTORY}) AS BIGINT) AS VARCHAR) AS f FROM documents),
files AS (
  SELECT doc_id, text,
         CASE WHEN doc_id % {PER_TREE} = 0 THEN s || '/LICENSE-' || doc_id
              WHEN doc_id % {PER_LANGUAGE} = 0 THEN s || '/' || l || '/LICENSE-' || doc_id
              WHEN doc_id % {PER_DIRECTORY} = 0 THEN s || '/' || l || '/' || f || '/LICENSE-' || doc_id
              ELSE s || '/' || l || '/' || f || '/' || doc_id || '.txt' END AS path
  FROM named),
numbered AS (
  SELECT doc_id, path, l, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos
  FROM (SELECT doc_id, path, string_split(text, chr(10)) AS l FROM files)),
marked AS (SELECT doc_id, path, l, pos FROM numbered WHERE regexp_matches(lower(line), '{_needed()}')),
units AS (
  SELECT doc_id, path, line AS notice FROM numbered
  UNION SELECT a.doc_id, a.path, array_to_string(a.l[a.pos:b.pos], chr(10))
  FROM marked a JOIN marked b ON a.doc_id = b.doc_id AND a.path = b.path AND b.pos > a.pos AND b.pos < a.pos + {WINDOW}
  UNION SELECT doc_id, path, text FROM files WHERE path LIKE '%/LICENSE-%'),
declared AS (
  SELECT doc_id, path, regexp_replace(regexp_replace(name, '\.+$', ''), '{_VERSIONS}', '') AS licence, 1.0::DOUBLE AS similarity
  FROM (SELECT doc_id, path, unnest(regexp_extract_all(text, '{_DECLARED}', 1)) AS name FROM files)),
words AS (
  SELECT notice, word, count(*) AS tf
  FROM (SELECT notice, unnest(regexp_extract_all(lower(notice), '{_WORD}')) AS word FROM (SELECT DISTINCT notice FROM units))
  WHERE word NOT IN ({", ".join(f"'{w}'" for w in COMMON)}) GROUP BY ALL),
weighed AS (SELECT notice, word, tf * coalesce(idf, {other!r}::DOUBLE) AS w FROM words LEFT JOIN idfs USING (word)),
lengths AS (SELECT notice, sqrt(sum(w * w)) AS length FROM weighed GROUP BY notice),
alike AS (
  SELECT notice, template, round(sum(w * unit) / any_value(length), 9) AS similarity
  FROM weighed JOIN vectors USING (word) JOIN lengths USING (notice) GROUP BY ALL),
best AS (
  SELECT notice, regexp_replace(template, '{_KIND}', '') AS licence, similarity FROM alike WHERE similarity >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY notice ORDER BY similarity DESC, template) = 1),
own AS (
  SELECT * FROM (SELECT doc_id, path, licence, similarity FROM units JOIN best USING (notice) UNION FROM declared)
  QUALIFY row_number() OVER (PARTITION BY doc_id, path ORDER BY similarity DESC, licence) = 1),
placed AS (SELECT doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS dir FROM files),
per_dir AS (
  SELECT dir AS licence_dir, licence AS dir_licence FROM own JOIN placed USING (doc_id, path) WHERE path LIKE '%/LICENSE-%'
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY similarity DESC, licence) = 1),
nearest AS (
  SELECT dir, licence_dir, dir_licence FROM (SELECT DISTINCT dir FROM placed) JOIN per_dir
    ON dir = licence_dir OR starts_with(dir, licence_dir || '/')
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(licence_dir) DESC) = 1)
SELECT p.doc_id, p.path, coalesce(licence, dir_licence) AS licence, similarity,
       CASE WHEN licence IS NOT NULL THEN 'notice' WHEN dir_licence IS NOT NULL THEN 'inherited' END AS origin,
       CASE WHEN licence IS NULL AND dir_licence IS NOT NULL THEN licence_dir END AS licence_dir
FROM placed p LEFT JOIN own o ON p.doc_id = o.doc_id AND p.path = o.path LEFT JOIN nearest n ON p.dir = n.dir"""
