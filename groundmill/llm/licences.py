"""License scans: TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest directory."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundmill.llm.common import stored

# Notices, headers and title blocks of common licences, as their publishers word them. A name with "OR"
# is that of words which several licences share.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-2-Clause OR BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("BSD-2-Clause OR BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details"),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0 - see the LICENSE file for details"),
)
#: Words that tell licences of like wording apart: a unit is compared only with templates that hold the same of them.
#: Version numbers with a point, and whole ones after "version" or "v", are such words too.
MARKS = (
    "mit", "apache", "bsd", "isc", "gnu", "gpl", "lgpl", "agpl", "mozilla", "mpl", "eclipse", "boost", "zlib", "artistic", "proprietary",
    "affero", "lesser", "library", "endorse", "cc", "cc0", "by-nc", "by-sa", "by-nd", "by-nc-sa", "by-nc-nd", "nc", "sa", "nd",
    "attribution", "attribution-noncommercial", "attribution-sharealike", "attribution-noderivatives", "attribution-noncommercial-sharealike",
    "attribution-noncommercial-noderivatives", "noncommercial", "non-commercial", "sharealike", "share-alike", "noderivatives", "noderivs",
)
#: A unit whose best templates of two licences are this close names neither.
MARGIN = 0.02
#: A file that names its licence itself.
DECLARED = r"SPDX-License-Identifier:[ \t]*([A-Za-z0-9.+-]+(?:[ \t]+(?:AND|OR|WITH)[ \t]+[A-Za-z0-9.+-]+)*)"
#: What stands between paragraphs: lines without terms.
BREAK = r"\n(?:[^A-Za-z0-9\n]*\n)+"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
#: Terms that a line must share with one template before it is scored; shorter templates need all of theirs.
SHARED = 3
#: Other terms, those on most lines, whose idf is told to every task; the rest are joined. Only the cost depends on it.
USUAL = 1000


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1))


def marks(found: Column) -> Column:
    """The marks among a unit's terms, sorted, as one string."""
    after = F.transform(found, lambda t, i: F.when((i > 0) & t.rlike(r"^[0-9]+$") & F.get(found, i - 1).isin("version", "v"), F.concat(F.lit("version "), t)))
    own = F.filter(found, lambda t: t.isin(*MARKS) | t.rlike(r"^[0-9]{1,2}[.][0-9]{1,2}$"))
    return F.array_join(F.array_sort(F.array_distinct(F.concat(own, F.filter(after, lambda t: t.isNotNull())))), " ")


def template_terms(spark: SparkSession, templates=TEMPLATES) -> dict[int, dict[str, int]]:
    """Terms of each template with their counts; templates are a short fixed list, so this stays on the driver."""
    rows = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(templates)], "template int, text string")
    counts: dict[int, dict[str, int]] = {}
    for r in rows.select("template", F.explode(terms(F.col("text"))).alias("term")).groupBy("template", "term").count().collect():
        counts.setdefault(r["template"], {})[r["term"]] = r["count"]
    return counts


def line_terms(files: DataFrame) -> DataFrame:
    """``(path, body, paragraphs, lines)``: a hash of the text, and the terms of each line, by paragraph and in one row; texts are cut once, as no term crosses a line's end."""
    paragraphs = F.transform(F.split(F.coalesce("text", F.lit("")), BREAK), lambda p: F.transform(F.split(p, "\n"), terms))
    return files.select("path", F.xxhash64("text").alias("body"), paragraphs.alias("paragraphs")).select("path", "body", "paragraphs", F.flatten("paragraphs").alias("lines"))


def squared(found: Column, weights: dict[str, float]) -> Column:
    """Sum of the squares of the weights of an array's terms; the others weigh nothing."""
    table = F.create_map(*(F.lit(x) for t, w in sorted(weights.items()) for x in (t, w * w)))
    return F.aggregate(found, F.lit(0.0), lambda acc, t: acc + F.coalesce(F.try_element_at(table, t), F.lit(0.0)))


def telling_terms(counts: dict[int, dict[str, int]], idf: dict[str, float], least: float) -> list[str]:
    """Terms of which a unit must hold one to reach ``least``: without a template's heaviest ones its other terms carry too little."""
    found = set()
    for terms_of in counts.values():
        shares = sorted((n * idf[t]) ** 2 for t, n in terms_of.items())
        weak = 0.0
        for t in sorted(terms_of, key=lambda t: terms_of[t] * idf[t]):
            weak += (terms_of[t] * idf[t]) ** 2
            if weak >= least * least * sum(shares) - 1e-6:
                found.add(t)
    return sorted(found)


def candidate_units(split: DataFrame, counts: dict[int, dict[str, int]], idf: dict[str, float], usual: list[str], floor: float, least: float) -> DataFrame:
    """``(path, unit, terms, marks)``: lines, paragraphs and whole files, numbered within their text, that can reach cosine ``least`` with some template.

    By Cauchy-Schwarz a cosine is at most the share of the template's length that lies on common terms, and at most
    the share of the unit's length that lies on the templates' terms. Each other distinct term adds ``floor`` squared
    or more, the square of the least idf of all terms beside ``usual``; those of ``usual`` may add nothing. Both
    bounds are taken inside the row, so texts that no template resembles are never exploded by term.
    """
    longer = F.transform(F.filter("paragraphs", lambda p: F.size(p) > 1), F.flatten)
    whole = F.when(F.size("paragraphs") > 1, F.array(F.flatten("lines"))).otherwise(F.array().cast("array<array<string>>"))
    told = telling_terms(counts, idf, least)
    rows = split.select("path", "body", F.posexplode(F.concat("lines", longer, whole)).alias("unit", "terms")).where(F.exists("terms", lambda t: t.isin(told)))
    rows = rows.withColumn("known", F.filter("terms", lambda t: t.isin(sorted(idf))))
    rows = rows.withColumn("shared", F.array_distinct("known")).where(F.size("shared") >= min(SHARED, *(len(t) for t in counts.values())))
    near = F.lit(False)
    for terms_of in counts.values():
        weights = {t: n * idf[t] for t, n in terms_of.items()}
        need = least * least * sum(w * w for w in weights.values())
        near = near | (squared(F.col("shared"), weights) >= F.lit(need - 1e-6))
    inside = F.aggregate("shared", F.lit(0.0), lambda acc, t: acc + F.pow(F.size(F.filter("known", lambda x: x == t)) * F.try_element_at(F.create_map(*(F.lit(x) for k in sorted(idf) for x in (k, idf[k]))), t), F.lit(2.0)))
    others = F.size(F.array_distinct(F.filter("terms", lambda t: ~t.isin(sorted({*idf, *usual})))))
    full = inside * (1 - least * least) >= others * F.lit(least * least * floor * floor) - 1e-6
    return rows.where(F.when(near, full).otherwise(False)).select("path", F.xxhash64("body", "unit").alias("unit"), "terms", marks(F.col("terms")).alias("marks"))


def line_counts(split: DataFrame) -> DataFrame:
    """``(term, count)``: the lines that each term of the corpus stands on; the empty term stands on every line."""
    line = F.array_append(F.array_distinct("line"), F.lit(""))
    return split.select(F.explode("lines").alias("line")).select(F.explode(line).alias("term")).groupBy("term").count()


def find_licences(files: DataFrame, templates=TEMPLATES, least: float = 0.75) -> DataFrame:
    """``(path, licence, similarity)``: the best template of each file that has one at cosine ``least`` or more.

    A term weighs count * idf; idf = ln((1 + lines) / (1 + lines with the term)) over all lines of all files, for
    every term of the corpus; the table of counts stays distributed. Lines, paragraphs (lines up to one without
    terms) and files as a whole that share at least SHARED terms with a template are scored, with the templates that
    hold the same MARKS: names, versions and clauses that tell licences of like wording apart. A unit whose two best
    licences lie within MARGIN names neither; of a file's units the best counts, ties go to the first template. A name
    with OR, of words that licences share, gives way to one of its own licences found elsewhere in the file.
    An SPDX line names a file's licence, or an expression of several, by itself: similarity 1.

    Null and empty texts have no licence; rows without path are left out; the texts of a repeated path are one file's.
    """
    spark = files.sparkSession
    counts = template_terms(spark, templates)
    known = sorted({t for of in counts.values() for t in of})
    split = line_terms(files.where("path IS NOT NULL").select("path", "text"))
    seen = stored(line_counts(split))
    # What comes back: one row per term of a template, one for all lines, and the USUAL other terms on most lines.
    told = {r["term"]: r["count"] for r in seen.where(F.col("term").isin([*known, ""])).collect()}
    top = seen.where(~F.col("term").isin([*known, ""])).orderBy(F.desc("count"), "term").limit(USUAL + 1).collect()
    lines = math.log(1.0 + told.get("", 0))
    idf = {t: lines - math.log(1.0 + told.get(t, 0)) for t in known}
    usual = {r["term"]: lines - math.log(1.0 + r["count"]) for r in top[:USUAL]}
    floor = lines - math.log(1.0 + top[-1]["count"]) if len(top) > USUAL else lines
    weights = [(i, templates[i][0], t, n * idf[t], math.sqrt(sum((m * idf[u]) ** 2 for u, m in of.items())), len(of)) for i, of in counts.items() for t, n in of.items()]
    vectors = spark.createDataFrame(weights, "template int, licence string, term string, w double, norm double, distinct_terms int")
    own_marks = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(templates)], "template int, text string").select("template", marks(terms(F.col("text"))).alias("marks"))
    vectors = vectors.join(F.broadcast(own_marks), "template")  # as many rows as templates
    likely = stored(candidate_units(split, counts, idf, list(usual), floor, least))
    counted = stored(likely.select("path", "unit", "marks", F.explode("terms").alias("term")).groupBy("path", "unit", "marks", "term").agg(F.count("*").alias("tf")))
    # Terms on very many lines take their idf from a broadcast table of fixed size, so that none makes a hot task.
    often = F.broadcast(spark.createDataFrame(sorted({**idf, **usual}.items()), "term string, idf double"))
    common = counted.join(often, "term")
    seldom = counted.join(often, "term", "left_anti").join(seen.hint("merge"), "term").withColumn("idf", F.lit(lines) - F.log(1.0 + F.col("count"))).drop("count")
    scaled = lambda rows: rows.withColumn("x", F.col("tf") * F.col("idf"))
    length = scaled(common.unionByName(seldom)).groupBy("path", "unit").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    dots = scaled(common).join(F.broadcast(vectors), ["term", "marks"]).groupBy("path", "unit", "template", "licence", "norm", "distinct_terms").agg(F.sum(F.col("x") * F.col("w")).alias("dot"), F.count("*").alias("common"))
    scored = dots.where(F.col("common") >= F.least(F.lit(SHARED), "distinct_terms")).join(length, ["path", "unit"]).withColumn("similarity", F.round(F.try_divide("dot", F.col("norm") * F.col("length")), 9))
    first = F.max(F.struct("similarity", (-F.col("template")).alias("first"), "licence"))
    by_licence = scored.where(F.col("similarity") >= least).groupBy("path", "unit", "licence").agg(first.alias("best"))
    ranked = by_licence.groupBy("path", "unit").agg(F.reverse(F.array_sort(F.collect_list("best"))).alias("best"))  # one for each licence at most
    clear = ranked.where((F.size("best") == 1) | (F.col("best")[0]["similarity"] - F.get("best", F.lit(1))["similarity"] >= MARGIN)).select("path", F.col("best")[0].alias("best"))
    each = clear.groupBy("path", "best.licence").agg(F.max("best").alias("best")).groupBy("path").agg(F.reverse(F.array_sort(F.collect_list("best"))).alias("best"))
    shared = F.split(F.col("best")[0]["licence"], " OR ")
    chosen = each.select("path", F.coalesce(F.get(F.filter("best", lambda b: (F.size(shared) > 1) & F.array_contains(shared, b["licence"])), F.lit(0)), F.col("best")[0]).alias("best"))
    declared = files.where("path IS NOT NULL").select("path", F.regexp_extract("text", DECLARED, 1).alias("licence")).where("licence <> ''").groupBy("path").agg(F.min("licence").alias("declared"))
    both = chosen.join(declared, "path", "full")
    return stored(both.select("path", F.coalesce("declared", "best.licence").alias("licence"), F.when(F.col("declared").isNotNull(), 1.0).otherwise(F.col("best.similarity")).alias("similarity")))


def directory(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit(""))


def inherit_licences(files: DataFrame, found: DataFrame, names: str = r"(?i)^(licen[cs]e|copying)(\.\w+)?$") -> DataFrame:
    """``(path, licence, similarity, origin)`` for every path of ``files``.

    A file's own licence wins and ``origin`` is its path; else that of a licence file (by name) in its directory or
    the nearest one above, and ``origin`` is that directory; else null. Of several licence files of a directory the most similar counts, then
    the first path. Directories, not files, look upwards, so the joins see each directory once per level.
    """
    paths = files.where("path IS NOT NULL").select("path").distinct()
    base = F.regexp_extract("path", "([^/]*)$", 1)
    pick = F.min_by("licence", F.struct(-F.col("similarity"), "path")).alias("dir_licence")
    granted = found.where(base.rlike(names)).select(directory(F.col("path")).alias("dir"), "licence", "similarity", "path").groupBy("dir").agg(pick)
    dirs = paths.select(directory(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    above = dirs.select("dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")).select("dir", "depth", F.array_join(F.slice(parts, 1, F.col("depth")), "/").alias("up"))
    nearest = above.join(granted.withColumnRenamed("dir", "up"), "up").groupBy("dir").agg(F.max(F.struct("depth", "up", "dir_licence")).alias("near"))
    own = paths.join(found, "path", "left").withColumn("dir", directory(F.col("path")))
    return own.join(nearest, "dir", "left").select(
        "path", F.coalesce("licence", F.col("near.dir_licence")).alias("licence"), "similarity",
        F.when(F.col("licence").isNotNull(), F.col("path")).otherwise(F.col("near.up")).alias("origin"),
    )


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source / language / hundred of ids; each tenth document is its folder's licence file.

    A row without doc_id has no path and no result.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.floor(F.col("doc_id") / 100).cast("string"))
    name = F.concat(F.when(F.col("doc_id") % 10 == 0, F.lit("LICENSE.")).otherwise(F.lit("doc.")), F.col("doc_id").cast("string"))
    files = docs.select(F.concat(folder, F.lit("/"), name).alias("path"), "text")
    scanned = inherit_licences(files, find_licences(files))
    return scanned.select(F.regexp_extract("path", r"(\d+)$", 1).cast("long").alias("doc_id"), "licence", "similarity", "origin")
