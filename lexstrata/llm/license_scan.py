"""License scans in DataFrame functions only.

Headers are lines that speak of a licence, and runs of comment lines that do, whole and by
paragraphs, so a wrapped header is one statement; in a licence file the whole text is one,
and each such paragraph, since titles and openings tell long licences apart.  Their sparse TF-IDF vectors, with document frequencies over all statements
and templates, are compared by cosine with template texts; the best one at ``accept`` or
more is the file's licence.  A file without one inherits from the nearest ancestor
directory that has one, by joins of directory paths: directories first resolve their
nearest licensed ancestor, then files join their directory, so a large directory is one
row on one side of a join that adaptive execution can split.

Defined cases: null or empty text has no statement; null path has no directory and
inherits nothing; ties go to the licence name first in order; several statements count
by their best; two licence files in a directory likewise; repeated rows are scanned each
on their own; null doc_id is kept; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

# Public licence texts that are short, whole or by their opening paragraph.
_BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
]
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."

# Names and public texts, headers and titles of common licences.
TEMPLATES = [
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", " ".join(_BSD)),
    ("BSD-3-Clause", " ".join([*_BSD[:3], _BSD_NAMES, _BSD[3]])),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT license. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
    ("Proprietary", "All rights reserved. Copyright. Unauthorized copying or distribution is prohibited."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("ISC", _ISC),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", _MIT),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
_CUE = r"(?i)licen[cs]|copyright|all rights reserved|public domain|redistribution and use|permission (?:is hereby granted|to use)"
#: Runs of comment lines, and what makes a line one.
_MARK = r"[ \t]*+(?:#++|//++|/?\*++/?|--++|;++|%++)"
_COMMENTS = rf"(?m)(?:^{_MARK}[^\n]*+\n?+)++"
_FILE = r"(?i)^(?:licen[cs]es?|copying|unlicense|notice)(?:[.\-_].*)?$"


def terms(text: Column) -> Column:
    """Lower-case runs of letters, digits and inner full stops."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*"), F.lit(0))


def _paragraphs(text: Column) -> Column:
    """Parts between blank lines that speak of a licence."""
    return F.filter(F.split(text, r"\n[ \t\r]*\n"), lambda x: x.rlike(_CUE))


def _parents(directory: Column) -> Column:
    """The directory and all above it, with their depths; the root is the empty path."""
    parts = F.filter(F.split(directory, "/"), lambda p: p != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(F.array_join(F.slice(parts, 1, n), "/").alias("at"), n.alias("depth")))


def _weights(units: DataFrame, frequency: DataFrame) -> DataFrame:
    """(unit, term, w): TF-IDF weights scaled to unit length."""
    w = units.groupBy("unit", "term").agg(F.count("*").alias("tf")).join(frequency, "term")
    w = w.select("unit", "term", (F.col("tf") * F.col("idf")).alias("w"))
    length = w.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    return w.join(length, "unit").select("unit", "term", (F.col("w") / F.col("length")).alias("w"))


def scan(files: DataFrame, path: Column, licence_file: Column | None = None, accept: float = 0.6) -> DataFrame:
    """Per file: doc_id, path, licence, score, origin (``own``, ``inherited`` or null), licence_dir.

    ``licence_file``: whether a file speaks for its directory; by default its name decides.
    """
    spark = files.sparkSession
    tmp = Scratch(spark, "licence")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.element_at(F.split(path, "/"), -1)
    speaks = F.coalesce(name.rlike(_FILE) if licence_file is None else licence_file, F.lit(False))
    lines = F.filter(F.split(text, r"\n"), lambda x: x.rlike(_CUE))
    blocks = F.transform(F.regexp_extract_all(text, F.lit(_COMMENTS), F.lit(0)), lambda x: F.regexp_replace(x, rf"(?m)^{_MARK}", ""))
    blocks = F.filter(blocks, lambda x: x.rlike(_CUE))
    headers = F.concat(lines, blocks, F.flatten(F.transform(blocks, _paragraphs)))
    of_file = F.concat(F.array(text), _paragraphs(text))
    found = F.when(~text.rlike(_CUE), F.array().cast("array<string>")).when(name.rlike(_FILE), F.array_distinct(of_file)).otherwise(F.array_distinct(headers))
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    directory = F.when(path.isNotNull(), F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), "/"))
    rows = files.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), path.alias("path"), directory.alias("dir"), speaks.alias("speaks"), found.alias("found"))
    rows = tmp.save(rows, "rows")

    # distinct statements are scored once, however many files hold them
    said = rows.select("row", F.explode("found").alias("statement")).withColumn("unit", F.md5("statement"))
    said = tmp.save(said, "said")
    units = said.groupBy("unit").agg(F.first("statement").alias("s"), F.count("*").alias("n")).select("unit", F.explode(terms(F.col("s"))).alias("term"), "n")
    units = tmp.save(units, "units")
    values = ", ".join("('{}#{}', '{}')".format(n, i, t.replace("'", "''")) for i, (n, t) in enumerate(TEMPLATES))
    template = spark.sql(f"SELECT unit, text FROM VALUES {values} AS t(unit, text)").select("unit", F.explode(terms(F.col("text"))).alias("term"))
    total = said.count() + len(TEMPLATES)
    seen = units.groupBy("unit", "term").agg(F.first("n").alias("n")).select("term", "n").union(template.distinct().select("term", F.lit(1).cast("long").alias("n")))
    frequency = tmp.save(seen.groupBy("term").agg(F.sum("n").alias("df")).select("term", (F.log((total + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf")), "frequency")
    known = _weights(template, frequency).withColumnsRenamed({"unit": "template", "w": "v"})
    close = _weights(units.select("unit", "term"), frequency).join(F.broadcast(known), "term")  # a fixed list of templates
    close = close.groupBy("unit", "template").agg(F.round(F.sum(F.col("w") * F.col("v")), 9).alias("score")).where(F.col("score") >= accept)
    best = lambda: F.min(F.struct((-F.col("score")).alias("by"), F.col("licence"))).alias("b")
    close = close.withColumn("licence", F.element_at(F.split("template", "#"), 1))
    match = tmp.save(close.groupBy("unit").agg(best()).select("unit", "b.licence", (-F.col("b.by")).alias("score")), "match")
    own = tmp.save(said.select("row", "unit").join(match, "unit").groupBy("row").agg(best()).select("row", F.col("b.licence").alias("licence"), (-F.col("b.by")).alias("score")), "own")

    # directories: their own licence, then the nearest ancestor's
    holders = rows.where("speaks and dir is not null").select("row", "dir").join(own, "row").groupBy("dir").agg(best())
    holders = tmp.save(holders.select(F.col("dir").alias("at"), F.col("b.licence").alias("inherited")), "holders")
    up = rows.where("dir is not null").select("dir").distinct().select("dir", F.explode(_parents(F.col("dir"))).alias("p")).select("dir", "p.at", "p.depth")
    near = up.join(holders, "at").groupBy("dir").agg(F.max(F.struct("depth", "at", "inherited")).alias("n"))
    near = tmp.save(near.select("dir", F.col("n.at").alias("licence_dir"), F.col("n.inherited").alias("inherited")), "near")
    out = tmp.save(rows.select("row", "doc_id", "path", "dir").join(own, "row", "left"), "out").join(near, "dir", "left")
    return out.select(
        "doc_id",
        "path",
        F.coalesce("licence", "inherited").alias("licence"),
        "score",
        F.when(F.col("licence").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").alias("origin"),
        F.when(F.col("licence").isNull(), F.col("licence_dir")).alias("licence_dir"),
    )
