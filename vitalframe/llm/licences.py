"""Licence scan by sparse TF-IDF cosine to templates and by directory, in DataFrame functions only.

Three kinds of units are compared with templates, as term vectors weighted by document frequency over
the whole corpus: lines and sentences that may state a licence, sentences that run over several lines of
a paragraph, and whole texts (with damped term counts) against the texts of licences. A whole text close
to a licence's text, or one that mostly consists of licence sentences, is a licence file; otherwise the
best sentence above a threshold is a file's own licence, where a reserved right yields to any licence
given. A file without a licence of its own inherits from the nearest ancestor directory that holds a
licence file, found by joining the ancestors of every directory with the directories of licence files.

Results for odd input: null and empty texts state nothing and only inherit; a null path has no
directory and does not inherit; ties go to the licence that comes first by name; repeated rows are
judged each; an empty table gives no rows; extra columns play no part.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalframe.llm.common import spread_join, written

THRESHOLD = 0.7
# A file is a licence file when licence sentences hold at least this share of its words.
FILE_SHARE = 0.5
# Or when its whole text is this close to a licence's text; long licences are given by their openings.
# A version that has no template is either below this or read as the nearest version.
FILE_THRESHOLD = 0.5
TERM_BREAK = r"[^a-z0-9.+]+|\.(?![0-9])"
SENTENCE_BREAK = r"\n|(?<=[.;!?])[ \t]+"
# A line feed inside a paragraph, with the comment marks that open the next line; it is kept as one mark.
FOLD, FOLDED = r"[ \t]*\n(?![ \t#*/;%-]*(\n|$))[ \t#*/;%-]*", "\x01"
PARAGRAPH_BREAK = r"\n|(?<=[.;!?])[ \t\x01]+"
LINE, PARAGRAPH, WHOLE = 0, 1, 2
RESERVED = "Proprietary"

# What a sentence must contain to be looked at, and opening sentences of public licences.
ANCHORS = ["licen", "copyright", "all rights reserved", "permission is hereby", "redistribution and use", "free software", "creative commons", "cc by", "cc-by", "cc0", "public domain", "spdx"]
TEMPLATES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and dedicated this work to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "Copyright. All rights reserved."),
]


# Texts of short licences, and titles and openings of long ones.
FILE_TEMPLATES = [
    ("MIT", """The MIT License (MIT). Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
    documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
    publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
    following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
    THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
    FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
    LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
    IN THE SOFTWARE."""),
    ("BSD-3-Clause", """Copyright. All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted provided
    that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
    disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
    documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be
    used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT
    HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
    FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
    SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS;
    OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
    OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("ISC", """ISC License. Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
    the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
    REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
    INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
    OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Apache-2.0", """Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION
    1. Definitions. "License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.
    "Licensor" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License. "Legal Entity" shall mean the union of
    the acting entity and all other entities that control, are controlled by, or are under common control with that entity. "You" (or "Your") shall mean an
    individual or Legal Entity exercising permissions granted by this License. "Source" form shall mean the preferred form for making modifications, including
    but not limited to software source code, documentation source, and configuration files. "Object" form shall mean any form resulting from mechanical
    transformation or translation of a Source form, including but not limited to compiled object code, generated documentation, and conversions to other media
    types. "Work" shall mean the work of authorship made available under the License. "Derivative Works" shall mean any work that is based on (or derived
    from) the Work. "Contribution" shall mean any work of authorship intentionally submitted to Licensor for inclusion in the Work. "Contributor" shall mean
    Licensor and any individual or Legal Entity on behalf of whom a Contribution has been received by Licensor. 2. Grant of Copyright License. Each Contributor
    hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works
    of, publicly display, publicly perform, sublicense, and distribute the Work. 3. Grant of Patent License. 4. Redistribution. You must retain all copyright,
    patent, trademark, and attribution notices; NOTICE text file. 5. Submission of Contributions. 6. Trademarks. 7. Disclaimer of Warranty. 8. Limitation of
    Liability. 9. Accepting Warranty or Additional Liability."""),
    ("GPL-3.0", """GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007. Copyright Free Software Foundation, Inc. Everyone is permitted to copy and distribute
    verbatim copies of this license document, but changing it is not allowed. Preamble. The GNU General Public License is a free, copyleft license for software
    and other kinds of works. 0. Definitions. "This License" refers to version 3 of the GNU General Public License. "The Program" refers to any copyrightable
    work licensed under this License. To "modify" a work means to copy from or adapt all or part of the work. A "covered work" means either the unmodified
    Program or a work based on the Program. To "propagate" a work; to "convey" a work means any kind of propagation that enables other parties to make or
    receive copies. Appropriate Legal Notices. 1. Source Code. Corresponding Source, System Libraries, Major Component, Standard Interface. 2. Basic
    Permissions. 3. Protecting Users' Legal Rights From Anti-Circumvention Law. 4. Conveying Verbatim Copies. 5. Conveying Modified Source Versions. 6. Conveying
    Non-Source Forms. User Product, Installation Information. 7. Additional Terms. 8. Termination. 9. Acceptance Not Required for Having Copies. 10. Automatic
    Licensing of Downstream Recipients. 11. Patents; contributor version, essential patent claims. 12. No Surrender of Others' Freedom. 13. Use with the GNU
    Affero General Public License. 14. Revised Versions. 15. Disclaimer of Warranty. 16. Limitation of Liability. You may make, run and propagate covered works
    that you do not convey, without conditions so long as your license otherwise remains in force. You may convey verbatim copies of the Program's source code
    as you receive it, in any medium, provided that you conspicuously and appropriately publish on each copy an appropriate copyright notice; keep intact all
    notices stating that this License and any non-permissive terms added in accord with section 7 apply to the code; and give all recipients a copy of this
    License along with the Program. You must license the entire work, as a whole, under this License to anyone who comes into possession of a copy. A compilation
    of a covered work with other separate and independent works, which are not by their nature extensions of the covered work, is called an aggregate. If you
    cease all violation of this License, then your license from a particular copyright holder is reinstated provisionally. An entity transaction is a transaction
    transferring control of an organization. If conditions are imposed on you (whether by court order, agreement or otherwise) that contradict the conditions of
    this License, they do not excuse you from the conditions of this License."""),
    ("GPL-2.0", """GNU GENERAL PUBLIC LICENSE Version 2, June 1991. Copyright Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim
    copies of this license document, but changing it is not allowed. Preamble. The licenses for most software are designed to take away your freedom to share
    and change it. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change free software. TERMS AND CONDITIONS FOR
    COPYING, DISTRIBUTION AND MODIFICATION. 0. This License applies to any program or other work which contains a notice placed by the copyright holder saying
    it may be distributed under the terms of this General Public License. The "Program" refers to any such program or work, and a "work based on the Program"
    means either the Program or any derivative work under copyright law. You may copy and distribute verbatim copies of the Program's source code as you receive
    it. You must cause the modified files to carry prominent notices. Accompany it with the complete corresponding machine-readable source code, or a written
    offer, valid for at least three years. You are not required to accept this License, since you have not signed it. However, nothing else grants you permission
    to modify or distribute the Program or its derivative works. Each time you redistribute the Program, the recipient automatically receives a license from the
    original licensor to copy, distribute or modify the Program subject to these terms and conditions. If, as a consequence of a court judgment or allegation of
    patent infringement or for any other reason, conditions are imposed on you that contradict the conditions of this License, they do not excuse you. NO WARRANTY.
    BECAUSE THE PROGRAM IS LICENSED FREE OF CHARGE, THERE IS NO WARRANTY FOR THE PROGRAM, TO THE EXTENT PERMITTED BY APPLICABLE LAW."""),
    ("LGPL-3.0", """GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007. This version of the GNU Lesser General Public License incorporates the terms and
    conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below. "The Library" refers to a covered work
    governed by this License, other than an Application or a Combined Work. An "Application" is any work that makes use of an interface provided by the Library.
    A "Combined Work" is a work produced by combining or linking an Application with the Library; "Linked Version". "Minimal Corresponding Source". Exception to
    Section 3 of the GNU GPL. Conveying Modified Versions. Object Code Incorporating Material from Library Header Files. Combined Libraries."""),
    ("MPL-2.0", """Mozilla Public License Version 2.0. 1. Definitions. "Contributor" means each individual or legal entity that creates, contributes to the creation
    of, or owns Covered Software. "Contributor Version", "Contribution", "Covered Software" means Source Code Form to which the initial Contributor has attached
    the notice in Exhibit A, the Executable Form of such Source Code Form, and Modifications. "Incompatible With Secondary Licenses". "Larger Work" means a work
    that combines Covered Software with other material. "Licensable". "Patent Claims". "Secondary License" means the GNU General Public License, the GNU Lesser
    General Public License, the GNU Affero General Public License. 2. License Grants and Conditions. 3. Responsibilities. 4. Inability to Comply Due to Statute
    or Regulation. 5. Termination. 6. Disclaimer of Warranty. 7. Limitation of Liability. 8. Litigation. 9. Miscellaneous. 10. Versions of the License. Each
    Contributor hereby grants You a world-wide, royalty-free, non-exclusive license under intellectual property rights (other than patent or trademark) Licensable
    by such Contributor to use, reproduce, make available, modify, display, perform, distribute, and otherwise exploit its Contributions. All distribution of
    Covered Software in Source Code Form, including any Modifications that You create or to which You contribute, must be under the terms of this License. You
    must inform recipients that the Source Code Form of the Covered Software is governed by the terms of this License, and how they can obtain a copy."""),
]


def _template_terms() -> list[tuple[int, str, bool, str, int]]:
    """(template, licence, whether of a whole text, term, count) of the fixed texts."""
    rows = []
    for n, (licence, text) in enumerate(TEMPLATES + FILE_TEMPLATES):
        terms = [t for t in re.split(TERM_BREAK, text.lower()) if t]
        rows += [(n, licence, n >= len(TEMPLATES), t, terms.count(t)) for t in sorted(set(terms))]
    return rows


def _terms(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), TERM_BREAK), "")


def _directory(path: Column) -> Column:
    """Path up to its last slash; empty at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def _ancestors(directory: Column) -> Column:
    """The directory itself and all above it, the top last, as (depth, name)."""
    parts = F.when(directory == "", F.array().cast("array<string>")).otherwise(F.split(directory, "/"))
    levels = F.sequence(F.lit(0), F.size(parts))
    return F.transform(levels, lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("name")))


def _units(kind: int, texts: Column) -> Column:
    return F.transform(texts, lambda t: F.struct(F.lit(kind).alias("kind"), _terms(t).alias("terms")))


def _prepared(files: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Per file: words, units that may state a licence (as terms), and the template terms it holds."""
    text = F.coalesce(F.col("text"), F.lit(""))
    small = F.lower(text)
    may = lambda col: reduce(Column.__or__, [col.contains(a) for a in ANCHORS])
    folded = F.split(F.regexp_replace(small, FOLD, FOLDED), PARAGRAPH_BREAK)
    units = F.concat(
        _units(LINE, F.filter(F.split(small, SENTENCE_BREAK), may)),
        _units(PARAGRAPH, F.filter(folded, lambda t: t.contains(FOLDED) & may(t))),
        _units(WHOLE, F.array(small)),
    )
    return files.select(
        "id", "path", _directory(F.col("path")).alias("directory"), _terms(text).alias("all_terms"), F.when(may(small), units).alias("units"),
    ).select(
        F.monotonically_increasing_id().alias("row"), "id", "path", "directory",
        F.size("all_terms").alias("n_terms"),
        F.array_intersect("all_terms", F.array(*map(F.lit, vocabulary))).alias("present"),
        "units",
    )


def own_licences(prepared: DataFrame, spark: SparkSession) -> DataFrame:
    """row, licence, score and whether the file is a licence file."""
    terms = _template_terms()
    # one row per template term: a fixed number, far below any broadcast limit
    names = ("template", "licence", "of_whole", "term", "tf")
    row = lambda values: F.struct(*(F.lit(v).alias(n) for n, v in zip(names, values)))
    fixed = written(spark.range(1).coalesce(1).select(F.inline(F.array(*map(row, terms)))), "templates")
    n_files = prepared.count()
    frequency = prepared.select(F.explode("present").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    rarest = F.log(F.lit(1.0 + n_files)) + 1
    idf = written(
        fixed.select("term").distinct().join(frequency, "term", "left")
        .select("term", (F.log(F.lit(1.0 + n_files) / (1 + F.coalesce("df", F.lit(0)))) + 1).alias("idf")).coalesce(1), "term-weights",
    )
    # counts of long texts are damped, or the commonest words would decide
    weight = lambda whole: F.when(whole, 1 + F.log("tf")).otherwise(F.col("tf"))
    weighted = fixed.join(F.broadcast(idf), "term").withColumn("w", weight(F.col("of_whole")) * F.col("idf"))
    norms = weighted.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    templates = weighted.join(norms, "template").select("template", "licence", "of_whole", "term", (F.col("w") / F.col("norm")).alias("tw"))

    unit = ["row", "n_terms", "unit", "kind", "length"]
    units = prepared.where(F.size("units") > 0).select("row", "n_terms", F.posexplode("units").alias("unit", "u")).select("row", "n_terms", "unit", "u.*")
    counted = units.select(*unit[:-1], F.size("terms").alias("length"), F.explode("terms").alias("term")).groupBy(*unit, "term").agg(F.count("*").alias("tf"))
    whole = F.col("kind") == WHOLE
    counted = counted.join(F.broadcast(idf), "term", "left").withColumn("w", weight(whole) * F.coalesce("idf", rarest))
    vectors = counted.groupBy(*unit).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.collect_list(F.when(F.col("idf").isNotNull(), F.struct("term", "w"))).alias("vector"))
    products = (
        vectors.select(*unit, "norm", whole.alias("of_whole"), F.inline("vector")).join(F.broadcast(templates), ["term", "of_whole"])
        .groupBy(*unit, "norm", "template", "licence").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
        .withColumn("score", F.round(F.col("dot") / F.col("norm"), 9))
        .where(F.col("score") >= F.when(whole, FILE_THRESHOLD).otherwise(THRESHOLD))
    )
    order = F.struct((~whole).alias("later"), (F.col("licence") == RESERVED).alias("reserved"), (-F.col("score")).alias("minus"), "licence")
    per_unit = products.groupBy(*unit).agg(F.min(order).alias("best"))
    stated = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("length"))), F.lit(0))
    share = F.greatest(stated(LINE), stated(PARAGRAPH)) >= FILE_SHARE * F.col("n_terms")
    return per_unit.groupBy("row", "n_terms").agg(F.min("best").alias("best"), (share | F.max(whole)).alias("is_licence_file")).select(
        "row", F.col("best.licence").alias("own"), (-F.col("best.minus")).alias("score"), "is_licence_file"
    )


def inherited(files: DataFrame) -> DataFrame:
    """directory and licence: for every directory, that of the nearest directory upwards with a licence file."""
    votes = files.where("is_licence_file").where(F.col("directory").isNotNull()).groupBy("directory", "own").agg(F.count("*").alias("n"))
    stated = votes.groupBy("directory").agg(F.min_by("own", F.struct(-F.col("n"), F.col("own"))).alias("licence")).withColumnRenamed("directory", "name")
    directories = files.where(F.col("directory").isNotNull()).select("directory").distinct()
    upwards = directories.select("directory", F.inline(_ancestors(F.col("directory"))))
    return spread_join(upwards, stated, "name").groupBy("directory").agg(F.max_by("licence", "depth").alias("inherited"))


def scan(docs: DataFrame, path: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, path, licence, score (of the file's own statement), origin (own, inherited or none)."""
    spark = docs.sparkSession
    files = docs.select(F.col(id_col).alias("id"), path.alias("path"), F.col(text).alias("text"))
    prepared = written(_prepared(files, sorted({r[3] for r in _template_terms()})), "licence-terms")
    marked = prepared.select("row", "id", "path", "directory").join(own_licences(prepared, spark), "row", "left")
    marked = written(marked.withColumn("is_licence_file", F.coalesce("is_licence_file", F.lit(False))), "own-licences")
    found = spread_join(marked, inherited(marked), "directory", "left")
    origin = F.when(F.col("own").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none")
    return found.select(F.col("id").alias(id_col), "path", F.coalesce("own", "inherited").alias("licence"), "score", origin.alias("origin"))
