"""License scan by sparse TF-IDF cosine, in DataFrame functions alone.

Two kinds of text are weighed by tf * idf and compared with the templates, which are phrases that
name a license and whole license texts:

* headers: a line that names a license, a copyright or a permission, alone and together with
  the lines after it, as long as four of five different words of each line are words of the templates;
* whole texts of files that have a header and of whose different words four of five are such words.

idf counts the headers of the table.  The best template with a cosine of at least ``COSINE`` is
the file's license; its basis is ``text`` if the whole text is nearer than any header, else
``header``.  A file is the license file of its directory if its whole text is near a template, if
the header makes up a fifth of its words, or if it is named like one and has a header.  Files
without a license of their own inherit from the nearest directory above them that has one.

Equal headers are compared once.  A null text or path is an empty one; an empty path is in no
directory.  Of equal cosines the first license in the alphabet wins, of several license files
in a directory the one with the largest cosine, then the smallest path; files of one path share
their license.  Repeated rows are kept.  Other columns of any name go along; columns named like
those of the result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

COSINE = 0.6
FILE_SHARE = 0.2
TEMPLATE_SHARE = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEADER = "licen[cs]e|copyright|spdx|permission|redistribut"
FILE_NAME = "(^|/)(licen[cs]e|copying|notice)[^/]*$"

# Phrases by which licenses are stated, and whole texts of the short ones.
_NO_WARRANTY = (
    'IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, '
    'INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, '
    'PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS '
    'INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT '
    'LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF '
    'THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
)
_BSD = (
    'Redistribution and use in source and binary forms, with or without modification, are '
    'permitted provided that the following conditions are met: 1. Redistributions of source code '
    'must retain the above copyright notice, this list of conditions and the following '
    'disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, '
    'this list of conditions and the following disclaimer in the documentation and/or other '
    'materials provided with the distribution. '
)
_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS '
    'OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF '
    'MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
)
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use "
     "this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
     "modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
     "License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. "
     "2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this '
     'software and associated documentation files (the "Software"), to deal in the Software '
     'without restriction, including without limitation the rights to use, copy, modify, merge, '
     'publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons '
     'to whom the Software is furnished to do so, subject to the following conditions: The above '
     'copyright notice and this permission notice shall be included in all copies or substantial '
     'portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
     'EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS '
     'FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT '
     'HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF '
     'CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE '
     'USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("BSD-2-Clause", _BSD + _AS_IS + _NO_WARRANTY),
    ("BSD-3-Clause", _BSD + '3. Neither the name of the copyright holder nor the names of its '
     'contributors may be used to endorse or promote products derived from this software without '
     'specific prior written permission. ' + _AS_IS + _NO_WARRANTY),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose '
     'with or without fee is hereby granted, provided that the above copyright notice and this '
     'permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR '
     'DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
     'MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, '
     'DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF '
     'USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS '
     'ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not '
     'use this file except in compliance with the License. You may obtain a copy of the License '
     'at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed '
     'to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
     'WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License '
     'for the specific language governing permissions and limitations under the License.'),
    ("GPL-3.0", 'This program is free software: you can redistribute it and/or modify it under '
     'the terms of the GNU General Public License as published by the Free Software Foundation, '
     'either version 3 of the License, or (at your option) any later version. This program is '
     'distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the '
     'implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU '
     'General Public License for more details.'),
]


def _plain(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(_plain(text), F.lit("([a-z0-9]+)"), F.lit(1))


def _terms(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf)"""
    return df.select(key, F.explode(_words(F.col(text))).alias("term")).groupBy(key, "term").agg(
        F.count("*").alias("tf"))


def _share(text: Column, vocabulary: Column) -> Column:
    """The part of a text's different words that the templates have; null without words."""
    words = F.array_distinct(_words(text))
    return F.size(F.array_intersect(words, vocabulary)) / F.nullif(F.size(words), F.lit(0))


def _headers(lines: Column, likely: Column) -> Column:
    """Each header line, and with the likely lines that follow it if there are any."""
    def blocks(line: Column, i: Column) -> Column:
        after = F.slice(likely, i + 2, F.size(likely))
        stop = F.array_position(after, F.lit(False)).cast("int")
        n = F.when(stop == 0, F.size(after)).otherwise(stop - 1)
        whole = F.array_join(F.slice(lines, i + 1, n + 1), " ")
        return F.when(~_plain(line).rlike(HEADER), F.array().cast("array<string>")).when(
            n > 0, F.array(line, whole)).otherwise(F.array(line))

    return F.flatten(F.transform(lines, blocks))


def _best(texts: DataFrame, key: str, text: str, idf: DataFrame, unseen: float, phrases: DataFrame,
          phrase_norms: DataFrame, known: DataFrame) -> DataFrame:
    """(key, cosine, license) of every different text that is near a template."""
    weighed = _terms(texts, key, text).join(idf, "term", "left").withColumn(
        "w", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    weighed = common.materialize(weighed, "weighed")
    norms = weighed.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(F.broadcast(phrases.select("template", "term", "tw")), "term").groupBy(
        key, "template").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    cosines = dots.join(norms, key).join(F.broadcast(phrase_norms), "template").join(
        F.broadcast(known), "template").select(
        key, "license", F.round(F.col("dot") / (F.col("norm") * F.col("tn")), 6).alias("cosine"))
    best = cosines.where(F.col("cosine") >= COSINE).groupBy(key).agg(
        F.max("cosine").alias("cosine"),
        F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("m"))
    return common.materialize(best.select(key, "cosine", F.col("m.license").alias("license")), "best")


def scan(
    files: DataFrame, path_col: str = "path", text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """``files``' other columns with (path, license, basis, similarity).

    ``basis`` is text, header, directory or none; ``similarity`` is the cosine, or that of the
    license file inherited from, to six digits.
    """
    spark = files.sparkSession
    rows = [(i, name, text) for i, (name, text) in enumerate(templates or TEMPLATES)]
    known = spark.createDataFrame(rows, "template int, license string, phrase string")
    phrase_terms = common.materialize(_terms(known, "template", "phrase"), "phrase-terms")
    words = sorted(r.term for r in phrase_terms.select("term").distinct().collect())
    vocabulary = F.array(*map(F.lit, words)).cast("array<string>")  # the templates' words

    result = {"path", "license", "basis", "similarity"}
    rest = [c for c in files.columns if c not in (path_col, text_col) and c.lower() not in result]
    source = files.select(
        F.struct(*rest, F.lit(0).alias(common.unused(files, "none")[0])).alias("row"),
        F.coalesce(F.col(path_col), F.lit("")).alias("path"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Headers stay with their file as a short array; no file is looked up by an id.  Only files
    # with a header are looked at more closely, and each step is computed once per row.
    lines = F.split("text", "\n")
    some = F.col("text").rlike("(?i)" + HEADER)
    likely = F.transform("lines", lambda line: F.coalesce(_share(line, vocabulary) >= TEMPLATE_SHARE, F.lit(False)))
    cut = source.select("row", "path", "text", F.inline(F.array(F.struct(
        F.when(some, lines).otherwise(F.array().cast("array<string>")).alias("lines")))))
    marked = cut.select("row", "path", "text", "lines", F.inline(F.array(F.struct(likely.alias("likely")))))
    whole = F.when(some & (_share(F.col("text"), vocabulary) >= TEMPLATE_SHARE), F.col("text"))
    listed = common.materialize(marked.select(
        "row", "path", F.array_distinct(_headers(F.col("lines"), F.col("likely"))).alias("headers"),
        F.when(F.size("lines") > 0, F.size(_words(F.col("text")))).alias("n_words"),
        whole.alias("whole")), "headers")

    blocks = common.materialize(
        listed.select(F.explode("headers").alias("header")).groupBy("header").agg(
            F.count("*").alias("n")), "blocks")
    total = blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    terms = blocks.select("header", "n", F.explode(F.array_distinct(_words(F.col("header")))).alias("term"))
    mine = F.broadcast(phrase_terms.select("term").distinct())
    df = terms.join(mine, "term").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.log(F.lit(total + 1.0) / (F.lit(1.0) + F.coalesce("df", F.lit(0)))) + 1.0
    idf = phrase_terms.select("term").distinct().join(df, "term", "left").select(
        "term", weight.alias("idf"))
    idf = F.broadcast(common.materialize(idf, "idf"))
    unseen = spark.range(1).select(F.log(F.lit(total + 1.0)) + 1.0).first()[0]
    phrases = phrase_terms.join(idf, "term").withColumn("tw", F.col("tf") * F.col("idf"))
    phrase_norms = phrases.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tn"))
    against = (idf, unseen, phrases, phrase_norms, known)
    best = _best(blocks, "header", "header", *against)
    wholes = common.materialize(
        listed.where(F.col("whole").isNotNull()).select("whole").distinct(), "whole-texts")
    best_whole = _best(wholes, "whole", "whole", *against)

    # Files with headers only; a header of very many files is split by adaptive execution.
    with_headers = listed.where(F.size("headers") > 0).select(
        "path", "n_words", F.explode("headers").alias("header"))
    named = with_headers.join(best, "header").select(
        "path", "cosine", "license", F.lit(0).alias("kind"),
        ((F.size(_words(F.col("header"))) >= FILE_SHARE * F.col("n_words"))
         | _plain(F.col("path")).rlike(FILE_NAME)).alias("is_file"))
    texts = listed.where(F.col("whole").isNotNull()).select("path", "whole").join(
        best_whole, "whole").select(
        "path", "cosine", "license", F.lit(1).alias("kind"), F.lit(True).alias("is_file"))
    own = common.materialize(
        named.unionByName(texts).groupBy(F.col("path").alias("of_path")).agg(
            F.min(F.struct((-F.col("cosine")).alias("c"), "license", "kind")).alias("m"),
            F.max("is_file").alias("is_file"))
        .select("of_path", F.col("m.license").alias("own"), (-F.col("m.c")).alias("own_cosine"),
                F.when(F.col("m.kind") == 1, "text").otherwise("header").alias("own_basis"), "is_file"),
        "own")

    folder = lambda p: F.regexp_extract(p, "^(.*)/[^/]*$", 1)
    license_files = own.where("is_file").groupBy(folder(F.col("of_path")).alias("folder")).agg(
        F.min(F.struct((-F.col("own_cosine")).alias("c"), "of_path", "own")).alias("m"))
    license_files = license_files.select(
        "folder", F.col("m.own").alias("up"), (-F.col("m.c")).alias("up_cosine"))
    # Folders, not files, look for the nearest license above them: every folder once.
    folders = listed.select(folder(F.col("path")).alias("at")).where("at != ''").distinct()
    steps = F.split("at", "/")
    above = folders.select("at", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(steps)),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(steps, F.lit(1), n), "/").alias("folder"))
    )).alias("s")).select("at", "s.depth", "s.folder")
    nearest = above.join(license_files, "folder").groupBy("at").agg(
        F.max(F.struct("depth", "up", "up_cosine")).alias("m")).select(
        "at", F.col("m.up").alias("up"), F.col("m.up_cosine").alias("up_cosine"))
    joined = listed.select("row", "path").join(own, F.col("path") == F.col("of_path"), "left").join(
        nearest, folder(F.col("path")) == F.col("at"), "left")
    basis = F.when(F.col("own").isNotNull(), F.col("own_basis")).when(
        F.col("up").isNotNull(), "directory").otherwise("none")
    return joined.select(
        *(F.col("row").getField(c).alias(c) for c in rest), "path",
        F.coalesce("own", "up").alias("license"), basis.alias("basis"),
        F.coalesce("own_cosine", "up_cosine").alias("similarity"))
