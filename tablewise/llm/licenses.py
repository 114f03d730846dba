"""Licence scan by canonical digests.

A text is brought to one form (case, punctuation, copyright lines, equivalent
spellings) and its digest is looked up among the digests of known licences.
Entire texts go through a hash join with the table of known licences; so do the
lines of a text, because a notice is a known text that stands on a line of its own.
Built-in expressions only.
"""
from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bundle, col, others, unbundle, written

# Known licence texts and notices by SPDX identifier.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
]
# Whole licences, a file each: the SPDX identifier, perhaps a variant's name after a further dot.
TEXTS = Path(__file__).with_name("license_texts")
# What may stand above a text that has no title of its own.
TITLES = {
    "MIT": ["The MIT License", "The MIT License (MIT)", "MIT License"],
    "ISC": ["ISC License", "The ISC License"],
    "BSD-2-Clause": ["BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "The BSD 3-Clause License", "BSD License"],
    "Zlib": ["zlib License", "The zlib License"],
    "Unlicense": ["The Unlicense"],
}
# The usual heads of source files.
HEADERS = [
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    *[(f"GPL-{version}.0", f"""This program is free software{mark} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{either} version {version} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License{end}""")
      for version, mark, either, end in [
          (3, ":", ", either", "\nalong with this program.  If not, see <http://www.gnu.org/licenses/>."),
          (2, ";", "; either", "\nalong with this program.  If not, see <http://www.gnu.org/licenses/>."),
          (2, ";", "; either", """ along
with this program; if not, write to the Free Software Foundation, Inc.,
51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."""),
      ]],
]
END_OF_TERMS = "END OF TERMS AND CONDITIONS"
# Equivalent spellings (a pattern, what it becomes), after lower-casing.
SAME = [
    (r"licen[cs]e", "license"), (r"sub-license", "sublicense"), (r"copyright owner", "copyright holder"),
    (r"non-?infringement", "noninfringement"), (r"creative commons attribution", "cc by"), (r"https", "http"),
    (r"&", " and "), (r"merchantibility", "merchantability"), (r"\bversion\b|\bv\.", "v "),
]
COPYRIGHT_LINE = r"(?m)^[ \t]*(?:copyright|\(c\)|©)[^\n]*$"
PUNCTUATION = r"[^\p{L}\p{N}\n]+"
# Lengths and first words of known forms that lines are tested for at most; with more of them the test is left out.
MAX_TESTS = 10_000
# Known licences that are broadcast at most; more of them are joined by a shuffle.
MAX_BROADCAST = 100_000

ADDED = ["license", "license_sha256", "notices", "n_notices"]


def canonical_lines(text: Column) -> Column:
    """The canonical form with the line ends of the text; the words of a line are its canonical form, but for outer spaces."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, " ")
    for pattern, same in SAME:
        out = F.regexp_replace(out, pattern, same)
    return F.regexp_replace(out, PUNCTUATION, " ")


def joined(form: Column) -> Column:
    return F.trim(F.regexp_replace(form, "[ \n]+", " "))


def canonical(text: Column) -> Column:
    return joined(canonical_lines(text))


def whole_texts() -> list[tuple[str, str]]:
    """(license, text) of whole licences and file heads in their usual forms: with and without title, "All rights
    reserved", numbers of the conditions and appendix, in lines and in unbroken paragraphs."""
    files = [(re.match(r"(.+?)(?:\.[a-z]+)?\.txt$", f.name)[1], f.read_text("utf-8")) for f in sorted(TEXTS.glob("*.txt"))]
    short = [(name, text.removeprefix("MIT License\n")) for name, text in KNOWN if "\n" in text]
    found = []
    for name, text in [*files, *short, *HEADERS]:
        forms = [text]
        if END_OF_TERMS in text:
            head = text[:text.index(END_OF_TERMS)]
            forms += [head + END_OF_TERMS, head]
        if name in TITLES:
            forms += [re.sub(r"(?m)^[ \t]*[1-9]\. ", "", text)]
            forms = [above + form for form in forms for title in ["", *TITLES[name]]
                     for above in ([f"{title}\n\n", f"{title}\n\nAll rights reserved.\n\n"] if title else ["", "All rights reserved.\n\n"])]
        # a copyright line ends where its line ends, so the breaks of a paragraph count
        forms += [re.sub(r"[ \t]*(?<!\n)\n(?!\n)[ \t]*", " ", form) for form in forms]
        found += [(name, form) for form in dict.fromkeys(forms)]
    return found


def known_licenses(spark: SparkSession, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """(license, digest, length, word) of the known texts (default: the built-in ones); one row a digest. The
    length and the first word are those of the canonical form."""
    df = spark.createDataFrame([*KNOWN, *whole_texts()] if texts is None else texts, "license string, text string")
    form = df.select("license", canonical(F.col("text")).alias("form"))
    return (form.groupBy(F.sha2("form", 256).alias("digest"), F.length("form").alias("length"),
                         F.substring_index("form", " ", 1).alias("word")).agg(F.min("license").alias("license")))


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, text_col: str = "text",
                  carry: list[str] | None = None) -> DataFrame:
    """Find licences in whole texts.

    Adds ``license_sha256`` (of the canonical text), ``license`` (the known licence
    that the entire text is, else null), ``notices`` (known licences whose text stands on a
    line, sorted, comma-joined) and ``n_notices`` (such lines).

    Null text counts as empty; an empty canonical text is no licence. Repeated rows and
    null ids give a row each, an empty table none. Input columns named like
    the added ones are replaced. ``known`` is broadcast up to ``MAX_BROADCAST`` rows; lines are looked up
    if their canonical form has the length and the first word of a known one (all lines, if ``known`` lacks
    ``length`` and ``word``).
    """
    spark = docs.sparkSession
    known = known_licenses(spark) if known is None else known
    known = known.where(F.col("digest") != F.sha2(F.lit(""), 256))
    tests = [c for c in ("length", "word") if c in known.columns]
    sizes = known.agg(F.count("*").alias("n"), *[F.count_distinct(c).alias(c) for c in tests]).first()
    few = [c for c in tests if sizes[c] <= MAX_TESTS]  # only these are gathered
    facts = known.agg(*[F.collect_set(c).alias(c) for c in few]).first().asDict() if few else {}
    table = F.broadcast(known) if sizes["n"] <= MAX_BROADCAST else known
    cols = others(docs, ADDED) if carry is None else carry
    form = canonical_lines(F.coalesce(col(text_col), F.lit("")))

    def likely(line: Column) -> Column:
        out = F.length(line) > 0
        for c, of in (("length", F.length(line)), ("word", F.substring_index(line, " ", 1))):
            if c in few:
                out = out & of.isin(facts[c])
        return out

    lines = F.filter(F.transform(F.split("_form", "\n"), lambda x: F.trim(x)), likely)
    df = docs.select(bundle(cols), form.alias("_form"), F.monotonically_increasing_id().alias("_at"))
    # the canonical form of every text is made once: digests go on, texts only if they are carried
    df = written(df.select("_row", "_at", F.sha2(joined(F.col("_form")), 256).alias("license_sha256"),
                           F.transform(lines, lambda x: F.sha2(x, 256)).alias("_lines")), "license-digests")
    df = df.join(table.select(F.col("digest").alias("_whole"), "license"),
                 F.col("license_sha256") == F.col("_whole"), "left")
    plain = df.where(F.size("_lines") == 0).select(
        *unbundle(cols), "license", "license_sha256", F.lit("").alias("notices"), F.lit(0).cast("long").alias("n_notices"))
    # the few texts with candidate lines: a row a line, joined, and gathered again
    line = df.where(F.size("_lines") > 0).withColumn("_line", F.explode("_lines")).drop("_lines")
    met = line.join(table.select(F.col("digest").alias("_d"), F.col("license").alias("_notice")),
                    F.col("_line") == F.col("_d"), "left")
    found = met.groupBy("_at").agg(
        F.first("_row").alias("_row"), F.first("license").alias("license"),
        F.first("license_sha256").alias("license_sha256"),
        F.array_join(F.array_sort(F.collect_set("_notice")), ",").alias("notices"),
        F.count("_notice").alias("n_notices"))
    return plain.unionByName(found.select(*unbundle(cols), *ADDED))
