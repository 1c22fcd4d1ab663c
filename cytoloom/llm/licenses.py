"""License scans: MinHash bands over overlapping windows find templates, exact shingle containment verifies them.

A text is cut into windows of words that overlap by half, in one window length per length class of the templates; a
window is twice as long as the longest template of its class, so every occurrence lies whole in some window. The
signature of a window is the smallest hash of its five-word shingles in each of BANDS permutations, one value per band.
A template and a window that holds it agree in a band whenever the smallest shingle of the window is one of the
template; the bands are many enough that a window which holds a whole template misses all of them with a probability
below ``(1 - s / w) ** BANDS``, s and w being the numbers of shingles of template and window. Pairs that agree in a band are
verified: the share of the template's shingles that occur in the window must reach the threshold.

A window that holds CONTAINMENT of a template holds one of any few more than ``1 - CONTAINMENT`` of its shingles, the leads; texts
without a lead are left before windows are made, and only windows with one are signed. Everything is DataFrame work;
the template table is small and bounded.
"""

from __future__ import annotations

import math
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
BANDS = 24
MAX_TEMPLATES = 1_000
WORD_SPLIT = "[ \\t\\n\\u000B\\f\\r]+"

# Short notices as they stand in files: fixed values.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


# Bodies and usual headers. BSD is what the licenses of two and three clauses share, BSD-3-Clause the third clause; a header that
# names a version is short enough that another version or the lesser license falls below CONTAINMENT.
TEXTS = [
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included "
        "in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE "
        "COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED "
        "TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
        "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
        "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
        "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    *[
        (f"{short}-{version}{'' if '.' in version else '.0'}", f"the terms of the GNU {name} as published by the Free Software Foundation; either version {version} of the License")
        for short, name, version in [
            ("GPL", "General Public License", "2"), ("GPL", "General Public License", "3"),
            ("LGPL", "Lesser General Public License", "2.1"), ("LGPL", "Lesser General Public License", "3"),
        ]
    ],
]
# The longer bodies, one file a license.
BODIES = Path(__file__).with_name("license_texts")


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NOTICES, "license string, text string")


def templates(spark: SparkSession) -> DataFrame:
    """One-line notices, headers and whole licenses: a fixed table. The clause of NOTICES that all BSD licenses share says BSD."""
    lines = [("BSD" if name == "BSD-3-Clause" else name, text) for name, text in NOTICES]
    bodies = [(f.name.removesuffix(".txt"), f.read_text()) for f in sorted(BODIES.glob("*.txt"))]
    return spark.createDataFrame(lines + TEXTS + bodies, "license string, text string")


def _words(text: Column) -> Column:
    """Lower-cased words without punctuation at their ends; a word of punctuation alone is none."""
    trimmed = F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_SPLIT, -1), lambda w: F.regexp_replace(w, "^\\p{Punct}+|\\p{Punct}+$", ""))
    return F.filter(trimmed, lambda w: w != "")


def _shingles(words: Column) -> Column:
    """Hashes of the five-word shingles in text order; fewer words are one shingle, none give none."""

    def of(w: Column) -> Column:
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - SHINGLE_WORDS, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE_WORDS)]))
        )

    return F.transform(F.array(F.struct(words.alias("v"))), lambda s: of(s["v"]))[0]


def _signature(shingles: Column) -> Column:
    """The shingle with the smallest hash in every permutation."""
    bands = F.array(*[F.lit(b) for b in range(BANDS)])
    return F.transform(bands, lambda b: F.array_min(F.transform(shingles, lambda h: F.struct(F.xxhash64(h, b).alias("value"), h.alias("h"))))["h"])


def _hashes(values: set[int]) -> Column:
    return F.array(*[F.lit(h).cast("long") for h in sorted(values)])


def scan(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """(doc_id, license, n_windows, first_shingle, containment) for every document and template found in it.

    ``containment`` is the largest share of the template's shingles in one window, at least CONTAINMENT; ``first_shingle`` the
    place of the first such window, counted in shingles; ``n_windows`` their number. Texts are scanned whole. A null or empty text
    has no license. Rows that share a doc_id are scanned one by one and reported together; a null doc_id counts as
    one id. Templates with the same name are variants of one license; empty ones are ignored. More than
    MAX_TEMPLATES are refused. Other columns are ignored, an empty table gives an empty table.
    """
    if templates.limit(MAX_TEMPLATES + 1).count() > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    known = templates.select(F.col("license").cast("string").alias("license"), F.array_distinct(_shingles(_words(F.col("text")))).alias("shingles"))
    known = known.where(F.size("shingles") > 0).distinct()
    # a power of two at least the number of shingles: the length class
    known = known.withColumn("class", F.pow(F.lit(2.0), F.ceil(F.log2(F.size("shingles").cast("double")))).cast("int"))
    found = known.collect()  # MAX_TEMPLATES at most
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _shingles(_words(F.col("text"))).alias("shingles"))
    if not found:
        return rows.select("doc_id", F.lit("").alias("license"), F.lit(0).cast("long").alias("n_windows"), F.lit(0).cast("long").alias("first_shingle"), F.lit(0.0).alias("containment")).where("false")
    leads: dict[int, set[int]] = {}
    for row in found:
        missed = math.floor((1 - CONTAINMENT) * len(row["shingles"]) + 1e-6)
        leads.setdefault(row["class"], set()).update(sorted(row["shingles"])[: missed + 1])
    every = _hashes(set().union(*leads.values()))
    rows = rows.where(F.arrays_overlap("shingles", every)).withColumn("hits", F.array_intersect("shingles", every))
    held = [F.struct(F.lit(c).alias("class"), F.array_intersect("hits", _hashes(leads[c])).alias("hits")) for c in sorted(leads)]
    windows = rows.select("doc_id", "shingles", F.explode(F.array(*held)).alias("held")).where(F.size("held.hits") > 0)
    windows = windows.select("doc_id", "shingles", "held.*")
    starts = F.sequence(F.lit(0), F.greatest(F.size("shingles") - 1, F.lit(0)), F.col("class"))
    windows = windows.select("doc_id", "class", "shingles", "hits", F.explode(starts).alias("start"))
    windows = windows.select("doc_id", "class", "start", "hits", F.slice("shingles", F.col("start") + 1, F.col("class") * 2).alias("window"))
    windows = windows.where(F.arrays_overlap("window", "hits"))
    banded = windows.select("doc_id", "class", "start", "window", F.explode(F.array_distinct(_signature(F.col("window")))).alias("h"))
    # the window's smallest shingles are looked up among all shingles of the templates, these then by number
    spark = docs.sparkSession
    numbered = [(i, *row) for i, row in enumerate(found)]
    numbered = spark.createDataFrame(numbered, "template int, license string, shingles array<bigint>, class int")
    marks = numbered.select("class", F.explode("shingles").alias("h"), "template")
    share = F.size(F.array_intersect("window", "shingles")) / F.size("shingles")
    # at most MAX_TEMPLATES templates, so these sides are small at any corpus size
    pairs = banded.join(F.broadcast(marks), ["class", "h"]).join(F.broadcast(numbered.select("template", "license", "shingles")), "template")
    pairs = pairs.select("doc_id", "license", "start", share.alias("share")).where(F.col("share") >= CONTAINMENT)
    return pairs.groupBy("doc_id", "license").agg(
        F.count_distinct("start").alias("n_windows"), F.min("start").cast("long").alias("first_shingle"), F.max("share").alias("containment")
    )
