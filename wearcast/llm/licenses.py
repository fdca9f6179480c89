"""License scans: MinHash bands over text windows, then exact containment.

DataFrame functions only.  Texts are cut to words (letters and digits, lower
case) and 3-word shingles.  For each distinct template length, windows of that
length plus a stride slide over the text, so an occurrence lies whole in some
window.  A bitmap of the templates' shingles tells the places of a text that
may lie in a template, whatever the number of templates.  A window is signed
if it holds as many such places as the least template of its length needs for
a match: the others cannot match, so none is lost.  Bands of the windows'
MinHash signatures look up the templates of that length, and a match is kept
if the window holds at least ``CONTAINMENT`` of the template's shingles.

With 24 bands of 2 rows, a window whose Jaccard similarity with a template is
0.55 (the least at a containment of 0.8) is retrieved with a chance of
1 - (1 - 0.55^2)^24 > 0.9998; an exact occurrence has 0.75 or more, and a
chance above 1 - 1e-8.
"""

from __future__ import annotations

import json
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .book import query
from .common import table

SHINGLE, BANDS, BAND_ROWS, CONTAINMENT = 3, 24, 2, 0.8
#: The templates are broadcast up to this many shingles (some 400 bytes each with
#: their bands); more are joined by shuffle.
BROADCAST_SHINGLES = 200_000
#: Bits of the bitmap: at least this many for each template shingle, up to a megabyte.
BITS_EACH, MOST_BITS = 1024, 1 << 23

# FIXED VALUES: notices and whole texts as their licenses word them.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "mit": "Released under the MIT License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files, to deal in the Software without restriction",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are "
                          "permitted provided that the following conditions are met",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "bsd-3-clause-text": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be
used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE
IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.""",
    "zlib-text": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the
following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software. 3. This notice may not be removed or altered from any source
distribution.""",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    "gpl-3.0-header": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
details. You should have received a copy of the GNU General Public License along with this program. If not, see
https://www.gnu.org/licenses/""",
    "unlicense-text": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for
any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author
or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this
dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this
dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under
copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING
FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information,
please refer to https://unlicense.org/""",
}


def _bound(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def license_words(text: Column) -> Column:
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1)
    return F.filter(parts, lambda w: w != "")


def shingle_hashes(words: Column) -> Column:
    """Hashes of the 3-word windows, in order (a shorter text has none)."""
    return _bound(words, lambda ws: F.transform(
        F.slice(ws, 1, F.greatest(F.size(ws) - (SHINGLE - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2))))


def band_keys(shingles: Column) -> Column:
    """One key for each band of the MinHash signature of a shingle array."""
    def low(band: int, row: int) -> Column:
        seed = F.lit(band * BAND_ROWS + row)
        return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, seed)))

    return F.array(*[F.xxhash64(F.lit(b), *[low(b, r) for r in range(BAND_ROWS)]) for b in range(BANDS)])


def _bitmap(spark: SparkSession, shingles: DataFrame, count: int) -> tuple[Column, int]:
    """The set bits of the templates' shingle hashes, as a literal array of
    64-bit words, and its number of bits (a power of two)."""
    bits = 1 << 12
    while bits < min(MOST_BITS, BITS_EACH * count):
        bits <<= 1
    at = F.col("h").bitwiseAND(F.lit(bits - 1))
    word, bit = F.shiftright(at, 6).cast("int"), at.bitwiseAND(F.lit(63)).cast("int")
    rows = shingles.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit")).groupBy(
        "word").agg(F.bit_or("bit").alias("bits")).collect()  # at most MOST_BITS / 64
    words = [0] * (bits // 64)
    for r in rows:
        words[r["word"]] = r["bits"]
    return F.from_json(F.lit(json.dumps(words)), "array<bigint>"), bits


def _marked(bitmap: Column, bits: int, h: Column) -> Column:
    """Whether the hash's bit is set."""
    at = h.bitwiseAND(F.lit(bits - 1))
    word = F.get(bitmap, F.shiftright(at, 6).cast("int"))
    return F.call_function("shiftright", word, at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """Licenses found in the documents: doc_id, license, containment (the best
    window's share of the template's shingles) and n_windows that matched.

    Documents without a match have no row; null, empty and shorter texts have
    none.  Rows with the same id (or with no id) are one document here.  Only
    doc_id and text are read.  A template under 3 words raises an error, no
    templates give an empty result.  Any number of templates is searched; the
    driver sees their lengths and bitmap."""
    spark = docs.sparkSession
    words = license_words(F.col("text"))
    known = spark.createDataFrame(sorted(templates.items()), "license string, text string").select(
        "license", F.size(words).alias("n_words"), F.array_distinct(shingle_hashes(words)).alias("t_shingles"))
    stride = F.greatest(F.floor(F.col("n_words") / 4), F.lit(1)).cast("int")
    known = known.select("license", "t_shingles", "n_words", stride.alias("stride"), (
        F.col("n_words") + stride - SHINGLE + 1).cast("int").alias("width"))
    listed = known.groupBy("n_words", "width", "stride").agg(
        F.min(F.size("t_shingles")).alias("least"), F.sum(F.size("t_shingles")).alias("total")).orderBy("n_words").collect()
    if any(r["n_words"] < SHINGLE for r in listed):
        raise ValueError(f"templates need {SHINGLE} words at least")
    count = sum(r["total"] for r in listed)
    bitmap, bits = _bitmap(spark, known.select(F.explode("t_shingles").alias("h")), count)
    needs = [max(1, ceil(containment * r["least"] - 1e-9)) for r in listed]
    fewest = min(needs, default=1)
    lengths = F.array(*[F.struct(F.lit(r["width"]).alias("width"), F.lit(r["stride"]).alias("stride"),
                                 F.lit(need).alias("need"))
                        for r, need in zip(listed, needs)]) if listed else F.array().cast("array<struct<width:int,stride:int,need:int>>")
    hits = docs.select(F.col("doc_id").cast("long").alias("doc_id"), shingle_hashes(license_words(F.col("text"))).alias("s")).select(
        "doc_id", "s", F.filter(F.transform("s", lambda h, i: F.when(_marked(bitmap, bits, h), i)),
                                lambda i: i.isNotNull()).alias("at")).where(F.size("at") >= fewest)

    def starts(length: Column) -> Column:
        """Window starts (multiples of the stride) whose window holds enough hits."""
        first = lambda i: F.greatest(F.ceil((i - length["width"] + 1) / length["stride"]), F.lit(0))
        near = F.array_sort(F.flatten(F.transform("at", lambda i: F.sequence(
            first(i).cast("int"), F.floor(i / length["stride"]).cast("int")))))  # a window once for each hit
        enough = _bound(near, lambda ks: F.array_distinct(F.filter(ks, lambda k, j: F.coalesce(
            F.get(ks, j + length["need"] - 1) == k, F.lit(False)))))
        return F.transform(F.when(F.size("at") >= length["need"], enough).otherwise(F.array().cast("array<int>")),
                           lambda k: F.struct(length["width"].alias("width"), (k * length["stride"]).cast("int").alias("start")))

    windows = hits.select("doc_id", "s", F.explode(F.flatten(F.transform(lengths, starts))).alias("w")).select(
        "doc_id", "w", F.array_distinct(F.slice("s", F.col("w.start") + 1, F.col("w.width"))).alias("w_shingles"))
    keyed = windows.select("doc_id", "w", F.col("w.width").alias("width"), "w_shingles",
                           F.explode(F.array_distinct(band_keys(F.col("w_shingles")))).alias("band"))
    index = known.select("license", "t_shingles", "width", F.explode(F.array_distinct(band_keys(F.col("t_shingles")))).alias("band"))
    share = F.size(F.array_intersect("w_shingles", "t_shingles")) / F.size("t_shingles")
    found = keyed.join(F.broadcast(index) if count <= BROADCAST_SHINGLES else index, ["band", "width"]).select(
        "doc_id", "license", "w", share.alias("share")).where(F.col("share") >= containment)
    return found.groupBy("doc_id", "license").agg(
        F.round(F.max("share"), 6).alias("containment"), F.count_distinct("w").alias("n_windows"))


@query("op10_license_scan")
def op10(spark, sf_dir):
    """License notices in all documents."""
    return scan_licenses(table(spark, sf_dir, "documents"))
