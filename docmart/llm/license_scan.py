"""License scans: MinHash bands over text windows, then exact containment.

Texts and templates become words ([a-z0-9]+ of the lower-cased text) and runs
of ``K`` words (shingles).  For every size of template (3 to 8, 10, 12, 14, 16, 20,
... words) a text is cut into windows half as long again as that size, starting
every quarter of it.  Only texts that hold one of a few long words without which no template
can be contained are cut at all.  A whole template of the size lies in some
window and makes up over half of the template's window or nearly so.  Windows
that hold fewer template shingles than the shortest template of their size
needs for a match cannot contain one and are skipped.  The others get ``BANDS`` MinHash
values of one row each; equal values retrieve templates.  With likeness J a
window and a template meet with probability 1 - (1 - J) ** BANDS, over 0.9999
at J = 0.35, and a template in its window has more.  A retrieved template is a match if at least ``CONTAINED`` per cent of its
shingles are in the window.

Null and empty texts match nothing.  Repeated rows of a doc_id are one
document; rows with a null doc_id are one document without a name.
Templates are given in code (``LICENSES``, or the caller's), so the tables made
of them are bounded.  Only DataFrame functions are used.
"""

from __future__ import annotations

import pkgutil
import re
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

K, BANDS, CONTAINED = 3, 24, 80     # CONTAINED is in per cent
MOST_TEMPLATE_WORDS = 200_000      # of all templates together

# Notices by which public licenses ask to be named, and whole licenses.
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
          "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND ")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. ")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
            "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
            "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
            "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
            "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN "
            "ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_GNU = ("This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2} General Public "
        "License as published by the Free Software Foundation")
_GNU_END = (" This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
            "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} General Public License for more details.")
LICENSES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0",
    "MIT line": "Released under the MIT License",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0 line": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "MIT grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "ISC grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                 "fee is hereby granted",
    "BSD grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met",
    "GPL grant": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                 "GNU General Public License as published by the Free Software Foundation",
    "All rights reserved": "All rights reserved",
    "LGPL grant": _GNU.format("library", "; ", "Lesser"),
    "AGPL grant": _GNU.format("program", ": ", "Affero"),
    "GPL warranty notice": _GNU_END.format(""),
    "LGPL warranty notice": _GNU_END.replace("program", "library").format("Lesser"),
    "AGPL warranty notice": _GNU_END.format("Affero"),
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                      "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                         "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                         "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                         "permissions and limitations under the License.",
    "MIT text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
                "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
                "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
                "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
                "the Software. " + _AS_IS + "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
                "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
                "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
                "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
                "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
                "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
                "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
                "PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause text": _BSD + _BSD_END,
    "BSD-3-Clause text": _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                         "or promote products derived from this software without specific prior written permission. " + _BSD_END,
    "Unlicense text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                      "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                      "binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize "
                      "copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
                      "software to the public domain. We make this dedication for the benefit of the public at large and to the "
                      "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
                      "perpetuity of all present and future rights to this software under copyright law. " + _AS_IS
                      + "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
                      "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
                      "USE OR OTHER DEALINGS IN THE SOFTWARE.",
    **{f"{name} SPDX": f"SPDX-License-Identifier: {name}" for name in (
        "Apache-2.0", "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0",
        "AGPL-3.0", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-NC-4.0")},
    **{f"{name} text": pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode() for name in (
        "Apache-2.0", "MPL-2.0", "LGPL-2.1", "LGPL-3", "GPL-2", "GPL-3")},
}


def _words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def _shingles(w: Column) -> Column:
    """Of a column of words: a hash for each run of K words."""
    first = F.slice(w, 1, F.size(w) - (K - 1))
    out = F.zip_with(first, F.slice(w, 2, F.size(w) - (K - 1)), lambda a, b: F.concat_ws(" ", a, b))
    out = F.zip_with(out, F.slice(w, 3, F.size(w) - (K - 1)), lambda a, b: F.xxhash64(F.concat_ws(" ", a, b)))
    return F.when(F.size(w) >= K, out).otherwise(F.array().cast("array<bigint>"))


def _bands(shingles: str) -> Column:
    """array<struct<band, value>>: the smallest of the rehashed shingles, for every band."""
    def smallest(i: int) -> Column:
        return F.array_min(F.transform(F.col(shingles), lambda x: F.xxhash64(x, F.lit(i))))

    return F.array(*[F.struct(F.lit(i).alias("band"), smallest(i).alias("value")) for i in range(BANDS)])


def _enough(n: int) -> int:
    """How many of n shingles make a match."""
    return -(-CONTAINED * n // 100)


def _needed(w: list[str]) -> list[str]:
    """Words of a template of which every match holds at least one: without them, over a fifth of its shingles is missing."""
    runs = {tuple(w[i:i + K]) for i in range(len(w) - K + 1)}
    left, chosen = set(runs), []
    while len(left) >= _enough(len(runs)):
        held = Counter(x for r in left for x in set(r))
        word = min(held, key=lambda x: (-min(len(x), 7), -held[x], x))       # long ones are rare
        chosen.append(word)
        left = {r for r in left if word not in r}
    return chosen


def _size(n: int) -> int:
    """The window size for a template of n words: its own up to 8, then the next of 10, 12, 14, 16, 20, 24, 28, 32, ..."""
    step = max(1, 1 << (n - 1).bit_length() >> 3)
    return -(-n // step) * step


def _around(size: Column) -> Column:
    """array<struct<at, width>>: the windows for templates of a size that hold one of the ``places``."""
    width, step = size + F.floor(size / 2) - (K - 1), F.greatest(F.lit(1), F.floor(size / 4))
    starts = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(
        F.greatest(F.lit(0), F.ceil((p - width + 1) / step)).cast("int"), F.floor(p / step).cast("int")))))
    return F.transform(starts, lambda j: F.struct((j * step).cast("int").alias("at"), width.cast("int").alias("width")))


def _fewest(listed: list[tuple[str, list[str]]]) -> dict[int, int]:
    """By window size: the shingles that the shortest template of that size needs for a match."""
    fewest: dict[int, int] = {}
    for _, w in listed:
        distinct = len({tuple(w[i:i + K]) for i in range(len(w) - K + 1)})
        fewest[_size(len(w))] = min(fewest.get(_size(len(w)), distinct), _enough(distinct))
    return fewest


def scan(docs: DataFrame, licenses: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, license, containment, first_word, last_word, n_windows): one row per license found in a document."""
    licenses = LICENSES if licenses is None else licenses
    listed = [(name, _words(text)) for name, text in licenses.items()]
    listed = [(name, w) for name, w in listed if len(w) >= K]
    if sum(len(w) for _, w in listed) > MOST_TEMPLATE_WORDS:
        raise ValueError("templates of more than MOST_TEMPLATE_WORDS words: pass them in several scans")
    spark = docs.sparkSession
    table = spark.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(name).alias("license"), F.lit(_size(len(w))).alias("size"),
        F.split(F.lit(" ".join(w)), " ").alias("words")) for name, w in listed])))
    table = table.withColumn("own", F.array_distinct(_shingles(F.col("words")))).withColumn("band", F.explode(_bands("own")))
    table = stored(table.select("license", "size", "own", "band.band", "band.value"), "license_bands")
    # at most MOST_TEMPLATE_WORDS numbers
    known: dict[int, list[str]] = {}
    for r in table.select("size", F.explode("own").alias("s")).distinct().orderBy("s").collect():
        known.setdefault(r["size"], []).append(str(r["s"]))
    numbers = lambda xs: F.split(F.lit(",".join(xs)), ",").cast("array<bigint>")      # noqa: E731
    literal = numbers(sorted({x for xs in known.values() for x in xs}))
    fewest = _fewest(listed)
    by_size = F.array(*[F.struct(F.lit(size).alias("size"), F.lit(fewest[size]).alias("least"), numbers(xs).alias("own"))
                        for size, xs in sorted(known.items())])

    needed = {word for _, w in listed for word in _needed(w)}
    needed = sorted(w for w in needed if not any(x != w and x in w for x in needed))      # a word holds its parts
    lowered = F.lower(F.coalesce("text", F.lit("")))
    # one element, so a text is lowered once for all words
    holds = F.exists(F.array(lowered), lambda t: reduce(or_, [F.contains(t, F.lit(w)) for w in needed], F.lit(False)))
    texts = docs.where(holds).select("doc_id", lowered.alias("lowered"))
    texts = texts.select("doc_id", F.array_remove(F.split("lowered", "[^a-z0-9]+"), "").alias("words"))
    marked = texts.select("doc_id", _shingles(F.col("words")).alias("shingles")).where(
        F.arrays_overlap("shingles", literal))
    # from here on only texts that hold a shingle of a template
    marked = marked.select("doc_id", "shingles", F.array_intersect("shingles", literal).alias("held"))
    # a match needs so many shingles of one template, so texts and windows with fewer of all templates of a size have none
    sizes = marked.select("doc_id", "shingles", F.inline(F.transform(by_size, lambda g: F.struct(
        g["size"].alias("size"), g["least"].alias("least"), F.array_intersect(F.col("held"), g["own"]).alias("held")))))
    sizes = sizes.where(F.size("held") >= F.col("least")).withColumn("places", F.filter(
        F.transform("shingles", lambda x, i: F.when(F.array_contains(F.col("held"), x), i)),
        lambda i: i.isNotNull()))
    # windows [j * step, j * step + width) around a place
    windows = sizes.select("doc_id", "shingles", "size", "least", "held", F.explode(_around(F.col("size"))).alias("c")).select(
        "doc_id", "size", "least", "held", "c.at",
        F.array_distinct(F.slice("shingles", F.col("c.at") + 1, F.col("c.width"))).alias("window"))
    windows = windows.where(F.size(F.array_intersect("window", "held")) >= F.col("least"))
    windows = windows.withColumn("b", F.explode(_bands("window"))).select(
        "doc_id", "size", "at", "window", "b.band", "b.value")
    met = (windows.join(F.broadcast(table), ["size", "band", "value"])
           .withColumn("both", F.size(F.array_intersect("own", "window")))
           .where(100 * F.col("both") >= CONTAINED * F.size("own"))
           .withColumn("containment", F.col("both") / F.size("own"))
           .withColumn("last", F.col("at") + F.size("window") + K - 2))
    found = met.groupBy("doc_id", "license", "at").agg(F.max("containment").alias("containment"), F.max("last").alias("last"))
    return found.groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.min("at").cast("long").alias("first_word"),
        F.max("last").cast("long").alias("last_word"), F.count(F.lit(1)).alias("n_windows"))
