"""Licence scans: canonical texts looked up by digest."""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import once

# Words that licence matching treats as the same, as whole words.
EQUIVALENT = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense",
    "organisation": "organization", "organisations": "organizations", "acknowledgement": "acknowledgment",
    "merchantibility": "merchantability", "favour": "favor", "fulfil": "fulfill", "per cent": "percent",
    "copyright owner": "copyright holder", "copyright owners": "copyright holders",
    "non commercial": "noncommercial", "sub license": "sublicense", "https": "http",
}

_WARRANTY_BSD = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
_TERMS_BSD = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.
"""

# Known licence texts and short notices, (id, text).
KNOWN = (
    ("MIT", """
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
IN THE SOFTWARE.
"""),
    ("ISC", """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
USE OR PERFORMANCE OF THIS SOFTWARE.
"""),
    ("BSD-2-Clause", _TERMS_BSD + _WARRANTY_BSD),
    ("BSD-3-Clause", _TERMS_BSD + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
""" + _WARRANTY_BSD),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)


def canonical(text: Column) -> Column:
    """Lower case; lines that open with a copyright mark or "all rights
    reserved" left out, unless a sentence of the terms runs on with "notice",
    "holder" or "owner"; other signs than letters and digits as one space;
    equivalent spellings as one."""
    plain = F.regexp_replace(F.lower(text), r"(^|\n)[ \t]*(copyright (?!notice|holder|owner)|copyright\n|\(c\)|©|all rights reserved)[^\n]*", "$1")
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    for spelling, same in EQUIVALENT.items():
        plain = F.replace(plain, F.lit(f" {spelling} "), F.lit(f" {same} "))
    return F.trim(plain)


def anchors(known) -> list[str]:
    """Words of which every known text holds one: chosen one by one to cover the
    most texts, the longest first. Normalising leaves these words as they are,
    so a text without any of them cannot be known."""
    changed = {w for pair in EQUIVALENT.items() for side in pair for w in side.split()} | {"copyright", "reserved"}
    left = []
    for _, text in known:
        found = {w for w in re.findall(r"[a-z]{3,}", text.lower()) if w not in changed}
        if not found:
            return []
        left.append(found)
    chosen = []
    while left:
        times = Counter(w for found in left for w in found)
        best = max(times, key=lambda w: (times[w], len(w), w))
        chosen.append(best)
        left = [found for found in left if best not in found]
    return chosen


def _may_match(text: Column, words: list[str]) -> Column:
    if not words:
        return F.lit(True)
    return reduce(lambda a, b: a | b, [F.contains(F.lower(text), F.lit(w)) for w in words])


def known_digests(spark, known=KNOWN) -> DataFrame:
    """(licence, digest), one row per known text; a digest listed twice counts once."""
    rows = spark.createDataFrame(list(known), "licence string, text string")
    return rows.select("licence", F.sha2(canonical(F.col("text")), 256).alias("digest")).groupBy("digest").agg(
        F.min("licence").alias("licence"))


def scan_licences(docs: DataFrame, known=KNOWN, id_col: str = "doc_id", text_col: str = "text",
                  lines: bool = True) -> DataFrame:
    """(doc_id, scope, line, licence): texts that are, as a whole, a known
    licence (scope ``text``, line null), and lines that are a known notice
    (scope ``line``, numbered from 0) unless ``lines`` is off.

    Null and empty texts, and those with nothing left after normalising, match
    nothing; rows with a null doc_id are scanned like others; repeated rows give
    repeated results. Long texts are digested whole. Only texts and lines with a
    word that every known text holds one of are normalised. The digest table is the
    caller's licence list; it goes to every task while it holds at most 100,000
    entries and is joined by a shuffle beyond.
    """
    spark = docs.sparkSession
    words = anchors(known)
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter(_may_match(F.col("text"), words))
    whole = base.select("doc_id", F.lit("text").alias("scope"), F.lit(None).cast("int").alias("line"), "text")
    texts = whole
    if lines:
        split = base.select("doc_id", F.lit("line").alias("scope"), F.posexplode(F.split("text", "\n")).alias("line", "text"))
        texts = whole.unionByName(split.filter(_may_match(F.col("text"), words)))
    digests = known_digests(spark, known)
    if len(known) <= 100_000:
        digests = F.broadcast(digests)
    plain = texts.select("doc_id", "scope", "line", once(canonical(F.col("text"))).alias("plain")).filter("plain <> ''")
    return (
        plain.select("doc_id", "scope", "line", F.sha2("plain", 256).alias("digest"))
        .join(digests, "digest").select("doc_id", "scope", "line", "licence")
    )
