"""Licence scan: passages of documents against licence templates, by Dice coefficient over word bigrams.

A text is normalised (lower case; each run of characters that are neither letters nor digits is one space), so that line breaks, comment marks and
punctuation don't matter, and is taken as its row of hashed word bigrams. A template is a set B of n bigrams. A passage is any stretch of the text; its size is the number of
its bigrams, one of B counting once and any other each time it stands there. Dice = 2 x / (size + n), with x bigrams of B in the passage. It can reach the threshold t only if
the size lies between n t / (2 - t) and n (2 - t) / t; so a template whose bigrams don't come up in the text n t / (2 - t) times, each counted once, is not
compared (almost none is, for almost all texts), and a passage is (2 - t) / t times as long as its template at most. Only passages that begin and end with a bigram of
B are looked at: others do better without their ends.

Result, per document: n_matches, the number of templates that some passage reaches the threshold with; and the best one: licence, dice, word (the place of its first
word in the text, from 0) and n_words. Ties go to the larger template, then to the first by name, then to the earliest and the longest passage. A notice is found wherever it stands, on one line or wrapped over
several, alone or within a longer text.

A null or empty text matches nothing; a document without a match has nulls and n_matches 0. Rows repeat as in the input; equal texts are compared once. Extra columns are ignored. An empty table gives
no rows. Everything is a DataFrame expression: no Python runs on the executors.
"""

from __future__ import annotations

import re
from math import ceil, floor

import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickwork.llm.common import redealt

THRESHOLD = 0.8

#: Licence notices and texts as they are customarily written, without their copyright lines.
TEMPLATES = {
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A '
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A '
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause-short": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
        "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: "
        "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, "
        "and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. '
        "IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; "
        "either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, '
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:"
    ),
    "MIT-text": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the "
        "public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present "
        "and future rights to this software under copyright law."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated "
        "but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution."
    ),
}


def words_of(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def template_bigrams(text: str) -> list[tuple[str, str]]:
    """The distinct bigrams of a template, in order."""
    w = words_of(text)
    return list(dict.fromkeys(zip(w, w[1:], strict=False)))


def _least(n: int, threshold: float) -> int:
    return ceil(n * threshold / (2 - threshold) - 1e-9)


def _longest(text: str, threshold: float) -> int:
    """The most bigrams of a passage that is compared with the template."""
    return floor((len(words_of(text)) - 1) * (2 - threshold) / threshold + 1e-9)


def _hash(pair: tuple[str, str]) -> int:
    """xxhash64(first, second) as Spark has it: the hash of a value is the seed of the next."""
    seed = 42
    for w in pair:
        seed = xxhash.xxh64_intdigest(w.encode(), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def bigrams(text: Column) -> Column:
    """The hashes of a text's word bigrams, in order."""
    w = F.split(F.trim(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " ")), " ")
    return F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1), lambda a, b: F.xxhash64(a, b))


def passages(hits: Column, n: Column, longest: Column, least: Column, threshold: float) -> Column:
    """For bigrams of a template in a text, as (p, prev) by place p with the place of the same bigram before it: each passage that reaches the threshold, the best of those that begin at one bigram, as (-dice, p, -bigrams)."""

    def best(first: Column, i: Column) -> Column:
        def step(a: Column, e: Column) -> Column:
            x = a["x"] + (e["prev"] < first["p"]).cast("int")
            size = e["p"] - first["p"] + 1
            d = -2 * x / (x + size - (a["c"] + 1) + n)
            found = F.struct(x.alias("x"), (a["c"] + 1).alias("c"), F.least(a["d"], d).alias("d"), F.when(d <= a["d"], -size).otherwise(a["size"]).alias("size"))
            return F.when(size <= longest, found).otherwise(a)

        zero = F.struct(F.lit(0).alias("x"), F.lit(0).alias("c"), F.lit(0.0).alias("d"), F.lit(0).alias("size"))
        enough = F.get(hits, i + least - 1)["p"] - first["p"] < longest
        return F.when(enough, F.aggregate(F.slice(hits, i + 1, longest), zero, step, lambda a: F.struct(a["d"].alias("d"), first["p"].alias("p"), a["size"].alias("size"))))

    return F.filter(F.transform(hits, best), lambda x: x["d"] <= -threshold + 1e-12)


def scan(documents: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_matches, licence, dice, word, n_words): the count of templates that match and the best match, per document."""
    sets = {k: template_bigrams(v) for k, v in sorted(templates.items())}
    known = F.array(*(
        F.struct(F.lit(k).alias("licence"), F.lit(len(b)).alias("n"), F.lit(_longest(templates[k], threshold)).alias("longest"), F.lit(_least(len(b), threshold)).alias("least"), F.array(*(F.lit(_hash(x)) for x in b)).alias("b"))
        for k, b in sets.items()
    ))
    every = F.array(*(F.lit(h) for h in sorted({_hash(x) for b in sets.values() for x in b})))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # the filter names a column that isn't deterministic: pushed below the projections it would compute all of them again
    d = documents.select(F.xxhash64(text).alias("t"), bigrams(text).alias("b"), F.monotonically_increasing_id().alias("_stay")).withColumn("some", F.array_intersect("b", every))
    d = d.where((F.col("_stay") >= 0) & (F.size("some") >= min(_least(len(b), threshold) for b in sets.values())))
    d = d.withColumn("fit", F.filter(known, lambda k: F.size(F.array_intersect("some", k["b"])) >= k["least"])).where(F.size("fit") > 0)
    d = d.select("t", "b", F.transform("fit", lambda k: k["licence"]).alias("fit")).dropDuplicates(["t"])
    hits = d.select("t", "fit", F.posexplode("b").alias("p", "h"))
    parts = documents.sparkSession.range(1).select(F.explode(known).alias("k")).select("k.*").withColumn("h_", F.explode("b")).drop("b")
    # as many rows as the templates have bigrams, whatever the documents
    hits = hits.join(F.broadcast(parts), (F.col("h") == F.col("h_")) & F.array_contains("fit", F.col("licence")))
    same = Window.partitionBy("t", "licence", "h").orderBy("p")
    hits = hits.withColumn("prev", F.coalesce(F.lag("p").over(same), F.lit(-1)))
    g = hits.groupBy("t", "licence", "n", "longest", "least").agg(F.sort_array(F.collect_list(F.struct("p", "prev"))).alias("hits"))
    g = g.withColumn("best", F.array_min(passages(F.col("hits"), F.col("n"), F.col("longest"), F.col("least"), threshold))).where("best is not null")
    best = g.groupBy("t").agg(F.count("*").alias("n_matches"), F.min(F.struct(F.col("best.d").alias("d"), (-F.col("n")).alias("o"), "licence", F.col("best.p").alias("p"), F.col("best.size").alias("size"))).alias("m"))
    best = best.select(redealt(F.col("t")).alias("_t"), "n_matches", "m")
    ids = documents.select("doc_id", F.xxhash64(text).alias("t"))
    return ids.join(best, F.col("t") == F.col("_t"), "left").select(
        "doc_id", F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"), F.col("m.licence").alias("licence"), F.round(-F.col("m.d"), 6).alias("dice"),
        F.col("m.p").cast("long").alias("word"), (1 - F.col("m.size")).cast("long").alias("n_words"),
    )


def _sql() -> str:
    rows = ", ".join(f"('{k}', {_longest(v, THRESHOLD)}, {_least(len(template_bigrams(v)), THRESHOLD)}, [" + ", ".join(f"'{a} {b}'" for a, b in template_bigrams(v)) + "])" for k, v in sorted(TEMPLATES.items()))
    return f"""
WITH t(licence, longest, least, b) AS (VALUES {rows}),
g AS (SELECT licence, unnest(b) AS g FROM t),
d AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
w AS (SELECT text, string_split(trim(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w FROM d),
a AS (SELECT text, p, w[p + 1] || ' ' || w[p + 2] AS g FROM (SELECT text, w, unnest(range(0, len(w) - 1)) AS p FROM w)),
h AS (SELECT text, licence, p, a.g FROM a JOIN g ON a.g = g.g),
c AS (SELECT text, licence FROM h GROUP BY text, licence HAVING count(DISTINCT g) >= (SELECT least FROM t WHERE t.licence = h.licence)),
k AS (SELECT h.text, h.licence, p, coalesce(lag(p) OVER (PARTITION BY h.text, h.licence, g ORDER BY p), -1) AS prev FROM h JOIN c ON h.text = c.text AND h.licence = c.licence),
s AS (SELECT i.text, i.licence, i.p, j.p - i.p + 1 AS size, sum((j.prev < i.p)::INT) OVER (PARTITION BY i.text, i.licence, i.p ORDER BY j.p) AS x, row_number() OVER (PARTITION BY i.text, i.licence, i.p ORDER BY j.p) AS c, len(t.b) AS n
  FROM k i JOIN k j ON i.text = j.text AND i.licence = j.licence AND j.p >= i.p JOIN t ON t.licence = i.licence WHERE j.p - i.p < t.longest),
m AS (SELECT text, licence, p, size, n AS of, 2 * x / (x + size - c + n) AS dice FROM s WHERE 2 * x / (x + size - c + n) >= {THRESHOLD} - 1e-12),
best AS (SELECT text, licence, dice, p, size, count(DISTINCT licence) OVER (PARTITION BY text) AS n FROM m QUALIFY row_number() OVER (PARTITION BY text ORDER BY dice DESC, of DESC, licence, p, size DESC) = 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_matches, licence, round(dice, 6) AS dice, p::BIGINT AS word, (size + 1)::BIGINT AS n_words
FROM documents LEFT JOIN best ON coalesce(documents.text, '') = best.text
"""


SQL = _sql()
