"""Licence scan: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

Every line of a file that names a licence is a header; a file that is called like a licence is one
header as a whole. Notices that are wrapped over lines, stand inside a longer line or are a whole
licence are found as windows of terms, whatever the line breaks and comment marks: wherever three
terms in a row are those of a notice, the window of its length around them is compared with it
(texts that share no three terms in a row with a notice are not). The best header or window wins, but a
notice yields to a longer one that contains it and is there as well, and a bare reservation of
rights yields to any window that names a licence. Headers and templates are sparse vectors of term frequency times inverse
document frequency over the templates (terms of no template weigh as if they were in none of them);
a header's licence is that of the nearest template, if the cosine reaches the threshold, and a file's
own licence is that of its best header. A directory has the licence of its best file that is called
like a licence and has one, else that of its best licensed file; files without a licence of their own inherit from the nearest directory above them that has one.

Only DataFrame functions are used. The scan is one pass without a shuffle; directories, not files, are
joined with their ancestors. NULL and empty texts have no licence of their own; a file with a NULL path
inherits nothing and licenses no directory. Of headers of one score the greatest licence name wins, of
licence files, or other licensed files, of a directory the best score, then the greatest name. Rows that repeat are scanned one
by one. Empty tables give empty results; other columns are never read.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import stored, whole_text

THRESHOLD = 0.6
SURE = 0.9
TERM = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
NAMES_LICENCE = r"(?i)licen[sc]e|copyright|spdx|rights reserved|public domain|unlicense|copyleft"
LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice|unlicense)(\.[a-z]+)?$"

# Notices by which the licences ask to be named.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 public domain dedication."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited. Copyright, all rights reserved."),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_3 = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission."""
_BSD_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND
ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE
USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies."""
_ISC_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES
OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_GNU = """This {0} is free software{3} you can redistribute it and/or modify it under the terms of the GNU {1} Public License as published
by the Free Software Foundation{4} either version {2} of the License, or (at your option) any later version."""
_GNU_ONLY = "under the terms of the GNU {1} Public License version {2} as published by the Free Software Foundation."
_GNU_FIT = """This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} Public License for more details."""
_GNU_KINDS = (
    ("GPL-2.0", "program", "General", "2"), ("GPL-3.0", "program", "General", "3"), ("LGPL-2.1", "library", "Lesser General", "2.1"),
    ("LGPL-3.0", "library", "Lesser General", "3"), ("AGPL-3.0", "program", "Affero General", "3"),
)

# Notices and short licences in full, and the beginnings of the long ones.
NOTICES = (
    *(x for x in TEMPLATES if len(re.findall(TERM, x[1].lower())) >= 6),
    ("MIT", _MIT),
    ("MIT", f"{_MIT} {_AS_IS}"),
    ("BSD-2-Clause", _BSD),
    ("BSD-2-Clause", f"{_BSD} {_BSD_AS_IS}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_3}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_3} {_BSD_AS_IS}"),
    ("ISC", _ISC),
    ("ISC", f"{_ISC} {_ISC_AS_IS}"),
    *((kind[0], _GNU.format(*kind[1:], ";", ";")) for kind in _GNU_KINDS),
    *((kind[0], f"{_GNU.format(*kind[1:], ';', ';')} {_GNU_FIT.format(*kind[1:])}") for kind in _GNU_KINDS),
    *((kind[0], _GNU_ONLY.format(*kind[1:])) for kind in _GNU_KINDS),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
     You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
     software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
     See the License for the specific language governing permissions and limitations under the License."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with
     this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell,
     or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""),
)

# Every notice holds one of these, across line breaks and comment marks.
NAMES_NOTICE = r"(?i)licen[sc]e|permission|redistribution|public\W+domain|unencumbered|copyright|proprietary"


def vectors(templates=TEMPLATES) -> tuple[list[tuple[str, dict[str, float]]], dict[str, float], float]:
    """Unit vectors of the templates, inverse document frequencies, and that of unknown terms."""
    terms = [Counter(re.findall(TERM, text.lower())) for _, text in templates]
    held = Counter(t for one in terms for t in one)
    idf = {t: math.log((1 + len(templates)) / (1 + n)) + 1 for t, n in held.items()}
    out = []
    for (name, _), one in zip(templates, terms, strict=True):
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in one.items()))
        out.append((name, {t: n * idf[t] / norm for t, n in one.items()}))
    return out, idf, math.log(1 + len(templates)) + 1


def best_licence(headers: Column, threshold: float = THRESHOLD, templates=TEMPLATES) -> Column:
    """struct<score, licence> of the best header of an array of texts; NULL below the threshold."""
    units, idf, unknown = vectors(templates)
    known = F.from_json(F.lit(json.dumps(idf)), "map<string,double>")
    vector = F.from_json(
        F.lit(json.dumps([{"licence": n, "terms": v} for n, v in units])), "array<struct<licence:string,terms:map<string,double>>>"
    )

    def weighted(text: Column) -> Column:
        terms = F.regexp_extract_all(F.lower(text), F.lit(f"({TERM})"), F.lit(1))

        def weight(all_terms: Column) -> Column:
            count = lambda t: F.size(F.filter(all_terms, lambda x: x == t))
            return F.transform(
                F.array_distinct(all_terms), lambda t: F.struct(t.alias("t"), (count(t) * F.coalesce(known[t], F.lit(unknown))).alias("w"))
            )

        return F.get(F.transform(F.array(terms), weight), F.lit(0))

    def add(terms: Column, value) -> Column:
        return F.aggregate(terms, F.lit(0.0), lambda total, x: total + value(x))

    def scores(terms: Column) -> Column:
        norm = F.sqrt(add(terms, lambda x: x["w"] * x["w"]))
        dot = lambda v: add(terms, lambda x: x["w"] * F.coalesce(v["terms"][x["t"]], F.lit(0.0)))
        return F.transform(vector, lambda v: F.struct(F.round(dot(v) / norm, 4).alias("score"), v["licence"].alias("licence")))

    best = F.array_max(F.flatten(F.transform(F.filter(F.transform(headers, weighted), lambda t: F.size(t) > 0), scores)))
    return F.when(best["score"] >= threshold, best)


def own_licences(df: DataFrame, path: str, text: str, threshold: float = THRESHOLD) -> Column:
    """struct<score, licence> of each file: its headers, or its whole text if it is called like a licence."""
    content = whole_text(df, text)
    lines = F.filter(F.split(content, "\n"), lambda x: x.rlike(NAMES_LICENCE))
    named = F.coalesce(df[path].rlike(LICENCE_FILE), F.lit(False))
    headers = F.when(named, F.concat(F.array(content), lines)).otherwise(lines)
    by_header = F.when(named | content.rlike(NAMES_LICENCE), best_licence(headers, threshold))
    by_window = F.when(content.rlike(NAMES_NOTICE), best_window(content, threshold))

    def better(header: Column, window: Column) -> Column:
        reserved = window.isNotNull() & (header["licence"] == "Proprietary") & (window["licence"] != "Proprietary")
        return F.when(reserved, window).otherwise(F.greatest(header, window))  # greatest skips NULL

    return _bound(by_header, lambda h: _bound(by_window, lambda w: better(h, w)))


def _bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: a lambda's variable is not computed again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def best_window(content: Column, threshold: float = THRESHOLD, notices=NOTICES) -> Column:
    """struct<score, licence> of the window of terms that is nearest to a notice; NULL below the threshold."""
    units, idf, unknown = vectors(notices)
    terms = [re.findall(TERM, text.lower()) for _, text in notices]
    starts: dict[str, set[tuple[int, int]]] = {}
    for unit, one in enumerate(terms):
        for at in range(len(one) - 2):
            starts.setdefault(" ".join(one[at : at + 3]), set()).add((unit, at))
    joined = [f" {' '.join(one)} " for one in terms]
    inside = [[i for i, x in enumerate(joined) if x != whole and x in whole] for whole in joined]
    literal = lambda value, kind: F.from_json(F.lit(json.dumps(value)), kind)
    anchors = literal({t: [{"unit": u, "at": a} for u, a in sorted(x)] for t, x in starts.items()}, "map<string,array<struct<unit:int,at:int>>>")
    vector = literal(
        [{"licence": n, "size": len(one), "terms": v, "inside": parts} for (n, v), one, parts in zip(units, terms, inside, strict=True)],
        "array<struct<licence:string,size:int,terms:map<string,double>,inside:array<int>>>",
    )
    known = literal(idf, "map<string,double>")

    def add(items: Column, value) -> Column:
        return F.aggregate(items, F.lit(0.0), lambda total, x: total + value(x))

    def score(window: Column, unit: Column) -> Column:
        count = lambda t: F.size(F.filter(window, lambda x: x == t))
        weighted = F.transform(
            F.array_distinct(window), lambda t: F.struct(t.alias("t"), (count(t) * F.coalesce(known[t], F.lit(unknown))).alias("w"))
        )
        return _bound(
            weighted,
            lambda ws: F.round(add(ws, lambda x: x["w"] * F.coalesce(unit["terms"][x["t"]], F.lit(0.0))) / F.sqrt(add(ws, lambda x: x["w"] * x["w"])), 4),
        )

    def nearest(words: Column) -> Column:
        def met(_: Column, i: Column) -> Column:
            found = anchors[F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))]
            return F.transform(found, lambda x: F.struct(x["unit"].alias("unit"), F.greatest(i - x["at"], F.lit(0)).alias("start")))

        places = F.array_distinct(F.flatten(F.filter(F.transform(words, met), lambda x: x.isNotNull())))
        compared = F.transform(
            places,
            lambda p: _bound(
                F.get(vector, p["unit"]),
                lambda unit: _bound(
                    F.slice(words, p["start"] + 1, unit["size"]),
                    lambda window: F.struct(
                        score(window, unit).alias("score"), unit["licence"].alias("licence"), p["unit"].alias("unit"), unit["inside"].alias("inside")
                    ),
                ),
            ),
        )
        return _bound(compared, whole_notices)

    def whole_notices(found: Column) -> Column:
        """The best of those that are no part of a longer notice which is there as well."""
        parts = F.array_distinct(F.flatten(F.transform(F.filter(found, lambda x: x["score"] >= SURE), lambda x: x["inside"])))
        left = _bound(parts, lambda gone: F.filter(found, lambda x: ~F.array_contains(gone, x["unit"])))
        return F.array_max(F.transform(left, lambda x: F.struct(x["score"].alias("score"), x["licence"].alias("licence"))))

    best = _bound(F.regexp_extract_all(F.lower(content), F.lit(f"({TERM})"), F.lit(1)), nearest)
    return _bound(best, lambda x: F.when(x["score"] >= threshold, x))


def parent(path: Column) -> Column:
    """The directory of a path; empty for a path without one."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(df: DataFrame, key: str, path: str, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``df``: doc_id, path, own_licence, own_score, licence, inherited_from."""
    found = df.select(df[key].alias("doc_id"), df[path].alias("path"), own_licences(df, path, text, threshold).alias("own"))
    files = stored(found.withColumn("dir", parent(F.col("path"))), "licence-files")
    # a file called like a licence speaks for its directory before any header there
    claim = F.struct(F.col("path").rlike(LICENCE_FILE).alias("named"), "own")
    licensed = files.where(F.col("own").isNotNull() & F.col("dir").isNotNull()).groupBy("dir").agg(F.max(claim).alias("best"))
    licensed = licensed.select(F.col("dir").alias("above"), F.col("best.own.licence").alias("licence"))
    # each directory once, with itself and all directories above it
    dirs = files.where(F.col("own").isNull() & F.col("dir").isNotNull()).select("dir").distinct()
    parts = F.split("dir", "/")
    chain = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("above")))
    # the empty path stands above all others; the top directory of a relative path is its first part
    chain = F.when(F.col("dir") == "", F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("above")))).otherwise(
        F.concat(F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("above"))), chain)
    )
    above = dirs.select("dir", F.inline(chain))
    nearest = above.join(licensed, "above").groupBy("dir").agg(F.max(F.struct("depth", "licence", "above")).alias("near"))
    nearest = stored(nearest.select("dir", F.col("near.licence").alias("given"), F.col("near.above").alias("from")), "licence-dirs")
    joined = files.join(nearest, "dir", "left")
    own = F.col("own.licence")
    return joined.select(
        "doc_id",
        "path",
        own.alias("own_licence"),
        F.col("own.score").alias("own_score"),
        F.coalesce(own, F.col("given")).alias("licence"),
        F.when(own.isNull(), F.col("from")).alias("inherited_from"),
    )


def scan_sql(table: str, key: str, path: str, text: str = "text", threshold: float = THRESHOLD) -> str:
    """The scan as SQL for a table whose files have no licence names."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    units, idf, unknown = vectors()
    terms = ", ".join(f"({i}, {quoted(n)}, {quoted(t)}, {w!r})" for i, (n, v) in enumerate(units) for t, w in v.items())
    known = ", ".join(f"({quoted(t)}, {w!r})" for t, w in idf.items())
    marker = quoted(NAMES_LICENCE.removeprefix("(?i)"))
    return f"""
        WITH template(unit, licence, term, weight) AS (VALUES {terms}),
        known(term, idf) AS (VALUES {known}),
        files AS (SELECT {key} AS doc_id, {path} AS path, regexp_replace({path}, '/?[^/]*$', '') AS dir, coalesce({text}, '') AS body FROM {table}),
        header AS (
            SELECT doc_id, unnest(list_distinct(list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, {marker}, 'i')))) AS line
            FROM files WHERE regexp_matches(body, {marker}, 'i')),
        term AS (
            SELECT doc_id, line, t AS term, count(*) * coalesce(max(idf), {unknown!r}) AS weight
            FROM (SELECT doc_id, line, unnest(regexp_extract_all(lower(line), {quoted(TERM)})) AS t FROM header) s LEFT JOIN known ON known.term = s.t
            GROUP BY doc_id, line, t),
        norm AS (SELECT doc_id, line, sqrt(sum(weight * weight)) AS norm FROM term GROUP BY doc_id, line),
        scored AS (
            SELECT t.doc_id, t.line, p.unit, p.licence, round(sum(t.weight * p.weight) / any_value(n.norm), 4) AS score
            FROM term t JOIN template p ON p.term = t.term JOIN norm n ON n.doc_id = t.doc_id AND n.line = t.line
            GROUP BY t.doc_id, t.line, p.unit, p.licence),
        own AS (
            SELECT doc_id, max(score) AS own_score, max_by(licence, (score, licence)) AS own_licence
            FROM scored WHERE score >= {threshold} GROUP BY doc_id),
        licensed AS (
            SELECT dir, max_by(own_licence, (own_score, own_licence)) AS licence FROM files JOIN own USING (doc_id) GROUP BY dir),
        near AS (
            SELECT f.dir, max_by(l.licence, length(l.dir)) AS licence, max_by(l.dir, length(l.dir)) AS inherited_from
            FROM (SELECT DISTINCT dir FROM files) f JOIN licensed l ON l.dir = '' OR l.dir = f.dir OR starts_with(f.dir, l.dir || '/')
            GROUP BY f.dir)
        SELECT f.doc_id, f.path, o.own_licence, o.own_score, coalesce(o.own_licence, n.licence) AS licence,
               CASE WHEN o.own_licence IS NULL THEN n.inherited_from END AS inherited_from
        FROM files f LEFT JOIN own o USING (doc_id) LEFT JOIN near n ON n.dir = f.dir"""
