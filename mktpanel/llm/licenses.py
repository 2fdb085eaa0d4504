"""License scans: TF-IDF cosine of parts of a file to notices and licence texts, then inheritance by path.

Compared with the templates are every line, every two and three lines that
follow each other, every paragraph, the first ``HEADER_LINES`` lines, and the
whole file.  Term weights are idf over all files: the document frequencies of
all terms are counted by Spark; those of the templates' terms go to the scan,
and the others are joined to the terms of the few parts that can still reach
``MIN_COSINE``.  A licence is named only if the part has its telling terms
(``TELLING``: name and version, or the words that only its text has).  A file's
own licence is that of its best part at ``MIN_COSINE`` or more.  A file whose
name is one of ``LICENCE_NAMES``, or most of whose words are on lines of such
parts, is a licence file and speaks for its directory; files without an own
licence inherit from the nearest ancestor directory that has one, found by
joining each distinct directory's ancestors with the licence directories.

Cases: a null or blank text has no own licence; a null path inherits nothing
and speaks for none; a path without a slash lies in the root directory ``""``,
which is everyone's last ancestor; of several licence files in a directory the
best score speaks, then the smaller path; ties between templates go to the
first listed; repeated rows get equal results; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from math import log, sqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktpanel.llm.common import materialize

MIN_COSINE = 0.7
HEADER_LINES = 30
TERMS_AT_ONCE = 500_000
LICENCE_NAMES = ("license", "licence", "copying", "unlicense", "notice")

# Short public licence notices by SPDX identifier.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "SPDX-License-Identifier: MIT",
            "MIT License", "The MIT License (MIT)", "This project is released under the MIT License."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
                   "Licensed under the Apache License, Version 2.0 (the \"License\");",
                   "Apache License Version 2.0, January 2004", "Apache License 2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "SPDX-License-Identifier: GPL-3.0-only", "Licensed under the GNU GPL version 3 or later.",
                "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "GNU General Public License v3.0"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.",
                "SPDX-License-Identifier: GPL-2.0-only",
                "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "GNU General Public License v2.0"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0",
                 "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause",
                     "BSD 3-Clause License"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause",
                     "BSD 2-Clause License"],
    "MPL-2.0": ["This file is subject to the terms of the Mozilla Public License, version 2.0.",
                "SPDX-License-Identifier: MPL-2.0", "Mozilla Public License Version 2.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "Licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"],
    "Proprietary": ["All rights reserved."],
}

_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions:"""
_KEEP = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
THE POSSIBILITY OF SUCH DAMAGE."""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."""
_GNU_REST = """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should
have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""
_APACHE_REST = """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

# Public licence texts and file headers, whole and by telling paragraph.
TEXTS = {
    "MIT": [f"MIT License Copyright (c) {_GRANT} {_KEEP} {_DISCLAIMER}", f"{_GRANT} {_KEEP} {_DISCLAIMER}", _GRANT],
    "ISC": [f"ISC License Copyright (c) {_ISC} {_ISC_DISCLAIMER}", _ISC],
    "BSD-3-Clause": [f"BSD 3-Clause License Copyright (c) All rights reserved. {_BSD} {_BSD_THIRD} {_BSD_DISCLAIMER}", f"{_BSD} {_BSD_THIRD}"],
    "BSD-2-Clause": [f"BSD 2-Clause License Copyright (c) All rights reserved. {_BSD} {_BSD_DISCLAIMER}", _BSD],
    "GPL-3.0": [f"{_GNU.format(3)} {_GNU_REST}", _GNU.format(3)],
    "GPL-2.0": [f"{_GNU.format(2)} {_GNU_REST}", _GNU.format(2)],
    "LGPL-3.0": [f"{_GNU.format(3)} {_GNU_REST}".replace("General", "Lesser General"), _GNU.format(3).replace("General", "Lesser General")],
    "Apache-2.0": [f"{_APACHE} {_APACHE_REST}", _APACHE],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
}

# By licence: groups of terms of which a part must have one each, and terms it must not have, for notices or else texts.
_OTHER_GNU = "lesser library affero lgpl agpl"
TELLING = {
    "MIT": [("mit", ""), ("granted sublicense", "")], "ISC": [("isc", ""), ("permission fee purpose", "sublicense")],
    "Apache-2.0": [("apache 2", "")], "GPL-3.0": [("gnu|gpl|gplv3 3|v3|gplv3", _OTHER_GNU)],
    "GPL-2.0": [("gnu|gpl|gplv2 2|v2|gplv2", _OTHER_GNU)], "LGPL-3.0": [("lesser|lgpl|lgplv3 3|v3|lgplv3", "")],
    "BSD-3-Clause": [("bsd 3", ""), ("redistribution|redistributions binary endorse", "")],
    "BSD-2-Clause": [("bsd 2", "endorse"), ("redistribution|redistributions binary", "endorse")],
    "MPL-2.0": [("mozilla|mpl 2", "")], "CC-BY-4.0": [("cc|creative by|attribution 4", "nc sa nd noncommercial sharealike")],
    "CC-BY-SA-4.0": [("cc|creative sa|sharealike 4", "nc noncommercial")],
    "CC-BY-NC-4.0": [("cc|creative nc|noncommercial 4", "sa nd sharealike")], "CC0-1.0": [("cc0", "")],
    "Proprietary": [("rights reserved", "")],
}

_TERMS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(line: str) -> list[bytes]:
    return line.lower().encode().translate(_TERMS).split()


def _vocabulary(templates: dict[str, list[str]]) -> frozenset[bytes]:
    return frozenset(t for notices in templates.values() for n in notices for t in terms(n))


def document_frequencies(texts: DataFrame) -> DataFrame:
    """(term, n): in how many texts each term occurs; the term "" stands for all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([t.decode() for t in found], pa.string()),
                                               pa.array(list(found.values()), pa.int64())], ["term", "n"])

        found: Counter[bytes] = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for text in batch.slice(at, 256).column(0).to_pylist():
                    found[b""] += 1
                    found.update(set(terms(text or "")))
                    if len(found) > TERMS_AT_ONCE:
                        yield rows()
                        found.clear()
        yield rows()

    return texts.mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _idf(n: int, df: int) -> float:
    return log((n + 1) / (df + 1)) + 1


class Matcher:
    """Cosine of parts of a text to the templates, with sparse vectors over the vocabulary."""

    def __init__(self, templates: dict[str, list[str]], n: int, frequency: dict[bytes, int]):
        self.idf = {t: _idf(n, frequency.get(t, 0)) for t in _vocabulary(templates)}
        self.vectors: list[tuple[str, dict[bytes, float]]] = []
        for name, notices in templates.items():
            for notice in notices:
                v = {t: k * self.idf[t] for t, k in Counter(terms(notice)).items()}
                norm = sqrt(sum(x * x for x in v.values()))
                self.vectors.append((name, {t: x / norm for t, x in v.items()}))
        self.telling = {name: [([frozenset(g.encode().split(b"|")) for g in need.split()], frozenset(no.encode().split()))
                               for need, no in TELLING[name]] for name in templates if name in TELLING}
        # Some term of every part that can have a name.
        self.anchors = frozenset().union(*(need[-1] if name == "Proprietary" else need[0] for name, ways in self.telling.items()
                                           for need, _ in ways))
        self.open = any(name not in TELLING for name in templates)

    def _tells(self, name: str, has: set[bytes]) -> bool:
        return name not in self.telling or any(all(g & has for g in need) and not no & has for need, no in self.telling[name])

    def part(self, part_terms: list[bytes], least: float) -> tuple[str, float, float, dict[bytes, int]] | None:
        """(licence, dot product, squared norm of the known terms, other terms) if the cosine can be ``least``."""
        counts = Counter(part_terms)
        known = {t: counts[t] * self.idf[t] for t in counts.keys() & self.idf.keys()}
        inside = sum(x * x for x in known.values())
        others = {t: k for t, k in counts.items() if t not in known}
        # A term of every text weighs 1, any other more.
        norm = sqrt(inside + sum(k * k for k in others.values()))
        if inside < least * norm * least * norm:
            return None
        name, top, may = None, 0.0, {}
        for of, vector in self.vectors:
            dot = sum(x * vector[t] for t, x in known.items() if t in vector)
            if dot > top + 1e-12 and dot >= (least - 1e-9) * norm:
                if of not in may:
                    may[of] = self._tells(of, counts.keys())
                if may[of]:
                    name, top = of, dot
        return (name, top, inside, others) if name else None

    def parts(self, text: str | None, least: float) -> tuple[list[dict], list[int]]:
        """The parts of a text that may be notices, as first and last line, and the number of terms of each line."""
        lines = [terms(x) for x in (text or "").split("\n")]
        marked = [i for i, x in enumerate(lines) if x and (self.open or not self.anchors.isdisjoint(x))]
        spans: set[tuple[int, int]] = set()
        if marked:
            for i in marked:
                spans |= {(a, a + n) for n in range(3) for a in range(i - n, i + 1)
                          if a >= 0 and a + n < len(lines) and all(lines[a:a + n + 1])}
            begin = 0
            for i in range(len(lines) + 1):
                if i == len(lines) or not lines[i]:
                    if i > begin and any(begin <= m < i for m in marked):
                        spans.add((begin, i - 1))
                    begin = i + 1
            if marked[0] < HEADER_LINES:
                spans.add((0, min(HEADER_LINES, len(lines)) - 1))
            spans.add((0, len(lines) - 1))
        out = []
        for a, b in sorted(spans):
            found = self.part([t for x in lines[a:b + 1] for t in x], least)
            if found:
                out.append({"a": a, "b": b, "name": found[0], "dot": found[1], "inside": found[2],
                            "others": [{"term": t.decode(), "k": k} for t, k in found[3].items()]})
        return out, [len(x) for x in lines]


def own_licences(files: DataFrame, matcher: Matcher, frequency: DataFrame, n: int, least: float) -> DataFrame:
    """(id, path, own, score, n_notices, is_licence_file) of rows (id, path, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("name", pa.string()), ("dot", pa.float64()),
                                   ("inside", pa.float64()),
                                   ("others", pa.list_(pa.struct([("term", pa.string()), ("k", pa.int64())])))]))
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                found = [matcher.parts(t, least) for t in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(row, row + len(found)), pa.int64()), some.column(0), some.column(1),
                     pa.array([f[0] for f in found], kind),
                     pa.array([f[1] if f[0] else [] for f in found], pa.list_(pa.int32()))],
                    ["row", "id", "path", "parts", "sizes"])
                row += len(found)

    scanned = materialize(files.mapInArrow(
        run, "row long, id long, path string, parts array<struct<a int, b int, name string, dot double, inside double, "
             "others array<struct<term string, k long>>>>, sizes array<int>"), "licence-parts")
    parts = scanned.select("row", F.posexplode("parts").alias("no", "part"))
    rest = (parts.select("row", "no", F.explode("part.others").alias("o")).select("row", "no", F.col("o.term").alias("term"), "o.k")
                 .join(frequency, "term").groupBy("row", "no")
                 .agg(F.sum(F.pow(F.col("k") * (F.log(F.lit(n + 1.0) / (F.col("n") + 1)) + 1), F.lit(2.0))).alias("rest")))
    scored = parts.join(rest, ["row", "no"], "left").withColumn(
        "cosine", F.least(F.lit(1.0), F.col("part.dot") / F.sqrt(F.col("part.inside") + F.coalesce("rest", F.lit(0.0)))))
    good = scored.filter(F.col("cosine") >= least).groupBy("row").agg(F.sort_array(F.collect_list(
        F.struct("part.a", "part.b", "part.name", "cosine"))).alias("good"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids, paths, sizes, found = (some.column(i) for i in range(4))
                out = [verdict(g or [], k) for g, k in zip(found.to_pylist(), sizes.to_pylist(), strict=True)]
                names = [(p or "").rpartition("/")[2].lower().partition(".")[0] for p in paths.to_pylist()]
                speaks = [bool(f[0]) and (f[3] or x in LICENCE_NAMES) for f, x in zip(out, names, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [ids, paths, pa.array([f[0] for f in out], pa.string()), pa.array([f[1] for f in out], pa.float64()),
                     pa.array([f[2] for f in out], pa.int32()), pa.array(speaks, pa.bool_())],
                    ["id", "path", "own", "score", "n_notices", "is_licence_file"])

    return scanned.join(good, "row", "left").select("id", "path", "sizes", "good").mapInArrow(
        judge, "id long, path string, own string, score double, n_notices int, is_licence_file boolean")


def verdict(good: list[dict], sizes: list[int]) -> tuple[str | None, float, int, bool]:
    """(licence, score, lines of notices, mostly notices) from the good parts of a file, in their order.

    A part is a notice if no part inside it is as good: a notice does not grow by the lines beside it.
    """
    if not good:
        return None, 0.0, 0, False
    first = [g["a"] for g in good]
    lines: set[int] = set()
    for i, g in enumerate(good):
        within = range(bisect_left(first, g["a"]), bisect_right(first, g["b"]))
        if not any(j != i and good[j]["b"] <= g["b"] and good[j]["cosine"] >= g["cosine"] - 1e-9 for j in within):
            lines.update(range(g["a"], g["b"] + 1))
    best = good[0]
    for g in good:
        # Of equal parts the first, and there the shortest.
        if g["cosine"] > best["cosine"] + 1e-9:
            best = g
    inside = sum(sizes[i] for i in lines)
    return best["name"], best["cosine"], sum(sizes[i] > 0 for i in lines), inside * 2 >= sum(sizes) > 0


def _directory(path: F.Column) -> F.Column:
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).otherwise(
        F.when(path.isNotNull(), F.lit("")))


def inherited(own: DataFrame) -> DataFrame:
    """(dir, licence, from_path) for every directory that has a speaking ancestor or speaks itself."""
    speaking = own.filter("is_licence_file and path is not null").groupBy(_directory(F.col("path")).alias("above")).agg(
        F.min_by(F.struct(F.col("own").alias("licence"), F.col("path").alias("from_path")),
                 F.struct(-F.col("score"), F.col("path"))).alias("said"))
    dirs = own.filter("own is null and path is not null").select(_directory(F.col("path")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    lines = dirs.select("dir", F.posexplode(F.concat(
        F.array(F.lit("")), F.when(F.col("dir") != "", F.transform(
            F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/")))
        .otherwise(F.array().cast("array<string>")))).alias("depth", "above"))
    return (lines.join(speaking, "above").groupBy("dir").agg(F.max_by("said", "depth").alias("said"))
                 .select("dir", "said.licence", "said.from_path"))


def scan_licences(files: DataFrame, templates: dict[str, list[str]] | None = None, least: float = MIN_COSINE) -> DataFrame:
    """One row per file (id, path, text): id, path, license, score, how (own, inherited, none), from_path, n_notices."""
    if templates is None:
        templates = {name: TEMPLATES.get(name, []) + TEXTS.get(name, []) for name in [*TEMPLATES, "ISC"]}
    files = files.select(F.col("id").cast("long").alias("id"), F.col("path").cast("string").alias("path"),
                         F.col("text").cast("string").alias("text"))
    frequency = materialize(document_frequencies(files.select("text")), "term-counts")
    known = {r["term"].encode(): r["n"] for r in
             frequency.filter(F.col("term").isin("", *(t.decode() for t in _vocabulary(templates)))).collect()}
    n = known.pop(b"", 0)
    own = materialize(own_licences(files, Matcher(templates, n, known), frequency, n, least), "own-licences")
    above = inherited(own).withColumnRenamed("dir", "__dir")
    rows = own.join(above, own["own"].isNull() & (_directory(own["path"]) == F.col("__dir")), "left")
    return rows.select("id", "path", F.coalesce("own", "licence").alias("license"), "score",
                       F.when(F.col("own").isNotNull(), "own").when(F.col("licence").isNotNull(), "inherited")
                       .otherwise("none").alias("how"),
                       F.when(F.col("own").isNotNull(), F.col("path")).otherwise(F.col("from_path")).alias("from_path"),
                       "n_notices", "is_licence_file")
