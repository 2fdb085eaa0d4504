from collections import Counter
from math import log, sqrt

from pyspark.sql import functions as F

from mktpanel.llm import licenses as L
from mktpanel.llm.queries import QUERIES

FILES = [
    (1, "p/LICENSE", "Released under the MIT License."), (2, "p/a/x.c", "code words only"),
    (3, "p/a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
    (4, "p/a/b/c/y.c", "more words here"), (5, "p/a/z.c", "int x = 1 ; int y = 2 ; return x + y ;\nLicensed under the Apache License, Version 2.0.\nmore"),
    (6, "q/w.c", "plain"), (7, None, "plain"), (8, "top.txt", "plain"), (9, "p/a/b/c/y.c", None), (9, "p/a/b/c/y.c", None),
    (10, "r/notes.txt", "All rights reserved."), (11, "r/s/t/u.c", "x " * 50000 + "\nLicensed under CC BY-NC 4.0.\n" + "y " * 50000),
    (12, "p/a/b/c/license.md", ""),
]


def test_own_and_inherited(spark):
    files = spark.createDataFrame(FILES, "id long, path string, text string").withColumn("dir", F.lit("x"))
    got = {r.id: (r.license, r.how, r.from_path) for r in L.scan_licences(files).collect()}
    assert got == {
        1: ("MIT", "own", "p/LICENSE"), 2: ("MIT", "inherited", "p/LICENSE"), 3: ("GPL-3.0", "own", "p/a/b/COPYING"),
        4: ("GPL-3.0", "inherited", "p/a/b/COPYING"), 5: ("Apache-2.0", "own", "p/a/z.c"), 6: (None, "none", None),
        7: (None, "none", None), 8: (None, "none", None), 9: ("GPL-3.0", "inherited", "p/a/b/COPYING"),
        10: ("Proprietary", "own", "r/notes.txt"), 11: ("CC-BY-NC-4.0", "own", "r/s/t/u.c"),
        12: ("GPL-3.0", "inherited", "p/a/b/COPYING")}
    assert L.scan_licences(files).count() == len(FILES)
    assert L.scan_licences(files.limit(0)).count() == 0


def test_root_licence_and_ties(spark):
    rows = [(1, "COPYING", "Released under the MIT License."), (2, "LICENSE", "Released under the MIT License."), (3, "a/b/c.c", "x")]
    got = {r.id: r.from_path for r in L.scan_licences(spark.createDataFrame(rows, "id long, path string, text string")).collect()}
    assert got == {1: "COPYING", 2: "LICENSE", 3: "COPYING"}


def brute(text, idf, other):
    """Best dense cosine of any line to any notice."""
    best = (0.0, None)
    for line in (text or "").split("\n"):
        a = {t: k * idf.get(t, other) for t, k in Counter(L.terms(line)).items()}
        for name, notices in L.TEMPLATES.items():
            for n in notices:
                b = {t: k * idf[t] for t, k in Counter(L.terms(n)).items()}
                dot = sum(x * b.get(t, 0) for t, x in a.items())
                c = dot / sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values())) if dot else 0.0
                if c >= L.MIN_COSINE and c > best[0] + 1e-9:
                    best = (c, name)
    return best


def test_query_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    vocabulary = L._vocabulary(L.TEMPLATES)
    df = Counter(t for r in docs for t in vocabulary & set(L.terms(r.text or "")))
    idf = {t: log((len(docs) + 1) / (df[t] + 1)) + 1 for t in vocabulary}
    other = log(len(docs) + 1) + 1
    got = {r.doc_id: r for r in QUERIES["op5_license_scan"](spark, small).collect()}
    speaks = {}
    for r in docs:
        cosine, name = brute(r.text, idf, other)
        g = got[r.doc_id]
        assert abs(g.score - cosine) < 1e-6 and (g.license if g.how == "own" else None) == name
        if g.is_licence_file:
            here = g.path.rpartition("/")[0]
            speaks[here] = min(speaks.get(here, (0, "~", "")), (-g.score, g.path, g.license))
    for g in got.values():
        if g.how != "own":
            parts = g.path.split("/")[:-1]
            above = next((speaks[x] for x in ["/".join(parts[:n]) for n in range(len(parts), -1, -1)] if x in speaks), None)
            assert (g.license, g.from_path) == ((above[2], above[1]) if above else (None, None))


MIT = """MIT License

Copyright (c) 2021 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
GPL = """/* This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */
int main;"""
WHOLE = [
    ("MIT", "m/LICENSE", MIT), ("MIT", "m/x.c", MIT.partition("\n\n")[2].partition("\n\n")[2] + "\n\nint x;"), ("MIT", "m/n.c", "MIT License"),
    ("BSD-2-Clause", "b/LICENSE", BSD), ("GPL-3.0", "g/x.c", GPL),
    ("GPL-3.0", "g/COPYING", "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\n" + "Some words of the terms here. " * 300),
    (None, "g/y.c", "GNU GENERAL PUBLIC LICENSE"), ("Apache-2.0", "a/LICENSE", "Apache License\nVersion 2.0, January 2004"),
    ("MPL-2.0", "l/x", "Mozilla Public License Version 2.0"),
    ("ISC", "i/x.c", "// Permission to use, copy, modify, and/or distribute this software for any\n// purpose with or without fee is hereby "
     "granted, provided that the above\n// copyright notice and this permission notice appear in all copies.\n"),
    (None, "p/x.txt", "The permission was granted to the person with the conditions of the notice and the software."),
]


def test_licence_texts_and_wrapped_headers(spark):
    rows = [(i, p, t) for i, (_, p, t) in enumerate(WHOLE)] + [(100 + i, f"z/{i}/f", f"word{i} and other words") for i in range(100)]
    got = {r.id: r for r in L.scan_licences(spark.createDataFrame(rows, "id long, path string, text string")).collect()}
    assert {i: got[i].license if got[i].how == "own" else None for i in range(len(WHOLE))} == {i: x[0] for i, x in enumerate(WHOLE)}
    assert got[0].is_licence_file and got[5].is_licence_file and not got[5].n_notices > 3 and got[6].from_path == "g/COPYING"


def test_weights_count_every_term(spark):
    notices = {100: "Licensed under the MIT license, see the LICENSE file for details.", 101: "Copyright 2020 Jane Doe. All rights reserved."}
    rows = [(i, None, f"see file for details copyright 2020 jane doe number{i}") for i in range(100)] + [(i, None, t) for i, t in notices.items()]
    got = {r.id: r for r in L.scan_licences(spark.createDataFrame(rows, "id long, path string, text string")).collect()}
    n, df = len(rows), Counter(t for r in rows for t in set(L.terms(r[2])))
    for i, name in ((100, "MIT"), (101, "Proprietary")):
        a = {t: k * (log((n + 1) / (df[t] + 1)) + 1) for t, k in Counter(L.terms(notices[i])).items()}
        best = 0.0
        for notice in L.TEMPLATES[name]:
            b = {t: k * (log((n + 1) / (df[t] + 1)) + 1) for t, k in Counter(L.terms(notice)).items()}
            best = max(best, sum(x * b.get(t, 0) for t, x in a.items()) / sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values())))
        assert got[i].license == name and abs(got[i].score - best) < 1e-9 and best >= L.MIN_COSINE


def test_query_has_licence_files_by_name(spark):
    got = QUERIES["op5_license_scan"](spark, "/root/testdata/sf0.01").collect()
    named = [g for g in got if g.how == "own" and g.path.rpartition("/")[2].startswith("LICENSE.")]
    assert named and all(g.is_licence_file for g in named)
    speaks = {}
    for g in got:
        if g.is_licence_file:
            here = g.path.rpartition("/")[0]
            speaks[here] = min(speaks.get(here, (0, "~", "")), (-g.score, g.path, g.license))
    inherited = 0
    for g in got:
        if g.how != "own":
            parts = g.path.split("/")[:-1]
            above = next((speaks[x] for x in ["/".join(parts[:n]) for n in range(len(parts), -1, -1)] if x in speaks), None)
            assert (g.license, g.from_path) == ((above[2], above[1]) if above else (None, None))
            inherited += above is not None
    assert inherited > 100
