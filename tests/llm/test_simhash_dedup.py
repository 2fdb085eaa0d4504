import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from mktpanel.llm import simhash_dedup as S
from mktpanel.llm.common import table
from mktpanel.llm.components import components
from mktpanel.llm.hamming import Classes, GrayIndex, gray_rank, near_links


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or ([" ".join(ws)] if ws else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes_of(values, bits):
    up = list(range(len(values)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= bits:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def check(docs):
    plain = docs.select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in plain]
    roots = classes_of(fps, 3)
    names = {}
    for r, c in zip(plain, roots):
        if r.doc_id is not None:
            names[c] = min(names.get(c, r.doc_id), r.doc_id)
    want = sorted(((str(r.doc_id), f"{fp:016x}", names.get(c)) for r, fp, c in zip(plain, fps, roots)), key=str)
    got = sorted(((str(r.doc_id), r.fingerprint, r.component_id) for r in S.near_duplicates(docs).collect()), key=str)
    assert got == want


def test_equals_brute_force(spark, small, edge_docs, no_docs):
    check(table(spark, small, "documents"))
    check(edge_docs)
    assert S.near_duplicates(no_docs).count() == 0


def clustered(n, seed=2):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(12)]
    out = set()
    while len(out) < n:
        v = rng.choice(centres)
        for _ in range(rng.randrange(0, 5)):
            v ^= 1 << rng.randrange(64)
        out.add(v)
    return sorted(out)


def test_index_finds_every_pair():
    values = clustered(400)
    fps = np.array(values, np.uint64)
    keys = np.array([v % 2 for v in values])
    index = GrayIndex(keys, fps)
    found = {tuple(sorted((int(index.order[i]), int(index.order[j])))) for a, b in index.pairs(3) for i, j in zip(a, b)}
    want = {(i, j) for j in range(400) for i in range(j)
            if keys[i] == keys[j] and bin(values[i] ^ values[j]).count("1") <= 3}
    assert found == want
    skipping = Classes(index)
    for a, b in index.pairs(3, skipping.joined):
        skipping.link(a, b)
    plain = Classes(index)
    for a, b in index.pairs(3):
        plain.link(a, b)
    assert (skipping.label == plain.label).all()


def test_index_prunes_groups():
    fps = np.random.default_rng(0).integers(0, 2 ** 63, 4000).astype(np.uint64)
    index, met = GrayIndex(np.zeros(4000, int), fps), []
    index._fixed_differences = lambda level, a, b, f=index._fixed_differences: met.append(len(a) * (level == 0)) or f(level, a, b)
    list(index.pairs(3))
    assert sum(met) < 0.7 * 4000 * 4000 / 2


def test_gray_rank_orders_neighbours():
    codes = np.array([i ^ (i >> 1) for i in range(256)], np.uint64)
    assert gray_rank(codes).tolist() == list(range(256))


def test_links_join_the_same_classes_with_hot_buckets(spark):
    values = clustered(300)
    df = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    at = {int(np.uint64(v).astype(np.int64)): i for i, v in enumerate(values)}
    want = classes_of(values, 3)
    for hot in (10 ** 6, 3):
        linked = components(near_links(df, 3, hot_bucket=hot)).collect()
        group = {}
        for r in linked:
            group.setdefault(r.root, set()).add(at[r.node])
        plain = {}
        for i, c in enumerate(want):
            plain.setdefault(c, set()).add(i)
        assert sorted(map(sorted, group.values())) == sorted(sorted(g) for g in plain.values() if len(g) > 1)


def test_components_of_paths_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 500 + i) for i in range(1, 100)] + [(7, 7), (900, 901), (901, 900)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(201)}, **{500 + i: 500 for i in range(100)}, 900: 900, 901: 900}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_each_class_stays(spark, edge_docs, no_docs, small):
    for docs in (edge_docs, table(spark, small, "documents")):
        whole = S.near_duplicates(docs).collect()
        kept = S.keep_first(docs)
        assert kept.columns == docs.columns
        fps = {plain_fingerprint(r.text) for r in kept.collect()}
        assert len(fps) == kept.count()
        groups = classes_of([int(f, 16) for f in sorted({r.fingerprint for r in whole})], 3)
        assert kept.count() == len(set(groups))
    assert S.keep_first(no_docs).count() == 0
