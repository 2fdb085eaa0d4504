import hashlib
import zlib

from pyspark.sql import functions as F

from mktpanel.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """Root, and the (left, right) siblings of every node on its way to it."""
    paths, spots = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(spots):
            run = nodes[at // 3 * 3:at // 3 * 3 + 3]
            paths[i].append(("".join(run[:at % 3]), "".join(run[at % 3 + 1:])))
        nodes = [h(*nodes[j:j + 3]) for j in range(0, len(nodes), 3)]
        spots = [at // 3 for at in spots]
    return nodes[0], paths


def brute(rows):
    """``rows``: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        gone = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
        now = leaf_of((*r[:4], r[4].replace("\n", "") if gone else r[4]))
        groups.setdefault(r[1], []).append(((r[0] is not None, r[0] or 0, leaf_of(r)), r[0], leaf_of(r), now))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(groups[s])]) for s in names}
    root, upper = climb([trees[s][0] for s in names]) if names else (None, [])
    out = []
    for s, above in zip(names, upper):
        sub, paths = trees[s]
        for (_, doc, leaf, now), path in zip(sorted(groups[s]), paths):
            got = now
            for left, right in path + above:
                got = h(left, got, right)
            out.append((doc, leaf, sub, root, h(*[x for p in path + above for x in p]), got, got == root))
    return sorted(out, key=str)


def check(docs, **more):
    rows = [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]
    got = merkle.manifest(docs, merkle.without_line_breaks(), **more)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_groups_of_every_height(spark):
    """Groups of 243 rows and fewer end in the first bucket of levels, the larger ones in the second."""
    sizes = {"a": 1, "b": 2, "c": 3, "d": 4, "e": 27, "f": 28, "g": 243, "h": 244, "i": 1000, None: 10, "ä": 9, "Z": 5}
    rows = [(i * 7919 % 2003 + 3000 * n, s, "en", i, f"line {i}\nof {s}" if i % 5 else "plain")
            for n, (s, m) in enumerate(sizes.items()) for i in range(m)]
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7))


def test_edge_cases(spark, edge_docs, no_docs):
    check(edge_docs.withColumn("tree", F.lit("x")).withColumn("hash", F.lit("x")).withColumn("n", F.lit("x")))
    assert merkle.manifest(no_docs).collect() == []


def test_one_row_and_one_id(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    check(spark.createDataFrame([(4, None, None, None, "a\nb")], schema))
    check(spark.createDataFrame([(4, "s", None, 1, "same")] * 300 + [(4, "s", None, 1, "other")] * 2, schema))


def test_four_buckets_of_levels(spark):
    rows = [(i, "s" if i % 3 else "t", "en", 1, f"x\n{i}") for i in range(60)]
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"), levels=1)
