import hashlib
import math
import re
from collections import Counter

from mktpanel.llm import mixing as M
from mktpanel.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water(sizes):
    """Targets by repeated resharing, as the contract tells it."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        share = {s: (left - sum(fixed.values())) * w[s] / sum(w[t] for t in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s] + 1e-9]
        if not over:
            return fixed | share
        fixed |= {s: 2.0 * sizes[s] for s in over}


def brute(rows):
    docs = []
    for doc, text, source in rows:
        size, text = len(WORD.findall(text or "")), text or ""
        signs = len(re.findall(r"[#*$%&|<>]", text))
        weight = 2.0 if signs == 0 and size >= 50 else 0.5 if signs * 20 > len(text) else 1.0
        digest = hashlib.md5(f"mix-1-{'null' if doc is None else doc}".encode()).hexdigest()
        key = -math.log((int(digest[:13], 16) + 1.0) / 2 ** 52) / weight
        docs.append((source, key, doc if doc is not None else -1, size))
    sizes = Counter()
    for s, _, _, n in docs:
        sizes[s] += n
    goal, out = water(sizes), []
    for s in sizes:
        epochs = math.floor(goal[s] / sizes[s]) if sizes[s] else 0
        rest, upto = goal[s] - epochs * sizes[s], 0
        for _, _, doc, n in sorted(d for d in docs if d[0] == s) if s is not None else sorted(
                (d for d in docs if d[0] is None), key=lambda d: d[1:]):
            upto += n
            out.append((str(doc), n, sizes[s], round(goal[s], 6), n * (epochs + (rest > 0 and upto - n / 2 <= rest))))
    return sorted(out)


def got(docs):
    return sorted((str(-1 if r.doc_id is None else r.doc_id), r["size"], r.source_size, round(r.target, 6), r.taken)
                  for r in M.taken(docs).collect())


def test_equals_brute_force(spark, edge_docs, no_docs):
    for docs in (table(spark, "/root/testdata/sf0.01", "documents"), edge_docs):
        rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        assert got(docs) == brute(rows)
    assert M.taken(no_docs).count() == 0


def test_one_heavy_source_and_reruns(spark):
    rows = [(i, "w " * (i % 90), "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = got(docs)
    assert first == brute(rows) and first == got(docs.repartition(5))
    mixed = sorted(r.doc_id for r in M.mixed(docs).collect())
    want = sorted(int(d) for d, n, _, _, t in first if n for _ in range(t // n))
    assert [d for d in mixed if rows[d][1]] == want


def test_mixed_rows_keep_their_columns(edge_docs, no_docs):
    assert M.mixed(edge_docs).columns == edge_docs.columns
    assert M.mixed(no_docs).count() == 0
