import re
from collections import Counter

from mktpanel.llm import quality_rules as Q
from mktpanel.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    ws = WORD.findall(text or "")
    windows = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    n = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered))


def check_counts(docs, got):
    expected = sorted((str(r.doc_id), *brute(r.text)) for r in docs.select("doc_id", "text").collect())
    assert sorted((str(r.doc_id), *[r[c] for c in Q.BASE]) for r in got) == expected


def test_counts_equal_brute_force(spark, small, edge_docs):
    for docs in (table(spark, small, "documents"), edge_docs):
        check_counts(docs, Q.text_stats(docs, ["doc_id"]).collect())


def test_verdicts_follow_the_learnt_list(spark, small):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    rules = Q.learn(Q.labelled_stats(docs, labels))
    assert rules and all(rules)
    rows = Q.judge(docs, labels, ["doc_id"]).collect()
    for r in rows:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        first = next((i for i, rule in enumerate(rules, 1)
                      if all((r[c.feature] > c.cut) if c.above else (r[c.feature] <= c.cut) for c in rule)), None)
        assert (r.base_failed, r.rule, r.kept) == (failed, first, not failed and first is None)
    kept = {r.doc_id: r.kept for r in rows}
    known = [r for r in labels.collect() if r.quality is not None]
    assert sum(kept[r.doc_id] for r in known if r.quality == 0) <= 0.05 * len(known)


def test_rules_cover_a_planted_conjunction(spark):
    rows = [{"bad": (i % 7 > 3) and (i % 5 > 2), "prune": i % 3 == 0, **{f: 0.0 for f in Q.FEATURES},
             "symbol_share": float(i % 7), "upper_share": float(i % 5)} for i in range(2000)]
    rules = Q.learn(spark.createDataFrame(rows).coalesce(1))
    for r in rows:
        hit = any(all((r[c.feature] > c.cut) if c.above else (r[c.feature] <= c.cut) for c in rule) for rule in rules)
        assert hit == r["bad"]


def test_edge_cases(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 0), (99, 0)], "doc_id long, quality int")
    assert Q.judge(edge_docs, labels, ["doc_id"]).count() == edge_docs.count()
    kept = Q.keep_good(edge_docs, labels)
    assert kept.columns == edge_docs.columns and {r.doc_id for r in kept.collect()} == set()
    assert Q.judge(no_docs, labels.limit(0), ["doc_id"]).count() == 0
    assert Q.judge(edge_docs, labels.limit(0), ["doc_id"]).filter("rule is not null").count() == 0
