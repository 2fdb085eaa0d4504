import random
import re
from itertools import combinations
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from mktpanel.llm import url_rules as U

GIVEN = {(h, p): v for v, h, p in U.GIVEN}


def parts(url):
    """Host and path by plain string search."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.split("[?#]", rest[len(host):])[0]


def plain_tokens(url):
    if url is None:
        return set()
    host, path = parts(url)
    low = re.sub("[A-Z]", lambda m: m.group().lower(), url)
    *folders, name = path.lower().split("/")
    found = {"scheme:" + (low.split("://")[0] if "://" in low else ""), "host:" + host,
             "ending:" + (name[name.rindex("."):] if "." in name else ""), "fragment" if "#" in low else "no fragment"}
    found |= {f"label{i}:{x}" for i, x in enumerate(reversed(host.split("."))) if x}
    found |= {"folder:" + x for x in folders if x}
    query = low.split("#")[0].split("?", 1)
    return found | {"key:" + k.split("=")[0] for k in (query[1].split("&") if len(query) > 1 else []) if k.split("=")[0]}


def brute(pages, labels, least, confidence):
    bad = {}
    for doc, quality, toxic in labels:
        if quality is not None or toxic is not None:
            bad[doc] = bad.get(doc, False) or quality == 0 or toxic == 1
    learn = [(plain_tokens(u), bad[i]) for i, u in {p for p in pages if p[1] is not None} if i is not None and i in bad]
    common = {t for t in set().union(*[s for s, _ in learn]) if sum(b for s, b in learn if t in s) >= least} if learn else set()
    rules = {}
    for s, b in learn:
        some = sorted(s & common)
        for n in range(1, len(some) + 1):
            for c in combinations(some, n):
                k = rules.setdefault(c, [0, 0])
                k[0] += b
                k[1] += 1
    rules = [set(c) for c, (nb, n) in rules.items() if nb >= least and nb / n >= confidence]
    out = []
    for i, u in pages:
        host, path = parts(u)
        fits = [r for r in GIVEN if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        rule = max(fits, key=lambda r: len(r[0]) + len(r[1]), default=None)
        learned = "block" if any(r <= plain_tokens(u) for r in rules) else "allow"
        out.append((i, host, path, rule and "".join(rule), GIVEN[rule] if rule else learned))
    return sorted(out, key=str), rules


def run(spark, pages, labels, **limits):
    p = spark.createDataFrame(pages, "page_id long, url string").withColumn("item", F.lit("x")).withColumn("tokens", F.lit("x"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("url", F.lit("x"))
    return sorted(map(tuple, U.judge(p, lab, **limits).collect()), key=str)


def test_planted_combination_is_found_and_matched(spark):
    """Neither the host nor the key is bad, both together are; ``spam`` is bad wherever it stands."""
    pages, labels = [], []
    for i in range(600):
        host = ["news.one.org", "two.fr", "spam.three.io", "four.de"][i % 4]
        url = f"https://{host}/{['a', 'b'][i // 4 % 2]}/{i}.html" + ["", "?promo=1", "?page=2", "#top"][i // 8 % 4]
        pages.append((i, url))
        if i % 3:
            labels.append((i, 0 if "spam" in url or ("two.fr" in url and "promo" in url) else 1, 0))
    got = run(spark, pages, labels, min_count=8)
    want, rules = brute(pages, labels, 8, U.MIN_CONFIDENCE)
    assert got == want
    assert {"host:two.fr", "key:promo"} in rules and {"host:two.fr"} not in rules and {"key:promo"} not in rules
    verdict = {i: v for i, _, _, _, v in got}
    assert all(verdict[i] == ("block" if "spam" in u or ("two.fr" in u and "promo" in u) else "allow") for i, u in pages)
    rules_df, _ = U.mine(U.labelled(spark.createDataFrame(pages, "page_id long, url string"),
                                    spark.createDataFrame(labels, "doc_id long, quality int, toxic int")), min_count=8)
    assert rules_df.count() <= 4        # one for the host, one or more for the pair; what holds them is pruned


def test_one_long_url_in_many_copies(spark):
    """Sixty folders of one URL are one item, not 2 ** 60 combinations."""
    long_url = "http://x.org/" + "/".join(f"f{i}" for i in range(60)) + "/"
    pages = [(i, long_url) for i in range(200)] + [(200 + i, f"http://y{i}.org/z/") for i in range(200)] + [(999, "http://q.org/f7/z")]
    labels = [(i, 0, None) for i in range(200)] + [(200 + i, 1, 0) for i in range(200)]
    got = {r[0]: r[4] for r in run(spark, pages, labels)}
    assert got[0] == "block" and got[300] == "allow" and got[999] == "block"


def test_edge_cases(spark):
    pages = [(1, None), (2, ""), (3, "no scheme/en/"), (4, "http://EXAMPLE.com/en/x"), (5, "http://www.example.com/en/"),
             (6, "http://a.www.Example.com/en/?q#f"), (7, "http://example.com"), (8, "http://notexample.com/en/"),
             (9, "http://net/es/"), (10, "http://x.net/EN/"), (11, "a://b.net/fr/://c.com/"), (12, "http://x.org?u=http://y.com/en/"),
             (None, "http://x.com/"), (13, "http://a.com:80/en/"), (4, "http://EXAMPLE.com/en/x"), (14, "://"), (15, "http:///en/"),
             (16, "http://ÄB.net/es/\n"), (17, "http://" + "a." * 3000 + "net/fr/" + "b/" * 3000), (18, "http://x.com./a")]
    labels = [(1, 0, 0), (4, 0, 1), (None, 0, 0), (5, None, None), (99, 0, 0), (4, 1, 0), (7, None, 1)]
    assert run(spark, pages, labels) == brute(pages, labels, 10, U.MIN_CONFIDENCE)[0]
    assert run(spark, pages, labels[:0]) == brute(pages, [], 10, U.MIN_CONFIDENCE)[0]
    assert run(spark, pages[:0], labels) == []
    assert run(spark, pages[:16], labels, min_count=1) == brute(pages[:16], labels, 1, U.MIN_CONFIDENCE)[0]


@pytest.mark.parametrize("url", ["https://a.example.org/x/y.html?k=v&l=#z", "http://h/p", "ftp://u@h:1/?&&=2&b"])
def test_parts_agree_with_the_library(spark, url):
    got = spark.range(1).select(U.host_of(F.lit(url)), U.path_of(F.lit(url)), U.tokens(F.lit(url))).first()
    split = urlsplit(url)
    assert got[0] == split.netloc and got[1] == split.path and set(got[2]) == plain_tokens(url)


def test_no_rule_is_lost_on_pages_with_more_items_than_fp_growth_takes(spark):
    """The bad combination is of the commonest items, which a cut at the rarest ones would drop."""
    rnd = random.Random(3)
    pages, labels = [], []
    for i in range(400):
        folders = [f for f, share in (("a", .8), ("b", .7), ("c", .6), ("d", .5), ("e", .4)) if rnd.random() < share]
        host, key = rnd.choice(["x.org", "y.fr", "z.de"]), rnd.choice(["", "?k=1", "?l=2&k=1"])
        pages.append((i, f"https://{host}/{'/'.join(folders + [''])}{rnd.choice(['p', 'q.html'])}{key}"))
        planted = {"a", "b", "d"} <= set(folders) or (host == "x.org" and "e" in folders and "k=1" in key)
        if i % 8:
            labels.append((i, 0 if planted and rnd.random() < .95 or rnd.random() < .1 else 1, 0))
    want, rules = brute(pages, labels, 10, U.MIN_CONFIDENCE)
    smallest = {frozenset(r) for r in rules if not any(x < r for x in rules)}
    assert len({len(r) for r in smallest}) > 2
    learn = U.labelled(spark.createDataFrame(pages, "page_id long, url string"),
                       spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    counts = learned(pages, labels)
    assert run(spark, pages, labels, max_items=3) == want
    found, index = U.mine(learn, max_items=3)
    token = {r["item"]: r["token"] for r in index.collect()}
    found = {frozenset(token[i] for i in r["items"]): r for r in found.collect()}
    # Of tokens that can't be told apart a rule names any one.
    covers = lambda s: frozenset(i for i, (has, _) in enumerate(counts) if s <= has)
    assert {covers(s) for s in found} == {covers(s) for s in smallest}
    for s, r in found.items():
        has = [b for t, b in counts if s <= t]
        assert (r["support"] * len(counts), r["confidence"]) == pytest.approx((sum(has), sum(has) / len(has)))


def learned(pages, labels):
    bad = {d: q == 0 or t == 1 for d, q, t in labels}
    return [(plain_tokens(u), bad[i]) for i, u in pages if i in bad]
