import math
import zlib
from itertools import groupby

import numpy as np

from mktpanel.llm import language_id as L
from mktpanel.llm.common import table


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = L.identify(docs).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    out = [r for r in rows if r.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in out]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_counts_equal_brute_force(spark):
    texts = [("en", "Hello, world 12!"), ("en", "hello"), ("de", "Grüße"), (None, "x"), ("de", None)]
    got = {(r.lang, r.gram): r.n for r in L.gram_counts(spark.createDataFrame(texts, "lang string, text string")).collect()}
    want = {}
    for lang, text in texts:
        if lang and text:
            for g, n in enumerate(L.trigram_counts(text).tolist()):
                if n:
                    want[lang, g] = want.get((lang, g), 0) + n
    assert got == want
    assert L.trigram_counts("ab cd").sum() == len(" ab cd ") - 2 and L.trigram_counts("").sum() == 0


def plain_predict(text, langs, probs):
    """Shares by expectation-maximisation over single trigrams, one after the other, in plain Python."""
    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0, 0
    # One blank for each run of other characters, and one more at both ends.
    letters = " " + "".join("".join(run) if alpha else " " for alpha, run in groupby(text.lower(), str.isalpha)) + " "
    rows = []
    for i in range(len(letters) - 2):
        a, b, c = (ord(x) for x in letters[i:i + 3])
        h = ((a * 0x9E3779B1) ^ (b * 0x85EBCA77) ^ (c * 0xC2B2AE3D)) & 0xFFFFFFFF
        h = (h ^ (h >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF
        rows.append([float(x) for x in probs[(h >> 17) & (L.BUCKETS - 1)]])

    def fit(keep, share, rounds):
        for _ in range(rounds):
            new = dict.fromkeys(keep, 0.0)
            for p in rows:
                whole = sum(share[k] * p[k] for k in keep)
                for k in keep:
                    new[k] += share[k] * p[k] / whole
            share = {k: v / sum(new.values()) for k, v in new.items()}
        return share, sum(math.log(sum(share[k] * p[k] for k in keep)) for p in rows)

    keep = list(range(len(langs)))
    share, best = fit(keep, {k: 1 / len(keep) for k in keep}, L.ROUNDS)
    while len(keep) > 1:
        weakest = min(keep, key=lambda k: share[k])
        rest = [k for k in keep if k != weakest]
        start = {k: max(share[k], 1e-6) for k in rest}
        less, value = fit(rest, {k: v / sum(start.values()) for k, v in start.items()}, L.ROUNDS // 3 if len(rest) > 1 else 0)
        if best - value > L.PENALTY * math.log(max(len(rows), 2)):
            break
        keep, share, best = rest, less, value
    top = max(keep, key=lambda k: (share[k], -k))
    return langs[top], share[top], len(keep)


def test_predictions_equal_plain_inference(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").filter("length(text) < 1500").limit(60)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows += [(-1, rows[0][1] + " " + rows[1][1] + " " + rows[2][1]), (-2, "a"), (-3, "... 12"), (-4, None)]
    langs, probs = L.train(table(spark, "/root/testdata/sf0.01", "documents").select("lang", "text"))
    got = {r.doc_id: r for r in L.predict(spark.createDataFrame(rows, "doc_id long, text string"), langs, probs).collect()}
    for doc, text in rows:
        lang, score, n = plain_predict(text, langs, probs)
        assert (got[doc].lang_pred, got[doc].n_langs) == (lang, n) and abs(got[doc].score - score) < 1e-6, doc


def test_a_very_long_text_is_one_mixture(spark):
    """Cut or not, counts are the same; a language of a small part of the text is seen in the whole."""
    docs = table(spark, "/root/testdata/sf0.01", "documents").filter("length(text) > 3000").select("lang", "text").collect()
    one = {r.lang: r.text for r in docs}
    long_text = one["en"] * (600_000 // len(one["en"])) + one["fr"][:2900] * 3
    assert len(long_text) > 2 * L.PIECE
    assert (L.trigram_counts(long_text) == L.trigram_counts(long_text, piece=10 ** 9)).all()
    assert (L.trigram_counts(long_text) == L.trigram_counts(long_text, piece=1001)).all()
    langs, probs = L.train(table(spark, "/root/testdata/sf0.01", "documents").select("lang", "text"))
    got = L.predict(spark.createDataFrame([(1, long_text)], "doc_id long, text string"), langs, probs).first()
    shares = L.mixture(L.trigram_counts(long_text), probs)
    assert got.lang_pred == "en" and got.score == shares.max() and shares[langs.index("fr")] > 0


def test_mixture_finds_shares_and_set(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    langs, probs = L.train(docs.select("lang", "text"))
    one = {r.lang: r.text for r in docs.filter("length(text) > 3000").select("lang", "text").collect()}
    both = L.mixture(L.trigram_counts(one["en"][:2000]) + L.trigram_counts(one["fr"][:1000]), probs)
    assert {langs[i] for i in np.flatnonzero(both)} == {"en", "fr"}
    assert abs(both[langs.index("en")] - 2 / 3) < 0.1
    alone = L.mixture(L.trigram_counts(one["de"]), probs)
    assert [langs[i] for i in np.flatnonzero(alone)] == ["de"]


def test_edge_cases(edge_docs, no_docs):
    rows = L.identify(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by = {r.doc_id: r for r in rows}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (3, 4, 5))
    assert by[None].held_out is False and by[10].lang_pred in ("de", "en")
    assert L.identify(no_docs).count() == 0
    assert {r.lang_pred for r in L.identify(edge_docs.withColumn("lang", edge_docs.lang.substr(9, 1)).filter("doc_id = 3"))
            .collect()} == {"und"}
