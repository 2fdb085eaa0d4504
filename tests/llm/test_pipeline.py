import corpus_pipeline as C
from test_line_dedup import brute as lines_left
from test_mixing import brute as mix
from test_packing import check as check_packing
from test_simhash_dedup import classes_of, plain_fingerprint

from mktpanel.llm import quality_rules as Q
from mktpanel.llm.common import materialize, table


def test_every_stage_equals_brute_force(spark, small):
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    columns = docs.columns
    kept = {r.doc_id: r.kept for r in Q.judge(docs, labels, ["doc_id"]).collect()}
    for name, stage in C.STAGES:
        before = docs.collect()
        out = materialize(stage(spark, docs, small), "test-stage")
        after = out.collect()
        if name != "pack_sequences":
            assert out.columns == columns
        if name == "quality_rules":
            assert {r.doc_id for r in after} == {i for i, k in kept.items() if k}
        elif name == "line_dedup":
            want = lines_left(docs)
            was = {r.doc_id: r.text for r in before}
            assert len(after) == len(before)
            assert all(r.text == want[r.doc_id, was[r.doc_id]] and r.n_chars == len(r.text) for r in after)
        elif name == "simhash_near_dedup":
            roots = classes_of([int(plain_fingerprint(r.text)) for r in before], 3)
            names = {}
            for r, c in zip(before, roots):
                names[c] = min(names.get(c, r.doc_id), r.doc_id)
            assert sorted(r.doc_id for r in after) == sorted(names.values())
        elif name == "mix_sources":
            want = {d: t // n for d, n, _, _, t in mix([(r.doc_id, r.text, r.source) for r in before]) if n}
            got = {str(r.doc_id): 0 for r in after if r.text}
            for r in after:
                if r.text:
                    got[str(r.doc_id)] += 1
            assert got == {d: k for d, k in want.items() if k}
        else:
            check_packing([(r.doc_id, r.text) for r in before], after)
        docs = out


def test_run_gives_the_last_stage(spark, small):
    out = C.run(spark, small)
    assert out.columns[:3] == ["doc_id", "start", "length"] and out.count() > 0
    assert [n for n, _ in C.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "mix_sources", "pack_sequences"]


def test_stages_on_edge_cases(spark, small, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in C.STAGES:
            out = stage(spark, docs, small)
            assert out.columns == docs.columns or name == "pack_sequences"
            assert out.count() >= 0
