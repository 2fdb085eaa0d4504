import numpy as np
from pyspark.sql import functions as F

from mktpanel.llm import topk


def brute(rows, k, asks):
    """All scores; equal rows are one query and as many candidates as there are."""
    good = [(i, tuple(int(np.floor(64 * float(np.float32(x)))) for x in v)) for i, v in rows if i is not None and v is not None
            and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v in set(good):
        if not asks(i):
            continue
        s = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in good if j != i)[:k]
        out += [(i, r, j, -score) for r, (score, j) in enumerate(s, 1)]
    return sorted(out)


def run(spark, rows, k=5, **sizes):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 3 == 0, k, **sizes).collect()))


def test_equals_brute_force_over_many_blocks(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(60)]       # a large group of equal vectors: ties by id
    assert run(spark, rows, block=50, batch=7) == brute(rows, 5, lambda i: i % 3 == 0)


def test_search_stops_before_the_lists_end():
    rng = np.random.default_rng(1)
    x = rng.integers(-5, 6, size=(4000, 3))
    x[:20] = [40, 40, 40]
    block = topk.Block(np.arange(4000), x)
    scored = []
    block._scores = lambda rows, q, f=block._scores: scored.append(len(rows)) or f(rows, q)
    (ids, _), (other, _) = block.top(np.array([-1, 3]), np.array([[3, 2, 1], [1, 1, 1]]), 10)
    assert other.tolist() == [i for i in range(11) if i != 3]
    assert ids.tolist() == list(range(10)) and sum(scored) < 1000


def test_edge_cases(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (3, None), (6, [float("nan"), 1.0]), (9, [None, 1.0]), (None, [1.0, 1.0]),
            (1, [0.0, 0.0]), (2, [float("inf"), 0.0]), (12, [0.0, 0.0]), (4, [-0.01, 0.5])]
    assert run(spark, rows) == brute(rows, 5, lambda i: i % 3 == 0)
    assert run(spark, rows[:0]) == []
    assert run(spark, [(0, [1.0])]) == []
    mixed = run(spark, [(0, [1.0, 1.0, 1.0]), (1, [1.0]), (2, [])])
    assert mixed == [(0, 1, 1, 4096), (0, 2, 2, 0)]


def test_repeated_rows_are_candidates_and_spread(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(30)] + [(5, [9.0, 9.0])] * 50 + [(9, [2.0, 1.0])] * 2
    assert run(spark, rows, k=8, block=10, batch=4) == brute(rows, 8, lambda i: i % 3 == 0)
    got = run(spark, rows, k=8, block=10, batch=4)
    assert [r[2] for r in got if r[0] == 0] == [5] * 8


def test_exact_beyond_doubles(spark):
    big = float(2 ** 24)
    rows = [(0, [big, 1.0]), (1, [big, 0.015625]), (2, [big, 0.03125])]
    assert [r[2] for r in run(spark, rows)] == [2, 1]
