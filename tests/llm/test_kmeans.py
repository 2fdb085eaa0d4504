import hashlib

import numpy as np
import pytest

from mktpanel.llm import kmeans


def brute(rows, k, rounds, scale, dims):
    """Plain rounds over all distances, in Python integers."""
    good = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows
            if i is not None and v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(good, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    at = [list(v) for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(at))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in good]
        for c in range(len(at)):
            mine = [v for (_, v), o in zip(good, own) if o == c]
            if mine:
                at[c] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [nearest(v) for _, v in good]
    total = sum(d for d, _ in last)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted((i, c, d, sum(e for e, o in last if o == c), total, names[c]) for (i, _), (d, c) in zip(good, last))


def run(spark, rows, k=5, rounds=6, scale=16, dims=3, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for name in ("id", "vec", "block", "near", "cluster"):
        df = df.withColumn(name, df.vec_id)
    return sorted(map(tuple, kmeans.cluster(df, k, rounds, scale, dims, **more).collect()))


def test_equals_plain_rounds_with_ties_and_copies(spark):
    rng = np.random.default_rng(11)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, size=3) / 4]) for i in range(120)]   # many equal distances
    rows += [(200 + i, [0.25, 0.25, 0.25]) for i in range(80)]                              # one large group of copies
    rows += [(7, rows[7][1])] * 5                                                            # repeated rows
    assert run(spark, rows, block=16) == brute(rows, 5, 6, 16, 3)


def test_edge_cases(spark):
    rows = [(1, [0.5, 0.0, 1.0]), (2, None), (3, [1.0, 2.0]), (4, [1.0, None, 0.0]), (5, [float("nan"), 0.0, 0.0]),
            (6, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (8, [-0.01, 0.0, 0.0]), (8, [-0.01, 0.0, 0.0])]
    assert run(spark, rows) == brute(rows, 5, 6, 16, 3)          # fewer vectors than centroids
    assert run(spark, rows[:1]) == brute(rows[:1], 5, 6, 16, 3)
    assert run(spark, rows[:0]) == [] and run(spark, rows[1:3]) == []
    far = run(spark, [(1, [3e38, 0.0, 0.0]), (2, [-3e38, 0.0, 0.0])], k=1, rounds=1)
    assert [r[2] for r in far] == [kmeans.LIMIT ** 2, kmeans.LIMIT ** 2]
    with pytest.raises(ValueError):
        run(spark, rows, dims=1000)


def test_bounds_spare_distances():
    rng = np.random.default_rng(2)
    middles = rng.integers(-4000, 4000, size=(20, 16))
    x = (middles[rng.integers(0, 20, size=4000)] + rng.integers(-60, 60, size=(4000, 16))).astype(np.int64)
    now = kmeans.Centroids(x[:20].copy())
    state, first = now.assign(x, now.fresh(len(x)))
    total = first
    for _ in range(8):
        at = np.array([x[state["near"] == c].sum(0) // max(1, (state["near"] == c).sum()) for c in range(20)])
        now = kmeans.Centroids(at, now.at)
        state, n = now.assign(x, state)
        total += n
        d = ((x[:, None, :] - at[None]) ** 2).sum(2)
        assert (state["near"] == d.argmin(1)).all()
        rest = np.sort(d, axis=1)
        assert (state["upper"] >= np.sqrt(rest[:, 0])).all() and (state["lower"] <= np.sqrt(rest[:, 1])).all()
    assert total < 9 * 4000 * 20 / 3


def test_rounds_move_no_vector(spark):
    """The join of vectors and bounds reads matching buckets: no exchange."""
    buckets = kmeans._Buckets(spark)
    df = spark.range(64).selectExpr("id as block", "cast('x' as binary) as vecs", "cast('x' as binary) as ids")
    one = spark.table(buckets.write(df.repartition(buckets.n, "block")))
    two = spark.table(buckets.write(df.select("block", df.vecs.alias("near"))))
    plan = one.join(two.hint("merge"), "block")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    buckets.drop()
