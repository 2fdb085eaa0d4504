"""Centroid clustering: exact k-means rounds with Shallot's search.

Vectors become integers, so every distance, sum and mean is exact.  A vector
keeps its nearest centroid with an upper bound of that distance and its second
nearest with a lower bound; both follow the centroids' moves by the triangle
inequality.  Where the bounds meet, both distances are computed, the search
starts from the closer of the two, and scans that centroid's neighbours in
order of distance while they lie within the sum of the distance to it and the
second smallest distance found so far: the ball shrinks as the search goes on.
Bounds are floats with a margin; whatever they leave is compared in integers.

Vectors lie in blocks of ``BLOCK`` rows, written once into a table that is
bucketed by block; a round's bounds are a second, narrow table of the same
buckets.  A round thus joins the two where they lie, moves no vector, and
hands ``k`` times the dimensions of sums per block on to be added up.  Only
centroids and their sums reach the driver: ``k`` x dimensions numbers.

Cases: vectors that are null, of another length, or hold null or non-finite
components, and null ids take no part; rows that repeat are vectors of their
own; components beyond +-``LIMIT`` count as that (so squared distances fit a
long); fewer than ``k`` vectors are as many centroids; an empty table gives no
rows; ties go to the smaller centroid number, at the start to the smaller
vector; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mktpanel.llm.common import materialize, shared_dir

BLOCK = 4096
LIMIT = 1 << 27       # dimensions * (2 * LIMIT) ** 2 stays below 2 ** 63 up to 128 dimensions
MAX_DIMS = 128
MARGIN = 1e-9         # relative; far above the rounding of a few float steps
STATE = "near int, second int, upper double, lower double"


def quantised(vec: Column, scale: int, dims: int) -> Column:
    """floor(scale x) of every component as longs, null where the vector takes no part."""
    good = (F.size(vec) == dims) & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                                            & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    cut = lambda x: F.greatest(F.lit(float(-LIMIT)), F.least(F.lit(float(LIMIT)), x.cast("double") * scale))
    return F.when(good, F.transform(vec, lambda x: F.floor(cut(x)).cast("long")))


class Centroids:
    """The centroids of one round: their numbers, mutual distances, neighbours in order, and moves since the last round."""

    def __init__(self, at: np.ndarray, before: np.ndarray | None = None):
        self.at, self.k = at, len(at)
        apart = np.sqrt(((at[:, None, :] - at[None, :, :]) ** 2).sum(2).astype(float))
        np.fill_diagonal(apart, -1.0)              # itself first, then the others by distance
        self.order = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        self.apart = apart
        self.moved = np.zeros(self.k) if before is None else np.sqrt(((at - before) ** 2).sum(1).astype(float))
        others = np.where(np.eye(self.k, dtype=bool), 0.0, self.moved[None, :])
        self.others_moved = others.max(axis=1, initial=0.0)

    def squared(self, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        return ((x - self.at[which]) ** 2).sum(1)

    def assign(self, x: np.ndarray, state: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], int]:
        """The state after this round's search, and how many distances it computed."""
        near, second = state["near"].copy(), state["second"].copy()
        if self.k == 1:
            d = np.sqrt(self.squared(x, near).astype(float))
            return {"near": near, "second": second, "upper": d, "lower": np.full(len(x), np.inf)}, len(x)
        upper = (state["upper"] + self.moved[near]) * (1 + MARGIN)
        lower = (state["lower"] - self.others_moved[near]) * (1 - MARGIN)
        rows = np.flatnonzero(~(upper < lower))
        if not len(rows):
            return {"near": near, "second": second, "upper": upper, "lower": lower}, 0
        d1 = self.squared(x[rows], near[rows])
        upper[rows] = np.sqrt(d1.astype(float)) * (1 + MARGIN)
        computed = len(rows)
        left = ~(upper[rows] < lower[rows])
        rows, d1 = rows[left], d1[left]
        y, a, b = x[rows], near[rows], second[rows]
        d2 = self.squared(y, b)
        computed += len(rows)
        swap = (d2 < d1) | ((d2 == d1) & (b < a))
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
        start, known, reach = a.copy(), b.copy(), np.sqrt(d1.astype(float))
        at = np.arange(len(rows))
        for place in range(self.k - 1):
            c = self.order[start[at], place]
            ball = (reach[at] + np.sqrt(d2[at].astype(float))) * (1 + MARGIN)
            inside = self.apart[start[at], c] <= ball
            at, c = at[inside], c[inside]          # the neighbours further on lie outside too
            if not len(at):
                break
            new = c != known[at]
            i, c = at[new], c[new]
            d = self.squared(y[i], c)
            computed += len(i)
            first = (d < d1[i]) | ((d == d1[i]) & (c < a[i]))
            other = ~first & ((d < d2[i]) | ((d == d2[i]) & (c < b[i])))
            j = i[first]
            d2[j], b[j] = d1[j], a[j]
            d1[j], a[j] = d[first], c[first]
            j = i[other]
            d2[j], b[j] = d[other], c[other]
        near[rows], second[rows] = a, b
        upper[rows] = np.sqrt(d1.astype(float)) * (1 + MARGIN)
        lower[rows] = np.sqrt(d2.astype(float)) * (1 - MARGIN)
        return {"near": near, "second": second, "upper": upper, "lower": lower}, computed

    def fresh(self, n: int) -> dict[str, np.ndarray]:
        """The state of ``n`` vectors that have met no centroid yet."""
        return {"near": np.zeros(n, np.int32), "second": np.full(n, min(1, self.k - 1), np.int32),
                "upper": np.full(n, np.inf), "lower": np.zeros(n)}


def _to_blocks(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                vec = part.column("vec")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.column("id").to_numpy(zero_copy_only=False).astype("<i8").tobytes()], pa.binary()),
                     pa.array([vec.flatten().to_numpy(zero_copy_only=False).astype("<i4").tobytes()], pa.binary())],
                    ["ids", "vecs"])
    return run


STATE_FIELDS = {"near": "<i4", "second": "<i4", "upper": "<f8", "lower": "<f8"}


def _blocks_of(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[dict, np.ndarray]]:
    for row in batch.to_pylist():
        yield row, np.frombuffer(row["vecs"], "<i4").astype(np.int64).reshape(-1, dims)


def _state_of(row: dict, n: int, centroids: Centroids) -> dict[str, np.ndarray]:
    if row.get("near") is None:
        return centroids.fresh(n)
    return {f: np.frombuffer(row[f], t) for f, t in STATE_FIELDS.items()}


def _round(centroids: Centroids, dims: int):
    """Blocks with their state -> block, new state, counts and sums of its clusters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f: [] for f in ("block", *STATE_FIELDS, "counts", "sums")}
            for row, x in _blocks_of(batch, dims):
                state, _ = centroids.assign(x, _state_of(row, len(x), centroids))
                out["block"].append(row["block"])
                for f, t in STATE_FIELDS.items():
                    out[f].append(state[f].astype(t).tobytes())
                sums = np.zeros((centroids.k, dims), np.int64)
                np.add.at(sums, state["near"], x)
                out["counts"].append(np.bincount(state["near"], minlength=centroids.k).tolist())
                out["sums"].append(sums.ravel().tolist())
            if out["block"]:
                types = [pa.int64(), *[pa.binary()] * 4, pa.list_(pa.int64()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))
    return run


def _final(centroids: Centroids, dims: int):
    """Blocks with their state -> (vec_id, cluster, distance)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, x in _blocks_of(batch, dims):
                state, _ = centroids.assign(x, _state_of(row, len(x), centroids))
                near = state["near"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(row["ids"], "<i8")), pa.array(near.astype(np.int32)),
                     pa.array(centroids.squared(x, near))], ["vec_id", "cluster", "distance"])
    return run


class _Buckets:
    """Tables of the shared folder bucketed by ``block``, so that rounds join without moving vectors."""

    def __init__(self, spark: SparkSession):
        self.spark, self.tag, self.made = spark, uuid.uuid4().hex[:12], 0
        self.n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(self, df: DataFrame) -> str:
        name = f"mktpanel_kmeans_{self.tag}_{self.made}"
        self.made += 1
        (df.write.bucketBy(self.n, "block").sortBy("block").option("path", shared_dir(self.spark, "kmeans"))
           .format("parquet").saveAsTable(name))
        return name

    def drop(self) -> None:
        """Forget the names; the files belong to the shared folder."""
        for i in range(self.made):
            self.spark.sql(f"drop table if exists mktpanel_kmeans_{self.tag}_{i}")


def centroid_sha256(row: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in row).encode()).hexdigest()


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, scale: int = 1024, dims: int = 64, seed: int = 3,
            id_col: str = "vec_id", vec_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """Rows (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of the vectors that take part.

    Centroids start as the ``k`` vectors of smallest sha256 of ``seed:vec_id``;
    each round assigns all vectors and moves non-empty centroids to the floor
    of their mean; a last assignment follows.  ``k`` and ``dims`` bound what
    the driver holds.
    """
    if dims > MAX_DIMS:
        raise ValueError(f"at most {MAX_DIMS} dimensions")
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vec_col), scale, dims).alias("vec"))
    rows = rows.filter("id is not null and vec is not null")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = np.array([r.vec for r in rows.orderBy(key, "vec").limit(k).collect()], np.int64).reshape(-1, dims)
    if not len(first):
        return _with_inertia(spark.createDataFrame([], "vec_id long, cluster int, distance long"), [], [])
    buckets = _Buckets(spark)
    blocks = (rows.mapInArrow(_to_blocks(block), "ids binary, vecs binary")
                  .withColumn("block", F.monotonically_increasing_id()))
    blocks = materialize(blocks, "blocks").repartition(buckets.n, "block")
    data = spark.table(buckets.write(blocks))
    state: DataFrame | None = None

    def seen(narrow: bool) -> DataFrame:
        wide = data.drop("ids") if narrow else data.drop("block")
        if state is None:
            return wide
        joined = data.join(state.select("block", *STATE_FIELDS).hint("merge"), "block")
        return joined.drop("ids") if narrow else joined.drop("block")

    now = Centroids(first)
    schema = ("block long, near binary, second binary, upper binary, lower binary, "
              "counts array<long>, sums array<long>")
    for _ in range(rounds):
        state = spark.table(buckets.write(seen(True).mapInArrow(_round(now, dims), schema)))
        now = Centroids(_moved(state, now.at), now.at)
    out = materialize(seen(False).mapInArrow(_final(now, dims), "vec_id long, cluster int, distance long"), "clusters")
    buckets.drop()
    inertia = dict(out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    return _with_inertia(out, [int(inertia.get(c, 0)) for c in range(now.k)], [centroid_sha256(c) for c in now.at])


def _moved(state: DataFrame, before: np.ndarray) -> np.ndarray:
    """The floor of each cluster's mean; an empty cluster's centroid stays."""
    k, dims = before.shape
    cells = (state.select(F.posexplode("counts").alias("at", "v")).withColumn("what", F.lit("n"))
                  .unionByName(state.select(F.posexplode("sums").alias("at", "v")).withColumn("what", F.lit("s"))))
    total = {(r.what, r["at"]): int(r.v) for r in
             cells.groupBy("what", "at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()}
    after = before.copy()
    for c in range(k):
        n = total[("n", c)]
        if n:
            after[c] = [total[("s", c * dims + d)] // n for d in range(dims)]
    return after


def _with_inertia(out: DataFrame, inertia: list[int], names: list[str]) -> DataFrame:
    """Cluster values looked up by number; sums beyond a long count as the largest long."""
    held = [min(x, (1 << 63) - 1) for x in inertia]
    pick = lambda values, kind: F.element_at(F.lit(values) if values else F.array().cast(f"array<{kind}>"), F.col("cluster") + 1)
    return out.select("vec_id", "cluster", "distance", pick(held, "long").cast("long").alias("cluster_inertia"),
                      F.lit(min(sum(inertia), (1 << 63) - 1)).cast("long").alias("inertia"), pick(names, "string").alias("centroid_sha256"))
