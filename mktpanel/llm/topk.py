"""Exact top-k by inner product: Fagin's threshold algorithm in blocks.

Vectors are dealt to blocks of about ``BLOCK`` rows.  A block keeps one list
per dimension, sorted by that component.  Queries come to it in batches, which
read the lists in step from the ends that their signs ask for, score each
vector when it is first met (random access, one matrix for the batch), and a
query leaves the batch once its kth score beats the bound that the components
at the present depth allow.  A vector that ties with the kth score may still
win by its id, so the search goes on until the bound is strictly lower.  The
blocks' winners are merged by rank.

Queries meet every block: that is the stated query set against all rows.  A
block's vectors are sent once, and the queries stream past them in batches of
``BATCH``, so a task holds one block and one batch however many there are.

Cases: vectors that are null, or hold null or non-finite components, take no
part; rows equal in id and vector are one query and as many candidates as
there are; an id with several vectors is several queries; a row is never its
own query's candidate, nor is another row of its id; a null id takes no part;
shorter vectors count as padded with zeros; fewer than k candidates are all
returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mktpanel.llm.common import materialize

BLOCK = 4096
BATCH = 512
FIRST_DEPTH = 32
EXACT_DOUBLE = 1 << 53


def quantised(vec: Column) -> Column:
    """floor(64 x) of every component, null where the vector takes no part."""
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                    & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when(good, F.transform(vec, lambda x: F.floor(x.cast("double") * 64).cast("long")))


class Block:
    """Sorted lists of one block and the threshold search over them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.x = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(vectors.T, self.order, axis=1)
        self.largest = int(np.abs(vectors).max(initial=0))
        self.doubles = vectors.astype(float)

    def _products(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Exact products of integer matrices, cut to a long's range."""
        most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * max(1, left.shape[1])
        if most < EXACT_DOUBLE:
            return (left.astype(float) @ right.astype(float)).astype(np.int64)
        exact = left.astype(object) @ right.astype(object)
        return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)

    def _scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Scores of some rows for each query."""
        if self.largest * int(np.abs(q).max(initial=0)) * max(1, q.shape[1]) < EXACT_DOUBLE:
            return (q.astype(float) @ self.doubles[rows].T).astype(np.int64)
        return self._products(q, self.x[rows].T)

    def _bounds(self, q: np.ndarray, depth: int) -> np.ndarray:
        """The most that a vector not met at ``depth`` can score for each query."""
        n = len(self.ids)
        return np.array([int(b) for b in (np.maximum(q, 0).astype(object) @ self.sorted[:, n - 1 - depth].astype(object)
                                          + np.minimum(q, 0).astype(object) @ self.sorted[:, depth].astype(object))], object)

    def top(self, own: np.ndarray, q: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of the block's k best for each query of a batch, best first."""
        n = len(self.ids)
        found: list = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(q)
        active = np.arange(len(q))
        seen = np.zeros(n, bool)
        depth, step = 0, FIRST_DEPTH
        while len(active):
            asks = q[active]
            upto = min(n, depth + step)
            met = np.zeros(n, bool)
            down, up = (asks > 0).any(axis=0), (asks < 0).any(axis=0)
            if (asks == 0).all(axis=1).any():
                met[:], upto = True, n      # every score of such a query is 0
            else:
                met[self.order[up, depth:upto]] = True
                met[self.order[down, n - upto:n - depth]] = True
            new = np.flatnonzero(met & ~seen)
            seen |= met
            scores, ids = self._scores(new, asks), self.ids[new]
            for a, query in enumerate(active):
                found[query] = _best(found[query], ids, scores[a], own[query], k)
            if upto == n:
                break
            bounds = self._bounds(asks, upto)
            active = np.array([i for i, b in zip(active, bounds, strict=True) if len(found[i][1]) < k or int(found[i][1][-1]) <= b], int)
            depth, step = upto, step * 2
        return found


def _best(held: tuple, ids: np.ndarray, scores: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of what is held and what is new, ties to the smaller id."""
    if len(held[1]) == k:
        some = scores >= held[1][-1]
        ids, scores = ids[some], scores[some]
    some = ids != own
    ids, scores = np.concatenate([held[0], ids[some]]), np.concatenate([held[1], scores[some]])
    if len(scores) > k:
        some = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[some], scores[some]
    first = np.lexsort((ids, ~scores))[:k]
    return ids[first], scores[first]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks()
    lengths = np.diff(flat.offsets.to_numpy()) if len(flat) else np.empty(0, int)
    values = flat.flatten().to_numpy(zero_copy_only=False)
    if len(flat) and (lengths == width).all():
        return values.reshape(-1, width).astype(np.int64)
    out = np.zeros((len(flat), width), np.int64)
    at = 0
    for i, m in enumerate(lengths):
        out[i, :m] = values[at:at + m]
        at += m
    return out


def _search(k: int, batch: int):
    """Rows sorted by block, vectors before queries -> each query's best of each block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, block, width = None, [], None, 0
        for some in batches:
            for at in range(0, some.num_rows, batch):
                rows = pa.Table.from_batches([some.slice(at, batch)])
                while rows.num_rows:
                    number = rows.column("block")[0].as_py()
                    same = int(pc.sum(pc.equal(rows.column("block"), number)).as_py())
                    part, rows = rows.slice(0, same), rows.slice(same)
                    if number != now:
                        now, held, block = number, [], None
                    vectors = part.filter(pc.invert(part.column("asks")))
                    asks = part.filter(part.column("asks"))
                    if vectors.num_rows:
                        held.append(vectors)
                    if not asks.num_rows or not held:
                        continue
                    longest = int(pc.max(pc.list_value_length(asks.column("vec"))).as_py() or 0)
                    if block is None or longest > width:
                        whole = pa.concat_tables(held)
                        width = max(longest, int(pc.max(pc.list_value_length(whole.column("vec"))).as_py() or 0))
                        block = Block(whole.column("id").to_numpy(), _matrix(whole.column("vec"), width))
                    own = asks.column("id").to_numpy()
                    found = block.top(own, _matrix(asks.column("vec"), width), k)
                    sizes = [len(ids) for ids, _ in found]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(own, sizes), pa.int64()), pa.array(np.repeat(asks.column("key").to_numpy(), sizes), pa.int64()),
                         pa.array(np.concatenate([i for i, _ in found]), pa.int64()),
                         pa.array(np.concatenate([s for _, s in found]), pa.int64())], ["query_id", "key", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
          block: int = BLOCK, batch: int = BATCH) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): each query's ``k`` best other vectors, ties to the smaller id."""
    rows = (vectors.filter(F.col(id_col).isNotNull())
                   .select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vec_col)).alias("vec"),
                           F.coalesce(is_query, F.lit(False)).alias("asks"))
                   .filter("vec is not null").withColumn("row", F.monotonically_increasing_id()))
    rows = materialize(rows, "vectors")
    blocks = max(1, -(-rows.count() // block))
    # Rows are dealt one by one, so that copies of one vector are spread as well.
    lists = rows.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), F.lit(False).alias("asks"), "id",
                        F.lit(0).cast("long").alias("key"), "vec")
    asks = rows.filter("asks").select("id", "vec").distinct()
    asks = asks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(True).alias("asks"), "id",
                       F.xxhash64("id", "vec").alias("key"), "vec")
    met = lists.unionByName(asks).repartition(F.col("block")).sortWithinPartitions("block", "asks")
    found = met.mapInArrow(_search(k, batch), "query_id long, key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "key").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                 .select("query_id", "rank", "vec_id", "score"))
