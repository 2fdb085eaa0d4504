"""Links between 64-bit fingerprints that differ in few bits.

``GrayIndex`` is a Gray-order hierarchical index over many buckets at once:
the fingerprints of a bucket are sorted by Gray rank, so neighbours share long
bit patterns; every eight consecutive nodes get a parent that keeps the bits
on which all members agree (a mask and a pattern, held as the AND and the OR
of the members).  A search walks pairs of nodes from the roots down and counts
the bits that are fixed on both sides and differ; a pair of whole groups is
dropped as soon as that count passes the limit.

``near_links`` spreads the index over a cluster.  Two fingerprints at up to
``max_bits`` differing bits agree on at least one of ``max_bits + 1`` blocks of
the 64 bits, so the rows are dealt by (block, value): each such bucket is one
tree whose root has the block's bits as its shared pattern.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mktpanel.llm.common import batches_by_key, releasing

FAN_OUT = 8
PAIRS_AT_ONCE = 16_384
# A bucket with more rows is dealt again by blocks of its remaining bits.
HOT_BUCKET = 200_000
MAX_SPLITS = 2


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """Position of each uint64 in the Gray sequence."""
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Index over fingerprints ``fps`` (uint64) dealt to buckets ``keys``.

    ``order`` sorts the input by (bucket, Gray rank); node numbers of level 0
    are positions in that order.
    """

    def __init__(self, keys: np.ndarray, fps: np.ndarray):
        self.order = np.lexsort((gray_rank(fps), keys))
        keys, fps = keys[self.order], fps[self.order]
        self.fps = fps
        self.ands, self.ors, self.first = [fps], [fps], []
        while len(keys):
            new = np.ones(len(keys), bool)
            new[1:] = keys[1:] != keys[:-1]
            begin = np.flatnonzero(new)
            if len(begin) == len(keys):
                break
            place = np.arange(len(keys)) - np.repeat(begin, np.diff(np.append(begin, len(keys))))
            starts = np.flatnonzero(place % FAN_OUT == 0)
            self.first.append(np.append(starts, len(keys)))
            self.ands.append(np.bitwise_and.reduceat(self.ands[-1], starts))
            self.ors.append(np.bitwise_or.reduceat(self.ors[-1], starts))
            keys = keys[starts]

    def _fixed_differences(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ands, ors = self.ands[level], self.ors[level]
        return np.bitwise_count((ands[a] & ~ors[b]) | (ands[b] & ~ors[a]))

    def pairs(self, max_bits: int, joined=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs (a < b) of one bucket at up to ``max_bits`` bits, in chunks.

        ``joined(level, a, b)``, if given, says which node pairs need no further
        look because their members already belong to one class.
        """
        top = len(self.first)
        roots = np.arange(len(self.ands[-1]))
        work = [(top, roots, roots)]
        while work:
            level, a, b = work.pop()
            if len(a) > PAIRS_AT_ONCE:
                work += [(level, a[i:i + PAIRS_AT_ONCE], b[i:i + PAIRS_AT_ONCE])
                         for i in range(0, len(a), PAIRS_AT_ONCE)]
                continue
            if level == 0:
                if len(a):
                    yield a, b
                continue
            if joined is not None:
                keep = ~joined(level, a, b)
                a, b = a[keep], b[keep]
            first = self.first[level - 1]
            na, nb = first[a + 1] - first[a], first[b + 1] - first[b]
            n = na * nb
            which = np.repeat(np.arange(len(a)), n)
            k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            ca = first[a][which] + k // nb[which]
            cb = first[b][which] + k % nb[which]
            # Below one node each pair of children counts once; a leaf is no pair of its own.
            keep = (ca < cb) if level == 1 else (ca <= cb)
            ca, cb = ca[keep], cb[keep]
            keep = self._fixed_differences(level - 1, ca, cb) <= max_bits
            if keep.any():
                work.append((level - 1, ca[keep], cb[keep]))


class Classes:
    """Union-find over the leaves of an index, with whole-array steps."""

    def __init__(self, index: GrayIndex):
        self.index, self.label = index, np.arange(len(index.fps))
        self._uniform: list[np.ndarray] | None = None
        self._age = 0

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            la, lb = self.label[a], self.label[b]
            differ = la != lb
            if not differ.any():
                break
            a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
            np.minimum.at(self.label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up

    def joined(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """True where all members of both nodes carry one label by now."""
        if self._uniform is None or self._age >= 64:
            marks = [self.label]
            for first in self.index.first:
                low = np.minimum.reduceat(marks[-1], first[:-1])
                high = np.maximum.reduceat(marks[-1], first[:-1])
                marks.append(np.where((low == high) & (low >= 0), low, -1 - np.arange(len(low))))
            self._uniform, self._age = marks, 0
        self._age += 1
        u = self._uniform[level]
        return (u[a] == u[b]) & (u[a] >= 0) & ((a != b) | (u[a] >= 0))


def block_masks(max_bits: int, within: int = (1 << 64) - 1) -> list[int]:
    """``max_bits + 1`` masks that share out the set bits of ``within``."""
    bits = [i for i in range(64) if within >> i & 1]
    n = max_bits + 1
    cuts = [len(bits) * i // n for i in range(n + 1)]
    return [sum(1 << b for b in bits[cuts[i]:cuts[i + 1]]) for i in range(n)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _bucket(fp: Column, level: int, mask: int, salt: int) -> Column:
    # Two buckets that share a hash are searched together; distances are checked, so no false link follows.
    return F.xxhash64(F.lit(salt), F.lit(level), F.lit(_signed(mask)), fp.bitwiseAND(F.lit(_signed(mask)).cast("long")))


def with_buckets(rows: DataFrame, fp: str, max_bits: int, hot_bucket: int = HOT_BUCKET, salt: int = 0) -> DataFrame:
    """``rows`` once per block with its bucket in column ``bucket``; hot buckets are dealt again.

    Column ``block`` is the number of the block, or -1 in buckets dealt again.

    Rows of a bucket above ``hot_bucket`` rows move to the buckets of the
    blocks of their other bits: two of them at up to ``max_bits`` bits agree on
    one of those blocks as well, so no pair is lost.
    """
    tops = block_masks(max_bits)
    out = rows.withColumn("_b", F.explode(F.array(*[
        F.struct(F.lit(i).alias("m"), _bucket(F.col(fp), 0, m, salt).alias("bucket")) for i, m in enumerate(tops)])))
    out = out.select(*rows.columns, F.col("_b.m").alias("block"), F.col("_b.m").alias("_m"), F.col("_b.bucket").alias("bucket"))
    masks = list(tops)
    for level in range(1, MAX_SPLITS + 1):
        hot = out.groupBy("bucket").count().filter(F.col("count") > hot_bucket).select("bucket")
        if hot.isEmpty():
            break
        hot = hot.withColumn("_hot", F.lit(True))
        flagged = out.join(hot, "bucket", "left")
        # Rows of calm buckets have no mask to be split by and stay where they are.
        calm = flagged.filter(F.col("_hot").isNull()).withColumn("_m", F.lit(-1))
        below = [(i, sub) for i, m in enumerate(masks) for sub in block_masks(max_bits, ~m & ((1 << 64) - 1))]
        split = flagged.filter("_hot").withColumn("_b", F.explode(F.filter(F.array(*[
            F.struct(F.lit(i).alias("of"), F.lit(k).alias("m"),
                     _bucket(F.col(fp), level, masks[i] | sub, salt).alias("bucket"))
            for k, (i, sub) in enumerate(below)]), lambda x: x["of"] == F.col("_m"))))
        split = split.select(*rows.columns, F.lit(-1).alias("block"), F.col("_b.m").alias("_m"),
                             F.col("_b.bucket").alias("bucket"))
        masks = [masks[i] | sub for i, sub in below]
        out = calm.select(*split.columns).unionByName(split)
    return out.drop("_m")


def _search(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches_by_key(batches, "bucket"):
            keys = part.column("bucket").to_numpy()
            fps = part.column("fp").to_numpy().view(np.uint64)
            index = GrayIndex(keys, fps)
            classes = Classes(index)
            for a, b in index.pairs(max_bits, classes.joined):
                classes.link(a, b)
            child = np.flatnonzero(classes.label != np.arange(len(fps)))
            yield pa.RecordBatch.from_arrays([pa.array(index.fps[child].view(np.int64)),
                                              pa.array(index.fps[classes.label[child]].view(np.int64))], ["a", "b"])
    return run


def near_links(fps: DataFrame, max_bits: int, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Links (a, b) that join exactly the fingerprints reachable by steps of up to ``max_bits`` bits.

    ``fps``: one long column ``fp`` of distinct values.  Within a bucket the
    links found are reduced to a forest, so a group of n copies gives n - 1
    links per bucket rather than all pairs.  Links may repeat across buckets.
    """
    rows = with_buckets(fps.select("fp"), "fp", max_bits, hot_bucket)
    return (rows.repartition("bucket").sortWithinPartitions("bucket")
                .mapInArrow(releasing(_search(max_bits)), "a long, b long"))
