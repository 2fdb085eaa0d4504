"""Merkle manifest of a dataset: digests, inclusion proofs and checks of every row.

Each group (source) is a tree over its rows in order, and the groups' roots
are the leaves of one more tree.  A node is labelled with the interval of leaf
ranks that it covers: it is an ancestor of what its interval contains, and its
siblings are what remains of the parent's interval without its own.

Levels are taken ``LEVELS`` at a time.  A bucket of levels cuts the nodes of
its lowest level into blocks of ``FAN ** LEVELS`` neighbours, each a subtree
that one task holds whole (243 nodes).  On the way up a block gives its top
node to the next bucket; on the way down a containment join gives each block
the path of the node above that contains it.  A tree of n leaves thus takes
log(n) / LEVELS small joins; no row meets its ancestors one by one and no task
holds a group, however large it is.

Ranks come from a range partitioning by (group, order): a running count within
each range and one row of counts per (group, range).

Cases: null fields hash as ``-``; a null group is a group of its own, first; a
null id comes first in its group and is not altered; rows with one id follow
each other by digest, so repeated rows are leaves of their own; an empty text
has a digest like any other; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mktpanel.llm.common import materialize

FAN = 3
LEVELS = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

Node = tuple[int, int, str]      # first leaf rank, rank after the last, digest


def field_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def row_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ---------------------------------------------------------------- one block


def parents(nodes: list[Node], width: int) -> list[Node]:
    """The nodes whose intervals are ``width`` ranks wide (the last may be narrower) over the given ones."""
    runs: dict[int, list[Node]] = {}
    for node in nodes:
        runs.setdefault(node[0] // width, []).append(node)
    return [(run[0][0], run[-1][1], digest([h for _, _, h in run])) for run in runs.values()]


def block_levels(nodes: list[Node], base: int, end: int, n: int) -> list[list[Node]]:
    """The levels of one block, from its own nodes (level ``base`` of a tree of ``n`` leaves) to its top (``end`` at most)."""
    levels = [nodes]
    for level in range(base, end):
        if n <= FAN ** level:       # a single node remains in the tree
            break
        levels.append(parents(levels[-1], FAN ** (level + 1)))
    return levels


def steps(levels: list[list[Node]], at: int) -> list[str]:
    """``left:right`` sibling digests on the way from node ``at`` of the lowest level to the top."""
    found = []
    lo, hi, _ = levels[0][at]
    for low, high in zip(levels, levels[1:], strict=False):
        up_lo, up_hi = next((a, b) for a, b, _ in high if a <= lo and hi <= b)
        rest = [x for x in low if up_lo <= x[0] and x[1] <= up_hi and not (x[0] <= lo and hi <= x[1])]
        found.append("".join(h for _, b, h in rest if b <= lo) + ":" + "".join(h for a, _, h in rest if a >= hi))
        lo, hi = up_lo, up_hi
    return found


def fold(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its siblings lead to."""
    for step in path:
        left, right = step.split(":")
        leaf = digest([left, leaf, right])
    return leaf


# ---------------------------------------------------------------- trees


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rank`` (from 0) of each row in its ``tree`` by ``order``, and ``n``, the tree's rows."""
    placed = (rows.withColumn("uid", F.monotonically_increasing_id()).repartitionByRange("tree", *order, "uid")
                  .withColumn("part", F.spark_partition_id()))
    placed = materialize(placed, "ranges")
    sizes = placed.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("m"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    sizes = sizes.select("tree", "part", (F.sum("m").over(before) - F.col("m")).alias("base"),
                         F.sum("m").over(Window.partitionBy("tree")).alias("n"))
    inside = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order, "uid")) - 1
    return (placed.withColumn("inside", inside).join(sizes, ["tree", "part"])
                  .withColumn("rank", (F.col("base") + F.col("inside")).cast("long")).drop("part", "base", "inside", "uid"))



def _blocks(nodes: DataFrame, width: int) -> DataFrame:
    """Nodes (tree, n, lo, hi, hash, payload) -> one row per block of ``width`` ranks, its nodes in order."""
    return (nodes.groupBy("tree", "n", F.floor(F.col("lo") / width).cast("long").alias("block"))
                 .agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "hash", "payload"))).alias("kids")))


def _nodes(kids: list[dict]) -> list[Node]:
    return [(k["lo"], k["hi"], k["hash"]) for k in kids]


def _tops(base: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["tree"], r["n"], *block_levels(_nodes(r["kids"]), base, end, r["n"])[-1][0]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist([dict(zip(("tree", "n", "lo", "hi", "hash"), r, strict=True)) for r in rows],
                                             pa.schema([("tree", pa.string()), ("n", pa.int64()), ("lo", pa.int64()),
                                                        ("hi", pa.int64()), ("hash", pa.string())]))
    return run


def _paths(base: int, end: int):
    """Blocks with the path above their top -> their nodes with whole paths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tree", "lo", "hi", "hash", "payload", "path", "subroot", "root"]
        types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5]
        for batch in batches:
            for r in batch.to_pylist():
                levels = block_levels(_nodes(r["kids"]), base, end, r["n"])
                above = [r["path"]] if r["path"] else []
                rows = [(r["tree"], k["lo"], k["hi"], k["hash"], k["payload"], " ".join(steps(levels, i) + above),
                         r["subroot"], r["root"]) for i, k in enumerate(r["kids"])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
    return run


def build(leaves: DataFrame, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every bucket of levels, lowest first, and one row (tree, n, hash) per tree with its root.

    ``leaves``: tree, n, rank, hash, payload.
    """
    nodes = leaves.select("tree", "n", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "hash", "payload")
    buckets: list[DataFrame] = []
    roots: DataFrame | None = None
    while True:
        base, end = levels * len(buckets), levels * (len(buckets) + 1)
        blocks = materialize(_blocks(nodes, FAN ** end), "blocks")
        buckets.append(blocks)
        tops = materialize(blocks.mapInArrow(_tops(base, end), "tree string, n long, lo long, hi long, hash string"), "tops")
        done = F.col("n") <= FAN ** end
        ended = tops.filter(done).select("tree", "n", "hash")
        roots = ended if roots is None else roots.unionByName(ended)
        nodes = tops.filter(~done).withColumn("payload", F.lit(None).cast("string"))
        if nodes.isEmpty():
            return buckets, roots


def attach(buckets: list[DataFrame], starts: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Every leaf (tree, lo, hi, hash, payload) with its ``path``, and its tree's ``subroot`` and ``root``.

    ``starts``: one row (tree, path, subroot, root) per tree, the path of its root.
    """
    above: DataFrame | None = None
    for number in reversed(range(len(buckets))):
        base, end = levels * number, levels * (number + 1)
        width = FAN ** end
        blocks = buckets[number]
        held = blocks.filter(F.col("n") <= width).join(starts, "tree")
        if above is not None:
            # A block lies in the interval of exactly one node of the level where the buckets meet.
            up = above.select(F.col("tree").alias("up_tree"), F.floor(F.col("lo") / width).cast("long").alias("up_block"),
                              F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"), "path", "subroot", "root")
            inner = (F.col("tree") == F.col("up_tree")) & (F.col("block") == F.col("up_block")) & (
                F.col("up_lo") <= F.col("block") * width) & (F.col("block") * width < F.col("up_hi"))
            held = held.unionByName(blocks.filter(F.col("n") > width).join(up, inner)
                                          .drop("up_tree", "up_block", "up_lo", "up_hi"))
        above = held.mapInArrow(_paths(base, end), "tree string, lo long, hi long, hash string, payload string, "
                                              "path string, subroot string, root string")
        if number:
            above = materialize(above, "paths")
    return above


# ---------------------------------------------------------------- the manifest


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths -> proof digest, and the root folded from the given leaf."""
    for batch in batches:
        paths = [p.split(" ") if p else [] for p in batch.column("path").to_pylist()]
        now = batch.column("now").to_pylist()
        proof = [digest([s.replace(":", "") for s in p]) for p in paths]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("hash"), batch.column("subroot"), batch.column("root"),
             pa.array(proof, pa.string()), pa.array([fold(h, p) for h, p in zip(now, paths, strict=True)], pa.string())],
            ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])


def manifest(docs: DataFrame, altered: dict[str, Column] | None = None, group: str = "source", id_col: str = "doc_id",
             fields: tuple[str, ...] = FIELDS, levels: int = LEVELS) -> DataFrame:
    """Rows (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one per row of ``docs``.

    ``altered`` gives other values of fields for the check: the root is folded
    from the digest of the altered row and the siblings of the original tree.
    ``levels``: how many levels a bucket has.
    """
    now = [altered.get(f, F.col(f)) if altered else F.col(f) for f in fields]
    leaf = row_digest([F.col(f) for f in fields])
    # A group's name with a mark in front sorts as the group does, null first, and is never null.
    tree = F.coalesce(F.concat(F.lit("1"), F.col(group)), F.lit("0"))
    rows = docs.select(tree.alias("tree"), F.col(id_col).cast("long").alias("id"), leaf.alias("hash"),
                       row_digest(now).alias("now"))
    rows = ranked(materialize(rows, "leaves"), ["id", "hash"])
    payload = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(","),
                       F.when(F.col("now") != F.col("hash"), F.col("now")).otherwise(""))
    buckets, roots = build(rows.select("tree", "n", "rank", "hash", payload.alias("payload")), levels)
    tops = ranked(roots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "hash"), ["of"])
    above, top = build(tops.select("tree", "n", "rank", "hash", F.col("of").alias("payload")), levels)
    whole = top.select("tree", F.lit("").alias("path"), F.col("hash").alias("subroot"), F.col("hash").alias("root"))
    starts = attach(above, whole, levels).select(F.col("payload").alias("tree"), "path", F.col("hash").alias("subroot"), "root")
    found = attach(buckets, materialize(starts, "starts"), levels)
    doc = F.split("payload", ",")
    found = found.select(F.when(doc[0] != "", doc[0].cast("long")).alias("doc_id"), "hash", "subroot", "root", "path",
                         F.when(doc[1] != "", doc[1]).otherwise(F.col("hash")).alias("now"))
    out = found.mapInArrow(_checked, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def without_line_breaks(id_col: str = "doc_id", text_col: str = "text") -> dict[str, Column]:
    """The text without its line breaks where 2 divides the CRC-32 of the id in decimal."""
    pick = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return {text_col: F.when(pick, F.translate(text_col, "\n", "")).otherwise(F.col(text_col))}
