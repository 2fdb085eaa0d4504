"""Connected components of a link table by alternating large-star and small-star steps.

Every step is an aggregation and a join; the links of a step are written to
the shared folder, so the plan stays short and a lost executor costs at most
one step.  No step gathers a component in one task: the minimum neighbour is
pre-aggregated and the join on a hub is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktpanel.llm.common import materialize


def _signature(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low"))
    low = low.select("u", F.least("u", "low").alias("low"))
    return (both.join(low, "u").filter(F.col("v") > F.col("u"))
                .select(F.col("v").alias("u"), F.col("low").alias("v")))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("low"))
    moved = down.join(low, "u").filter(F.col("v") != F.col("low")).select(F.col("v").alias("u"),
                                                                            F.col("low").alias("v"))
    return moved.unionByName(low.select("u", F.col("low").alias("v"))).distinct()


def components(links: DataFrame, max_steps: int = 100) -> DataFrame:
    """Rows (node, root): for every node of a link, the smallest node that it reaches.

    ``links``: columns ``a`` and ``b`` of one orderable type.  Loops, repeats
    and nulls are ignored; an empty table gives an empty result.
    """
    start = (links.filter(F.col("a") != F.col("b"))
                  .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    now = materialize(start, "links")
    seen = _signature(now)
    for _ in range(max_steps):
        if seen[0] == 0:
            break
        now = materialize(_small_star(_large_star(now)), "links")
        new = _signature(now)
        if new == seen:
            break
        seen = new
    else:
        raise RuntimeError(f"components did not settle in {max_steps} steps")
    roots = now.select(F.col("v").alias("node")).distinct()
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
               .unionByName(roots.select("node", F.col("node").alias("root"))))
