"""Exact ranks within groups of any size, without a window over a group.

Rows are range-partitioned by (group, order), so a hot group lies in many
ranges.  Within its range a row's place is the difference of two running
numbers, and one narrow row per (group, range) carries how many rows of the
group lie before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mktpanel.session import materialize


def with_group_rank(df: DataFrame, by, order, rank: str = "rank", total: str = "n") -> DataFrame:
    """``df`` with each row's ``rank`` (from 0) in its group by ``order`` (columns), and the group's ``total``.

    The rows are written with a number first: ranges are drawn from a sample,
    which would else compute ``df`` twice, and equal rows, however many, are
    told apart by a number that no lost executor changes.  NULLs come first.
    """
    keys = [*by, *order]
    numbered = materialize(df.withColumn("_read", F.monotonically_increasing_id()), "numbered")
    placed = numbered.repartitionByRange(*keys, "_read").sortWithinPartitions(*keys, "_read")
    # The running number follows the order within a range; a group's rows there are neighbours.
    placed = materialize(placed.withColumn("_at", F.monotonically_increasing_id())
                               .withColumn("_range", F.spark_partition_id()).drop("_read"), "ranked")
    runs = placed.groupBy(*by, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_m"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    runs = runs.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(by)], F.col("_range").alias("_r"), "_first",
                       (F.sum("_m").over(before) - F.col("_m")).alias("_before"),
                       F.sum("_m").over(Window.partitionBy(*by)).alias(total))
    same = F.col("_range") == F.col("_r")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_{i}"))
    out = placed.join(runs, same).withColumn(rank, F.col("_before") + F.col("_at") - F.col("_first"))
    return out.select(*df.columns, rank, total)
