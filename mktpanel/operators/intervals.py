"""Point-in-interval joins as equi-joins: intervals are covered by aligned blocks.

A block of level l is ``FAN ** l`` days that start at a multiple of that.  An
interval is the disjoint union of few of them (at most ``2 * FAN`` a level),
and a day lies in one block of each level, so a day is in the interval if and
only if exactly one of its blocks is in the cover.  The join is on (symbol,
level, block): its rows do not grow with the length of intervals, only its
result does, and a hot symbol spreads over its days.  Days meet only levels
that some cover has: with intervals of a few weeks that is one or two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mktpanel.session import materialize

FAN = 8
LEVELS = 6          # 8 ** 5 days are 90 years; longer intervals take more blocks of the last level


def day_number(day) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long")


def _range(first: Column, last: Column) -> Column:
    """first, ..., last - 1; empty if there is none."""
    return F.when(first < last, F.sequence(first, last - 1)).otherwise(F.array().cast("array<bigint>"))


def _at_level(blocks: Column, level: int) -> Column:
    return F.transform(blocks, lambda b: F.struct(F.lit(level).alias("level"), b.alias("block")))


def cover(first: Column, last: Column, fan: int = FAN, levels: int = LEVELS) -> Column:
    """Blocks ``array<struct<level, block>>`` whose disjoint union is the day numbers first..last, both inside."""
    end = last + 1
    lo = [F.ceil(first / fan ** i).cast("long") for i in range(levels)]
    hi = [F.floor(end / fan ** i).cast("long") for i in range(levels)]
    parts = []
    for i in range(levels):
        blocks = _range(lo[i], hi[i])
        if i + 1 < levels:
            # What larger blocks cover is left out.
            blocks = F.when(lo[i + 1] < hi[i + 1], F.concat(_range(lo[i], lo[i + 1] * fan), _range(hi[i + 1] * fan, hi[i]))).otherwise(blocks)
        parts.append(_at_level(blocks, i))
    return F.concat(*parts)


def interval_blocks(intervals: DataFrame, keep: list[str], fan: int = FAN) -> DataFrame:
    """(keep..., level, block): the cover of each ``[start_date, end_date]``; an interval that ends before it starts has none."""
    good = intervals.where(F.col("start_date") <= F.col("end_date"))
    blocks = F.explode(cover(day_number("start_date"), day_number("end_date"), fan)).alias("_b")
    return good.select(*keep, blocks).select(*keep, F.col("_b.level").alias("level"), F.col("_b.block").alias("block"))


def join_days_to_intervals(points: DataFrame, intervals: DataFrame, key: str, fan: int = FAN) -> DataFrame:
    """Rows of ``points`` (symbol, day, ...) with ``key``, ``start_date`` and ``end_date`` of every interval that holds them.

    The covers are written once: narrow rows, whose levels (``LEVELS`` at most)
    the driver reads to know which blocks days have to look up.
    """
    blocks = materialize(interval_blocks(intervals, ["symbol", key, "start_date", "end_date"], fan), "interval-blocks")
    levels = sorted(r.level for r in blocks.select("level").distinct().collect())
    if not levels:
        levels = [0]
    n = day_number("day")
    own = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.floor(n / fan ** i).cast("long").alias("block")) for i in levels])).alias("_b")
    asked = points.select(*points.columns, own)
    asked = asked.select(*points.columns, F.col("_b.level").alias("level"), F.col("_b.block").alias("block"))
    return asked.join(blocks, ["symbol", "level", "block"]).drop("level", "block")
