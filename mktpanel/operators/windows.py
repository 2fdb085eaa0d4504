"""Window operators over weekly rows.

Each symbol has one row per week, so a symbol window holds at most the
number of weeks in the run: bounded by the calendar, not by data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def history_window(df: DataFrame, col: str, max_weeks: int, out: str = "history",
                   by: str = "symbol", order: str = "week_idx") -> DataFrame:
    """Up to ``max_weeks`` earlier values of ``col``, oldest first."""
    if max_weeks < 1:
        raise ValueError("max_weeks must be >= 1")
    w = Window.partitionBy(by).orderBy(order).rowsBetween(-max_weeks, -1)
    return df.withColumn(out, F.collect_list(col).over(w))


def history_join(df: DataFrame, col: str, max_weeks: int, out: str = "history",
                 by: str = "symbol", order: str = "week_idx") -> DataFrame:
    """``history_window`` for texts of any size (W1): only keys pass the window by ``by``.

    Each row's key meets the keys of up to ``max_weeks`` earlier rows; the
    pairs are joined to the texts and gathered by (``by``, ``order``), so a hot
    symbol's texts lie in as many partitions as it has weeks.  Keys are unique;
    ``df`` is read three times, so give it a written table.
    """
    if max_weeks < 1:
        raise ValueError("max_weeks must be >= 1")
    w = Window.partitionBy(by).orderBy(order).rowsBetween(-max_weeks, -1)
    pairs = df.select(by, order).select(by, order, F.collect_list(order).over(w).alias("_keys"))
    pairs = pairs.select(by, order, F.explode("_keys").alias("_earlier"))
    texts = df.where(F.col(col).isNotNull()).select(by, F.col(order).alias("_earlier"), F.col(col).alias("_text"))
    lists = (pairs.join(texts, [by, "_earlier"]).groupBy(by, order)
                  .agg(F.array_sort(F.collect_list(F.struct("_earlier", "_text"))).alias("_l")))
    texts_of = F.transform(F.coalesce("_l", F.array().cast(lists.schema["_l"].dataType)), lambda e: e["_text"])
    return df.join(lists, [by, order], "left").withColumn(out, texts_of).drop("_l")


def history_gate(df: DataFrame, min_weeks: int, order: str = "week_idx") -> DataFrame:
    """No output for the first ``min_weeks`` weeks (W2); applied after the window."""
    if min_weeks < 0:
        raise ValueError("min_weeks must be >= 0")
    return df.where(F.col(order) >= min_weeks)


def chrono_split(df: DataFrame, ratio: float, by: str = "symbol", order: str = "week_idx",
                 out: str = "split") -> DataFrame:
    """Per symbol, the first ``round(ratio * n)`` rows (half-to-even) are train, the rest test."""
    w_all = Window.partitionBy(by)
    w = Window.partitionBy(by).orderBy(order)
    n = F.count(F.lit(1)).over(w_all)
    train = F.bround(F.lit(float(ratio)) * n, 0)
    return df.withColumn(out, F.when(F.row_number().over(w) <= train, F.lit("train")).otherwise(F.lit("test")))


def lag_in_blocks(df: DataFrame, col: str, n: int, out: str, by: str = "symbol", order: str = "week_idx",
                  block: int = 64) -> DataFrame:
    """``lag(col, n)`` over the rows of ``by`` in ``order`` (W3), without a window over all of them.

    Rows are taken in blocks of ``block`` values of ``order``.  The first rows
    of a block look back into the last ``n`` values of the blocks before it,
    which come from one row per block.  Keys are unique; ``df`` is read twice,
    so give it a written table.
    """
    rows = df.withColumn("_block", F.floor(F.col(order) / block))
    value = F.struct(F.col(col).alias("v"))       # a NULL is a value too
    inside = Window.partitionBy(by, "_block").orderBy(order)
    rows = rows.withColumn("_near", F.lag(value, n).over(inside)).withColumn("_place", F.row_number().over(inside))
    tails = rows.groupBy(by, "_block").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("s")))).alias("_all"))
    tails = tails.select(by, "_block", F.transform(F.slice("_all", -F.least(F.lit(n), F.size("_all")), n), lambda e: e["s"]).alias("_tail"))
    blocks = Window.partitionBy(by).orderBy("_block")
    none = F.array().cast(tails.schema["_tail"].dataType)
    # Each block before has a row at least, so n blocks reach far enough.
    past = F.concat(*[F.coalesce(F.lag("_tail", i).over(blocks), none) for i in range(n, 0, -1)])
    past = tails.select(by, "_block", past.alias("_past"))
    far = F.try_element_at("_past", (F.col("_place") - n - 1).cast("int"))
    out_value = F.when(F.col("_place") > n, F.col("_near")).otherwise(far)
    return rows.join(past, [by, "_block"]).withColumn(out, out_value["v"]).drop("_block", "_near", "_place", "_past")


def train_cutoffs(keys: DataFrame, ratio: float, by: str = "symbol", order=("week_idx",)) -> DataFrame:
    """Per symbol the last key of its train rows: ``(by, _cut struct<order...>)``, NULL where none is train.

    An exact order statistic by counting: rows are counted per key before the
    shuffle, and the key at which the running count reaches
    ``round(ratio * n)`` (half-to-even) is the cutoff.
    """
    counts = keys.groupBy(by, *order).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    n = F.sum("_n").over(Window.partitionBy(by))
    train = F.bround(F.lit(float(ratio)) * n, 0)
    first = counts.withColumn("_train", upto - F.col("_n") < train)
    return first.groupBy(by).agg(F.max(F.when(F.col("_train"), F.struct(*order))).alias("_cut"))
