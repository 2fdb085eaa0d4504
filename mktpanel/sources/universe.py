"""Symbol universes (S7) and asset class (F1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mktpanel.functions import fixed

_LISTS = {"dow": fixed.DOW_30, "euro": fixed.EURO_STOXX_50, "crypto": fixed.CRYPTO}


def index_members(spark: SparkSession) -> DataFrame:
    """index_members(symbol, index_name, asset_class) for the built-in universes.

    The euro list names one symbol twice; the universe is a set, so each
    (symbol, index) appears once.  89 rows at most: safe to broadcast.
    """
    rows, seen = [], set()
    for name, symbols in _LISTS.items():
        for s in symbols:
            if (s, name) not in seen:
                seen.add((s, name))
                rows.append((s, name, "crypto" if name == "crypto" else "company"))
    return spark.createDataFrame(rows, "symbol string, index_name string, asset_class string")


def universe(members: DataFrame, index_name: str) -> DataFrame:
    """Members of one index.  Unknown names raise, as a run with a bad index must."""
    if index_name not in fixed.INDEX_LABELS:
        raise ValueError("Invalid index name")
    return members.where(F.col("index_name") == index_name).select("symbol", "index_name", "asset_class")


def with_asset_class(df: DataFrame, members: DataFrame) -> DataFrame:
    """Attach ``asset_class`` (F1): ``crypto`` for crypto members, else ``company``.

    Members hold one row per (symbol, index); the class per symbol is reduced
    first so the join cannot multiply rows; Spark broadcasts it if it is small.
    """
    cls = (members.groupBy("symbol")
                  .agg(F.max(F.when(F.col("asset_class") == "crypto", 1).otherwise(0)).alias("_c")))
    out = df.join(cls, "symbol", "left")
    return out.withColumn("asset_class", F.when(F.col("_c") == 1, F.lit("crypto")).otherwise(F.lit("company"))).drop("_c")
