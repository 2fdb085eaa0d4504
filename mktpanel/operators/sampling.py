"""Per-group top-k and seeded sampling (K1, K2).

Both rank with ``row_number() <= k``.  Catalyst plans that as a
``WindowGroupLimit`` below the shuffle as well as above it, so each map task
forwards at most ``k`` rows per group: a hot week with millions of articles
ships ``k`` rows per task, never the whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def article_order() -> list:
    """Total order of articles within a group: date stamp, then headline, then summary."""
    return [F.col("date").asc(), F.col("headline").asc_nulls_first(), F.col("summary").asc_nulls_first()]


def top_news(df: DataFrame, k: int = 5, by=("symbol", "week_idx"), order=None, rank_col: str = "rn") -> DataFrame:
    """First ``k`` articles of each group in (date, headline, summary) order (K1)."""
    w = Window.partitionBy(*by).orderBy(*(order or article_order()))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def sample_key(seed: int, *cols) -> F.Column:
    """Deterministic pseudo-random key: md5 of the seed and the article identity."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in cols]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def sample_news(df: DataFrame, k: int = 5, seed: int = 0, by=("symbol", "week_idx"),
                identity=("date", "headline", "summary"), rank_col: str = "rn") -> DataFrame:
    """``min(k, n)`` articles per group without replacement, seeded (K2).

    Chosen articles keep their original (date) order through ``rank_col``,
    which numbers the sampled rows by (date, headline, summary).
    """
    key = sample_key(seed, *by, *identity)
    w = Window.partitionBy(*by).orderBy(key, *article_order())
    picked = df.withColumn("_pick", F.row_number().over(w)).where(F.col("_pick") <= k).drop("_pick")
    w2 = Window.partitionBy(*by).orderBy(*article_order())
    return picked.withColumn(rank_col, F.row_number().over(w2))
