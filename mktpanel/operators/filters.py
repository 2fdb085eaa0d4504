"""Row filters and constant columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktpanel.functions import fixed


def drop_boilerplate(df: DataFrame, prefix: str = fixed.BOILERPLATE_SHORT, col: str = "summary") -> DataFrame:
    """Drop articles whose summary starts with a boilerplate prefix (F2).

    A NULL summary is kept (it is not boilerplate).
    """
    return df.where(~F.coalesce(F.startswith(F.col(col), F.lit(prefix)), F.lit(False)))


def news_cutoff(df: DataFrame, stamp_col: str = "date", end_col: str = "end_date") -> DataFrame:
    """Keep articles dated on or before the interval end: ``stamp[:8] <= yyyyMMdd(end)``."""
    return df.where(F.substr(F.col(stamp_col), F.lit(1), F.lit(8)) <= F.date_format(F.col(end_col), "yyyyMMdd"))


def usable_answers(df: DataFrame, col: str = "answer") -> DataFrame:
    """Keep rows whose answer is a non-empty string."""
    return df.where(F.col(col).isNotNull() & (F.col(col) != ""))


def with_empty_basics(df: DataFrame) -> DataFrame:
    """Constant empty basics, for runs without fundamentals."""
    return (df.withColumn("basics_period", F.lit(None).cast("date"))
              .withColumn("basics_metrics", F.create_map().cast("map<string,double>")))
