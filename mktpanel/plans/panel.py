"""Weekly panel (P1) and the panel enriched with news and fundamentals."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mktpanel.functions import fixed
from mktpanel.operators.aggregates import pivot_basics
from mktpanel.operators.filters import with_empty_basics
from mktpanel.operators.joins import attach_basics, attach_news
from mktpanel.operators.timeseries import weekly_returns
from mktpanel.session import materialize

__all__ = ["Panel", "weekly_returns", "build_panel", "panel_summary"]


class Panel(NamedTuple):
    """A panel: one row per symbol-week plus its articles in long form.

    ``weeks``: symbol, week_idx, start_date, start_price, end_date, end_price,
    weekly_return, bin_label, basics_period, basics_metrics.
    ``news``: symbol, week_idx, start_date, end_date, date, headline, summary
    (one row per article and week it falls in; a week may have none).
    ``weekly``: the weekly return rows alone (materialised), for consumers that
    need no fundamentals.
    """
    weeks: DataFrame
    news: DataFrame
    weekly: DataFrame | None = None


def build_panel(prices: DataFrame, news: DataFrame, basics_long: DataFrame | None,
                with_basics: bool = True, always: bool = False, materialize_weeks: bool = True) -> Panel:
    """Weekly returns joined with news by week and fundamentals as of each week.

    The weekly table (one row per symbol-week, small) is written once to the
    shared checkpoint folder when ``materialize_weeks`` is set, so the price
    scan and its aggregates run once although the table feeds both joins.
    """
    weekly = weekly_returns(prices)
    if materialize_weeks:
        weekly = materialize(weekly, "weekly")
    if with_basics and basics_long is not None:
        weeks = attach_basics(weekly, pivot_basics(basics_long), always=always)
    else:
        weeks = with_empty_basics(weekly)
    return Panel(weeks, attach_news(weekly.select("symbol", "week_idx", "start_date", "end_date"), news), weekly)


def articles_digest() -> Column:
    """Aggregate over articles: the sum of 32 bits of each one's MD5, whatever their order."""
    text = F.concat_ws("|", "date", F.coalesce("headline", F.lit(fixed.NULL_TEXT)), F.coalesce("summary", F.lit(fixed.NULL_TEXT)))
    return F.sum(F.conv(F.left(F.md5(text), F.lit(8)), 16, 10).cast("bigint"))


def panel_summary(panel: Panel) -> DataFrame:
    """Flat view of a panel: weekly columns, basics period, article count and digest per week."""
    counts = panel.news.groupBy("symbol", "week_idx").agg(F.count(F.lit(1)).alias("n_news"),
                                                          articles_digest().alias("news_digest"))
    w = panel.weeks.join(counts, ["symbol", "week_idx"], "left")
    return w.select("symbol", "week_idx", "start_date", "start_price", "end_date", "end_price",
                    "weekly_return", "bin_label", F.coalesce("n_news", F.lit(0)).alias("n_news"),
                    F.coalesce("news_digest", F.lit(0)).alias("news_digest"), "basics_period")
