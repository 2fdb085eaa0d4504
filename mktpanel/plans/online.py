"""As-of-day panel (P8) and prompts (P9) for a given ``curday``."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktpanel.functions import fixed
from mktpanel.functions import text as T
from mktpanel.operators.aggregates import pivot_basics
from mktpanel.operators.filters import drop_boilerplate, news_cutoff
from mktpanel.operators.joins import attach_profile, current_basics, news_in_intervals
from mktpanel.operators.sampling import sample_news
from mktpanel.operators.timeseries import recent_intervals
from mktpanel.sources.universe import with_asset_class


class RecentPanel(NamedTuple):
    """``intervals``: symbol, row_idx, start_date, end_date, start_price, end_price.
    ``news``: symbol, row_idx, start_date, end_date, date, headline, summary."""
    intervals: DataFrame
    news: DataFrame


def recent_panel(prices: DataFrame, news: DataFrame, symbols: DataFrame, curday: str,
                 n_weeks: int = fixed.DEFAULT_ONLINE_WEEKS) -> RecentPanel:
    """Intervals of the last ``n_weeks`` before ``curday`` and their articles."""
    iv = recent_intervals(symbols.select("symbol").distinct(), prices, curday, n_weeks)
    lo = F.date_sub(F.lit(curday).cast("date"), 7 * n_weeks)
    hi = F.lit(curday).cast("date")
    return RecentPanel(iv, news_in_intervals(iv, news, lo, hi))


def online_prompts(recent: RecentPanel, profiles: DataFrame, basics_long: DataFrame | None,
                   members: DataFrame, curday: str, with_basics: bool = True, seed: int = 0,
                   k: int = fixed.NEWS_TOP_K) -> DataFrame:
    """As-of-day prompt per symbol (P9): returns ``(symbol, info, prompt)``.

    Each interval contributes its header (earlier form) and up to ``k``
    sampled articles dated no later than its end, boilerplate removed.
    """
    arts = drop_boilerplate(news_cutoff(recent.news), fixed.BOILERPLATE_LONG)
    arts = arts.withColumn("text", T.article_text("headline", "summary", "earlier"))
    picked = sample_news(arts, k=k, seed=seed, by=("symbol", "row_idx"))
    lists = (picked.groupBy("symbol", "row_idx")
                   .agg(F.array_sort(F.collect_list(F.struct("rn", "text"))).alias("_l")))
    rows = recent.intervals.join(lists, ["symbol", "row_idx"], "left")
    header = T.week_header("symbol", "start_date", "end_date", "start_price", "end_price", "earlier")
    ntext = T.news_text(F.transform("_l", lambda e: e["text"]), fixed.NO_NEWS_ONLINE)
    rows = rows.select("symbol", "row_idx", F.concat(F.lit("\n"), header, ntext).alias("row_text"))
    body = (rows.groupBy("symbol")
                .agg(F.array_sort(F.collect_list(F.struct("row_idx", "row_text"))).alias("_r"))
                .select("symbol", F.array_join(F.transform("_r", lambda e: e["row_text"]), "").alias("body")))
    body = attach_profile(with_asset_class(body, members), profiles)
    crypto = F.col("asset_class") == "crypto"
    if with_basics and basics_long is not None:
        cur = current_basics(pivot_basics(basics_long), curday)
        body = body.join(cur, "symbol", "left")
        basics = F.when(crypto, F.lit(fixed.BASICS_LIST_EMPTY)).otherwise(T.basics_text("symbol", "period", "metrics"))
    else:
        basics = F.lit(fixed.BASICS_LIST_EMPTY)
    intro = F.when(crypto, T.crypto_intro()).otherwise(T.company_intro(variant="earlier"))
    info = F.concat(intro, F.lit("\n"), F.col("body"), F.lit("\n"), basics)
    d = F.lit(curday).cast("date")
    ending = T.fill(fixed.ONLINE_ENDING, curday=T.iso_date(d), symbol=F.col("symbol"), period=T.forecast_period(d))
    return body.select("symbol", info.alias("info")).select("symbol", "info", F.concat("info", ending).alias("prompt"))
