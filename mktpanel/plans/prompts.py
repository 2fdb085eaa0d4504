"""Offline prompts with rolling history.

Each week first becomes one block (header and at most five articles, which are
whole texts), written once.  History is found on keys; a block then goes to
the weeks that want it by an equi-join on (symbol, week), so no task holds or
sorts the texts of a symbol.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktpanel.functions import fixed
from mktpanel.functions import text as T
from mktpanel.operators.aggregates import first_news
from mktpanel.operators.filters import drop_boilerplate
from mktpanel.operators.joins import attach_profile
from mktpanel.operators.windows import history_gate, history_join
from mktpanel.plans.panel import Panel
from mktpanel.session import materialize
from mktpanel.sources.universe import with_asset_class


def week_blocks(panel: Panel, k: int = fixed.NEWS_TOP_K) -> DataFrame:
    """Panel weeks + ``header``, ``news_text`` and ``block`` (header, newline, news)."""
    arts = drop_boilerplate(panel.news, fixed.BOILERPLATE_SHORT)
    arts = arts.withColumn("text", T.article_text("headline", "summary", "later"))
    lists = first_news(arts, k=k, text_col="text")
    weeks = panel.weeks.join(lists, ["symbol", "week_idx"], "left")
    header = T.week_header("symbol", "start_date", "end_date", "start_price", "end_price", "later")
    ntext = T.news_text(F.transform("news", lambda e: e["text"]), fixed.NO_NEWS_LATER)
    return (weeks.withColumn("header", header)
                 .withColumn("news_text", ntext)
                 .withColumn("block", F.concat("header", F.lit("\n"), "news_text")))


def intro_text() -> F.Column:
    """Company introduction (later form), or the crypto introduction for crypto symbols."""
    return F.when(F.col("asset_class") == "crypto", T.crypto_intro()).otherwise(T.company_intro(variant="later"))


def build_prompts(panel: Panel, profiles: DataFrame, members: DataFrame,
                  min_weeks: int = fixed.DEFAULT_MIN_WEEKS, max_weeks: int = fixed.DEFAULT_MAX_WEEKS,
                  include_target: bool = True) -> DataFrame:
    """One prompt per week from ``min_weeks`` on.

    Prompt = introduction, up to ``max_weeks`` earlier week blocks, this week's
    header and news, the basics highlights, and the task ending; outer
    whitespace stripped.  ``include_target=False`` leaves out this week's
    header and news (they reveal the label being predicted).
    Returns ``(symbol, week_idx, start_date, end_date, asset_class, prompt)``.
    """
    # Whatever is joined by symbol alone is joined to the narrow weeks, before texts.
    weeks = attach_profile(with_asset_class(panel.weeks, members), profiles)
    weeks = weeks.select(*panel.weeks.columns, "asset_class", intro_text().alias("intro"))
    blocks = week_blocks(panel._replace(weeks=weeks)).select(
        "symbol", "week_idx", "start_date", "end_date", "asset_class", "intro", "basics_period", "basics_metrics", "block")
    weeks = history_gate(history_join(materialize(blocks, "week-blocks"), "block", max_weeks), min_weeks)
    basics = F.when(F.col("asset_class") == "crypto", F.lit(fixed.HIGHLIGHTS_EMPTY)).otherwise(
        T.basics_highlights("basics_period", "basics_metrics"))
    parts = [F.col("intro"), F.lit("\n\n"), F.array_join("history", "\n\n"), F.lit("\n\n")]
    if include_target:
        parts += [F.col("block"), F.lit("\n\n")]
    parts += [basics, T.task_ending("symbol", "start_date", "end_date")]
    prompt = T.py_strip(F.concat(*parts))
    return weeks.select("symbol", "week_idx", "start_date", "end_date", "asset_class", prompt.alias("prompt"))
