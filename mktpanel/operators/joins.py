"""Joins (J1-J8): news by week, fundamentals as of a date, profiles, pairing, resume.

Interval and as-of joins are rewritten as equi-joins or single window passes
so no join condition has only a range (no nested-loop or cartesian plans).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mktpanel.functions.text import news_day, news_stamp
from mktpanel.operators.intervals import join_days_to_intervals
from mktpanel.operators.timeseries import sunday_on_or_after
from mktpanel.operators.windows import lag_in_blocks
from mktpanel.session import materialize


def article_days(news: DataFrame) -> DataFrame:
    """news(symbol, datetime, headline, summary) -> + ``date`` stamp and UTC ``day``."""
    return news.select("symbol", "headline", "summary",
                       news_stamp("datetime").alias("date"), news_day("datetime").alias("day"))


def article_weeks(news: DataFrame) -> DataFrame:
    """Each article tagged with every week (ending Sunday) whose inclusive range holds it.

    A week is ``[end - 7, end]`` with both ends inclusive, so an article dated on
    a Sunday belongs to the week ending that day and to the week ending seven
    days later.  Exploding that 1-2 element array turns the interval join
    into an equi-join on ``(symbol, week_end)`` (rewrite R1).
    """
    a = article_days(news)
    wk = sunday_on_or_after("day")
    ends = F.when(F.dayofweek("day") == 1, F.array(wk, F.date_add(wk, 7))).otherwise(F.array(wk))
    return a.withColumn("week_end", F.explode(ends))


def attach_news(weeks: DataFrame, news: DataFrame) -> DataFrame:
    """Articles of each panel week (J1), long form: one row per (article, week).

    ``(symbol, week_idx, start_date, end_date, date, headline, summary)``.  Weeks
    with no article simply have no row here; the panel keeps them.  The weeks
    side is one row per symbol-week (small); AQE broadcasts it when it fits and
    splits a hot (symbol, week) partition when it does not.
    """
    a = article_weeks(news)
    w = weeks.select("symbol", "week_idx", "start_date", F.col("end_date").alias("week_end"))
    return (a.join(w, ["symbol", "week_end"])
             .select("symbol", "week_idx", "start_date", F.col("week_end").alias("end_date"),
                     "date", "headline", "summary"))


def news_in_intervals(intervals: DataFrame, news: DataFrame, lo=None, hi=None, key: str = "row_idx") -> DataFrame:
    """Articles inside irregular ``[start_date, end_date]`` intervals (generic J1 form, P8).

    News is first cut to the day range ``[lo, hi]`` if given (pushed to the
    scan).  Intervals, which may be years long and overlap, are covered by
    aligned blocks of days, so this is an equi-join on (symbol, level, block)
    whose input does not grow with their length (``operators.intervals``).
    """
    a = article_days(news)
    if lo is not None:
        a = a.where(F.col("day") >= (F.lit(lo).cast("date") if isinstance(lo, str) else lo))
    if hi is not None:
        a = a.where(F.col("day") <= (F.lit(hi).cast("date") if isinstance(hi, str) else hi))
    return (join_days_to_intervals(a, intervals, key)
            .select("symbol", key, "start_date", "end_date", "date", "headline", "summary"))


def attach_basics(weeks: DataFrame, basics: DataFrame, always: bool = False) -> DataFrame:
    """Fundamentals as of each week (J2, J3): latest period strictly before ``end_date``.

    Default: the period must also be on or after the start of the row two
    rows back, and rows 0 and 1 get none (W3).  ``always=True``
    drops the lower bound for every row.  A period without a date is none.

    Rewrite R2 in two levels: week rows and periods are ordered by (date, kind)
    within (symbol, quarter), week rows first on ties, so the last period so
    far lies strictly before the week end.  Where a quarter has none yet, the
    last one of the quarters before it is carried in, found over one row per
    symbol and quarter.  Linear, no range join, and no window over a whole
    symbol's rows.
    """
    b = basics.where(F.col("period").isNotNull()).select(
        "symbol", F.col("period").alias("_t"), F.lit(1).alias("_kind"),
        F.struct(F.col("period").alias("period"), F.col("metrics").alias("metrics")).alias("_b"))
    w = weeks.select(*weeks.columns, F.col("end_date").alias("_t"), F.lit(0).alias("_kind"),
                     F.lit(None).cast(b.schema["_b"].dataType).alias("_b"))
    u = w.unionByName(b, allowMissingColumns=True)
    # Written once: both levels, and the look two rows back, read it.
    u = materialize(u.select(*u.columns, (F.year("_t") * 4 + F.quarter("_t")).alias("_q")), "weeks-and-periods")
    if not always:
        u = lag_in_blocks(u.where(F.col("_kind") == 0), "start_date", 2, "_lower").unionByName(
            u.where(F.col("_kind") == 1), allowMissingColumns=True)
    inside = Window.partitionBy("symbol", "_q").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    asof = u.withColumn("_near", F.last("_b", ignorenulls=True).over(inside)).where(F.col("_kind") == 0)
    ends = u.groupBy("symbol", "_q").agg(F.max_by("_b", F.when(F.col("_kind") == 1, F.col("_t"))).alias("_end"))
    before = Window.partitionBy("symbol").orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("symbol", "_q", F.last("_end", ignorenulls=True).over(before).alias("_far"))
    asof = asof.join(carried, ["symbol", "_q"]).withColumn("_last", F.coalesce("_near", "_far"))
    keep = F.col("_last").isNotNull()
    if not always:
        keep = keep & F.coalesce(F.col("_last.period") >= F.col("_lower"), F.lit(False))
    return asof.select(*weeks.columns,
                       F.when(keep, F.col("_last.period")).alias("basics_period"),
                       F.when(keep, F.col("_last.metrics")).otherwise(F.create_map().cast("map<string,double>"))
                        .alias("basics_metrics"))


def current_basics(basics: DataFrame, curday) -> DataFrame:
    """Latest period on or before ``curday`` per symbol, else the earliest period."""
    d = F.lit(curday).cast("date") if isinstance(curday, str) else curday
    entry = F.struct("period", "metrics")
    g = basics.groupBy("symbol").agg(
        F.max_by(entry, F.when(F.col("period") <= d, F.col("period"))).alias("_le"),
        F.min_by(entry, "period").alias("_first"))
    pick = F.coalesce("_le", "_first")
    return g.select("symbol", pick["period"].alias("period"), pick["metrics"].alias("metrics"))


def pair_predictions(truth: DataFrame, pred: DataFrame, align: str = "position") -> DataFrame:
    """Truth labels paired with predictions for symbols on both sides.

    ``align="position"``: i-th truth row with i-th prediction row per symbol,
    cut to the shorter side (the reproduced behaviour, shifted by the warm-up
    weeks).  ``align="key"``: same (symbol, week_idx).
    Inputs: truth(symbol, week_idx, true_label), pred(symbol, week_idx, pred_label).
    """
    if align == "key":
        return truth.join(pred, ["symbol", "week_idx"]).select("symbol", "week_idx", "true_label", "pred_label")
    if align != "position":
        raise ValueError(f"unknown align {align!r}")
    wt = Window.partitionBy("symbol").orderBy("week_idx")
    t = truth.select("symbol", (F.row_number().over(wt) - 1).alias("pos"), "true_label")
    p = pred.select("symbol", (F.row_number().over(wt) - 1).alias("pos"), "pred_label")
    return t.join(p, ["symbol", "pos"]).select("symbol", F.col("pos").cast("int").alias("week_idx"),
                                               "true_label", "pred_label")


def attach_profile(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """Profile columns per symbol (J7).  One profile row per symbol; AQE picks broadcast by size."""
    return df.join(profiles, "symbol", "left")


def pending_prompts(prompts: DataFrame, answers: DataFrame) -> DataFrame:
    """Prompts without an answer yet, by key."""
    return prompts.join(answers.select("symbol", "week_idx"), ["symbol", "week_idx"], "left_anti")
