"""Aggregations (A1-A4): article lists, metric maps, accuracy report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktpanel.functions.labels import direction_match, exact_match
from mktpanel.operators.ranking import with_group_rank
from mktpanel.operators.sampling import top_news

# Articles are whole texts: a cell holds a hundred of them at most.
PAGE_ROWS = 100
REPORT_COLUMNS = ["symbol", "samples", "directional_accuracy", "full_accuracy", "missing_predictions"]


def collect_news(week_articles: DataFrame, by=("symbol", "week_idx"), page_rows: int = PAGE_ROWS) -> DataFrame:
    """Every article of a group as ordered lists (A1), in pages of at most ``page_rows`` articles.

    ``(by..., page, news array<struct<date, headline, summary>>, n_page, n_news)``;
    pages are numbered from 0, in order they are the whole list, and ``n_news``
    is its length.  An article's page follows from its exact rank, so a hot
    week, or a hot second of it, is as many cells as it needs and is ranked and
    gathered in many tasks.
    """
    ranked = with_group_rank(week_articles, by, ["date", "headline", "summary"], "_rank", "n_news")
    page = F.floor(F.col("_rank") / page_rows).cast("int").alias("page")
    return ranked.groupBy(*by, page).agg(
        F.sort_array(F.collect_list(F.struct("date", "headline", "summary"))).alias("news"),
        F.count(F.lit(1)).alias("n_page"), F.first("n_news").alias("n_news"))


def first_news(week_articles: DataFrame, k: int, by=("symbol", "week_idx"), text_col: str | None = None) -> DataFrame:
    """The first ``k`` articles of each group as one list, in (date, headline, summary) order (K1).

    The cut happens map-side before the shuffle (see ``sampling.top_news``).
    """
    fields = ["date", "headline", "summary"] + ([text_col] if text_col else [])
    top = top_news(week_articles, k=k, by=by)
    return (top.groupBy(*by)
               .agg(F.array_sort(F.collect_list(F.struct("rn", *fields))).alias("_l"))
               .select(*by, F.transform("_l", lambda e: F.struct(*[e[f].alias(f) for f in fields])).alias("news")))


def pivot_basics(basics_long: DataFrame) -> DataFrame:
    """basics_long(symbol, period, metric, v[, pos]) -> (symbol, period, metrics map) (A2).

    A metric listed more than once in a period has the value of the largest
    ``pos`` (the later entry); without ``pos`` the largest value.  A map holds
    one entry per metric, so it is bounded by the number of metric names.
    """
    later = F.max_by("v", "pos") if "pos" in basics_long.columns else F.max("v")
    one = basics_long.groupBy("symbol", "period", "metric").agg(later.alias("v"))
    return (one.groupBy("symbol", "period")
               .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "v")))).alias("metrics")))


def evaluate(pairs: DataFrame) -> DataFrame:
    """Per-symbol accuracy (A3): samples, mean direction match, mean exact match, missing count.

    A partial aggregate per symbol runs before the shuffle.  Symbols without
    any pair produce no row (their accuracy would be undefined).
    """
    g = pairs.groupBy("symbol").agg(
        F.count(F.lit(1)).cast("double").alias("samples"),
        F.avg(direction_match("true_label", "pred_label").cast("double")).alias("directional_accuracy"),
        F.avg(exact_match("true_label", "pred_label").cast("double")).alias("full_accuracy"),
        F.sum(F.col("pred_label").isNull().cast("int")).cast("double").alias("missing_predictions"))
    return g.where(F.col("directional_accuracy").isNotNull()).select(*REPORT_COLUMNS)


# Per-symbol values are summed as decimals: exact, so any order of partial sums gives the same mean.
_EXACT = "decimal(38,12)"


def with_macro_average(report: DataFrame, label: str = "Average") -> DataFrame:
    """Append the mean of the per-symbol rows (A4); a macro average, not a micro one.

    One pass: ``rollup("symbol")`` over the per-symbol report.  A symbol's group
    holds its single row; the grand total is a partial sum per task and one
    division.
    """
    n = F.count(F.lit(1)).cast("double")
    g = report.rollup("symbol").agg(
        *[F.sum(F.col(c).cast(_EXACT)).cast("double").alias(f"_s_{c}") for c in REPORT_COLUMNS[1:]],
        *[F.max(c).alias(f"_v_{c}") for c in REPORT_COLUMNS[1:]],
        n.alias("_n"), F.grouping("symbol").alias("_total"))
    total = F.col("_total") == 1
    g = g.where(~total | (F.col("_n") > 0))
    return g.select(F.when(total, F.lit(label)).otherwise(F.col("symbol")).alias("symbol"),
                    *[F.when(total, F.col(f"_s_{c}") / F.col("_n")).otherwise(F.col(f"_v_{c}")).alias(c)
                      for c in REPORT_COLUMNS[1:]])
