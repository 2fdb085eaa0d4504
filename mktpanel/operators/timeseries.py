"""Time-series operators over (symbol, date) tables.

Windows here are partitioned by symbol and ordered by time over *daily or
weekly* rows: at most one row per symbol and day, so a window partition is
bounded by the length of the calendar range, never by data volume.  Heavy
inputs are reduced by partial aggregates before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mktpanel.functions.labels import bin_label


def sunday_on_or_after(d) -> F.Column:
    """Weekly bucket label: the Sunday on or after a date (right-closed W-SUN weeks)."""
    c = F.col(d) if isinstance(d, str) else d
    return F.next_day(F.date_sub(c, 1), "SUN")


def _valid(c: str) -> F.Column:
    return F.col(c).isNotNull() & ~F.isnan(F.col(c))


def price_field(prices: DataFrame) -> DataFrame:
    """Add ``price``: adjusted close when the symbol has any adjusted value, else close (S3).

    The choice is per symbol, not per row: one flag per symbol is aggregated
    and joined back, so the daily rows are not sorted by symbol.
    """
    flag = prices.groupBy("symbol").agg(F.max(F.coalesce(_valid("adj_close"), F.lit(False))).alias("_adj"))
    return (prices.join(flag, "symbol")
                  .withColumn("price", F.when(F.col("_adj"), F.col("adj_close")).otherwise(F.col("close"))).drop("_adj"))


def weekly_close(prices: DataFrame) -> DataFrame:
    """Last valid price of each symbol-week (T1): ``(symbol, week_end, price)``.

    A partial aggregate per (symbol, week) runs before the shuffle, so the
    exchange carries one row per symbol-week and map task.  The adjusted/plain
    choice is made afterwards on the weekly rows.
    """
    wk = sunday_on_or_after("date")
    g = (prices.groupBy("symbol", wk.alias("week_end"))
               .agg(F.max_by("close", F.when(_valid("close"), F.col("date"))).alias("close"),
                    F.max_by("adj_close", F.when(_valid("adj_close"), F.col("date"))).alias("adj_close")))
    w = Window.partitionBy("symbol")
    use_adj = F.max(F.col("adj_close").isNotNull().cast("int")).over(w) == 1
    out = g.select("symbol", "week_end",
                   F.when(use_adj, F.col("adj_close")).otherwise(F.col("close")).alias("price"))
    return out.where(F.col("price").isNotNull())


def weekly_ffill(weekly: DataFrame, date_col: str = "week_end", value_col: str = "price") -> DataFrame:
    """Full Sunday spine from first to last week, last observation carried forward.

    No spine table and no join: each observed week is expanded with
    ``sequence`` up to the week before the next observation.
    """
    w = Window.partitionBy("symbol").orderBy(date_col)
    nxt = F.lead(date_col).over(w)
    stop = F.coalesce(F.date_sub(nxt, 7), F.col(date_col))
    return (weekly.select("symbol", date_col, value_col, stop.alias("_stop"))
                  .select("symbol", F.explode(F.sequence(F.col(date_col), F.col("_stop"),
                                                         F.expr("INTERVAL 7 DAYS"))).alias(date_col),
                          value_col))


def pct_change(df: DataFrame, value_col: str, by: str | list = "symbol", order: str = "week_end",
               out_col: str = "pct_change") -> DataFrame:
    """``value / previous value - 1`` per group; the first row of a group is dropped.

    Division by zero gives NULL (``try_divide``) instead of an error.
    """
    w = Window.partitionBy(*([by] if isinstance(by, str) else by)).orderBy(order)
    return (df.withColumn("_prev", F.lag(value_col).over(w))
              .withColumn("_has_prev", F.lag(F.lit(1)).over(w))
              .where(F.col("_has_prev").isNotNull())
              .withColumn(out_col, F.try_divide(F.col(value_col), F.col("_prev")) - 1)
              .drop("_prev", "_has_prev"))


def interval_pairs(df: DataFrame, date_col: str = "date", price_col: str = "price",
                   by: str = "symbol", order: str | None = None) -> DataFrame:
    """Consecutive rows as (start_date, start_price, end_date, end_price) (T4)."""
    w = Window.partitionBy(by).orderBy(order or date_col)
    out = df.select(by,
                    F.lag(date_col).over(w).alias("start_date"),
                    F.lag(price_col).over(w).alias("start_price"),
                    F.col(date_col).alias("end_date"),
                    F.col(price_col).alias("end_price"),
                    F.lag(F.lit(1)).over(w).alias("_has_prev"))
    return out.where(F.col("_has_prev").isNotNull()).drop("_has_prev")


def with_week_idx(df: DataFrame, by: str = "symbol", order: str = "end_date", col: str = "week_idx") -> DataFrame:
    """0-based row position within the symbol, by time."""
    w = Window.partitionBy(by).orderBy(order)
    return df.withColumn(col, (F.row_number().over(w) - 1).cast("int"))


def weekly_returns(prices: DataFrame) -> DataFrame:
    """Weekly panel with return and class (P1 = S3 T1 T2 T3 T4 C1 W4).

    One shuffle reduces daily prices to one row per symbol-week; one window
    pass over those rows gives the previous observed price, the next observed
    week and the first week; ``explode(sequence)`` then fills empty weeks.
    Because the spine is gap-free, ``week_idx`` and ``start_date`` are
    arithmetic, with no second window.
    """
    obs = weekly_close(prices)
    w = Window.partitionBy("symbol").orderBy("week_end")
    obs = obs.select(
        "symbol", "week_end", "price",
        F.lag("price").over(w).alias("prev_price"),
        F.lead("week_end").over(w).alias("next_week"),
        F.min("week_end").over(Window.partitionBy("symbol")).alias("first_week"))
    stop = F.coalesce(F.date_sub("next_week", 7), F.col("week_end"))
    spine = obs.select("symbol", "week_end", "price", "prev_price", "first_week",
                       F.explode(F.sequence("week_end", stop, F.expr("INTERVAL 7 DAYS"))).alias("end_date"))
    observed = F.col("end_date") == F.col("week_end")
    start_price = F.when(observed, F.col("prev_price")).otherwise(F.col("price"))
    ret = F.try_divide(F.col("end_price"), F.col("start_price")) - 1
    out = (spine.where(F.col("end_date") > F.col("first_week"))
                .select("symbol",
                        ((F.datediff("end_date", "first_week") / 7).cast("int") - 1).alias("week_idx"),
                        F.date_sub("end_date", 7).alias("start_date"),
                        start_price.alias("start_price"),
                        "end_date",
                        F.col("price").alias("end_price")))
    out = out.withColumn("weekly_return", ret)
    return out.withColumn("bin_label", bin_label("weekly_return"))


# ---------------------------------------------------------------- as-of day


def step_grid(curday, n_weeks: int) -> F.Column:
    """Array of days ``curday - 7*i`` for ``i = n..0``, oldest first (T5).

    A negative ``n`` runs forward in time (``curday`` first).
    """
    d = F.lit(curday).cast("date") if isinstance(curday, str) else curday
    if n_weeks >= 0:
        return F.sequence(F.date_sub(d, 7 * n_weeks), d, F.expr("INTERVAL 7 DAYS"))
    return F.reverse(F.sequence(F.date_add(d, -7 * n_weeks), d, F.expr("INTERVAL -7 DAYS")))


def symbol_steps(symbols: DataFrame, curday, n_weeks: int) -> DataFrame:
    """(symbol, step_idx, step) for every symbol: the step grid as rows."""
    return symbols.select("symbol", F.posexplode(step_grid(curday, n_weeks)).alias("step_idx", "step"))


def asof_forward(steps: DataFrame, prices: DataFrame, curday, n_weeks: int,
                 price_col: str = "close") -> DataFrame:
    """First trading row on or after each step (T6), among rows in ``[step0, curday)``.

    The day window is pushed to the price scan.  In two levels: each step's own
    seven days give their first trading row, by a partial aggregate, and a step
    without one takes the next step's that has, over a handful of rows per
    symbol.  Steps with no later row are absent.  The last step (``curday``) is
    not looked up: it is closed by ``recent_intervals``.
    """
    d = F.lit(curday).cast("date") if isinstance(curday, str) else curday
    day0 = F.date_sub(d, 7 * n_weeks)
    window = prices.where((F.col("date") >= day0) & (F.col("date") < d))
    slot = F.floor(F.datediff("date", day0) / 7).cast("int").alias("step_idx")
    firsts = window.groupBy("symbol", slot).agg(F.min_by(F.struct("date", F.col(price_col).alias("price")), "date").alias("_first"))
    s = steps.where(F.col("step") < d).select("symbol", "step_idx", "step")
    later = Window.partitionBy("symbol").orderBy("step_idx").rowsBetween(0, Window.unboundedFollowing)
    j = s.join(firsts, ["symbol", "step_idx"], "left").withColumn("_next", F.first("_first", ignorenulls=True).over(later))
    return (j.where(F.col("_next").isNotNull())
             .select("symbol", "step_idx", "step", F.col("_next.date").alias("date"), F.col("_next.price").alias("price")))


def recent_intervals(symbols: DataFrame, prices: DataFrame, curday, n_weeks: int = 3,
                     price_col: str = "close") -> DataFrame:
    """Intervals of the last ``n_weeks`` before ``curday`` (T5+T6+T7+T4).

    Every step takes the first trading day on or after it; the last interval
    closes on the last trading day before ``curday``.
    """
    d = F.lit(curday).cast("date") if isinstance(curday, str) else curday
    steps = symbol_steps(symbols, curday, n_weeks)
    first = asof_forward(steps, prices, curday, n_weeks, price_col)
    day0 = F.date_sub(d, 7 * n_weeks)
    last = (prices.where((F.col("date") >= day0) & (F.col("date") < d))
                  .groupBy("symbol")
                  .agg(F.max("date").alias("date"), F.max_by(price_col, "date").alias("price"))
                  .withColumn("step_idx", F.lit(n_weeks + 1)))
    pts = first.select("symbol", "step_idx", "date", "price").unionByName(last.select("symbol", "step_idx", "date", "price"))
    w = Window.partitionBy("symbol").orderBy("step_idx")
    pairs = pts.select("symbol",
                       F.lag("date").over(w).alias("start_date"),
                       F.col("date").alias("end_date"),
                       F.lag("price").over(w).alias("start_price"),
                       F.col("price").alias("end_price"),
                       (F.row_number().over(w) - 2).cast("int").alias("row_idx"))
    return pairs.where(F.col("row_idx") >= 0)


def spark_dates(spark: SparkSession, days: list[str]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("date"))
