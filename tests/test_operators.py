"""Operator goldens on small hand-built frames."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from mktpanel.operators import aggregates as A
from mktpanel.operators import joins as J
from mktpanel.operators import sampling as K
from mktpanel.operators import timeseries as TS
from mktpanel.operators import windows as W
from mktpanel.operators.ranking import with_group_rank
from tests.conftest import rows

D = dt.date.fromisoformat


def prices_df(spark, data):
    return spark.createDataFrame(
        [(s, D(d), c, a, 1) for s, d, c, a in data],
        "symbol string, date date, close double, adj_close double, volume bigint")


def test_weekly_returns_equal_pandas_resample(spark):
    # Gaps of several weeks, a Sunday trade and a Saturday trade.
    days = ["2023-05-31", "2023-06-01", "2023-06-02", "2023-06-05", "2023-06-09", "2023-06-11",
            "2023-06-17", "2023-07-05", "2023-07-06", "2023-08-01", "2023-08-02"]
    closes = [10.0, 10.5, 10.25, 11.0, 10.0, 9.5, 9.75, 12.0, 12.5, 12.5, 11.0]
    df = prices_df(spark, [("X", d, c, None) for d, c in zip(days, closes)])
    got = TS.weekly_returns(df).orderBy("week_idx").collect()

    s = pd.Series(closes, index=pd.to_datetime(days))
    wk = s.resample("W").ffill()
    ret = wk.pct_change()[1:]
    assert len(got) == len(ret)
    for r, (end, v), start_p, end_p in zip(got, ret.items(), wk.values[:-1], wk.values[1:]):
        assert r.end_date == end.date()
        assert r.start_date == (end - pd.Timedelta(days=7)).date()
        assert r.start_price == start_p and r.end_price == end_p
        assert r.weekly_return == v
    assert [r.week_idx for r in got] == list(range(len(got)))


def test_price_field_prefers_adjusted_per_symbol(spark):
    df = prices_df(spark, [("A", "2023-06-01", 10.0, 9.0), ("A", "2023-06-02", 11.0, None),
                           ("B", "2023-06-01", 10.0, None)])
    got = rows(TS.price_field(df), "symbol", "date", "price")
    assert got == [("A", D("2023-06-01"), 9.0), ("A", D("2023-06-02"), None), ("B", D("2023-06-01"), 10.0)]
    # Weekly: the last *valid* adjusted price of the week is used.
    wk = rows(TS.weekly_close(df), "symbol", "price")
    assert wk == [("A", 9.0), ("B", 10.0)]


def test_sunday_article_in_two_weeks(spark):
    weeks = spark.createDataFrame([("X", i, D("2023-06-04") + dt.timedelta(days=7 * i)) for i in range(3)],
                                  "symbol string, week_idx int, end_date date")
    weeks = weeks.withColumn("start_date", F.date_sub("end_date", 7))
    sunday = int(dt.datetime(2023, 6, 11, 15, 0, tzinfo=dt.timezone.utc).timestamp())
    monday = int(dt.datetime(2023, 6, 12, 9, 0, tzinfo=dt.timezone.utc).timestamp())
    news = spark.createDataFrame([("X", sunday, "h1", "s1"), ("X", monday, "h2", "s2")],
                                 "symbol string, datetime bigint, headline string, summary string")
    got = rows(J.attach_news(weeks, news), "week_idx", "headline")
    assert got == [(1, "h1"), (2, "h1"), (2, "h2")]


def test_basics_asof_boundaries(spark):
    ends = [D("2023-01-01") + dt.timedelta(days=7 * i) for i in range(6)]
    weeks = spark.createDataFrame([("X", i, e) for i, e in enumerate(ends)], "symbol string, week_idx int, end_date date")
    weeks = weeks.withColumn("start_date", F.date_sub("end_date", 7))
    # period == end of week 3 (excluded for week 3), == end(4) - 21 (included for week 4)
    periods = [(ends[3], {"m": 1.0}), (ends[1], {"m": 2.0}), (ends[0] - dt.timedelta(days=1), {"m": 3.0})]
    basics = spark.createDataFrame([("X", p, m) for p, m in periods], "symbol string, period date, metrics map<string,double>")
    got = dict(rows(J.attach_basics(weeks, basics), "week_idx", "basics_period"))
    assert got[0] is None and got[1] is None                     # rows 0 and 1 never get basics
    assert got[2] == ends[1]                                       # lower bound end(2)-21 < ends[1]
    assert got[3] == ends[1]                                       # ends[3] itself is excluded
    assert got[4] == ends[3]
    assert got[5] == ends[3]                                       # end(5)-21 == ends[2] <= ends[3]
    always = dict(rows(J.attach_basics(weeks, basics, always=True), "week_idx", "basics_period"))
    assert always[0] == ends[0] - dt.timedelta(days=1) and always[1] == ends[0] - dt.timedelta(days=1)


def test_current_basics_falls_back_to_earliest(spark):
    basics = spark.createDataFrame([("X", D("2023-03-31"), {"a": 1.0}), ("X", D("2023-06-30"), {"a": 2.0}),
                                    ("Y", D("2023-03-31"), {"a": 3.0})],
                                   "symbol string, period date, metrics map<string,double>")
    assert rows(J.current_basics(basics, "2023-05-01"), "symbol", "period") == [("X", D("2023-03-31")), ("Y", D("2023-03-31"))]
    assert rows(J.current_basics(basics, "2022-01-01"), "symbol", "period") == [("X", D("2023-03-31")), ("Y", D("2023-03-31"))]
    assert rows(J.current_basics(basics, "2023-07-01"), "symbol", "period")[0] == ("X", D("2023-06-30"))


def test_chrono_split_half_even(spark):
    df = spark.createDataFrame([("A", i) for i in range(5)] + [("B", 0)], "symbol string, week_idx int")
    got = rows(W.chrono_split(df, 0.5), "symbol", "week_idx", "split")
    assert [r[2] for r in got if r[0] == "A"] == ["train", "train", "test", "test", "test"]
    one = rows(W.chrono_split(df.where(F.col("symbol") == "B"), 0.6), "split")
    assert one == [("train",)]


def test_history_sizes_min1_max4(spark):
    df = spark.createDataFrame([("X", i, f"b{i}") for i in range(10)], "symbol string, week_idx int, block string")
    h = W.history_gate(W.history_window(df, "block", 4), 1)
    got = {r.week_idx: r.history for r in h.collect()}
    assert 0 not in got
    assert got[1] == ["b0"] and got[3] == ["b0", "b1", "b2"] and got[9] == ["b5", "b6", "b7", "b8"]


def test_history_by_join_equals_history_by_window(spark):
    data = [("X", w, f"b{w}" if w != 3 else None) for w in (0, 1, 2, 3, 5, 9)] + [("Y", 4, "y")]     # gaps and a NULL
    df = spark.createDataFrame(data, "symbol string, week_idx int, block string")
    for n in (1, 2, 4):
        assert rows(W.history_join(df, "block", n)) == rows(W.history_window(df, "block", n))
    assert W.history_join(df.limit(0), "block", 2).collect() == []


def test_top_news_and_sample_are_bounded_and_ordered(spark):
    data = [("X", 0, f"2023010{d}000000", f"h{d}", "s") for d in range(1, 9)] + [("X", 1, "20230110000000", None, "s")]
    df = spark.createDataFrame(data, "symbol string, week_idx int, date string, headline string, summary string")
    top = rows(K.top_news(df, 5), "week_idx", "rn", "headline")
    assert [r for r in top if r[0] == 0] == [(0, i, f"h{i}") for i in range(1, 6)]
    smp = K.sample_news(df, 5, seed=7).collect()
    w0 = sorted((r.rn, r.date) for r in smp if r.week_idx == 0)
    assert len(w0) == 5 and [d for _, d in w0] == sorted(d for _, d in w0)
    assert K.sample_news(df, 5, seed=7).where("week_idx = 1").count() == 1


def test_collect_news_keeps_every_article_in_order(spark):
    data = [("X", 0, f"202301010{d // 3}00{d % 3}00", h, "s") for d, h in enumerate(["b", "a", None, "d", "e", "f", "g"])]
    df = spark.createDataFrame(data + data[:1], "symbol string, week_idx int, date string, headline string, summary string")
    pages = sorted(A.collect_news(df, page_rows=3).collect(), key=lambda r: r.page)
    assert [e.headline for r in pages for e in r.news] == ["b", "b", "a", None, "d", "e", "f", "g"]
    assert [(r.page, r.n_page) for r in pages] == [(0, 3), (1, 3), (2, 2)] and all(r.n_news == 8 for r in pages)
    assert [r.n_page for r in A.collect_news(df).collect()] == [8]
    assert A.collect_news(df.limit(0)).collect() == []


def test_one_second_with_very_many_articles_is_many_pages_and_tasks(spark):
    """100,000 articles of one symbol and stamp, a third of them equal, beside a small group."""
    i = F.col("id")
    df = spark.range(100_000, numPartitions=8).select(
        F.lit("X").alias("symbol"), F.lit(0).alias("week_idx"), F.lit("20230101000000").alias("date"),
        F.when(i % 3 > 0, F.concat(F.lit("h"), F.lpad((i * 7919 % 100_000).cast("string"), 6, "0"))).alias("headline"),
        F.lit("s").alias("summary"))
    df = df.unionByName(spark.range(5).select(F.lit("Y").alias("symbol"), F.lit(1).alias("week_idx"), F.lit("2").alias("date"),
                                              F.col("id").cast("string").alias("headline"), F.lit("s").alias("summary")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")        # no joining of small ranges
    try:
        ranked = with_group_rank(df, ["symbol", "week_idx"], ["date", "headline", "summary"])
        spread = ranked.where("symbol = 'X'").groupBy(F.spark_partition_id()).count().collect()
        assert len(spread) == 4 and max(r["count"] for r in spread) < 40_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert ranked.where("symbol = 'X' and n = 100000").agg(F.countDistinct("rank"), F.min("rank"), F.max("rank")).first() == (100_000, 0, 99_999)
    pages = A.collect_news(df).orderBy("symbol", "page").collect()
    assert max(r.n_page for r in pages) == A.PAGE_ROWS and len(pages) == 1001
    listed = [e.headline for r in pages[:1000] for e in r.news]
    assert listed == sorted(listed, key=lambda h: h or "") and len(listed) == 100_000


def test_first_news_is_cut(spark):
    data = [("X", 0, f"2023010{d}000000", f"h{d}", "s") for d in range(1, 9)]
    df = spark.createDataFrame(data, "symbol string, week_idx int, date string, headline string, summary string")
    assert [e.headline for e in A.first_news(df, k=3).first().news] == ["h1", "h2", "h3"]


def test_repeated_metric_has_the_later_value(spark):
    data = [("X", D("2023-03-31"), "peTTM", 9.0, 0), ("X", D("2023-03-31"), "peTTM", 1.0, 1), ("X", D("2023-03-31"), "a", 2.0, 0)]
    df = spark.createDataFrame(data, "symbol string, period date, metric string, v double, pos int")
    assert A.pivot_basics(df).first().metrics == {"peTTM": 1.0, "a": 2.0}
    assert A.pivot_basics(df.drop("pos")).first().metrics == {"peTTM": 9.0, "a": 2.0}


def test_recent_intervals_steps(spark):
    # Trading days with a gap: step 2023-06-06 has no price that day -> next price day.
    days = ["2023-05-29", "2023-05-31", "2023-06-07", "2023-06-08", "2023-06-14", "2023-06-16"]
    df = prices_df(spark, [("X", d, float(i + 1), None) for i, d in enumerate(days)])
    sym = spark.createDataFrame([("X",)], "symbol string")
    iv = TS.recent_intervals(sym, df, "2023-06-20", 3).orderBy("row_idx").collect()
    # steps 05-30, 06-06, 06-13 (06-20 is curday) -> 05-31, 06-07, 06-14; last day 06-16 closes.
    assert [(str(r.start_date), str(r.end_date)) for r in iv] == [
        ("2023-05-31", "2023-06-07"), ("2023-06-07", "2023-06-14"), ("2023-06-14", "2023-06-16")]
    assert [r.end_price for r in iv] == [3.0, 5.0, 6.0]


def test_step_grid(spark):
    df = spark.range(1).select(TS.step_grid("2023-06-20", 3).alias("g"), TS.step_grid("2023-06-20", -1).alias("f"))
    r = df.first()
    assert [str(x) for x in r.g] == ["2023-05-30", "2023-06-06", "2023-06-13", "2023-06-20"]
    assert [str(x) for x in r.f] == ["2023-06-20", "2023-06-27"]


def test_pairing_by_position_is_shifted(spark):
    truth = spark.createDataFrame([("X", i, f"U{i}") for i in range(4)], "symbol string, week_idx int, true_label string")
    pred = spark.createDataFrame([("X", i, f"U{i}") for i in range(1, 4)] + [("Z", 1, "U1")],
                                 "symbol string, week_idx int, pred_label string")
    pos = rows(J.pair_predictions(truth, pred, "position"), "week_idx", "true_label", "pred_label")
    assert pos == [(0, "U0", "U1"), (1, "U1", "U2"), (2, "U2", "U3")]
    key = rows(J.pair_predictions(truth, pred, "key"), "week_idx", "true_label", "pred_label")
    assert key == [(1, "U1", "U1"), (2, "U2", "U2"), (3, "U3", "U3")]


def test_evaluate_macro_average(spark):
    pairs = spark.createDataFrame([("A", 0, "U1", "U1"), ("A", 1, "U2", "D2"), ("B", 0, "D1", None)],
                                  "symbol string, week_idx int, true_label string, pred_label string")
    rep = {r.symbol: r for r in A.with_macro_average(A.evaluate(pairs)).collect()}
    assert rep["A"].samples == 2.0 and rep["A"].directional_accuracy == 0.5 and rep["A"].full_accuracy == 0.5
    assert rep["B"].missing_predictions == 1.0 and rep["B"].directional_accuracy == 0.0
    assert rep["Average"].samples == 1.5 and rep["Average"].directional_accuracy == 0.25


def test_cover_is_the_interval_and_small(spark):
    import random
    from mktpanel.operators import intervals as IV
    rnd = random.Random(4)
    cases = [(rnd.randrange(-2000, 20000), rnd.choice([0, 1, 6, 7, 8, 63, 64, 500, 9000])) for _ in range(300)]
    df = spark.createDataFrame([(a, a + n) for a, n in cases], "a long, b long")
    for fan in (2, 8):
        levels = 14 if fan == 2 else IV.LEVELS
        got = df.select("a", "b", IV.cover(F.col("a"), F.col("b"), fan, levels).alias("c")).collect()
        for r in got:
            days = [d for x in r.c for d in range(x.block * fan ** x.level, (x.block + 1) * fan ** x.level)]
            assert sorted(days) == list(range(r.a, r.b + 1))
            assert len(r.c) <= 2 * fan * (1 + max(x.level for x in r.c))


def test_interval_join_equals_range_join_and_its_input_does_not_grow_with_length(spark):
    from mktpanel.operators import intervals as IV
    day0 = F.lit("2000-01-01").cast("date")
    news = spark.range(600).select(F.when(F.col("id") % 3 == 0, "X").otherwise("Y").alias("symbol"),
                                   (F.lit(946684800) + F.col("id") * 86400 * 9).alias("datetime"), F.col("id").cast("string").alias("headline"),
                                   F.lit("s").alias("summary"))
    def intervals(days):
        return spark.range(40).select(F.when(F.col("id") % 2 == 0, "X").otherwise("Y").alias("symbol"), F.col("id").cast("int").alias("row_idx"),
                                      F.date_add(day0, (F.col("id") * 50).cast("int")).alias("start_date"),
                                      F.date_add(day0, (F.col("id") * 50 + days - F.col("id")).cast("int")).alias("end_date"))
    for days in (3, 30, 6000):
        got = J.news_in_intervals(intervals(days), news).select("symbol", "row_idx", "headline")
        a, iv = J.article_days(news), intervals(days)
        want = a.join(iv, (a.symbol == iv.symbol) & a.day.between(iv.start_date, iv.end_date)).select(a.symbol, "row_idx", "headline")
        assert rows(got) == rows(want) and (days == 3 or len(rows(got)) > 0)
    rows_in = {d: IV.interval_blocks(intervals(d), ["symbol"]).count() for d in (60, 600, 6000)}
    assert rows_in[6000] <= 40 * 2 * IV.FAN * IV.LEVELS and rows_in[6000] < 4 * rows_in[600] < 40 * 600
    assert J.news_in_intervals(intervals(3).limit(0), news).collect() == []


def test_lag_in_blocks_equals_lag(spark):
    from pyspark.sql import Window
    data = [("X", w, w * 10 if w % 7 else None) for w in list(range(0, 30)) + [64, 128, 200, 201, 202, 500]] + [("Y", 3, 1)]
    df = spark.createDataFrame(data, "symbol string, week_idx int, v int")
    for n in (1, 2, 3):
        want = df.withColumn("o", F.lag("v", n).over(Window.partitionBy("symbol").orderBy("week_idx")))
        for block in (1, 4, 64):
            assert rows(W.lag_in_blocks(df, "v", n, "o", block=block).select(want.columns), "symbol", "week_idx", F.coalesce("o", F.lit(-1))) \
                == rows(want, "symbol", "week_idx", F.coalesce("o", F.lit(-1)))


def test_asof_in_quarters_equals_the_plain_condition(spark):
    """Quarters without periods, periods on a week's end, several periods a quarter, symbols without any."""
    import random
    rnd = random.Random(9)
    day = lambda i: dt.date(2000, 1, 2) + dt.timedelta(days=i)
    weeks = [(s, i, day(7 * i - 7), day(7 * i)) for s in "XYZ" for i in range(150)]
    basics = [(s, day(d), {"m": float(d)}) for s in "XY" for d in {rnd.randrange(-300, 1100) for _ in range(9 if s == "X" else 2)} | {7 * 20}]
    w = spark.createDataFrame(weeks, "symbol string, week_idx int, start_date date, end_date date")
    b = spark.createDataFrame(basics + [("X", None, {"m": 1.0})], "symbol string, period date, metrics map<string,double>")
    for always in (True, False):
        got = {(r.symbol, r.week_idx): (r.basics_period, r.basics_metrics) for r in J.attach_basics(w, b, always).collect()}
        for s, i, _, end in weeks:
            last = max((p for x, p, _ in basics if x == s and p < end), default=None)
            if not always and (last is None or i < 2 or last < day(7 * (i - 2) - 7)):
                last = None
            assert got[s, i] == (last, next((m for x, p, m in basics if x == s and p == last), {})), (s, i, always)
