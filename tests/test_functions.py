"""Hand goldens for the column functions (labels, text)."""

import math

from pyspark.sql import functions as F

from mktpanel.functions import fixed
from mktpanel.functions import labels as L
from mktpanel.functions import text as T


def one_col(spark, values, typ):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")


def test_bin_label_edges(spark):
    vals = [0.0, 0.004, 0.015, -0.001, 0.05, 0.0500001, -0.25, None, float("nan"), float("inf")]
    want = ["U0", "U1", "U2", "D1", "U5", "U5+", "D5+", None, None, None]
    df = one_col(spark, vals, "double").select("i", L.bin_label("v").alias("b"))
    got = [r.b for r in df.orderBy("i").collect()]
    assert got == want


def test_bin_label_matches_python_rule(spark):
    # The rule itself: 'U' if r >= 0 else 'D', then ceil(|100 r|), above 5 -> '5+'.
    vals = [i / 997.0 - 0.06 for i in range(120)]

    def rule(r):
        n = math.ceil(abs(100 * r))
        return ("U" if r >= 0 else "D") + (str(n) if n <= 5 else "5+")

    df = one_col(spark, vals, "double").select("i", L.bin_label("v").alias("b"))
    assert [r.b for r in df.orderBy("i").collect()] == [rule(v) for v in vals]


def test_zero_start_price_gives_null_label(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "e double, s double")
    r = df.select(L.bin_label(F.try_divide("e", "s") - 1).alias("b")).first()
    assert r.b is None


def test_fuzzy_prediction_texts(spark):
    texts = ["Expected to rise 1-2% next week", "A gain of 3%", "The price may decline by 2.5-3%",
             "Shares will drop 7%", "It moves against the trend", "Prediction: Up by 1-2%", "", None]
    want = ["U1", "U3", "D2", "D5+", "U1", None, None, None]
    df = one_col(spark, texts, "string").select("i", L.predicted_label("v").alias("p"))
    assert [r.p for r in df.orderBy("i").collect()] == want


def test_strict_prediction(spark):
    texts = ["Prediction: Up by 1-2%", "Prediction: Down by more than 5%", "prediction: down by 2.5-3%",
             "It moves against the trend"]
    want = ["U2", "D5+", "D3", None]
    df = one_col(spark, texts, "string").select("i", L.predicted_label("v", strict=True).alias("p"))
    assert [r.p for r in df.orderBy("i").collect()] == want


def test_direction_and_exact_match(spark):
    df = spark.createDataFrame([("U1", "U3"), ("U1", "D1"), ("U1", None), (None, "U1"), ("D5+", "D5+")],
                               "t string, p string")
    got = [(r.d, r.e) for r in df.select(L.direction_match("t", "p").alias("d"),
                                         L.exact_match("t", "p").alias("e")).collect()]
    assert got == [(True, False), (False, False), (False, False), (False, False), (True, True)]


def test_bin_phrase_variants(spark):
    labels = ["U0", "U1", "U2", "U5", "U5+", "D3", "D5+"]
    df = one_col(spark, labels, "string")
    got = df.orderBy("i").select(L.bin_phrase("v", "v1").alias("a"), L.bin_phrase("v", "v2").alias("b")).collect()
    assert [r.a for r in got] == ["up by 0", "up by 0-1%", "up by 1-2%", "up by 4-5%", "up by more than 5%",
                                  "down by 2-3%", "down by more than 5%"]
    # The second form chains replacements over their own output.
    assert got[2].b == "Up by 0-1%-2%"

    def chained(x):
        for a, b in fixed.BIN_PHRASE_V2_STEPS:
            x = x.replace(a, b)
        return x
    assert [r.b for r in got] == [chained(x) for x in labels]


def test_week_header_equal_prices_say_decreased(spark):
    df = spark.createDataFrame([("AAPL", "2023-06-04", "2023-06-11", 10.0, 10.0)],
                               "s string, a string, b string, p double, q double")
    df = df.select("s", F.col("a").cast("date").alias("a"), F.col("b").cast("date").alias("b"), "p", "q")
    r = df.select(T.week_header("s", "a", "b", "p", "q").alias("h"),
                  T.week_header("s", "a", "b", "p", "q", variant="earlier").alias("e")).first()
    assert r.h == "From 2023-06-04 to 2023-06-11, AAPL's stock price decreased from 10.00 to 10.00."
    assert r.e.endswith("News during this period are listed below:\n\n")


def test_basics_highlights_fallbacks(spark):
    schema = "p date, m map<string,double>"
    data = [
        (None, {}),                                                   # no basics
        ("2023-03-31", {"peTTM": -1.0, "roeTTM": 0.1}),               # all below thresholds
        ("2023-03-31", {"peTTM": 12.5, "roeTTM": None, "netMargin": 0.5}),  # present NULL stops
        ("2023-03-31", {"peTTM": 12.5, "roeTTM": 0.31, "totalDebtToEquity": 2.5, "roaTTM": 0.2}),
    ]
    df = spark.createDataFrame([(None if p is None else __import__("datetime").date.fromisoformat(p), m)
                                for p, m in data], schema)
    got = [r.h for r in df.select(T.basics_highlights("p", "m").alias("h")).collect()]
    assert got[0] == "[Basic Financials]:\n\nNo basic financials reported."
    assert got[1] == "[Basic Financials Summary]:\n\nNo strong indicators reported."
    assert got[2] == "[Basic Financials Summary]:\n\nHigh valuation (P/E: 12.5), Financial summary unavailable."
    assert got[3] == ("[Basic Financials Summary]:\n\nHigh valuation (P/E: 12.5), Strong return on equity (ROE: 0.31), "
                      "High leverage (Debt/Equity: 2.5), Efficient asset utilization (ROA: 0.2)")


def test_basics_highlights_list_variant(spark):
    df = spark.createDataFrame([({"peTTM": -3.0, "operatingMargin": 0.25, "netMargin": 0.3},)], "m map<string,double>")
    r = df.select(T.basics_highlights_list("m").alias("h")).first()
    # P/E is listed whenever present; operating margin needs > 0.3 here.
    assert r.h == ["High valuation (P/E: -3.0)", "Solid profitability (Net Margin: 0.3)"]


def test_news_text_and_article_forms(spark):
    df = spark.createDataFrame([(None, "s1"), ("h2", "s2")], "h string, s string")
    r = df.select(F.collect_list(T.article_text("h", "s")).alias("a"),
                  F.collect_list(T.article_text("h", "s", "earlier")).alias("b")).first()
    assert sorted(r.a) == ["- None: s1", "- h2: s2"]
    assert "[Headline]: None\n[Summary]: s1\n" in r.b
    e = spark.createDataFrame([([],)], "a array<string>").select(T.news_text("a").alias("t")).first()
    assert e.t == fixed.NO_NEWS_LATER


def test_strip_prompt_and_py_strip(spark):
    df = spark.createDataFrame([("PROMPT\n\n  answer text 　\n", "PROMPT"), (None, "P"), ("P", "P")],
                               "g string, p string")
    got = [r.a for r in df.select(T.strip_prompt("g", "p").alias("a")).collect()]
    assert got == ["answer text", "", ""]


def test_inject_label_and_rewrite(spark):
    ans = "[Positive Developments]:\n1. x\n\n[Prediction & Analysis]:\n  Rates $5 \\ up"
    df = spark.createDataFrame([(ans, "up by more than 5%")], "a string, l string")
    r = df.select(T.inject_label("a", "l").alias("x")).first()
    assert r.x.endswith("[Prediction & Analysis]:\nPrediction: Up by more than 5%\nAnalysis: Rates $5 \\ up")
    sent = fixed.ASSUME_SENTENCE.format(period="2023-06-04 to 2023-06-11", phrase="down by 1-2%")
    df = spark.createDataFrame([("head\n\n" + sent, "A$B")], "p string, s string")
    period, label, matched = T.extract_period_label("p")
    r = df.select(period.alias("period"), label.alias("label"), matched.alias("m"),
                  T.rewrite_request("p", "s", period).alias("rw")).first()
    assert (r.period, r.label, r.m) == ("2023-06-04 to 2023-06-11", "down by 1-2%", True)
    assert r.rw == ("head\n\nThen make your prediction of the A$B cryptocurrency price movement for next week "
                    "(2023-06-04 to 2023-06-11). Provide a summary analysis to support your prediction.")


def test_news_stamp_is_utc(spark):
    df = spark.createDataFrame([(915321600 + 3661,)], "e bigint")
    r = df.select(T.news_stamp("e").alias("s"), T.news_day("e").alias("d")).first()
    assert r.s == "19990103010101" and str(r.d) == "1999-01-03"


def test_training_system_prompt_rewrites_last_section(spark):
    df = spark.createDataFrame([("company",)], "c string")
    r = df.select(T.training_system_prompt(T.system_prompt("c")).alias("s")).first()
    assert r.s.endswith("[Prediction & Analysis]\nPrediction: ...\nAnalysis: ...\n")
    assert "[Positive Developments]:\n1. ..." in r.s


def test_number_text_equals_python(spark):
    import random

    from mktpanel.functions import text as T
    rng = random.Random(1)
    xs = [1.005, 0.125, 2.675, 1e7, 0.0005, 0.0, -0.0, -0.001, 1e15, 1e16, 1e-5, 1.5e-7, 99.995, 1e22, -1e-4,
          float("nan"), float("inf"), float("-inf"), None]
    xs += [rng.randrange(10 ** 7) / 1000 for _ in range(300)] + [rng.randrange(10 ** 6) / 8 for _ in range(300)]
    xs += [rng.uniform(-1e6, 1e6) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in df.select("x", T.money("x").alias("m"), T.num_text("x").alias("n")).collect():
        assert (r.m, r.n) == (("None", "None") if r.x is None else (f"{r.x:.2f}", str(r.x)))


def test_number_text_is_the_shortest_on_any_java(spark):
    """Values for which older platforms write a digit or more too many, beside random ones of every size."""
    import random
    import struct
    rnd = random.Random(6)
    values = [2e23, 1.1e23, 2.0 ** -44, 2.0 ** 60, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 9007199254740993.0, 0.1 + 0.2,
              8.41e21, 2.0 ** 70, 9.999999999999999e22, 1e-5, 123456789012345680.0, -4.35e-5, 0.0, -0.0, 100.0, 1e16, 1e15, 99999.99999999999]
    values += [2.0 ** k for k in range(-60, 64)] + [10.0 ** k for k in range(-30, 30)]
    values += [rnd.uniform(-1, 1) * 10 ** rnd.randrange(-6, 19) for _ in range(4000)]
    odd = [struct.unpack("<d", rnd.randbytes(8))[0] for _ in range(3000)]
    values += [x for x in odd if x == x and abs(x) != float("inf")]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    for r in df.select("x", T.num_text("x").alias("s")).collect():
        if 1e-6 <= abs(r.x) < 9.2e18 or r.x == 0:
            assert r.s == repr(r.x), (repr(r.x), r.s)
        assert float(r.s) == r.x and (len(r.s) == len(repr(r.x)) or abs(r.x) < 2.3e-308)


def test_number_text_of_common_values_is_compiled(spark):
    """Ordinary amounts meet no lambda (which Spark interprets value by value) before they are written."""
    import random
    for column, written in ((T.money("x"), "lpad("), (T.num_text("x"), "rint(")):
        plan = spark.range(1).select(F.col("id").cast("double").alias("x")).select(column.alias("t"))._jdf.queryExecution().analyzed().toString()
        assert written in plan.split("lambda")[0]
    rnd = random.Random(8)
    cents = [rnd.randrange(10 ** rnd.randrange(1, 9)) for _ in range(2000)] + list(range(0, 4000, 4))
    xs = [y for k in cents for y in (k / 800, k / 100 / 8, k / 100 / 1000, k / 100 * 1e6, -k / 800, k / 1000, k / 200)]
    for edge in (0.001, 0.005, 0.5, 1.0, 1e7, 1e13, 2.0 ** 53, 1e16, 1e18):
        steps = [math.nextafter(edge, 0), edge, math.nextafter(edge, math.inf), edge - 0.5, edge + 0.125, edge + 0.375, edge + 0.995]
        xs += [sign * y for y in steps for sign in (1, -1)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in df.select("x", T.money("x").alias("m"), T.num_text("x").alias("n")).collect():
        assert (r.m, r.n) == (f"{r.x:.2f}", str(r.x))
