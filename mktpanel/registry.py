"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query derives its inputs from the driver's tables (``sources.fixtures``)
and runs one operator or composite job over the whole tables.  Queries that
exercise a sink write under the session's shared checkpoint folder and read
the result back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mktpanel.functions import fixed
from mktpanel.functions import labels as L
from mktpanel.functions import text as T
from mktpanel.operators import aggregates as A
from mktpanel.operators import filters as FL
from mktpanel.operators import joins as J
from mktpanel.operators import sampling as K
from mktpanel.operators import timeseries as TS
from mktpanel.operators import windows as W
from mktpanel.plans import dataset as D
from mktpanel.plans import evaluate as EV
from mktpanel.plans import generate as G
from mktpanel.plans import online as ON
from mktpanel.plans import panel as P
from mktpanel.plans import prompts as PR
from mktpanel.plans import run as RUN
from mktpanel.session import materialize, shared_dir
from mktpanel.sources import fixtures as fx
from mktpanel.sources import readers as R
from mktpanel.sources import universe as U
from mktpanel.sources.answer_log import AnswerLog

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered queries (the run defaults where one exists).
SCAN_START, SCAN_END = "1996-01-01", "2000-01-01"
RUN_START, RUN_END = "1998-01-01", "1999-07-01"
CURDAY = "1999-06-16"
ONLINE_WEEKS = fixed.DEFAULT_ONLINE_WEEKS
MIN_WEEKS, MAX_WEEKS, RATIO = fixed.DEFAULT_MIN_WEEKS, fixed.DEFAULT_MAX_WEEKS, fixed.DEFAULT_TRAIN_RATIO
TOP_K = fixed.NEWS_TOP_K
SEED = 0
ANSWER_BATCHES = 4
LONG_DAYS = 1461       # days of the longest interval of news_long_intervals
NEWS_PAGE = 2          # articles a page: small, so that the tables' weeks have several


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(QUERIES)


# ------------------------------------------------------------ shared inputs


class Ctx:
    """Inputs of one query call, each built at most once and shared by its branches."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d
        self._cache: dict = {}

    def _get(self, key, make):
        if key not in self._cache:
            self._cache[key] = make()
        return self._cache[key]

    @property
    def counts(self):
        # Small (brands x days x line numbers) and read by both prices and
        # fundamentals: written once so ``lineitem`` is scanned once per query.
        return self._get("counts", lambda: materialize(fx.line_counts(self.spark, self.d), "line-counts"))

    @property
    def prices(self):
        return self._get("prices", lambda: fx.prices(self.spark, self.d, self.counts))

    @property
    def news(self):
        return self._get("news", lambda: fx.news(self.spark, self.d))

    @property
    def basics_long(self):
        return self._get("basics_long", lambda: fx.basics_long(self.spark, self.d, self.counts))

    @property
    def profiles(self):
        return self._get("profiles", lambda: fx.profiles(self.spark, self.d))

    @property
    def members(self):
        return self._get("members", lambda: fx.index_members(self.spark, self.d))

    @property
    def panel(self) -> P.Panel:
        return self._get("panel", lambda: P.build_panel(self.prices, self.news, self.basics_long))

    @property
    def weeks(self):
        """Weekly return rows (from the materialised panel when one is built)."""
        return self.panel.weekly

    @property
    def prompts(self):
        return self._get("prompts", lambda: PR.build_prompts(self.panel, self.profiles, self.members,
                                                              MIN_WEEKS, MAX_WEEKS))

    @property
    def answers(self):
        return self._get("answers", lambda: G.generate_answers(self.prompts, None, G.canned_generator))

    @property
    def outcomes(self):
        """Answers without their prompts, for those who score them."""
        return self._get("outcomes", lambda: G.generate_answers(self.prompts, None, G.canned_generator, keep_prompt=False))

    @property
    def recent(self) -> ON.RecentPanel:
        return self._get("recent", lambda: ON.recent_panel(self.prices, self.news, self.members, CURDAY,
                                                            ONLINE_WEEKS))

    @property
    def training(self):
        return self._get("training", lambda: D.training_rows(self.answers, self.weeks, self.members).rows)


def _weekly(spark, d):
    return TS.weekly_returns(fx.prices(spark, d))


def _article_weeks(spark, d) -> DataFrame:
    return J.attach_news(_weekly(spark, d), fx.news(spark, d))


def _list_text(arr) -> F.Column:
    return F.array_join(arr, "\n")


# ------------------------------------------------------------ 2.1 sources and sinks


@register("scan_prices")
def q_scan_prices(spark, d):
    path = shared_dir(spark, "prices")
    fx.prices(spark, d).write.mode("overwrite").partitionBy("symbol").parquet(path)
    return (R.read_prices(spark, path, SCAN_START, SCAN_END)
             .select("symbol", "date", "close", "adj_close", "volume"))


@register("unpivot_prices")
def q_unpivot_prices(spark, d):
    # The provider's files: one column per symbol and field, two files of different years.
    path, prices = shared_dir(spark, "wide-prices"), materialize(fx.prices(spark, d), "prices")
    symbols = [r.symbol for r in prices.select("symbol").distinct().orderBy("symbol").collect()]     # the fixture's columns
    for part, years in (("early", F.year("date") < 1996), ("late", F.year("date") >= 1996)):
        R.to_wide(prices.where(years), symbols).coalesce(1).write.option("header", True).csv(f"{path}/{part}")
    return R.read_wide_prices(spark, f"{path}/*").select("symbol", "date", "close", "adj_close", "volume")


@register("unpivot_price_maps")
def q_unpivot_price_maps(spark, d):
    by_date = R.prices_by_date(fx.prices(spark, d))
    return R.unpivot_price_maps(by_date).select("symbol", "date", "close", "adj_close", "volume")


@register("price_field")
def q_price_field(spark, d):
    return TS.price_field(fx.prices(spark, d)).select("symbol", "date", "price")


@register("scan_news")
def q_scan_news(spark, d):
    path = shared_dir(spark, "news")
    R.write_news(fx.news(spark, d), path)
    return R.read_news(spark, path)


@register("scan_basics")
def q_scan_basics(spark, d):
    path = shared_dir(spark, "basics")
    R.basics_raw(fx.basics_long(spark, d)).write.mode("overwrite").json(path)
    return R.read_basics_files(spark, path).select("symbol", "period", "metric", "v")


@register("scan_profiles")
def q_scan_profiles(spark, d):
    path = shared_dir(spark, "profiles")
    fx.profiles(spark, d).write.mode("overwrite").json(path)
    return R.read_profiles(spark, path)


@register("universe")
def q_universe(spark, d):
    return U.universe(fx.index_members(spark, d), "dow")


@register("panel_roundtrip")
def q_panel_roundtrip(spark, d):
    path = shared_dir(spark, "panel")
    panel = Ctx(spark, d).panel
    R.write_panel(panel.weeks, panel.news, path)
    weeks, news = R.read_panel(spark, path)
    return P.panel_summary(P.Panel(weeks, news))


@register("panel_json_roundtrip")
def q_panel_json_roundtrip(spark, d):
    path = shared_dir(spark, "panel-json")
    panel = Ctx(spark, d).panel
    R.write_panel_json(panel.weeks, panel.news, path)
    weeks, news = R.read_panel_json(spark, path)
    return P.panel_summary(P.Panel(weeks, news))


@register("answers_append")
def q_answers_append(spark, d):
    log = AnswerLog(spark, shared_dir(spark, "answers"), ANSWER_BATCHES)
    prompts = materialize(Ctx(spark, d).prompts, "prompts")
    for _ in range(2):       # the second run finds every prompt answered and commits nothing
        log.append(prompts, lambda some, old: G.generate_answers(some, old, G.canned_generator))
    return log.read().select("symbol", "week_idx", "answer")


@register("dataset_roundtrip")
def q_dataset_roundtrip(spark, d):
    path = shared_dir(spark, "dataset")
    R.write_dataset(D.create_dataset(Ctx(spark, d).training, RATIO), path)
    return R.read_dataset(spark, path).select(*D.DATASET_COLUMNS)


@register("evaluation_roundtrip")
def q_evaluation_roundtrip(spark, d):
    path = shared_dir(spark, "evaluation")
    c = Ctx(spark, d)
    R.write_evaluation(EV.evaluation_report(c.weeks, c.outcomes), path)
    return R.read_evaluation(spark, path)


@register("pending_symbols")
def q_pending_symbols(spark, d):
    # Symbols of one index have their panel written already.
    c = Ctx(spark, d)
    path = shared_dir(spark, "panel")
    done = c.members.where(F.col("index_name") == "dow").select("symbol")
    panel = P.build_panel(c.prices.join(done, "symbol", "left_semi"), c.news.join(done, "symbol", "left_semi"),
                          None, with_basics=False)
    R.write_panel(panel.weeks, panel.news, path)
    return R.pending_symbols(c.members, R.read_panel(spark, path)[0])


# ------------------------------------------------------------ 2.2 filters


@register("asset_class")
def q_asset_class(spark, d):
    w = _weekly(spark, d).select("symbol", "week_idx")
    return U.with_asset_class(w, fx.index_members(spark, d))


@register("drop_boilerplate")
def q_drop_boilerplate(spark, d):
    return FL.drop_boilerplate(fx.news(spark, d))


@register("news_cutoff")
def q_news_cutoff(spark, d):
    # Every article of the weeks around the day meets every interval of its symbol that began before it.
    c = Ctx(spark, d)
    day = F.lit(CURDAY).cast("date")
    near = J.article_days(c.news).where(F.col("day").between(F.date_sub(day, 7 * ONLINE_WEEKS), F.date_add(day, 14)))
    uncut = near.join(c.recent.intervals, "symbol").where(F.col("day") >= F.col("start_date"))
    return FL.news_cutoff(uncut).select("symbol", "row_idx", "date", "headline", "summary")


@register("usable_answers")
def q_usable_answers(spark, d):
    return FL.usable_answers(Ctx(spark, d).outcomes).select("symbol", "week_idx", "answer")


@register("empty_basics")
def q_empty_basics(spark, d):
    w = FL.with_empty_basics(_weekly(spark, d))
    return w.select("symbol", "week_idx", "basics_period", F.size("basics_metrics").alias("n_metrics"))


# ------------------------------------------------------------ 2.3 time series


@register("weekly_close")
def q_weekly_close(spark, d):
    return TS.weekly_close(fx.prices(spark, d))


@register("weekly_ffill")
def q_weekly_ffill(spark, d):
    return TS.weekly_ffill(TS.weekly_close(fx.prices(spark, d)))


@register("pct_change")
def q_pct_change(spark, d):
    return TS.pct_change(TS.weekly_ffill(TS.weekly_close(fx.prices(spark, d))), "price")


@register("interval_pairs")
def q_interval_pairs(spark, d):
    return TS.interval_pairs(TS.weekly_ffill(TS.weekly_close(fx.prices(spark, d))), date_col="week_end")


@register("step_grid")
def q_step_grid(spark, d):
    return TS.symbol_steps(fx.index_members(spark, d), CURDAY, ONLINE_WEEKS)


@register("asof_forward")
def q_asof_forward(spark, d):
    steps = TS.symbol_steps(fx.index_members(spark, d), CURDAY, ONLINE_WEEKS)
    return TS.asof_forward(steps, fx.prices(spark, d), CURDAY, ONLINE_WEEKS)


@register("recent_intervals")
def q_recent_intervals(spark, d):
    c = Ctx(spark, d)
    return TS.recent_intervals(c.members, c.prices, CURDAY, ONLINE_WEEKS)


# ------------------------------------------------------------ 2.4 joins


@register("news_interval_join")
def q_news_interval_join(spark, d):
    return _article_weeks(spark, d)


@register("news_long_intervals")
def q_news_long_intervals(spark, d):
    # Every week opens an interval of up to four years: long, irregular and overlapping.
    length = (F.col("week_idx") * 37 + 1) % LONG_DAYS
    iv = _weekly(spark, d).select("symbol", F.col("week_idx").alias("row_idx"), "start_date",
                                  F.date_add("start_date", length.cast("int")).alias("end_date"))
    found = J.news_in_intervals(iv, fx.news(spark, d))
    return found.groupBy("symbol", "row_idx", "start_date", "end_date").agg(
        F.count(F.lit(1)).alias("n_news"), P.articles_digest().alias("news_digest"))


def _basics_asof(spark, d, always):
    c = Ctx(spark, d)
    w = J.attach_basics(TS.weekly_returns(c.prices), A.pivot_basics(c.basics_long), always=always)
    return w.select("symbol", "week_idx", "end_date", "basics_period",
                    T.metrics_lines("basics_metrics").alias("metrics_text"))


@register("basics_asof_window")
def q_basics_asof_window(spark, d):
    return _basics_asof(spark, d, False)


@register("basics_asof_always")
def q_basics_asof_always(spark, d):
    return _basics_asof(spark, d, True)


@register("basics_asof_recent")
def q_basics_asof_recent(spark, d):
    # Irregular rows: the row two back does not start three weeks before.
    c = Ctx(spark, d)
    rows = c.recent.intervals.withColumnRenamed("row_idx", "week_idx")
    w = J.attach_basics(rows, A.pivot_basics(c.basics_long))
    return w.select("symbol", "week_idx", "end_date", "basics_period",
                    T.metrics_lines("basics_metrics").alias("metrics_text"))


@register("current_basics")
def q_current_basics(spark, d):
    cur = J.current_basics(A.pivot_basics(fx.basics_long(spark, d)), CURDAY)
    return cur.select("symbol", "period", T.metrics_lines("metrics").alias("metrics_text"))


@register("pair_by_key")
def q_pair_by_key(spark, d):
    c = Ctx(spark, d)
    return EV.prediction_pairs(c.weeks, c.outcomes, align="key")


@register("pair_by_position")
def q_pair_by_position(spark, d):
    c = Ctx(spark, d)
    return EV.prediction_pairs(c.weeks, c.outcomes, align="position")


@register("profile_join")
def q_profile_join(spark, d):
    w = J.attach_profile(_weekly(spark, d).select("symbol", "week_idx"), fx.profiles(spark, d))
    return w.select("symbol", "week_idx", "name", "finnhubIndustry", "marketCapitalization")


@register("pending_prompts")
def q_pending_prompts(spark, d):
    c = Ctx(spark, d)
    return J.pending_prompts(c.prompts, FL.usable_answers(c.outcomes)).select("symbol", "week_idx")


# ------------------------------------------------------------ 2.5 aggregations


@register("collect_news")
def q_collect_news(spark, d):
    lists = A.collect_news(_article_weeks(spark, d), page_rows=NEWS_PAGE)
    item = lambda e: F.concat_ws("|", e["date"], F.coalesce(e["headline"], F.lit("None")), e["summary"])
    return lists.select("symbol", "week_idx", "page", "n_page", "n_news", _list_text(F.transform("news", item)).alias("news_list"))


@register("pivot_basics")
def q_pivot_basics(spark, d):
    # One metric is listed again with a later, smaller value.
    b = Ctx(spark, d).basics_long.withColumn("pos", F.lit(0))
    later = b.where(F.col("metric") == "peTTM").withColumn("v", F.col("v") - 0.5).withColumn("pos", F.lit(1))
    return A.pivot_basics(b.unionByName(later)).select("symbol", "period", T.metrics_lines("metrics").alias("metrics_text"))


@register("evaluate")
def q_evaluate(spark, d):
    c = Ctx(spark, d)
    return A.evaluate(EV.prediction_pairs(c.weeks, c.outcomes))


@register("evaluate_with_average")
def q_evaluate_with_average(spark, d):
    c = Ctx(spark, d)
    return A.with_macro_average(A.evaluate(EV.prediction_pairs(c.weeks, c.outcomes, align="key")))


# ------------------------------------------------------------ 2.6 windows


def _headers(spark, d):
    w = _weekly(spark, d)
    return w.withColumn("header", T.week_header("symbol", "start_date", "end_date", "start_price", "end_price"))


@register("history_window")
def q_history_window(spark, d):
    h = W.history_window(_headers(spark, d), "header", MAX_WEEKS)
    return h.select("symbol", "week_idx", F.size("history").alias("n_history"),
                    F.array_join("history", " | ").alias("history_text"))


@register("history_gate")
def q_history_gate(spark, d):
    h = W.history_gate(W.history_window(_headers(spark, d), "header", MAX_WEEKS), MIN_WEEKS)
    return h.select("symbol", "week_idx", F.size("history").alias("n_history"))


@register("week_index")
def q_week_index(spark, d):
    f = TS.weekly_ffill(TS.weekly_close(fx.prices(spark, d)))
    return TS.with_week_idx(f, order="week_end")


@register("chrono_split")
def q_chrono_split(spark, d):
    return W.chrono_split(_weekly(spark, d).select("symbol", "week_idx"), RATIO)


# ------------------------------------------------------------ 2.7 top-k, sampling


@register("top_news")
def q_top_news(spark, d):
    return K.top_news(_article_weeks(spark, d), TOP_K).select("symbol", "week_idx", "rn", "date", "headline", "summary")


@register("sample_news")
def q_sample_news(spark, d):
    s = K.sample_news(_article_weeks(spark, d), TOP_K, SEED)
    return s.select("symbol", "week_idx", "rn", "date", "headline", "summary")


# ------------------------------------------------------------ 2.8 set operations


@register("union_symbols")
def q_union_symbols(spark, d):
    c = Ctx(spark, d)
    prices, members = c.prices, c.members
    dow = members.where(F.col("index_name") == "dow").select("symbol")
    a = TS.weekly_returns(prices.join(dow, "symbol", "left_semi"))
    b = TS.weekly_returns(prices.join(dow, "symbol", "left_anti"))
    return a.unionByName(b)


# ------------------------------------------------------------ 2.9 column functions


@register("bin_label")
def q_bin_label(spark, d):
    daily = TS.price_field(fx.prices(spark, d))
    r = TS.pct_change(daily, "price", order="date", out_col="ret")
    return r.select("symbol", "date", "ret", L.bin_label("ret").alias("bin_label"))


@register("bin_phrase")
def q_bin_phrase(spark, d):
    w = _weekly(spark, d)
    return w.select("symbol", "week_idx", "bin_label", L.bin_phrase("bin_label", "v1").alias("phrase_v1"),
                    L.bin_phrase("bin_label", "v2").alias("phrase_v2"))


@register("week_header")
def q_week_header(spark, d):
    w = _weekly(spark, d)
    args = ("symbol", "start_date", "end_date", "start_price", "end_price")
    return w.select("symbol", "week_idx", T.week_header(*args, variant="later").alias("header_later"),
                    T.week_header(*args, variant="earlier").alias("header_earlier"))


@register("news_text")
def q_news_text(spark, d):
    blocks = PR.week_blocks(Ctx(spark, d).panel)
    return blocks.select("symbol", "week_idx", "news_text")


@register("basics_text")
def q_basics_text(spark, d):
    c = Ctx(spark, d)
    w = J.attach_basics(TS.weekly_returns(c.prices), A.pivot_basics(c.basics_long), always=True)
    return w.select("symbol", "week_idx", T.basics_text("symbol", "basics_period", "basics_metrics").alias("basics_text"))


@register("basics_highlights")
def q_basics_highlights(spark, d):
    c = Ctx(spark, d)
    w = J.attach_basics(TS.weekly_returns(c.prices), A.pivot_basics(c.basics_long))
    return w.select("symbol", "week_idx", T.basics_highlights("basics_period", "basics_metrics").alias("highlights"))


@register("basics_highlights_list")
def q_basics_highlights_list(spark, d):
    c = Ctx(spark, d)
    w = J.attach_basics(TS.weekly_returns(c.prices), A.pivot_basics(c.basics_long), always=True)
    h = T.basics_highlights_list("basics_metrics")
    return w.select("symbol", "week_idx", F.size(h).alias("n_highlights"), _list_text(h).alias("highlights"))


@register("company_intro")
def q_company_intro(spark, d):
    p = fx.profiles(spark, d)
    return p.select("symbol", T.company_intro(variant="later").alias("intro_later"),
                    T.company_intro(variant="earlier").alias("intro_earlier"))


@register("crypto_intro")
def q_crypto_intro(spark, d):
    return fx.profiles(spark, d).select("symbol", T.crypto_intro().alias("intro"))


@register("system_prompt")
def q_system_prompt(spark, d):
    m = fx.index_members(spark, d)
    s = T.system_prompt("asset_class")
    return m.select("symbol", s.alias("system_prompt"), T.training_system_prompt(s).alias("training_system_prompt"))


@register("extract_period_label")
def q_extract_period_label(spark, d):
    p = D.old_form_prompts(_weekly(spark, d))
    period, label, matched = T.extract_period_label("prompt")
    return p.select("symbol", "week_idx", period.alias("period"), label.alias("label"), matched.alias("matched"))


@register("rewrite_request")
def q_rewrite_request(spark, d):
    p = D.old_form_prompts(_weekly(spark, d))
    period, _, matched = T.extract_period_label("prompt")
    p = p.where(matched).withColumn("period", period)
    return p.select("symbol", "week_idx", T.rewrite_request("prompt", "symbol", "period").alias("prompt"))


@register("inject_label")
def q_inject_label(spark, d):
    c = Ctx(spark, d)
    a = c.outcomes.join(c.weeks.select("symbol", "week_idx", "bin_label"), ["symbol", "week_idx"])
    a = a.where(F.col("bin_label").isNotNull())
    return a.select("symbol", "week_idx", T.inject_label("answer", L.bin_phrase("bin_label")).alias("answer"))


@register("strip_prompt")
def q_strip_prompt(spark, d):
    # Generated texts echo the prompt; every eighth call failed.
    p = Ctx(spark, d).prompts
    said = F.concat("prompt", F.lit("\n\t Outlook for "), "symbol", F.lit(" week "), F.col("week_idx").cast("string"),
                    F.lit(" \r\n"))
    generated = F.when(F.col("week_idx") % 8 != 7, said)
    return p.select("symbol", "week_idx", T.strip_prompt(generated, "prompt").alias("answer"))


@register("number_text")
def q_number_text(spark, d):
    price = F.col("l_extendedprice").cast("double")
    rows = fx.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.explode(F.array(price / 8, price / 1000, price * 1e6)).alias("x"))
    return rows.select("l_orderkey", "l_linenumber", "x", T.money("x").alias("money_text"), T.num_text("x").alias("plain_text"))


@register("predicted_label")
def q_predicted_label(spark, d):
    a = Ctx(spark, d).outcomes
    return a.select("symbol", "week_idx", "answer", L.predicted_label("answer").alias("pred_label"))


# ------------------------------------------------------------ 2.10 composite jobs


@register("weekly_returns")
def q_weekly_returns(spark, d):
    return _weekly(spark, d)


@register("build_panel")
def q_build_panel(spark, d):
    return P.panel_summary(Ctx(spark, d).panel)


@register("build_prompts")
def q_build_prompts(spark, d):
    return Ctx(spark, d).prompts.select("symbol", "week_idx", "start_date", "end_date", "prompt")


@register("generate_answers")
def q_generate_answers(spark, d):
    return Ctx(spark, d).answers


@register("generate_outcomes")
def q_generate_outcomes(spark, d):
    c = Ctx(spark, d)
    return G.generate_outcomes(c.prompts, None, G.canned_generator).select("symbol", "week_idx", "answer", "attempts", "error")


@register("training_rows")
def q_training_rows(spark, d):
    return Ctx(spark, d).training


def _old_form_rows(spark, d):
    # Prompts in the old request form, each with one answer; weeks without a class phrase have no match.
    c = Ctx(spark, d)
    old = D.old_form_prompts(TS.weekly_returns(c.prices))
    answers = old.select("symbol", "week_idx", "prompt", F.lit("[Prediction & Analysis]:\nA plain outlook.").alias("answer"))
    answers = answers.where(F.col("prompt").isNotNull())
    return D.training_rows(answers, None, c.members, label_source="regex")


@register("training_rows_regex")
def q_training_rows_regex(spark, d):
    return _old_form_rows(spark, d).rows


@register("training_rejects")
def q_training_rejects(spark, d):
    return _old_form_rows(spark, d).rejects


@register("create_dataset")
def q_create_dataset(spark, d):
    return D.create_dataset(Ctx(spark, d).training, RATIO)


@register("evaluation_report")
def q_evaluation_report(spark, d):
    c = Ctx(spark, d)
    return EV.evaluation_report(c.weeks, c.outcomes)


@register("skipped_symbols")
def q_skipped_symbols(spark, d):
    # Answers of one index only: the others' weeks have none.
    c = Ctx(spark, d)
    dow = c.members.where(F.col("index_name") == "dow").select("symbol")
    return EV.skipped_symbols(c.weeks, c.outcomes.join(dow, "symbol", "left_semi"))


@register("recent_panel")
def q_recent_panel(spark, d):
    rp = Ctx(spark, d).recent
    n = rp.news.groupBy("symbol", "row_idx").agg(F.count(F.lit(1)).alias("n_news"), P.articles_digest().alias("news_digest"))
    out = rp.intervals.join(n, ["symbol", "row_idx"], "left")
    return out.select("symbol", "row_idx", "start_date", "end_date", "start_price", "end_price",
                      F.coalesce("n_news", F.lit(0)).alias("n_news"),
                      F.coalesce("news_digest", F.lit(0)).alias("news_digest"))


@register("online_prompts")
def q_online_prompts(spark, d):
    c = Ctx(spark, d)
    return ON.online_prompts(c.recent, c.profiles, c.basics_long, c.members, CURDAY, with_basics=True, seed=SEED)


def _full_run(spark, d, index_name, start=None, end=None):
    c = Ctx(spark, d)
    return RUN.run_all(spark, c.prices, c.news, c.basics_long, c.profiles, c.members, shared_dir(spark, "run"),
                       G.canned_generator, index_name=index_name, start_date=start, end_date=end,
                       min_weeks=MIN_WEEKS, max_weeks=MAX_WEEKS, train_ratio=RATIO,
                       answer_batches=ANSWER_BATCHES)


@register("full_run")
def q_full_run(spark, d):
    return _full_run(spark, d, "dow")


@register("full_run_range")
def q_full_run_range(spark, d):
    return _full_run(spark, d, "dow", RUN_START, RUN_END)


@register("full_run_euro")
def q_full_run_euro(spark, d):
    return _full_run(spark, d, "euro")


@register("full_run_crypto")
def q_full_run_crypto(spark, d):
    return _full_run(spark, d, "crypto")
