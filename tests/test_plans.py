"""Composite jobs at sf0.001: invariants, resume behaviour and plan shape."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from mktpanel.plans import dataset as D
from mktpanel.plans import generate as G
from mktpanel.plans import panel as P
from mktpanel.plans import prompts as PR
from mktpanel.plans import run as RUN
from mktpanel.session import materialize, shared_dir
from mktpanel.sources import fixtures as fx
from mktpanel.sources import readers as R
from mktpanel.sources.answer_log import AnswerLog
from tests.conftest import SF_SMALL, rows


def plan_text(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def panel(spark):
    return P.build_panel(fx.prices(spark, SF_SMALL), fx.news(spark, SF_SMALL), fx.basics_long(spark, SF_SMALL))


@pytest.fixture(scope="module")
def prompts(spark, panel):
    return PR.build_prompts(panel, fx.profiles(spark, SF_SMALL), fx.index_members(spark, SF_SMALL), 1, 4)


def test_weeks_are_contiguous_sundays(panel):
    bad = (panel.weeks.where((F.datediff("end_date", "start_date") != 7) | (F.dayofweek("end_date") != 1)).count())
    assert bad == 0
    stats = panel.weeks.groupBy("symbol").agg(F.count("*").alias("n"), F.max("week_idx").alias("m"),
                                              F.min("week_idx").alias("lo")).collect()
    assert all(r.n == r.m + 1 and r.lo == 0 for r in stats)


def test_weekly_returns_independent_of_input_order(spark):
    prices = fx.prices(spark, SF_SMALL)
    a = P.weekly_returns(prices)
    b = P.weekly_returns(prices.repartition(7).orderBy(F.rand(3)))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_panel_plan_has_no_nested_loop_or_cartesian(panel):
    for df in (panel.weeks, panel.news):
        txt = plan_text(df)
        assert "CartesianProduct" not in txt and "BroadcastNestedLoopJoin" not in txt


def test_prompt_plan_is_jvm_only_and_topk_is_map_side(panel, prompts):
    txt = plan_text(PR.week_blocks(panel)) + plan_text(prompts)      # the blocks are written, then joined
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert python_node not in txt
    # top-5 articles per week: partial limit before the shuffle and a final one after it
    assert txt.count("WindowGroupLimit") >= 2


def test_no_text_moves_or_is_sorted_by_symbol_alone(panel, prompts):
    """Exchanges, sorts and windows keyed by symbol alone carry keys, not blocks or articles."""
    seen = 0
    for df in (PR.week_blocks(panel), prompts):
        for node in re.split(r"\n\s*\n", plan_text(df, "formatted")):
            if re.match(r"\s*\(\d+\) (Exchange|Sort|Window)\b", node) and re.search(
                    r"hashpartitioning\(symbol#\d+, \d+\)|: \[symbol#\d+ ASC NULLS FIRST\]|, \[symbol#\d+\], \[week_idx", node):
                seen += 1
                assert not re.search(r"\b(block|_text|text|news|summary|prompt)#", node), node
    assert seen >= 2


def test_history_size_is_min_of_week_and_max(spark, panel):
    from mktpanel.operators.windows import history_window
    blocks = PR.week_blocks(panel)
    h = history_window(blocks, "block", 4)
    assert h.where(F.size("history") != F.least(F.col("week_idx"), F.lit(4))).count() == 0


def test_generation_resumes_and_second_run_is_empty(spark, prompts):
    path = shared_dir(spark, "answers-test")
    first = G.generate_answers(prompts, None, G.canned_generator)
    R.append_answers(first, path)
    again = G.generate_answers(prompts, R.read_answers(spark, path), G.canned_generator)
    assert again.count() == 0
    # A partial file (as after a crash) is completed, not duplicated.
    part = shared_dir(spark, "answers-part")
    R.append_answers(first.where(F.col("week_idx") % 2 == 0), part)
    R.append_answers(G.generate_answers(prompts, R.read_answers(spark, part), G.canned_generator), part)
    done = R.read_answers(spark, part)
    assert done.count() == prompts.count() == done.select("symbol", "week_idx").distinct().count()


def test_failed_generation_yields_empty_answer(spark, prompts):
    def factory():
        def fn(pdf):
            if (pdf["week_idx"] == 3).any():
                raise RuntimeError("model crashed")
            return [p + " ok" for p in pdf["full_prompt"]]
        return fn
    a = G.generate_answers(prompts, None, factory)
    got = dict(((r.symbol, r.week_idx), r.answer) for r in a.collect())
    assert all(v == "" for (s, w), v in got.items() if w == 3)
    assert all(v == "ok" for (s, w), v in got.items() if w != 3)


def test_dataset_split_invariants(spark, panel, prompts):
    answers = G.generate_answers(prompts, None, G.canned_generator)
    tr = D.training_rows(answers, panel.weekly, fx.index_members(spark, SF_SMALL)).rows
    ds = D.create_dataset(tr, 0.6)
    assert ds.count() == tr.count()
    # every train row precedes every test row of its symbol
    g = ds.groupBy("symbol").agg(F.max(F.when(F.col("split") == "train", F.col("week_idx"))).alias("t"),
                                 F.min(F.when(F.col("split") == "test", F.col("week_idx"))).alias("s"))
    assert g.where(F.col("t") >= F.col("s")).count() == 0
    r = ds.first()
    assert r.prompt.startswith("[INST]<<SYS>>\n") and r.prompt.endswith("[/INST]")
    assert "Prediction: " in r.answer


def test_regex_label_source_and_rejects(spark, panel):
    old = D.old_form_prompts(panel.weekly)
    ans = old.select("symbol", "week_idx", "prompt", F.lit("[Prediction & Analysis]: text").alias("answer"))
    tr = D.training_rows(ans, None, fx.index_members(spark, SF_SMALL), label_source="regex")
    n_u0 = panel.weekly.where(F.col("bin_label") == "U0").count()
    assert tr.rejects.count() == n_u0 + panel.weekly.where(F.col("bin_label").isNull()).count()
    row = tr.rows.first()
    assert "cryptocurrency price movement for next week" in row.prompt


def test_read_prices_pushes_filters(spark):
    path = shared_dir(spark, "prices-test")
    fx.prices(spark, SF_SMALL).write.partitionBy("symbol").parquet(path)
    df = R.read_prices(spark, path, "1996-01-01", "1997-01-01", symbols=["Brand#2"])
    txt = plan_text(df)
    assert "PushedFilters" in txt and "date" in txt.split("PushedFilters")[1][:200]
    assert "PartitionFilters" in txt and "Brand#2" in txt
    assert df.where((F.col("date") < "1996-01-01") | (F.col("date") >= "1997-01-01")).count() == 0


def test_unpivot_roundtrip(spark):
    prices = fx.prices(spark, SF_SMALL)
    syms = sorted(r.symbol for r in prices.select("symbol").distinct().collect())
    back = R.unpivot_prices(R.to_wide(prices, syms)).select("symbol", "date", "close", "adj_close", "volume")
    assert back.exceptAll(prices).count() == 0 and prices.exceptAll(back).count() == 0
    assert "Exchange" not in plan_text(R.unpivot_prices(R.to_wide(prices, syms).limit(0)))


def test_news_payload_keeps_items_with_all_keys(spark):
    payload = '[{"datetime": 1, "headline": null, "summary": "a"}, {"datetime": 2, "summary": "b"}, ' \
              '{"datetime": 3, "headline": "h", "summary": "c"}]'
    df = spark.createDataFrame([("X", payload)], "symbol string, payload string")
    got = rows(R.parse_news_payload(df), "datetime", "headline")
    assert got == [(1, None), (3, "h")]


def test_basics_duplicate_entry_later_wins(spark):
    doc = '{"series": {"quarterly": {"peTTM": [{"period": "2023-03-31", "v": 1.0}, {"period": "2023-03-31", "v": 2.0}]}}}'
    df = spark.createDataFrame([("X", doc)], "symbol string, json string")
    assert rows(R.read_basics(df), "metric", "v") == [("peTTM", 2.0)]


def test_universe_rejects_bad_index(spark):
    from mktpanel.sources.universe import index_members, universe
    m = index_members(spark)
    assert universe(m, "euro").count() == 49          # the duplicate member appears once
    with pytest.raises(ValueError):
        universe(m, "nasdaq")


def test_full_run_resume_gives_equal_tables(spark):
    base = shared_dir(spark, "run-test")
    args = (spark, fx.prices(spark, SF_SMALL), fx.news(spark, SF_SMALL), fx.basics_long(spark, SF_SMALL),
            fx.profiles(spark, SF_SMALL), fx.index_members(spark, SF_SMALL), base, G.canned_generator)
    first = RUN.run_all(*args, index_name="dow")
    a = first.collect()
    second = RUN.run_all(*args, index_name="dow").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, second))
    weeks, _ = R.read_panel(spark, f"{base}/DOW-30_all_all/panel")
    assert weeks.count() == weeks.select("symbol", "week_idx").distinct().count()


def test_crypto_run_uses_crypto_intro_and_no_basics(spark):
    base = shared_dir(spark, "run-crypto")
    ds = RUN.run_all(spark, fx.prices(spark, SF_SMALL), fx.news(spark, SF_SMALL), fx.basics_long(spark, SF_SMALL),
                     fx.profiles(spark, SF_SMALL), fx.index_members(spark, SF_SMALL), base, G.canned_generator,
                     index_name="crypto")
    rows_ = ds.select("prompt", "symbol").collect()
    assert rows_ and all("[Cryptocurrency Introduction]:" in r.prompt for r in rows_)
    assert all("No basic financials reported." in r.prompt for r in rows_)
    assert all("seasoned crypto market analyst" in r.prompt for r in rows_)
    weeks, _ = R.read_panel(spark, f"{base}/CRYPTO_all_all_nobasics/panel")
    assert weeks.where(F.col("basics_period").isNotNull()).count() == 0


def test_online_prompt_structure(spark):
    from mktpanel.plans import online as ON
    members = fx.index_members(spark, SF_SMALL)
    rp = ON.recent_panel(fx.prices(spark, SF_SMALL), fx.news(spark, SF_SMALL), members, "1999-06-16", 3)
    out = ON.online_prompts(rp, fx.profiles(spark, SF_SMALL), fx.basics_long(spark, SF_SMALL), members, "1999-06-16")
    got = {r.symbol: r for r in out.collect()}
    company = got["Brand#2"]
    assert company.info.startswith("[Company Introduction]:\n\nCompany Brand#2 is a leading entity")
    assert "Some recent basic financials of Brand#2, reported at " in company.info
    assert company.prompt.startswith(company.info)
    assert company.prompt.endswith("for next week (1999-06-16 to 1999-06-23). Provide a summary analysis to support "
                                   "your prediction.")
    crypto = got["Brand#22"]
    assert crypto.info.startswith("[Cryptocurrency Introduction]:")
    assert crypto.info.endswith("[Basic Financials]:\n\nNo basic financial reported.")
    # at most five sampled articles per interval
    assert all(r.info.count("[Headline]:") <= 5 * 4 for r in got.values())


@pytest.mark.parametrize("stop_after", ["news", "weeks"])
def test_run_stopped_between_the_panel_writes_resumes_whole(spark, monkeypatch, stop_after):
    args = (spark, fx.prices(spark, SF_SMALL), fx.news(spark, SF_SMALL), fx.basics_long(spark, SF_SMALL),
            fx.profiles(spark, SF_SMALL), fx.index_members(spark, SF_SMALL))
    clean, base = shared_dir(spark, "run-clean"), shared_dir(spark, f"run-stopped-{stop_after}")
    RUN.run_all(*args, clean, G.canned_generator, index_name="dow")
    write = R.replace_symbols

    def stop(df, path):
        write(df, path)
        if path.endswith(stop_after):
            raise KeyboardInterrupt

    monkeypatch.setattr(R, "replace_symbols", stop)
    with pytest.raises(KeyboardInterrupt):
        RUN.run_all(*args, base, G.canned_generator, index_name="dow")
    monkeypatch.setattr(R, "replace_symbols", write)
    RUN.run_all(*args, base, G.canned_generator, index_name="dow")
    for a, b in zip(R.read_panel(spark, f"{clean}/DOW-30_all_all/panel"), R.read_panel(spark, f"{base}/DOW-30_all_all/panel")):
        assert a.count() == b.count() > 0
    a, b = (sorted((r.symbol, r.week_idx, r.date, r.headline or "", r.summary) for r in
                   R.read_panel(spark, f"{x}/DOW-30_all_all/panel")[1].collect()) for x in (clean, base))
    assert a == b


def test_generator_survives_null_prompts_odd_results_and_raising_rows(spark):
    rows_ = [("S", i, "company", None if i == 1 else f"prompt {i}") for i in range(40)]
    prompts = spark.createDataFrame(rows_, "symbol string, week_idx int, asset_class string, prompt string")

    def factory():
        def fn(pdf):
            if (pdf["week_idx"] == 3).any():
                raise RuntimeError("model crashed")
            return [float("nan") if w == 5 else 7 if w == 6 else p + " ok" for w, p in zip(pdf["week_idx"], pdf["full_prompt"])]
        return fn

    got = {r.week_idx: r.answer for r in G.generate_answers(prompts, None, factory, partitions=2).collect()}
    assert got == {i: "" if i in (1, 3, 5, 6) else "ok" for i in range(40)}


def test_a_row_has_a_bounded_number_of_attempts():
    import pandas as pd
    calls = []

    def fn(pdf):
        calls.append(len(pdf))
        if (pdf["week_idx"] == 77).any():
            raise RuntimeError
        return ["x"] * len(pdf)

    out = G._outcomes(fn, pd.DataFrame({"week_idx": range(1000)}), 4)
    assert [i for i, (x, _, _) in enumerate(out) if x is None] == [77]
    assert out[77] == (None, 4, "RuntimeError") and max(n for _, n, _ in out) == 4 and out[500] == ("x", 2, None)
    assert calls[:2] == [1000, 100] and 1 in calls and len(calls) == 31
    assert {n for _, n, _ in G._outcomes(fn, pd.DataFrame({"week_idx": range(100)}), 1)} == {1}
    assert G._outcomes(lambda p: ["x"], pd.DataFrame({"week_idx": [1, 2]}), 1) == [(None, 1, "wrong length")] * 2
    assert G._outcomes(fn, pd.DataFrame({"week_idx": []}), 4) == []


def test_outcomes_tell_failures_from_empty_answers_and_failures_recover(spark):
    rows_ = [("S", i, "company", None if i == 1 else f"prompt {i}") for i in range(6)]
    prompts = spark.createDataFrame(rows_, "symbol string, week_idx int, asset_class string, prompt string")

    def factory(options):
        calls = []

        def fn(pdf):
            key = tuple(pdf["week_idx"])
            calls.append(key)
            if 3 in key or (2 in key and len(calls) < 4):
                raise ValueError("always at 3, at first at 2")
            return [p + ("" if w == 4 else f" {options.max_new_tokens} {options.do_sample}") if w != 5 else None
                    for w, p in zip(pdf["week_idx"], pdf["full_prompt"])]
        return fn

    out = G.generate_outcomes(prompts, None, factory, partitions=1, options=G.GenerationOptions(max_new_tokens=7))
    got = {r.week_idx: (r.answer, r.error) for r in out.collect()}
    assert got == {0: ("7 False", None), 1: ("", "no prompt"), 2: ("7 False", None), 3: ("", "ValueError"),
                   4: ("", None), 5: ("", "no text")}
    # The accepted rows go to the answers; a later run asks for the rejects only.
    done = out.where("error is null").select("symbol", "week_idx", "prompt", "answer")
    again = G.generate_outcomes(prompts, done, G.canned_generator, partitions=1)
    assert {r.week_idx for r in again.collect()} == {1, 3, 5}


def test_dataset_asks_the_generator_once_per_prompt(spark, panel, prompts):
    """Answers that differ from call to call lose no row, and no prompt is paid for twice."""
    asked = spark.sparkContext.accumulator(0)

    def factory():
        import random

        def fn(pdf):
            asked.add(len(pdf))
            return [p + random.choice(["", " a gain of 3%", " a loss of 2%"]) for p in pdf["full_prompt"]]
        return fn

    answers = G.generate_answers(prompts, None, factory)
    ds = D.create_dataset(D.training_rows(answers, panel.weekly, fx.index_members(spark, SF_SMALL)).rows, 0.6)
    txt = plan_text(ds, "formatted")
    assert "MapInPandas" not in txt            # already written: whoever reads it asks nobody
    got = ds.select("symbol", "week_idx", "split").collect()
    assert asked.value == prompts.count()
    by = {}
    for r in got:
        by.setdefault(r.symbol, []).append((r.week_idx, r.split))
    for pairs in by.values():
        n = round(0.6 * len(pairs))
        assert [s for _, s in sorted(pairs)] == ["train"] * n + ["test"] * (len(pairs) - n)


def test_split_of_repeated_weeks_is_exact(spark):
    rows_ = [("S", w, f"p{i}", "a", "x", "y") for w in (1, 2) for i in range(5)] + [("T", 1, "p", "a", "x", "y")]
    df = spark.createDataFrame(rows_, "symbol string, week_idx int, prompt string, answer string, period string, label string")
    ds = D.create_dataset(df, 0.8).collect()
    assert sum(r.split == "train" for r in ds if r.symbol == "S") == 8
    assert all(r.split == "train" for r in ds if r.week_idx == 1) and len(ds) == 11
    assert {r.split for r in D.create_dataset(df, 0.0).collect()} == {"test"}
    assert D.create_dataset(df.limit(0), 0.8).collect() == []


def test_generation_spreads_one_symbol_over_tasks(spark):
    prompts = spark.range(200).selectExpr("'S' symbol", "cast(id as int) week_idx", "'company' asset_class", "'p' prompt")
    out = G.generate_answers(prompts, None, G.canned_generator, partitions=6)
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() == 6


def test_missing_profile_field_does_not_blank_the_prompt(spark, panel):
    profiles = fx.profiles(spark, SF_SMALL).withColumn("exchange", F.lit(None).cast("string"))
    out = PR.build_prompts(panel, profiles, fx.index_members(spark, SF_SMALL), 1, 4)
    assert out.where(F.col("prompt").isNull()).count() == 0


def test_no_text_below_the_symbol_exchange_of_the_split(spark, panel, prompts):
    answers = G.generate_answers(prompts, None, G.canned_generator)
    path = shared_dir(spark, "split-answers")
    R.append_answers(answers, path)
    tr = D.training_rows(R.read_answers(spark, path), panel.weekly, fx.index_members(spark, SF_SMALL)).rows
    txt = plan_text(D.create_dataset(tr, 0.6), "formatted")
    windows = [b for b in txt.split("\n\n") if ") Window" in b.split("\n")[0]]
    assert windows and all("prompt" not in b and "answer" not in b for b in windows)


def test_report_gathers_nothing(spark, panel, prompts):
    from mktpanel.plans import evaluate as EV
    path = shared_dir(spark, "report-answers")
    R.append_answers(G.generate_answers(prompts, None, G.canned_generator), path)
    assert "collect_list" not in plan_text(EV.evaluation_report(panel.weekly, R.read_answers(spark, path)), "formatted")


def test_empty_dataset_reads_back(spark):
    path = shared_dir(spark, "empty-dataset")
    R.write_dataset(spark.createDataFrame([], R.DATASET_SCHEMA), path)
    assert R.read_dataset(spark, path).count() == 0


def test_articles_are_whole(spark):
    docs = fx.table(spark, SF_SMALL, "documents").agg(F.max(F.length("text"))).first()[0]
    assert fx.news(spark, SF_SMALL).agg(F.max(F.length("summary"))).first()[0] >= docs


def test_article_pages_add_up(spark, panel):
    from mktpanel.operators.aggregates import collect_news
    pages = collect_news(panel.news).groupBy("symbol", "week_idx").agg(
        F.sum(F.size("news")).alias("a"), F.sum("n_page").alias("b"), F.max("n_news").alias("n"))
    assert pages.where("a <> n or b <> n").count() == 0 and pages.agg(F.sum("n")).first()[0] == panel.news.count()


def _prompts(spark, n):
    return spark.range(n).selectExpr("concat('S', id % 3) symbol", "cast(id as int) week_idx", "'company' asset_class", "concat('p', id) prompt")


def _answering(factory=G.canned_generator):
    return lambda some, old: G.generate_answers(some, old, factory, partitions=2)


def test_killed_run_keeps_its_finished_batches(spark):
    path, prompts = shared_dir(spark, "log-killed"), _prompts(spark, 90)
    batches = []

    def stopping(some, old):
        if len(batches) == 2:
            raise KeyboardInterrupt
        batches.append(some.count())
        return _answering()(some, old)

    log = AnswerLog(spark, path, slots=5)
    with pytest.raises(KeyboardInterrupt):
        log.append(prompts, stopping)
    assert log.read().count() == sum(batches) > 0
    # A batch whose writer died before its commit does not count, and is swept away.
    log.read().write.parquet(f"{path}/data/00004-dead")
    assert log.read().count() == sum(batches)
    assert log.append(prompts, _answering()) == 3
    done = AnswerLog(spark, path).read()               # the log knows its slots
    assert done.count() == done.select("symbol", "week_idx").distinct().count() == 90
    assert log.append(prompts, _answering()) == 0
    assert log.drop_uncommitted() == ["00004-dead"] and log.read().count() == 90
    assert log.append(_prompts(spark, 100), _answering()) > 0 and log.read().count() == 100


def test_two_runs_at_once_leave_each_key_once(spark):
    path, prompts = shared_dir(spark, "log-two"), _prompts(spark, 60)
    other = AnswerLog(spark, path, slots=3)
    met = []

    def late(some, old):
        """Another run answers the same slot after this one has looked at it."""
        new = materialize(_answering()(some, old), "mine")
        if not met:
            met.append(other.append(some, _answering()))
        return new

    log = AnswerLog(spark, path, slots=3)
    committed = log.append(prompts, late)
    done = log.read()
    assert met == [1] and committed == 2
    assert done.count() == done.select("symbol", "week_idx").distinct().count() == 60
    assert log.drop_uncommitted() == []


def test_commits_are_never_replaced_nor_seen_by_half(spark):
    log = AnswerLog(spark, shared_dir(spark, "log-files"), slots=1)
    assert log.append(_prompts(spark, 5), _answering()) == 1
    before = log.commits()
    assert log._commit(0, 1, "another") is False and log.commits() == before
    assert [n for n in log._files.names(f"{log.root}/commits")] == ["00000-000001"]
    log._files.fs.create(log._files.path(f"{log.root}/commits/.written-aside"), False).close()
    assert log.commits() == before and log.read().count() == 5


def test_asof_has_no_window_over_a_symbol(spark, panel):
    """Windows by symbol alone run over one row per quarter or block of weeks."""
    from mktpanel.operators import aggregates as A
    from mktpanel.operators import joins as J
    df = J.attach_basics(panel.weekly, A.pivot_basics(fx.basics_long(spark, SF_SMALL)))
    for node in re.split(r"\n\s*\n", plan_text(df, "formatted")):
        if re.match(r"\s*\(\d+\) Window\b", node) and re.search(r"windowspecdefinition\(symbol#\d+, (?!_q|_block)\w+#\d+ ASC", node):
            raise AssertionError(node)


def test_wide_files_read_by_their_own_headers(spark, tmp_path):
    """Files of different columns, NaN and empty cells, a symbol with a bar in it; the plan does not grow with symbols."""
    (tmp_path / "a.csv").write_text('date,X|Close,X|Volume,A|B|Close,note\n2020-01-02,1.5,10,,n\n2020-01-03,,,7,n\n\n')
    (tmp_path / "b.csv").write_text('date,A|B|Adj Close,X|Close\n2020-02-03,2.25,NaN\n')
    got = {(r.symbol, str(r.date)): (r.close, r.adj_close, r.volume) for r in R.read_wide_prices(spark, str(tmp_path)).collect()}
    assert got == {("X", "2020-01-02"): (1.5, None, 10), ("A|B", "2020-01-03"): (7.0, None, None),
                   ("A|B", "2020-02-03"): (None, 2.25, None)}
    wide = tmp_path / "wide"
    wide.mkdir()
    (wide / "c.csv").write_text("date," + ",".join(f"S{i}|Close" for i in range(30_000)) + "\n2020-01-02," + ",".join(map(str, range(30_000))))
    large = R.read_wide_prices(spark, str(wide))
    assert large.count() == 30_000 and large.where("symbol = 'S29999'").first().close == 29999.0
    assert abs(len(plan_text(large)) - len(plan_text(R.read_wide_prices(spark, str(tmp_path / "a.csv"))))) < 100


def test_symbols_without_pairs_are_listed(spark):
    from mktpanel.plans import evaluate as EV
    weeks = spark.createDataFrame([("A", 0, "U1"), ("B", 0, "D1")], "symbol string, week_idx int, bin_label string")
    answers = spark.createDataFrame([("A", 0, "up 1%"), ("C", 1, "x")], "symbol string, week_idx int, answer string")
    assert rows(EV.skipped_symbols(weeks, answers)) == [("B", "no answers"), ("C", "no weeks")]
    wanted = spark.createDataFrame([("A",), ("D",)], "symbol string")
    assert rows(EV.skipped_symbols(weeks, answers, wanted)) == [("D", "no weeks and no answers")]
