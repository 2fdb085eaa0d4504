"""Independent DuckDB SQL for every registered query.

Each entry derives the domain tables from the driver's views (region nation
customer supplier part orders lineitem events documents ...) with its own
SQL and computes the operator's result in plain SQL (joins, GROUP BY,
window functions), written without reference to the Spark code paths.
"""

from __future__ import annotations

import re

from mktpanel.functions import fixed

# Query parameters, the same values the registry passes to the Spark jobs.
SCAN_START, SCAN_END = "1996-01-01", "2000-01-01"
RUN_START, RUN_END = "1998-01-01", "1999-07-01"
CURDAY = "1999-06-16"
ONLINE_WEEKS = 3
MIN_WEEKS, MAX_WEEKS, RATIO = 1, 4, 0.6
TOP_K = 5
NEWS_PAGE = 2
LONG_DAYS = 1461


def q(s: str) -> str:
    """SQL string literal (newlines are kept inside the quotes)."""
    return "'" + s.replace("'", "''") + "'"


def tpl(template: str, **exprs: str) -> str:
    """Concatenation of the template's literal pieces and SQL expressions."""
    out, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            out.append(q(template[pos:m.start()]))
        out.append(f"({exprs[m.group(1)]})")
        pos = m.end()
    if pos < len(template):
        out.append(q(template[pos:]))
    return " || ".join(out)


NL = "chr(10)"

# ------------------------------------------------------------ fixture tables
PRICES = """prices AS (
  select p_brand as symbol, cast(l_shipdate as date) as date,
         cast(110 + sum(l_linenumber) % 13 as double) as close,
         case when p_brand = 'Brand#1' then cast(null as double)
              else cast(100 + sum(l_linenumber) % 13 as double) end as adj_close,
         count(*) as volume
  from lineitem join part on l_partkey = p_partkey
  group by p_brand, cast(l_shipdate as date))"""

NEWS = f"""news AS (
  select concat('Brand#', cast(case when doc_id % 2 = 0 then 1 else 1 + (doc_id // 2) % 25 end as varchar)) as symbol,
         915321600 + ((doc_id * 7919) % 420) * 86400 + (doc_id * 37) % 86400 as datetime,
         case when doc_id % 17 = 0 then null
              else split_part(text, chr(10), 1) end as headline,
         case when doc_id % 10 = 0 then {q(fixed.BOILERPLATE_LONG)} || replace(text, chr(10), ' ')
              else replace(text, chr(10), ' ') end as summary
  from documents)"""

BASICS_LONG = """basics_long AS (
  select p_brand as symbol,
         last_day(cast(date_trunc('quarter', l_shipdate) + interval 2 month as date)) as period,
         case l_linenumber when 1 then 'peTTM' when 2 then 'roeTTM' when 3 then 'operatingMargin'
              when 4 then 'totalDebtToEquity' when 5 then 'netMargin' when 6 then 'roaTTM'
              else 'currentRatio' end as metric,
         cast(count(*) as double) / 10 as v
  from lineitem join part on l_partkey = p_partkey
  group by 1, 2, 3)"""

PROFILES = """profiles AS (
  select p_brand as symbol, concat('Company ', p_brand) as name, min(p_type) as finnhubIndustry,
         '1990-01-01' as ipo, max(p_retailprice) as marketCapitalization, 'USD' as currency,
         cast(count(*) as double) + 0.5 as shareOutstanding, 'US' as country, p_brand as ticker,
         'XNAS' as exchange, concat(min(p_type), ' token ', p_brand) as description,
         cast(sum(p_size) as bigint) as marketCap
  from part group by p_brand)"""

MEMBERS = """members AS (
  select symbol, index_name, case when index_name = 'crypto' then 'crypto' else 'company' end as asset_class
  from (select distinct p_brand as symbol,
               case when cast(substr(p_brand, 7) as int) <= 12 then 'dow'
                    when cast(substr(p_brand, 7) as int) <= 20 then 'euro' else 'crypto' end as index_name
        from part))"""

# ------------------------------------------------------------ weekly panel
WEEKLY = """flag AS (
  select symbol, bool_or(adj_close is not null and not isnan(adj_close)) as use_adj
  from prices group by symbol),
daily AS (
  select p.symbol, p.date, case when f.use_adj then p.adj_close else p.close end as price
  from prices p join flag f on p.symbol = f.symbol),
obs AS (
  select symbol, cast(date + cast(7 - isodow(date) as integer) as date) as wk, arg_max(price, date) as price
  from daily where price is not null and not isnan(price) group by 1, 2),
bounds AS (select symbol, min(wk) as w0, max(wk) as w1 from obs group by symbol),
spine AS (
  select symbol, cast(unnest(generate_series(cast(w0 as timestamp), cast(w1 as timestamp), interval 7 day)) as date) as wk
  from bounds),
filled AS (
  select s.symbol, s.wk,
         last_value(o.price ignore nulls) over (partition by s.symbol order by s.wk
                                                rows between unbounded preceding and current row) as price
  from spine s left join obs o on s.symbol = o.symbol and s.wk = o.wk),
pairs AS (
  select symbol, wk as end_date, price as end_price,
         lag(wk) over (partition by symbol order by wk) as start_date,
         lag(price) over (partition by symbol order by wk) as start_price,
         row_number() over (partition by symbol order by wk) - 2 as week_idx
  from filled),
rets AS (
  select symbol, cast(week_idx as integer) as week_idx, start_date, start_price, end_date, end_price,
         end_price / start_price - 1 as weekly_return
  from pairs where week_idx >= 0),
weekly AS (
  select *, case when weekly_return is null or isnan(weekly_return) or isinf(weekly_return) then null
                 else (case when weekly_return >= 0 then 'U' else 'D' end) ||
                      (case when ceil(abs(100 * weekly_return)) <= 5
                            then cast(cast(ceil(abs(100 * weekly_return)) as bigint) as varchar)
                            else '5+' end) end as bin_label
  from rets)"""


# ------------------------------------------------------------ news and basics
NEWS_DAYS = """news_days AS (
  select symbol, strftime(make_timestamp(cast(datetime as bigint) * 1000000), '%Y%m%d%H%M%S') as date,
         cast(make_timestamp(cast(datetime as bigint) * 1000000) as date) as day, headline, summary
  from news)"""

# Naive interval join: every article whose day lies in [start_date, end_date].
ART_WEEKS = """art_weeks AS (
  select w.symbol, w.week_idx, w.start_date, w.end_date, n.date, n.headline, n.summary
  from weekly w join news_days n on n.symbol = w.symbol and n.day between w.start_date and w.end_date)"""

BMAP = """bmap AS (
  select symbol, period,
         string_agg(metric || ': ' || cast(v as varchar), chr(10) order by metric) as metrics_text,
         max(case when metric = 'peTTM' then v end) as pe,
         max(case when metric = 'roeTTM' then v end) as roe,
         max(case when metric = 'operatingMargin' then v end) as om,
         max(case when metric = 'totalDebtToEquity' then v end) as de,
         max(case when metric = 'netMargin' then v end) as nm,
         max(case when metric = 'roaTTM' then v end) as roa
  from basics_long group by symbol, period)"""


def asof(name: str, always: bool) -> str:
    lower = "" if always else " and b.period >= w.end_date - 21 and w.week_idx >= 2"
    return f"""{name} AS (
  select w.*, b2.period as basics_period, coalesce(b2.metrics_text, '') as metrics_text,
         b2.pe, b2.roe, b2.om, b2.de, b2.nm, b2.roa
  from weekly w
  left join (select w.symbol, w.week_idx, max(b.period) as bp
             from weekly w join bmap b on b.symbol = w.symbol and b.period < w.end_date{lower}
             group by 1, 2) a on a.symbol = w.symbol and a.week_idx = w.week_idx
  left join bmap b2 on b2.symbol = w.symbol and b2.period = a.bp)"""


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def header(variant: str = "later", p: str = "") -> str:
    t = fixed.HEADER_LATER if variant == "later" else fixed.HEADER_EARLIER
    move = f"case when {p}end_price > {p}start_price then 'increased' else 'decreased' end"
    return tpl(t, start=iso(f"{p}start_date"), end=iso(f"{p}end_date"), symbol=f"{p}symbol", move=move,
               sp=f"printf('%.2f', {p}start_price)", ep=f"printf('%.2f', {p}end_price)")


def highlights_utils() -> str:
    items = [f"case when {c} > {thr} then {q(t.split('{}')[0])} || cast({c} as varchar) || {q(t.split('{}')[1])} end"
             for c, (_, thr, t) in zip(["pe", "roe", "om", "de", "nm", "roa"], fixed.HIGHLIGHTS_UTILS)]
    hl = "concat_ws(', ', " + ", ".join(items) + ")"
    return (f"case when basics_period is null then {q(fixed.HIGHLIGHTS_EMPTY)} "
            f"when {hl} = '' then {q(fixed.HIGHLIGHTS_NONE)} else {q(fixed.HIGHLIGHTS_HEAD)} || {hl} end")


def company_intro(variant: str = "later", p: str = "") -> str:
    t = fixed.COMPANY_INTRO_LATER if variant == "later" else fixed.COMPANY_INTRO_EARLIER
    cols = {k: f"{p}{k}" for k in ("name", "finnhubIndustry", "ipo", "currency", "country", "ticker", "exchange")}
    cols["marketCapitalization"] = f"printf('%.2f', {p}marketCapitalization)"
    cols["shareOutstanding"] = f"printf('%.2f', {p}shareOutstanding)"
    return tpl(t, **cols)


def crypto_intro(p: str = "") -> str:
    return tpl(fixed.CRYPTO_INTRO, description=f"{p}description", marketCap=f"cast({p}marketCap as varchar)")


LATER_ITEM = "'- ' || coalesce(headline, 'None') || ': ' || coalesce(summary, 'None')"
EARLIER_ITEM = tpl(fixed.ARTICLE_EARLIER, headline="coalesce(headline, 'None')", summary="coalesce(summary, 'None')")
ART_ORDER = "date, headline nulls first, summary nulls first"

# Week blocks: header, newline, first five non-boilerplate articles (or fallback).
BLOCKS = f"""nt AS (
  select symbol, week_idx, string_agg({LATER_ITEM}, chr(10) order by rn) as news_text
  from (select *, row_number() over (partition by symbol, week_idx order by {ART_ORDER}) as rn
        from art_weeks where not coalesce(starts_with(summary, {q(fixed.BOILERPLATE_SHORT)}), false))
  where rn <= {TOP_K} group by 1, 2),
blocks AS (
  select w.*, {header('later', 'w.')} as header,
         coalesce(nt.news_text, {q(fixed.NO_NEWS_LATER)}) as news_text,
         {header('later', 'w.')} || chr(10) || coalesce(nt.news_text, {q(fixed.NO_NEWS_LATER)}) as block
  from wb w left join nt on nt.symbol = w.symbol and nt.week_idx = w.week_idx),
hist AS (
  select t.symbol, t.week_idx,
         coalesce(string_agg(h.block, chr(10) || chr(10) order by h.week_idx), '') as history
  from blocks t left join blocks h
    on h.symbol = t.symbol and h.week_idx between t.week_idx - {MAX_WEEKS} and t.week_idx - 1
  group by 1, 2),
cls AS (select symbol, max(asset_class) as asset_class from members group by symbol),
prompts AS (
  select b.symbol, b.week_idx, b.start_date, b.end_date, c.asset_class,
         trim(
           (case when c.asset_class = 'crypto' then {crypto_intro('p.')} else {company_intro('later', 'p.')} end)
           || chr(10) || chr(10) || h.history || chr(10) || chr(10) || b.header || chr(10) || b.news_text
           || chr(10) || chr(10)
           || (case when c.asset_class = 'crypto' then {q(fixed.HIGHLIGHTS_EMPTY)} else ({highlights_utils()}) end)
           || {tpl(fixed.TASK_ENDING, start_date=iso('b.start_date'), end_date=iso('b.end_date'), symbol='b.symbol')},
           ' ' || chr(9) || chr(10) || chr(13)) as prompt
  from blocks b join hist h on h.symbol = b.symbol and h.week_idx = b.week_idx
  join cls c on c.symbol = b.symbol left join profiles p on p.symbol = b.symbol
  where b.week_idx >= {MIN_WEEKS})"""

_CANNED = ["Expected to rise 1-2% next week", "A gain of 3%", "The price may decline by 2.5-3%",
           "Shares will drop 7%", "It moves against the trend", "Prediction: Up by 1-2%"]
# Deterministic generator: canned continuation by (week_idx * 31 + brand * 13) % 8 under the
# analysis heading; choice 6 is empty and 7 a failed call (both give an empty answer).
ANSWERS = """answers AS (
  select symbol, week_idx, prompt,
         case (week_idx * 31 + cast(substr(symbol, 7) as int) * 13) % 8 """ + " ".join(
    f"when {i} then {q('[Prediction & Analysis]:' + chr(10) + t)}" for i, t in enumerate(_CANNED)) + """
              else '' end as answer
  from prompts)"""

RANGE_RE, SINGLE_RE = q(fixed.RANGE_PERCENT), q(fixed.SINGLE_PERCENT)
UPW = " or ".join(f"contains(lower(answer), {q(w)})" for w in fixed.UP_WORDS)
DOWNW = " or ".join(f"contains(lower(answer), {q(w)})" for w in fixed.DOWN_WORDS)
PRED = f"""pred AS (
  select symbol, week_idx, answer,
         case when dir is null then null when lb is null then dir || '1' when lb >= 5 then dir || '5+'
              else dir || cast(cast(floor(lb) as bigint) as varchar) end as pred_label
  from (select *, case when answer is null then null when {UPW} then 'U' when {DOWNW} then 'D' end as dir,
               case when regexp_matches(answer, {RANGE_RE}) then cast(regexp_extract(answer, {RANGE_RE}, 1) as double)
                    when regexp_matches(answer, {SINGLE_RE}) then cast(regexp_extract(answer, {SINGLE_RE}, 1) as double)
               end as lb
        from answers))"""


def pairs(align: str) -> str:
    if align == "key":
        return """evpairs AS (
  select w.symbol, w.week_idx, w.bin_label as true_label, p.pred_label
  from weekly w join pred p on p.symbol = w.symbol and p.week_idx = w.week_idx)"""
    return """evpairs AS (
  select t.symbol, cast(t.pos as integer) as week_idx, t.true_label, p.pred_label
  from (select symbol, row_number() over (partition by symbol order by week_idx) - 1 as pos, bin_label as true_label
        from weekly) t
  join (select symbol, row_number() over (partition by symbol order by week_idx) - 1 as pos, pred_label
        from pred) p on p.symbol = t.symbol and p.pos = t.pos)"""


REPORT = """rep AS (
  select symbol, cast(count(*) as double) as samples,
         avg(case when coalesce(left(true_label, 1) = left(pred_label, 1), false) then 1.0 else 0.0 end) as directional_accuracy,
         avg(case when coalesce(true_label = pred_label, false) then 1.0 else 0.0 end) as full_accuracy,
         cast(sum(case when pred_label is null then 1 else 0 end) as double) as missing_predictions
  from evpairs group by symbol)"""


def _mean(c: str) -> str:
    return f"cast(sum(cast({c} as decimal(38,12))) as double) / cast(count(*) as double)"


REPORT_AVG = ("select * from rep union all select 'Average', " +
              ", ".join(_mean(c) for c in ["samples", "directional_accuracy", "full_accuracy", "missing_predictions"])
              + " from rep having count(*) > 0")

PHRASE_V1 = "case bin_label " + " ".join(f"when {q(k)} then {q(v)}" for k, v in fixed.BIN_PHRASE_V1.items()) + " end"
TRAIN_SYS = (f"replace(case when c.asset_class = 'crypto' then {q(fixed.SYSTEM_PROMPTS['crypto'])} "
             f"else {q(fixed.SYSTEM_PROMPTS['company'])} end, {q(fixed.SYSTEM_REWRITE_FROM)}, {q(fixed.SYSTEM_REWRITE_TO)})")
CAP = "upper(left(label, 1)) || lower(substr(label, 2))"
TRAINING = f"""tr AS (
  select a.symbol, a.week_idx,
         {q(fixed.B_INST + fixed.B_SYS)} || {TRAIN_SYS} || {q(fixed.E_SYS)} || a.prompt || {q(fixed.E_INST)} as prompt,
         regexp_replace(a.answer, {q(fixed.ANALYSIS_HEADING_PATTERN)},
                        {q('[Prediction & Analysis]:' + chr(10) + 'Prediction: ')} || {CAP} || {q(chr(10) + 'Analysis: ')}, 'g') as answer,
         a.period, a.label
  from (select a.*, {iso('w.start_date')} || ' to ' || {iso('w.end_date')} as period,
               (select {PHRASE_V1} from (select w.bin_label)) as label
        from answers a join weekly w on w.symbol = a.symbol and w.week_idx = a.week_idx) a
  join cls c on c.symbol = a.symbol
  where a.answer <> '' and a.label is not null),
ds AS (
  select prompt, answer, period, label, symbol,
         case when row_number() over (partition by symbol order by week_idx)
                   <= round_even({RATIO} * count(*) over (partition by symbol), 0) then 'train' else 'test' end as split,
         week_idx
  from tr)"""

WB = "wb AS (" + asof("wb_inner", False).split(" AS (", 1)[1].rsplit(")", 1)[0] + ")"

STEPS = f"""steps AS (
  select m.symbol, cast(i as integer) as step_idx, date '{CURDAY}' - cast(7 * ({ONLINE_WEEKS} - i) as integer) as step
  from (select distinct symbol from members) m, range(0, {ONLINE_WEEKS + 1}) t(i)),
win AS (select symbol, date, close from prices
        where date >= date '{CURDAY}' - {7 * ONLINE_WEEKS} and date < date '{CURDAY}'),
firsts AS (
  select s.symbol, s.step_idx, s.step, min(w.date) as date
  from steps s join win w on w.symbol = s.symbol and w.date >= s.step
  where s.step < date '{CURDAY}' group by 1, 2, 3),
fwd AS (select f.symbol, f.step_idx, f.step, f.date, w.close as price
        from firsts f join win w on w.symbol = f.symbol and w.date = f.date),
pts AS (select symbol, step_idx, date, price from fwd
        union all select symbol, {ONLINE_WEEKS + 1}, max(date), arg_max(close, date) from win group by symbol),
iv AS (
  select * from (
    select symbol, lag(date) over (partition by symbol order by step_idx) as start_date, date as end_date,
           lag(price) over (partition by symbol order by step_idx) as start_price, price as end_price,
           cast(row_number() over (partition by symbol order by step_idx) - 2 as integer) as row_idx
    from pts) where row_idx >= 0),
iv_news AS (
  select i.symbol, i.row_idx, i.start_date, i.end_date, n.date, n.headline, n.summary
  from iv i join news_days n on n.symbol = i.symbol and n.day between i.start_date and i.end_date)"""


def sample_key(by2: str) -> str:
    return (f"md5(concat_ws('|', '0', symbol, cast({by2} as varchar), coalesce(date, 'None'), "
            f"coalesce(headline, 'None'), coalesce(summary, 'None')))")


ONLINE = f"""picked AS (
  select * from (
    select *, row_number() over (partition by symbol, row_idx order by {sample_key('row_idx')}, {ART_ORDER}) as pk
    from iv_news
    where substr(date, 1, 8) <= strftime(end_date, '%Y%m%d')
      and not coalesce(starts_with(summary, {q(fixed.BOILERPLATE_LONG)}), false))
  where pk <= {TOP_K}),
lists AS (select symbol, row_idx, string_agg({EARLIER_ITEM}, chr(10) order by {ART_ORDER}) as news
          from picked group by 1, 2),
rows_t AS (select i.symbol, i.row_idx,
                  chr(10) || {header('earlier', 'i.')} || coalesce(l.news, {q(fixed.NO_NEWS_ONLINE)}) as row_text
           from iv i left join lists l on l.symbol = i.symbol and l.row_idx = i.row_idx),
body AS (select symbol, string_agg(row_text, '' order by row_idx) as body from rows_t group by symbol),
cur AS (select symbol, coalesce(max(case when period <= date '{CURDAY}' then period end), min(period)) as period
        from bmap group by symbol),
curb AS (select c.symbol, c.period, b.metrics_text from cur c join bmap b on b.symbol = c.symbol and b.period = c.period),
info AS (
  select b.symbol,
         (case when c.asset_class = 'crypto' then {crypto_intro('p.')} else {company_intro('earlier', 'p.')} end)
         || chr(10) || b.body || chr(10)
         || (case when c.asset_class = 'crypto' or cb.period is null then {q(fixed.BASICS_LIST_EMPTY)}
                  else {tpl(fixed.BASICS_LIST_HEAD, symbol='b.symbol', period=iso('cb.period'))} || cb.metrics_text end) as info
  from body b join cls c on c.symbol = b.symbol left join profiles p on p.symbol = b.symbol
  left join curb cb on cb.symbol = b.symbol)"""

ONLINE_END = tpl(fixed.ONLINE_ENDING, curday=q(CURDAY), symbol="symbol",
                 period=f"'{CURDAY} to ' || {iso(f'date {q(CURDAY)} + 7')}")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SQL: dict[str, str] = {}

# 2.1 sources and sinks
SQL["scan_prices"] = with_(PRICES) + f"""
select symbol, date, close, adj_close, volume from prices where date >= date '{SCAN_START}' and date < date '{SCAN_END}'"""
SQL["unpivot_prices"] = with_(PRICES) + "select symbol, date, close, adj_close, volume from prices"
SQL["unpivot_price_maps"] = SQL["unpivot_prices"]
SQL["price_field"] = with_(PRICES, WEEKLY) + "select symbol, date, price from daily"
SQL["scan_news"] = with_(NEWS) + "select symbol, datetime, headline, summary from news"
SQL["scan_basics"] = with_(BASICS_LONG) + "select symbol, period, metric, v from basics_long"
SQL["scan_profiles"] = with_(PROFILES) + "select * from profiles"
SQL["universe"] = with_(MEMBERS) + "select symbol, index_name, asset_class from members where index_name = 'dow'"

DIGEST = ("sum(('0x' || left(md5(concat_ws('|', date, coalesce(headline, 'None'), coalesce(summary, 'None'))), 8))::bigint)"
          "::bigint")
PANEL_SUMMARY = """select w.symbol, w.week_idx, w.start_date, w.start_price, w.end_date, w.end_price, w.weekly_return,
       w.bin_label, coalesce(n.n_news, 0) as n_news, coalesce(n.news_digest, 0) as news_digest, w.basics_period
from wb w left join (select symbol, week_idx, count(*) as n_news, """ + DIGEST + """ as news_digest
                     from art_weeks group by 1, 2) n on n.symbol = w.symbol and n.week_idx = w.week_idx"""
SQL["panel_roundtrip"] = with_(PRICES, NEWS, BASICS_LONG, WEEKLY, NEWS_DAYS, ART_WEEKS, BMAP, WB) + PANEL_SUMMARY
BASE = (PRICES, NEWS, BASICS_LONG, PROFILES, MEMBERS, WEEKLY, NEWS_DAYS, ART_WEEKS, BMAP, WB, BLOCKS)
SQL["panel_json_roundtrip"] = SQL["panel_roundtrip"]
SQL["answers_append"] = with_(*BASE, ANSWERS) + "select symbol, week_idx, answer from answers"
SQL["dataset_roundtrip"] = with_(*BASE, ANSWERS, TRAINING) + "select * from ds"
SQL["evaluation_roundtrip"] = with_(*BASE, ANSWERS, PRED, pairs("position"), REPORT) + REPORT_AVG
SQL["pending_symbols"] = with_(PRICES, MEMBERS, WEEKLY) + """
select symbol, index_name, asset_class from members
where symbol not in (select w.symbol from weekly w join members m on m.symbol = w.symbol where m.index_name = 'dow')"""

# 2.2 filters
SQL["asset_class"] = with_(PRICES, MEMBERS, WEEKLY) + """
select w.symbol, w.week_idx, case when m.symbol is null then 'company' else m.asset_class end as asset_class
from weekly w left join members m on m.symbol = w.symbol"""
SQL["drop_boilerplate"] = with_(NEWS) + f"""
select * from news where not coalesce(starts_with(summary, {q(fixed.BOILERPLATE_SHORT)}), false)"""
SQL["news_cutoff"] = with_(PRICES, NEWS, MEMBERS, NEWS_DAYS, STEPS) + f"""
select i.symbol, i.row_idx, n.date, n.headline, n.summary
from iv i join news_days n on n.symbol = i.symbol
where n.day between date '{CURDAY}' - {7 * ONLINE_WEEKS} and date '{CURDAY}' + 14 and n.day >= i.start_date
  and n.day <= i.end_date"""
SQL["usable_answers"] = with_(*BASE, ANSWERS) + "select symbol, week_idx, answer from answers where answer <> ''"
SQL["empty_basics"] = with_(PRICES, WEEKLY) + """
select symbol, week_idx, cast(null as date) as basics_period, 0 as n_metrics from weekly"""

# 2.3 time series
SQL["weekly_close"] = with_(PRICES, WEEKLY) + "select symbol, wk as week_end, price from obs"
SQL["weekly_ffill"] = with_(PRICES, WEEKLY) + "select symbol, wk as week_end, price from filled"
SQL["pct_change"] = with_(PRICES, WEEKLY) + """
select symbol, week_end, price, pct_change from (
  select symbol, wk as week_end, price, price / lag(price) over (partition by symbol order by wk) - 1 as pct_change,
         row_number() over (partition by symbol order by wk) as rn
  from filled) where rn > 1"""
SQL["interval_pairs"] = with_(PRICES, WEEKLY) + """
select symbol, start_date, start_price, end_date, end_price from pairs where week_idx >= 0"""
SQL["step_grid"] = with_(PRICES, NEWS, MEMBERS, NEWS_DAYS, STEPS) + "select symbol, step_idx, step from steps"
SQL["asof_forward"] = with_(PRICES, NEWS, MEMBERS, NEWS_DAYS, STEPS) + "select symbol, step_idx, step, date, price from fwd"
SQL["recent_intervals"] = with_(PRICES, NEWS, MEMBERS, NEWS_DAYS, STEPS) + """
select symbol, start_date, end_date, start_price, end_price, row_idx from iv"""

# 2.4 joins
SQL["news_interval_join"] = with_(PRICES, NEWS, WEEKLY, NEWS_DAYS, ART_WEEKS) + "select * from art_weeks"
SQL["basics_asof_window"] = with_(PRICES, BASICS_LONG, WEEKLY, BMAP, asof("wb", False)) + """
select symbol, week_idx, end_date, basics_period, metrics_text from wb"""
SQL["basics_asof_always"] = with_(PRICES, BASICS_LONG, WEEKLY, BMAP, asof("wb", True)) + """
select symbol, week_idx, end_date, basics_period, metrics_text from wb"""
SQL["basics_asof_recent"] = with_(PRICES, NEWS, BASICS_LONG, MEMBERS, NEWS_DAYS, STEPS, BMAP) + """
select r.symbol, r.row_idx as week_idx, r.end_date, b.period as basics_period, coalesce(b.metrics_text, '') as metrics_text
from (select i.*, (select max(b.period) from bmap b where b.symbol = i.symbol and b.period < i.end_date
                   and b.period >= (select j.start_date from iv j where j.symbol = i.symbol and j.row_idx = i.row_idx - 2)) as bp
      from iv i) r left join bmap b on b.symbol = r.symbol and b.period = r.bp"""
SQL["current_basics"] = with_(BASICS_LONG, BMAP) + f"""
select c.symbol, c.period, b.metrics_text
from (select symbol, coalesce(max(case when period <= date '{CURDAY}' then period end), min(period)) as period
      from bmap group by symbol) c join bmap b on b.symbol = c.symbol and b.period = c.period"""
SQL["pair_by_key"] = with_(*BASE, ANSWERS, PRED, pairs("key")) + "select * from evpairs"
SQL["pair_by_position"] = with_(*BASE, ANSWERS, PRED, pairs("position")) + "select * from evpairs"
SQL["profile_join"] = with_(PRICES, PROFILES, WEEKLY) + """
select w.symbol, w.week_idx, p.name, p.finnhubIndustry, p.marketCapitalization
from weekly w left join profiles p on p.symbol = w.symbol"""
SQL["pending_prompts"] = with_(*BASE, ANSWERS) + """
select symbol, week_idx from prompts
except all
select symbol, week_idx from answers where answer <> ''"""

# 2.5 aggregations
SQL["collect_news"] = with_(PRICES, NEWS, WEEKLY, NEWS_DAYS, ART_WEEKS) + f"""
select symbol, week_idx, page, count(*) as n_page, any_value(n_news) as n_news,
       string_agg(concat_ws('|', date, coalesce(headline, 'None'), summary), chr(10) order by {ART_ORDER}) as news_list
from (select *, count(*) over (partition by symbol, week_idx) as n_news,
             ((row_number() over (partition by symbol, week_idx order by {ART_ORDER}) - 1) // {NEWS_PAGE})::int as page
      from art_weeks)
group by symbol, week_idx, page"""
SQL["news_long_intervals"] = with_(PRICES, NEWS, WEEKLY, NEWS_DAYS) + f"""
select w.symbol, w.week_idx as row_idx, w.start_date, w.end_day as end_date, count(*) as n_news, {DIGEST} as news_digest
from (select *, start_date + ((week_idx * 37 + 1) % {LONG_DAYS})::int as end_day from weekly) w
join news_days n on n.symbol = w.symbol and n.day between w.start_date and w.end_day
group by w.symbol, w.week_idx, w.start_date, w.end_day"""
SQL["pivot_basics"] = with_(BASICS_LONG, """twice AS (
  select symbol, period, metric, case when metric = 'peTTM' then v - 0.5 else v end as v from basics_long)""",
                            BMAP.replace("from basics_long", "from twice")) + "select symbol, period, metrics_text from bmap"
SQL["evaluate"] = with_(*BASE, ANSWERS, PRED, pairs("position"), REPORT) + "select * from rep"
SQL["evaluate_with_average"] = with_(*BASE, ANSWERS, PRED, pairs("key"), REPORT) + REPORT_AVG

# 2.6 windows
HEADERS = f"hd AS (select *, {header('later')} as header from weekly)"
SQL["history_window"] = with_(PRICES, WEEKLY, HEADERS) + f"""
select t.symbol, t.week_idx, cast(count(h.header) as integer) as n_history,
       coalesce(string_agg(h.header, ' | ' order by h.week_idx), '') as history_text
from hd t left join hd h on h.symbol = t.symbol and h.week_idx between t.week_idx - {MAX_WEEKS} and t.week_idx - 1
group by t.symbol, t.week_idx"""
SQL["history_gate"] = with_(PRICES, WEEKLY) + f"""
select symbol, week_idx, least(week_idx, {MAX_WEEKS}) as n_history from weekly where week_idx >= {MIN_WEEKS}"""
SQL["week_index"] = with_(PRICES, WEEKLY) + """
select symbol, wk as week_end, price, cast(row_number() over (partition by symbol order by wk) - 1 as integer) as week_idx
from filled"""
SQL["chrono_split"] = with_(PRICES, WEEKLY) + f"""
select symbol, week_idx,
       case when week_idx + 1 <= round_even({RATIO} * count(*) over (partition by symbol), 0) then 'train' else 'test' end as split
from weekly"""

# 2.7 top-k, sampling
SQL["top_news"] = with_(PRICES, NEWS, WEEKLY, NEWS_DAYS, ART_WEEKS) + f"""
select symbol, week_idx, rn, date, headline, summary from (
  select *, cast(row_number() over (partition by symbol, week_idx order by {ART_ORDER}) as integer) as rn from art_weeks)
where rn <= {TOP_K}"""
SQL["sample_news"] = with_(PRICES, NEWS, WEEKLY, NEWS_DAYS, ART_WEEKS) + f"""
select symbol, week_idx, cast(row_number() over (partition by symbol, week_idx order by {ART_ORDER}) as integer) as rn,
       date, headline, summary
from (select *, row_number() over (partition by symbol, week_idx order by {sample_key('week_idx')}, {ART_ORDER}) as pk
      from art_weeks)
where pk <= {TOP_K}"""

# 2.8 set operations
SQL["weekly_returns"] = with_(PRICES, WEEKLY) + """
select symbol, week_idx, start_date, start_price, end_date, end_price, weekly_return, bin_label from weekly"""
SQL["union_symbols"] = SQL["weekly_returns"]

# 2.9 column functions
SQL["bin_label"] = with_(PRICES, WEEKLY) + """
select symbol, date, ret,
       case when ret is null or isnan(ret) or isinf(ret) then null
            else (case when ret >= 0 then 'U' else 'D' end) ||
                 (case when ceil(abs(100 * ret)) <= 5 then cast(cast(ceil(abs(100 * ret)) as bigint) as varchar)
                       else '5+' end) end as bin_label
from (select symbol, date, price / lag(price) over (partition by symbol order by date) - 1 as ret,
             row_number() over (partition by symbol order by date) as rn
      from daily) where rn > 1"""
V2 = "bin_label"
for a, b in fixed.BIN_PHRASE_V2_STEPS:
    V2 = f"replace({V2}, {q(a)}, {q(b)})"
SQL["bin_phrase"] = with_(PRICES, WEEKLY) + f"""
select symbol, week_idx, bin_label, {PHRASE_V1} as phrase_v1, {V2} as phrase_v2 from weekly"""
SQL["week_header"] = with_(PRICES, WEEKLY) + f"""
select symbol, week_idx, {header('later')} as header_later, {header('earlier')} as header_earlier from weekly"""
SQL["news_text"] = with_(PRICES, NEWS, BASICS_LONG, WEEKLY, NEWS_DAYS, ART_WEEKS, BMAP, WB,
                         BLOCKS.split(",\nhist AS")[0]) + "select symbol, week_idx, news_text from blocks"
SQL["basics_text"] = with_(PRICES, BASICS_LONG, WEEKLY, BMAP, asof("wb", True)) + f"""
select symbol, week_idx,
       case when basics_period is null then {q(fixed.BASICS_LIST_EMPTY)}
            else {tpl(fixed.BASICS_LIST_HEAD, symbol='symbol', period=iso('basics_period'))} || metrics_text end as basics_text
from wb"""
SQL["basics_highlights"] = with_(PRICES, BASICS_LONG, WEEKLY, BMAP, asof("wb", False)) + f"""
select symbol, week_idx, {highlights_utils()} as highlights from wb"""
_ITEMS2 = []
for c, (_, thr, t) in zip(["pe", "roe", "om", "de", "nm", "roa"], fixed.HIGHLIGHTS_DATA):
    cond = f"{c} is not null" if thr is None else f"{c} > {thr}"
    _ITEMS2.append(f"case when {cond} then {q(t.split('{}')[0])} || cast({c} as varchar) || {q(t.split('{}')[1])} end")
SQL["basics_highlights_list"] = with_(PRICES, BASICS_LONG, WEEKLY, BMAP, asof("wb", True)) + f"""
select symbol, week_idx, {' + '.join(f'(case when ({x}) is null then 0 else 1 end)' for x in _ITEMS2)} as n_highlights,
       concat_ws(chr(10), {', '.join(_ITEMS2)}) as highlights
from wb"""
SQL["company_intro"] = with_(PROFILES) + f"""
select symbol, {company_intro('later')} as intro_later, {company_intro('earlier')} as intro_earlier from profiles"""
SQL["crypto_intro"] = with_(PROFILES) + f"select symbol, {crypto_intro()} as intro from profiles"
SQL["system_prompt"] = with_(MEMBERS) + f"""
select symbol, sp as system_prompt, replace(sp, {q(fixed.SYSTEM_REWRITE_FROM)}, {q(fixed.SYSTEM_REWRITE_TO)}) as training_system_prompt
from (select symbol, case when asset_class = 'crypto' then {q(fixed.SYSTEM_PROMPTS['crypto'])}
                          else {q(fixed.SYSTEM_PROMPTS['company'])} end as sp from members)"""
OLD = f"""old AS (
  select symbol, week_idx,
         {header('later')} || chr(10) || chr(10) ||
         {tpl(fixed.ASSUME_SENTENCE, period=iso('start_date') + " || ' to ' || " + iso('end_date'), phrase=PHRASE_V1)} as prompt
  from weekly)"""
SQL["extract_period_label"] = with_(PRICES, WEEKLY, OLD) + f"""
select symbol, week_idx,
       case when m then regexp_extract(prompt, {q(fixed.ASSUME_PATTERN)}, 1) end as period,
       case when m then regexp_extract(prompt, {q(fixed.ASSUME_PATTERN)}, 2) end as label,
       m as matched
from (select *, regexp_matches(prompt, {q(fixed.ASSUME_PATTERN)}) as m from old)"""
SQL["rewrite_request"] = with_(PRICES, WEEKLY, OLD) + f"""
select symbol, week_idx,
       regexp_replace(prompt, {q(fixed.ASSUME_FULL_PATTERN)},
                      {tpl(fixed.REQUEST_SENTENCE, symbol='symbol', period=f"regexp_extract(prompt, {q(fixed.ASSUME_PATTERN)}, 1)")}, 'g') as prompt
from old where regexp_matches(prompt, {q(fixed.ASSUME_PATTERN)})"""
SQL["inject_label"] = with_(*BASE, ANSWERS) + f"""
select a.symbol, a.week_idx,
       regexp_replace(a.answer, {q(fixed.ANALYSIS_HEADING_PATTERN)},
                      {q('[Prediction & Analysis]:' + chr(10) + 'Prediction: ')} || {CAP} || {q(chr(10) + 'Analysis: ')}, 'g') as answer
from answers a join (select symbol, week_idx, {PHRASE_V1} as label from weekly where bin_label is not null) w
  on w.symbol = a.symbol and w.week_idx = a.week_idx"""
SQL["strip_prompt"] = with_(*BASE) + """
select symbol, week_idx, case when week_idx % 8 = 7 then '' else 'Outlook for ' || symbol || ' week ' || week_idx end as answer
from prompts"""
SQL["number_text"] = """
select l_orderkey, l_linenumber, x, printf('%.2f', x) as money_text, cast(x as varchar) as plain_text
from (select l_orderkey, l_linenumber, unnest([l_extendedprice::double / 8, l_extendedprice::double / 1000,
                                              l_extendedprice::double * 1e6]) as x from lineitem)"""
SQL["predicted_label"] = with_(*BASE, ANSWERS, PRED) + "select symbol, week_idx, answer, pred_label from pred"

# 2.10 composite jobs
SQL["build_panel"] = SQL["panel_roundtrip"]
SQL["build_prompts"] = with_(*BASE) + "select symbol, week_idx, start_date, end_date, prompt from prompts"
SQL["generate_answers"] = with_(*BASE, ANSWERS) + "select symbol, week_idx, prompt, answer from answers"
SQL["skipped_symbols"] = with_(*BASE, ANSWERS) + """
select distinct symbol, 'no answers' as reason from weekly
where symbol not in (select a.symbol from answers a join members m on m.symbol = a.symbol where m.index_name = 'dow')"""
SQL["generate_outcomes"] = with_(*BASE, ANSWERS) + """
select symbol, week_idx, answer, 1 as attempts,
       case when (week_idx * 31 + cast(substr(symbol, 7) as int) * 13) % 8 = 7 then 'no text' end as error
from answers"""
SQL["training_rows"] = with_(*BASE, ANSWERS, TRAINING) + "select symbol, week_idx, prompt, answer, period, label from tr"
OLD_TRAIN = f"""tr_old AS (
  select a.symbol, a.week_idx,
         {q(fixed.B_INST + fixed.B_SYS)} || {TRAIN_SYS} || {q(fixed.E_SYS)} || a.prompt || {q(fixed.E_INST)} as prompt,
         {q('[Prediction & Analysis]:' + chr(10) + 'Prediction: ')} || {CAP} || {q(chr(10) + 'Analysis: ')}
           || {q('A plain outlook.')} as answer,
         a.period, a.label
  from (select symbol, week_idx, regexp_extract(prompt, {q(fixed.ASSUME_PATTERN)}, 1) as period,
               regexp_extract(prompt, {q(fixed.ASSUME_PATTERN)}, 2) as label,
               regexp_replace(prompt, {q(fixed.ASSUME_FULL_PATTERN)},
                      {tpl(fixed.REQUEST_SENTENCE, symbol='symbol', period=f"regexp_extract(prompt, {q(fixed.ASSUME_PATTERN)}, 1)")}, 'g') as prompt
        from old where regexp_matches(prompt, {q(fixed.ASSUME_PATTERN)})) a
  join (select symbol, max(asset_class) as asset_class from members group by symbol) c on c.symbol = a.symbol)"""
SQL["training_rows_regex"] = with_(PRICES, MEMBERS, WEEKLY, OLD, OLD_TRAIN) + """
select symbol, week_idx, prompt, answer, period, label from tr_old"""
SQL["training_rejects"] = with_(PRICES, WEEKLY, OLD) + f"""
select symbol, week_idx, prompt, {q('[Prediction & Analysis]:' + chr(10) + 'A plain outlook.')} as answer
from old where prompt is not null and not regexp_matches(prompt, {q(fixed.ASSUME_PATTERN)})"""
SQL["create_dataset"] = with_(*BASE, ANSWERS, TRAINING) + "select * from ds"
SQL["evaluation_report"] = SQL["evaluation_roundtrip"]
SQL["recent_panel"] = with_(PRICES, NEWS, MEMBERS, NEWS_DAYS, STEPS) + """
select i.symbol, i.row_idx, i.start_date, i.end_date, i.start_price, i.end_price,
       coalesce(n.n_news, 0) as n_news, coalesce(n.news_digest, 0) as news_digest
from iv i left join (select symbol, row_idx, count(*) as n_news, """ + DIGEST + """ as news_digest
                     from iv_news group by 1, 2) n on n.symbol = i.symbol and n.row_idx = i.row_idx"""
SQL["online_prompts"] = with_(PRICES, NEWS, BASICS_LONG, PROFILES, MEMBERS, NEWS_DAYS, STEPS, BMAP,
                              "cls AS (select symbol, max(asset_class) as asset_class from members group by symbol)",
                              ONLINE) + f"select symbol, info, info || {ONLINE_END} as prompt from info"
SQL["full_run"] = with_(*BASE, ANSWERS, TRAINING) + """
select * from ds where symbol in (select symbol from members where index_name = 'dow')"""

RANGE = PRICES.replace("from lineitem join part on l_partkey = p_partkey",
                                             "from lineitem join part on l_partkey = p_partkey\n"
                                             f"  where cast(l_shipdate as date) >= date '{RUN_START}' "
                                             f"and cast(l_shipdate as date) < date '{RUN_END}'")
SQL["full_run_range"] = with_(RANGE, *BASE[1:], ANSWERS, TRAINING) + """
select * from ds where symbol in (select symbol from members where index_name = 'dow')"""
SQL["full_run_euro"] = with_(*BASE, ANSWERS, TRAINING) + """
select * from ds where symbol in (select symbol from members where index_name = 'euro')"""
SQL["full_run_crypto"] = with_(*BASE, ANSWERS, TRAINING) + """
select * from ds where symbol in (select symbol from members where index_name = 'crypto')"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
