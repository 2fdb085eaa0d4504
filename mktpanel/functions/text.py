"""Text column functions used to build prompts and training rows.

Everything is a Spark column expression; templates are filled with ``concat``
so no text is built in Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from mktpanel.functions import fixed

_FIELD = re.compile(r"\{(\w+)\}")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill(template: str, **cols) -> Column:
    """``template.format(**cols)`` as a column: literal pieces and columns concatenated.

    A NULL column makes the result NULL, as ``concat`` does; callers coalesce
    first where a missing value must print.
    """
    parts, pos = [], 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        v = cols[m.group(1)]
        parts.append(v if isinstance(v, Column) else F.lit(v))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")


# Doubles from here on are whole and leave the range of a long.
_LONG_END = 9.2e18


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once and the expression kept small."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _two_decimals(x: Column) -> Column:
    a = F.abs(x)
    whole = F.floor(a)

    def cents_of(part: Column) -> Column:
        split = part * 134217729.0
        high = split - (split - part)
        product = part * 100.0
        error = (high * 100.0 - product) + (part - high) * 100.0
        down = F.floor(product)
        past_half = (product - down) - 0.5
        return down + F.when((past_half > -error) | ((past_half == -error) & (down % 2 == 1)), 1).otherwise(0)

    return _let(cents_of(a - whole), lambda cents: F.concat(
        F.when(F.startswith(x.cast("string"), F.lit("-")), F.lit("-")).otherwise(F.lit("")),
        (whole + F.floor(cents / 100)).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0")))


def _cents(a: Column) -> Column:
    """100 * ``a`` as a long, half to even, for 0 <= a < 1e13; one compiled expression without ``_let``.

    Where the rounded product is no half, the exact one lies on the same side
    of it.  Where it is, 200 times the part after the point is compared with
    that half exactly, in two pieces of few bits.
    """
    part = a - F.floor(a)
    down = F.floor(part * 100.0)
    high = F.floor(part * 67108864.0) / 67108864.0
    over = (high * 200.0 - (down * 2 + 1)) + (part - high) * 200.0
    rest = part * 100.0 - down
    up = (rest > 0.5) | ((rest == 0.5) & ((over > 0) | ((over == 0) & (down % 2 == 1))))
    return F.floor(a) * 100 + down + F.when(up, 1).otherwise(0)


def _minus(x: Column) -> Column:
    """The sign in front, that of -0.0 included."""
    negative = (x < 0) | ((x == 0) & F.startswith(x.cast("string"), F.lit("-")))
    return F.when(negative, F.lit("-")).otherwise(F.lit(""))


def money(x) -> Column:
    """``{:.2f}``: the exact binary value rounded half to even; NULL prints as ``None``.

    From 1e13 on the part after the point is split off exactly and 100 times
    it is taken as a rounded product plus its error (its two halves have few
    enough bits); the rest of that is compared with a half.
    """
    x = _c(x).cast("double")
    cents = _cents(F.abs(x))
    common = F.concat(_minus(x), _over(cents, F.lit(100)).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    return F.coalesce(F.when(F.abs(x) < 1e13, common).otherwise(
        _let(x, lambda v: F.when(F.isnan(v), F.lit("nan")).when(
            F.abs(v) < _LONG_END, _two_decimals(v)).when(F.abs(v) < float("inf"), F.format_string("%.2f", v)).when(
            v > 0, F.lit("inf")).when(v < 0, F.lit("-inf")))), F.lit(fixed.NULL_TEXT))


# Powers of ten that are exact doubles, and their halves of few bits (whose products have no error).
_POWERS = [10.0 ** i for i in range(23)]
_HIGHS = [p * 134217729.0 - (p * 134217729.0 - p) for p in _POWERS]
_LOWS = [p - h for p, h in zip(_POWERS, _HIGHS, strict=True)]


def _over(n: Column, by: Column) -> Column:
    """Whole-number quotient of non-negative longs."""
    return F.call_function("div", n, by)


def _times_power(x: Column, p: Column) -> Column:
    """struct<n, rest>: x * 10^p rounded to a whole number and what is left over, exactly (0 <= p <= 22)."""
    at = lambda values: F.get(F.expr("array(" + ",".join(f"{v!r}D" for v in values) + ")"), p)
    halves = F.struct((x * 134217729.0 - (x * 134217729.0 - x)).alias("high"), at(_POWERS).alias("power"),
                      at(_HIGHS).alias("power_high"), at(_LOWS).alias("power_low"))

    def multiplied(t: Column) -> Column:
        low, product = x - t["high"], x * t["power"]
        error = ((t["high"] * t["power_high"] - product) + low * t["power_high"] + t["high"] * t["power_low"]) + low * t["power_low"]
        return _let(F.struct(product.alias("product"), error.alias("error")), lambda u: F.struct(
            (u["product"].cast("long") + F.bround(u["error"], 0).cast("long")).alias("n"),
            (u["error"] - F.bround(u["error"], 0)).alias("rest")))

    return _let(halves, multiplied)


def _divided(x: Column, by: Column) -> Column:
    """struct<n, rest> of a whole number over 10 or 100."""
    whole = x.cast("long")
    n = F.round((whole % by) / by, 0).cast("long") + _over(whole, by)
    return _let(n, lambda n: F.struct(n.alias("n"), ((whole - n * by) / by).cast("double").alias("rest")))


def _seventeen(v: Column, exp: Column, platform: Column) -> Column:
    """struct<n, rest>: the 17 digits nearest to ``v`` = d.ddd x 10^exp as a number, and what is left over of it.

    For 1e-6 <= v < 9.2e18 the value times (or, if whole, divided by) a power
    of ten is taken exactly; beyond, ``platform`` has the platform's digits.
    """
    return (F.when(~((v >= 1e-6) & (v < _LONG_END)), F.struct(platform.alias("n"), F.lit(0.0).alias("rest")))
             .when(exp <= 16, _times_power(v, 16 - exp))
             .otherwise(_divided(v, F.when(exp == 18, F.lit(100)).otherwise(F.lit(10)).cast("long"))))


def _shortest(v: Column, exp: Column, platform: Column) -> Column:
    """struct<digits, exp>: the fewest digits that read back as ``v`` > 0, and of these the nearest to it."""
    def reads_back(n: Column, digits: int) -> Column:
        return F.concat(n.cast("string"), F.lit("E"), (exp - digits + 1).cast("string")).cast("double") == v

    def candidates(t: Column) -> Column:
        n, rest, last = t["n"], t["rest"], t["n"] % 10
        down = _over(n, F.lit(10))
        up = (last > 5) | ((last == 5) & ((rest > 0) | ((rest == 0) & (down % 2 == 1))))
        return F.struct(n.alias("n"), _over(n + 50, F.lit(100)).alias("fifteen"),
                        (down + F.when(up, 1).otherwise(0)).alias("near"), (down + F.when(up, 0).otherwise(1)).alias("other"))

    def chosen(t: Column) -> Column:
        pick = lambda n, digits: F.struct(t[n].alias("n"), F.lit(digits).alias("digits"))
        return F.when(reads_back(t["fifteen"], 15), pick("fifteen", 15)).when(reads_back(t["near"], 16), pick("near", 16)).when(
            reads_back(t["other"], 16), pick("other", 16)).otherwise(pick("n", 17))

    def written(t: Column) -> Column:
        n = t["n"].cast("string")
        return F.struct(F.rtrim(n, F.lit("0")).alias("digits"), (exp + F.length(n) - t["digits"]).alias("exp"))

    return _let(_let(_let(_seventeen(v, exp, platform), candidates), chosen), written)


def _decimal(x: Column) -> Column:
    """struct<digits, exp>: the shortest d.ddd x 10^exp of a finite value, whatever digits the platform writes.

    Up to 15 digits are the platform's: no two decimals of that length read as
    one double.  A longer text may have digits too many or a last one too far.
    """
    def split(s: Column) -> Column:
        mantissa = F.split_part(s, F.lit("E"), F.lit(1))
        return F.struct(F.split_part(mantissa, F.lit("."), F.lit(1)).alias("whole"),
                        F.split_part(mantissa, F.lit("."), F.lit(2)).alias("frac"),
                        F.split_part(s, F.lit("E"), F.lit(2)).alias("power"))

    def read(t: Column) -> Column:
        zeros = F.length(t["frac"]) - F.length(F.ltrim(t["frac"], F.lit("0")))
        exp = F.when(t["power"] != "", t["power"].cast("int")).when(t["whole"] != "0", F.length(t["whole"]) - 1).otherwise(-1 - zeros)
        digits = F.rtrim(F.ltrim(F.concat(t["whole"], t["frac"]), F.lit("0")), F.lit("0"))
        return F.struct(digits.alias("digits"), exp.alias("exp"))

    def shortened(t: Column) -> Column:
        n = F.length(t["digits"])
        carry = F.when((n > 17) & (F.substr(t["digits"], F.lit(18), F.lit(1)) >= "5"), 1).otherwise(0)
        platform = F.rpad(t["digits"], 17, "0").cast("long") + carry
        zero = F.struct(F.lit("0").alias("digits"), F.lit(0).alias("exp"))
        return F.when(n == 0, zero).when(n <= 15, t).otherwise(_shortest(F.abs(x), t["exp"], platform))

    return _let(_let(_let(F.abs(x).cast("string"), split), read), shortened)


def _python_digits(x: Column) -> Column:
    """``str(float)`` of any value."""
    def laid_out(t: Column) -> Column:
        digits, exp, more = t["digits"], t["exp"], F.length(t["digits"]) - 1
        large = F.when(more <= exp, F.concat(digits, F.repeat(F.lit("0"), exp - more), F.lit(".0"))).otherwise(
            F.concat(F.left(digits, exp + 1), F.lit("."), F.substr(digits, exp + 2)))
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
        power = F.concat(F.left(digits, F.lit(1)), F.when(more > 0, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise(F.lit("")),
                         F.when(exp < 0, F.lit("e-")).otherwise(F.lit("e+")),
                         F.when(F.abs(exp) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(exp).cast("string"))
        return F.when((exp >= 0) & (exp < 16), large).when((exp < 0) & (exp >= -4), small).otherwise(power)

    sign = F.when(F.startswith(x.cast("string"), F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    return (F.when(F.isnan(x), F.lit("nan")).when(F.abs(x) == float("inf"), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
             .otherwise(F.concat(sign, _let(_decimal(x), laid_out))))


def num_text(x) -> Column:
    """``str(float)``: plain digits for exponents -4 to 15, else ``d.de+XX``; NULL prints as ``None``.

    The shortest digits that read back as the same double, on any Java.  Among
    several of that length the nearest is taken exactly for 1e-6 <= |x| <
    9.2e18; beyond, the nearest to the platform's digits (values below
    2.3e-308, which have few bits, have the platform's digits as they are).
    """
    x = _c(x).cast("double")
    a = F.abs(x)
    # A short plain text has at most 15 digits, which need no second look.
    common = (((a >= 0.001) & (a < 1e7)) | (x == 0)) & (F.length(x.cast("string")) <= 16)
    # Whole numbers below 2^53 are their own shortest text.
    whole = (a < 9007199254740992.0) & (F.rint(x) == x)
    return F.coalesce(F.when(common, x.cast("string")).when(whole, F.concat(x.cast("long").cast("string"), F.lit(".0"))).otherwise(
        _let(x, _python_digits)), F.lit(fixed.NULL_TEXT))


def iso_date(d) -> Column:
    return F.date_format(_c(d), "yyyy-MM-dd")


def movement(start_price, end_price) -> Column:
    """``increased`` only when the end price is strictly higher."""
    return F.when(_c(end_price) > _c(start_price), F.lit(fixed.MOVE_UP)).otherwise(F.lit(fixed.MOVE_DOWN))


def week_header(symbol, start_date, end_date, start_price, end_price, variant: str = "later") -> Column:
    """Week header sentence (C4); ``earlier`` ends with the news lead-in."""
    tpl = fixed.HEADER_LATER if variant == "later" else fixed.HEADER_EARLIER
    return fill(tpl, start=iso_date(start_date), end=iso_date(end_date), symbol=_c(symbol),
                move=movement(start_price, end_price), sp=money(start_price), ep=money(end_price))


def article_text(headline, summary, variant: str = "later") -> Column:
    """One article (C5): ``- headline: summary`` or the bracketed earlier form."""
    h = F.coalesce(_c(headline), F.lit(fixed.NULL_TEXT))
    s = F.coalesce(_c(summary), F.lit(fixed.NULL_TEXT))
    if variant == "later":
        return F.concat(F.lit("- "), h, F.lit(": "), s)
    return fill(fixed.ARTICLE_EARLIER, headline=h, summary=s)


def news_text(items, fallback: str = fixed.NO_NEWS_LATER) -> Column:
    """Join article texts by newline, or the fallback when there are none."""
    # Items are never empty strings, so an empty join means no items; the
    # array is then evaluated once.
    return F.coalesce(F.nullif(F.array_join(_c(items), "\n"), F.lit("")), F.lit(fallback))


def metrics_lines(metrics) -> Column:
    """``k: v`` lines of a metrics map, sorted by metric name."""
    entries = F.array_sort(F.map_entries(_c(metrics)))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), num_text(e["value"]))), "\n")


def basics_text(symbol, period, metrics) -> Column:
    """Basics listing (C6): header with the period, then ``k: v`` lines; none -> fallback."""
    body = F.concat(fill(fixed.BASICS_LIST_HEAD, symbol=_c(symbol), period=iso_date(period)),
                    F.coalesce(metrics_lines(metrics), F.lit("")))
    return F.when(_c(period).isNull(), F.lit(fixed.BASICS_LIST_EMPTY)).otherwise(body)


def _highlight_items(metrics, rules, stop_on_null: bool):
    m = _c(metrics)
    items, stopped = [], None
    for key, threshold, template in rules:
        value = F.element_at(m, F.lit(key))
        if stop_on_null:
            # A metric present with a NULL value ends the list, itself included.
            here = F.map_contains_key(m, F.lit(key)) & value.isNull()
            stopped = here if stopped is None else (stopped | here)
            ok = (~stopped) & (F.coalesce(value, F.lit(-1.0)) > F.lit(threshold))
        else:
            ok = value.isNotNull() if threshold is None else (value > F.lit(threshold))
        head, tail = template.split("{}")
        items.append(F.struct(ok.alias("ok"), F.lit(head).alias("head"), value.alias("value"), F.lit(tail).alias("tail")))
    # One text expression for all items; those that do not count are NULL.
    written = F.transform(F.array(*items), lambda e: F.when(e["ok"], F.concat(e["head"], num_text(e["value"]), e["tail"])))
    return written, (stopped if stopped is not None else F.lit(False))


def basics_highlights(period, metrics) -> Column:
    """Highlights text, first variant (C7): thresholds P/E > 0, ROE > 0.3, operating
    margin > 0.2, debt/equity > 2, net margin > 0.2, ROA > 0.1 in that order; a present
    NULL value ends the list with "Financial summary unavailable."."""
    items, stop = _highlight_items(metrics, fixed.HIGHLIGHTS_UTILS, stop_on_null=True)
    # concat_ws skips NULL items; an empty result means no highlight, so the
    # list is built once.
    joined = F.concat_ws(", ", items, F.when(stop, F.lit(fixed.HIGHLIGHTS_UNAVAILABLE)))
    text = F.coalesce(F.concat(F.lit(fixed.HIGHLIGHTS_HEAD), F.nullif(joined, F.lit(""))), F.lit(fixed.HIGHLIGHTS_NONE))
    return F.when(_c(period).isNull(), F.lit(fixed.HIGHLIGHTS_EMPTY)).otherwise(text)


def basics_highlights_list(metrics) -> Column:
    """Highlights as an array, second variant (C8): P/E whenever present, margin > 0.3."""
    items, _ = _highlight_items(F.coalesce(_c(metrics), F.create_map().cast("map<string,double>")),
                                fixed.HIGHLIGHTS_DATA, stop_on_null=False)
    return F.array_compact(items)


def company_intro(profile: dict | None = None, variant: str = "later") -> Column:
    """Company introduction (C9) from profile columns (names as in the profile source)."""
    p = {k: F.col(k) for k in ("name", "finnhubIndustry", "ipo", "marketCapitalization",
                                "currency", "shareOutstanding", "country", "ticker", "exchange")}
    p.update(profile or {})
    # A missing field prints as such; it must not make the whole prompt NULL.
    p = {k: money(v) if k in ("marketCapitalization", "shareOutstanding") else F.coalesce(v, F.lit(fixed.NULL_TEXT))
         for k, v in p.items()}
    tpl = fixed.COMPANY_INTRO_LATER if variant == "later" else fixed.COMPANY_INTRO_EARLIER
    return fill(tpl, **p)


def crypto_intro(description="description", market_cap="marketCap") -> Column:
    """Crypto introduction."""
    return fill(fixed.CRYPTO_INTRO, description=F.coalesce(_c(description), F.lit(fixed.NULL_TEXT)),
                marketCap=F.coalesce(_c(market_cap).cast("string"), F.lit(fixed.NULL_TEXT)))


def task_ending(symbol, start_date, end_date) -> Column:
    """Task ending of an offline prompt (C11)."""
    return fill(fixed.TASK_ENDING, start_date=iso_date(start_date), end_date=iso_date(end_date),
                symbol=_c(symbol))


def system_prompt(asset_class) -> Column:
    """System prompt by asset class."""
    return (F.when(_c(asset_class) == "crypto", F.lit(fixed.SYSTEM_PROMPTS["crypto"]))
             .otherwise(F.lit(fixed.SYSTEM_PROMPTS["company"])))


def training_system_prompt(system) -> Column:
    """System prompt for training rows (C13): ``:\\n...`` -> prediction/analysis lines."""
    return F.replace(_c(system), F.lit(fixed.SYSTEM_REWRITE_FROM), F.lit(fixed.SYSTEM_REWRITE_TO))


def extract_period_label(prompt):
    """(period, label, matched) read from an old-form request sentence (C14)."""
    p = _c(prompt)
    matched = p.rlike(fixed.ASSUME_PATTERN)
    return (F.when(matched, F.regexp_extract(p, fixed.ASSUME_PATTERN, 1)),
            F.when(matched, F.regexp_extract(p, fixed.ASSUME_PATTERN, 2)),
            matched)


def regex_literal(replacement) -> Column:
    """Escape ``\\`` and ``$`` so a column is inserted verbatim by ``regexp_replace``."""
    r = F.replace(_c(replacement), F.lit("\\"), F.lit("\\\\"))
    return F.replace(r, F.lit("$"), F.lit("\\$"))


def rewrite_request(prompt, symbol, period) -> Column:
    """Old assume-sentence -> prediction request (C15); says "cryptocurrency" for any symbol."""
    repl = fill(fixed.REQUEST_SENTENCE, symbol=_c(symbol), period=_c(period))
    return F.regexp_replace(_c(prompt), F.lit(fixed.ASSUME_FULL_PATTERN), regex_literal(repl))


def capitalize(s) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower."""
    x = _c(s)
    return F.concat(F.upper(F.left(x, F.lit(1))), F.lower(F.substr(x, F.lit(2))))


def inject_label(answer, label) -> Column:
    """Put ``Prediction: <Label>`` and ``Analysis:`` under the analysis heading."""
    head, tail = fixed.ANALYSIS_HEADING_REPLACEMENT.split("{label}")
    repl = F.concat(F.lit(head), capitalize(label), F.lit(tail))
    return F.regexp_replace(_c(answer), F.lit(fixed.ANALYSIS_HEADING_PATTERN), regex_literal(repl))


def inst_wrap(system, prompt) -> Column:
    """``[INST]<<SYS>>\\n system \\n<</SYS>>\\n\\n prompt [/INST]`` (C17)."""
    return F.concat(F.lit(fixed.B_INST + fixed.B_SYS), _c(system), F.lit(fixed.E_SYS),
                    _c(prompt), F.lit(fixed.E_INST))


# Characters Python's str.strip() removes: every code point with str.isspace().
PY_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def py_strip(s) -> Column:
    """Python ``str.strip()``: remove Python whitespace characters at both ends."""
    return F.btrim(_c(s), F.lit(PY_WHITESPACE))


def strip_prompt(generated, full_prompt) -> Column:
    """Generated text after the prompt, stripped (C18); NULL (failed call) -> ``''``."""
    tail = F.substr(_c(generated), F.length(_c(full_prompt)) + 1)
    return F.coalesce(py_strip(tail), F.lit(""))


def news_stamp(epoch_seconds) -> Column:
    """Epoch seconds -> ``yyyyMMddHHmmss`` in UTC, independent of the session zone."""
    ts = F.timestamp_add("SECOND", _c(epoch_seconds), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.date_format(ts, "yyyyMMddHHmmss")


def news_day(epoch_seconds) -> Column:
    """UTC calendar day of an epoch-seconds value."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(_c(epoch_seconds) / 86400).cast("int"))


def forecast_period(curday) -> Column:
    """``curday to curday+7``."""
    d = _c(curday)
    return F.concat(iso_date(d), F.lit(" to "), iso_date(F.date_add(d, 7)))
