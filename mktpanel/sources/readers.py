"""Sources and sinks with declared schemas.

Market data is landed as files (parquet by default, CSV/JSON accepted); no
provider is called.  Every reader declares its schema, so nothing is inferred,
and filters are expressed before any other work so they reach the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mktpanel.operators.aggregates import collect_news

PRICE_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("adj_close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])
NEWS_SCHEMA = "symbol string, datetime bigint, headline string, summary string"
BASICS_RAW_SCHEMA = "struct<series:struct<quarterly:map<string,array<struct<period:string,v:double>>>>>"
PROFILE_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("finnhubIndustry", T.StringType()),
    T.StructField("ipo", T.StringType()),
    T.StructField("marketCapitalization", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("shareOutstanding", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("marketCap", T.LongType()),
])
PANEL_WEEKS_SCHEMA = ("symbol string, week_idx int, start_date date, start_price double, end_date date, "
                      "end_price double, weekly_return double, bin_label string, basics_period date, "
                      "basics_metrics map<string,double>")
PANEL_NEWS_SCHEMA = ("symbol string, week_idx int, start_date date, end_date date, date string, "
                     "headline string, summary string")
# Wide price field name -> long column.
WIDE_FIELDS = {"Open": "open", "High": "high", "Low": "low", "Close": "close",
               "Adj Close": "adj_close", "Volume": "volume"}


def _nan_to_null(c: str):
    return F.when(~F.isnan(F.col(c)), F.col(c)).alias(c)


def read_prices(spark: SparkSession, path: str, start=None, end=None, symbols=None,
                fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """Daily prices in ``[start, end)`` (S1), optionally for some symbols.

    The date and symbol predicates are pushed into the scan (and prune
    ``symbol=`` partitions when the files are partitioned by symbol).  NaN
    prices become NULL, so later steps use the last valid price.
    """
    r = spark.read.schema(PRICE_SCHEMA).format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    df = r.load(path)
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("date") < F.lit(end).cast("date"))
    if symbols is not None:
        df = df.where(F.col("symbol").isin(list(symbols)))
    return df.select("symbol", "date", *[_nan_to_null(c) for c in ("open", "high", "low", "close", "adj_close")],
                     "volume")


def unpivot_prices(wide: DataFrame, date_col: str = "date") -> DataFrame:
    """Wide ``"<symbol>|<field>"`` columns -> long prices.

    The symbol/field pairs come from the schema, so the reshape is a single
    ``explode`` of per-symbol structs: no shuffle and no pivot.  A field a
    symbol lacks is NULL.
    """
    by_symbol: dict[str, dict[str, str]] = {}
    for name in wide.columns:
        if name == date_col or "|" not in name:
            continue
        sym, field = name.rsplit("|", 1)
        if field in WIDE_FIELDS:
            by_symbol.setdefault(sym, {})[WIDE_FIELDS[field]] = name
    structs = []
    for sym, cols in by_symbol.items():
        vals = [F.lit(sym).alias("symbol")]
        for long_name in ("open", "high", "low", "close", "adj_close"):
            c = cols.get(long_name)
            vals.append((F.col(f"`{c}`") if c else F.lit(None)).cast("double").alias(long_name))
        c = cols.get("volume")
        vals.append((F.col(f"`{c}`") if c else F.lit(None)).cast("bigint").alias("volume"))
        structs.append(F.struct(*vals))
    out = wide.select(F.col(date_col).cast("date").alias("date"), F.explode(F.array(*structs)).alias("p"))
    out = out.select("p.symbol", "date", "p.open", "p.high", "p.low", "p.close", "p.adj_close", "p.volume")
    # A symbol has no row on a day with no value in any of its fields.
    return out.where(F.coalesce("close", "adj_close", "open", "high", "low").isNotNull()
                     | F.col("volume").isNotNull())


def read_wide_prices(spark: SparkSession, path: str, date_col: str = "date", sep: str = ",") -> DataFrame:
    """Wide price files with a header of ``"<symbol>|<field>"`` columns, as the provider gives them -> long prices.

    Nothing is taken from the schema: lines are read as text, and a file's
    header line is exploded into (file, position, symbol, field) rows, which
    its cells meet by position.  The plan has the same size for 30 symbols and
    for 30,000, files may have different columns, and a file may be split
    between tasks.  Empty and NaN cells are no values; a symbol has no row on a day
    without a value in any field.  Cells hold numbers and are not quoted.
    """
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.split("value", re.escape(sep)).alias("cells"))
    is_header = F.trim(F.col("cells")[0], F.lit('" ')) == date_col
    names = lines.where(is_header).select("file", F.posexplode("cells").alias("pos", "name"))
    names = names.select("file", "pos", F.trim("name", F.lit('" ')).alias("name")).distinct()
    field = F.substring_index("name", "|", -1)
    names = names.select("file", "pos", F.expr("left(name, length(name) - length(substring_index(name, '|', -1)) - 1)").alias("symbol"),
                         field.alias("field")).where(F.col("name").contains("|") & field.isin(list(WIDE_FIELDS)))
    cells = lines.where(~is_header & (F.size("cells") > 1)).select(
        "file", F.trim(F.col("cells")[0], F.lit('" ')).cast("date").alias("date"), F.posexplode("cells").alias("pos", "value"))
    cells = cells.where((F.col("pos") > 0) & (F.trim("value") != ""))
    value = F.nanvl(F.col("value").try_cast("double"), F.lit(None))
    one = {long_name: F.max(F.when(F.col("field") == wide, value)) for wide, long_name in WIDE_FIELDS.items()}
    long = cells.join(names, ["file", "pos"]).groupBy("symbol", "date").agg(
        *[v.cast("bigint" if k == "volume" else "double").alias(k) for k, v in one.items()])
    some = F.coalesce("close", "adj_close", "open", "high", "low").isNotNull() | F.col("volume").isNotNull()
    return long.where(some)


def to_wide(prices: DataFrame, symbols: list[str]) -> DataFrame:
    """Long prices -> wide ``"<symbol>|<field>"`` frame (the provider's shape), one row per date."""
    g = prices.groupBy("date").pivot("symbol", symbols).agg(
        F.first("close").alias("Close"), F.first("adj_close").alias("Adj Close"), F.first("volume").alias("Volume"))
    ren = [F.col("date")]
    for c in g.columns:
        for field in ("Adj Close", "Close", "Volume"):
            if c.endswith("_" + field):
                ren.append(F.col(f"`{c}`").alias(f"{c[:-len(field) - 1]}|{field}"))
                break
    return g.select(*ren)


def prices_by_date(prices: DataFrame) -> DataFrame:
    """Long prices -> one row per date with a map ``"<symbol>|<field>" -> value`` (the wide shape as a map).

    A map holds one entry per symbol and field of a day; the plan does not grow with the symbols.
    """
    fields = [F.struct(F.concat("symbol", F.lit("|" + wide)).alias("key"), F.col(long_name).cast("double").alias("value"))
              for wide, long_name in WIDE_FIELDS.items() if long_name in prices.columns]
    entries = prices.select("date", F.explode(F.array(*fields)).alias("e")).where(F.col("e.value").isNotNull())
    return entries.groupBy("date").agg(F.map_from_entries(F.collect_list("e")).alias("values"))


def unpivot_price_maps(by_date: DataFrame) -> DataFrame:
    """``prices_by_date`` rows -> long prices (S2); a field that a symbol lacks is NULL."""
    cells = by_date.select("date", F.explode("values").alias("key", "value"))
    name = F.regexp_extract("key", r"^(.*)\|([^|]*)$", 1)
    field = F.regexp_extract("key", r"^(.*)\|([^|]*)$", 2)
    one = {long_name: F.max(F.when(field == wide, F.col("value"))) for wide, long_name in WIDE_FIELDS.items()}
    return cells.groupBy(name.alias("symbol"), "date").agg(
        *[v.cast("bigint" if k == "volume" else "double").alias(k) for k, v in one.items()])


def parse_news_payload(df: DataFrame, payload_col: str = "payload", symbol_col: str = "symbol") -> DataFrame:
    """Provider news payload (JSON list per row) -> one row per article.

    Items lacking any of ``datetime``, ``headline``, ``summary`` are dropped;
    a key present with a null value is kept (it prints as ``None`` later).
    """
    items = F.explode(F.from_json(F.col(payload_col), "array<map<string,string>>"))
    return _article_from_map(df.select(F.col(symbol_col).alias("symbol"), items.alias("m")))


def _article_from_map(df: DataFrame) -> DataFrame:
    m = F.col("m")
    keep = (F.map_contains_key(m, F.lit("datetime")) & F.map_contains_key(m, F.lit("headline"))
            & F.map_contains_key(m, F.lit("summary")))
    return df.where(keep).select(
        "symbol",
        F.element_at(m, F.lit("datetime")).cast("bigint").alias("datetime"),
        F.element_at(m, F.lit("headline")).alias("headline"),
        F.element_at(m, F.lit("summary")).alias("summary"))


def read_news(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines articles ``{"symbol", "datetime", "headline", "summary"}``."""
    raw = spark.read.text(path)
    m = F.from_json(F.col("value"), "map<string,string>")
    return _article_from_map(raw.select(F.element_at(m, F.lit("symbol")).alias("symbol"), m.alias("m")))


def write_news(news: DataFrame, path: str) -> None:
    """Land articles as JSON lines, keeping explicit nulls (keys stay present)."""
    news.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def basics_raw(basics_long: DataFrame) -> DataFrame:
    """basics_long -> provider form ``(symbol, json)`` with ``series.quarterly`` lists."""
    per_metric = (basics_long.groupBy("symbol", "metric")
                  .agg(F.array_sort(F.collect_list(F.struct(F.date_format("period", "yyyy-MM-dd").alias("period"),
                                                            F.col("v").alias("v")))).alias("vals")))
    per_symbol = per_metric.groupBy("symbol").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "vals")))).alias("quarterly"))
    return per_symbol.select("symbol", F.to_json(F.struct(F.struct("quarterly").alias("series"))).alias("json"))


def read_basics(raw: DataFrame, json_col: str = "json") -> DataFrame:
    """Provider fundamentals -> basics_long(symbol, period, metric, v).

    When a (metric, period) is listed twice the later entry wins.
    """
    doc = F.from_json(F.col(json_col), BASICS_RAW_SCHEMA)
    per_metric = raw.select("symbol", F.explode(doc["series"]["quarterly"]).alias("metric", "vals"))
    per_value = per_metric.select("symbol", "metric", F.posexplode("vals").alias("pos", "x"))
    return (per_value.groupBy("symbol", F.col("x.period").cast("date").alias("period"), "metric")
                     .agg(F.max_by("x.v", "pos").alias("v")))


def read_basics_files(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines ``{"symbol": ..., "json": "<provider document>"}`` files -> basics_long."""
    return read_basics(spark.read.schema("symbol string, json string").json(path))


def read_profiles(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Company / crypto profiles with a declared schema."""
    return spark.read.schema(PROFILE_SCHEMA).format(fmt).load(path)


# ------------------------------------------------------------------ sinks


def write_panel(weeks: DataFrame, news: DataFrame, path: str) -> None:
    """Panel sink (S8): weeks and their articles, parquet partitioned by symbol."""
    replace_symbols(news, f"{path}/news")
    replace_symbols(weeks, f"{path}/weeks")


def replace_symbols(df: DataFrame, path: str) -> None:
    """Write ``df`` partitioned by symbol, replacing the symbols that it holds and no others.

    Rows are rebalanced by symbol first: a symbol's rows come from few tasks,
    and adaptive execution splits a hot one, so there are few small files.
    """
    (df.hint("rebalance", "symbol").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("symbol").parquet(path))


def read_panel(spark: SparkSession, path: str, symbols=None):
    """Panel source (S8) with declared schemas; a symbol filter prunes partitions.

    A table written empty (a universe without news) reads back as empty.
    """
    weeks = spark.read.schema(PANEL_WEEKS_SCHEMA).parquet(f"{path}/weeks")
    news = spark.read.schema(PANEL_NEWS_SCHEMA).parquet(f"{path}/news")
    if symbols is not None:
        weeks = weeks.where(F.col("symbol").isin(list(symbols)))
        news = news.where(F.col("symbol").isin(list(symbols)))
    return weeks, news


PANEL_CSV = ("symbol string, week_idx int, start_date date, start_price double, end_date date, end_price double, "
             "weekly_return double, bin_label string, basics string")
NEWS_CSV = "symbol string, week_idx int, start_date date, end_date date, page int, news string"
_BASICS_CELL = "struct<period:date,metrics:map<string,double>>"
_NEWS_CELL = "array<struct<date:string,headline:string,summary:string>>"
_CSV = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "emptyValue": "", "nullValue": "\\N",
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_panel_json(weeks: DataFrame, news: DataFrame, path: str) -> None:
    """Panel as CSV with JSON cells (S8, C23): a basics cell per week, a news cell per page of a week.

    The news cells of a week in page order are its whole list; no cell holds
    more than ``PAGE_ROWS`` articles.
    """
    keep = {"ignoreNullFields": "false"}
    basics = F.to_json(F.struct(F.col("basics_period").alias("period"), F.col("basics_metrics").alias("metrics")), keep)
    cols = [c.split()[0] for c in PANEL_CSV.split(", ")[:-1]]
    weeks.select(*cols, basics.alias("basics")).write.mode("overwrite").options(**_CSV).csv(f"{path}/weeks")
    pages = collect_news(news, by=("symbol", "week_idx", "start_date", "end_date"))
    pages.select("symbol", "week_idx", "start_date", "end_date", "page", F.to_json("news", keep).alias("news")) \
         .write.mode("overwrite").options(**_CSV).csv(f"{path}/news")


def read_panel_json(spark: SparkSession, path: str):
    """(weeks, news) of ``write_panel_json``, with the cells parsed."""
    weeks = spark.read.schema(PANEL_CSV).options(**_CSV).csv(f"{path}/weeks")
    cell = F.from_json("basics", _BASICS_CELL)
    weeks = weeks.withColumn("_b", cell).select(*[c for c in weeks.columns if c != "basics"],
                                                F.col("_b.period").alias("basics_period"),
                                                F.col("_b.metrics").alias("basics_metrics"))
    pages = spark.read.schema(NEWS_CSV).options(**_CSV).csv(f"{path}/news")
    news = pages.select("symbol", "week_idx", "start_date", "end_date", F.explode(F.from_json("news", _NEWS_CELL)).alias("a"))
    return weeks, news.select("symbol", "week_idx", "start_date", "end_date", "a.date", "a.headline", "a.summary")


def append_answers(answers: DataFrame, path: str) -> None:
    """Answer sink (S9): append-only; the resume step reads it back by key."""
    answers.write.mode("append").parquet(path)


ANSWERS_SCHEMA = "symbol string, week_idx int, prompt string, answer string"


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ANSWERS_SCHEMA).parquet(path)


def dataset_path(base: str, index_name: str, start_date: str, end_date: str,
                 min_weeks: int, max_weeks: int, train_ratio: float) -> str:
    """Dataset folder naming index, dates, history bounds and ratio."""
    label = index_name.lower()
    return (f"{base.rstrip('/')}/forecast-dataset-{label}-{start_date.replace('-', '')}-"
            f"{end_date.replace('-', '')}-{min_weeks}-{max_weeks}-{str(train_ratio).replace('.', '')}")


def write_dataset(dataset: DataFrame, path: str) -> None:
    """Dataset sink (S10): parquet partitioned by split (train/test)."""
    dataset.write.mode("overwrite").partitionBy("split").parquet(path)


DATASET_SCHEMA = "prompt string, answer string, period string, label string, symbol string, week_idx int, split string"


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """The dataset with its declared schema: one written empty reads back as empty."""
    return spark.read.schema(DATASET_SCHEMA).parquet(path)


def write_evaluation(report: DataFrame, path: str) -> None:
    """Evaluation CSV (S11): one row per symbol plus the average."""
    report.write.mode("overwrite").option("header", True).csv(path)


def read_evaluation(spark: SparkSession, path: str) -> DataFrame:
    schema = ("symbol string, samples double, directional_accuracy double, "
              "full_accuracy double, missing_predictions double")
    return spark.read.schema(schema).option("header", True).csv(path)


def pending_symbols(universe: DataFrame, acquired: DataFrame) -> DataFrame:
    """Universe members without an acquired panel yet."""
    return universe.join(acquired.select("symbol").distinct(), "symbol", "left_anti")
