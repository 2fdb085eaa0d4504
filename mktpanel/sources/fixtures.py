"""Domain tables derived from the driver's parquet tables.

The driver ships TPC-H-like tables, not market data, so prices, news,
fundamentals, profiles and index membership are derived from them by fixed
rules (documented in FIXTURES.md).  The oracle SQL in ``mktpanel.oracle``
derives the same tables independently in DuckDB.  Every derivation is a
distributed aggregate or projection, so its cost grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mktpanel.functions import fixed

# First news second: 1999-01-03 00:00:00 UTC (a Sunday); articles spread over 420 days.
NEWS_EPOCH0 = 915321600
NEWS_DAYS = 420
# Metric name by line number.
METRIC_BY_LINE = ["peTTM", "roeTTM", "operatingMargin", "totalDebtToEquity", "netMargin", "roaTTM"]
METRIC_OTHER = "currentRatio"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items counted per (brand, ship day, line number): the one pass over ``lineitem``.

    Both prices and fundamentals are derived from this aggregate, whose size is
    bounded by brands x days x line numbers however large ``lineitem`` grows;
    sharing it lets a query scan and join ``lineitem`` once.
    """
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_linenumber", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (li.join(part, li.l_partkey == part.p_partkey)
              .groupBy(F.col("p_brand").alias("symbol"), F.col("l_shipdate").cast("date").alias("date"),
                       F.col("l_linenumber").alias("line"))
              .agg(F.count(F.lit(1)).alias("n")))


def prices(spark: SparkSession, sf_dir: str, counts: DataFrame | None = None) -> DataFrame:
    """prices(symbol, date, close, adj_close, volume): one row per brand and ship day.

    ``Brand#1`` has no adjusted close, so price selection falls back to close.
    """
    c = counts if counts is not None else line_counts(spark, sf_dir)
    g = (c.groupBy("symbol", "date")
          .agg(F.sum(F.col("line") * F.col("n")).alias("s"), F.sum("n").alias("volume")))
    rem = F.col("s") % 13
    return g.select(
        "symbol", "date",
        (F.lit(110) + rem).cast("double").alias("close"),
        F.when(F.col("symbol") == "Brand#1", F.lit(None).cast("double"))
         .otherwise((F.lit(100) + rem).cast("double")).alias("adj_close"),
        "volume")


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """news(symbol, datetime epoch s, headline, summary), one article per document.

    Half of the articles are on one symbol, the others on all 25 in turn.  The
    headline is the whole first line, the summary the whole text on one line;
    every seventeenth headline is NULL and every tenth summary begins with the
    boilerplate.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    doc = F.col("doc_id")
    whole = F.replace("text", F.lit("\n"), F.lit(" "))
    brand = F.when(doc % 2 == 0, F.lit(1)).otherwise(F.lit(1) + F.floor(doc / 2) % 25)
    return d.select(
        F.concat(F.lit("Brand#"), brand.cast("string")).alias("symbol"),
        (F.lit(NEWS_EPOCH0) + ((doc * 7919) % NEWS_DAYS) * 86400 + (doc * 37) % 86400).alias("datetime"),
        F.when(doc % 17 == 0, F.lit(None).cast("string"))
         .otherwise(F.split_part("text", F.lit("\n"), F.lit(1))).alias("headline"),
        F.when(doc % 10 == 0, F.concat(F.lit(fixed.BOILERPLATE_LONG), whole)).otherwise(whole).alias("summary"))


def basics_long(spark: SparkSession, sf_dir: str, counts: DataFrame | None = None) -> DataFrame:
    """basics_long(symbol, period, metric, v): quarterly metrics per brand."""
    c = counts if counts is not None else line_counts(spark, sf_dir)
    line = F.col("line")
    metric = F.lit(METRIC_OTHER)
    for i in range(len(METRIC_BY_LINE), 0, -1):
        metric = F.when(line == i, F.lit(METRIC_BY_LINE[i - 1])).otherwise(metric)
    period = F.last_day(F.add_months(F.trunc("date", "quarter"), 2))
    return (c.groupBy("symbol", period.alias("period"), metric.alias("metric"))
             .agg((F.sum("n").cast("double") / 10).alias("v")))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """profiles: one row per brand with company and crypto fields."""
    part = table(spark, sf_dir, "part").select("p_brand", "p_type", "p_retailprice", "p_size")
    return (part.groupBy(F.col("p_brand").alias("symbol"))
                .agg(F.min("p_type").alias("finnhubIndustry"),
                     F.max("p_retailprice").alias("marketCapitalization"),
                     (F.count(F.lit(1)).cast("double") + 0.5).alias("shareOutstanding"),
                     F.sum("p_size").cast("bigint").alias("marketCap"))
                .select("symbol",
                        F.concat(F.lit("Company "), F.col("symbol")).alias("name"),
                        "finnhubIndustry",
                        F.lit("1990-01-01").alias("ipo"),
                        "marketCapitalization",
                        F.lit("USD").alias("currency"),
                        "shareOutstanding",
                        F.lit("US").alias("country"),
                        F.col("symbol").alias("ticker"),
                        F.lit("XNAS").alias("exchange"),
                        F.concat(F.col("finnhubIndustry"), F.lit(" token "), F.col("symbol")).alias("description"),
                        "marketCap"))


def index_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """index_members(symbol, index_name, asset_class): brands 1-12 dow, 13-20 euro, rest crypto."""
    part = table(spark, sf_dir, "part").select("p_brand")
    n = F.substr("p_brand", F.lit(7)).cast("int")
    idx = F.when(n <= 12, F.lit("dow")).when(n <= 20, F.lit("euro")).otherwise(F.lit("crypto"))
    return (part.select(F.col("p_brand").alias("symbol"), idx.alias("index_name")).distinct()
                .withColumn("asset_class",
                            F.when(F.col("index_name") == "crypto", F.lit("crypto")).otherwise(F.lit("company"))))
