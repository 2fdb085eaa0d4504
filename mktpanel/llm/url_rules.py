"""URL filtering: given host rules first, learned association rules for the rest.

A URL is a set of tokens: scheme, host, each label of the host by its place from the
right, folders, the file's ending, query keys and whether it has a fragment.
Labelled pages are transactions; one that is labelled bad also holds the item
``BAD``.  Spark's FP-growth mines the combinations, and those rules
``combination => BAD`` stay that have the least support and confidence and no
smaller rule inside them (which would fire wherever they do).

Tokens that occur in exactly the same labelled pages can't be told apart by
any rule: they are one item, held by a URL that has any of them.  Without
this the copies of one long URL would be frequent in all their combinations.

Matching is by inverted index: each rule is listed under its rarest item, and
a URL meets only the rules listed under items that it has.  URLs are made
distinct before they are taken apart, so a hot URL is matched once.

Model limits (parameters of ``mine``): a rule has at least ``min_count`` bad
pages, ``min_support`` of all labelled pages and ``min_confidence`` bad pages
among those that it fits.  A transaction of n items has 2 ** n combinations, so
FP-growth takes a page's ``max_items`` rarest items; an item that some page has
beyond these is left out of all its transactions (what it counts is exact then).
Combinations with such items are grown level by level by joins over pages: only
those go on that are frequent, no rule, and have fewer good pages than each
combination inside them (one that excludes no page more can't be a smallest
rule).  Both together are all the rules, whatever ``max_items`` is.

Cases: a null URL or one without ``://`` has an empty host and path, fits no
given rule, and has no tokens if null; labels that say nothing, of no page or
with a null id do not count; a page is bad if any of its labels says so; without
rules everything is allowed; an empty table gives no rows; pages that repeat are
rows of their own; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mktpanel.llm.common import discard, materialize

# (verdict, host, path): a host stands for itself and its subdomains.
GIVEN = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_SUPPORT = 0.001
MIN_COUNT = 10
MIN_CONFIDENCE = 0.6
MAX_ITEMS = 20
BAD = -1          # the class as an item; other items are numbered from 0


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    """The host in lower case; empty for null and where ``://`` is missing."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """The path with its leading slash; empty if there is none."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def given_rule(host: Column, path: Column, rules=GIVEN) -> tuple[Column, Column]:
    """(rule, verdict) of the longest given rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for said, name, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(name + start)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """The set of tokens of a URL; empty for null."""
    lower = F.translate(url, UPPER, LOWER)
    host, path = host_of(url), F.translate(path_of(url), UPPER, LOWER)
    mark = lambda kind, items: F.transform(F.filter(items, lambda x: x != ""), lambda x: F.concat(F.lit(kind + ":"), x))
    labels = F.transform(F.reverse(F.split(host, r"\.")),
                         lambda x, i: F.when(x != "", F.concat(F.lit("label"), i.cast("string"), F.lit(":"), x)))
    folders = F.split(F.regexp_extract(path, r"(?s)^(.*)/[^/]*\z", 1), "/")
    query = F.regexp_extract(lower, r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0))
    single = F.array(F.concat(F.lit("scheme:"), F.regexp_extract(lower, "(?s)^(.*?)://", 1)), F.concat(F.lit("host:"), host),
                     F.concat(F.lit("ending:"), F.regexp_extract(path, r"(\.[^./]*)\z", 1)),
                     F.when(F.contains(lower, F.lit("#")), F.lit("fragment")).otherwise(F.lit("no fragment")))
    found = F.array_distinct(F.concat(single, F.filter(labels, lambda x: x.isNotNull()), mark("folder", folders), mark("key", keys)))
    return F.when(url.isNotNull(), found).otherwise(F.array().cast("array<string>"))


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, bad, tokens) of every labelled page: bad if a label gives low quality or toxic content."""
    said = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = F.col("quality").isNotNull() | F.col("toxic").isNotNull()
    bad = labels.filter(known).groupBy(F.col("doc_id").alias("id")).agg(F.max(said).alias("bad"))
    urls = pages.select(F.col("page_id").alias("id"), "url").filter("id is not null and url is not null").distinct()
    return urls.join(bad, "id").select(F.xxhash64("id", "url").alias("id"), "bad", tokens(F.col("url")).alias("tokens"))


def mine(pages: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT,
         min_confidence: float = MIN_CONFIDENCE, max_items: int = MAX_ITEMS) -> tuple[DataFrame, DataFrame]:
    """(rule, items, rarest, support, confidence) and the (token, item) table, from ``labelled`` pages."""
    spark = pages.sparkSession
    rules_schema = "rule long, items array<long>, rarest long, support double, confidence double"
    none = spark.createDataFrame([], rules_schema), spark.createDataFrame([], "token string, item long")
    pages = materialize(pages, "labelled")
    n = pages.count()
    least = max(min_count, math.ceil(n * min_support))
    occurs = pages.select("id", "bad", F.explode("tokens").alias("token"))
    # A token's pages as a fingerprint: equal for tokens of exactly the same pages.
    mark = F.sum(F.xxhash64("id").cast("decimal(38,0)"))
    seen = occurs.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("n_bad"), mark.alias("a"),
                                       F.sum(F.xxhash64(F.lit(1), "id").cast("decimal(38,0)")).alias("b"))
    kinds = seen.filter(F.col("n_bad") >= least).groupBy("n", "a", "b").agg(F.sort_array(F.collect_set("token")).alias("tokens"))
    kinds = materialize(kinds.withColumn("item", F.monotonically_increasing_id()), "items")
    if kinds.isEmpty():
        return none
    index = materialize(kinds.select("item", "n", F.explode("tokens").alias("token")), "tokens")
    held = occurs.join(index, "token").groupBy("id", "bad").agg(F.sort_array(F.collect_set(F.struct("n", "item"))).alias("held"))
    held = materialize(held.select("id", "bad", F.transform("held", lambda x: x["item"]).alias("items")), "held")
    wide = held.filter(F.size("items") > max_items)
    over = materialize(wide.select(F.explode(F.slice("items", max_items + 1, F.size("items"))).alias("item")).distinct(), "over")
    if over.isEmpty():
        found = _fp_growth(held, least, min_confidence, n)
    else:
        core = held.select("id", "bad", F.explode("items").alias("item")).join(over, "item", "left_anti")
        core = core.groupBy("id", "bad").agg(F.collect_list("item").alias("items"))
        found = _fp_growth(core, least, min_confidence, n).unionByName(_by_levels(
            held, over, least, min_confidence, n, pages.filter("not bad").count()))
    found = materialize(found.withColumn("rule", F.monotonically_increasing_id()), "rules")
    smaller = found.select(F.col("items").alias("inner_items"), F.explode("items").alias("item"), F.col("rule").alias("inner_rule"))
    larger = found.select(F.col("items").alias("outer_items"), F.explode("items").alias("item"), F.col("rule").alias("rule"))
    spare = larger.join(smaller, "item").filter(
        (F.size("inner_items") < F.size("outer_items")) & (F.size(F.array_except("inner_items", "outer_items")) == 0))
    found = found.join(spare.select("rule").distinct(), "rule", "left_anti")
    sizes = kinds.select("item", "n")
    by = found.select("rule", F.explode("items").alias("item")).join(sizes, "item").groupBy("rule").agg(
        F.min_by("item", F.struct("n", "item")).alias("rarest"))
    rules = materialize(found.join(by, "rule").select("rule", "items", "rarest", "support", "confidence"), "rules")
    return rules, index.select("token", "item")


def _fp_growth(held: DataFrame, least: int, min_confidence: float, n: int) -> DataFrame:
    """(items, support, confidence) of the rules that FP-growth finds in (bad, items) of pages."""
    bad = F.array(F.lit(BAD).cast("long"))
    held = held.select(F.when(F.col("bad"), F.concat("items", bad)).otherwise(F.col("items")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=min_confidence).fit(_filled(held, n))
    return model.associationRules.filter(F.col("consequent")[0] == BAD).select(
        F.sort_array("antecedent").alias("items"), "support", "confidence")


def _filled(held: DataFrame, n: int) -> DataFrame:
    """Pages without a frequent item count as well: FP-growth's support is a share of all transactions."""
    missing = n - held.count()
    return held if not missing else held.unionByName(
        held.sparkSession.range(missing).select(F.array().cast("array<long>").alias("items")))


def _by_levels(held: DataFrame, over: DataFrame, least: int, min_confidence: float, n: int, n_good: int) -> DataFrame:
    """(items, support, confidence) of rules with an item of ``over``: all the smallest, and some that hold a smaller rule without one.

    A combination is an ascending array; items of ``over`` are negative in it
    (-1 - item), so it has one if its first is.  Each is reached once, from
    itself without its last item, and only pages that hold it are joined.
    """
    bad, good = F.sum("n_bad").alias("n_bad"), F.sum("n_good").alias("n_good")
    is_rule = F.col("n_bad") / (F.col("n_bad") + F.col("n_good")) >= min_confidence
    pages = held.groupBy("items").agg(F.count_if("bad").alias("n_bad"), F.count_if(~F.col("bad")).alias("n_good"))
    pages = materialize(pages.withColumn("page", F.monotonically_increasing_id()), "pages")
    at = F.when(F.col("over"), -1 - F.col("item")).otherwise(F.col("item")).alias("at")
    parts = pages.select("page", "n_bad", "n_good", F.explode("items").alias("item")).join(
        over.withColumn("over", F.lit(True)), "item", "left").select("page", "n_bad", "n_good", at)
    alone = materialize(parts.groupBy("at").agg(bad, good), "alone")
    # A rule of one item is in no other smallest rule.
    parts = materialize(parts.join(alone.filter(~is_rule).select("at"), "at"), "parts")
    first = alone.filter("at < 0").select(F.col("at").alias("set"), F.array("at").alias("items"), "n_bad", "n_good")
    rules = first.filter(is_rule)
    sets = first.filter(~is_rule & (F.col("n_good") < n_good))
    cover = materialize(parts.join(sets.select("set"), F.col("at") == F.col("set")).select("set", "page", F.col("at").alias("last")), "cover")
    while not cover.isEmpty():
        longer = cover.join(parts, "page").filter(F.col("at") > F.col("last")).groupBy("set", "at").agg(bad, good)
        longer = longer.filter(F.col("n_bad") >= least).join(sets.select("set", "items"), "set")
        longer = materialize(longer.select(F.col("set").alias("start"), "at", F.concat("items", F.array("at")).alias("items"), "n_bad", "n_good")
                             .withColumn("set", F.monotonically_increasing_id()), "sets")
        places = longer.select("set", F.col("n_good").alias("now"), "items", F.explode(F.sequence(F.lit(1), F.size("items"))).alias("i"))
        inside = places.select("set", "now", F.concat(F.slice("items", F.lit(1), F.col("i") - 1),
                                                      F.slice("items", F.col("i") + 1, F.size("items"))).alias("items"))
        # Combinations without an item of ``over`` are FP-growth's, and not known here.
        met = inside.filter(F.col("items")[0] < 0).join(sets.select("items", "n_good"), "items", "left")
        kept = met.groupBy("set").agg(F.bool_and(F.coalesce(F.col("n_good") > F.col("now"), F.lit(False))).alias("kept"))
        longer = materialize(longer.join(kept.filter("kept").select("set"), "set"), "sets")
        rules = rules.unionByName(longer.filter(is_rule).select("set", "items", "n_bad", "n_good"))
        sets, before = longer.filter(~is_rule), cover
        ways = cover.join(sets.select(F.col("set").alias("next"), F.col("start").alias("set"), "at"), "set")
        cover = materialize(ways.join(parts, ["page", "at"]).select(F.col("next").alias("set"), "page", F.col("at").alias("last")), "cover")
        discard(before)
    items = F.sort_array(F.transform("items", lambda x: F.when(x < 0, -1 - x).otherwise(x)))
    return rules.select(items.alias("items"), (F.col("n_bad") / n).alias("support"),
                        (F.col("n_bad") / (F.col("n_bad") + F.col("n_good"))).alias("confidence"))


def fitting(urls: DataFrame, rules: DataFrame, index: DataFrame) -> DataFrame:
    """The distinct ``url`` that a rule fits."""
    parts = urls.select("url").filter("url is not null").distinct().select("url", F.explode(tokens(F.col("url"))).alias("token"))
    items = parts.join(index, "token").groupBy("url").agg(F.collect_set("item").alias("has"))
    listed = rules.select(F.col("rarest").alias("item"), "items")
    met = items.select("url", "has", F.explode("has").alias("item")).join(listed, "item")
    return met.filter(F.size(F.array_except("items", "has")) == 0).select("url").distinct()


def judge(pages: DataFrame, labels: DataFrame, given=GIVEN, **limits) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict) of all pages; ``limits`` are those of ``mine``."""
    rules, index = mine(labelled(pages, labels), **limits)
    url = F.col("url")
    host, path = host_of(url), path_of(url)
    rule, said = given_rule(F.col("host"), F.col("path"), given)
    rows = pages.select(F.col("page_id"), url, host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", rule).withColumn("said", said)
    hits = fitting(rows.filter("rule is null"), rules, index).withColumn("hit", F.lit(True))
    rows = rows.join(hits, "url", "left")
    learned = F.when(F.col("hit"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("page_id", "host", "path", "rule", F.coalesce("said", learned).alias("verdict"))

