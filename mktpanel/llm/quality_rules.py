"""Quality rules: base limits and a learned decision list, all as column expressions.

``text_stats`` derives per-document statistics from whole texts, ``learn``
grows an ordered list of threshold conjunctions by sequential covering on
labelled statistics, and ``first_rule`` turns the list into one conditional
column.  No Python runs on the executors.

Learning reads at most about ``SAMPLE_ROWS`` labelled documents (chosen by id
hash); their statistics fit one small partition, and every grow or prune step
sends at most features x thresholds counts to the driver.

Cases: a null or blank text has zero words and fails the base limits; a null
label, or one without a document, is ignored; a document labelled more than
once counts as good if any label says so; without bad labels the list is empty
and only the base limits act; repeated rows get the same verdict; an empty
table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mktpanel.llm.common import materialize, words

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
SYMBOLS = "[#*$%&|<>]"
SAMPLE_ROWS = 10_000
CUTS = 32
MAX_RULES = 8
MAX_CONDITIONS = 4
MIN_PRECISION = 0.95
MIN_SUPPORT = 3

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["symbol_share", "upper_share", "mark_share", "digit_share", "dup_line_share", "repeat_share",
            "distinct_share", "word_length", "n_words"]


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        c = F.col(self.feature).cast("double")
        return c > F.lit(self.cut) if self.above else c <= F.lit(self.cut)


Rule = tuple[Condition, ...]


def _all(conditions: Rule) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.column()
    return out


def _removed(text: Column, pattern: str) -> Column:
    """Number of characters of ``text`` that ``pattern`` takes away."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def text_stats(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs`` with the base counts and the learner's features.

    A repeated window is found by sorting the (hash, position) pairs of a
    text's three-word windows, so a long text costs n log n.
    """
    one = docs.select(F.struct(*keep).alias("__row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__t"))
    two = one.select("__row", "__t", words(F.col("__t")).alias("__w"),
                     F.filter(F.split("__t", "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\f\r"))) > 0)
                     .alias("__l"))
    n = F.size("__w")
    windows = F.when(n >= 4, F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.struct(
        F.xxhash64(F.element_at("__w", i), F.element_at("__w", i + 1), F.element_at("__w", i + 2)).alias("h"),
        i.alias("p"))))
    three = two.select(
        "__row", "__t", n.cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.size(F.array_distinct("__w")).alias("__distinct"),
        F.size("__l").alias("__lines"), F.size(F.array_distinct("__l")).alias("__own_lines"),
        F.sort_array(windows).alias("__s"))
    s = F.col("__s")

    def twice(x: Column, i: Column) -> Column:
        before = F.get(s, i - 1)["h"]
        after = F.get(s, i + 1)["h"]
        return (F.coalesce(before == x["h"], F.lit(False))) | (F.coalesce(after == x["h"], F.lit(False)))

    four = three.withColumn("__p", F.sort_array(F.transform(F.filter(s, twice), lambda x: x["p"]))).drop("__s")
    p = F.col("__p")
    covered = F.when(F.size(p) > 1, F.lit(3) + F.aggregate(
        F.sequence(F.lit(2), F.size(p)), F.lit(0),
        lambda acc, i: acc + F.least(F.lit(3), F.element_at(p, i) - F.element_at(p, i - 1)))).otherwise(0)
    five = four.select(
        "__row", "n_words", "word_chars", _removed(F.col("__t"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.col("__lines") - F.col("__own_lines")).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        _removed(F.col("__t"), r"\p{Lu}+").alias("__upper"), _removed(F.col("__t"), "[!?]+").alias("__marks"),
        _removed(F.col("__t"), r"\p{Nd}+").alias("__digits"), "__lines", "__distinct")
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return five.select(
        "__row.*", *BASE,
        (F.col("n_symbols") / chars).alias("symbol_share"), (F.col("__upper") / chars).alias("upper_share"),
        (F.col("__marks") / chars).alias("mark_share"), (F.col("__digits") / chars).alias("digit_share"),
        (F.col("n_dup_lines") / F.greatest(F.col("__lines"), F.lit(1))).alias("dup_line_share"),
        (F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1))).alias("repeat_share"),
        (F.col("__distinct") / F.greatest(F.col("n_words"), F.lit(1))).alias("distinct_share"),
        (F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))).alias("word_length"),
        F.monotonically_increasing_id().alias("__fence"))


def where(stats: DataFrame, condition: Column) -> DataFrame:
    """Rows of ``text_stats`` that meet ``condition``.

    A plain filter would be pushed below the projections and repeat their
    expressions, nested, for every use; it stays above one that is not
    deterministic and that it refers to.
    """
    return stats.filter(condition & (F.col("__fence") >= 0)).drop("__fence")


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PCT) * F.col("n_words")))


# ---------------------------------------------------------------- learning


def labelled_stats(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Statistics of a bounded sample of labelled documents with ``bad`` and ``prune`` (a third, by id hash)."""
    known = (labels.filter("doc_id is not null and quality is not null").groupBy("doc_id")
                   .agg((F.max("quality") == 0).alias("bad")).select(F.col("doc_id").alias("__id"), "bad"))
    n = known.count()
    if n > sample_rows:
        known = known.filter(F.pmod(F.xxhash64(F.lit("sample"), "__id"), F.lit(1 << 20))
                             < int(sample_rows / n * (1 << 20)))
    # At most about sample_rows narrow rows: the bound makes the broadcast safe.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("__id"))
    stats = text_stats(rows.select("__id", "bad", "text"), ["__id", "bad"])
    stats = where(stats, ~base_failed()).withColumn("prune", F.pmod(F.xxhash64(F.lit("fold"), "__id"), F.lit(3)) == 0)
    # One partition: the rows are bounded, and the many small counts below then need no exchange.
    return materialize(stats.select("bad", "prune", *FEATURES), "labelled-stats").coalesce(1)


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """Candidate thresholds of each feature: quantiles of the good and of the bad rows."""
    at = [i / CUTS for i in range(1, CUTS)]
    got = rows.groupBy("bad").agg(*[F.percentile_approx(F.col(f).cast("double"), at, 10_000).alias(f)
                                    for f in FEATURES]).collect()
    out = {}
    for f in FEATURES:
        values = sorted({c for r in got for c in (r[f] or [])})
        # Also half way between neighbours, where a rule stands clear of both classes.
        out[f] = sorted({*values, *((a + b) / 2 for a, b in zip(values, values[1:]))})
    return out


def _cuts_below(cuts: list[float], value: Column) -> Column:
    marks = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<double>")
    return F.size(F.filter(marks, lambda c: c < value.cast("double")))


def _counts(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[tuple[int, int, bool], int]:
    """(feature, number of cuts below the value, bad) -> rows."""
    bins = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), _cuts_below(cuts[f], F.col(f)).alias("b"))
                               for i, f in enumerate(FEATURES)]))
    got = rows.select("bad", bins.alias("x")).groupBy("x.f", "x.b", "bad").count().collect()
    return {(r["f"], r["b"], r["bad"]): r["count"] for r in got}


def _information(p: float, n: float) -> float:
    from math import log2
    return log2(p / (p + n)) if p else -99.0


def _best(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[Condition, int, int] | None:
    """The condition of largest first-order gain with the bad and good rows that it keeps."""
    counts = _counts(rows, cuts)
    p0 = sum(v for (f, _, bad), v in counts.items() if f == 0 and bad)
    n0 = sum(v for (f, _, bad), v in counts.items() if f == 0 and not bad)
    best, top = None, 1e-9
    for i, f in enumerate(FEATURES):
        p = n = 0
        for k, cut in enumerate(cuts[f]):
            p += counts.get((i, k, True), 0)
            n += counts.get((i, k, False), 0)
            for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                gain = pp * (_information(pp, nn) - _information(p0, n0)) if pp else 0
                # Of equal gains the narrowest condition: the largest cut of a lower bound, the smallest of an upper one.
                if gain > top or (above and gain == top and best and best[0].above and best[0].feature == f):
                    best, top = (Condition(f, above, cut), pp, nn), gain
    return best


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS:
        found = _best(rows.filter(_all(tuple(rule))), cuts)
        if not found:
            break
        rule.append(found[0])
        if found[2] == 0:
            break
    return tuple(rule)


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The prefix of ``rule`` with the best (p - n) / (p + n) on the pruning rows, and its p and n."""
    sums = [F.sum(F.when(_all(rule[:k]) & (F.col("bad") == want), 1).otherwise(0))
            for k in range(1, len(rule) + 1) for want in (True, False)]
    got = [v or 0 for v in rows.agg(*sums).first()]
    scored = [((p - n) / (p + n) if p + n else -1.0, -k, p, n)
              for k, (p, n) in enumerate(zip(got[::2], got[1::2], strict=True), 1)]
    _, k, p, n = max(scored)
    return rule[:-k], p, n


def learn(rows: DataFrame) -> list[Rule]:
    """Ordered rules that reject; each covers bad rows that earlier rules leave.

    ``rows``: the features with ``bad`` and ``prune``.  A rule stays if, on the
    pruning rows, it covers ``MIN_SUPPORT`` bad rows at ``MIN_PRECISION``.
    """
    rules: list[Rule] = []
    cuts = _cuts(rows)
    left = rows
    while len(rules) < MAX_RULES:
        grown = _grow(left.filter(~F.col("prune")), cuts)
        if not grown:
            break
        rule, p, n = _prune(left.filter("prune"), grown)
        if p < MIN_SUPPORT or p < MIN_PRECISION * (p + n):
            break
        rules.append(rule)
        left = left.filter(~_all(rule))
    return rules


def first_rule(rules: list[Rule]) -> Column:
    """Number (from 1) of the first rule that holds, null where none does."""
    out = F.lit(None).cast("int")
    for i in range(len(rules), 0, -1):
        out = F.when(_all(rules[i - 1]), F.lit(i)).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` of every document with base counts, features, ``base_failed``, ``rule`` and ``kept``."""
    rules = learn(labelled_stats(docs, labels))
    stats = text_stats(docs, keep).withColumn("base_failed", base_failed()).withColumn("rule", first_rule(rules))
    return stats.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, in their own columns."""
    judged = judge(docs.select(F.struct(*docs.columns).alias("__doc"), F.col("doc_id"), F.col("text")), labels, ["__doc"])
    return where(judged, F.col("kept")).select("__doc.*")
