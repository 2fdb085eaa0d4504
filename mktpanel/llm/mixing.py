"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a token budget; whole epochs of it come first, the rest of
the budget is filled in the order of exponential keys -ln(u) / weight, u being
drawn from a hash of the document's id.  The order inside a source is a prefix
sum in two levels: keys are cut into ``BINS`` ranges, range totals are summed
per source, and only the rows of one (source, range) meet in a window, so a
source with a third of all rows spreads over thousands of groups.

Cases: a null text has size 0; a null source is a source of its own, after all
others; a null id is drawn like the text 'null'; repeated rows are separate
documents with one key, taken alike where the cut falls on them; a source of
empty texts has target 0; an empty table gives no rows; other columns are
carried by ``mixed`` and not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mktpanel.llm.common import materialize, word_count

SOURCE_WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
BINS = 4096
SEED = "mix-1"
SYMBOLS = "[#*$%&|<>]"
GOOD_WORDS, BAD_ONE_IN = 50, 20
GOOD_WEIGHT, PLAIN_WEIGHT, BAD_WEIGHT = 2.0, 1.0, 0.5


def quality_weight(text: Column, size: Column) -> Column:
    """Weight of a document: good where it has enough words and no markup signs, bad where signs fill it."""
    text = F.coalesce(text, F.lit(""))
    signs = F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))
    return (F.when((signs == 0) & (size >= GOOD_WORDS), GOOD_WEIGHT)
             .when(signs * BAD_ONE_IN > F.length(text), BAD_WEIGHT).otherwise(PLAIN_WEIGHT))


def _uniform(id_col: Column) -> Column:
    """A number in (0, 1] from the id: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat(F.lit(SEED + "-"), F.coalesce(id_col.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1.0) / float(1 << 52)


def targets(sizes: DataFrame) -> DataFrame:
    """Rows of ``sizes`` (src, source_size) with ``target``: one row per source.

    Water filling in closed form: ordered by limit over weight, the sources up
    to the first that is not full stay at their limit, and the others share
    what is left by weight.  All comparisons are between integers.
    """
    by_name = Window.orderBy(F.col("src.missing"), F.col("src.name"))
    w = F.element_at(F.array(*map(F.lit, SOURCE_WEIGHTS)),
                     (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(SOURCE_WEIGHTS))) + 1).cast("int"))
    rows = sizes.withColumn("w", w.cast("long")).withColumn("cap", F.col("source_size") * MAX_EPOCHS)
    lcm = 6
    fill = Window.orderBy(F.col("cap") * (F.lit(lcm) / F.col("w")).cast("long"), F.col("src.missing"), F.col("src.name"))
    everything = Window.partitionBy()
    rows = (rows.withColumn("k", F.row_number().over(fill))
                .withColumn("capped_before", F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
                .withColumn("w_left", F.sum("w").over(fill.rowsBetween(0, Window.unboundedFollowing)))
                .withColumn("total", F.sum("source_size").over(everything)))
    # Twice the budget that is left, so that 150 % stays an integer.
    rows = rows.withColumn("left2", F.col("total") * int(2 * SHARE) - F.col("capped_before") * 2)
    rows = rows.withColumn("open", F.col("cap") * 2 * F.col("w_left") > F.col("left2") * F.col("w"))
    first_open = F.min(F.when(F.col("open"), F.col("k"))).over(everything)
    rows = rows.withColumn("first_open", first_open)
    level = F.max(F.when(F.col("k") == F.col("first_open"), F.col("left2") / 2.0 / F.col("w_left"))).over(everything)
    target = F.when(F.col("first_open").isNull() | (F.col("k") < F.col("first_open")), F.col("cap").cast("double")) \
              .otherwise(level * F.col("w"))
    return rows.select("src", "source_size", target.alias("target"))


def _drawn(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` in a struct ``__row`` with src, size, key, tie-breaking id and key range of every document."""
    text = F.col("text").cast("string")
    rows = docs.select(F.struct(*keep).alias("__row"), text.alias("__text"), F.col("doc_id").cast("long").alias("__doc"),
                       F.struct(F.col("source").isNull().alias("missing"),
                                F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name")).alias("src"),
                       word_count(text).alias("size"))
    rows = rows.withColumn("key", -F.log(_uniform(F.col("__doc"))) / quality_weight(F.col("__text"), F.col("size")))
    return rows.select("__row", "src", "size", "key", F.coalesce("__doc", F.lit(-(1 << 63))).alias("tie"),
                       F.least(F.lit(BINS - 1), F.floor((1.0 - F.exp(-F.col("key"))) * BINS)).cast("int").alias("bin"))


def budgets(drawn: DataFrame) -> DataFrame:
    """One row per source: src, source_size, target, epochs, cut_bin and cut.

    Documents of a lower key range than ``cut_bin``, and those of it up to
    ``cut`` in (key, id, size), are taken once more than ``epochs``.
    """
    bins = drawn.groupBy("src", "bin").agg(F.sum("size").alias("bin_size"))
    bins = bins.withColumn("before", F.sum("bin_size").over(
        Window.partitionBy("src").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)) - F.col("bin_size"))
    goals = targets(drawn.groupBy("src").agg(F.sum("size").alias("source_size")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goals = goals.withColumn("epochs", epochs).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    # The one range of a source in which its budget ends.
    ends = bins.join(goals.select("src", "rest"), "src").filter(
        "rest > 0 and before <= rest and before + bin_size > rest").select("src", "bin", "before", "rest")
    inside = Window.partitionBy("src", "bin").orderBy("key", "tie", "size")
    upto = F.col("before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    # A document is in if the cut at its end is nearer to the budget than the cut before it.
    chosen = (drawn.select("src", "bin", "key", "tie", "size").join(ends, ["src", "bin"])
                   .withColumn("in", (upto - F.col("size") / 2.0) <= F.col("rest")))
    cuts = chosen.groupBy("src").agg(F.min("bin").alias("cut_bin"),
                                     F.max(F.when(F.col("in"), F.struct("key", "tie", "size"))).alias("cut"))
    return goals.join(cuts, "src", "left").select("src", "source_size", "target", "epochs", "cut_bin", "cut")


def _copies() -> Column:
    """How often a document is taken, from its own columns and its source's."""
    more = (F.col("bin") < F.col("cut_bin")) | ((F.col("bin") == F.col("cut_bin"))
                                                & (F.struct("key", "tie", "size") <= F.col("cut")))
    return F.col("epochs") + F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0)


def taken(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every document."""
    drawn = materialize(_drawn(docs, ["doc_id"]), "mix-draws")
    # Written first, so that Spark knows how small it is: the documents need not be dealt by source.
    limits = materialize(budgets(drawn), "mix-budgets")
    return drawn.join(limits, "src").select("__row.doc_id", "size", "source_size", "target",
                                                    (F.col("size") * _copies()).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix in their own columns, a document taken twice as two rows.

    Texts stay where they are: only sizes and keys are gathered, and every
    document meets its source's few numbers again.
    """
    narrow = materialize(_drawn(docs, ["doc_id"]), "mix-draws")
    limits = materialize(budgets(narrow), "mix-budgets")
    rows = _drawn(docs, docs.columns).join(limits, "src").withColumn("__n", _copies().cast("int"))
    return rows.filter("__n > 0").select("__row", F.explode(F.array_repeat(F.lit(0), F.col("__n")))).select("__row.*")
