"""Accuracy report (P7): predicted labels scored against realised weekly classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktpanel.functions.labels import predicted_label
from mktpanel.operators.aggregates import evaluate, with_macro_average
from mktpanel.operators.joins import pair_predictions


def prediction_pairs(weeks: DataFrame, answers: DataFrame, align: str = "position",
                     strict: bool = False, symbols: DataFrame | None = None) -> DataFrame:
    """(symbol, week_idx, true_label, pred_label) for symbols with both truth and answers."""
    truth = weeks.select("symbol", "week_idx", F.col("bin_label").alias("true_label"))
    pred = answers.select("symbol", "week_idx", predicted_label("answer", strict=strict).alias("pred_label"))
    if symbols is not None:
        keep = symbols.select("symbol").distinct()
        truth = truth.join(keep, "symbol", "left_semi")
        pred = pred.join(keep, "symbol", "left_semi")
    return pair_predictions(truth, pred, align)


def evaluation_report(weeks: DataFrame, answers: DataFrame, align: str = "position",
                      strict: bool = False, symbols: DataFrame | None = None) -> DataFrame:
    """Per-symbol accuracy rows plus their macro average.

    ``align="position"`` reproduces pairing by row position (shifted by the
    warm-up weeks); ``align="key"`` pairs each answer with its own week.
    """
    return with_macro_average(evaluate(prediction_pairs(weeks, answers, align, strict, symbols)))


def skipped_symbols(weeks: DataFrame, answers: DataFrame, symbols: DataFrame | None = None) -> DataFrame:
    """Symbols that leave no row in the report, and why: ``(symbol, reason)``.

    ``symbols`` are those that were wanted (default: all that occur on a side).
    """
    truth = weeks.select("symbol").distinct().withColumn("_weeks", F.lit(True))
    pred = answers.select("symbol").distinct().withColumn("_answers", F.lit(True))
    both = truth.join(pred, "symbol", "full")
    if symbols is not None:
        both = symbols.select("symbol").distinct().join(both, "symbol", "left")
    reason = (F.when(F.col("_weeks").isNull() & F.col("_answers").isNull(), F.lit("no weeks and no answers"))
               .when(F.col("_weeks").isNull(), F.lit("no weeks")).when(F.col("_answers").isNull(), F.lit("no answers")))
    return both.select("symbol", reason.alias("reason")).where(F.col("reason").isNotNull())
