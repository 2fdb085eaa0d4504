"""Training rows (P5) and the chronological train/test dataset."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktpanel.functions import fixed
from mktpanel.functions import text as T
from mktpanel.functions.labels import bin_phrase
from mktpanel.operators.filters import usable_answers
from mktpanel.operators.windows import train_cutoffs
from mktpanel.session import materialize
from mktpanel.sources.universe import with_asset_class

DATASET_COLUMNS = ["prompt", "answer", "period", "label", "symbol", "split", "week_idx"]


class TrainingRows(NamedTuple):
    rows: DataFrame      # symbol, week_idx, prompt, answer, period, label
    rejects: DataFrame   # answers whose prompt carries no request sentence (label_source="regex")


def training_rows(answers: DataFrame, weeks: DataFrame | None, members: DataFrame,
                  label_source: str = "panel") -> TrainingRows:
    """Answers -> instruction-formatted training rows (P5).

    Rows with an empty answer are dropped.  ``label_source="panel"`` takes the
    period (``start to end``) and label phrase from the answer's week;
    ``"regex"`` reads them from an old-form request sentence in the prompt
    (rows without one go to ``rejects``).  The request sentence is rewritten,
    the label is put under the analysis heading, and the prompt is wrapped
    with the training system prompt.
    """
    a = usable_answers(answers)
    if label_source == "panel":
        w = weeks.select("symbol", "week_idx", "start_date", "end_date", "bin_label")
        a = a.join(w, ["symbol", "week_idx"])
        a = a.withColumn("period", F.concat(T.iso_date("start_date"), F.lit(" to "), T.iso_date("end_date")))
        a = a.withColumn("label", bin_phrase("bin_label", "v1"))
        rejects = a.where(F.lit(False))
    elif label_source == "regex":
        period, label, matched = T.extract_period_label("prompt")
        a = a.withColumn("period", period).withColumn("label", label).withColumn("_m", matched)
        rejects = a.where(~F.col("_m")).select("symbol", "week_idx", "prompt", "answer")
        a = a.where(F.col("_m"))
    else:
        raise ValueError(f"unknown label_source {label_source!r}")
    # A missing label cannot be capitalised: such rows are skipped.
    a = a.where(F.col("label").isNotNull())
    a = with_asset_class(a, members)
    system = T.training_system_prompt(T.system_prompt("asset_class"))
    prompt = T.inst_wrap(system, T.rewrite_request("prompt", "symbol", "period"))
    rows = a.select("symbol", "week_idx", prompt.alias("prompt"),
                    T.inject_label("answer", "label").alias("answer"), "period", "label")
    return TrainingRows(rows, rejects.select("symbol", "week_idx", "prompt", "answer"))


def create_dataset(rows: DataFrame, train_ratio: float = 0.8) -> DataFrame:
    """Per symbol, the first ``round(ratio * n)`` rows by week are train, the rest test.

    The rows are written once, as answers may come from a generator that must
    not be asked twice.  One cutoff per symbol is found by counting narrow keys
    (``train_cutoffs``), and each row is compared with its symbol's: no text is
    sorted or held by a symbol's window.  Rows of one week are ordered by a
    digest of all columns, so rows that repeat stay on one side.
    """
    written = materialize(rows.withColumn("_row", F.xxhash64(*rows.columns)), "training-rows")
    cutoffs = train_cutoffs(written.select("symbol", "week_idx", "_row"), train_ratio, order=("week_idx", "_row"))
    train = F.coalesce(F.struct("week_idx", "_row") <= F.col("_cut"), F.lit(False))
    return (written.join(cutoffs, "symbol").withColumn("split", F.when(train, F.lit("train")).otherwise(F.lit("test")))
                   .select(*DATASET_COLUMNS))


def old_form_prompts(weeks: DataFrame) -> DataFrame:
    """Prompts in the old request form, one per week: the text ``label_source='regex'`` reads.

    ``(symbol, week_idx, prompt)`` where the prompt is the week header and the
    assume-sentence with the week's period and class phrase.
    """
    period = F.concat(T.iso_date("start_date"), F.lit(" to "), T.iso_date("end_date"))
    sentence = T.fill(fixed.ASSUME_SENTENCE, period=period, phrase=bin_phrase("bin_label", "v1"))
    header = T.week_header("symbol", "start_date", "end_date", "start_price", "end_price", "later")
    return weeks.select("symbol", "week_idx", F.concat(header, F.lit("\n\n"), sentence).alias("prompt"))
