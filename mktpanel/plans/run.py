"""A whole run (P10): universe -> panel -> prompts -> answers -> dataset.

Every stage boundary is a table written under ``base_dir`` (a shared folder),
which cuts lineage and makes the run resumable: symbols whose panel exists
are not rebuilt, prompts with an answer are not regenerated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from mktpanel.functions import fixed
from mktpanel.plans.dataset import create_dataset, training_rows
from mktpanel.plans.generate import GeneratorFactory, generate_answers
from mktpanel.plans.panel import Panel, build_panel
from mktpanel.plans.prompts import build_prompts
from mktpanel.session import materialize
from mktpanel.sources import readers as R
from mktpanel.sources.answer_log import SLOTS, AnswerLog
from mktpanel.sources.universe import universe


def _exists(spark: SparkSession, path: str, schema: str) -> bool:
    """True when a table has been written at ``path`` (possibly empty)."""
    try:
        spark.read.schema(schema).parquet(path).schema
        return True
    except AnalysisException:
        return False


def run_all(spark: SparkSession, prices: DataFrame, news: DataFrame, basics_long: DataFrame,
            profiles: DataFrame, members: DataFrame, base_dir: str, factory: GeneratorFactory,
            index_name: str = "dow", start_date: str | None = None, end_date: str | None = None,
            min_weeks: int = fixed.DEFAULT_MIN_WEEKS, max_weeks: int = fixed.DEFAULT_MAX_WEEKS,
            train_ratio: float = fixed.DEFAULT_TRAIN_RATIO, partitions: int | None = None,
            answer_batches: int = SLOTS) -> DataFrame:
    """Run every stage for one index and date range; returns the dataset as written.

    ``partitions``: number of generator tasks (see ``generate_answers``);
    ``answer_batches``: how many batches answers are committed in (fixed when the
    answer log is started).
    """
    members_u = universe(members, index_name)          # raises on a bad index name
    with_basics = index_name != "crypto"
    label = fixed.INDEX_LABELS[index_name]
    tag = f"{label}_{start_date or 'all'}_{end_date or 'all'}" + ("" if with_basics else "_nobasics")
    panel_dir = f"{base_dir.rstrip('/')}/{tag}/panel"
    answers_dir = f"{base_dir.rstrip('/')}/{tag}/answers"

    # 1. acquire panels for symbols not yet written (S12).  A symbol is done when its weeks are there,
    # and these are written last; a pending symbol's partitions are replaced, so what a stopped run
    # left of its news is not doubled.
    syms = members_u.select("symbol")
    if _exists(spark, f"{panel_dir}/weeks", R.PANEL_WEEKS_SCHEMA):
        done, _ = R.read_panel(spark, panel_dir)
        syms = R.pending_symbols(syms, done)
    syms = materialize(syms, "pending-symbols")   # its source is written to below
    p = prices.join(syms, "symbol", "left_semi")
    if start_date:
        p = p.where(F.col("date") >= F.lit(start_date).cast("date"))
    if end_date:
        p = p.where(F.col("date") < F.lit(end_date).cast("date"))
    n = news.join(syms, "symbol", "left_semi")
    b = basics_long.join(syms, "symbol", "left_semi") if with_basics else None
    fresh = build_panel(p, n, b, with_basics=with_basics)
    R.replace_symbols(fresh.news, f"{panel_dir}/news")
    R.replace_symbols(fresh.weeks, f"{panel_dir}/weeks")
    weeks, wnews = R.read_panel(spark, panel_dir)
    panel = Panel(weeks, wnews)

    # 2. prompts and answers for prompts not yet answered (J8, S9), batch by batch: a killed run keeps
    # its finished batches, and runs at once leave one answer each
    prompts = build_prompts(panel, profiles, members, min_weeks, max_weeks)
    log = AnswerLog(spark, answers_dir, answer_batches)
    log.append(prompts, lambda some, old: generate_answers(some, old, factory, partitions))
    answers = log.read()

    # 3. training rows and split
    rows = training_rows(answers, weeks, members).rows
    dataset = create_dataset(rows, train_ratio)
    out = R.dataset_path(base_dir, label, start_date or "all", end_date or "all", min_weeks, max_weeks, train_ratio)
    R.write_dataset(dataset, out)
    return R.read_dataset(spark, out).select("prompt", "answer", "period", "label", "symbol", "split", "week_idx")
