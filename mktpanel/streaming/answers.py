"""Incremental answer generation with Structured Streaming (P4 resume, S9).

Prompt files landing in a folder are answered once: the stream checkpoint
records which files were consumed, and every micro-batch also anti-joins
its prompts against the answers already written, so a batch that is
replayed after a failure appends nothing twice.  With
``trigger(availableNow=True)`` the query drains what has landed and stops,
which is the streaming form of re-running the batch job after a crash.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from mktpanel.plans.generate import GeneratorFactory, generate_answers
from mktpanel.sources import readers as R

PROMPT_SCHEMA = ("symbol string, week_idx int, start_date date, end_date date, "
                 "asset_class string, prompt string")


def _answered(spark: SparkSession, answers_dir: str) -> DataFrame | None:
    try:
        return R.read_answers(spark, answers_dir).select("symbol", "week_idx")
    except AnalysisException:
        return None


def answer_stream(spark: SparkSession, prompts_dir: str, answers_dir: str, checkpoint_dir: str,
                  factory: GeneratorFactory, available_now: bool = True,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start a stream that answers every prompt file landing in ``prompts_dir``.

    Returns the running query; with ``available_now`` it stops once every
    landed file is processed (call ``awaitTermination()``).
    """
    reader = spark.readStream.schema(PROMPT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    prompts = reader.parquet(prompts_dir)

    def process(batch: DataFrame, epoch_id: int) -> None:
        new = generate_answers(batch, _answered(batch.sparkSession, answers_dir), factory)
        R.append_answers(new, answers_dir)

    w = prompts.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
