"""Resumable batch generation.

The text generator is user code: a factory called once per partition (load
the model there) that returns a function from a pandas batch to generated
texts.  It runs through ``mapInPandas`` on Arrow batches.  A failing batch is
asked again in ever smaller parts, down to single rows at the last of
``max_attempts``; a row that still fails, has no prompt or gets anything but
text has the answer ``''`` and an error that says which, so one bad prompt
never fails the task and a failure is told from an empty answer.  Only prompts
without an answer are sent (left-anti join on the key), so a second run over
the same answers generates nothing.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mktpanel.functions import fixed
from mktpanel.functions import text as T
from mktpanel.operators.joins import pending_prompts

# batch(symbol, week_idx, full_prompt) -> generated texts (prompt echoed first, as
# text-generation pipelines return it).
BatchFn = Callable[[pd.DataFrame], "pd.Series | list"]


@dataclass(frozen=True)
class GenerationOptions:
    """What a generator is asked for: at most so many new tokens, and the same text for the same prompt unless sampled."""
    max_new_tokens: int = fixed.MAX_NEW_TOKENS
    do_sample: bool = False


# Called with the options if it takes an argument.
GeneratorFactory = Callable[..., BatchFn]

# A row's error if it has one: no prompt was there, no text came back, or the class of what was raised.
NO_PROMPT, NO_TEXT, WRONG_LENGTH = "no prompt", "no text", "wrong length"
MAX_ATTEMPTS = 4

KEPT = {"prompt": "string", "tail": "string", "attempts": "int", "error": "string"}


def _make(factory: GeneratorFactory, options: GenerationOptions) -> BatchFn:
    return factory(options) if inspect.signature(factory).parameters else factory()


def _run(factory: GeneratorFactory, options: GenerationOptions, max_attempts: int, keep: list[str],
         batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Call the generator per Arrow batch; return the kept fields.

    Only keys and the full prompt enter Python; only keys, the text after the
    prompt and what else is kept leave it.
    """
    fn = _make(factory, options)
    for pdf in batches:
        full = pdf["full_prompt"].tolist()
        asked = [i for i, f in enumerate(full) if isinstance(f, str)]
        out: list = [(None, 0, NO_PROMPT)] * len(full)
        feed = pdf[["symbol", "week_idx", "full_prompt"]].iloc[asked]
        for i, got in zip(asked, _outcomes(fn, feed, max_attempts), strict=True):
            out[i] = got
        fields = {
            "prompt": lambda: [f[int(s):] if isinstance(f, str) else None for f, s in zip(full, pdf["prompt_start"].tolist(), strict=True)],
            # text after the full prompt, as the model echoes the prompt first
            "tail": lambda: [g[len(f):] if isinstance(g, str) else None for (g, _, _), f in zip(out, full, strict=True)],
            "attempts": lambda: [n for _, n, _ in out],
            "error": lambda: [e for _, _, e in out],
        }
        yield pd.DataFrame({"symbol": pdf["symbol"].values, "week_idx": pdf["week_idx"].values} | {k: fields[k]() for k in keep})


def _outcomes(fn: BatchFn, feed: pd.DataFrame, max_attempts: int) -> list[tuple]:
    """(text or None, attempts, error or None) per row; the last attempt at a failing row is at it alone."""
    out: list = [None] * len(feed)
    todo = [(0, len(feed))] if len(feed) else []
    for attempt in range(1, max(1, max_attempts) + 1):
        failed = []
        for lo, hi in todo:
            try:
                got, error = list(fn(feed.iloc[lo:hi])), None
                if len(got) != hi - lo:
                    got, error = [None] * (hi - lo), WRONG_LENGTH
            except Exception as e:  # noqa: BLE001 - asked again in smaller parts, then reported
                got, error = [None] * (hi - lo), type(e).__name__
            for i, text in enumerate(got, lo):
                out[i] = (text, attempt, error or (None if isinstance(text, str) else NO_TEXT))
            if error:
                failed.append((lo, hi))
        left = max_attempts - attempt
        if not failed or not left:
            break
        todo = [(at, min(at + size, hi)) for lo, hi in failed
                for size in [1 if left == 1 else max(1, round((hi - lo) ** (1 - 1 / left)))] for at in range(lo, hi, size)]
    return out


def _generated(prompts: DataFrame, answers: DataFrame | None, factory: GeneratorFactory, partitions: int | None,
               options: GenerationOptions, max_attempts: int, keep: list[str]) -> DataFrame:
    todo = prompts if answers is None else pending_prompts(prompts, answers)
    system = T.system_prompt("asset_class")
    todo = todo.select("symbol", "week_idx",
                       (F.length(system) + 2).alias("prompt_start"),
                       F.concat(system, F.lit("\n\n"), F.col("prompt")).alias("full_prompt"))
    n = partitions or int(prompts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    todo = todo.repartition(n, "symbol", "week_idx")
    schema = ", ".join(["symbol string", "week_idx int", *[f"{k} {KEPT[k]}" for k in keep]])
    gen = todo.mapInPandas(lambda it: _run(factory, options, max_attempts, keep, it), schema)
    return gen.withColumn("tail", F.coalesce(T.py_strip("tail"), F.lit(""))).withColumnRenamed("tail", "answer")


def generate_answers(prompts: DataFrame, answers: DataFrame | None, factory: GeneratorFactory,
                     partitions: int | None = None, options: GenerationOptions = GenerationOptions(),
                     max_attempts: int = MAX_ATTEMPTS, keep_prompt: bool = True) -> DataFrame:
    """New answers for pending prompts (P4): ``(symbol, week_idx, prompt, answer)``.

    ``prompts`` needs ``symbol, week_idx, asset_class, prompt``.  The full
    prompt is the system prompt for the asset class, a blank line, then the
    prompt; the answer is the generated text after it, stripped (C18), and a
    failed call gives ``''``.  Prompts are dealt to ``partitions`` generator tasks by
    key (default: the session's shuffle partitions), so a hot symbol does not
    limit how many run at once.  ``keep_prompt=False`` leaves the prompt out,
    for readers of the answer alone: it does not come back out of Python then.
    """
    keep = ["prompt", "tail"] if keep_prompt else ["tail"]
    return _generated(prompts, answers, factory, partitions, options, max_attempts, keep)


def generate_outcomes(prompts: DataFrame, answers: DataFrame | None, factory: GeneratorFactory,
                      partitions: int | None = None, options: GenerationOptions = GenerationOptions(),
                      max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """``generate_answers`` with what became of each row: ``(symbol, week_idx, prompt, answer, attempts, error)``.

    ``error`` is NULL for a row that got text, an empty one too.  The rows with
    an error are the rejects; write the others to the answers, and a later run
    asks for the rejects again.
    """
    return _generated(prompts, answers, factory, partitions, options, max_attempts, list(KEPT))


# ------------------------------------------------------------ test generator
# Canned continuations used by the deterministic test generator; the choice is
# (week_idx * 31 + brand_number * 13) % 8.  None stands for a failed call.
CANNED_ANSWERS = [
    "Expected to rise 1-2% next week",
    "A gain of 3%",
    "The price may decline by 2.5-3%",
    "Shares will drop 7%",
    "It moves against the trend",
    "Prediction: Up by 1-2%",
    "",
    None,
]


def canned_index(symbol: str, week_idx: int) -> int:
    brand = int(symbol[6:]) if symbol[6:].isdigit() else sum(map(ord, symbol))
    return (int(week_idx) * 31 + brand * 13) % len(CANNED_ANSWERS)


def canned_generator() -> BatchFn:
    """Deterministic stand-in for a language model: echoes the prompt, appends a canned answer.

    The canned text goes under an analysis heading so training rows get a
    label injected; the failing choice gives no text, like a crashed call.
    """
    def fn(pdf: pd.DataFrame) -> list:
        out = []
        for s, w, p in zip(pdf["symbol"], pdf["week_idx"], pdf["full_prompt"]):
            a = CANNED_ANSWERS[canned_index(s, w)]
            out.append(None if a is None else p + ("\n\n[Prediction & Analysis]:\n" + a + "\n" if a else "\n"))
        return out
    return fn
