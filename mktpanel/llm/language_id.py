"""Multilingual language identification by mixture inference.

Training counts hashed character trigrams of all training documents per
language; the counts are summed by Spark and become smoothed likelihoods.  A
document is a mixture: expectation-maximisation estimates the share of each
language from its trigrams' likelihoods, and languages leave the mixture, the
weakest first, as long as the likelihood lost is less than the penalty of a
parameter.  The prediction is the language with the largest share.

The model has languages x ``BUCKETS`` numbers, and ``train`` refuses more than
``MAX_LANGUAGES``, so what is sent to the workers is bounded.

Cases: a text that is null or has no letter is ``und`` with score 0; without
training rows every text is; ties go to the first language by code point; a
null language is not learnt; a null id is never held out and not learnt;
repeated rows get equal results; a text of any length is one mixture over its
whole trigram counts;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mktpanel.llm.common import materialize

BUCKETS = 1 << 15
MAX_LANGUAGES = 256
FOLDS = 5
SMOOTHING = 0.5
ROUNDS = 12
# Log-likelihood that one more language must bring, per logarithm of the number of trigrams.
PENALTY = 8.0
PIECE = 1 << 18
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_NOT_LETTERS = regex.compile(r"[^\p{L}]+")


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def _letters(text: str) -> str:
    """The lower-cased words, each between blanks."""
    return f" {_NOT_LETTERS.sub(' ', text.lower())} "


def _buckets(letters: str) -> np.ndarray:
    codes = np.frombuffer(letters.encode("utf-32-le", "replace"), np.uint32)
    mixed = (codes[:-2] * np.uint32(0x9E3779B1)) ^ (codes[1:-1] * np.uint32(0x85EBCA77)) ^ (codes[2:] * np.uint32(0xC2B2AE3D))
    mixed ^= mixed >> np.uint32(15)
    return ((mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(17)).astype(np.int64) & (BUCKETS - 1)


def trigram_counts(text: str, piece: int = PIECE) -> np.ndarray:
    """How often each bucket of character trigrams occurs in the whole text.

    A long text is hashed ``piece`` trigrams at a time to bound the memory of
    their codes; pieces overlap by two characters, so the counts are those of
    the text in one go.
    """
    letters = _letters(text)
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(letters) - 2, piece):
        counts += np.bincount(_buckets(letters[at:at + piece + 2]), minlength=BUCKETS)
    return counts


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all of ``docs`` (lang, text): counts per task, then summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if lang not in sums:
                        sums[lang] = np.zeros(BUCKETS, np.int64)
                    sums[lang] += trigram_counts(text)
            if len(sums) > MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                              pa.array(n[at])], ["lang", "gram", "n"])

    rows = docs.filter("lang is not null and text is not null").select(F.col("lang").cast("string"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, probabilities as BUCKETS x languages) from rows (lang, text)."""
    counts = materialize(gram_counts(docs), "gram-counts")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.full((BUCKETS, len(langs)), SMOOTHING)
    at = {lang: i for i, lang in enumerate(langs)}
    for batch in counts.toArrow().to_batches():
        cols = [at[x] for x in batch.column(0).to_pylist()]
        table[batch.column(1).to_numpy(), cols] += batch.column(2).to_numpy()
    return langs, (table / table.sum(axis=0, keepdims=True)).astype(np.float32)


def _fit(p: np.ndarray, n: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Shares after some steps of expectation-maximisation, and their log-likelihood; ``n``: how often each row of ``p`` occurs."""
    for _ in range(rounds):
        weight = n / (p @ share)
        share = share * (weight @ p)
        share = share / share.sum()
    return share, float(n @ np.log(p @ share))


def mixture(counts: np.ndarray, probs: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Share of every language in a text with these trigram counts, 0 for those outside the chosen set."""
    grams = np.flatnonzero(counts)
    n, p = counts[grams].astype(float), probs[grams].astype(float)
    price = penalty * np.log(max(n.sum(), 2))
    share, best = _fit(p, n, np.full(p.shape[1], 1.0 / p.shape[1]), ROUNDS)
    keep = np.arange(p.shape[1])
    while len(keep) > 1:
        weakest = int(np.argmin(share))
        rest = np.delete(np.arange(len(keep)), weakest)
        start = np.maximum(share[rest], 1e-6)
        q = p[:, rest]
        less, value = _fit(q, n, start / start.sum(), ROUNDS // 3 if len(rest) > 1 else 0)
        if best - value > price:
            break
        p, keep, share, best = q, keep[rest], less, value
    out = np.zeros(probs.shape[1])
    out[keep] = share
    return out


def predict(docs: DataFrame, langs: list[str], probs: np.ndarray, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, n_langs) of every document."""
    model = docs.sparkSession.sparkContext.broadcast(probs)

    def one(text: str | None) -> tuple[str, float, int]:
        if not langs or text is None or not _LETTER.search(text):
            return UNKNOWN, 0.0, 0
        shares = mixture(trigram_counts(text), model.value)
        top = int(np.argmax(shares))
        return langs[top], float(min(1.0, shares[top])), int((shares > 0).sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(t) for t in batch.column(1).to_pylist()]
            lang, score, n = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(n, pa.int32())], ["id", "lang_pred", "score", "n_langs"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string"))
                .mapInArrow(run, "id long, lang_pred string, score double, n_langs int")
                .withColumnRenamed("id", id_col))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_langs): learnt from the documents that are not held out."""
    learnt = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text")
    langs, probs = train(learnt)
    return predict(docs, langs, probs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                                              "n_langs")
