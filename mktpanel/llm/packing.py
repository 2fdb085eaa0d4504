"""Packing of token sequences by shortest-pack-first over the length histogram.

Documents are tokenised where they lie and cut into pieces of at most
``SEQUENCE`` tokens; only a piece's numbers and checksum move on.  The
histogram of piece lengths, at most ``SEQUENCE`` rows, is packed on the
driver: lengths are placed longest first into the packs with most room, and
the result is a list of patterns with counts.  Patterns meet pieces again by
(length, rank); ranks are counted in salted groups, so a length that most
pieces share spreads over many tasks.

Cases: a null or empty text is the end token alone; a long text is cut into
many pieces; repeated rows are packed each; a null id is kept; equal lengths
are ranked by (id, start, checksum); an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mktpanel.llm.common import materialize, releasing, slices
from mktpanel.llm.tokens import encoder, public_file

SEQUENCE = 1024
VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
TEXTS_AT_ONCE = 5000
PIECES_IN_GROUP = 250_000
MIN_SALTS = 64

Pattern = tuple[tuple[int, int], ...]  # runs of (length, pieces of it in each pack)
Slot = tuple[int, int, int, int, int, int]
_PIECE = "id long, start long, length int, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, path: str, end_id: int = END_ID, sequence: int = SEQUENCE, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Rows (id, start, length, ids_crc32, doc_tokens): the cuts of every document."""
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, spaced=True)
        for batch in slices(batches, TEXTS_AT_ONCE):
            rows: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1).to_pylist()), strict=True):
                ids += end
                n = len(ids) // 4
                rows += [(doc, s, min(sequence, n - s), zlib.crc32(ids[4 * s:4 * (s + sequence)]), n)
                         for s in range(0, n, sequence)]
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 ["id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(releasing(run, encoders=True), _PIECE)


def pack_histogram(counts: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[Pattern, int]]:
    """Patterns with counts that place every piece of a length histogram.

    Of the packs that can take a length, those with most room take it first,
    as many pieces each as fit and are there; a pattern met in part is split
    in two, and what is left over opens new packs.
    """
    room: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)
    full: list[tuple[Pattern, int]] = []

    def put(pattern: Pattern, n: int) -> None:
        left = sequence - sum(length * each for length, each in pattern)
        (room[left] if left else full).append((pattern, n))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            widest = max((r for r, packs in room.items() if r >= length and packs), default=sequence)
            pattern, have = room[widest].pop() if room[widest] else ((), max(1, n // (sequence // length)))
            used = min(n, have)
            each = max(1, min(widest // length, n // used))
            if pattern and have > used:
                room[widest].append((pattern, have - used))
            put((*pattern, (length, each)), used)
            n -= used * each
    return full + [p for packs in room.values() for p in packs]


def slots(patterns: list[tuple[Pattern, int]]) -> list[Slot]:
    """(length, first rank, last rank, first sequence, offset, pieces per pack): where lengths and ranks go."""
    out: list[Slot] = []
    given: dict[int, int] = defaultdict(int)
    sequence = 0
    for runs, n in patterns:
        offset = 0
        for length, each in runs:
            out.append((length, given[length], given[length] + n * each - 1, sequence, offset, each))
            given[length] += n * each
            offset += length * each
        sequence += n
    return out


def ranked(cut: DataFrame, total: int) -> DataFrame:
    """``cut`` with ``rank``: 0, 1, ... among the pieces of one length."""
    salts = max(MIN_SALTS, -(-total // PIECES_IN_GROUP))
    cut = cut.withColumn("salt", F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(salts)).cast("int"))
    before = cut.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n")
    inside = Window.partitionBy("length", "salt").orderBy("id", "start", "ids_crc32", "doc_tokens")
    return (cut.join(before, ["length", "salt"])
               .withColumn("rank", F.col("before") + F.row_number().over(inside) - 1).drop("before", "salt"))


def pack(docs: DataFrame, path: str | None = None, end_id: int = END_ID, sequence: int = SEQUENCE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence and its offset there."""
    cut = materialize(pieces(docs, path or public_file(VOCABULARY), end_id, sequence, id_col, text_col), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    rows = slots(pack_histogram(counts, sequence)) or [(0, 0, 0, 0, 0, 1)]
    # Bounded by the histogram's lengths, not by the documents.
    where = docs.sparkSession.createDataFrame(
        rows, "slot_length int, first_rank long, last_rank long, first_sequence long, first_offset long, each int")
    placed = ranked(cut, sum(counts.values())).join(
        F.broadcast(where), (F.col("length") == F.col("slot_length"))
        & F.col("rank").between(F.col("first_rank"), F.col("last_rank")))
    nth = F.col("rank") - F.col("first_rank")
    return placed.select(
        F.col("id").alias(id_col), "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("first_sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + F.pmod(nth, F.col("each").cast("long")) * F.col("length")).cast("long").alias("offset"))
