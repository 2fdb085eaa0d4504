"""Token-id files of adaptive, arithmetic-coded blocks.

Documents are tokenised in ascending id order; every Spark partition of that
order is a shard, and a shard's ids are cut into blocks of ``BLOCK`` ids.  A
block is coded on its own: the model starts with no more than the block's table,
and the block carries the checksum of its ids.

Model: an id is coded in one step, with the predictions of three contexts mixed.
The id before it (order 1) and the two before it (order 2) each predict the id
that last followed them, with a trust that the block learns for every state of a
prediction; the share that both leave goes to the block's own ids by their
frequency (order 0), which come first as a table: the gaps of the sorted ids,
and the power of two below each one's count.  The mix drives a range coder.  All
arithmetic is on integers, so reading repeats it exactly.
Hundreds of blocks advance side by side as numpy lanes.

File format: Parquet files of rows (shard, block, doc_ids, counts, open, data).
``doc_ids`` and ``counts`` list whose ids the block holds; ``open`` says that
the last of them goes on in the next block.  ``data`` is, little-endian:
``ACM2``, ids (u32), digits per id (u32), CRC-32 of the ids as u32 (u32); then,
if there are ids, the table: distinct ids (u32), bytes of its two parts (u32
each), gaps and powers by their powers of two in unary, the gaps' other bits;
then coded 16-bit words.

Cases: a null or empty text is its end id alone; null ids come first, ties are
ordered by text hash; repeated rows are written each; a document may span many
blocks but never two shards; a damaged block raises; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mktpanel.llm.common import releasing, shared_dir
from mktpanel.llm.tokens import encoder, public_file

BLOCK = 2048
LANES = 2048
VOCABULARY = "word_bpe_49k.json"
END_ID = 2
MAGIC = b"ACM2"
_HEAD = struct.Struct("<4sIII")

_SLOTS = 1 << 11        # contexts of order 2 per block
_STATES = 8             # what is known of a prediction: nothing (0), or it came and then held up to 6 times
_RATE = 4               # a trust moves by 1/16 of its error
_LEAST, _MOST = 500, 60_000  # of 65536, a trust goes no further
_RANGE = (1 << 48) - 1
_LOW = np.uint64(1 << 32)
_U16 = np.uint64(16)
_U32 = np.uint64(32)
_MASK32 = np.uint64((1 << 32) - 1)
_TABLE = struct.Struct("<III")
_DAMAGED = "checksum of a block does not match its ids"


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of some runs of these sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(_starts(sizes), sizes)


def _log2(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.int64) - 1


class _Order0:
    """The distinct ids of some blocks, one symbol each, with their shares of 2 ** ``bits`` in their block."""

    def __init__(self, ids: np.ndarray, classes: np.ndarray, sizes: np.ndarray):
        self.ids, self.classes, self.sizes, self.first = ids, classes, sizes, _starts(sizes)
        self.bits = np.maximum(_log2(sizes) + 3, 10)
        # A class stands for the counts from 2 ** class on; the weight is near their mean.
        weight = np.where(classes == 0, 4, (21 << classes) >> 2)
        ends = np.cumsum(weight)
        base = ends[self.first] - weight[self.first]
        total, room = ends[self.first + sizes - 1] - base, (1 << self.bits) - sizes
        base, total, room = (np.repeat(c, sizes) for c in (base, total, room))
        at = _within(sizes)
        self.low = at + (ends - weight - base) * room // total
        self.share = at + 1 + (ends - base) * room // total - self.low

    def tables(self) -> list[bytes]:
        """Each block's ids and classes: gaps and classes by their powers of two in unary, then the gaps' other bits."""
        gaps = np.diff(self.ids, prepend=0)
        gaps[self.first] = self.ids[self.first] + 1
        power = _log2(gaps)
        ones = np.stack([power, self.classes], 1).ravel() + 1
        firsts, sizes1 = self._aligned(np.add.reduceat(ones, 2 * self.first))
        unary = np.zeros(8 * int(sizes1.sum()), np.uint8)
        ends = np.cumsum(ones)
        unary[ends - 1 + np.repeat(firsts - (ends - ones)[2 * self.first], 2 * self.sizes)] = 1
        firsts, sizes2 = self._aligned(np.add.reduceat(power, self.first))
        rest = np.zeros(8 * int(sizes2.sum()), np.uint8)
        places = _starts(power) + np.repeat(firsts - _starts(power)[self.first], self.sizes)
        bit = _within(power)
        rest[np.repeat(places, power) + bit] = np.repeat(gaps, power) >> (np.repeat(power, power) - 1 - bit) & 1
        one, two = np.packbits(unary).tobytes(), np.packbits(rest).tobytes()
        return [_TABLE.pack(m, n1, n2) + one[a:a + n1] + two[b:b + n2] for m, n1, n2, a, b in zip(*(
            c.tolist() for c in (self.sizes, sizes1, sizes2, _starts(sizes1), _starts(sizes2))), strict=True)]

    @staticmethod
    def _aligned(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first bit and the bytes of each block, whole bytes a block."""
        size = -(-bits // 8)
        return 8 * _starts(size), size

    @classmethod
    def of_tables(cls, coded: list[bytes], bound: int) -> tuple[_Order0, list[int]]:
        """The symbols of blocks that start with their tables, and how long these are."""
        if any(len(c) < _TABLE.size for c in coded):
            raise ValueError(_DAMAGED)
        heads = [_TABLE.unpack_from(c) for c in coded]
        sizes, sizes1, sizes2 = np.array(heads, np.int64).T
        lengths = _TABLE.size + sizes1 + sizes2
        if (sizes < 1).any() or any(len(c) < n for c, n in zip(coded, lengths.tolist(), strict=True)):
            raise ValueError(_DAMAGED)
        ends = (_TABLE.size + sizes1).tolist()
        unary = np.frombuffer(b"".join(c[_TABLE.size:e] for c, e in zip(coded, ends, strict=True)), np.uint8)
        rest = np.frombuffer(b"".join([*(c[e:n] for c, e, n in zip(coded, ends, lengths.tolist(), strict=True)), bytes(8)]), np.uint8)
        ones, firsts = np.flatnonzero(np.unpackbits(unary)), 8 * _starts(sizes1)
        if (np.diff(np.append(np.searchsorted(ones, firsts), len(ones))) != 2 * sizes).any():
            raise ValueError(_DAMAGED)
        first = _starts(sizes)
        values = np.diff(ones, prepend=-1) - 1
        values[2 * first] = ones[2 * first] - firsts
        power, classes = values.reshape(-1, 2).T.copy()
        if values.max() > 31 or (-(-np.add.reduceat(power, first) // 8) != sizes2).any():
            raise ValueError(_DAMAGED)
        at = _starts(power) + np.repeat(8 * _starts(sizes2) - _starts(power)[first], sizes)
        some = sum(rest[(at >> 3) + j].astype(np.int64) << (32 - 8 * j) for j in range(5))
        gaps = 1 << power | some >> (40 - (at & 7) - power) & ((1 << power) - 1)
        ids = np.cumsum(gaps)
        ids -= np.repeat(ids[first] - gaps[first], sizes) + 1
        if ids.max() >= bound:
            raise ValueError(_DAMAGED)
        return cls(ids, classes, sizes), lengths.tolist()


class _Model:
    """The predictions of orders 1 and 2 in some blocks and how far each is trusted."""

    def __init__(self, order0: _Order0):
        n, lanes = len(order0.ids), len(order0.sizes)
        # A prediction is symbol * _STATES + state.  A block begins after a symbol of its own.
        self.one = np.full(n + lanes, -_STATES, np.int64)
        self.two = np.full(lanes * _SLOTS, -_STATES, np.int64)
        self.slots = np.arange(lanes) * _SLOTS
        mixed = (order0.ids.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
        mixed = (mixed ^ mixed >> np.uint32(15)) * np.uint32(0x85EBCA77)
        self.hash = np.append((mixed >> np.uint32(10)).astype(np.int64), np.zeros(lanes, np.int64))
        trust = np.arange(_STATES) * (65536 // (2 * _STATES))
        self.trust = np.tile(trust, 2 * lanes)
        self.row1, self.row2 = np.arange(lanes) * _STATES, np.arange(lanes, 2 * lanes) * _STATES
        self.last, self.before = np.arange(n, n + lanes), np.zeros(lanes, np.int64)

    def predict(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Parts of 65536 for the prediction of order 2, and for those of orders 2 and 1, in the first ``k`` blocks."""
        self.at1 = self.last[:k]
        now = self.hash.take(self.at1)
        self.at2 = self.slots[:k] + ((now ^ self.before[:k]) & (_SLOTS - 1))
        self.before = now >> 11
        self.e1, self.e2 = self.one.take(self.at1), self.two.take(self.at2)
        self.state1, self.state2 = self.e1 & (_STATES - 1), self.e2 & (_STATES - 1)
        self.guess1, self.guess2 = self.e1 >> 3, self.e2 >> 3
        self.at_trust1, self.at_trust2 = self.row1[:k] + self.state1, self.row2[:k] + self.state2
        self.trust1, self.trust2 = self.trust.take(self.at_trust1), self.trust.take(self.at_trust2)
        # What order 2 expects already, order 1 does not expect again.
        self.part1 = self.trust1 * (self.guess1 != self.guess2)
        return self.trust2, self.trust2 + (((65536 - self.trust2) * self.part1) >> 16)

    def update(self, symbol: np.ndarray, hit1: np.ndarray, hit2: np.ndarray) -> None:
        """``hit1``, ``hit2``: where the symbol was coded as the prediction of order 1 or of order 2."""
        step = (hit2 * (_MOST - _LEAST) + _LEAST - self.trust2) >> _RATE
        self.trust[self.at_trust2] = self.trust2 + step * (self.state2 > 0)
        step = (hit1 * (_MOST - _LEAST) + _LEAST - self.trust1) >> _RATE
        self.trust[self.at_trust1] = self.trust1 + step * ((self.part1 > 0) & ~hit2)
        fresh = symbol * _STATES + 1
        self.one[self.at1] = np.where(symbol == self.guess1, self.e1 + (self.state1 < _STATES - 1), fresh)
        self.two[self.at2] = np.where(hit2, self.e2 + (self.state2 < _STATES - 1), fresh)
        self.last = symbol


def _groups(sizes: list[int]) -> list[list[int]]:
    """Positions of the blocks that have an id, ``LANES`` at a time, longest first."""
    return [sorted((i for i in range(begin, min(begin + LANES, len(sizes))) if sizes[i]), key=lambda i: -sizes[i])
            for begin in range(0, len(sizes), LANES) if any(sizes[begin:begin + LANES])]


def encode_blocks(blocks: list[np.ndarray], digits: int) -> list[bytes]:
    """The table and the coded words of each block of ids below 16 ** ``digits``; any number of blocks of any length."""
    out: list[bytes] = [b""] * len(blocks)
    for some in _groups([len(b) for b in blocks]):
        lanes, sizes = len(some), np.array([len(blocks[i]) for i in some])
        symbols = np.zeros((lanes, int(sizes[0])), np.int64)
        place = np.zeros(int(max(blocks[i].max() for i in some)) + 1, np.int64)
        found, counts, n = [], [], 0
        for lane, i in enumerate(some):
            ids = np.sort(blocks[i])
            ends = np.append(np.flatnonzero(ids[1:] != ids[:-1]), len(ids) - 1)
            found.append(ids[ends])
            counts.append(np.diff(ends, prepend=-1))
            place[found[-1]] = np.arange(n, n + len(ends))
            symbols[lane, :len(ids)] = place[blocks[i]]
            n += len(ends)
        order0 = _Order0(np.concatenate(found).astype(np.int64), _log2(np.concatenate(counts)), np.array([len(f) for f in found]))
        symbols, model, bits = np.ascontiguousarray(symbols.T), _Model(order0), order0.bits.astype(np.uint64)
        of_low, of_share = order0.low.astype(np.uint64), order0.share.astype(np.uint64)
        low, span = np.zeros(lanes, np.uint64), np.full(lanes, _RANGE, np.uint64)
        words, at = np.zeros((2 * len(symbols) + 8) * lanes, np.uint32), np.arange(lanes)  # a row of lanes for each word
        for t, k in enumerate(np.searchsorted(-sizes, -np.arange(len(symbols)), "left").tolist()):  # lanes that still have an id
            row, lo, sp = symbols[t, :k], low[:k], span[:k]
            part2, part = model.predict(k)
            unit = sp >> _U16
            two, both = unit * part2.view(np.uint64), unit * part.view(np.uint64)
            hit2 = row == model.guess2
            hit1 = row == model.guess1
            hit1 &= ~hit2
            unit = (sp - both) >> bits[:k]
            lo += np.where(hit2, 0, np.where(hit1, two, both + unit * of_low.take(row)))
            np.copyto(sp, np.where(hit2, two, np.where(hit1, both - two, unit * of_share.take(row))))
            small = np.flatnonzero(sp < _LOW)
            while len(small):
                # Carries stay in the upper bits of the words until the end.
                x, place = lo[small], at[small]
                words[place] = x >> _U32
                at[small] = place + lanes
                lo[small] = (x & _MASK32) << _U16
                x = sp[small] << _U16
                sp[small] = x
                small = small[x < _LOW]
            model.update(row, hit1, hit2)
        for _ in range(3):
            words[at] = (low >> _U32).astype(np.uint32)
            at += lanes
            low = (low & _MASK32) << _U16
        n = at // lanes
        words, carry = words.reshape(-1, lanes)[:int(n.max())], np.zeros(lanes, np.uint32)
        for row in words[::-1]:
            row += carry
            np.right_shift(row, np.uint32(16), out=carry)
        words = np.ascontiguousarray(words.T.astype("<u2"))
        for lane, (i, table) in enumerate(zip(some, order0.tables(), strict=True)):
            out[i] = table + words[lane, :n[lane]].tobytes()
    return out


def decode_blocks(coded: list[tuple[bytes, int]], digits: int) -> list[np.ndarray]:
    """The ids of each (table and coded words, number of ids)."""
    out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(coded)
    for some in _groups([n for _, n in coded]):
        lanes, sizes = len(some), np.array([coded[i][1] for i in some])
        order0, begins = _Order0.of_tables([coded[i][0] for i in some], 16 ** digits)
        model, bits = _Model(order0), order0.bits.astype(np.uint64)
        of_low, of_share = order0.low.astype(np.uint64), order0.share.astype(np.uint64)
        # The symbol of each part of a block's shares.
        parts = np.repeat(np.arange(len(order0.ids)), order0.share)
        first, most = _starts(1 << order0.bits).astype(np.uint64), ((1 << order0.bits) - 1).astype(np.uint64)
        runs = [np.frombuffer(coded[i][0], "<u2", (len(coded[i][0]) - b) // 2, b) for i, b in zip(some, begins, strict=True)]
        words = np.zeros((lanes, max(map(len, runs)) + 4), np.uint16)
        for lane, run in enumerate(runs):
            words[lane, :len(run)] = run
        words = np.ascontiguousarray(words.T).astype(np.uint64)  # a row of lanes for each word
        value = words[0] << _U32 | words[1] << _U16 | words[2]
        words = words.ravel()
        span, at, end = np.full(lanes, _RANGE, np.uint64), np.arange(lanes) + 3 * lanes, len(words) - lanes + np.arange(lanes)
        symbols = np.zeros((int(sizes[0]), lanes), np.int64)
        for t, k in enumerate(np.searchsorted(-sizes, -np.arange(len(symbols)), "left").tolist()):
            va, sp = value[:k], span[:k]
            part2, part = model.predict(k)
            unit = sp >> _U16
            two, both = unit * part2.view(np.uint64), unit * part.view(np.uint64)
            hit2, other = va < two, va >= both
            hit1 = ~(hit2 | other)
            unit = (sp - both) >> bits[:k]
            found = np.minimum((va - both) // unit, most[:k])
            found += first[:k]
            row = np.where(other, parts.take(found.view(np.int64)), np.where(hit2, model.guess2, model.guess1))
            va -= np.where(other, both + unit * of_low.take(row), np.where(hit2, 0, two))
            np.copyto(sp, np.where(other, unit * of_share.take(row), np.where(hit2, two, both - two)))
            small = np.flatnonzero(sp < _LOW)
            while len(small):
                place = at[small]
                va[small] = va[small] << _U16 | words[np.minimum(place, end[small])]
                at[small] = place + lanes
                x = sp[small] << _U16
                sp[small] = x
                small = small[x < _LOW]
            model.update(row, hit1, hit2)
            symbols[t, :k] = row
        ids = order0.ids.astype(np.uint32)[np.ascontiguousarray(symbols.T)]
        for lane, i in enumerate(some):
            out[i] = ids[lane, :sizes[lane]].copy()
    return out


def _packed(blocks: list[np.ndarray], digits: int) -> list[bytes]:
    return [_HEAD.pack(MAGIC, len(b), digits, zlib.crc32(b.astype("<u4").tobytes())) + words
            for b, words in zip(blocks, encode_blocks(blocks, digits), strict=True)]


def _unpacked(data: list[bytes]) -> list[np.ndarray]:
    heads = [_HEAD.unpack_from(d) for d in data]
    if any(h[0] != MAGIC for h in heads) or len({h[2] for h in heads}) > 1:
        raise ValueError("not a block of token ids")
    ids = decode_blocks([(d[_HEAD.size:], h[1]) for d, h in zip(data, heads, strict=True)], heads[0][2]) if heads else []
    for found, h in zip(ids, heads, strict=True):
        if zlib.crc32(found.astype("<u4").tobytes()) != h[3]:
            raise ValueError(_DAMAGED)
    return ids


# ---------------------------------------------------------------- files

_BLOCK_ROW = "shard int, block int, doc_ids array<long>, counts array<int>, open boolean, data binary"


def write_ids(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID,
              block: int = BLOCK) -> None:
    """Write the token ids of all documents (doc_id, text) under ``path`` in ascending id order."""
    vocabulary = vocabulary or public_file(VOCABULARY)
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, spaced=False)
        digits = max(1, -(-max(enc.tokenizer.get_vocab_size() - 1, end_id, 1).bit_length() // 4))
        shard, number = 0, 0
        blocks: list[np.ndarray] = []
        runs: list[tuple[list, list, bool]] = []
        held: list[bytes] = []      # parts of the block that is being filled, each of one document
        owners: list = []
        room = block

        def close(goes_on: bool) -> None:
            nonlocal held, owners, room
            blocks.append(np.frombuffer(b"".join(held), "<u4"))
            runs.append((owners, [len(h) // 4 for h in held], goes_on))
            held, owners, room = [], [], block

        def flush() -> pa.RecordBatch:
            nonlocal number, blocks, runs
            data = _packed(blocks, digits)
            m = len(blocks)
            out = pa.RecordBatch.from_arrays(
                [pa.array([shard] * m, pa.int32()), pa.array(range(number, number + m), pa.int32()),
                 pa.array([r[0] for r in runs], pa.list_(pa.int64())), pa.array([r[1] for r in runs], pa.list_(pa.int32())),
                 pa.array([r[2] for r in runs], pa.bool_()), pa.array(data, pa.binary())],
                ["shard", "block", "doc_ids", "counts", "open", "data"])
            number += m
            blocks, runs = [], []
            return out

        for batch in batches:
            if batch.num_rows:
                shard = batch.column(2)[0].as_py()
            # Many texts at once share more of their words; the encoder takes them by size.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc, ids in zip(part.column(0).to_pylist(), enc.encode(part.column(1).to_pylist()), strict=True):
                    ids += end
                    begin = 0
                    while begin < len(ids):
                        piece = ids[begin:begin + 4 * room]
                        held.append(piece)
                        owners.append(doc)
                        begin += len(piece)
                        room -= len(piece) // 4
                        if room == 0:
                            close(begin < len(ids))
                            if len(blocks) == LANES:
                                yield flush()
        if held:
            close(False)
        if blocks:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("id", "h").sortWithinPartitions("id", "h")
    (rows.select("id", "text", F.spark_partition_id().alias("shard")).mapInArrow(releasing(run, encoders=True), _BLOCK_ROW)
         .write.mode("overwrite").parquet(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files under ``path``."""
    blocks = spark.read.schema(_BLOCK_ROW).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, start = None, 0
        crc, n = 0, 0               # of the document that is being read
        for batch in batches:
            for at in range(0, batch.num_rows, LANES):
                part = batch.slice(at, LANES).to_pylist()
                out: list[list] = [[], [], [], [], []]
                for row, ids in zip(part, _unpacked([r["data"] for r in part]), strict=True):
                    if row["shard"] != shard:
                        shard, start, crc, n = row["shard"], 0, 0, 0
                    raw, begin = ids.astype("<u4").tobytes(), 0
                    for i, (doc, count) in enumerate(zip(row["doc_ids"], row["counts"], strict=True)):
                        crc = zlib.crc32(raw[begin:begin + 4 * count], crc)
                        begin += 4 * count
                        n += count
                        if row["open"] and i == len(row["doc_ids"]) - 1:
                            continue
                        for col, v in zip(out, (shard, doc, start, n, crc), strict=True):
                            col.append(v)
                        start, crc, n = start + n, 0, 0
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                                 ["shard", "doc_id", "inside", "n_tokens", "ids_crc32"])

    found = (blocks.repartition("shard").sortWithinPartitions("shard", "block")
                   .mapInArrow(releasing(run), "shard long, doc_id long, inside long, n_tokens long, ids_crc32 long"))
    # One row per shard: the ids before it.
    sizes = blocks.groupBy("shard").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c)).alias("n"))
    bases = sizes.select(F.col("shard").cast("long").alias("of"),
                         (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    return found.join(bases, found["shard"] == bases["of"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def write_and_read(docs: DataFrame, path: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """Write the files and give what they hold per document."""
    spark = docs.sparkSession
    path = path or shared_dir(spark, "token-files")
    write_ids(docs, path, vocabulary)
    return read_ids(spark, path)
