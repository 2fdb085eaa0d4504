import zlib

import numpy as np
import pytest
from test_packing import plain

from mktpanel.llm import token_files as T
from mktpanel.llm.common import shared_dir, table


def blocks():
    rng = np.random.default_rng(0)
    some = [rng.integers(0, 65536, n) for n in (0, 1, 2, 700)] + [np.zeros(900, int), np.full(5, 65535)]
    text = rng.choice(rng.integers(0, 49408, 60), 1500, p=np.arange(60, 0, -1) / 1830)
    return [b.astype(np.uint32) for b in [*some, text, *[text[i:i + 300] for i in range(0, 1200, 300)]]]


def test_blocks_come_back_exactly():
    data = blocks()
    for digits in (4, 5):
        coded = T.encode_blocks(data, digits)
        back = T.decode_blocks([(c, len(b)) for c, b in zip(coded, data)], digits)
        assert all(x.tolist() == y.tolist() for x, y in zip(data, back, strict=True))
    # Predictable ids take far fewer bits than 16.
    assert len(coded[6]) * 8 < 9 * len(data[6])
    assert len(T.encode_blocks([data[4]], 4)[0]) < 200


def test_a_block_does_not_depend_on_its_neighbours():
    data = blocks()
    assert [T.encode_blocks([b], 4)[0] for b in data] == T.encode_blocks(data, 4)


def test_an_id_is_one_step_of_the_model(monkeypatch):
    data, steps, predict = blocks(), [], T._Model.predict
    monkeypatch.setattr(T._Model, "predict", lambda *a: steps.append(1) or predict(*a))
    coded = T.encode_blocks(data, 4)
    longest = max(map(len, data))
    assert len(steps) == longest
    T.decode_blocks([(c, len(b)) for c, b in zip(coded, data)], 4)
    assert len(steps) == 2 * longest
    # The block's own ids cost little more than their entropy and their table.
    counts = np.bincount(data[6])
    share = counts[counts > 0] / len(data[6])
    assert len(coded[6]) * 8 < -len(data[6]) * (share * np.log2(share)).sum() * 1.05 + 24 * len(share)


def test_extreme_and_damaged_blocks():
    rng = np.random.default_rng(1)
    turns = np.tile(rng.permutation(5000), 3)
    data = [b.astype(np.uint32) for b in (np.arange(65536), turns, np.array([0, 65535]), np.tile([7, 7, 9], 9000))]
    coded = T.encode_blocks(data, 4)
    back = T.decode_blocks([(c, len(b)) for c, b in zip(coded, data)], 4)
    assert all(x.tolist() == y.tolist() for x, y in zip(data, back, strict=True))
    packed = T._packed([blocks()[6], turns[:900].astype(np.uint32)], 4)
    for which in range(2):
        for at in rng.integers(T._HEAD.size, len(packed[which]) - 8, 60):
            bad = [bytearray(x) for x in packed]
            bad[which][at] ^= int(rng.integers(1, 256))
            with pytest.raises(ValueError, match="checksum"):
                T._unpacked([bytes(x) for x in bad])


def test_damage_is_found():
    packed = bytearray(T._packed(blocks()[6:7], 4)[0])
    packed[40] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        T._unpacked([bytes(packed)])
    with pytest.raises(ValueError, match="not a block"):
        T._unpacked([b"XXXX" + bytes(packed[4:])])


def check(spark, docs):
    encode = plain("word_bpe_49k.json")
    rows = sorted(T.write_and_read(docs).collect(), key=lambda r: r.start)
    want = sorted(((r.doc_id, tuple(encode(r.text, 2).tolist())) for r in docs.select("doc_id", "text").collect()), key=str)
    start = 0
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    assert [r.doc_id is not None and r.doc_id or 0 for r in rows] == sorted((r.doc_id or 0) for r in rows)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows), key=str) == sorted(
        ((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in want), key=str)


def test_files_hold_every_document(spark, small, edge_docs, no_docs):
    check(spark, table(spark, small, "documents"))
    check(spark, edge_docs)
    path = shared_dir(spark, "empty-tokens")
    T.write_ids(no_docs, path)
    assert T.read_ids(spark, path).count() == 0
