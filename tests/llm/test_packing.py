import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from mktpanel.llm import packing as P
from mktpanel.llm.common import table
from mktpanel.llm.tokens import Encoder, public_file


def plain(name):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_file(name))
    t.encode_special_tokens = True
    return lambda text, end: np.array(t.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def check(docs, rows, sequence=1024):
    encode = plain("byte_bpe_50k.json")
    want = Counter()
    for doc, text in docs:
        ids = encode(text, 0)
        want[doc, len(ids), zlib.crc32(ids.tobytes())] += 1
    at, pieces = defaultdict(list), Counter()
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id] += r.length
    total = Counter()
    for doc, n, _ in want.elements():
        total[doc] += n
    assert pieces == total
    texts = {(d, t) for d, t in docs}
    good = {(d, s, min(sequence, len(ids) - s), zlib.crc32(ids[s:s + sequence].tobytes()), len(ids))
            for d, t in texts for ids in [encode(t, 0)] for s in range(0, len(ids), sequence)}
    assert {(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows} == good
    padding = 0
    for parts in at.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= sequence
        padding += 0 if end & (end - 1) == 0 else sequence - end
    return padding / max(1, sum(pieces.values()))


def test_every_id_lies_in_one_piece(spark, edge_docs, no_docs):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert check(rows, P.pack(docs).collect()) < 0.02
    check([(r.doc_id, r.text) for r in edge_docs.collect()], P.pack(edge_docs).collect())
    assert P.pack(no_docs).count() == 0


def test_histogram_is_placed_once_and_densely():
    rng = random.Random(4)
    for counts in ({}, {1024: 5}, {1: 3000}, {600: 10, 400: 25, 24: 7}, {n: rng.randrange(1, 200) for n in range(1, 1024)}):
        patterns = P.pack_histogram(counts)
        placed = Counter()
        for runs, n in patterns:
            assert sum(length * each for length, each in runs) <= 1024
            for length, each in runs:
                placed[length] += each * n
        assert placed == Counter(counts)
        ranks = defaultdict(list)
        for length, first, last, *_ in P.slots(patterns):
            ranks[length] += range(first, last + 1)
        assert all(sorted(ranks[length]) == list(range(n)) for length, n in counts.items())
        ids = sum(length * n for length, n in counts.items())
        assert len(counts) < 4 or sum(n for _, n in patterns) * 1024 <= 1.02 * ids + 1024


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_cached_words_give_the_tokenizers_ids(spark, small, name, spaced):
    texts = [r.text for r in table(spark, small, "documents").collect()]
    texts += ["", " a", "a ", "a  b", "a\n\nb", "x\ty", "l'été 12,5 <|endoftext|> end", "it's we'll I's", "\0 a\0b c",
              "Σας ΟΔΟΣ İstanbul ǅ é ñ.", "a. b, c! d? É. ÀÉ, straße ß. word.. x.,", "a b  c", "\x1c a"]
    encode, enc = plain(name), Encoder(public_file(name), spaced)
    for _ in range(2):
        for text, ids in zip(texts, enc.encode(texts), strict=True):
            assert ids == encode(text, 0)[:-1].tobytes(), text[:80]


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_a_word_of_many_places_is_looked_up_once(name, spaced):
    class Counted(dict):
        asked = 0

        def get(self, *key):
            self.asked += 1
            return super().get(*key)

        def __getitem__(self, key):
            self.asked += 1
            return super().__getitem__(key)

    enc = Encoder(public_file(name), spaced=spaced)
    enc.cache = Counted()
    texts = ["one two, three\nfour five. " + "six seven " * 200 + str(i) for i in range(100)]
    encode = plain(name)
    assert list(enc.encode(texts)) == [encode(t, 0)[:-1].tobytes() for t in texts]
    assert enc.cache.asked < 1000           # some 110 words; 41,000 places
    # Chunks without a simple text, and without any.
    odd = ["", "  ", "a  b", "x\x1cy", "\0", " a"]
    assert list(enc.encode(odd)) == [encode(t, 0)[:-1].tobytes() for t in odd] and list(enc.encode([])) == []
