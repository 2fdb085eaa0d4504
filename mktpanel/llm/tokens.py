"""Token ids of whole texts as bytes, through a cache of words.

Both tokenizers split a text at single white space before they merge, so a
text's ids are its words' ids in a row.  Arrow splits a batch of texts and
numbers its different words; those that the cache lacks are encoded together.
Texts with other white space than single spaces and line feeds go through the
tokenizer whole.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TEXT_AT_ONCE = 1 << 22
CACHE_WORDS = 400_000
_ENDS = frozenset(".,;:!?")
# Blanks to Python, signs to the tokenizers.
_SEPARATORS = re.compile("[\x1c-\x1f]")


def _byte_characters() -> list[str]:
    """The character by which byte-level files write each byte: itself if printable, else the next from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


_BYTE_CHARACTERS = str.maketrans(dict(enumerate(_byte_characters())))


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers.

    ``spaced``: a word's ids depend on the space before it (byte-level files)
    and line feeds have an id; otherwise white space is dropped.
    """

    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.spaced = spaced
        self.mark = "\0" if spaced else " "
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}

    def _direct(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _marked(self, text: str) -> str | None:
        """A text with ``self.mark`` between the words that the tokenizer sees, or None where it must see the whole."""
        if _SEPARATORS.search(text):
            return None
        found = text.split()
        if not self.spaced:
            return " ".join(found)
        if not found or len(found) != text.count(" ") + text.count("\n") + 1:
            return None if text else ""
        # A word after a space keeps it; a line feed stands alone.
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ") if "\0" not in text else None

    def _merged(self, word: str) -> bytes:
        """Ids of a word that is one piece before the merges."""
        shown = word if word.isascii() and word[0] != " " else word.encode().decode("latin-1").translate(_BYTE_CHARACTERS)
        ids = [t.id for t in self.tokenizer.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, new: list[str]) -> None:
        """Put new words in the cache; only those of letters, with or without a sign behind, are seen to be simple."""
        hard = []
        for word in new:
            bare = word[1:] if word[0] == " " else word
            head = bare[:-1] if bare[-1:] in _ENDS else bare
            # Characters up to U+00FF are normalised and have a lower case of their own.
            if not head.isalpha() or not self.spaced and max(head) > "\xff":
                hard.append(word)
                continue
            whole = word if self.spaced else word.lower()
            if head is bare:
                self.cache[word] = self._merged(whole)
            else:
                self.cache[word] = (self.cache.get(word[:-1]) or self._merged(whole[:-1])) + self._sign(whole[-1])
        self.cache.update(zip(hard, self._direct(hard), strict=True))

    def _sign(self, sign: str) -> bytes:
        if sign not in self.signs:
            self.signs[sign] = self._direct([sign])[0]
        return self.signs[sign]

    def _known(self, words: list[str]) -> list[bytes]:
        """The ids of different words, by the cache where it has them."""
        found = list(map(self.cache.get, words))
        # Found one by one: ``set - dict.keys()`` would go through the whole cache.
        wanted = [w for w, ids in zip(words, found, strict=True) if ids is None]
        if len(self.cache) + len(wanted) > CACHE_WORDS:
            # Words in use move over from the older half as they are met again.
            self.older, self.cache, wanted = self.cache, {}, words
        again = {w: self.older[w] for w in wanted if w in self.older}
        self.cache.update(again)
        self._learn([w for w in wanted if w not in again])
        return [self.cache[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]

    def _simple(self, marked: list[str]) -> list[bytes]:
        """Ids of marked texts: each different word is looked up once, its ids are copied to its places by numpy."""
        split = pc.split_pattern(pa.array(marked, pa.large_string()), self.mark)
        coded = split.values.dictionary_encode()
        ids = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        word = coded.indices.to_numpy()
        n = sizes[word]
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(ends[-1]) + np.repeat((np.cumsum(sizes) - sizes)[word] - ends[:-1], n)
        out = np.frombuffer(b"".join(ids), "<u4")[at].tobytes()
        bounds = (4 * ends[split.offsets.to_numpy()]).tolist()
        return [out[i:j] for i, j in pairwise(bounds)]

    def _chunk(self, texts: list[str]) -> list[bytes]:
        marked = [self._marked(t) for t in texts]
        simple = iter(self._simple([m for m in marked if m]))
        return [next(simple) if m else b"" if m is not None else self._direct([t])[0]
                for m, t in zip(marked, texts, strict=True)]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text (null: none), in order; about a megabyte of text at once."""
        some: list[str] = []
        n = 0
        for t in texts:
            some.append(t or "")
            n += len(some[-1])
            if n >= TEXT_AT_ONCE:
                yield from self._chunk(some)
                some, n = [], 0
        if some:
            yield from self._chunk(some)


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaced: bool) -> Encoder:
    """This worker's encoder for a file, kept between tasks."""
    if (path, spaced) not in _encoders:
        _encoders[path, spaced] = Encoder(path, spaced)
    return _encoders[path, spaced]


def forget_encoders() -> None:
    """Drop this worker's encoders and their words."""
    _encoders.clear()


def public_file(name: str) -> str:
    """Path of a public vocabulary file; the default of the ``path`` parameters."""
    import public_tokenizers

    return public_tokenizers.path(name)
