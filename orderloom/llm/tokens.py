"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker.

Words between ASCII white space are encoded apart. That gives the ids of the
whole text: this vocabulary's tokenizer drops white space, splits at it, and
none of its normalisers looks across it. Special tokens are the exception, so a
text that holds one is encoded as a whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

#: Words a worker remembers. The memory is emptied when full, which changes the time taken only.
REMEMBERED = 1_200_000
#: Words encoded by one call.
AT_ONCE = 2_000
#: Stands between words that may have any number of parts; a word that holds it is encoded alone.
MARK = b"\x01"
#: Words of one part, or of two: letters that no normaliser splits or joins, and one mark. Each part ends in one id that ends a word.
SIMPLE = re.compile("([a-zA-ZÀ-ÖØ-öø-ÿ]+)([.,;:!?])?").fullmatch


#: How the vocabulary writes the end of a word.
WORD_END = "</w>"


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        (self.mark,) = self.ids(MARK.decode())
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.memo: dict[bytes, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        (one,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)  # the ids of encode(), without offsets
        return np.asarray(one.ids, dtype=self.dtype)

    def _cut(self, words: list[bytes], ids: np.ndarray, ends: np.ndarray, skip: int) -> None:
        """Remember of each word the ids up to its end, leaving out ``skip`` ids after it."""
        if len(ends) != len(words):
            raise ValueError("this vocabulary does not mark the ends of words as expected")
        size, raw, start = self.dtype.itemsize, ids.tobytes(), 0
        for w, end in zip(words, (ends * self.dtype.itemsize).tolist(), strict=True):
            self.memo[w] = raw[start:end]
            start = end + skip * size

    def _learn(self, words: set[bytes]) -> None:
        simple, parts, other = [], [], []
        for w in words:
            if found := SIMPLE(w.decode()):
                simple.append(w)
                parts.append(found.lastindex)
            elif MARK in w:
                self.memo[w] = self.ids(w.decode()).tobytes()
            else:
                other.append(w)
        for a in range(0, len(simple), AT_ONCE):
            some = simple[a : a + AT_ONCE]
            ids = self.ids(b" ".join(some).decode())
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            n = np.cumsum(parts[a : a + AT_ONCE])
            self._cut(some, ids, ends[n - 1] if len(ends) == n[-1] else ends[:0], 0)
        for a in range(0, len(other), AT_ONCE):
            some = other[a : a + AT_ONCE]
            ids = self.ids((b" %b " % MARK).join([*some, b""]).decode())
            self._cut(some, ids, np.flatnonzero(ids == self.mark), 1)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Of each text the ids, packed in ``dtype``; a null text has none."""
        raw = [(t or "").encode() for t in texts]
        # Lower case first only where that cannot change how characters compose.
        split = [None if any(s in b for s in self.special) else (b.lower() if b.isascii() else b).split() for b in raw]
        new = set().union(*(ws for ws in split if ws)).difference(self.memo)
        if len(self.memo) + len(new) > REMEMBERED:
            self.memo.clear()
            new = set().union(*(ws for ws in split if ws))
        self._learn(new)
        word = self.memo.__getitem__
        return [self.ids(t).tobytes() if ws is None else b"".join(map(word, ws)) for t, ws in zip(texts, split, strict=True)]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per worker process, kept from task to task."""
    return Encoder(path)


def slices(sizes: list[int], most: int = 4 << 20):
    """Cut a batch into runs of at most ``most`` bytes, a longer text alone in its own."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)
