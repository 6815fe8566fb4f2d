"""Hashed words of whole texts as flat numpy arrays, for the classifiers of this folder."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np

#: Buckets of the hashed vocabulary; bucket 0 is padding and never a word.
BUCKETS = 1 << 16
#: Words start alike in languages that compound or inflect, so the first PREFIX letters are hashed as well.
PREFIX = 5
MEMO = 60_000
#: Words that are worked on at a time; one longer text makes a longer block.
BLOCK_WORDS = 100_000

_find = re.compile(r"[^\W_]+").findall


class _Memo(dict):
    """word -> bucket of the word, and of its prefix in the high half."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        bucket = lambda s: 1 + zlib.crc32(s.encode("utf-8", "surrogatepass")) % (BUCKETS - 1)
        self[word] = value = bucket(word) | bucket("^" + word[:PREFIX]) << 32
        return value


_memo = _Memo()


def word_ids(text: str) -> np.ndarray:
    """One uint64 a word of the lower-cased text: its bucket low, its prefix's bucket high."""
    words = _find(text.lower())
    return np.fromiter(map(_memo.__getitem__, words), np.uint64, len(words))


def blocks(texts: list[str]) -> Iterator[tuple[list[np.ndarray], int, int]]:
    """Word arrays of consecutive texts, with the first and one past the last, of about BLOCK_WORDS words together."""
    held: list[np.ndarray] = []
    size = first = 0
    for k, text in enumerate(texts):
        held.append(word_ids(text))
        size += len(held[-1])
        if size >= BLOCK_WORDS or k == len(texts) - 1:
            yield held, first, k + 1
            held, size, first = [], 0, k + 1
