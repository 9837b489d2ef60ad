"""Word shingles of whole texts as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

from kiln.llm.common import distinct, hold_memory, mix64, remembers

KNOWN_WORDS = 400_000


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hashes = WordHashes()
remembers("shingles", _hashes.clear)


def split_words(text: str) -> list[bytes]:
    """Words of a text with A-Z in lower case: runs of anything but blank and \\t..\\r (bytes split at just these)."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    hold_memory("shingles")
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def join_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive words."""
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mix64(out + h[i:i + n])
    return out


def shingle_set(text: str, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles; fewer words make one shingle of all, no word none."""
    h = word_hashes(split_words(text))
    return distinct(join_hashes(h, min(k, len(h)))) if len(h) else h
