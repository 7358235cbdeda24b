"""Words and word n-grams of a text as fixed 64-bit hashes, in numpy."""

from __future__ import annotations

from itertools import islice

import numpy as np
import xxhash

_MULTIPLY = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def forget_older(held: dict) -> None:
    """Drop the half of a dictionary that came first; frequent words of it soon come again."""
    for key in list(islice(held, len(held) // 2)):
        del held[key]


class WordHash(dict):
    """Hash of each word (bytes), remembered for up to ``limit`` words."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            forget_older(self)
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def low_words(text: str | None) -> list[bytes]:
    """The words of a text with A-Z in lower case; of null, none."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-grams of the words, by position."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(size, np.uint64)
    for i in range(n):
        out += hashes[i : i + size] * _MULTIPLY[i % 5] ^ np.uint64(i // 5)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out
