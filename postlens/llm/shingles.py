"""Words and word n-grams of texts, in numpy; shared by the near-duplicate operator's stages."""

from __future__ import annotations

import re

import numpy as np
import xxhash

_TAG = re.compile(r"<[^>]*>")
_WORD = re.compile(r"[^\W_]+")

#: Bits of a gram's hash in the sketches, and of a document's place in its batch above them.
GRAM_BITS = 40
MASK = np.uint64((1 << GRAM_BITS) - 1)
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def words(text: str) -> list[str]:
    """Maximal runs of letters and digits in lower case; what stands from < to > parts words."""
    if "<" in text:
        text = _TAG.sub(" ", text)
    return _WORD.findall(text.lower())


class WordHash(dict):
    """64-bit hashes of words, kept while a worker lives; emptied when it grows too large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        made = self[word] = xxhash.xxh3_64_intdigest(word)
        return made


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def batch_grams(lists: list[list[str]], n: int, hashes: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys (document << GRAM_BITS | gram) without repetition, and the documents' set sizes."""
    count = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    flat = np.fromiter((hashes[w] for ws in lists for w in ws), dtype=np.uint64, count=int(count.sum()))
    doc = np.repeat(np.arange(len(lists), dtype=np.uint64), count)
    total = len(flat) - n + 1
    if total <= 0:
        return np.empty(0, np.uint64), np.zeros(len(lists), np.int64)
    gram = np.zeros(total, np.uint64)
    for k in range(n):
        gram += flat[k : k + total] * _MULT[k]
    inside = doc[:total] == doc[n - 1 :]
    keys = np.sort((doc[:total][inside] << np.uint64(GRAM_BITS)) | (mix(gram[inside]) & MASK))
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
    sizes = np.bincount((keys >> np.uint64(GRAM_BITS)).astype(np.int64), minlength=len(lists))
    return keys, sizes


class ExactGrams:
    """Sets of n-grams as arrays of exact integers: words, or whole n-grams, get numbers when first met.

    Up to three words fit into one integer as they are; longer n-grams are numbered themselves.
    """

    WORD_BITS = 21

    def __init__(self, n: int):
        self.n, self.ids = n, {}

    def of(self, text: str) -> np.ndarray:
        ids, n, ws = self.ids, self.n, words(text)
        if n > 3:
            grams = set(zip(*(ws[k:] for k in range(n)), strict=False))
            return np.sort(np.fromiter((ids.setdefault(g, len(ids)) for g in grams), dtype=np.int64, count=len(grams)))
        w = np.fromiter((ids.setdefault(x, len(ids)) for x in ws), dtype=np.int64, count=len(ws))
        total = len(w) - n + 1
        if total <= 0:
            return np.empty(0, np.int64)
        if len(ids) > 1 << self.WORD_BITS:
            raise OverflowError("too many different words; start anew when full() says so")
        gram = np.zeros(total, np.int64)
        for k in range(n):
            gram = (gram << self.WORD_BITS) | w[k : k + total]
        return np.unique(gram)

    def full(self) -> bool:
        """Whether to start anew before the next batch of texts."""
        return len(self.ids) > 1_000_000
