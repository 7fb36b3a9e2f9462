"""Word runs of many texts at once, as sorted 64-bit hashes (numpy; used inside Arrow batches)."""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np

#: Maximal runs of letters and numbers; `\\w` without the underscore is exactly categories L and N.
WORD = re.compile(r"[^\W_]+")

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class _WordHash(dict):
    """Word -> 64-bit hash, remembered; emptied when it has grown to a million words."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = int.from_bytes(blake2b(word.encode("utf-8", "replace"), digest_size=8).digest(), "little")
        return h


WORDS = _WordHash()


def mix64(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M2
        return x ^ (x >> np.uint64(31))


def shingles(texts, width: int, min_words: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`(doc, hash, n)` of a batch: the distinct runs of `width` words of each text, sorted by (doc, hash).

    `n[i]` is the number of distinct runs of text i; it is 0 for null texts, for those of fewer than
    `min_words` words and for those shorter than one run.
    """
    get, find = WORDS.__getitem__, WORD.findall
    ids: list[int] = []
    lens = np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        if t:
            w = find(t.lower())
            if len(w) >= max(min_words, width):
                lens[i] = len(w)
                ids.extend(map(get, w))
    n = np.zeros(len(texts), dtype=np.int64)
    if not ids:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), n
    a = np.fromiter(ids, dtype=np.uint64, count=len(ids))
    doc = np.repeat(np.arange(len(texts)), lens)
    m = len(a) - width + 1
    with np.errstate(over="ignore"):
        h = a[:m].copy()
        for k in range(1, width):
            h = mix64(h * _M1 + a[k : m + k])
    inside = doc[:m] == doc[width - 1 :]
    h, doc = h[inside], doc[:m][inside]
    o = np.lexsort((h, doc))
    h, doc = h[o], doc[o]
    keep = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]
    h, doc = h[keep], doc[keep]
    n += np.bincount(doc, minlength=len(texts))
    return doc, h, n


def overlaps(left, right, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`(shared, n_left, n_right)` distinct runs of the pairs left[i], right[i]."""
    da, ha, na = shingles(left, width)
    db, hb, nb = shingles(right, width)
    doc, h = np.r_[da, db], np.r_[ha, hb]
    o = np.lexsort((h, doc))
    doc, h = doc[o], h[o]
    twice = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    return np.bincount(doc[1:][twice], minlength=len(left)), na, nb
