"""Hashed character n-grams of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from docspark.llm.arrays import kept

#: Features: n-grams are hashed to 16 bits, whose sort is linear.
DIMS = 1 << 16


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def hashed_ngrams(texts: list[str], orders: tuple[int, ...], letters_only: bool) -> Iterator[np.ndarray]:
    """For each text the 16-bit hashes of its character n-grams, repeats included, in no special order.

    ``letters_only``: texts are put in lower case, and whatever is no letter becomes one blank. At most
    three characters per n-gram: their code points side by side are the number that is hashed.
    """
    joined = "\0".join([t.lower() for t in texts] if letters_only else texts)
    codes = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.uint64)
    ends = np.cumsum([len(t.lower()) + 1 if letters_only else len(t) + 1 for t in texts])
    if letters_only:
        alpha = kept("letters", _letters)[codes]
        stay = alpha.copy()
        stay[1:] |= alpha[:-1]
        codes = np.where(alpha, codes, np.uint64(32))[stay]
        count = np.concatenate([[0], np.cumsum(stay)])
        # a text keeps the blank that follows its last letter
        bounds = np.concatenate([[0], count[np.minimum(ends, len(stay))]])
        last = bounds[1:]
    else:
        bounds = np.concatenate([[0], ends])
        last = bounds[1:] - 1
    keys, grams = codes, {}
    for n in range(1, max(orders) + 1):
        if n > 1:
            keys = (keys[:-1] << np.uint64(21)) | codes[n - 1 :]
        if n in orders:
            grams[n] = ((keys + np.uint64(n * 0xD6E8FEB86659FD93 % 2**64)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.uint16)
    for a, b in zip(bounds[:-1].tolist(), last.tolist(), strict=True):
        yield np.concatenate([g[a : max(a, b - n + 1)] for n, g in grams.items()])


def counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features in ascending order, and how often each occurs."""
    grams = np.sort(grams, kind="stable")
    if not len(grams):
        return grams.astype(np.int64), np.zeros(0, np.int64)
    at = np.concatenate([[0], np.flatnonzero(grams[1:] != grams[:-1]) + 1, [len(grams)]])
    return grams[at[:-1]].astype(np.int64), np.diff(at)
