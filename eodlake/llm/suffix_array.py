"""Suffix order of a block of bytes by two-stage sorting, and the common prefixes of neighbours.

A suffix is of the small kind if it is smaller than its successor, else of the large kind. Only small suffixes are
sorted directly; the large ones follow from them in one scan over the 256 buckets of first bytes, since the suffix
before a sorted one is known to be sorted by its first byte and its successor's place. Plain numpy on one block,
which the caller keeps small.
"""

from __future__ import annotations

import numpy as np

WORD = 8


def words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number; bytes behind the end count as 0."""
    padded = np.concatenate([text, np.zeros(WORD, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for i in range(WORD):
        out = (out << np.uint64(8)) | padded[i : i + len(text)]
    return out


def small_kind(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; the last one is not, as nothing is smallest of all."""
    n = len(text)
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)  # last places of the runs of equal bytes
    rising = np.append(text[ends[:-1]] < text[ends[:-1] + 1], False)
    return np.repeat(rising, np.diff(ends, prepend=-1))


def _sort_directly(at: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
    """The places `at` in the order of their first `depth` bytes; later words are read for ties alone."""
    n = len(keys)
    at = at[np.argsort(keys[at], kind="stable")]
    level = keys[at]
    new = np.append(True, level[1:] != level[:-1])
    for skip in range(WORD, depth, WORD):
        group = np.cumsum(new)
        tied = np.flatnonzero(~new | ~np.append(new[1:], True))
        if not len(tied):
            break
        there = at[tied] + skip
        value = np.where(there < n, keys[np.minimum(there, n - 1)], 0)
        order = np.lexsort((value, group[tied]))
        at[tied] = at[tied][order]
        value, group = value[order], group[tied]
        new[tied[1:]] |= (value[1:] != value[:-1]) & (group[1:] == group[:-1])
    return at


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes of `text` (bytes), ordered by at least their first `depth` bytes."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    small = np.flatnonzero(small_kind(text))
    small = _sort_directly(small, words(text), depth) if len(small) else small
    bounds = np.searchsorted(text[small], np.arange(257)) if len(small) else np.zeros(257, np.int64)
    large: list[list[np.ndarray]] = [[] for _ in range(256)]
    large[text[-1]].append(np.array([n - 1]))  # follows from the empty suffix
    out = []
    for c in range(256):
        here = large[c]
        turn = np.concatenate(here) if here else np.zeros(0, np.int64)
        scanned = [turn]
        while len(turn):  # large suffixes that follow from others of this bucket
            turn = turn - 1
            turn = turn[turn >= 0]
            turn = turn[text[turn] == c]
            scanned.append(turn)
        scanned.append(small[bounds[c] : bounds[c + 1]])
        bucket = np.concatenate(scanned)
        large[c] = []
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[text[before] > c]
        if len(before):
            first = text[before]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
            for piece in np.split(before, cuts):
                large[text[piece[0]]].append(piece)
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of each suffix in `order` with the one before it, up to `limit`; 0 for the first."""
    keys, n = words(text), len(text)
    common = np.zeros(len(order), np.int64)
    open_ = np.arange(1, len(order))
    for skip in range(0, limit, WORD):
        a, b = order[open_ - 1] + skip, order[open_] + skip
        inside = (a < n) & (b < n)
        open_, a, b = open_[inside], a[inside], b[inside]
        differ = keys[a] ^ keys[b]
        # equal leading bytes: none of the upper bits set
        equal = np.zeros(len(differ), np.int64)
        for i in range(1, WORD + 1):
            equal += (differ >> np.uint64(64 - 8 * i)) == 0
        equal = np.minimum(equal, np.minimum(n - a, n - b))
        common[open_] += equal
        open_ = open_[equal == WORD]
        if not len(open_):
            break
    return np.minimum(common, limit)
