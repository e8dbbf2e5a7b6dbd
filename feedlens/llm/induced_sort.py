"""Suffix arrays by induced sorting, in numpy steps over whole buckets.

A suffix is S if it is smaller than the next one, else L; the leftmost S of a run of S is an
LMS place. Sorted LMS suffixes determine the order of all others: the L suffixes are put in
from the smallest bucket on, then the S suffixes from the largest. A bucket's entries are
put in together, so the steps are as many as the alphabet is large, not as the text is long.
"""

from __future__ import annotations

import numpy as np


def _types(s: np.ndarray) -> np.ndarray:
    """True for S suffixes; ``s`` ends with its only zero, which is S."""
    n = len(s)
    change = np.flatnonzero(s[1:] != s[:-1])  # places that differ from the next
    nearest = np.full(n, n - 1)
    nearest[change] = change
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]  # next such place, or the end
    small = np.ones(n, bool)
    inside = nearest < n - 1
    small[inside] = s[nearest[inside]] < s[nearest[inside] + 1]
    return small


def _induce(s: np.ndarray, small: np.ndarray, sorted_lms: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array from LMS suffixes in order."""
    n = len(s)
    counts = np.bincount(s, minlength=sigma)
    ends = np.cumsum(counts)
    starts = ends - counts
    n_large = np.bincount(s[~small], minlength=sigma)
    by_bucket = np.split(sorted_lms, np.cumsum(np.bincount(s[sorted_lms], minlength=sigma))[:-1])
    array = np.full(n, -1, np.int64)

    def put(found: np.ndarray, fill: np.ndarray, forward: bool) -> None:
        """The places before ``found`` into their buckets, in the order of ``found``."""
        chars = s[found]
        order = np.argsort(chars.astype(np.uint16), kind="stable")
        found, chars = found[order], chars[order]
        first = np.flatnonzero(np.r_[True, chars[1:] != chars[:-1]])
        size = np.diff(np.r_[first, len(chars)])
        within = np.arange(len(chars)) - np.repeat(first, size)
        array[fill[chars] + within if forward else fill[chars] - 1 - within] = found
        fill[chars[first]] += size if forward else -size

    # L suffixes, from the front. A bucket grows while its own entries put more into it.
    fill = starts.copy()
    for c in np.flatnonzero(counts):
        done = starts[c]
        while done < fill[c]:
            now = array[done:fill[c]]
            done = fill[c]
            before = now[now > 0] - 1
            before = before[~small[before]]
            if len(before):
                put(before, fill, True)
        before = by_bucket[c][by_bucket[c] > 0] - 1  # LMS places follow an L place
        if len(before):
            put(before, fill, True)
    # S suffixes, from the back.
    fill = ends.copy()
    put(np.array([n - 1]), fill, False)
    for c in np.flatnonzero(counts)[::-1]:
        done = ends[c]
        while done > fill[c]:
            now = array[fill[c]:done][::-1]
            done = fill[c]
            before = now[now > 0] - 1
            before = before[small[before]]
            if len(before):
                put(before, fill, False)
        now = array[starts[c]:starts[c] + n_large[c]][::-1]
        before = now[now > 0] - 1
        before = before[small[before]]
        if len(before):
            put(before, fill, False)
    return array


def _sorted_lms(s: np.ndarray, small: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """LMS places in the order of their suffixes, as far as ``depth`` signs decide it.

    The substring from an LMS place to the next is named by its rank; then the text of the
    names is sorted by ranks of twice as many names each round.
    """
    size = np.minimum(np.r_[np.diff(lms) + 1, len(s) - lms[-1]], depth)
    # Of equal signs an L is smaller than an S.
    padded = np.concatenate([s * 2 + small + 1, np.zeros(8, np.int64)])
    ranks = np.zeros(len(lms), np.int64)
    covered = 0
    while covered < size.max():  # six signs at a time; shorter substrings end in zeros
        key = np.zeros(len(lms), np.int64)
        for j in range(covered, covered + 6):
            key = key * 1024 + np.where(j < size, padded[np.minimum(lms + j, len(s))], 0)
        pair = np.unique(key, return_inverse=True)[1]
        ranks = np.unique(ranks * (len(lms) + 1) + pair, return_inverse=True)[1] if covered else pair
        covered += 6
    step, reach = 1, 1
    while ranks.max() + 1 < len(lms) and 2 * reach <= depth:  # a name stands for two signs at least
        ahead = np.concatenate([ranks[step:] + 1, np.zeros(min(step, len(ranks)), np.int64)])
        ranks = np.unique(ranks * (len(lms) + 2) + ahead, return_inverse=True)[1]
        step, reach = step * 2, reach * 2
    return lms[np.argsort(ranks, kind="stable")]


def suffix_array(s: np.ndarray, sigma: int, depth: int | None = None) -> np.ndarray:
    """Starts of the suffixes of ``s`` (numbers below ``sigma`` <= 500) in order.

    With ``depth`` the order need only be right as far as so many signs decide it, which
    spares rounds for texts that repeat over long stretches.
    """
    if not len(s):
        return np.zeros(0, np.int64)
    ended = np.concatenate([np.asarray(s, np.int64) + 1, [0]])
    small = _types(ended)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    ordered = _sorted_lms(ended, small, lms, len(ended) if depth is None else depth)
    return _induce(ended, small, ordered, sigma + 1)[1:]


def common_prefix_at_least(s: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the suffixes at ``a`` and ``b`` (both with ``length`` signs, below 512) agree so far."""
    signs, many = s.astype(np.int64), 1
    while many < min(7, length):  # more of them in one number
        signs = signs[:-1] << 9 | s[many:]
        many += 1
    alive = np.arange(len(a))
    for j in [*range(0, length - many, many), length - many]:
        if not len(alive):
            break
        alive = alive[signs[a[alive] + j] == signs[b[alive] + j]]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out
