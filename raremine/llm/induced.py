"""Suffix arrays by induced sorting, vectorised by character bucket.

Suffixes are classified as smaller (S) or larger (L) than their right
neighbour.  Leftmost-smaller substrings are sorted by one induction, named, and
the string of names is sorted recursively; a second induction from their final
order places all other suffixes in linear work.  Within a bucket the scan goes
in batches: entries placed so far are processed at once, what they append to
the same bucket is the next batch.

The string of names has few equal neighbours but a large alphabet, for which
buckets no longer pay; it is then sorted by prefix doubling.
"""

from __future__ import annotations

import numpy as np

from raremine.llm.suffixes import suffix_array as doubling_suffix_array

#: Tokens per distinct token below which a string is sorted by doubling.
MIN_PER_BUCKET = 256


def _classify(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it."""
    n = len(t)
    step = np.empty(n, np.int8)
    step[-1] = 1
    step[:-1] = np.sign(t[1:].astype(np.int64) - t[:-1])
    known = np.where(step != 0, np.arange(n), n)
    return step[np.minimum.accumulate(known[::-1])[::-1]] > 0


def _append(sa, pointer, chars, positions, direction):
    """Puts positions, in order, at the pointers of their buckets and moves the
    pointers on (direction 1: upwards, -1: downwards)."""
    order = np.argsort(chars, kind="stable")
    c, p = chars[order], positions[order]
    first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
    size = np.diff(np.append(first, len(c)))
    rank = np.arange(len(c)) - np.repeat(first, size)
    sa[pointer[c] + direction * rank] = p
    pointer[c[first]] += direction * size


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, count: np.ndarray, n_large: np.ndarray) -> np.ndarray:
    """Suffix array induced from leftmost-smaller positions in the given order
    (which must be by first character)."""
    n = len(t)
    head = np.cumsum(count) - count
    tail = head + count
    present = np.flatnonzero(count)
    sa = np.full(n, -1, np.int64)
    # leftmost-smaller suffixes at the ends of their buckets
    c = t[lms]
    per = np.bincount(c, minlength=len(count))
    sa[(tail - per)[c] + np.arange(len(lms)) - (np.cumsum(per) - per)[c]] = lms
    # larger suffixes from left to right
    pointer = head.copy()
    for b in present:
        lo = head[b]
        while True:
            hi = pointer[b]
            if lo == hi:
                break
            batch = sa[lo:hi] - 1
            batch = batch[batch >= 0]
            batch = batch[~small[batch]]
            if len(batch):
                _append(sa, pointer, t[batch], batch, 1)
            lo = hi
        if per[b]:
            batch = sa[tail[b] - per[b]:tail[b]] - 1
            batch = batch[batch >= 0]
            batch = batch[~small[batch]]
            if len(batch):
                _append(sa, pointer, t[batch], batch, 1)
    # smaller suffixes from right to left
    pointer = tail - 1
    for b in present[::-1]:
        hi = tail[b] - 1
        while True:
            lo = pointer[b]
            if lo == hi:
                break
            batch = sa[lo + 1:hi + 1][::-1] - 1
            batch = batch[batch >= 0]
            batch = batch[small[batch]]
            if len(batch):
                _append(sa, pointer, t[batch], batch, -1)
            hi = lo
        if n_large[b]:
            batch = sa[head[b]:head[b] + n_large[b]][::-1] - 1
            batch = batch[batch >= 0]
            batch = batch[small[batch]]
            if len(batch):
                _append(sa, pointer, t[batch], batch, -1)
    return sa


def _names(t: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Name of every leftmost-smaller substring (text order): equal substrings
    share one, names follow the sorted order."""
    size = np.append(np.diff(lms), 0) + 1
    number = np.empty(len(t), np.int64)
    number[lms] = np.arange(len(lms))
    by = number[order]
    a, b = order[:-1], order[1:]
    differ = size[by[:-1]] != size[by[1:]]
    length = size[by[1:]]
    open_ = np.flatnonzero(~differ)
    k = 0
    while len(open_):
        same = t[a[open_] + k] == t[b[open_] + k]
        differ[open_[~same]] = True
        k += 1
        open_ = open_[same]
        open_ = open_[length[open_] > k]
    names = np.empty(len(lms), np.int64)
    names[by] = np.concatenate([[0], np.cumsum(differ)])
    return names


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Suffix array of small non-negative integers that end in a unique least 0."""
    n = len(t)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    size = int(t.max()) + 1
    if n < MIN_PER_BUCKET * size and size > 512:
        return doubling_suffix_array(t)
    small = _classify(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    count = np.bincount(t, minlength=size)
    n_large = np.bincount(t[~small], minlength=size)
    if len(lms) > 1:
        rough = _induce(t, small, lms[np.argsort(t[lms], kind="stable")], count, n_large)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        order = rough[is_lms[rough]]
        names = _names(t, lms, order)
        if names.max() + 1 < len(lms):
            order = lms[suffix_array(names)]
    else:
        order = lms
    return _induce(t, small, order, count, n_large)
