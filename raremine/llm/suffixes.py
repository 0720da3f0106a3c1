"""Suffix arrays over integer tokens and their longest-common-prefix values,
vectorised with numpy for many short texts at once."""

from __future__ import annotations

import numpy as np


def suffix_ranks(tokens: np.ndarray) -> np.ndarray:
    """Rank of every suffix by prefix doubling.  Only suffixes that still share
    their rank are sorted again, so texts without long repeats settle after a
    few rounds.  The last token must be unique (a sentinel)."""
    n = len(tokens)
    order = np.argsort(tokens, kind="stable")
    t = tokens[order]
    new = np.empty(n, bool)
    new[:1] = True
    new[1:] = t[1:] != t[:-1]
    heads = np.flatnonzero(new)
    size = np.diff(np.append(heads, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(heads, size)
    open_ = order[np.repeat(size > 1, size)]
    k = 1
    while len(open_):
        after = open_ + k
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        first = rank[open_]
        by = np.lexsort((second, first))
        open_, first, second = open_[by], first[by], second[by]
        group = np.empty(len(open_), bool)
        group[0] = True
        group[1:] = first[1:] != first[:-1]
        part = group.copy()
        part[1:] |= second[1:] != second[:-1]
        at = np.arange(len(open_))
        group_head = at[group][np.cumsum(group) - 1]
        part_head = np.flatnonzero(part)
        part_size = np.diff(np.append(part_head, len(open_)))
        moved = first + np.repeat(part_head, part_size) - group_head
        rank[open_] = moved
        open_ = open_[np.repeat(part_size > 1, part_size)]
        k *= 2
    return rank


def suffix_array(tokens: np.ndarray) -> np.ndarray:
    sa = np.empty(len(tokens), np.int64)
    sa[suffix_ranks(tokens)] = np.arange(len(tokens))
    return sa


def permuted_lcp(tokens: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """PLCP[i]: length of the longest common prefix of suffix i and the suffix
    before it in the suffix array.  A value is reducible (one less than its
    left neighbour's) where the tokens before both suffixes agree; only the
    irreducible ones are compared, all of them at once."""
    n = len(tokens)
    if n == 0:
        return np.zeros(0, np.int64)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    at = np.arange(n)
    reducible = np.zeros(n, bool)
    ok = (at > 0) & (phi > 0)
    reducible[ok] = tokens[at[ok] - 1] == tokens[phi[ok] - 1]
    todo = np.flatnonzero(~reducible & (phi >= 0))
    length = np.zeros(n, np.int64)
    while len(todo):
        a, b = todo + length[todo], phi[todo] + length[todo]
        inside = np.maximum(a, b) < n
        same = np.zeros(len(todo), bool)
        same[inside] = tokens[a[inside]] == tokens[b[inside]]
        todo = todo[same]
        length[todo] += 1
    source = np.maximum.accumulate(np.where(reducible, -1, at))
    return np.where(reducible, length[source] - (at - source), length)


def longest_repeat_at(tokens: np.ndarray) -> np.ndarray:
    """For every position the length of the longest substring that starts there
    and also starts elsewhere: the depth of the deepest longest-common-prefix
    interval that holds its suffix."""
    sa = suffix_array(tokens)
    plcp = permuted_lcp(tokens, sa)
    lcp = np.append(plcp[sa], 0)
    depth = np.empty(len(tokens), np.int64)
    depth[sa] = np.maximum(lcp[:-1], lcp[1:])
    return depth
