"""Near-duplicate passages through compact windows.

A text is a sequence of word shingles.  For one hash function the Cartesian tree
over the shingles' hashes has a node for every shingle; the node's compact
window [l, r] is the largest range in which its hash is the minimum.  All
subsequences that contain the node and stay in the window share that min-hash.
Only nodes whose window holds a passage (``passage`` words) matter; they are
the minima of some window of that length, and so are their nearest smaller
neighbours, so the tree is built over them alone.

1. Windows with equal signatures (function and minimum) meet; signatures that
   occur once are dropped by counts before anything else moves.
2. Windows with the same shingles around their node are one kind with members.
3. Kinds that share a signature are compared, aligned at the node: the interval
   of ``passage`` words around it with the most shingles in common must reach
   the similarity in an exact comparison of shingle sets.  Groups with many
   kinds are first split by an exact prefix filter: similar intervals share one
   of their rarest shingles.  Parts still large are dealt as pairs of blocks.
4. Members of a kind and verified kinds link documents; classes are the
   connected components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raremine.llm.components import connected_components
from raremine.llm.store import written
from raremine.llm.suffix_dedup import _sliding_min
from raremine.llm.textops import (
    LOWER, NOT_SPACE, _power_tables, gram_hash, mix64, span_hash, text_blocks, word_spans)

SHINGLE_WORDS, PASSAGE_WORDS, SIMILARITY = 5, 50, 0.8
FUNCTIONS = 3
#: Kinds compared pair by pair in one group, pivots of larger groups, kinds of a task.
MAX_KINDS, PIVOTS, TASK_KINDS = 1500, 8, 6000
#: Shift, in words, up to which shingles count as in common before sets are
#: compared; more words put in on one side leave less than the similarity.
MAX_SHIFT = 4
#: Shingle counts that a task adds up at once; kinds of groups compared side by
#: side (in larger ones shingles tell first who meets); pairs held at a time.
HELD_ROWS, FEW_KINDS, PAIRS_AT_ONCE = 2_000_000, 40, 2048
_PLACE_BITS = 24


def _seed(i: int) -> np.uint64:
    return np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1)) & ((1 << 64) - 1))


def _shingles(data: np.ndarray, offs: np.ndarray, words: int):
    """Hash of the shingle that starts at every word, first word of every text,
    and the end of its shingles."""
    low = LOWER[data]
    start, end, w_offs = word_spans(low, offs, NOT_SPACE)
    h = gram_hash(span_hash(low, start, end), words)
    return h, w_offs, np.maximum(w_offs[:-1], w_offs[1:] - words + 1)


def tree_nodes(h: np.ndarray, w_offs: np.ndarray, ends: np.ndarray, length: int):
    """(text, node, ranked hash) of every Cartesian-tree node whose compact
    window holds ``length`` shingles; positions count over the block."""
    none = np.zeros(0, np.int64)
    if len(h) < length:
        return none, none, none.astype(np.uint64)
    place = np.uint64(_PLACE_BITS)
    ranked = (h >> place << place) | (np.arange(len(h), dtype=np.uint64) & np.uint64((1 << _PLACE_BITS) - 1))
    # places are kept modulo 2^_PLACE_BITS, which is more than a window has
    low = (_sliding_min(ranked, length) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    low = np.arange(len(low)) + ((low - np.arange(len(low))) & ((1 << _PLACE_BITS) - 1))
    doc_of = np.repeat(np.arange(len(ends)), np.diff(w_offs))[:len(low)]
    inside = np.arange(len(low)) + length <= ends[doc_of]
    # the places of a sliding window's minimum never go back
    nodes = low[inside]
    nodes = nodes[np.append(True, nodes[1:] != nodes[:-1])[:len(nodes)]]
    return np.searchsorted(w_offs, nodes, side="right") - 1, nodes, ranked[nodes]


def tree_windows(h: np.ndarray, w_offs: np.ndarray, ends: np.ndarray, length: int):
    """(text, node, l, r) of every Cartesian-tree node whose compact window
    holds ``length`` shingles; positions count over the block, r included."""
    doc, nodes, ranked = tree_nodes(h, w_offs, ends, length)
    value, where, texts = ranked.tolist(), nodes.tolist(), doc.tolist()
    first, last = w_offs[:-1].tolist(), ends.tolist()
    left, right = [0] * len(where), [0] * len(where)
    stack: list[int] = []
    for k, v in enumerate(value):
        if stack and texts[stack[-1]] != texts[k]:
            for s in stack:
                right[s] = last[texts[s]] - 1
            stack = []
        while stack and value[stack[-1]] > v:
            right[stack.pop()] = where[k] - 1
        left[k] = where[stack[-1]] + 1 if stack else first[texts[k]]
        stack.append(k)
    for s in stack:
        right[s] = last[texts[s]] - 1
    return doc, nodes, np.array(left, np.int64), np.array(right, np.int64)


_PLACE = "row long, signature long, kind long, node long, lo long, hi long"


def _signatures(docs: DataFrame, shingle: int, passage: int, functions: int) -> DataFrame:
    """Signature of every compact window of (text); needs nodes only, no tree."""
    def run(batches):
        for _, data, offs in text_blocks(batches, "text"):
            h, w_offs, ends = _shingles(data, offs, shingle)
            for i in range(functions):
                _, node, _ = tree_nodes(mix64(h ^ _seed(i)), w_offs, ends, passage - shingle + 1)
                yield pa.RecordBatch.from_arrays([pa.array(mix64(h[node] + _seed(i + 100)).view(np.int64))], names=["signature"])

    return docs.select("text").mapInArrow(run, "signature long")


def _windows(docs: DataFrame, shingle: int, passage: int, functions: int) -> DataFrame:
    """Compact windows of (row, text): signature, hash of the shingles around
    the node, and where they are."""
    length = passage - shingle + 1

    def run(batches):
        for part, data, offs in text_blocks(batches, "text"):
            h, w_offs, ends = _shingles(data, offs, shingle)
            up, down, _ = _power_tables(len(h) + 1)
            sums = np.zeros(len(h) + 1, np.uint64)
            np.cumsum(h * up[:len(h)], out=sums[1:])
            for i in range(functions):
                doc, node, left, right = tree_windows(mix64(h ^ _seed(i)), w_offs, ends, length)
                lo, hi = np.maximum(left, node - length + 1), np.minimum(right, node + length - 1)
                kind = mix64(((sums[hi + 1] - sums[lo]) * down[lo]) ^ ((hi - lo) << 20 | (node - lo)).astype(np.uint64))
                base = w_offs[doc]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc)), *(pa.array(x.view(np.int64)) for x in (mix64(h[node] + _seed(i + 100)), kind)),
                     *(pa.array(x - base) for x in (node, lo, hi))], names=[c.split()[0] for c in _PLACE.split(", ")])

    return docs.mapInArrow(run, _PLACE)


# ------------------------------------------------------------- comparisons --

def best_similarity(a: np.ndarray, na: int, b: np.ndarray, nb: int, length: int) -> float:
    """Largest Jaccard similarity of shingle sets of two intervals of
    ``length`` that contain the nodes a[na] and b[nb], over all intervals of a
    and those of b moved by up to two places against it; over all pairs of
    intervals if a shingle stands twice on a side."""
    first, last = max(0, na - length + 1), min(na, len(a) - length)
    low, high = max(0, nb - length + 1), min(nb, len(b) - length)
    if last < first or high < low:
        return 0.0
    order = np.argsort(b, kind="stable")
    ranked = b[order]
    once = (ranked[1:] != ranked[:-1]).all() and len(np.unique(a)) == len(a)
    if once:
        # no shingle twice: those in common are places of a whose place in b lies in the interval
        at = np.minimum(np.searchsorted(ranked, a), len(b) - 1)
        place = np.where(ranked[at] == a, order[at], -1)
        rows = np.lib.stride_tricks.sliding_window_view(place, length)[first:last + 1]
        most = 0
        for move in (0, -1, 1, -2, 2):
            to = np.arange(first, last + 1) - na + nb + move
            fits = (to >= low) & (to <= high)
            if fits.any():
                to = to[fits, None]
                most = max(most, int(((rows[fits] >= to) & (rows[fits] < to + length)).sum(axis=1).max()))
        return most / (2 * length - most)
    # otherwise which shingles each interval holds, and for all pairs of intervals how many in both
    ids = np.unique(np.concatenate([a, b]), return_inverse=True)[1]
    holds = []
    for own, lo, hi in ((ids[:len(a)], first, last), (ids[len(a):], low, high)):
        held = np.zeros((hi - lo + 1, int(ids.max()) + 1), np.float32)
        held[np.arange(hi - lo + 1)[:, None], np.lib.stride_tricks.sliding_window_view(own, length)[lo:hi + 1]] = 1
        holds.append(held)
    both = (holds[0] @ holds[1].T).astype(np.int64)
    sizes = [h.sum(axis=1).astype(np.int64) for h in holds]
    return float((both / (sizes[0][:, None] + sizes[1][None, :] - both)).max())


class _Context:
    """Shingles around a node, ready to be compared."""

    def __init__(self, tokens: np.ndarray, node: int, length: int, distinct: int | None = None):
        self.tokens, self.node, self.set = tokens, node, frozenset(tokens.tolist())
        self.aligned = np.zeros(2 * length - 1, np.uint32)
        self.aligned[length - 1 - node:length - 1 - node + len(tokens)] = tokens | 1          # zero: no shingle there
        # distinct shingles that any interval around the node has at least
        self.distinct = distinct or length
        if distinct is None and len(self.set) < len(tokens):
            self.distinct = min(len(set(tokens[s:s + length].tolist())) for s in range(len(tokens) - length + 1))


def similar(a: _Context, b: _Context, length: int, similarity: float) -> bool:
    """Whether some intervals of ``length`` shingles that contain the nodes are
    similar enough: first the one with the most aligned shingles in common,
    then all of them."""
    if len(a.set & b.set) < similarity * max(a.distinct, b.distinct):
        return False
    same = np.concatenate([[0], np.cumsum((a.aligned == b.aligned) & (a.aligned != 0))])
    s = int(np.argmax(same[length:] - same[:-length]))
    x, y = (c.aligned[s:s + length].tolist() for c in (a, b))
    if 0 not in x and 0 not in y and len(set(x) & set(y)) >= similarity * len(set(x) | set(y)):
        return True
    return best_similarity(a.tokens, a.node, b.tokens, b.node, length) >= similarity


class _Kinds:
    """Contexts of many kinds as the rows of a matrix, aligned at the node."""

    def __init__(self, tokens: list[np.ndarray], nodes, length: int):
        self.tokens, self.nodes, self.length = tokens, nodes, length
        sizes = np.array([len(t) for t in tokens], np.int64)
        self.first = length - 1 - np.array(nodes, np.int64)
        self.end = self.first + sizes
        flat = np.concatenate(tokens) if len(tokens) else np.zeros(0, np.uint32)
        offs = np.cumsum(sizes) - sizes
        row = np.repeat(np.arange(len(sizes)), sizes)
        column = np.arange(len(flat)) + np.repeat(self.first - offs, sizes)
        self.aligned = np.zeros((len(sizes), 2 * length - 1), np.uint32)
        self.aligned[row, column] = flat | 1                                                  # zero: no shingle there
        # distinct shingles that any interval around the node has at least
        self.distinct = np.full(len(sizes), length, np.int64)
        self.each = np.full((len(sizes), length), length, np.int16)                           # of each interval
        ranked = np.sort(self.aligned, axis=1)
        twice = np.flatnonzero(((ranked[:, 1:] == ranked[:, :-1]) & (ranked[:, 1:] != 0)).any(axis=1))
        self.once = np.ones(len(sizes), bool)
        self.once[twice] = False
        if len(twice):
            self.each[twice] = self._distinct(twice, flat, sizes, offs)
            self.distinct[twice] = self.each[twice].min(axis=1)
        self._contexts: dict[int, _Context] = {}

    def _distinct(self, rows, flat, sizes, offs) -> np.ndarray:
        length, width = self.length, self.aligned.shape[1]
        sizes, offs, first = sizes[rows], offs[rows], self.first[rows]
        row = np.repeat(np.arange(len(rows)), sizes)
        within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = within + np.repeat(first, sizes)
        order = np.lexsort((place, flat[within + np.repeat(offs, sizes)], row))
        row, place, token = row[order], place[order], flat[within + np.repeat(offs, sizes)][order]
        # a shingle's next place adds nothing to the intervals that hold both
        again = np.flatnonzero((row[1:] == row[:-1]) & (token[1:] == token[:-1]) & (place[1:] - place[:-1] < length))
        change = np.bincount(row[again] * (width + 1) + np.maximum(place[again + 1] - length + 1, 0), minlength=len(rows) * (width + 1))
        change -= np.bincount(row[again] * (width + 1) + place[again] + 1, minlength=len(rows) * (width + 1))
        found = length - np.cumsum(change.reshape(len(rows), width + 1), axis=1)[:, :length]
        start = np.arange(length)
        found[(start < first[:, None]) | (start + length > (first + sizes)[:, None])] = length
        return found

    def context(self, i: int) -> _Context:
        if i not in self._contexts:
            self._contexts[i] = _Context(self.tokens[i], int(self.nodes[i]), self.length, int(self.distinct[i]))
        return self._contexts[i]


def _best_sums(hit: np.ndarray, length: int) -> np.ndarray:
    sums = np.zeros((len(hit), hit.shape[1] + 1), np.int16)
    np.cumsum(hit, axis=1, out=sums[:, 1:])
    return sums[:, length:] - sums[:, :-length]


def _as_sets(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of the sets in each row of a and of b."""
    both = np.concatenate([a.astype(np.uint64) << np.uint64(1), (b.astype(np.uint64) << np.uint64(1)) | np.uint64(1)], axis=1)
    both.sort(axis=1)
    sizes = 1 + (both[:, 1:] != both[:, :-1]).sum(axis=1)
    union = 1 + (both[:, 1:] >> np.uint64(1) != both[:, :-1] >> np.uint64(1)).sum(axis=1)
    return (sizes - union) / union


def _at_most(a: np.ndarray, b: np.ndarray, kinds: "_Kinds", i: np.ndarray, of: "_Kinds", j: np.ndarray) -> np.ndarray:
    """Bound of the similarity of pairs of aligned rows: what an interval of one
    has in common with all of the other, against sets as small as they may be."""
    width, length = a.shape[1], kinds.length
    both = np.concatenate([a, b], axis=1)
    order = both.argsort(axis=1)
    ranked = np.take_along_axis(both, order, axis=1)
    new = np.ones(ranked.shape, bool)
    new[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    group = np.cumsum(new.ravel()) - 1
    in_a = np.bincount(group, weights=(order < width).ravel()) > 0
    in_b = np.bincount(group, weights=(order >= width).ravel()) > 0
    hit = np.zeros(both.shape, bool)
    np.put_along_axis(hit, order, (in_a & in_b)[group].reshape(both.shape) & (ranked != 0), axis=1)
    out, start = np.ones(len(a)), np.arange(length)
    for side, own, at, least in ((hit[:, :width], kinds, i, of.distinct[j]), (hit[:, width:], of, j, kinds.distinct[i])):
        each = own.each[at].astype(np.int64)
        common = np.minimum(_best_sums(side, length), each)
        common[(start < own.first[at][:, None]) | (start + length > own.end[at][:, None])] = 0
        out = np.minimum(out, (common / (each + least[:, None] - common)).max(axis=1))
    return out


def _moved(a: np.ndarray, b: np.ndarray, in_a: tuple, in_b: tuple, length: int) -> np.ndarray:
    """For pairs of aligned rows without repeated shingles: the most in common
    to an interval of a and one of b moved by up to two places against it."""
    width = a.shape[1]
    place = np.arange(width, dtype=np.uint64)
    both = np.concatenate([(a.astype(np.uint64) << np.uint64(16)) | place,
                           (b.astype(np.uint64) << np.uint64(16)) | np.uint64(1 << 15) | place], axis=1)
    both.sort(axis=1)
    token = both >> np.uint64(16)
    row, at = np.nonzero((token[:, 1:] == token[:, :-1]) & (token[:, 1:] != 0))
    p, q = ((both[row, at + k] & np.uint64((1 << 15) - 1)).astype(np.int64) for k in (0, 1))
    start, most = np.arange(length), np.zeros(len(a), np.int64)
    for move in (0, -1, 1, -2, 2):
        # the intervals of a that hold p while those of b hold q
        lo, hi = np.maximum(np.maximum(p, q - move) - length + 1, 0), np.minimum(p, q - move)
        fits = lo <= hi
        base = row[fits] * (width + 1)
        change = np.bincount(base + lo[fits], minlength=len(a) * (width + 1)) - np.bincount(base + hi[fits] + 1, minlength=len(a) * (width + 1))
        n = np.cumsum(change.reshape(len(a), width + 1), axis=1)[:, :length]
        to = start + move
        n[:, (to < 0) | (to >= length)] = 0
        n[(start < in_a[0][:, None]) | (start + length > in_a[1][:, None]) | (to < in_b[0][:, None]) | (to + length > in_b[1][:, None])] = 0
        most = np.maximum(most, n.max(axis=1))
    return most


ALIKE, OPEN = 1, 2


def _judged(kinds: _Kinds, x: np.ndarray, y: np.ndarray, similarity: float, of: _Kinds | None = None) -> np.ndarray:
    """For pairs of kinds (y of ``of`` if given): ALIKE if the aligned shingles
    already show it, 0 if they rule it out, else OPEN, for ``_alike`` to tell."""
    of, length = of or kinds, kinds.length
    out = np.zeros(len(x), np.int8)
    start = np.arange(length)
    for lo in range(0, len(x), PAIRS_AT_ONCE):
        i, j = x[lo:lo + PAIRS_AT_ONCE], y[lo:lo + PAIRS_AT_ONCE]
        a, b = kinds.aligned[i], of.aligned[j]
        there = b != 0
        common = _best_sums((a == b) & there, length)
        first, end = np.maximum(kinds.first[i], of.first[j]), np.minimum(kinds.end[i], of.end[j])
        common[(start < first[:, None]) | (start + length > end[:, None])] = -1
        best, common = common.argmax(axis=1), common.max(axis=1).astype(np.int64)
        # each place that differs puts at most two shingles into one of the sets only
        sizes = kinds.distinct[i] + of.distinct[j]
        differ = 2 * (length - common)
        alike = (common >= 0) & (sizes - differ >= similarity * (sizes + differ))
        found = np.where(alike, ALIKE, OPEN).astype(np.int8)
        # intervals with repeated shingles are compared as sets where most places are equal
        odd = np.flatnonzero(~alike & (common >= 0) & (sizes < 2 * length))
        if len(odd):
            at = best[odd, None] + start
            found[odd[_as_sets(a[odd[:, None], at], b[odd[:, None], at]) >= similarity]] = ALIKE
        odd = np.flatnonzero((found == OPEN) & (sizes < 2 * length))
        if len(odd):
            found[odd[_at_most(a[odd], b[odd], kinds, i[odd], of, j[odd]) < similarity - 1e-9]] = 0
        # at most one edit fits in, so that shingles in common are moved little; repeated shingles may be anywhere
        plain = np.flatnonzero(~alike & (sizes == 2 * length))
        if len(plain):
            a, b = a[plain], b[plain]
            width = a.shape[1]
            hit = a == b
            for shift in range(1, MAX_SHIFT + 1):
                hit[:, shift:] |= b[:, shift:] == a[:, :width - shift]
                hit[:, :width - shift] |= b[:, :width - shift] == a[:, shift:]
            most = _best_sums(hit & there[plain], length).max(axis=1)
            near = most >= _least(sizes[plain], similarity)
            found[plain[~near]] = 0
            once = near & kinds.once[i[plain]] & of.once[j[plain]]
            if once.any():
                k = plain[once]
                most = _moved(a[once], b[once], (kinds.first[i[k]], kinds.end[i[k]]), (of.first[j[k]], of.end[j[k]]), length)
                found[k] = np.where(most / (2 * length - most) >= similarity, ALIKE, 0)
        out[lo:lo + PAIRS_AT_ONCE] = found
    return out


def _least(sizes, similarity: float):
    """Shingles that sets of that similarity and of so many in all have in common at least."""
    return similarity / (1 + similarity) * sizes - 1e-9


def _alike(a: _Context, b: _Context, length: int, similarity: float) -> bool:
    return len(a.set & b.set) >= _least(a.distinct + b.distinct, similarity) and similar(a, b, length, similarity)


class _Postings:
    """For every shingle of a group the kinds that hold it."""

    def __init__(self, tokens: list[np.ndarray]):
        sets = [np.unique(t) for t in tokens]
        self.size = len(tokens)
        self.offs = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
        _, self.of = np.unique(np.concatenate(sets), return_inverse=True)
        self.kinds = np.repeat(np.arange(self.size), np.diff(self.offs))[np.argsort(self.of, kind="stable")]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(self.of))])

    def shared(self, x: int) -> np.ndarray:
        """Number of shingles that each kind has in common with kind x."""
        ids = self.of[self.offs[x]:self.offs[x + 1]]
        lists = [self.kinds[a:b] for a, b in zip(self.starts[ids].tolist(), self.starts[ids + 1].tolist()) if b - a > 1]
        return np.bincount(np.concatenate(lists), minlength=self.size) if lists else np.zeros(self.size, np.int64)


def linked_kinds(tokens: list[np.ndarray], nodes: list[int], length: int, similarity: float, labels: list[int] | None = None,
                 sides: list[int] | None = None) -> list[tuple[int, int]]:
    """Edges of a spanning forest over the kinds of a group whose passages are
    similar enough.  All pairs are looked at (with ``sides``, those of different
    sides), those already joined, by equal ``labels`` too, are not compared again."""
    return linked_groups(tokens, nodes, np.array([0, len(tokens)]), length, similarity, labels, sides)


def linked_groups(tokens: list[np.ndarray], nodes: list[int], cuts: np.ndarray, length: int, similarity: float,
                  labels=None, sides=None) -> list[tuple[int, int]]:
    """``linked_kinds`` of many groups at once; group k is cuts[k] to cuts[k + 1].
    Each round takes one kind of every group against all after it."""
    if len(tokens) < 2:
        return []
    kinds = _Kinds(tokens, nodes, length)
    group = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    root = np.arange(len(tokens))
    if labels is not None:
        order = np.lexsort((labels, group))
        ranked = np.array(labels)[order]
        new = np.append(True, (ranked[1:] != ranked[:-1]) | (group[order][1:] != group[order][:-1]))
        root[order] = np.cumsum(new) - 1
    side = None
    if sides is not None:
        side = np.array(sides)
        if (side == side[0]).all():
            side = None
        else:
            # groups of one side only are compared whole
            mixed = np.maximum.reduceat(side, cuts[:-1]) != np.minimum.reduceat(side, cuts[:-1])
            side = np.where(mixed[group], side, np.arange(len(side)))
    edges = []

    def join(x: np.ndarray, y: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        found = _judged(kinds, x, y, similarity)
        for k in np.flatnonzero(found).tolist():
            i, j = int(x[k]), int(y[k])
            if root[i] != root[j] and (found[k] == ALIKE or _alike(kinds.context(i), kinds.context(j), length, similarity)):
                edges.append((i, j))
                part = root[lo[k]:hi[k]]
                part[part == root[j]] = root[i]

    sizes = np.diff(cuts)
    few = sizes <= FEW_KINDS
    begin, size = cuts[:-1][few], sizes[few]
    for r in range(int(size.max(initial=0)) - 1):
        begin, size = begin[size > r + 1], size[size > r + 1]
        rest = size - r - 1
        lo = np.repeat(begin, rest)
        x = lo + r
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(rest) - rest, rest)
        keep = root[x] != root[y]
        if side is not None:
            keep &= side[x] != side[y]
        join(x[keep], y[keep], lo[keep], np.repeat(begin + size, rest)[keep])
    for lo, hi in zip(cuts[:-1][~few].tolist(), cuts[1:][~few].tolist()):
        postings = _Postings(tokens[lo:hi])
        for x in range(lo, hi - 1):
            rest = np.flatnonzero(root[x + 1:hi] != root[x]) + x + 1
            if side is not None:
                rest = rest[side[rest] != side[x]]
            if len(rest):
                # shingles in common, wherever they are
                rest = rest[postings.shared(x - lo)[rest - lo] >= _least(kinds.distinct[x] + kinds.distinct[rest], similarity)]
            if len(rest):
                ends = np.full((2, len(rest)), [[lo], [hi]])
                join(np.full(len(rest), x), rest, *ends)
    return edges


def rare_shingles(own: _Context, heavy: np.ndarray, length: int, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Rarest shingles of the intervals of ``length``, as many as the least
    overlap requires: similar intervals without repeated shingles share one of
    the first kind, any similar intervals one of the second.  Shingles are
    ordered by hash, those of ``heavy`` (sorted by frequency) after the others."""
    t = own.tokens
    order = mix64(t.astype(np.uint64)) >> np.uint64(8)
    if len(heavy):
        by_value = np.argsort(heavy)
        at = np.minimum(np.searchsorted(heavy, t, sorter=by_value), len(heavy) - 1)
        hit = heavy[by_value[at]] == t
        order[hit] = np.uint64(1 << 60) + by_value[at][hit].astype(np.uint64)
    if own.distinct == length:
        windows = np.lib.stride_tricks.sliding_window_view(order, length)
        ranked = np.argsort(windows, axis=1) + np.arange(len(windows))[:, None]
        narrow = length - int(np.ceil(2 * length * similarity / (1 + similarity) - 1e-9)) + 1
        wide = length - int(np.ceil(length * similarity - 1e-9)) + 1
        return np.unique(t[ranked[:, :narrow]]), np.unique(t[ranked[:, :wide]])
    out = set()
    for s in range(len(t) - length + 1):
        rank = sorted(set(zip(order[s:s + length].tolist(), t[s:s + length].tolist())))
        out.update(x for _, x in rank[:len(rank) - int(np.ceil(len(rank) * similarity - 1e-9)) + 1])
    return np.zeros(0, np.uint32), np.array(sorted(out), np.uint32)


_KIND = "g long, signature long, kind long, row long, node int, tokens binary"
_PAIR = "signature long, kind_a long, kind_b long, a long, b long"


def _compare(kinds: DataFrame, tasks: int, length: int, similarity: float) -> DataFrame:
    """Verified pairs of kinds that share g: (signature, kind, row) of both."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("g", "ascending"), ("kind", "ascending")])
        g = table.column("g").to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1], [True]]))
        tokens = [np.frombuffer(x, np.uint32) for x in table.column("tokens").to_pylist()]
        node, label, side, signature, kind, row = (
            table.column(c).to_numpy() for c in ("node", "label", "side", "signature", "kind", "row"))
        x, y = np.array(linked_groups(tokens, node, cuts, length, similarity, label, side), np.int64).reshape(-1, 2).T
        return pa.table([pa.array(c) for c in (signature[x], kind[x], kind[y], row[x], row[y])],
                        names=["signature", "kind_a", "kind_b", "a", "b"])

    return (kinds.withColumn("task", F.pmod(F.xxhash64("g"), F.lit(tasks))).groupBy("task")
            .applyInArrow(run, _PAIR))


def _heavy_shingles(kinds: DataFrame, sizes: DataFrame, max_kinds: int) -> DataFrame:
    """(heavy_g, heavy): shingles in many kinds of a group, by frequency; at most
    64 times as many as a kind has."""
    def run(batches):
        held: list = []
        rows = 0

        def added_up():
            g, token, n = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((token, g))
            g, token, n = g[order], token[order], n[order]
            first = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (token[1:] != token[:-1])))
            return g[first], token[first], np.add.reduceat(n, first)

        def often():
            g, token, n = added_up()
            head = np.flatnonzero(token < 0)           # the first of each group: its kinds here
            kinds_here = np.repeat(n[head], np.diff(np.append(head, len(g))))
            keep = (token >= 0) & (n * 256 >= kinds_here) & (n > 1)
            return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (g, token, n)], names=["heavy_g", "token", "n"])

        for batch in batches:
            lists = [np.append(-1, np.unique(np.frombuffer(x, np.uint32)).astype(np.int64)) for x in batch.column(1).to_pylist()]
            if lists:
                token = np.concatenate(lists)
                held.append((np.repeat(batch.column(0).to_numpy(), [len(x) for x in lists]), token, np.ones(len(token), np.int64)))
                rows += len(token)
            if rows > HELD_ROWS:
                held = [added_up()]
                rows = len(held[0][0])
                if rows > HELD_ROWS // 2:
                    yield often()
                    held, rows = [], 0
        if held:
            yield often()

    # a task sends only shingles that are frequent in it: any common order of a
    # group's shingles gives the same pairs, frequent ones last give fewer parts
    counts = (kinds.select("g", "tokens").mapInArrow(run, "heavy_g long, token long, n long")
              .groupBy("heavy_g", "token").agg(F.sum("n").alias("n")))
    often = counts.join(sizes, F.col("heavy_g") == F.col("g")).filter(F.col("n") > F.greatest(F.lit(max_kinds / 4), F.col("count") / 64))
    return often.groupBy("heavy_g").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "token"))), lambda x: x["token"]).alias("heavy"))


_MARKED = "g long, signature long, kind long, row long, node int, tokens binary, label long, kind_b long, b long"


def _against_pivots(kinds: DataFrame, length: int, similarity: float) -> DataFrame:
    """The kinds of big groups, each compared with a few pivots of its group.
    ``label`` tells which are joined already (the smallest pivot reached, or the
    kind itself), (kind_b, b) is the pivot it is linked to."""
    pivots = (kinds.groupBy("g", F.pmod("kind", F.lit(PIVOTS)).alias("part"))
              .agg(F.min(F.struct("kind", "row", "node", "tokens")).alias("p"))
              .groupBy(F.col("g").alias("in_g")).agg(F.sort_array(F.collect_list("p")).alias("pivots")))
    joined = kinds.join(written(pivots, "pas-pivots"), F.col("g") == F.col("in_g"))

    def run(batches):
        known: dict = {}
        for batch in batches:
            g, kind, node = (batch.column(k).to_numpy() for k in (0, 2, 4))
            raw = batch.column(5).to_pylist()
            label, near, near_row = kind.tolist(), [None] * len(raw), [None] * len(raw)
            for own_g in np.unique(g).tolist():
                rows = np.flatnonzero(g == own_g)
                if own_g not in known:
                    known.clear()
                    found = batch.column(6)[int(rows[0])].as_py()
                    tokens, nodes = [np.frombuffer(p["tokens"], np.uint32) for p in found], [p["node"] for p in found]
                    root = list(range(len(found)))
                    for x, y in linked_kinds(tokens, nodes, length, similarity):
                        root = [min(root[x], root[y]) if r in (root[x], root[y]) else r for r in root]
                    known[own_g] = found, _Kinds(tokens, nodes, length), root
                found, pivot, root = known[own_g]
                own = _Kinds([np.frombuffer(raw[k], np.uint32) for k in rows.tolist()], node[rows], length)
                at = np.full(len(rows), -1)
                for i, p in enumerate(found):
                    at[kind[rows] == p["kind"]] = i
                pivots_here = at >= 0
                for i in range(len(found)):
                    rest = np.flatnonzero(at < 0)
                    for k, how in zip(rest.tolist(), _judged(own, rest, np.full(len(rest), i), similarity, pivot).tolist()):
                        if how == ALIKE or how == OPEN and _alike(own.context(k), pivot.context(i), length, similarity):
                            at[k] = i
                for k, i, is_pivot in zip(rows.tolist(), at.tolist(), pivots_here.tolist()):
                    if i >= 0:
                        label[k] = found[root[i]]["kind"]
                        to = i if not is_pivot else root[i] if root[i] != i else None
                        if to is not None:
                            near[k], near_row[k] = found[to]["kind"], found[to]["row"]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6], *(pa.array(x, pa.int64()) for x in (label, near, near_row))], names=[c.split()[0] for c in _MARKED.split(", ")])

    return joined.select("g", "signature", "kind", "row", "node", "tokens", "pivots").mapInArrow(run, _MARKED)


_KEYED = "g long, signature long, kind long, row long, node int, tokens binary, label long, keys array<long>, wide array<long>"


def _keyed(kinds: DataFrame, heavy: DataFrame, length: int, similarity: float) -> DataFrame:
    """``keys`` are the parts of its group in which a kind meets all it may be
    similar to: by narrow prefixes among kinds without repeated shingles (others
    have none), by ``wide`` ones else."""
    joined = kinds.join(written(heavy, "pas-heavy"), F.col("g") == F.col("heavy_g"), "left")

    def run(batches):
        known: dict = {}
        for batch in batches:
            g, node, raw = (batch.column(k).to_pylist() for k in (0, 4, 5))
            keys, wide = [], []
            for k in range(batch.num_rows):
                if g[k] not in known:
                    known.clear()
                    known[g[k]] = np.array(batch.column(7)[k].as_py(), np.int64).astype(np.uint32)
                own = _Context(np.frombuffer(raw[k], np.uint32), node[k], length)
                salt = mix64(np.array([g[k]], np.int64).view(np.uint64))[0]
                for column, rare, i in zip((keys, wide), rare_shingles(own, known[g[k]], length, similarity), (300, 301)):
                    column.append((mix64(rare.astype(np.uint64) ^ _seed(i)) ^ salt).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], *(pa.array(x, pa.list_(pa.int64())) for x in (keys, wide))],
                                             names=[c.split()[0] for c in _KEYED.split(", ")])

    return joined.select("g", "signature", "kind", "row", "node", "tokens", "label",
                         F.coalesce("heavy", F.array().cast("array<long>")).alias("heavy")).mapInArrow(run, _KEYED)


def _beside(kinds: DataFrame, size: int) -> DataFrame:
    """Kinds of groups that pivots joined but for at most ``size`` others, dealt
    over blocks: the others (side 0) among themselves and beside every block of
    about ``size`` joined ones (side 1).  As many rows as kinds, twice at most
    in large groups, since a copy of the others stands for a whole block."""
    blocks = F.ceil((F.col("count") - F.col("others")) / size).cast("int")
    own = F.pmod(F.xxhash64("kind", "g"), blocks).cast("int")
    joined = F.col("label") == F.col("most")
    dealt = kinds.withColumn("side", joined.cast("int")).withColumn(
        "block", F.explode(F.when(joined, F.array(own)).otherwise(F.sequence(F.lit(-1), blocks - 1))))
    return dealt.withColumn("g", F.xxhash64("g", "block"))


def _in_blocks(kinds: DataFrame, size: int) -> DataFrame:
    """Kinds of parts of any size (column count), dealt over groups of about two
    blocks of ``size`` kinds, one for each pair of blocks of a part; ``side`` is
    the block, so that blocks are compared with themselves once."""
    blocks = F.ceil(F.col("count") / size).cast("int")
    own = F.pmod(F.xxhash64("kind", "g"), blocks).cast("int")
    dealt = kinds.withColumn("side", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.withColumn("g", F.xxhash64("g", F.least("side", "other"), F.greatest("side", "other"))).drop("other", "count")


_COMPARED = ["g", "signature", "kind", "row", "node", "tokens", "label", "side"]


def _split(kinds: DataFrame, length: int, similarity: float, max_kinds: int) -> DataFrame:
    """Kinds of big groups (g, label, ...), dealt over parts by an exact prefix
    filter; only parts that hold kinds not joined yet go on, the large ones as
    pairs of blocks."""
    sizes = written(kinds.groupBy("g").count(), "pas-split-sizes")
    marked = written(_keyed(kinds, _heavy_shingles(kinds, sizes, max_kinds), length, similarity), "pas-keyed")
    odd = F.size("keys") == 0
    with_odd = marked.filter(odd).select("g").distinct()
    parts = marked.select("signature", "kind", "label", F.lit(True).alias("fits"), F.explode("keys").alias("key")).union(
        marked.join(with_odd, "g", "left_semi").select("signature", "kind", "label", odd.alias("fits"), F.explode("wide").alias("key")))
    open_ = written(parts.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.max("fits").alias("fits"),
                                             F.count(F.lit(1)).alias("count"))
                    .filter("x <> y AND fits").select("key", "count"), "pas-open")
    wanted = parts.select(F.col("signature").alias("s"), F.col("kind").alias("k"), "key").join(open_, "key")
    split = marked.drop("g").join(wanted, (F.col("signature") == F.col("s")) & (F.col("kind") == F.col("k"))).select(
        F.col("key").alias("g"), "signature", "kind", "row", "node", "tokens", "label", "count")
    small = split.filter(F.col("count") <= max_kinds).drop("count").withColumn("side", F.lit(0))
    block = max(1, max_kinds // 2)
    return small.select(_COMPARED).union(_in_blocks(split.filter(F.col("count") > max_kinds), block).select(_COMPARED))


def _verified(kinds: DataFrame, length: int, similarity: float, max_kinds: int) -> DataFrame:
    """Edges between kinds of a group (column g).  Groups up to ``max_kinds``
    are compared pair by pair.  Larger ones are compared with pivots, which
    joins near copies at once.  Where all are joined nothing is left to compare;
    where few are not, those meet each other and every joined one; else the
    group is split by prefixes."""
    def tasks(n: int) -> int:
        return max(1, -(-int(n or 0) // TASK_KINDS))

    sizes = written(kinds.groupBy("g").count().filter("count > 1"), "pas-sizes")
    large = sizes.filter(F.col("count") > max_kinds)
    total = sizes.filter(F.col("count") <= max_kinds).agg(F.sum("count")).first()[0]
    plain = kinds.withColumn("label", F.col("kind")).withColumn("side", F.lit(0))
    found = _compare(plain.join(sizes.filter(F.col("count") <= max_kinds), "g", "left_semi"), tasks(total), length, similarity)
    if large.first() is None:
        return found
    marked = written(_against_pivots(kinds.join(large, "g", "left_semi"), length, similarity), "pas-marked")
    found = found.union(marked.filter("b IS NOT NULL").select(
        "signature", F.col("kind").alias("kind_a"), "kind_b", F.col("row").alias("a"), "b"))
    groups = written(marked.groupBy("g", "label").count().groupBy("g").agg(
        F.sum("count").alias("count"), F.max(F.struct("count", "label")).alias("top")).select(
        "g", "count", F.col("top.label").alias("most"), (F.col("count") - F.col("top.count")).alias("others")).filter("others > 0"), "pas-groups")
    block = max(1, max_kinds // 2)
    marked = marked.drop("kind_b", "b")
    dealt = _beside(marked.join(groups.filter(F.col("others") <= block), "g"), block).select(_COMPARED)
    many = groups.filter(F.col("others") > block)
    if many.first() is not None:
        dealt = dealt.union(_split(marked.join(many, "g", "left_semi"), length, similarity, max_kinds))
    dealt = written(dealt, "pas-split")
    return found.union(_compare(dealt, tasks(dealt.count()), length, similarity))


# --------------------------------------------------------------- documents --

def passage_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS,
                    passage: int = PASSAGE_WORDS, similarity: float = SIMILARITY, functions: int = FUNCTIONS,
                    max_kinds: int = MAX_KINDS) -> DataFrame:
    """(key, n_shared, class_id) per row: compact windows verified to hold a
    passage that other rows have too, and the smallest key reachable over such
    passages (its own without any).

    Null, empty and short texts share nothing; repeated rows have one result;
    rows with a null key take part but name no class unless all its keys are
    null; an empty table gives an empty result; further columns are not read.
    """
    length = passage - shingle + 1
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("key", "text"))
    texts = rows.select("row", "text")
    cut = _windows(texts, shingle, passage, functions)
    # a table of its own, so that Spark may split a frequent signature's rows in the join
    known = written(_signatures(texts, shingle, passage, functions).groupBy("signature").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("signature"), "pas-known")
    places = written(cut.join(known, "signature", "left_semi"), "pas-places")
    kinds = written(places.groupBy("signature", "kind").agg(
        F.max("row").alias("top"), F.min(F.struct("row", "node", "lo", "hi")).alias("at"))
        .select("signature", "kind", (F.col("top") != F.col("at.row")).alias("shared"), "at.*"), "pas-kinds")
    several = kinds.groupBy("signature").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("signature")
    wanted = (kinds.join(several, "signature", "left_semi").groupBy(F.col("row").alias("in_row"))
              .agg(F.collect_list(F.struct("signature", "kind", "node", "lo", "hi")).alias("wanted")))
    joined = texts.join(wanted, texts.row == wanted.in_row).select("row", "text", "wanted")

    def extract(batches):
        for part, data, offs in text_blocks(batches, "text"):
            h, w_offs, _ = _shingles(data, offs, shingle)
            tokens = (h >> np.uint64(32)).astype(np.uint32)
            places = part.column(2)
            sizes = np.diff(places.offsets.to_numpy())
            signature, kind, node, lo, hi = (x.to_numpy() for x in places.flatten().flatten())
            row, base = np.repeat(part.column(0).to_numpy(), sizes), np.repeat(w_offs[:-1], sizes)
            for k in range(0, len(row), TASK_KINDS):
                at = slice(k, k + TASK_KINDS)
                n = hi[at] - lo[at] + 1
                offset = np.append(0, np.cumsum(n))
                held = tokens[np.arange(offset[-1]) + np.repeat(base[at] + lo[at] - offset[:-1], n)]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c[at]) for c in (signature, signature, kind, row)), pa.array((node[at] - lo[at]).astype(np.int32)),
                     pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((4 * offset).astype(np.int32)), pa.py_buffer(held)])],
                    names=["g", "signature", "kind", "row", "node", "tokens"])

    # copies of a row bring the same kind twice
    contexts = written(joined.dropDuplicates(["row"]).mapInArrow(extract, _KIND), "pas-contexts")
    pairs = written(_verified(contexts, length, similarity, max_kinds), "pas-pairs")
    alike = kinds.filter("shared").select("signature", "kind").union(
        pairs.filter("a <> b").select("signature", F.col("kind_a").alias("kind"))).union(
        pairs.filter("a <> b").select("signature", F.col("kind_b").alias("kind"))).distinct()
    shared = places.join(alike, ["signature", "kind"], "left_semi").groupBy("row").agg(F.count(F.lit(1)).alias("n_shared"))
    members = (places.join(kinds.filter("shared").select("signature", "kind", F.col("row").alias("b")), ["signature", "kind"])
               .select(F.col("row").alias("a"), "b"))
    edges = members.union(pairs.select("a", "b")).filter("a <> b").distinct()
    nodes = connected_components(written(edges, "pas-edges"))
    names = rows.select("key", "row")
    placed = (names.join(nodes, names.row == nodes.node, "left")
              .select("key", "row", F.coalesce("component", "row").alias("component")))
    placed = written(placed, "pas-placed")
    least = placed.groupBy("component").agg(F.min("key").alias("class_id"))
    return (placed.join(least, "component").join(shared, "row", "left")
            .select(F.col("key").alias(key), F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared"), "class_id"))
