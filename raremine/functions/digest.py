"""md5 of many short texts at once, for tasks that need a digest of every
(fold, row): numpy adds up the same digests as ``functions.numeric.hash_key``
without a text and a hex string for each of them."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark import cloudpickle

# functions of this module run in tasks of executors that lack the repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Digests worked on at once: their words stay in a core's cache.
_LANE = 4096
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_ADD = [int(abs(math.sin(i + 1)) * 2 ** 32) for i in range(64)]
_TURN = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
_WORD = [*range(16), *((5 * i + 1) % 16 for i in range(16)), *((3 * i + 5) % 16 for i in range(16)), *(7 * i % 16 for i in range(16))]


def md5_words(words: list, n: int) -> tuple[np.ndarray, ...]:
    """The four words of the md5 of ``n`` padded messages of equally many blocks;
    ``words`` are their little-endian words, an array or one int for all."""
    state = [np.full(n, v, np.uint32) for v in _START]
    f, t = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for block in range(0, len(words), 16):
        a, b, c, d = (v.copy() for v in state)
        for i in range(64):
            if i < 16:
                np.bitwise_xor(c, d, out=f)
                np.bitwise_and(f, b, out=f)
                np.bitwise_xor(f, d, out=f)
            elif i < 32:
                np.bitwise_xor(b, c, out=f)
                np.bitwise_and(f, d, out=f)
                np.bitwise_xor(f, c, out=f)
            elif i < 48:
                np.bitwise_xor(b, c, out=f)
                np.bitwise_xor(f, d, out=f)
            else:
                np.bitwise_not(d, out=f)
                np.bitwise_or(f, b, out=f)
                np.bitwise_xor(f, c, out=f)
            np.add(f, a, out=f)
            word = words[block + _WORD[i]]
            if isinstance(word, np.ndarray):
                np.add(f, word, out=f)
                word = 0
            np.add(f, np.uint32((_ADD[i] + word) & 0xFFFFFFFF), out=f)
            np.left_shift(f, np.uint32(_TURN[i]), out=t)
            np.right_shift(f, np.uint32(32 - _TURN[i]), out=f)
            np.bitwise_or(f, t, out=f)
            np.add(f, b, out=a)
            a, b, c, d = d, a, b, c
        for v, x in zip(state, (a, b, c, d)):
            np.add(v, x, out=v)
    return tuple(state)


def _padded(texts: Sequence[bytes], room: int) -> np.ndarray:
    """Messages of one number of blocks, each with ``room`` bytes left free before it."""
    size = np.array([len(t) for t in texts])
    width = (int(size.max()) + room + 8) // 64 * 64 + 64
    out = np.zeros((len(texts), width), np.uint8)
    held = np.frombuffer(b"".join(texts), np.uint8)
    row = np.repeat(np.arange(len(texts)), size)
    out[row, room + np.arange(len(held)) - np.repeat(np.cumsum(size) - size, size)] = held
    out[np.arange(len(texts)), room + size] = 0x80
    out[:, -8:] = ((size + room) * 8).astype("<u8")[:, None].view(np.uint8)
    return out.view("<u4")


def fold_digests(seed, folds: Sequence[int], keys: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, tuple]]:
    """(folds, rows, words) of the md5 of ``seed|fold|key`` for every fold and
    key, a few thousand at once; a null key is left out with its ``|``."""
    texts = [b"" if k is None else b"|" + k.encode() for k in keys]
    fronts: dict[int, list] = {}
    for f in folds:
        fronts.setdefault(len(f"{seed}|{f}"), []).append(f)
    for room, members in fronts.items():
        n_blocks = np.array([(len(t) + room + 8) // 64 for t in texts])
        for blocks in np.unique(n_blocks):
            of_blocks = np.flatnonzero(n_blocks == blocks)
            for lo in range(0, len(of_blocks), _LANE):
                rows = of_blocks[lo:lo + _LANE]
                padded = _padded([texts[r] for r in rows], room)
                heads = np.zeros((len(members), -(-room // 4) * 4), np.uint8)
                heads[:, :room] = np.frombuffer("".join(f"{seed}|{f}" for f in members).encode(), np.uint8).reshape(len(members), room)
                heads = heads.view("<u4")
                at_once = max(1, _LANE // len(rows))
                # words that all rows share stay one number, the others repeat for every fold
                same = (padded == padded[0]).all(axis=0)
                tail = [int(w[0]) if s else np.tile(w, at_once) for w, s in zip(padded.T, same)]
                for first in range(0, len(members), at_once):
                    some = np.array(members[first:first + at_once])
                    n = len(some) * len(rows)
                    words = [w if isinstance(w, int) else w[:n] for w in tail]
                    for j, head in enumerate(heads[first:first + at_once].T):
                        words[j] = np.repeat(head, len(rows)) | (np.uint32(words[j]) if isinstance(words[j], int) else words[j])
                    yield np.repeat(some, len(rows)), np.tile(rows, len(some)), md5_words(words, n)


def first_digits(words: tuple, digits: int = 13) -> np.ndarray:
    """The first hex digits (at most 16) of digests, as numbers."""
    a, b = (x.byteswap().astype(np.uint64) for x in words[:2])
    return (a << np.uint64(32) | b) >> np.uint64(64 - 4 * digits)


def hex_digests(words: tuple) -> np.ndarray:
    """Digests as texts of 32 hex digits (bytes)."""
    raw = np.stack(words, axis=1).astype("<u4").view(np.uint8)
    digits = np.frombuffer(b"0123456789abcdef", np.uint8)
    return np.ascontiguousarray(np.stack([digits[raw >> 4], digits[raw & 15]], axis=2)).reshape(len(raw), 32).view("S32").ravel()
