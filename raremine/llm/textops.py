"""Vectorised text helpers for Arrow batches: whole texts as one UTF-8 byte
array with offsets, words as byte spans, and 64-bit hashes of spans.

Separators are ASCII in every word pattern used here, and no byte of a
multi-byte UTF-8 character is ASCII, so byte-wise splitting is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_MULT = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """256 flags, true for the bytes of the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        table[lo:hi + 1] = True
    return table


#: Words of `[^\x20\x09-\x0D]+`.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Words of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after lower-casing A-Z).
LETTERS = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values (null: empty) and n + 1 offsets."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not (pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)):
        col = col.cast(pa.large_binary() if pa.types.is_binary(col.type) else pa.large_string())
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_large_binary(col.type) else "")
    n = len(col)
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[col.offset:col.offset + n + 1] if n else np.zeros(1, np.int64)
    if data is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def text_blocks(batches, column: str = "text", block_bytes: int = BLOCK_BYTES):
    """Slices of the Arrow batches holding about ``block_bytes`` of text each
    (a longer text makes a block of its own): (slice, bytes, offsets)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        data, offs = column_bytes(batch.column(batch.schema.get_field_index(column)))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = int(np.searchsorted(offs, offs[lo] + block_bytes, side="right")) - 1
            hi = min(max(hi, lo + 1), n)
            yield batch.slice(lo, hi - lo), data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
            lo = hi


def word_spans(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray):
    """Start and end byte of every word, and n + 1 word offsets per text."""
    w = is_word[data]
    if not w.any():
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    before = np.empty_like(w)
    before[0] = False
    before[1:] = w[:-1]
    before[offs[:-1][offs[:-1] < len(w)]] = False
    after = np.empty_like(w)
    after[-1] = False
    after[:-1] = w[1:]
    last = offs[1:] - 1
    after[last[last >= 0]] = False
    start = np.flatnonzero(w & ~before)
    end = np.flatnonzero(w & ~after) + 1
    return start, end, np.searchsorted(start, offs)


class _TaskCache(dict):
    """Tables kept within a task; shipped empty."""

    def __reduce__(self):
        return _TaskCache, ()


_powers = _TaskCache()


def _power_tables(n: int):
    """Powers of an odd multiplier and of its inverse, modulo 2^64."""
    if _powers.get("n", 0) < n:
        size = max(n, BLOCK_BYTES + 1)
        inv = pow(_MULT, -1, 1 << 64)
        up = np.full(size, _MULT, dtype=np.uint64)
        down = np.full(size, inv, dtype=np.uint64)
        up[0] = down[0] = 1
        _powers.update(n=size, up=np.cumprod(up), down=np.cumprod(down),
                       code=mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT)))
    return _powers["up"], _powers["down"], _powers["code"]


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span: prefix sums of a polynomial over
    scrambled byte codes, brought to a common position and finalised."""
    n = len(data)
    up, down, code = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(code[data] * up[:n], out=sums[1:])
    h = (sums[end] - sums[start]) * down[start]
    return mix64(h ^ ((end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def gram_hash(tokens: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k tokens (length n - k + 1, or empty)."""
    n = len(tokens) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * np.uint64(_MULT) + tokens[j:j + n]
    return mix64(h)


def union_lengths(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Flags over [0, n) of positions covered by at least one [start, end)."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, start, 1)
    np.add.at(d, end, -1)
    return np.cumsum(d[:-1]) > 0
