"""Best-fit packing of token sequences by hierarchical residual rounds.

Documents become pieces of at most ``capacity`` tokens.  Pieces are dealt into
groups of bounded size; each group packs its pieces best-fit, longest first.
Bins that are nearly full are emitted.  The underfull rest are the items of the
next round, in fewer groups (a tree), and so on until one group is left or a
round in as many groups saves no bin.  A bin carries its pieces along (each has a token at
least, so a bin holds ``capacity`` pieces at most).
"""

from __future__ import annotations

import base64
import json
import zlib
from array import array
from bisect import bisect_left, insort
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raremine.llm.store import written

CAPACITY, END_ID = 1024, 2
#: Pieces or bins packed by one task, groups of one round merged in the next,
#: free tokens up to which a bin counts as nearly full.
GROUP_ROWS, FAN_IN, SLACK = 50_000, 8, 8

_PIECE = "struct<id: {key}, piece: int, start: long, length: long, crc: long>"


def public_encoder(rank_file: str | None = None, vocabulary: str | None = None):
    """A function text -> ids for the byte-level BPE vocabulary, as the
    ``tokenizers`` library gives them for ``byte_bpe_50k.json`` without added
    special tokens: the strings of its added tokens inside a text are one id
    each.  The merges run on the rank file, which holds the same vocabulary, in
    a fifth of that library's time."""
    import public_tokenizers
    import tiktoken

    with open(vocabulary or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    with open(rank_file or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return partial(encoding.encode, allowed_special=set(added), disallowed_special=())


def cut(ids, capacity: int):
    """(start, end) of the pieces of a token list: all of ``capacity`` but the
    first, which takes what is left over."""
    n = len(ids)
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(a, a + capacity) for a in range(first, n, capacity)]


def token_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                 rank_file: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """(key, piece, start, length, crc) per piece of every row; a null text is
    empty and makes one piece that holds the end id alone."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))

    def run(batches):
        encode = public_encoder(rank_file, vocabulary)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                where, out = [], ([], [], [], [])
                for i, value in enumerate(part.column(1)):
                    ids = array("I", encode(value.as_py() or ""))
                    ids.append(END_ID)
                    view = memoryview(ids).cast("B")
                    for p, (a, b) in enumerate(cut(ids, capacity)):
                        where.append(i)
                        for column, v in zip(out, (p, a, b - a, zlib.crc32(view[4 * a:4 * b]))):
                            column.append(v)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(where, pa.int64())), pa.array(out[0], pa.int32()),
                     *[pa.array(c, pa.int64()) for c in out[1:]]], names=["id", "piece", "start", "length", "crc"])

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, crc long")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers: items by falling size (ties by number),
    each into the open bin with the least room that still holds it."""
    rooms: list[int] = []                    # distinct free sizes of open bins, ascending
    open_bins: dict[int, list[list[int]]] = {}
    bins = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            members = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(at)
        else:
            room, members = capacity, []
            bins.append(members)
        members.append(i)
        if room > size:
            if room - size not in open_bins:
                insort(rooms, room - size)
                open_bins[room - size] = []
            open_bins[room - size].append(members)
    return bins


def _pack_round(items: DataFrame, level: int, capacity: int, kind: str) -> DataFrame:
    """One round: ``items`` (g, fill, pieces, name) packed within each group g."""
    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("name", "ascending")])
        g = table.column("g")[0].as_py()
        fills = table.column("fill").to_pylist()
        bins = best_fit(fills, capacity)
        order = pa.array([i for b in bins for i in b], pa.int64())
        lists = table.column("pieces").combine_chunks().take(order)
        ends, at = [0], 0
        sizes = lists.value_lengths().to_pylist()
        it = iter(sizes)
        for b in bins:
            for _ in b:
                at += next(it)
            ends.append(at)
        pieces = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lists.flatten())
        name = [(level << 52) | (g << 32) | i for i in range(len(bins))]
        return pa.table([pa.array([sum(fills[i] for i in b) for b in bins], pa.int64()), pieces, pa.array(name, pa.int64())],
                        names=["fill", "pieces", "name"])

    return items.groupBy("g").applyInArrow(pack, f"fill long, pieces array<{_PIECE.format(key=kind)}>, name long")


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   group_rows: int = GROUP_ROWS, fan_in: int = FAN_IN, slack: int = SLACK,
                   rank_file: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) per piece.

    Nulls are empty texts (the end id alone); null keys are keys like any
    other; repeated rows are packed each; an empty table gives an empty
    result; further columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    pieces = written(token_pieces(docs, key, text, capacity, rank_file, vocabulary), "pieces")
    piece = F.struct("id", "piece", "start", "length", "crc")
    rows = pieces.select(F.col("length").alias("fill"), F.array(piece).alias("pieces"),
                         F.xxhash64("id", "piece", "crc").alias("name"))
    done = rows.filter(F.col("fill") >= capacity - slack).withColumn("name", F.lit(None).cast("long"))
    full, rest = [done], rows.filter(F.col("fill") < capacity - slack)
    left = rest.count()
    groups = max(1, -(-left // group_rows))
    level = 0
    while left:
        level += 1
        packed = written(_pack_round(rest.withColumn("g", F.pmod(F.xxhash64("name"), F.lit(groups)).cast("long")),
                                     level, capacity, kind), "bins")
        rest = packed.filter(F.col("fill") < capacity - slack)
        before, left = left, rest.count()
        if groups == 1 or not left:
            full.append(packed)
            break
        full.append(packed.filter(F.col("fill") >= capacity - slack))
        merged, groups = groups, max(-(-groups // fan_in), -(-left // (4 * group_rows)))
        if groups >= merged and left == before:         # no bin saved, no larger groups: the rest no longer fits together
            full.append(rest)
            break
    out = None
    for part in full:
        out = part if out is None else out.unionByName(part)
    return _placed(out, key)


def _placed(bins: DataFrame, key: str) -> DataFrame:
    """One row per piece with its bin and the tokens before it there.  Pieces
    that fill a bin alone get ids below all others (level zero)."""
    named = bins.select(F.coalesce("name", F.monotonically_increasing_id()).alias("name"), "pieces")
    kind = bins.schema["pieces"].dataType.elementType["id"].dataType.simpleString()

    def place(batches):
        for batch in batches:
            lists = batch.column(1)
            size = lists.value_lengths().to_numpy()
            p = lists.flatten()
            length = p.field("length").to_numpy()
            before = np.cumsum(length) - length
            first = np.cumsum(size) - size
            name = np.repeat(batch.column(0).to_numpy(), size)
            offset = before - np.repeat(before[first] if len(size) else before, size)
            yield pa.RecordBatch.from_arrays(
                [p.field("id"), p.field("piece"), p.field("start"), p.field("length"), p.field("crc"),
                 pa.array(name), pa.array(offset)], names=["id", "piece", "start", "length", "crc", "name", "offset"])

    out = named.mapInArrow(place, f"id {kind}, piece int, start long, length long, crc long, name long, offset long")
    return out.select(F.col("id").alias(key), "piece", "start", "length", F.col("crc").alias("ids_crc32"),
                      F.col("name").alias("sequence_id"), "offset")
