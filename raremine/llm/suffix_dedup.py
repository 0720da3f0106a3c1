"""Exact removal of repeated byte strings with suffix arrays.

A byte goes when a string of ``length`` bytes that covers it also starts
anywhere else.  Every window of that length has an anchor, its gram of smallest
hash (leftmost on ties), which depends on the window's bytes alone; equal
windows therefore meet under equal anchors.  Neighbouring windows of a text with
the same anchor form a piece.

1. Anchors that occur once in the corpus can't be part of a repeat; pieces of
   the others remain (hashes are counted before any text moves).
2. Equal pieces become one with a count.
3. Pieces are dealt by anchor into shards of bounded size.  Each shard's suffix
   array is made by induced sorting, its longest common prefixes in text order,
   and a window repeats if it shares ``length`` bytes with a neighbour in the
   suffix array, or if its piece occurs several times.
4. The repeated windows go back to all occurrences of their pieces; per text
   their bytes are united and cut out.

An anchor with more bytes of different pieces than a shard may hold is not
capped: its windows are compared one by one through 128-bit hashes instead.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raremine.llm.induced import suffix_array
from raremine.llm.store import written
from raremine.llm.suffixes import permuted_lcp
from raremine.llm.textops import _power_tables, column_bytes, mix64, text_blocks, union_lengths

LENGTH, GRAM = 200, 32
#: Bytes of pieces in a shard, and of different pieces under one anchor.
SHARD_BYTES, ANCHOR_BYTES = 512 << 10, 4 << 20
_PLACE_BITS = 24


# ------------------------------------------------------------------ pieces --

def _prefix_sums(data: np.ndarray):
    up, down, code = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code[data] * up[:len(data)], out=sums[1:])
    return sums, down


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, from block-wise running minima."""
    n = len(x)
    blocks = np.concatenate([x, np.full(-n % width, ~np.uint64(0), np.uint64)]).reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    since = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return np.minimum(since[:m], upto[width - 1:width - 1 + m])


def cut_pieces(data: np.ndarray, offs: np.ndarray, length: int, gram: int):
    """(text, first window, number of windows, anchor, content hash) of all
    pieces of a block.  Windows are numbered by their first byte in the text."""
    none = np.zeros(0, np.int64)
    out = [none, none, none, none.astype(np.uint64), none.astype(np.uint64)]
    if len(data) < length:
        return out
    parts = []
    doc_of = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    step = (1 << _PLACE_BITS) - length          # a longer block is cut with an overlap, no window is lost
    for lo in range(0, len(data) - length + 1, step):
        view = data[lo:lo + step + length - 1]
        sums, down = _prefix_sums(view)
        h = mix64((sums[gram:] - sums[:-gram]) * down[:len(view) - gram + 1])
        place = np.uint64(_PLACE_BITS)
        ranked = (h >> place << place) | np.arange(len(h), dtype=np.uint64)
        anchor = (_sliding_min(ranked, length - gram + 1) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        at = np.arange(len(anchor))
        doc = doc_of[lo:lo + len(anchor)]
        inside = lo + at + length <= offs[doc + 1]
        same = inside[1:] & inside[:-1] & (anchor[1:] == anchor[:-1]) & (doc[1:] == doc[:-1])
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~same
        last[:-1] &= ~same
        s, e = np.flatnonzero(first), np.flatnonzero(last)
        content = mix64(((sums[e + length] - sums[s]) * down[s]) ^ (e - s).astype(np.uint64))
        parts.append((doc[s], lo + s - offs[doc[s]], e - s + 1, h[anchor[s]], content))
    return [np.concatenate(p) for p in zip(*parts)] if parts else out


def _pieces(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(row, start, windows, anchor, content) of every piece of (row, text)."""
    def run(batches):
        for part, data, offs in text_blocks(batches, "text"):
            doc, start, count, anchor, content = cut_pieces(data, offs, length, gram)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(doc)), pa.array(start), pa.array(count.astype(np.int32)),
                 pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64))],
                names=["row", "start", "windows", "anchor", "content"])

    return docs.mapInArrow(run, "row long, start long, windows int, anchor long, content long")


# ------------------------------------------------------------------ shards --

def repeated_windows(pieces: list[bytes], counts: list[int], length: int) -> list[np.ndarray]:
    """For each piece the flags of its windows that also start elsewhere, in
    the piece itself, in another one or in another occurrence."""
    size = np.array([len(p) for p in pieces])
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int32) + 2
    ends = np.cumsum(size + 1) - 1
    text[ends] = 1                                   # between pieces; windows do not reach them
    text = np.append(text, 0)
    sa = suffix_array(text)
    plcp = permuted_lcp(text, sa)
    lcp = np.append(plcp[sa], 0)
    repeats = np.zeros(len(text), bool)
    repeats[sa] = np.maximum(lcp[:-1], lcp[1:]) >= length
    starts = ends - size
    return [np.ones(n - length + 1, bool) if c > 1 else repeats[a:a + n - length + 1]
            for a, n, c in zip(starts.tolist(), size.tolist(), counts)]


def _runs(flags: np.ndarray):
    """[from, to) of the runs of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2].tolist(), edge[1::2].tolist()


_FOUND = "anchor long, content long, from int, to int"


def _in_shards(pieces: DataFrame, shards: int, length: int) -> DataFrame:
    """Runs of repeated windows (anchor, content, from, to) of (anchor, content,
    n, bytes), by suffix arrays over shards of anchors."""
    def shard(table: pa.Table) -> pa.Table:
        table = table.sort_by([("anchor", "ascending"), ("content", "ascending")])
        anchor, content, counts = (table.column(c).to_pylist() for c in ("anchor", "content", "n"))
        rows = ([], [], [], [])
        for i, flags in enumerate(repeated_windows(table.column("bytes").to_pylist(), counts, length)):
            for a, b in zip(*_runs(flags)):
                for column, v in zip(rows, (anchor[i], content[i], a, b)):
                    column.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.table([pa.array(r, k) for r, k in zip(rows, kinds)], names=["anchor", "content", "from", "to"])

    # copies of a row bring the same piece several times; it counts once
    return (pieces.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
            .groupBy("shard").applyInArrow(shard, _FOUND))


def _one_by_one(pieces: DataFrame, length: int) -> DataFrame:
    """The same for pieces of anchors that outgrow a shard: every window's
    128-bit hash is counted, whatever the number of pieces."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                data, offs = column_bytes(part.column(3))
                n = np.diff(offs) - length + 1
                which = np.repeat(np.arange(part.num_rows), n)
                at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                begin = offs[which] + at
                one, down = _prefix_sums(data)
                two, _ = _prefix_sums(data ^ 0x55)
                hashes = [mix64((s[begin + length] - s[begin]) * down[begin]).view(np.int64) for s in (one, two)]
                w = pa.array(which)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(w), part.column(1).take(w), part.column(2).take(w), pa.array(at.astype(np.int32)),
                     *map(pa.array, hashes)], names=["anchor", "content", "n", "at", "h1", "h2"])

    windows = pieces.dropDuplicates(["anchor", "content"]).select("anchor", "content", "n", "bytes").mapInArrow(
        run, "anchor long, content long, n long, at int, h1 long, h2 long")
    known = windows.groupBy("h1", "h2").agg(F.sum("n").alias("total")).filter("total > 1").select("h1", "h2")
    return windows.join(known, ["h1", "h2"]).select("anchor", "content", F.col("at").alias("from"), (F.col("at") + 1).alias("to"))


# --------------------------------------------------------------- documents --

def repeated_spans(docs: DataFrame, length: int, gram: int, shard_bytes: int, anchor_bytes: int) -> DataFrame:
    """(row, from, to) byte ranges of (row, text) that repeated strings cover."""
    cut = _pieces(docs, length, gram)
    # a table of its own, so that Spark may split a frequent anchor's rows in the join
    known = written(cut.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "sub-known")
    places = written(cut.join(known, "anchor", "left_semi"), "sub-places")
    kinds = written(places.groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "start", "windows")).alias("at"))
        .select("anchor", "content", "n", "at.*"), "sub-kinds")
    bytes_of = (F.col("windows") + (length - 1)).cast("long")
    total = kinds.agg(F.sum(bytes_of)).first()[0] or 0
    big = written(kinds.groupBy("anchor").agg(F.sum(bytes_of).alias("size"))
                  .filter(F.col("size") > anchor_bytes).select("anchor"), "sub-big")
    wanted = kinds.groupBy("row").agg(F.collect_list(F.struct("anchor", "content", "n", "start", "windows")).alias("wanted")) \
        .withColumnRenamed("row", "in_row")
    texts = docs.join(wanted, docs.row == wanted.in_row).select("text", "wanted")

    def extract(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                out = ([], [], [], [])
                for value, pieces in zip(part.column(0), part.column(1).to_pylist()):
                    raw = value.as_py().encode()
                    for p in pieces:
                        for column, v in zip(out, (p["anchor"], p["content"], p["n"],
                                                   raw[p["start"]:p["start"] + p["windows"] + length - 1])):
                            column.append(v)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.binary())],
                    names=["anchor", "content", "n", "bytes"])

    pieces = texts.mapInArrow(extract, "anchor long, content long, n long, bytes binary")
    shards = max(1, -(-int(total) // shard_bytes))
    if big.first() is None:
        found = _in_shards(pieces, shards, length)
    else:
        pieces = written(pieces, "sub-pieces")
        found = _in_shards(pieces.join(big, "anchor", "left_anti"), shards, length).union(
            _one_by_one(pieces.join(big, "anchor", "left_semi"), length))
    found = written(found, "sub-found")
    return places.join(found, ["anchor", "content"]).select(
        "row", (F.col("start") + F.col("from")).alias("from"), (F.col("start") + F.col("to") + (length - 1)).alias("to"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
                   shard_bytes: int = SHARD_BYTES, anchor_bytes: int = ANCHOR_BYTES, texts: bool = False) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256 [, kept binary]) per row.

    Null and empty texts keep nothing of nothing; texts shorter than ``length``
    stay whole; repeated rows are repeats of each other; null keys are keys
    like any other; an empty table gives an empty result; further columns are
    not read.  ``kept`` are the remaining bytes, which need not be valid UTF-8
    when a removed run ends inside a character.
    """
    if not 0 < gram < length:
        raise ValueError("gram must be shorter than length")
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("key", "text"))
    spans = repeated_spans(rows.select("row", "text"), length, gram, shard_bytes, anchor_bytes)
    lists = spans.groupBy("row").agg(F.collect_set(F.struct("from", "to")).alias("spans")).withColumnRenamed("row", "in_row")
    joined = rows.join(lists, rows.row == lists.in_row, "left").select("key", "text", "spans")

    def cut_out(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                out = ([], [], [], [], [])
                for value, spans in zip(part.column(1), part.column(2)):
                    raw = value.as_py().encode()
                    removed = runs = 0
                    if spans.is_valid:
                        flat = spans.values
                        gone = union_lengths(flat.field("from").to_numpy(), flat.field("to").to_numpy(), len(raw))
                        removed, runs = int(gone.sum()), len(_runs(gone)[0])
                        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    else:
                        kept = raw
                    for column, v in zip(out, (len(raw), removed, runs, hashlib.sha256(kept).hexdigest(), kept if texts else None)):
                        column.append(v)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3]), pa.array(out[4], pa.binary())],
                    names=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    kind = docs.schema[key].dataType.simpleString()
    out = joined.mapInArrow(cut_out, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.select(F.col("key").alias(key), "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * texts)
