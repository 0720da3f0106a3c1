"""SimHash near-duplicates through a Gray-order hierarchical index.

A text's words make shingles; each bit of its fingerprint is the majority of
that bit over the shingles' XXH64 values.  Fingerprints at most ``max_bits``
apart are linked.

Two fingerprints that close agree on at least one of ``max_bits + 1`` equal
blocks of bits, so every distinct fingerprint goes to one group per block value
(equal fingerprints are merged before).  Within a group the fingerprints are
sorted by Gray rank, which puts codes with shared bits side by side, and a tree
is built over them: an upper node holds the bits that all codes below share
(mask and pattern).  A pair of nodes whose shared bits already differ in more
than ``max_bits`` places is dropped with everything below it.  A group returns
the edges of a spanning forest of its links, not all its pairs.

Groups above ``max_group`` codes are dealt again by blocks of the bits that
their key does not fix yet, by the same argument; distinct codes with at most
b free bits number 2^b at most, so groups stay bounded without dropping any.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raremine.llm.components import connected_components
from raremine.llm.store import if_small, written
from raremine.llm.textops import LOWER, NOT_SPACE, text_blocks, word_spans

SHINGLE_WORDS, MAX_BITS, HASH_SEED = 3, 3, 42
MAX_GROUP = 200_000
FANOUT = 8
#: Node pairs expanded at a time.
PAIRS = 1 << 18


# ------------------------------------------------------------ fingerprints --

def _normal_words(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """The words joined by single spaces: the bytes, and start and end of every
    word in them."""
    size = end - start
    before = np.cumsum(size) - size                     # bytes of the words before
    number = np.repeat(np.arange(len(start)), size)
    at = np.arange(int(size.sum()))
    out = np.full(len(at) + len(start), 32, np.uint8)
    out[at + number] = data[at + (start - before)[number]]
    new_start = before + np.arange(len(start))
    return out, new_start, new_start + size


def fingerprints(data: np.ndarray, offs: np.ndarray, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """One 64-bit fingerprint per text of a block (no words: zero)."""
    n = len(offs) - 1
    result = np.zeros(n, np.uint64)
    start, end, w_offs = word_spans(data, offs, NOT_SPACE)
    if not len(start):
        return result
    text, start, end = _normal_words(LOWER[data], start, end)
    words = np.diff(w_offs)
    grams = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    first = np.repeat(w_offs[:-1], grams) + np.arange(grams.sum()) - np.repeat(np.cumsum(grams) - grams, grams)
    last = np.minimum(first + shingle, np.repeat(w_offs[1:], grams)) - 1
    raw = text.tobytes()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[a:b], HASH_SEED) for a, b in zip(start[first].tolist(), end[last].tolist())),
                         dtype=np.uint64, count=len(first))
    full = np.flatnonzero(grams)
    bounds = (np.cumsum(grams) - grams)[full]
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, bounds, axis=0, dtype=np.int64)
    major = (2 * ones > grams[full][:, None]).astype(np.uint8)
    result[full] = np.packbits(major, axis=1, bitorder="little").reshape(-1, 8).copy().view(np.uint64).ravel()
    return result


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text",
                          shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(key, text_key long, fingerprint long): one row per row; null text has
    no words.  ``text_key`` is a hash that tells apart rows with the same key."""
    rows = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_text_key"), F.col(text).alias("_text"))

    def run(batches):
        for part, data, offs in text_blocks(batches, "_text"):
            codes = pa.array(fingerprints(data, offs, shingle).view(np.int64))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), codes], names=["_key", "_t", "_code"])

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"_key {kind}, _t long, _code long").select(
        F.col("_key").alias(key), F.col("_t").alias("text_key"), F.col("_code").alias("fingerprint"))


# ------------------------------------------------------------------- index --

def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence (prefix XOR)."""
    r = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(shift)
    return r


class GrayIndex:
    """Trees over groups of codes.  ``group`` must be sorted, codes of a group
    sorted by Gray rank.  Level 0 holds the codes; a node of level l + 1 spans
    up to FANOUT neighbouring nodes of its group on level l."""

    def __init__(self, group: np.ndarray, codes: np.ndarray):
        first = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1]) if len(group) else np.zeros(0, int)
        self.mask = [np.full(len(codes), ~np.uint64(0), np.uint64)]
        self.bits = [codes]
        self.child: list[np.ndarray] = []       # first child of every node, and one end
        size = np.diff(np.append(first, len(codes)))
        while len(size) and size.max() > 1:
            above = -(-size // FANOUT)
            starts = np.repeat(np.cumsum(size) - size, above) + FANOUT * (
                np.arange(above.sum()) - np.repeat(np.cumsum(above) - above, above))
            mask, bits = self.mask[-1], self.bits[-1]
            both = np.bitwise_and.reduceat(bits, starts)
            either = np.bitwise_or.reduceat(bits, starts)
            shared = np.bitwise_and.reduceat(mask, starts) & (both | ~either)
            self.child.append(np.append(starts, size.sum()))
            self.mask.append(shared)
            self.bits.append(both & shared)
            size = above
        self.groups = len(size)

    def close_pairs(self, max_bits: int):
        """Yields arrays (i, j) of code positions, i < j, at most max_bits apart."""
        top = len(self.child)
        roots = np.arange(self.groups)
        stack = [(top, roots, roots)]
        while stack:
            level, a, b = stack.pop()
            if len(a) > PAIRS // (FANOUT * FANOUT) and level:
                cut = PAIRS // (FANOUT * FANOUT)
                stack.append((level, a[cut:], b[cut:]))
                a, b = a[:cut], b[:cut]
            if level == 0:
                keep = a < b
                yield a[keep], b[keep]
                continue
            child = self.child[level - 1]
            na, nb = child[a + 1] - child[a], child[b + 1] - child[b]
            count = na * nb
            which = np.repeat(np.arange(len(a)), count)
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            ca = child[a][which] + place // nb[which]
            cb = child[b][which] + place % nb[which]
            mask, bits = self.mask[level - 1], self.bits[level - 1]
            apart = np.bitwise_count((bits[ca] ^ bits[cb]) & mask[ca] & mask[cb])
            ok = (apart <= max_bits) & (ca <= cb)
            if ok.any():
                stack.append((level - 1, ca[ok], cb[ok]))


def spanning_edges(index: GrayIndex, n: int, max_bits: int):
    """Positions (i, j) of the edges of a spanning forest of the close pairs."""
    root = np.arange(n)

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    left, right = [], []
    for i, j in index.close_pairs(max_bits):
        new = root[i] != root[j]
        for x, y in zip(i[new].tolist(), j[new].tolist()):
            p, q = find(x), find(y)
            if p != q:
                root[max(p, q)] = min(p, q)
                left.append(x)
                right.append(y)
        while len(i) and (root[root] != root).any():
            root = root[root]
    return np.array(left, np.int64), np.array(right, np.int64)


def _blocks(max_bits: int, free: list[int]) -> list[list[int]]:
    """``free`` bit numbers split into max_bits + 1 nearly equal parts."""
    parts = max_bits + 1
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    return [free[cuts[i]:cuts[i + 1]] for i in range(parts)]


def _mask_of(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def close_edges(codes: DataFrame, max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of distinct codes
    (column ``code``) at most ``max_bits`` apart.  ``mask`` holds the bits that
    a row's group fixes, ``g`` a hash of their values (should two groups share
    one, a few more pairs are compared and none is lost)."""
    rows = codes.select("code", F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("g"))
    fixed_sets: list[list[int]] = [[]]
    found = None
    while True:
        deeper, table = [], []
        for fixed in fixed_sets:
            free = [b for b in range(64) if b not in set(fixed)]
            parts = _blocks(max_bits, free)
            deeper += [sorted(fixed + part) for part in parts]
            table += [F.lit(_mask_of(fixed)), F.array(*[
                F.struct(F.lit(_mask_of(part)).alias("part"), F.lit(_mask_of(fixed + part)).alias("mask")) for part in parts])]
        keyed = (rows.select("code", "g", F.explode(F.create_map(*table)[F.col("mask")]).alias("s"))
                 .select("code", "s.mask", F.xxhash64("g", "s.mask", F.col("code").bitwiseAND(F.col("s.part"))).alias("g")))
        big = None
        if len(free) > 24:
            big = written(keyed.groupBy("g").count().filter(F.col("count") > max_group).select("g"), "sim-big")
            if big.first() is None:
                big = None
        edges = _edges_in_groups(keyed if big is None else keyed.join(big, "g", "left_anti"), max_bits)
        found = edges if found is None else found.union(edges)
        if big is None:
            return found
        rows = written(keyed.join(big, "g", "left_semi").select("code", "mask", "g"), "sim-deeper")
        fixed_sets = list({_mask_of(f): f for f in deeper}.values())


def _edges_in_groups(keyed: DataFrame, max_bits: int) -> DataFrame:
    """Edges within the codes of every group.  Rows are shuffled by group; a task
    indexes whole groups, as many at a time as make up a block of codes."""
    def emit(group, codes):
        order = np.lexsort((gray_rank(codes), group))
        group, codes = group[order], codes[order]
        i, j = spanning_edges(GrayIndex(group, codes), len(codes), max_bits)
        a, b = codes[i].view(np.int64), codes[j].view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

    def run(batches):
        group, codes, held = [], [], 0
        for batch in batches:
            g = batch.column(0).to_numpy()
            group.append(g)
            codes.append(batch.column(1).to_numpy().view(np.uint64))
            held += len(g)
            if held >= 1 << 16 and g[0] != g[-1]:
                g, c = np.concatenate(group), np.concatenate(codes)
                whole = int(np.flatnonzero(g != g[-1])[-1]) + 1
                yield emit(g[:whole], c[:whole])
                group, codes, held = [g[whole:]], [c[whole:]], len(g) - whole
        if held:
            yield emit(np.concatenate(group), np.concatenate(codes))

    return (keyed.select("g", "code").repartition("g").sortWithinPartitions("g")
            .mapInArrow(run, "a long, b long"))


# --------------------------------------------------------------- documents --

def _components(marked: DataFrame, key: str, max_bits: int, max_group: int) -> DataFrame:
    """(code, component_id) for every distinct fingerprint of ``marked``."""
    codes = written(marked.groupBy(F.col("fingerprint").alias("code")).agg(F.min(key).alias("least")), "sim-distinct")
    nodes = connected_components(close_edges(codes, max_bits, max_group))
    placed = codes.join(nodes, codes.code == nodes.node, "left").select(
        "code", "least", F.coalesce("component", "code").alias("component"))
    ids = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    return placed.join(ids, "component").select("code", "component", "component_id")


def near_duplicate_components(docs: DataFrame, key: str = "doc_id", text: str = "text",
                              shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                              max_group: int = MAX_GROUP) -> DataFrame:
    """(key, fingerprint long, component_id): component_id is the smallest key
    reachable over links between fingerprints at most ``max_bits`` apart.

    Null and empty texts have fingerprint zero and link like any other; rows
    with a null key take part but never name a component unless all its keys
    are null; repeated rows give repeated result rows; an empty table gives an
    empty result; further columns are not read.
    """
    marked = written(fingerprint_documents(docs, key, text, shingle), "sim-codes")
    named = _components(marked, key, max_bits, max_group)
    return (marked.join(named, marked.fingerprint == named.code)
            .select(key, "fingerprint", "component_id"))


def one_of_each_group(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS,
                      max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """One row of ``docs`` for each component of near duplicates, the one with
    the smallest (key, hash of the text), columns unchanged; nulls come first.
    Of equal rows one stays.  Only the names of the rows to drop meet the
    table; rows that occur several times are the only ones compared."""
    marked = written(fingerprint_documents(docs, key, text, shingle), "sim-codes")
    named = _components(marked, key, max_bits, max_group)
    rows = (marked.groupBy(key, "text_key", "fingerprint").agg(F.count(F.lit(1)).alias("copies"))
            .join(named, F.col("fingerprint") == named.code)
            .select("component", F.struct(F.col(key).alias("k"), F.col("text_key").alias("t")).alias("row"), "copies"))
    rows = written(rows, "sim-rows")
    first = rows.groupBy("component").agg(F.min("row").alias("first"))
    seen = rows.join(first, "component")
    drop = if_small(written(seen.filter(F.col("row") != F.col("first")).select("row.*"), "sim-drop"))
    repeated = written(seen.filter((F.col("row") == F.col("first")) & (F.col("copies") > 1)).select("row.*"), "sim-again")

    def same(d, other):
        return d[key].eqNullSafe(other["k"]) & (F.xxhash64(d[text]) == other["t"])

    left = docs.join(drop, same(docs, drop), "left_anti")
    if repeated.first() is None:
        return left
    repeated = if_small(repeated)
    several = left.join(repeated, same(left, repeated), "left_semi").dropDuplicates()
    return left.join(repeated, same(left, repeated), "left_anti").unionByName(several)
