"""Phrase collocations by direct-address tiling.

Texts become blocks of word codes, once.  Words that occur often enough get
ids by falling frequency; ids go back to the blocks that hold the word (a join
by word on each block's own word list, so no vocabulary is broadcast).  Pairs of
neighbours are cells of a table addressed by (left id, right id), cut into
tiles of ``TILE`` x ``TILE``.  Frequent words have small ids, so their pairs
crowd into few tiles: these are counted with dense bincounts.  Pairs of all
other tiles are sorted and counted as coordinates (COO).  Tasks send one row
per distinct pair, and Spark adds them up.  Pairs that are frequent come back
to the tasks as a bitmap of bounded size; pairs that pass it are ranked by
frequency again, and their ranks are the left ids of the next round, which
counts phrases one word longer in the same way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raremine.llm.store import if_small, written
from raremine.llm.textops import LOWER, byte_class, mix64, text_blocks, word_spans
from raremine.operators.clean import global_row_number

BREAK = byte_class(*[(ord(c), ord(c)) for c in ".,;:!?"], (0x0A, 0x0D))
WORD = ~(BREAK | byte_class((0x20, 0x20), (0x09, 0x09)))
NO_LANG = "und"

#: Text bytes of a block; side of a tile; ids below ``HEAD`` may lie in dense
#: tiles; occurrences per cell from which a tile is counted densely.
BLOCK_BYTES, TILE, HEAD, DENSE = 2 << 20, 512, 8192, 1 / 16
#: Rows that the Parquet reader holds at once (a row is a block), words counted
#: together, bits of a filter of phrases at most (128 MB).
READER_ROWS, TOGETHER, FILTER_BITS = 4, 1 << 19, 1 << 30


# ---------------------------------------------------------- in one block ----

def _at_breaks(data: np.ndarray, offs: np.ndarray, limit: int):
    """A text longer than a block, cut behind separators of pieces."""
    if len(data) <= limit:
        yield data, offs
        return
    breaks = np.flatnonzero(BREAK[data]) + 1
    lo = 0
    while lo < len(data):
        hi = len(data)
        if hi - lo > limit and len(breaks):
            k = int(np.searchsorted(breaks, lo + limit, side="right")) - 1
            if k < 0 or breaks[k] <= lo:                # no separator within the limit: the next one
                k = int(np.searchsorted(breaks, lo, side="right"))
            hi = int(breaks[k]) if k < len(breaks) else len(data)
        yield data[lo:hi], np.array([0, hi - lo], np.int64)
        lo = hi


def _word_codes(data: np.ndarray, offs: np.ndarray, langs: pa.Array):
    """(languages, words, counts, codes): the distinct (language, word) of a
    block, and the words in order as numbers of these, -1 between pieces."""
    data = LOWER[data]
    start, end, per_text = word_spans(data, offs, WORD)
    if not len(start):
        return None
    ends = np.cumsum(end - start)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(data[WORD[data]])]).dictionary_encode()
    lang = langs.fill_null(NO_LANG).dictionary_encode()
    text = np.repeat(np.arange(len(offs) - 1), np.diff(per_text))
    n_words = len(words.dictionary)
    both = lang.indices.to_numpy().astype(np.int64)[text] * n_words + words.indices.to_numpy()
    distinct, code, count = np.unique(both, return_inverse=True, return_counts=True)
    broken = np.cumsum(BREAK[data])
    new = np.flatnonzero((text[1:] != text[:-1]) | (broken[start[1:]] != broken[end[:-1] - 1])) + 1
    codes = np.insert(code.astype(np.int32), new, -1)
    return (lang.dictionary.take(pa.array(distinct // n_words)), words.dictionary.take(pa.array(distinct % n_words)),
            count, codes)


def count_cells(left: np.ndarray, right: np.ndarray, n_right: int):
    """(left, right, count) of the distinct pairs: dense bincounts for crowded
    tiles of frequent ids, sorted coordinates for the rest."""
    out = []
    tiles = HEAD // TILE
    head = (left < HEAD) & (right < HEAD)
    if head.any():
        a, b = left[head], right[head]
        tile = (a // TILE) * tiles + b // TILE
        sizes = np.bincount(tile, minlength=tiles * tiles)
        dense = sizes >= DENSE * TILE * TILE
        if dense.any():
            order = np.argsort(tile.astype(np.uint16), kind="stable")
            ends = np.cumsum(sizes)
            for t in np.flatnonzero(dense):
                of = order[ends[t] - sizes[t]:ends[t]]
                cells = np.bincount((a[of] % TILE) * TILE + b[of] % TILE, minlength=TILE * TILE)
                hit = np.flatnonzero(cells)
                out.append((hit // TILE + t // tiles * TILE, hit % TILE + t % tiles * TILE, cells[hit]))
            sparse = ~head
            sparse[np.flatnonzero(head)[~dense[tile]]] = True
            left, right = left[sparse], right[sparse]
    if len(left):
        if int(left.max()) < (1 << 62) // max(n_right, 1):
            code, count = np.unique(left * n_right + right, return_counts=True)
            out.append((code // n_right, code % n_right, count))
        else:
            order = np.lexsort((right, left))
            a, b = left[order], right[order]
            first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            out.append((a[first], b[first], np.diff(np.append(first, len(a)))))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*out))


def phrase_hash(words) -> np.ndarray:
    """64-bit hash of phrases given as one array of word ids per place."""
    h = np.zeros(len(words[0]), np.uint64)
    for w in words:
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + w.astype(np.uint64) + np.uint64(1))
    return h


def _in_filter(bits: np.ndarray, words) -> np.ndarray:
    at = phrase_hash(words) & np.uint64(8 * len(bits) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def count_phrases(ids: np.ndarray, size: int, n_words: int, filters: dict):
    """(word ids per place, counts) of the phrases of ``size`` words in ``ids``
    (-1: a break or a rare word) that may be frequent: their parts without the
    last and without the first word pass the filter of their size.  Level by
    level, phrases found are ranked by frequency, and the rank is the left id
    of the pairs that make them one word longer."""
    rank, at = ids, np.flatnonzero(ids >= 0)
    start = at                                         # where the phrase of a rank stands first
    for m in range(2, size + 1):
        good = np.zeros(len(ids) + 1, bool)
        good[at] = True if m == 2 else _in_filter(filters[m - 1], [ids[at + k] for k in range(m - 1)])
        at = at[(at + m <= len(ids))]
        at = at[good[at] & good[at + 1] & (ids[np.minimum(at + m - 1, len(ids) - 1)] >= 0)]
        left, right = rank[at].astype(np.int64), ids[at + m - 1].astype(np.int64)
        if m == size:
            a, b, n = count_cells(left, right, n_words)
            if size == 2:
                return [a, b], n
            return [ids[start[a] + k].astype(np.int64) for k in range(size - 1)] + [b], n
        _, first, inverse, n = np.unique(left * n_words + right, return_index=True, return_inverse=True, return_counts=True)
        by = np.argsort(-n, kind="stable")
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        rank = np.full(len(ids), -1, np.int64)
        rank[at] = place[inverse]
        start = at[first[by]]
    return [], np.zeros(0, np.int64)


# ------------------------------------------------------------ over blocks ----

def _width(n: int):
    """Type of ids below n."""
    return np.int32 if n < 1 << 31 else np.int64


def _written_blocks(df: DataFrame, name: str) -> DataFrame:
    """As ``written``, while tables of blocks are read a few rows at a time."""
    conf, key = df.sparkSession.conf, "spark.sql.parquet.columnarReaderBatchSize"
    before = conf.get(key, None)
    conf.set(key, str(READER_ROWS))
    try:
        return written(df, name)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def encode_blocks(docs: DataFrame, text: str, lang: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, words: array of (lang, word, n), codes) of the non-empty blocks."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))

    def run(batches):
        for part, data, offs in text_blocks(batches, block_bytes=block_bytes):
            langs = part.column(1)
            for piece, at in _at_breaks(data, offs, max(block_bytes, int(offs[-1]) if len(offs) > 2 else 0)):
                found = _word_codes(piece, at, langs)
                if found is None:
                    continue
                languages, words, count, codes = found
                entries = pa.StructArray.from_arrays([languages.cast(pa.string()), words.cast(pa.large_string()).cast(pa.string()), pa.array(count.astype(np.int64))],
                                                     names=["lang", "word", "n"])
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, len(entries)], pa.int32()), entries), pa.array([codes.tobytes()], pa.binary())],
                    names=["words", "codes"])

    found = rows.mapInArrow(run, "words array<struct<lang: string, word: string, n: long>>, codes binary")
    return written(found.withColumn("block", F.monotonically_increasing_id()), "blocks")


def _ranked(counts: DataFrame, order: list[str], name: str) -> DataFrame:
    """``counts`` with an id from 0 by falling n; ties by ``order``."""
    numbered = global_row_number(counts.withColumn("_less", -F.col("n")), ["_less", *order], "_rn")
    return written(numbered.withColumn("id", F.col("_rn") - 1).drop("_less", "_rn"), name)


def _word_ids(blocks: DataFrame, vocabulary: DataFrame, n_words: int) -> DataFrame:
    """(block, ids): word ids in order, -1 for breaks and rare words."""
    width = _width(n_words)
    entries = blocks.select("block", F.posexplode("words").alias("pos", "w")).select("block", "pos", "w.lang", "w.word")
    known = (entries.join(vocabulary.select("lang", "word", "id"), ["lang", "word"])
             .groupBy("block").agg(F.collect_list(F.struct("pos", "id")).alias("known")))
    rows = blocks.select("block", "codes", F.size("words").alias("size")).join(known, "block")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                codes = np.frombuffer(batch.column(1)[i].as_buffer(), np.int32)
                known = batch.column(3)[i].values
                table = np.full(batch.column(2)[i].as_py() + 1, -1, np.int64)          # the last entry is that of code -1
                table[known.field("pos").to_numpy()] = known.field("id").to_numpy()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([table.astype(width)[codes].tobytes()], pa.binary())],
                                                 names=["block", "ids"])

    return _written_blocks(rows.mapInArrow(run, "block long, ids binary"), "word-ids")


def _counted(coded: DataFrame, size: int, n_words: int, filters: dict) -> DataFrame:
    """(w0, w1, ..., n): counts of phrases of ``size`` words.  Blocks of a task
    are counted together, ``TOGETHER`` words at a time; Spark adds up."""
    names = [f"w{k}" for k in range(size)]
    shipped = {m: coded.sparkSession.sparkContext.broadcast(bits) for m, bits in filters.items() if m == size - 1 or m > 1}
    width = _width(n_words)

    def run(batches):
        known = {m: b.value for m, b in shipped.items()}
        gap = np.full(1, -1, width)
        held, words = [], 0

        def flush():
            found, n = count_phrases(np.concatenate(held), size, n_words, known)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in [*found, n]] if found else [pa.array([], pa.int64())] * (size + 1), names=[*names, "n"])

        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column(1)[i].as_buffer(), width)
                for lo in range(0, max(len(ids), 1), TOGETHER):      # a long block goes in parts that overlap by a phrase
                    held += [ids[max(lo - size + 1, 0):lo + TOGETHER], gap] if lo else [ids[:TOGETHER], gap]
                    words += min(len(ids) - lo, TOGETHER)
                    if words >= TOGETHER:
                        yield flush()
                        held, words = [], 0
        if held:
            yield flush()

    parts = coded.mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "n"]))
    return parts.groupBy(*names).agg(F.sum("n").alias("n"))


def _filter(found: DataFrame, size: int) -> np.ndarray:
    """A bitmap of the hashes of phrases: at least 8 bits for each while that
    is below ``FILTER_BITS``, the bound of what is sent to tasks.  What passes
    it wrongly is counted like the rest and is not frequent."""
    n = found.count()
    bits = min(FILTER_BITS, 1 << max(19, (8 * n).bit_length()))
    names = [f"w{k}" for k in range(size)]

    def hashed(batches):
        for batch in batches:
            at = phrase_hash([batch.column(k).to_numpy() for k in range(size)]) & np.uint64(bits - 1)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(19)).astype(np.int32)), pa.array((at & np.uint64((1 << 19) - 1)).astype(np.int32))],
                                             names=["part", "bit"])

    def pack(table: pa.Table) -> pa.Table:
        flags = np.zeros(1 << 19, np.uint8)
        flags[table.column("bit").to_numpy()] = 1
        return pa.table([table.column("part").slice(0, 1), pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())], names=["part", "bits"])

    parts = found.select(*names).mapInArrow(hashed, "part int, bit int").distinct().groupBy("part").applyInArrow(pack, "part int, bits binary")
    out = np.zeros(bits >> 3, np.uint8)
    for r in parts.collect():                          # FILTER_BITS / 8 bytes at most
        out[r["part"] << 16:(r["part"] + 1) << 16] = np.frombuffer(r["bits"], np.uint8)
    return out


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = 3, min_count: int = 10,
                     block_bytes: int = BLOCK_BYTES):
    """(totals, vocabulary, phrases): all words per language (lang, n); the
    words found ``min_count`` times (id, lang, word, n); the phrases of one to
    ``max_words`` words found so often (words: ids, lang, n)."""
    blocks = encode_blocks(docs, text, lang, block_bytes)
    # words are added up by (lang, word); a block holds each once
    counts = _written_blocks(blocks.select(F.explode("words").alias("w")).groupBy("w.lang", "w.word").agg(F.sum("w.n").alias("n")), "words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    vocabulary = _ranked(counts.filter(F.col("n") >= min_count), ["lang", "word"], "vocabulary")
    n_words = max(vocabulary.count(), 1)
    coded = _word_ids(blocks, vocabulary, n_words)
    out = vocabulary.select("lang", F.array("id").alias("words"), "n")
    filters: dict = {}
    for size in range(2, max_words + 1):
        names = [f"w{k}" for k in range(size)]
        found = _written_blocks(_counted(coded, size, n_words, filters).filter(F.col("n") >= min_count), "phrases")
        # ids are those of a language's words: the first one tells the language
        named = found.join(vocabulary.select(F.col("id").alias("w0"), "lang"), "w0")
        out = out.unionByName(named.select("lang", F.array(*names).alias("words"), "n"))
        if size < max_words:
            filters[size] = _filter(found, size)
    return totals, vocabulary, written(out, "phrases")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = 3, min_count: int = 10,
                 inside_percent: int = 50, top: int = 2000, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): per language the ``top``
    phrases of two to ``max_words`` words found a >= ``min_count`` times, by the
    score floor(10^6 a a / (l r)) of their lowest-scoring cut, without those
    that lie in a longer one found ``inside_percent`` percent as often or more.

    Null texts are empty, null languages are 'und'; empty texts have no words;
    texts of any length are read whole; repeated rows count each; ties go by a
    (falling), then by the phrase's bytes; an empty table gives an empty
    result; further columns are not read.  Scores are exact while a < 10^15.
    """
    totals, vocabulary, phrases = frequent_phrases(docs, text, lang, max_words, min_count, block_bytes)
    several = phrases.filter(F.size("words") > 1)
    part = phrases.select(F.col("words").alias("part"), F.col("n").alias("found"))
    cuts = several.select("lang", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("*", F.expr("slice(words, 1, k)").alias("first"), F.expr("slice(words, k + 1, size(words) - k)").alias("rest"))
    cuts = (cuts.join(part.select(F.col("part").alias("first"), F.col("found").alias("l")), "first")
            .join(part.select(F.col("part").alias("rest"), F.col("found").alias("r")), "rest"))
    score = F.expr("(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)))"
                   " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    scored = (cuts.withColumn("score", score).groupBy("lang", "words", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    longer = several.filter(F.size("words") > 2).select("words", F.col("n").alias("longer"))
    inside = longer.select("longer", "words", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("m"))
    inside = inside.select("longer", "words", "m", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("m") + 1)).alias("i"))
    inside = inside.groupBy(F.expr("slice(words, i, m)").alias("words")).agg(F.max("longer").alias("longer"))
    kept = scored.join(inside, "words", "left").filter(F.coalesce(F.col("longer") * 100 < F.col("a") * inside_percent, F.lit(True)))
    kept = written(kept.select("lang", "words", "a", "cut"), "kept")
    named = (kept.select("words", F.posexplode("words").alias("i", "id"))
             .join(vocabulary.select("id", "word"), "id").groupBy("words")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    rows = kept.join(named, "words").select("lang", "phrase", "a", "cut.*")
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = rows.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
    return (best.join(if_small(written(totals, "totals")), "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
