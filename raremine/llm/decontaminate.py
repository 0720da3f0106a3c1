"""Benchmark decontamination by winnowing.

Words are lower-cased runs of letters, digits and non-ASCII characters.  Every
run of GRAM words is hashed and of each sliding window of ``window - GRAM + 1``
grams the smallest hash is kept, so two texts that share ``window`` consecutive
words share a kept hash.  Kept hashes of documents and benchmark items are
joined, and each hit is extended to both sides word by word; runs of at least
``window`` equal words (or a whole shorter item) are hits.

Before the join a bitmap of fixed size, filled from the benchmark's hashes,
drops document hashes that the benchmark cannot have.  It can only let too many
through, so its size never changes a result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raremine.llm.store import if_small, written
from raremine.llm.textops import LETTERS, LOWER, gram_hash, mix64, span_hash, text_blocks, word_spans

WINDOW, GRAM = 10, 5
BITMAP_BITS = 24

_HIT = "struct<hash: long, left: array<string>, gram: array<string>, right: array<string>, at: long>"


def _kept_grams(tokens: np.ndarray, w_offs: np.ndarray, window: int, gram: int):
    """Positions and hashes of the grams that are smallest in some window of
    their text (all of them on ties)."""
    n, words = len(tokens), np.diff(w_offs)
    h = gram_hash(tokens, gram)
    span = window - gram + 1
    ends = np.repeat(w_offs[1:], words)             # end of each word's text
    starts = n - window + 1                         # windows by first word
    if starts <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = h[:starts].copy()
    for j in range(1, span):
        np.minimum(least, h[j:j + starts], out=least)
    whole = np.arange(starts) + window <= ends[:starts]
    kept = np.zeros(len(h), bool)
    for j in range(span):
        kept[j:j + starts] |= whole & (h[j:j + starts] == least)
    at = np.flatnonzero(kept)
    return at, h[at]


def _short_grams(tokens: np.ndarray, w_offs: np.ndarray, size: int):
    """Positions and hashes of all runs of ``size`` words inside one text."""
    h = gram_hash(tokens, size)
    inside = np.arange(len(h)) + size <= np.repeat(w_offs[1:], np.diff(w_offs))[:len(h)]
    at = np.flatnonzero(inside)
    return at, mix64(h[at] + np.uint64(size))


def _words(data: np.ndarray, offs: np.ndarray):
    low = LOWER[data]
    start, end, w_offs = word_spans(low, offs, LETTERS)
    return low, start, end, w_offs, span_hash(low, start, end)


def _context(raw: bytes, start, end, lo: int, hi: int, at: int, size: int, reach: int):
    """Words of a gram and up to ``reach`` words on either side, nearest first."""
    word = [raw[start[i]:end[i]].decode("utf-8", "replace") for i in range(max(lo, at - reach), min(hi, at + size + reach))]
    cut = at - max(lo, at - reach)
    return word[:cut][::-1], word[cut:cut + size], word[cut + size:]


def _benchmark_grams(items: DataFrame, item: str, text: str, window: int, gram: int) -> DataFrame:
    """(hash, left, gram, right, items): the kept grams of long items and the
    whole of shorter ones, each distinct context once with its items."""
    rows = items.select(F.col(item).alias("_item"), F.col(text).alias("_text"))

    def run(batches):
        for part, data, offs in text_blocks(batches, "_text"):
            low, start, end, w_offs, tokens = _words(data, offs)
            raw = low.tobytes()
            at, h = _kept_grams(tokens, w_offs, window, gram)
            found = [(int(a), gram, int(x)) for a, x in zip(at, h.view(np.int64))]
            for i in np.flatnonzero((np.diff(w_offs) > 0) & (np.diff(w_offs) < window)):
                size, a = int(w_offs[i + 1] - w_offs[i]), int(w_offs[i])
                x = mix64(gram_hash(tokens[a:a + size], size) + np.uint64(size))
                found.append((a, size, int(x.view(np.int64)[0])))
            doc = np.searchsorted(w_offs, [f[0] for f in found], side="right") - 1 if found else []
            ids = part.column(0).to_pylist()
            cols = [[], [], [], [], []]
            for (a, size, x), d in zip(found, doc):
                short = w_offs[d + 1] - w_offs[d] < window
                ctx = _context(raw, start, end, w_offs[d], w_offs[d + 1], a, size, 0 if short else window - gram)
                for c, v in zip(cols, (ids[d], x, *ctx)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], part.column(0).type), pa.array(cols[1], pa.int64()),
                 *[pa.array(c, pa.list_(pa.string())) for c in cols[2:]]], names=["_item", "hash", "left", "gram", "right"])

    kind = items.schema[item].dataType.simpleString()
    grams = rows.mapInArrow(run, f"_item {kind}, hash long, left array<string>, gram array<string>, right array<string>")
    return grams.groupBy("hash", "left", "gram", "right").agg(F.collect_set(F.col("_item").cast("string")).alias("items"))


def _bitmap(grams: DataFrame, bits: int) -> np.ndarray:
    """2^bits flags of the hashes' low bits; at most 2^bits / 64 rows come in."""
    low = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    words = (grams.select(low.alias("low")).selectExpr("shiftright(low, 6) AS word", "shiftleft(1L, CAST(low % 64 AS INT)) AS bit")
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas())
    flags = np.zeros(max(1, (1 << bits) // 64), np.int64)
    flags[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return np.unpackbits(flags.view(np.uint8), bitorder="little").astype(bool)


def _document_hits(docs: DataFrame, key: str, text: str, window: int, gram: int, grams: DataFrame, bits: int) -> DataFrame:
    """(key, text_key, n_words, hits): the document's kept grams that pass the
    bitmap, with their contexts."""
    flags = docs.sparkSession.sparkContext.broadcast(np.packbits(_bitmap(grams, bits)))
    low_bits = np.uint64((1 << bits) - 1)
    short_sizes = sorted(r[0] for r in grams.filter((F.size("left") == 0) & (F.size("right") == 0))
                         .select(F.size("gram")).distinct().collect())           # < window values
    rows = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_t"), F.col(text).alias("_text"))

    def run(batches):
        member = np.unpackbits(flags.value).astype(bool)
        for part, data, offs in text_blocks(batches, "_text"):
            low, start, end, w_offs, tokens = _words(data, offs)
            raw, found = low.tobytes(), []
            for size in [0, *short_sizes]:
                at, h = _short_grams(tokens, w_offs, size) if size else _kept_grams(tokens, w_offs, window, gram)
                ok = member[(h & low_bits).astype(np.int64)]
                found += [(a, size or gram, 0 if size else window - gram, x)
                          for a, x in zip(at[ok].tolist(), h[ok].view(np.int64).tolist())]
            hits = [[] for _ in range(part.num_rows)]
            doc = np.searchsorted(w_offs, [f[0] for f in found], side="right") - 1 if found else []
            for (a, size, reach, x), d in zip(found, doc):
                left, mid, right = _context(raw, start, end, w_offs[d], w_offs[d + 1], a, size, reach)
                hits[d].append({"hash": x, "left": left, "gram": mid, "right": right, "at": a - int(w_offs[d])})
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(np.diff(w_offs).astype(np.int64)), pa.array(hits, hit_type)],
                names=["_key", "_t", "n_words", "hits"])

    strings = pa.list_(pa.string())
    hit_type = pa.list_(pa.struct([("hash", pa.int64()), ("left", strings), ("gram", strings), ("right", strings), ("at", pa.int64())]))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"_key {kind}, _t long, n_words long, hits array<{_HIT}>")


def _agreeing(a: str, b: str):
    """Number of leading elements that two arrays share."""
    same = F.zip_with(a, b, lambda x, y: x.isNotNull() & x.eqNullSafe(y))
    stop = F.array_position(same, False)
    return F.when(stop == 0, F.size(same)).otherwise(stop - 1).cast("long")


def find_contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                       item: str = "item_id", item_text: str = "text", window: int = WINDOW, gram: int = GRAM,
                       bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """(key, text_key, n_words, spans, items) per row of ``docs``: ``spans`` are
    the word ranges [from, to) of hits (null without any), ``items`` the
    item ids as strings.  ``text_key`` is the hash of the text that tells apart
    rows with the same key.

    Null and empty texts have no words and no hits; an item without words hits
    nothing; equal items and repeated rows are compared once and reported for
    each; an empty benchmark or table gives no hits or no rows; further
    columns are not read.
    """
    grams = written(_benchmark_grams(items, item, item_text, window, gram), "bench-grams")
    marked = written(_document_hits(docs, key, text, window, gram, grams, bitmap_bits), "doc-hits")
    hits = marked.filter(F.size("hits") > 0).select("_key", "_t", "hits").dropDuplicates(["_key", "_t"])
    hits = hits.select("_key", "_t", F.explode("hits").alias("hit")).select("_key", "_t", "hit.*")
    b = grams.select("hash", F.col("left").alias("b_left"), F.col("gram").alias("b_gram"), F.col("right").alias("b_right"), "items")
    met = hits.join(b, "hash").filter(F.col("gram") == F.col("b_gram"))
    before, after = _agreeing("left", "b_left"), _agreeing("right", "b_right")
    size = F.size("gram")
    short = (F.size("b_left") == 0) & (F.size("b_right") == 0)
    met = (met.select("_key", "_t", "items", (F.col("at") - before).alias("from"), (F.col("at") + size + after).alias("to"),
                      short.alias("short"))
           .filter(F.col("short") | (F.col("to") - F.col("from") >= window)))
    spans = met.groupBy("_key", "_t").agg(F.collect_set(F.struct("from", "to")).alias("spans"))
    named = met.select("_key", "_t", F.explode("items").alias("item")).distinct() \
        .groupBy("_key", "_t").agg(F.collect_list("item").alias("items"))
    d = marked.select("_key", "_t", "n_words")
    for part, column in ((spans, "spans"), (named, "items")):
        part = part.select(F.col("_key").alias("k"), F.col("_t").alias("t"), column)
        d = d.join(part, d["_key"].eqNullSafe(part["k"]) & (d["_t"] == part["t"]), "left").drop("k", "t")
    return d.select(F.col("_key").alias(key), F.col("_t").alias("text_key"), "n_words", "spans", "items")


def words_covered(spans):
    """Number of words in the union of the spans [from, to) (null: 0)."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))

    def add(acc, s):
        begin = F.greatest(acc["end"], s["from"])
        return F.struct(F.greatest(acc["end"], s["to"]).alias("end"),
                        (acc["total"] + F.greatest(s["to"] - begin, F.lit(0).cast("long"))).alias("total"))

    return F.coalesce(F.aggregate(F.array_sort(spans), start, add)["total"], F.lit(0).cast("long"))


def remove_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without any hit, columns unchanged."""
    found = find_contamination(docs, items, key, text, **options)
    bad = found.filter(F.col("spans").isNotNull()).select(F.col(key).alias("_k"), F.col("text_key").alias("_t")).distinct()
    bad = if_small(written(bad, "bench-bad"))
    return docs.join(bad, docs[key].eqNullSafe(bad["_k"]) & (F.xxhash64(docs[text]) == bad["_t"]), "left_anti")
