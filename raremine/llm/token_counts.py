"""Token counts of whole texts by overlap resynchronisation.

Texts of at most ``chunk`` bytes need no splices.  A longer one is cut
into chunks that overlap; chunks are rows of their own, so one huge document is
encoded by many tasks.  Two chunks are spliced at a place that is proven to be
a token boundary of the whole text:

* both encodings start a word (a piece that the pre-tokenizer found) there.
  The pre-tokenizer scans from left to right, its pattern looks neither back
  nor further ahead than its match, and merges stay inside a word.  The left
  chunk, right up to this place by induction from the start of the text, says
  that a word of the text starts there; the right chunk scans on from there as
  the whole text does.
* the character there does not combine with the one before it, so that
  normalisation of the text is that of both sides.
* the left chunk goes on for ``MARGIN`` characters more, so that neither its
  end nor a special string cut by it changes what lies before.

Where an overlap has no such place (one word covers it), the document is done
again with chunks and overlaps four times as long, until a chunk holds it all.
"""

from __future__ import annotations

import json
import os
import re
import string
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raremine.llm.store import written
from raremine.llm.textops import LOWER, text_blocks

#: Characters of a chunk, characters that two chunks share, characters of the
#: left chunk behind a splice (more than any special string has).
CHUNK, OVERLAP, MARGIN = 1 << 16, 1 << 9, 64
LIMIT = 2048
WIDER = 4
#: Stretches whose counts a task remembers, text bytes whose stretches are told apart at once.
KNOWN, BLOCK_BYTES = 400_000, 4 << 20
#: Fixed value: the word pattern of the vocabulary file.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_cache: dict = {}


def public_tokenizer(vocabulary: str | None = None):
    """The tokenizer of ``word_bpe_49k.json`` (or of another file), without
    truncation or padding, on one thread."""
    import public_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def combines_back() -> frozenset:
    """Characters that normalisation may join with, or move before, the one
    before them: second parts of canonical compositions, combining marks and
    the vowels and finals of Hangul."""
    if "back" not in _cache:
        found = set(map(chr, (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))))
        for code in range(0x110000):
            c = chr(code)
            if unicodedata.combining(c):
                found.add(c)
            parts = unicodedata.decomposition(c)
            if parts and not parts.startswith("<"):
                found.update(chr(int(x, 16)) for x in parts.split()[1:])
        _cache["back"] = frozenset(found)
    return _cache["back"]


def word_starts(encoding, text: str, lo: int, hi: int):
    """(places, tokens before each) where a word of the encoding starts at a
    character of ``text`` in [lo, hi) that does not combine with the one before."""
    words = np.array([-1 if w is None else w for w in encoding.word_ids], np.int64)
    if not len(words):
        return [], []
    first = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
    at = np.array([a for a, _ in encoding.offsets], np.int64)[first]
    keep = (at >= lo) & (at < hi)
    back = combines_back()
    places, before = [], []
    for p, n in zip(at[keep].tolist(), first[keep].tolist()):
        if text[p] not in back and (not places or places[-1] < p):
            places.append(p)
            before.append(n)
    return places, before


def cuts_are_proven(tokenizer) -> bool:
    """Whether :func:`stretches` cuts at proven boundaries for this tokenizer:
    words are the matches of the pattern that the cuts are made for, nothing but
    them is kept, the normaliser changes white space and single characters only,
    and special strings hold no white space or digit and no other sign but glue."""
    parts = json.loads(tokenizer.to_str())
    normal, words = parts["normalizer"] or {}, parts["pre_tokenizer"] or {}
    steps = [(x["type"], x.get("pattern"), x.get("content")) for x in normal.get("normalizers", [])]
    split = (words.get("pretokenizers") or [{}])[0]
    return (steps == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
            and split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") is True
            and split.get("pattern") == {"Regex": WORD_PATTERN}
            and all(re.fullmatch(r"[<|>'][A-Za-z<|>']*[<|>']", t["content"])
                    and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in parts["added_tokens"]))


def _kinds() -> np.ndarray:
    """Class of every byte: 0 white space, 1 letter, 2 digit, 3 sign, 4 glue."""
    kind = np.full(256, 4, np.uint8)
    kind[[0x20, *range(0x09, 0x0E)]] = 0
    kind[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
    kind[[*range(0x30, 0x3A)]] = 2
    kind[[ord(c) for c in string.punctuation if c not in "'<|>"]] = 3
    return kind


KIND = _kinds()


def stretches(data: np.ndarray, offs: np.ndarray):
    """Bytes to count by, and start and end of the stretches of texts that are
    encoded on their own.  Texts are cut at white space, around digits, and
    between letters (ASCII and U+00C0 to U+00FF) and signs: there a match of the
    word pattern ends and the next begins, whatever lies beyond.  Never beside
    glue, which is all that may join on: an apostrophe, the signs of special
    strings, and every other character beyond ASCII.  Letters A-Z of stretches
    without glue are lower-cased, as the normaliser does."""
    kind = KIND[data]
    latin = np.flatnonzero(data == 0xC3)
    latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]        # the two signs among the letters
    kind[latin] = kind[latin + 1] = 1
    left, right = kind[:-1], kind[1:]
    edge = np.ones(len(kind) + 1, bool)
    edge[1:-1] = (left == 0) | (right == 0) | ((left < 4) & (right < 4) & ((left != right) | (left == 2)))
    edge[offs] = True
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    keep = kind[start] > 0 if len(data) else np.zeros(0, bool)
    start, end = start[keep], end[keep]
    glue = np.append(0, np.cumsum(kind == 4))
    plain = np.repeat(glue[end] == glue[start], end - start)
    inner = data[kind > 0]
    return np.where(plain, LOWER[inner], inner), start, end


def _count_short(rows: DataFrame, vocabulary: str | None) -> DataFrame:
    """(id, n_bytes, n_tokens) of texts that need no splices of chunks.  If its
    cuts are proven, the distinct stretches of many texts are encoded, each
    once, and their counts added up; else whole texts are encoded."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        tokenizer = public_tokenizer(vocabulary)
        apart = cuts_are_proven(tokenizer)
        known: dict[str, int] = {}

        def encoded(texts):
            return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        for part, data, offs in text_blocks(batches, block_bytes=BLOCK_BYTES):
            if apart:
                kept, start, end = stretches(data, offs)
                ends = np.append(0, np.cumsum(end - start)).astype(np.int64)
                found = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(kept)).dictionary_encode()
                distinct = found.dictionary.to_pylist()
                if len(known) > KNOWN:
                    known.clear()
                new = [w for w in distinct if w not in known]
                for lo in range(0, len(new), 4096):
                    known.update(zip(new[lo:lo + 4096], encoded(new[lo:lo + 4096])))
                counts = np.array([known[w] for w in distinct], np.int64)
                upto = np.append(0, np.cumsum(counts[found.indices.to_numpy()])) if len(distinct) else np.zeros(1, np.int64)
                at = np.searchsorted(start, offs)
                n = upto[at[1:]] - upto[at[:-1]]
            else:
                n = encoded(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")


def _chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, k, last, part): chunk k of a text holds ``chunk`` characters of its
    own and ``overlap`` of the next chunk's."""
    n = F.greatest(F.lit(1), F.ceil(F.length("text") / F.lit(chunk)).cast("int"))
    return (long.select("row", "text", F.posexplode(F.sequence(F.lit(0), n - 1)).alias("k", "_"), (n - 1).alias("end"))
            .select("row", "k", (F.col("k") == F.col("end")).alias("last"),
                    F.substr("text", F.col("k") * chunk + 1, F.lit(chunk + overlap)).alias("part")))


def _encode_chunks(parts: DataFrame, chunk: int, overlap: int, vocabulary: str | None) -> DataFrame:
    """Per chunk its token count, and the word starts with the tokens before
    them in the characters shared with the chunk before and the one after."""
    def run(batches):
        tokenizer = public_tokenizer(vocabulary)
        for batch in batches:
            for i in range(batch.num_rows):
                row, k, last, text = (batch.column(j)[i].as_py() for j in range(4))
                e = tokenizer.encode(text, add_special_tokens=False)
                left = word_starts(e, text, 0, overlap) if k else ([], [])
                right = ([], []) if last else word_starts(e, text, chunk, chunk + overlap - MARGIN)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row], pa.int64()), pa.array([k], pa.int32()), pa.array([last]), pa.array([len(e)], pa.int64()),
                     pa.array([left[0]], pa.list_(pa.int64())), pa.array([left[1]], pa.list_(pa.int64())),
                     pa.array([[p - chunk for p in right[0]]], pa.list_(pa.int64())), pa.array([right[1]], pa.list_(pa.int64()))],
                    names=["row", "k", "last", "n", "left_at", "left_n", "right_at", "right_n"])

    return parts.mapInArrow(run, "row long, k int, last boolean, n long, left_at array<long>, left_n array<long>, "
                                 "right_at array<long>, right_n array<long>")


def _splice(coded: DataFrame) -> DataFrame:
    """(row, n_tokens): chunk k counts from its splice with chunk k - 1 to that
    with chunk k + 1; null if some overlap has no common word start.  Every
    chunk is sent on to the next one's number, so pairs meet by (row, number)
    and no task holds a whole document's chunks."""
    ends = coded.select("row", "k", F.lit(True).alias("own"), "n", "last", F.col("left_at").alias("at"), F.col("left_n").alias("before"))
    sent = coded.filter("not last").select("row", (F.col("k") + 1).alias("k"), F.lit(False).alias("own"), F.lit(0).cast("long").alias("n"),
                                           F.lit(False).alias("last"), F.col("right_at").alias("at"), F.col("right_n").alias("before"))

    def side(own: bool, column: str):
        return F.first(F.when(F.col("own") == F.lit(own), F.col(column)), ignorenulls=True)

    pairs = ends.unionByName(sent).groupBy("row", "k").agg(
        F.sum("n").alias("n"), side(True, "last").alias("last"), side(True, "at").alias("at"), side(True, "before").alias("before"),
        side(False, "at").alias("prev_at"), side(False, "before").alias("prev_before"))
    common = F.array_min(F.array_intersect("at", "prev_at"))
    pairs = pairs.withColumn("p", common)
    # tokens of the chunk before up to the splice, less those of this one before it
    kept = (F.element_at("prev_before", F.array_position("prev_at", F.col("p")).cast("int"))
            - F.element_at("before", F.array_position("at", F.col("p")).cast("int")))
    # a chunk that is not the last ends at its splice with the next: its own total counts only for the last one
    part = F.when(F.col("k") == 0, F.lit(0)).otherwise(kept) + F.when(F.col("last"), F.col("n")).otherwise(0)
    return pairs.groupBy("row").agg(F.when(F.count_if((F.col("k") > 0) & F.col("p").isNull()) == 0, F.sum(part)).alias("n_tokens"))


def count_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, chunk: int = CHUNK,
                 overlap: int = OVERLAP, vocabulary: str | None = None) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) per row: the tokens that the library
    gives for the whole text, without added special tokens; special strings
    inside a text are read as by the library's default.

    Null texts are empty: no byte, no token.  Null keys, repeated keys and
    repeated rows are rows like any other; an empty table gives an empty result;
    further columns are not read.  ``overlap`` must exceed ``MARGIN``.
    """
    if overlap <= MARGIN or chunk < overlap:
        raise ValueError("the overlap must be longer than MARGIN and no longer than a chunk")
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    # a text of at most ``chunk`` bytes has no more characters, and its length is known without a look at it
    short = _count_short(rows.filter(F.col("n_bytes") <= chunk), vocabulary)
    long = written(rows.filter(F.col("n_bytes") > chunk).withColumn("row", F.monotonically_increasing_id()), "long-texts")
    done, left = [short], long
    open_rows = long.count()
    while open_rows:
        parts = _chunks(left, chunk, overlap).repartition("row", "k")
        counts = written(_splice(_encode_chunks(parts, chunk, overlap, vocabulary)), "spliced")
        # ids and counts of long documents: a few numbers a document
        done.append(long.select("row", "id", "n_bytes").join(counts.filter("n_tokens is not null"), "row").select("id", "n_bytes", "n_tokens"))
        again = counts.filter("n_tokens is null").select("row")
        open_rows = again.count()
        if open_rows:
            left = left.join(again, "row", "left_semi")
            chunk, overlap = chunk * WIDER, overlap * WIDER
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(F.col("id").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
