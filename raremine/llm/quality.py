"""Quality rules from suffix-array repetition.

Every text is a sequence of words.  A suffix array over them and its
longest-common-prefix intervals give the maximal repeated word strings; their
spans are united, and a text is refused when too large a part of its words is
covered or when a single repeat is too long.  The whole text counts; texts are
put into blocks only to vectorise the work, and no repeat crosses texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raremine.llm.suffixes import longest_repeat_at
from raremine.llm.textops import NOT_SPACE, mix64, span_hash, text_blocks, word_spans

MIN_WORDS = 10
#: Words of the windows counted as repeated, and the part of words they may cover.
WINDOW_WORDS, MAX_REPEATED = 5, 0.20
#: Limits on maximal repeats of at least MIN_REPEAT words.
MIN_REPEAT, MAX_COVERED, MAX_REPEAT_WORDS = 10, 0.20, 100

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "n_covered long, longest_repeat long")


def _per_text(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offs[1:]] - sums[offs[:-1]]


def _covered(depth: np.ndarray, least: int) -> np.ndarray:
    """Flags of tokens inside a repeat of at least ``least`` tokens."""
    at = np.arange(len(depth))
    reach = np.maximum.accumulate(np.where(depth >= least, at + depth, 0))
    return reach > at


def _repeated_lines(data, offs, start, w_offs):
    """Lines with a word that equal an earlier line of their text, per text."""
    breaks = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([offs[:-1], breaks + 1]))
    end = np.sort(np.concatenate([breaks, offs[1:]]))
    # a line belongs to the text in which it begins; with empty texts several begin at one byte
    doc = np.sort(np.concatenate([np.arange(len(offs) - 1), np.searchsorted(offs[1:], breaks, side="right")]))
    has_word = np.searchsorted(start, end) > np.searchsorted(start, begin)
    doc, begin, end = doc[has_word], begin[has_word], end[has_word]
    key = mix64(span_hash(data, begin, end) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[first] = False
    return np.bincount(doc[again], minlength=len(offs) - 1)


def measure(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """The columns MEASURES for the texts of one block."""
    n = len(offs) - 1
    start, end, w_offs = word_spans(data, offs, NOT_SPACE)
    words = np.diff(w_offs)
    doc = np.repeat(np.arange(n), words)
    in_word = np.zeros(len(data) + 1, np.int32)
    in_word[start] += 1
    in_word[end] -= 1
    inside = np.cumsum(in_word[:-1]) > 0 if len(data) else np.zeros(0, bool)
    chars = _per_text(inside & ((data & 0xC0) != 0x80), offs)
    symbols = _per_text(SYMBOLS[data], offs)
    # one sequence: the words of each text, told apart by text, and an end mark of its own after each
    at = np.arange(len(start)) + doc
    tokens = np.empty(len(start) + n, np.uint64)
    tokens[at] = mix64(span_hash(data, start, end) + (doc + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    tokens[w_offs[1:] + np.arange(n)] = mix64((np.arange(n, dtype=np.uint64) + np.uint64(1)) << np.uint64(32))
    depth = longest_repeat_at(tokens)
    t_offs = w_offs + np.arange(n + 1)
    longest = np.maximum.reduceat(depth, t_offs[:-1]) if n else depth
    return [words, chars, symbols, _repeated_lines(data, offs, start, w_offs) if n else words,
            _per_text(_covered(depth, WINDOW_WORDS), t_offs), _per_text(_covered(depth, MIN_REPEAT), t_offs),
            np.where(longest >= MIN_REPEAT, longest, 0)]


def measure_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures and the verdict appended.

    Names: those of MEASURES, ``base_failed`` and ``kept``; columns of the
    input with such a name are replaced.  Null and empty texts have no words
    and fail the base rule; equal rows get equal results; an empty table gives
    an empty result.
    """
    names = [c.split()[0] for c in MEASURES.split(", ")]
    carried = [c for c in docs.columns if c not in (*names, "base_failed", "kept")]
    rows = docs.select(*carried)

    def run(batches):
        for part, data, offs in text_blocks(batches, text):
            cols = [pa.array(np.asarray(c, dtype=np.int64)) for c in measure(data, offs)]
            yield pa.RecordBatch.from_arrays([*part.columns, *cols], names=[*carried, *names])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields] + [MEASURES])
    n = F.col("n_words")
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > int(100 * MAX_REPEATED) * n)
    fine = (F.col("n_covered") <= MAX_COVERED * n) & (F.col("longest_repeat") <= MAX_REPEAT_WORDS)
    return (rows.mapInArrow(run, schema)
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & fine))


def keep_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text passes the rules, columns unchanged."""
    return measure_documents(docs, text).filter("kept").select(*docs.columns)
