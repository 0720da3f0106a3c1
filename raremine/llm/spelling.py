"""Spelling variants: words one edit apart, found with an FM-index.

Words that are one edit apart agree on either half of the query.  A word asks
twice (a search scheme): once with its first half matched exactly and one edit
somewhere in the rest, once the other way round.  Words that share the exact
part meet in a shard; a shard holds an FM-index of its delimited words and one
of the same words reversed (together: bidirectional), so that the exact part is
always matched first and the search goes on across the part with the edit,
keeping intervals of suffix ranks.  All queries of a shard move through the
index together, one symbol at a time.

An exact part that more than ``hot`` rows share is made longer: the part that
may hold the edit is halved again, and again, until few words share the rest or
the edit has two places left, so no shard depends on how common a stem is.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raremine.llm.store import if_small, written
from raremine.llm.suffixes import suffix_array
from raremine.llm.textops import LOWER, byte_class, text_blocks

LETTERS = byte_class((0x41, 0x5A), (0x61, 0x7A))
MIN_LENGTH, MIN_COUNT, RATIO, DROP = 6, 5, 5, 199
#: Rows (a word under an exact part) of a shard, rows that may share an exact part.
SHARD_ROWS, HOT = 20_000, 20_000
#: Runs up to this many bytes get their check sum in numpy, all at once.
SHORT = 48


# -------------------------------------------------------------- the words ----

def runs(data: np.ndarray, offs: np.ndarray):
    """Start and end byte of every maximal run of A-Z, a-z and U+00C0 to U+00FF
    (two bytes that begin with C3), and the text each lies in."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    lead = data == 0xC3
    inside = LETTERS[data] | lead
    inside[1:] |= lead[:-1]
    edge = np.zeros(len(data) + 1, bool)          # no run goes from one text into the next
    edge[offs] = True
    start = np.flatnonzero(inside & (np.append(True, ~inside[:-1]) | edge[:-1]))
    end = np.flatnonzero(inside & (np.append(~inside[1:], True) | edge[1:])) + 1
    return start, end, np.searchsorted(offs, start, side="right") - 1


_crc: dict = {}


def _crc_table() -> np.ndarray:
    if "table" not in _crc:
        t = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
        _crc["table"] = t
    return _crc["table"]


def run_sums(data: np.ndarray, start: np.ndarray, end: np.ndarray, prefix_crc: np.ndarray) -> np.ndarray:
    """crc32 of prefix and run, carried on from the crc32 of each run's prefix:
    byte by byte, all short runs at once."""
    table = _crc_table()
    size = end - start
    out = np.zeros(len(start), np.uint32)
    order = np.argsort(-np.minimum(size, SHORT + 1), kind="stable")
    live = order[size[order] <= SHORT]
    state = ~prefix_crc[live].astype(np.uint32)
    at, left = start[live], size[live]
    for k in range(int(left.max()) if len(left) else 0):
        n = int(np.searchsorted(-left, -k, side="left"))      # runs with more than k bytes come first
        state[:n] = table[(state[:n] ^ data[at[:n] + k]) & 0xFF] ^ (state[:n] >> 8)
    out[live] = ~state
    for i in order[size[order] > SHORT].tolist():
        out[i] = zlib.crc32(data[start[i]:end[i]].tobytes(), int(prefix_crc[i]))
    return out


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, drop: int = DROP) -> DataFrame:
    """(word, n): all words of ``min_length`` code points or more.  A run whose
    crc32 of ``<key>:<run>`` is divisible by ``drop`` loses a code point."""
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))

    def run(batches):
        for part, data, offs in text_blocks(batches):
            data = LOWER[data]
            start, end, doc = runs(data, offs)
            points = np.cumsum(np.append(0, (data & 0xC0) != 0x80))
            keep = points[end] - points[start] >= min_length
            start, end, doc = start[keep], end[keep], doc[keep]
            if not len(start):
                continue
            prefix = np.array([zlib.crc32(f"{i}:".encode()) for i in part.column(0).to_pylist()], np.uint32)
            crc = run_sums(data, start, end, prefix[doc])
            changed = crc % drop == 0
            rest = ~changed
            sizes = end[rest] - start[rest]
            bounds = np.append(0, np.cumsum(sizes))
            flat = np.repeat(start[rest] - bounds[:-1], sizes) + np.arange(bounds[-1])
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[flat])])
            cut = []
            for i in np.flatnonzero(changed).tolist():
                word = data[start[i]:end[i]].tobytes().decode()
                at = int(crc[i]) % len(word)
                if len(word) > min_length:
                    cut.append((word[:at] + word[at + 1:]).encode())
            for found in (words, pa.array(cut, pa.large_binary())):
                counts = found.value_counts()
                yield pa.RecordBatch.from_arrays([counts.field("values").cast(pa.large_string()).cast(pa.string()), counts.field("counts").cast(pa.int64())], names=["word", "n"])

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# -------------------------------------------------------------- the index ----

class Index:
    """FM-index of delimited words: symbol 0 before, between and after them.
    ``extend`` prepends a symbol to what the bound of a suffix-rank interval
    stands for."""

    def __init__(self, words: list[np.ndarray]):
        sizes = np.array([len(w) + 1 for w in words], np.int64)
        self.starts = np.append(0, np.cumsum(sizes))[:-1]       # place of the delimiter before each word
        n = int(sizes.sum()) + 1
        t = np.zeros(n, np.int64)
        inner = np.ones(n, bool)
        inner[self.starts] = False
        inner[-1] = False
        if words:
            t[inner] = np.concatenate(words)
        ended = np.append(t + 1, 0)                             # the sentinel that the sort asks for
        self.sa = suffix_array(ended)[1:]
        before = t[self.sa - 1]                                 # suffix 0 takes the last delimiter: the text as a ring
        self.width = n + 1
        self.keys = np.sort(before * self.width + np.arange(n))
        self.before = before                                    # the symbol before each suffix, by rank
        self.n = n

    def extend(self, symbol, bound):
        return np.searchsorted(self.keys, symbol * self.width + bound)

    def word_at(self, rank):
        return np.searchsorted(self.starts, self.sa[rank])


def one_edit(index: Index, patterns: list[np.ndarray], exact: np.ndarray, window: np.ndarray, symbols: int):
    """(query, word) pairs: words that differ from a pattern by one edit.  The
    last ``exact`` symbols of a pattern and those before the ``window`` symbols
    in front of them match as they are; the edit lies in or beside the window.
    Intervals of all patterns move from right to left together."""
    length = np.array([len(p) for p in patterns], np.int64)
    longest = int(length.max()) if len(length) else 0
    table = np.zeros((len(patterns), longest + 1), np.int64)    # patterns as they are consumed
    for i, p in enumerate(patterns):
        table[i, :len(p)] = p[::-1]
    everything = np.arange(len(patterns))
    lo = np.full(len(patterns), index.extend(0, 0))
    hi = np.full(len(patterns), index.extend(0, index.n))
    q0, l0, h0 = everything, lo, hi                             # no edit yet
    q1 = l1 = h1 = np.zeros(0, np.int64)                        # after the edit
    found = []
    alphabet = np.arange(1, symbols + 1)

    def grown(q, a, b, symbol):
        a, b = index.extend(symbol, a), index.extend(symbol, b)
        live = a < b
        return q[live], a[live], b[live]

    def by_all(q, a, b, but=None):
        """Each state once for every symbol found before it (but one of its
        own): read off the suffixes of a narrow interval, tried for a wide one."""
        k = len(alphabet)
        narrow = b - a < k
        x = np.flatnonzero(narrow)
        n = b[x] - a[x]
        rank = np.repeat(a[x] - np.cumsum(n) + n, n) + np.arange(n.sum())
        state = np.unique(np.repeat(x, n) * (k + 1) + index.before[rank])
        state = state[state % (k + 1) > 0]
        wide = np.flatnonzero(~narrow)
        x = np.concatenate([state // (k + 1), np.repeat(wide, k)])
        s = np.concatenate([state % (k + 1), np.tile(alphabet, len(wide))])
        if but is not None:
            other = s != but[x]
            x, s = x[other], s[other]
        return grown(q[x], a[x], b[x], s)

    for t in range(longest + 1):
        inside = (t >= exact[q0]) & (t <= exact[q0] + window[q0])
        add = by_all(q0[inside], l0[inside], h0[inside])        # a symbol more than the pattern has
        q1, l1, h1 = (np.concatenate(x) for x in zip((q1, l1, h1), add))
        end = length[q1] == t
        q, a, b = grown(q1[end], l1[end], h1[end], 0)           # the delimiter before the word
        if len(q):
            n = b - a
            rank = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
            found.append((np.repeat(q, n), index.word_at(rank)))
        on = length[q1] > t
        q1, l1, h1 = q1[on], l1[on], h1[on]
        on = length[q0] > t
        q0, l0, h0 = q0[on], l0[on], h0[on]
        inside = (t >= exact[q0]) & (t < exact[q0] + window[q0])
        swap = by_all(q0[inside], l0[inside], h0[inside], table[q0[inside], t])   # another symbol instead
        skip = q0[inside], l0[inside], h0[inside]                                 # a symbol less
        q1, l1, h1 = (np.concatenate(x) for x in zip(grown(q1, l1, h1, table[q1, t]), swap, skip))
        q0, l0, h0 = grown(q0, l0, h0, table[q0, t])
        # equal states come from edits of equal neighbours: one of them goes on
        if len(q1) > 1:
            order = np.lexsort((h1, l1, q1))
            q1, l1, h1 = q1[order], l1[order], h1[order]
            new = np.append(True, (q1[1:] != q1[:-1]) | (l1[1:] != l1[:-1]) | (h1[1:] != h1[:-1]))
            q1, l1, h1 = q1[new], l1[new], h1[new]
    if not found:
        z = np.zeros(0, np.int64)
        return z, z
    pairs = np.unique(np.concatenate([q * len(index.starts) + w for q, w in found]))
    return pairs // len(index.starts), pairs % len(index.starts)


def _search_shard(table: pa.Table) -> pa.Table:
    """(word, near, near_n) of one shard: rows (word, n, ask, i, j)."""
    words = table.column("word").to_pylist()
    number: dict[str, int] = {}
    texts, counts = [], []
    for w, n in zip(words, table.column("n").to_pylist()):
        if w not in number:
            number[w] = len(texts)
            texts.append(w)
            counts.append(n)
    letters = {c: i + 1 for i, c in enumerate(sorted(set("".join(texts))))}
    coded = [np.array([letters[c] for c in w], np.int64) for w in texts]
    asking = sorted({(number[w], i, j) for w, ask, i, j in zip(words, table.column("ask").to_pylist(), table.column("i").to_pylist(),
                                                              table.column("j").to_pylist()) if ask})
    out = []
    for reverse in (False, True):
        some = [(x, i, j) if not reverse else (x, j, i) for x, i, j in asking if (i > j) == reverse]
        if not some:
            continue
        index = Index([c[::-1] for c in coded] if reverse else coded)
        for lo in range(0, len(some), 4096):
            part = some[lo:lo + 4096]
            pats = [coded[x][::-1] if reverse else coded[x] for x, _, _ in part]
            exact = np.array([j for _, _, j in part], np.int64)
            window = np.array([len(p) - i - j for p, (_, i, j) in zip(pats, part)], np.int64)
            q, w = one_edit(index, pats, exact, window, len(letters))
            out += [(part[a][0], b) for a, b in zip(q.tolist(), w.tolist())]
    out = sorted(set(out))
    return pa.table([pa.array([texts[a] for a, _ in out], pa.string()), pa.array([texts[b] for _, b in out], pa.string()),
                     pa.array([counts[b] for _, b in out], pa.int64())], names=["word", "near", "near_n"])


# -------------------------------------------------------- over the corpus ----

def _meetings(words: DataFrame, hot: int) -> DataFrame:
    """(word, n, ask, i, j, key): each word as a query of its own length, and as
    a word that queries of its length, one less and one more look for, under
    the exact parts they share: its first i and its last j characters."""
    size = F.length("word")
    rows = words.select("word", "n", size.alias("m"), F.explode(F.array(size - 1, size, size + 1)).alias("len"))
    half = (F.col("len") / 2).cast("int")
    rows = rows.select("*", F.explode(F.array(F.struct(half.alias("i"), F.lit(0).alias("j")),
                                              F.struct(F.lit(0).alias("i"), (F.col("len") - half).alias("j")))).alias("e"))
    ask = F.col("m") == F.col("len")

    def keyed(df):
        part = F.struct("i", "j", F.expr("substring(word, 1, i)").alias("a"), F.expr("substring(word, m - j + 1, j)").alias("b"))
        return df.withColumn("part", part)

    rows = keyed(rows.select("word", "n", "m", "len", "e.i", "e.j").withColumn("ask", ask))
    done = []
    while True:
        rows = written(rows, "meetings")
        often = written(rows.filter(F.col("len") - F.col("i") - F.col("j") > 2).groupBy("part").agg(F.count(F.lit(1)).alias("c"))
                        .filter(F.col("c") > hot).select("part"), "hot-parts")
        if not often.count():
            done.append(rows)
            break
        often = if_small(often)
        done.append(rows.join(often, "part", "left_anti"))
        again = rows.join(often, "part", "left_semi")
        middle = ((F.col("i") + F.col("len") - F.col("j")) / 2).cast("int")
        again = again.select("*", F.explode(F.array(F.struct(middle.alias("i2"), F.col("j").alias("j2")),
                                                    F.struct(F.col("i").alias("i2"), (F.col("len") - middle).alias("j2")))).alias("e"))
        # a text one shorter than the query may not have room for both parts
        rows = keyed(again.select("word", "n", "m", "len", "ask", F.col("e.i2").alias("i"), F.col("e.j2").alias("j"))
                     .filter(F.col("i") + F.col("j") <= F.col("m")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def near_pairs(words: DataFrame, shard_rows: int = SHARD_ROWS, hot: int = HOT) -> DataFrame:
    """(word, near, near_n): both directions of every pair of words (word, n),
    each word once, that differ by one inserted, deleted or replaced character."""
    rows = _meetings(words, hot)
    shards = max(1, -(-rows.count() // shard_rows))
    dealt = rows.select(F.pmod(F.xxhash64("part"), F.lit(shards)).alias("shard"), "word", "n", "ask", "i", "j").distinct()
    return dealt.groupBy("shard").applyInArrow(_search_shard, "word string, near string, near_n long").distinct()


def variant_forms(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                  ratio: int = RATIO, drop: int = DROP, shard_rows: int = SHARD_ROWS, hot: int = HOT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``min_length`` code
    points found ``min_count`` times.  A word's form is its near word of largest
    n (ties: smallest in code-point order) if that n is ``ratio`` times its own;
    the root follows forms to the last.

    Null texts have no words; a null key stands for no characters before the
    colon; texts and words of any length are read whole; repeated rows count
    each; an empty table gives an empty result; further columns are not read.
    """
    counted = count_words(docs, key, text, min_length, drop)
    words = written(counted.filter((F.col("n") >= min_count) & (F.length("word") >= min_length)), "words")
    near = near_pairs(words, shard_rows, hot).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    large = -F.col("best.less") >= F.col("n") * ratio
    rows = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(large, F.col("best.form")).alias("form"), F.when(large, -F.col("best.less")).alias("form_n"))
    rows = written(rows, "forms")
    return rows.join(_roots(rows), "word").select("word", "form", "root", "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): pointers to forms are doubled until none moves.  n grows
    along a chain, so chains end, after a logarithm of their length of rounds."""
    up = written(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        moved = up.filter("word <> root").select(F.col("word").alias("root"), F.col("root").alias("above"))
        # only words that are not roots themselves lead further: a root many words share has no row there
        up, before = written(up.join(moved, "root", "left").select("word", F.coalesce("above", "root").alias("root"),
                                                                   F.col("above").isNotNull().alias("moved")), "roots"), up
        if not up.filter("moved").count():
            return before
        up = up.drop("moved")
