import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from raremine.llm import quality, suffixes


def repeated(words, k):
    grams = Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    hit = set()
    for i in range(len(words) - k + 1):
        if grams[tuple(words[i:i + k])] > 1:
            hit |= set(range(i, i + k))
    return len(hit)


def longest(words):
    lo, hi = 0, len(words)
    while lo < hi:
        k = (lo + hi + 1) // 2
        grams = [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]
        lo, hi = (k, hi) if len(set(grams)) < len(grams) else (lo, k - 1)
    return lo


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    long_ = longest(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, repeated(words, 5),
            repeated(words, quality.MIN_REPEAT), long_ if long_ >= quality.MIN_REPEAT else 0)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array_and_lcp(xs):
    t = np.array([*[x + 1 for x in xs], 0], dtype=np.int64)
    want = sorted(range(len(t)), key=lambda i: t[i:].tolist())
    sa = suffixes.suffix_array(t)
    assert sa.tolist() == want
    lcp = suffixes.permuted_lcp(t, sa)[sa]
    for k in range(1, len(sa)):
        a, b = t[sa[k - 1]:], t[sa[k]:]
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        assert lcp[k] == n


def test_measures_against_brute_force(docs, rows):
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"]
    out = quality.measure_documents(docs).collect()
    want = Counter((i, *brute(t)) for i, t in rows)
    assert Counter((r.doc_id, *[r[c] for c in cols]) for r in out) == want
    for r in out:
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed
        assert r.kept == (not failed and r.n_covered <= quality.MAX_COVERED * r.n_words
                          and r.longest_repeat <= quality.MAX_REPEAT_WORDS)


def test_kept_rows_keep_their_columns(docs, empty):
    kept = quality.keep_documents(docs)
    assert kept.columns == docs.columns
    assert 0 < kept.count() < docs.count()
    assert quality.measure_documents(empty).count() == 0
    assert quality.measure_documents(docs.withColumn("n_words", docs.size)).columns.count("n_words") == 1


def test_a_long_single_repeat_is_refused(spark):
    words = [f"w{i}" for i in range(5000)]
    twice = words[:2000] + words[100:250] + words[2000:]
    df = spark.createDataFrame([(0, " ".join(words)), (1, " ".join(twice))], "doc_id long, text string")
    got = {r.doc_id: (r.base_failed, r.longest_repeat, r.kept) for r in quality.measure_documents(df).collect()}
    assert got == {0: (False, 0, True), 1: (False, 150, False)}
