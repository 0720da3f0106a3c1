import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from raremine.llm import induced, suffix_dedup


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
        kept = bytes(b for b, g in zip(r, gone) if not g)
        yield len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=70))
def test_induced_suffix_array(xs):
    t = np.array([*xs, 0])
    assert induced.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def test_induced_suffix_array_of_runs_and_text():
    for raw in (b"a" * 900, b"ab" * 500, b"banana" * 60 + b"bandana" * 60, bytes(range(1, 255)) * 3):
        t = np.append(np.frombuffer(raw, np.uint8).astype(np.int64), 0)
        assert induced.suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: raw[i:])


def result(df):
    return Counter((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("anchor_bytes", [suffix_dedup.ANCHOR_BYTES, 400])
def test_against_brute_force(docs, rows, anchor_bytes):
    want = Counter(brute([t for _, t in rows], 200))
    got = suffix_dedup.remove_repeats(docs, shard_bytes=20_000, anchor_bytes=anchor_bytes)
    assert result(got) == want and sum(n for (_, gone, *_), n in want.items() if gone) > 10


def test_short_lengths_and_periods(spark):
    texts = ["abcabcabcabcabcabcx", "zzzzzzzzzzzzzz", "hello world this is it", "say hello world this is all", "é" * 9, None, "", "abc"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for length, gram in ((6, 3), (8, 5), (9, 2)):
        assert result(suffix_dedup.remove_repeats(df, length=length, gram=gram)) == Counter(brute(texts, length))


def test_repeated_rows_and_empty(spark, empty):
    x = "".join(chr(97 + i * i % 23) for i in range(260))
    df = spark.createDataFrame([(1, x), (1, x), (None, x + "!"), (2, x[:199])], "doc_id long, text string")
    assert result(suffix_dedup.remove_repeats(df)) == Counter(brute([x, x, x + "!", x[:199]], 200))
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_kept_bytes(spark):
    x = "".join(chr(97 + i * i % 23) for i in range(260))
    df = spark.createDataFrame([(1, "A" + x + "B"), (2, x + "C")], "doc_id long, text string")
    out = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(df, texts=True).collect()}
    assert out == {1: b"AB", 2: b"C"}
