import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from raremine.llm import packing


def library_ids(texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids + [2] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check(out, rows, capacity):
    want = {}
    for (i, t), ids in zip(rows, library_ids([t for _, t in rows])):
        want.setdefault((i, zlib.crc32((t or "").encode())), []).append(ids)
    ids_of = defaultdict(list)
    for (i, _), lists in want.items():
        ids_of[i] += lists
    left = sorted((str(i), p, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes()))
                  for i, lists in ids_of.items() for ids in lists
                  for p, (a, b) in enumerate(packing.cut(ids, capacity)))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out) == left
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(r[3] for r in left) // capacity)


def test_pieces_are_those_of_the_library_and_bins_are_tight(docs, rows):
    used, least = check(packing.pack_documents(docs).collect(), rows, 1024)
    assert used <= least * 1.02 + 2


def test_special_strings_inside_texts(spark):
    e = "<|endoftext|>"
    texts = [e, e + e, f"a {e} b", f"{e} a", f"a{e}", f"in{e}side {e}", f" {e} ", "<|endoftext", "<|ENDOFTEXT|>", f"<|{e}|>",
             f"\n{e}\n\n{e} x", "<|endoftext |>", f"it's{e}'s"]
    rows = list(enumerate(texts))
    check(packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), capacity=7).collect(), rows, 7)


def test_many_rounds(docs, rows):
    out = packing.pack_documents(docs, capacity=200, group_rows=12, fan_in=3, slack=2).collect()
    used, least = check(out, rows, 200)
    assert used <= least * 1.05 + 2


def test_rounds_go_on_while_they_save_bins(spark):
    """Few of many open bins fit together, so that each round saves little."""
    rows = [(i, " a" * (45 if i % 25 == 0 else 60)) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = packing.pack_documents(df, capacity=100, group_rows=10, fan_in=2, slack=2).collect()
    assert len(out) == 800 and {r.length for r in out} == {46, 61}
    assert len({r.sequence_id for r in out}) <= 768 + 16 + 3


def test_only_longer_documents_are_cut():
    assert packing.cut(range(5), 8) == [(0, 5)]
    assert packing.cut(range(8), 8) == [(0, 8)]
    assert packing.cut(range(19), 8) == [(0, 3), (3, 11), (11, 19)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_best_fit(sizes):
    bins = packing.best_fit(sizes, 30)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 30 for b in bins)
    if len(bins) > 1:                       # no two bins fit into one
        fill = sorted(sum(sizes[i] for i in b) for b in bins)
        assert fill[0] + fill[1] > 30


def test_empty(empty):
    assert packing.pack_documents(empty).count() == 0
