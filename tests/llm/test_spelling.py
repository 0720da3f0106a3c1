import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from raremine.llm import spelling as S


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute_words(rows, drop=199):
    c = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % drop == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            c[run] += 1
    return c


def edits(w, letters):
    out = set()
    for i in range(len(w) + 1):
        out.update(w[:i] + c + w[i:] for c in letters)
        if i < len(w):
            out.add(w[:i] + w[i + 1:])
            out.update(w[:i] + c + w[i + 1:] for c in letters)
    return out - {w}


def brute(rows, least=5, ratio=5, drop=199):
    words = {w: n for w, n in brute_words(rows, drop).items() if len(w) >= 6 and n >= least}
    letters = set("".join(words))
    form, out = {}, []
    near_of = {w: [x for x in edits(w, letters) if x in words] for w in words}
    for w, n in words.items():
        best = min(near_of[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= ratio * n else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near_of[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=lambda r: r[0])


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(2)
    stems = ["running", "Walking", "étranger", "aaaaaa", "aaaaaaa", "abcabcabc", "straße", "prefixword", "prefixward", "x×y÷zab"]
    rows = []
    for i in range(400):
        words = []
        for _ in range(30):
            w = r.choice(stems)
            if r.random() < 0.3:
                at = r.randrange(len(w))
                w = r.choice([w[:at] + w[at + 1:], w[:at] + r.choice("abeé") + w[at:], w[:at] + r.choice("abeé") + w[at + 1:]])
            words.append(w)
        rows.append((i, " ".join(words) if i % 3 else "-".join(words).upper()))
    rows += [(None, "running " * 50), (7, None), (8, ""), (9, "y" * 3000 + " " + "y" * 2999 + " " + ("q" * 70 + " ") * 9 + ("q" * 71 + " ") * 60),
             rows[0], rows[0], (3, "other text under an id"), (5, "Ā running中runningſ")]
    # a chain of forms
    rows += [(1000 + k, "chainaa " * 5 + "chainab " * 25 + "chainbb " * 125 + "chbinbb " * 700)  for k in range(1)]
    return rows


@pytest.fixture(scope="module")
def table(spark, corpus):
    return spark.createDataFrame([(i, t, "k", 5, "w") for i, t in corpus], "doc_id long, text string, word string, n long, part string").repartition(4)


def test_equals_brute_force(table, corpus):
    want = brute(corpus)
    assert len({r[2] for r in want}) < len(want) and any(r[1] and r[2] != r[1] for r in want)
    assert result(S.variant_forms(table)) == want


def test_many_shards_and_longer_exact_parts(table, corpus):
    """Parts shared by three words or more are halved again; shards of a few words."""
    want = brute(corpus, least=2, drop=7)
    assert result(S.variant_forms(table, min_count=2, drop=7, shard_rows=20, hot=3)) == want


def test_real_texts(docs, rows):
    assert result(S.variant_forms(docs, min_count=2)) == brute(rows, least=2)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=6, max_size=9), min_size=1, max_size=40, unique=True), st.data())
def test_one_edit(words, data):
    coded = [np.array([ord(c) - 96 for c in w], np.int64) for w in words]
    index = S.Index(coded)
    w = data.draw(st.sampled_from(words))
    j = data.draw(st.integers(0, len(w)))
    p = coded[words.index(w)]
    q, x = S.one_edit(index, [p, p], np.array([j, 0]), np.array([len(w) - j, len(w)]), 2)
    near = {v for v in words if v in edits(w, "ab")}
    assert {words[b] for a, b in zip(q, x) if a == 1} == near
    tail = w[len(w) - j:]
    assert {words[b] for a, b in zip(q, x) if a == 0} == {v for v in near if v.endswith(tail) and v[:len(v) - j] in edits(w[:len(w) - j], "ab")}


def test_crc_of_runs():
    r = random.Random(1)
    words = ["".join(r.choice("abcé") for _ in range(r.randrange(1, 120))) for _ in range(300)]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    start, end, _ = S.runs(data, np.array([0, len(data)]))
    prefix = np.array([zlib.crc32(f"{i}:".encode()) for i in range(300)], np.uint32)
    assert S.run_sums(data, start, end, prefix).tolist() == [zlib.crc32(f"{i}:{w}".encode()) for i, w in enumerate(words)]


def test_empty(empty, spark):
    assert S.variant_forms(empty).count() == 0
    assert S.variant_forms(spark.createDataFrame([(None, None), (1, "short words")], "doc_id long, text string")).count() == 0
