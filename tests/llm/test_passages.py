import random
import re

import numpy as np
import pytest

from raremine.llm import passages


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(w[i:i + 5]) for i in range(len(w) - 4)]


def brute(a, b, length=46):
    """Largest similarity of two passages, over all pairs of intervals."""
    best = 0.0
    for i in range(len(a) - length + 1):
        x = set(a[i:i + length])
        for j in range(len(b) - length + 1):
            y = set(b[j:j + length])
            best = max(best, len(x & y) / len(x | y))
    return best


def test_tree_windows_are_those_of_a_cartesian_tree():
    rng = np.random.default_rng(3)
    sizes = [0, 3, 50, 7, 120, 8]
    w_offs = np.concatenate([[0], np.cumsum([s + 4 if s else 0 for s in sizes])])
    ends = w_offs[:-1] + np.array(sizes)
    h = rng.integers(0, 2**63, int(w_offs[-1]) - 4, dtype=np.uint64)
    got = set(zip(*(x.tolist() for x in passages.tree_windows(h, w_offs, ends, 8))))
    want = set()

    def split(doc, l, r):
        if r - l + 1 < 8:
            return
        c = min(range(l, r + 1), key=lambda i: (int(h[i]) >> 24, i))
        want.add((doc, c, l, r))
        split(doc, l, c - 1)
        split(doc, c + 1, r)

    for doc, (l, n) in enumerate(zip(w_offs[:-1].tolist(), sizes)):
        split(doc, l, l + n - 1)
    assert got == want and len(want) > 10


def test_windows_beyond_the_bits_of_a_place(monkeypatch):
    """A text with more shingles than places have bits for: all of its nodes."""
    rng = np.random.default_rng(8)
    h = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    w_offs, ends = np.array([0, 3004]), np.array([3000])
    whole = [x.tolist() for x in passages.tree_windows(h, w_offs, ends, 40)]
    monkeypatch.setattr(passages, "_PLACE_BITS", 9)
    few = [x.tolist() for x in passages.tree_windows(h, w_offs, ends, 40)]
    assert few == whole and max(few[1]) > 2900


def test_best_similarity_equals_sets():
    rng = np.random.default_rng(4)
    for trial in range(60):
        length = 8
        a = rng.permutation(200)[:rng.integers(8, 16)].astype(np.uint32)
        b = a.copy() if trial % 3 else rng.permutation(200)[:12].astype(np.uint32)
        b = np.delete(b, rng.integers(0, len(b))) if len(b) > 8 and trial % 2 else b
        if trial % 5 == 0:
            b = np.concatenate([b, b[:3]])             # shingles that stand twice
        na, nb = int(rng.integers(0, len(a))), int(rng.integers(0, len(b)))
        best = 0.0
        twice = len(set(b.tolist())) < len(b)
        for s in range(max(0, na - length + 1), min(na, len(a) - length) + 1):
            for t in range(max(0, nb - length + 1), min(nb, len(b) - length) + 1):
                if twice or abs((t - nb) - (s - na)) <= 2:
                    x, y = set(a[s:s + length].tolist()), set(b[t:t + length].tolist())
                    best = max(best, len(x & y) / len(x | y))
        assert abs(passages.best_similarity(a, na, b, nb, length) - best) < 1e-12


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(3000)]

    def prose(n):
        return [rnd.choice(words) for _ in range(n)]

    line = prose(14)                                    # a common line, shorter than a passage
    texts = []
    for g in range(6):
        p = prose(rnd.randint(52, 90))
        for k in range(4):
            q = list(p)
            if k == 1:
                q[len(q) // 2] = "changed"              # one word of the passage
            texts.append(prose(rnd.randint(0, 60)) + q + prose(rnd.randint(0, 60)))
        texts.append(prose(30) + p[:40] + prose(30))    # less than a passage
    texts += [prose(20) + line + prose(40) for _ in range(12)]
    texts += [prose(49), prose(50), prose(200)]
    out = [" ".join(t) for t in texts]
    return out + [out[0].upper(), "", None, "x " * 400, "x " * 300]


def classes(n, linked):
    root = list(range(n))
    for _ in range(n):
        for a, b in linked:
            root[a] = root[b] = min(root[a], root[b])
    return root


@pytest.mark.parametrize("max_kinds", [passages.MAX_KINDS, 2])
def test_classes_against_brute_force(spark, corpus, max_kinds):
    s = [shingles(t) for t in corpus]
    linked = [(i, j) for j in range(len(s)) for i in range(j) if brute(s[i], s[j]) >= 0.8]
    want = classes(len(s), linked)
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(corpus)], "doc_id long, text string, row string").repartition(4)
    out = passages.passage_classes(df, max_kinds=max_kinds).collect()
    got = {r.doc_id: r.class_id for r in out}
    together = [(i, j) for i, j in linked if got[i] == got[j]]
    assert len(together) >= 0.98 * len(linked) > 30                     # min-hashes are random
    assert all(want[i] == want[c] for i, c in got.items())              # nothing else is linked
    assert {r.doc_id for r in out if r.n_shared} <= {x for p in linked for x in p}


@pytest.mark.parametrize("m", [2, 60])
@pytest.mark.parametrize("near", [2, 5, 9, 36, 40, 43])
def test_comparison_finds_words_put_in_or_left_out_near_both_ends(m, near):
    """A word more changes five shingles and moves the rest by one; the node is beside it, on the short side."""
    rng = np.random.default_rng(near)

    def fresh(n):
        return rng.integers(1, 2**31, n).astype(np.uint32)

    p = fresh(45)                                                # shingles of the passage, 41 of them in common
    cut = min(near, 40)
    one = np.concatenate([fresh(20), p[:cut], fresh(4), p[cut + 4:], fresh(21)])
    more = np.concatenate([fresh(20), p[:cut], fresh(5), p[cut + 4:], fresh(20)])
    at = 20 + (cut - 1 if near < 20 else cut + 4)                # the last before or the first after the change
    shift = 0 if near < 20 else 1
    a, b = one[max(0, at - 45):at + 46], more[max(0, at + shift - 45):at + shift + 46]
    nodes = [at - max(0, at - 45), at + shift - max(0, at + shift - 45)]
    assert a[nodes[0]] == b[nodes[1]]
    others = [np.concatenate([fresh(45), a[nodes[0]:nodes[0] + 1], fresh(45)]) for _ in range(m - 2)]
    assert passages.best_similarity(a, nodes[0], b, nodes[1], 46) >= 0.8
    assert passages.linked_kinds([a, b, *others], nodes + [45] * (m - 2), 46, 0.8) == [(0, 1)]


@pytest.mark.parametrize("max_kinds", [passages.MAX_KINDS, 2])
def test_words_put_in_or_left_out_against_brute_force(spark, max_kinds):
    rnd = random.Random(5)

    def prose(n):
        return ["".join(rnd.choice("abcdefghij") for _ in range(7)) for _ in range(n)]

    texts = []
    for at in [4, 5, 6, 8, 10, 12, 14, 25, 36, 38, 40, 42, 44, 45, 46]:
        p = prose(50)
        texts += [prose(30) + p + prose(30), prose(25) + p[:at] + ["more"] + p[at:] + prose(35), prose(35) + p[:at] + p[at + 1:] + prose(25)]
    texts = [" ".join(t) for t in texts]
    s = [shingles(t) for t in texts]
    linked = [(i, j) for j in range(len(s)) for i in range(j - j % 3, j) if brute(s[i], s[j]) >= 0.8]
    want = classes(len(s), linked)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    # with many functions the signatures miss nothing, so that only the comparison can
    got = {r.doc_id: r.class_id for r in passages.passage_classes(df, functions=12, max_kinds=max_kinds).collect()}
    assert [got[i] for i in range(len(s))] == want and len(linked) >= 15


def test_similar_intervals_share_a_rare_shingle_and_a_common_line_is_none():
    rng = np.random.default_rng(8)
    line = rng.integers(1, 2**31, 30).astype(np.uint32)

    def kind(own):
        return passages._Context(np.concatenate([own[:30], line, own[30:]]), 45, 46)

    own = [rng.integers(1, 2**31, 61).astype(np.uint32) for _ in range(50)]
    heavy = line.copy()
    narrow = [set(passages.rare_shingles(kind(x), heavy, 46, 0.8)[0].tolist()) for x in own]
    assert not any(n & set(line.tolist()) for n in narrow)                      # the line joins no part
    assert not any(narrow[i] & narrow[j] for i in range(50) for j in range(i))
    for x in own:
        changed = x.copy()
        changed[27:30] = rng.integers(1, 2**31, 3)
        a, b = kind(x), kind(changed)
        assert passages.similar(a, b, 46, 0.8)
        for i in (0, 1):
            assert set(passages.rare_shingles(a, heavy, 46, 0.8)[i].tolist()) & set(passages.rare_shingles(b, heavy, 46, 0.8)[i].tolist())


def test_no_group_is_unbounded(spark, monkeypatch):
    """Many kinds around one node that all share a line: every group compared stays small, and the similar pairs are found."""
    rng = np.random.default_rng(4)
    line, rows = rng.integers(1, 2**31, 38).astype(np.uint32), []
    for i in range(120):
        own = rng.integers(1, 2**31, 53).astype(np.uint32)
        for k in range(2 if i % 10 == 0 else 1):
            rows.append((7, 7, 2 * i + k, 2 * i + k, 45, bytearray(np.concatenate([own[:26], line, own[26:52], own[52:] + np.uint32(k)]).tobytes())))
    kinds = spark.createDataFrame(rows, passages._KIND)
    sizes, inner = [], passages._compare

    def compare(kinds, *a):
        sizes.extend(r["count"] for r in kinds.groupBy("g").count().collect())
        return inner(kinds, *a)

    monkeypatch.setattr(passages, "_compare", compare)
    got = {(min(r.kind_a, r.kind_b), max(r.kind_a, r.kind_b)) for r in passages._verified(kinds, 46, 0.8, 20).collect()}
    assert {(2 * i, 2 * i + 1) for i in range(0, 120, 10)} == got
    assert max(sizes) <= 40


def test_blocks_meet_all_pairs_once(spark):
    kinds = spark.createDataFrame([(5, i, 100) for i in range(100)], "g long, kind long, count long")
    groups = {}
    for r in passages._in_blocks(kinds, 15).collect():
        groups.setdefault(r.g, []).append((r.kind, r.side))
    met = [tuple(sorted((a, b))) for rows in groups.values() for i, (a, x) in enumerate(rows) for b, y in rows[:i]
           if x != y or len({s for _, s in rows}) == 1]
    assert len(met) == len(set(met)) == 100 * 99 // 2 and max(map(len, groups.values())) < 60


def test_comparison_counts_moved_words():
    rng = np.random.default_rng(0)
    a = rng.integers(1, 2**31, 91).astype(np.uint32)
    assert passages.best_similarity(a, 45, a, 45, 46) == 1.0
    b = np.concatenate([a[:30], rng.integers(1, 2**31, 5).astype(np.uint32), a[34:]])     # a word more
    b = b[1:]
    assert passages.best_similarity(a, 45, b, 45, 46) >= 0.8
    assert sorted(passages.linked_kinds([a, b, a[:50].copy()], [45, 45, 45], 46, 0.8)) == [(0, 1), (0, 2)]


def test_repeated_rows_and_empty(spark, empty):
    t = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([(5, t), (5, t), (None, t), (9, t + " z"), (None, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shared > 0, r.class_id) for r in passages.passage_classes(df).collect())
    assert got == [("5", True, 5), ("5", True, 5), ("9", True, 5), ("None", False, None), ("None", True, 5)]
    assert passages.passage_classes(empty).count() == 0


def test_groups_at_once_equal_pairs_one_by_one():
    """Bounds and sets made for many pairs at once decide as the comparison of each pair does."""
    rng = np.random.default_rng(12)
    length, tokens, nodes, cuts = 46, [], [], [0]
    for m in [1, 2, 3, 2, 7, 12, 60]:
        p = rng.integers(1, 2**31, 91).astype(np.uint32)
        for k in range(m):
            q = p.copy()
            if k % 3 == 1:
                q[rng.integers(0, 5):][:3] = p[50]                   # shingles that stand twice
            if k % 4 == 2:
                q = np.concatenate([q[:30], rng.integers(1, 2**31, 5).astype(np.uint32), q[34:]])[1:]
                q[45] = p[45]
            if k % 5 == 3:
                q[20:40] = q[20]
            if k % 2:
                at = rng.integers(0, 80)
                q[at:at + int(rng.integers(1, 9))] = rng.integers(1, 2**31)
            lo = int(rng.integers(18, 24))
            tokens.append(q[lo:lo + 46 + k % 4])
            nodes.append(45 - lo)
        cuts.append(len(tokens))
    want = []
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        own = [passages._Context(tokens[i], nodes[i], length) for i in range(lo, hi)]
        root = list(range(hi - lo))
        for x in range(hi - lo):
            for y in range(x + 1, hi - lo):
                if root[x] != root[y] and passages.best_similarity(own[x].tokens, own[x].node, own[y].tokens, own[y].node, length) >= 0.8:
                    root = [root[x] if r == root[y] else r for r in root]
                    want.append((lo + x, lo + y))
    got = passages.linked_groups(tokens, nodes, np.array(cuts), length, 0.8)
    assert sorted(got) == sorted(want) and 20 < len(want) < len(tokens) - len(cuts)


def test_group_that_pivots_join_is_dealt_in_as_many_rows_as_it_has(spark, monkeypatch):
    """Near copies of one passage with a few other kinds: rows compared stay in proportion, and no link is lost."""
    rng = np.random.default_rng(6)
    base, rows = rng.integers(1, 2**31, 46).astype(np.uint32), []

    def add(tokens):
        rows.append((7, 7, len(rows), len(rows), 20, bytearray(tokens.astype(np.uint32).tobytes())))

    for k in range(101):
        q = base.copy()
        q[45] = 2 * k + 1
        if k == 50:
            q[:5], q[45] = rng.integers(1, 2**31, 5), 1     # similar to kind 0
            chain = q.copy()
        add(q)
    chain[41:] = rng.integers(1, 2**31, 5)              # similar to kind 50 only
    add(chain)
    for k in range(5):
        own = rng.integers(1, 2**31, 46)
        own[20] = base[20]
        add(own)
        if k == 0:
            own[0] = 3
            add(own)
    kinds = spark.createDataFrame(rows, passages._KIND)
    sizes, inner = [], passages._compare

    def compare(kinds, *a):
        sizes.append([r["count"] for r in kinds.groupBy("g").count().collect()])
        return inner(kinds, *a)

    monkeypatch.setattr(passages, "_compare", compare)
    linked = [(r.kind_a, r.kind_b) for r in passages._verified(kinds, 46, 0.8, 20).collect()]
    assert classes(len(rows), linked) == [0] * 102 + [102, 102, 104, 105, 106, 107]
    assert sum(sizes[-1]) <= 2 * len(rows) and max(sizes[-1]) <= 40
    # where all are joined, none are compared again
    sizes.clear()
    linked = [(r.kind_a, r.kind_b) for r in passages._verified(kinds.filter("kind < 101"), 46, 0.8, 20).collect()]
    assert classes(101, linked) == [0] * 101 and not sum(map(sum, sizes))
