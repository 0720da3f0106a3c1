import re

import numpy as np
import xxhash

from raremine.llm import components, simhash


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(codes, bits):
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(codes))]


def test_components_against_brute_force(docs, rows):
    codes = [fingerprint(t) for _, t in rows]
    roots = groups(codes, 3)
    least = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted((str(i), c, least.get(r)) for (i, _), c, r in zip(rows, codes, roots))
    for max_group in (simhash.MAX_GROUP, 2):
        out = simhash.near_duplicate_components(docs, max_group=max_group).collect()
        assert sorted((str(r.doc_id), r.fingerprint % 2**64, r.component_id) for r in out) == want


def test_index_finds_every_close_pair():
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = [np.bitwise_xor.reduce(np.uint64(1) << rng.integers(0, 64, k).astype(np.uint64)) for k in (1, 2, 3, 4) * 60]
    codes = np.unique(np.concatenate([seeds, rng.choice(seeds, 240) ^ np.array(flips, np.uint64)]))
    group = np.zeros(len(codes), np.int64)
    order = np.argsort(simhash.gray_rank(codes))
    codes = codes[order]
    got = set()
    for i, j in simhash.GrayIndex(group, codes).close_pairs(3):
        got |= set(zip(i.tolist(), j.tolist()))
    want = {(i, j) for j in range(len(codes)) for i in range(j) if int(codes[i] ^ codes[j]).bit_count() <= 3}
    assert got == want and len(want) > 100


def test_gray_rank_inverts_the_gray_code():
    n = np.arange(5000, dtype=np.uint64)
    assert (simhash.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def test_one_row_of_each_group_stays(docs, rows):
    roots = groups([fingerprint(t) for _, t in rows], 3)
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    out = kept.collect()
    assert len(out) == len(set(roots))
    by = {}
    for row, r in zip(rows, roots):
        by.setdefault(r, set()).add(row)
    for r in out:
        assert sum((r.doc_id, r.text) in g for g in by.values()) == 1


def test_empty_and_null(spark, empty):
    assert simhash.near_duplicate_components(empty).count() == 0
    assert simhash.one_of_each_group(empty).count() == 0
    nulls = spark.createDataFrame([(None, None), (None, "")], "doc_id long, text string")
    assert [r.component_id for r in simhash.near_duplicate_components(nulls).collect()] == [None, None]
    assert simhash.one_of_each_group(nulls).count() == 1


def test_connected_components_of_a_path_and_a_star(spark):
    edges = [(i + 1, i) for i in range(100, 160)] + [(500 + i, 500) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.component for r in components.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{500 + i: 500 for i in range(50)}, 7: 7}
