import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from raremine.llm import phrases as P


def brute(rows, max_words=3, least=10, inside=50, top=2000):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for size in range(1, max_words + 1):
                f[lang].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, c in f.items():
        found = []
        often = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        worst = Counter()
        for p, a in often.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    worst[p[i:i + m]] = max(worst[p[i:i + m]], a)
        for p, a in often.items():
            cut = min((10 ** 6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            if not (p in worst and 100 * worst[p] >= inside * a):
                found.append((-cut[0], -a, " ".join(p).encode(), cut[2], cut[3]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(11)
    words = ["the", "The", "of", "New", "york", "city", "a", "b", "é", "É", "x|y", "ab", "AB", "\U0001f600"] + [f"w{i}" for i in range(40)]
    weight = [30, 20, 25, 12, 12, 9, 8, 8, 6, 4, 3, 3, 3, 2] + [1] * 40
    rows = []
    for i in range(300):
        w = r.choices(words, weight, k=r.randrange(0, 60))
        glue = [r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "! ", "\x0b", "\xa0"]) for _ in w]
        rows.append((r.choice(["en", "en", "de", None, "und", ""]), "".join(a + b for a, b in zip(w, glue))))
    rows += [("en", None), (None, ""), ("fr", " \n.,"), ("en", "new york city " * 4000), rows[0], rows[0],
             ("en", "hot word, " * 300), ("de", "ab ab ab ab " * 100), ("en", "z" * 5000)]
    return rows


@pytest.fixture(scope="module")
def table(spark, corpus):
    data = [(i, t, lang, "k", 1, 2, "w") for i, (lang, t) in enumerate(corpus)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, word string, n long, id long, block string").repartition(4)


def test_equals_brute_force(table, corpus):
    assert result(P.collocations(table)) == brute(corpus)


def test_small_blocks_and_other_parameters(table, corpus):
    """Blocks of a few hundred bytes: long texts are cut at separators."""
    assert result(P.collocations(table, block_bytes=300, max_words=4, min_count=7, inside_percent=80, top=25)) == brute(corpus, 4, 7, 80, 25)
    assert result(P.collocations(table, max_words=2, min_count=3)) == brute(corpus, 2, 3)


def test_dense_and_sparse_tiles(table, corpus, monkeypatch):
    for tile, head, dense in ((4, 16, 0.1), (4, 16, 1e9), (2, 2, 0)):
        monkeypatch.setattr(P, "TILE", tile)
        monkeypatch.setattr(P, "HEAD", head)
        monkeypatch.setattr(P, "DENSE", dense)
        r = np.random.default_rng(3)
        a, b = (r.zipf(1.4, 4000).astype(np.int64) % 60 for _ in "ab")
        for n_right in (60, 1 << 61):
            got = Counter({(x, y): n for x, y, n in zip(*(v.tolist() for v in P.count_cells(a, b, n_right)))})
            assert got == Counter(zip(a.tolist(), b.tolist()))


def test_real_texts(docs, rows):
    assert result(P.collocations(docs)) == brute([("en", t) for _, t in rows])


def test_empty(empty, spark):
    assert P.collocations(empty).count() == 0
    assert P.collocations(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).count() == 0
