import hashlib
import re

import pyarrow.parquet as pq
import pytest
from llm_helpers import SMALL

from raremine.llm import decontaminate, queries


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    w = words(text)
    hit, found = set(), set()
    for item, x in items:
        iw = words(x)
        size = min(10, len(iw))
        for k in range(len(iw) - size + 1) if iw else ():
            for i in range(len(w) - size + 1):
                if w[i:i + size] == iw[k:k + size]:
                    hit |= set(range(i, i + size))
                    found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.fixture(scope="module")
def items():
    t = pq.read_table(f"{SMALL}/benchmark.parquet").to_pylist()
    rows = [(r["item_id"], r["text"]) for r in t[:12]]
    return rows + [(type(rows[0][0])(x), y) for x, y in zip(
        range(900, 907), ["", None, "five words", "one", "é ü é", rows[0][1], "a " * 30])]


def kind(items):
    return "long" if isinstance(items[0][0], int) else "string"


def test_against_brute_force(spark, docs, rows, items):
    long_ = words(items[3][1])
    extra = [(5000, "intro " + " ".join(long_[2:13]) + " outro"), (5001, " ".join(long_[2:11])),
             (5002, " ".join(long_[:10]).upper() + " mid " + " ".join(long_[5:15])), (5003, "x one y"), (5003, "x one y")]
    small = [r for r in rows if len(r[1] or "") < 4000][:120] + extra
    df = spark.createDataFrame([(i, t, 1) for i, t in small], "doc_id long, text string, items int").repartition(3)
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], f"item_id {kind(items)}, text string, hash string")
    found = decontaminate.find_contamination(df, bench).collect()
    got = sorted((str(r.doc_id), r.n_words, len({w for s in r.spans or [] for w in range(s["from"], s["to"])}),
                  len(r["items"] or []), hashlib.sha256(",".join(sorted(r["items"] or [])).encode()).hexdigest(), bool(r.spans))
                 for r in found)
    assert got == sorted((str(i), *brute(t, items)) for i, t in small)
    assert sum(r[-1] for r in got) >= 4
    clean = decontaminate.remove_contaminated(df, bench)
    assert clean.columns == df.columns and clean.count() == sum(not r[-1] for r in got)


def test_bitmap_size_changes_nothing(spark, docs, items):
    bench = spark.createDataFrame(items, f"item_id {kind(items)}, text string")
    a, b = (decontaminate.find_contamination(docs, bench, bitmap_bits=k).select("doc_id", "n_words", "items").collect() for k in (7, 24))
    norm = lambda out: sorted((str(r.doc_id), r.n_words, sorted(r["items"] or [])) for r in out)
    assert norm(a) == norm(b)


def test_query_figures(spark):
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SMALL}/benchmark.parquet").to_pylist()]
    t = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SMALL}/documents.parquet").to_pylist()}
    grams = {tuple(words(x)[k:k + 10]) for _, x in items for k in range(len(words(x)) - 9)}
    out = queries.op9_decontamination(spark, SMALL).collect()
    assert len(out) == len(t)
    for r in out:
        w = words(t[r.doc_id])
        if r.contaminated or any(tuple(w[i:i + 10]) in grams for i in range(len(w) - 9)):
            assert tuple(r)[1:] == brute(t[r.doc_id], items)


def test_empty_tables(spark, docs, empty, items):
    bench = spark.createDataFrame(items, f"item_id {kind(items)}, text string")
    assert decontaminate.find_contamination(empty, bench).count() == 0
    none = decontaminate.find_contamination(docs, bench.limit(0))
    assert none.count() == docs.count() and none.filter("spans is not null").count() == 0
